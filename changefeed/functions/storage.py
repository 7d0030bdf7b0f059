"""Folders on whatever storage the session is set up for.

Control work on names only; the data is never touched here.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def _open(spark: SparkSession, path: str, encoded: bool = False):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if encoded else path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str, encoded: bool = False) -> bool:
    """``encoded`` for names as Spark's file metadata gives them."""
    fs, target = _open(spark, path, encoded)
    return fs.delete(target, True)


def delete_all(files: DataFrame) -> list[str]:
    """Delete the files of ``files`` (file_path, as Spark's metadata gives it); the ones that are gone.

    Tasks delete what a file system of Arrow's reaches, the driver the rest.
    """

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            done = []
            for name in batch.column("file_path").to_pylist():
                # Spark writes file:/a where Arrow wants a path.
                local = urlparse(name).scheme in ("", "file")
                try:
                    store, path = (fs.LocalFileSystem(), unquote(urlparse(name).path)) if local else fs.FileSystem.from_uri(unquote(name))
                    store.delete_file(path)
                    done.append(True)
                except FileNotFoundError:
                    done.append(None)
                except (OSError, pa.ArrowInvalid, ImportError):
                    done.append(False)
            yield pa.RecordBatch.from_arrays([batch.column("file_path"), pa.array(done, pa.bool_())], ["file_path", "gone"])

    found = files.mapInArrow(in_task, "file_path string, gone boolean").filter("gone IS NOT NULL").toLocalIterator()
    spark = files.sparkSession
    return [r.file_path for r in found if r.gone or delete(spark, r.file_path, encoded=True)]


def names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names directly below ``path`` that start with ``prefix``, as of days."""
    fs, target = _open(spark, path)
    found = []
    entries = fs.listStatusIterator(target)
    while entries.hasNext():
        name = entries.next().getPath().getName()
        if name.startswith(prefix):
            found.append(name)
    return sorted(found)
