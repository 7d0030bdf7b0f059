"""A corpus pipeline: quality rules, deduplication, decontamination, PII, packing.

Every stage takes (spark, docs, sf_dir), works on all documents its
predecessor kept and returns them with the columns of documents; the last one
returns packed pieces. ``run`` writes each stage's result to the shared folder
and reads it again for the next.

No SQL states the whole of it (a trained model decides the first stage), so
ORACLE_SQL is None and the tests compare it with a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from changefeed.llm import decontamination, jaccard_join, packing, pii, quality_rules
from changefeed.llm.components import saved


#: Bytes of marks of copies that may be sent to all tasks.
SMALL = 16 << 20

#: The text has a character other than ASCII blanks.
HAS_WORDS = r"[^\x20\x09-\x0D]"


def unused(docs: DataFrame, name: str) -> str:
    """The name, with underscores before it as long as a column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken or any(f"{name}_{x}".lower() in taken for x in ("more", "id", "gone")):
        name = f"_{name}"
    return name


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line labels keep; the labels are fitted on ``docs``."""
    out = unused(docs, "rules")
    judged = quality_rules.judge(docs, quality_rules.train(docs), out=out)
    return judged.where(F.col(f"{out}.kept")).select(*docs.columns)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row (smallest id, null last) of each group of near-duplicates; of rows that repeat id and text, one.

    Different texts with one id are judged apart. Rows without id and words all stay.
    """
    mark, order = unused(docs, "mark"), unused(docs, "place")
    gone = saved(jaccard_join.copies(docs.select("doc_id", "text")), "copies").select(F.col("doc_id").alias(f"{mark}_id"), F.col("mark").alias(f"{mark}_gone"))
    rows = docs.withColumn(mark, F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col(f"{mark}_id")) & (F.col(mark) == F.col(f"{mark}_gone"))
    # A row of ``gone`` has 16 bytes; where they are many, both sides are shuffled, texts too.
    gone = F.broadcast(gone) if 16 * gone.count() <= SMALL else gone
    kept = rows.join(gone, same, "left_anti")
    again = rows.where(F.col("doc_id").isNotNull() | F.coalesce(F.col("text").rlike(HAS_WORDS), F.lit(False))).groupBy("doc_id", mark).count().where("count > 1")
    again = saved(again.select(F.col("doc_id").alias(f"{mark}_id"), F.col(mark).alias(f"{mark}_gone")), "again")
    if again.isEmpty():
        return kept.select(*docs.columns)
    first = kept.join(again, same, "left_semi").withColumn(order, F.row_number().over(W.partitionBy("doc_id", mark).orderBy(mark)))
    once = first.where(F.col(order) == 1).select(*docs.columns)
    return kept.join(again, same, "left_anti").select(*docs.columns).unionByName(once)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share too little with the benchmark to count as contaminated."""
    out = unused(docs, "overlap")
    found = decontamination.judged(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out=out)
    return found.where(~F.col(f"{out}.contaminated")).select(*docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    key, spans = unused(docs, "row_key"), unused(docs, "spans")
    found = pii.extract(docs.select("doc_id", "text")).select(F.col("row_key").alias(key), pii.all_spans(F.col("base"), F.col("more")).alias(spans))
    found = found.where(F.size(spans) > 0).dropDuplicates([key])
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.withColumn(key, F.xxhash64("doc_id", text)).join(found, key, "left")
    hidden = F.when(F.col(spans).isNull(), F.col("text")).otherwise(pii.redacted(text, F.col(spans)))
    marked = marked.withColumn("text", hidden)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        marked = marked.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(size))
    return marked.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their places in sequences."""
    import public_tokenizers

    return packing.packed(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", keep_good),
    ("jaccard_join", keep_first),
    ("decontamination", drop_benchmark),
    ("pii", hide_personal_data),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
