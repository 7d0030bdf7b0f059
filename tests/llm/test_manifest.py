"""The Merkle manifest against a plain tree, on hard rows and for some of the leaves only."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from changefeed.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, tree string, rank string, digest string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def plain_levels(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def plain_path(levels, rank):
    path = []
    for level in levels[:-1]:
        run, at = level[rank // 16 * 16 : rank // 16 * 16 + 16], rank % 16
        path.append(("".join(run[:at]), "".join(run[at + 1 :])))
        rank //= 16
    return path


def plain(rows):
    """(doc_id, leaf, subroot, root, path) of all rows, in order."""
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(((row[0] is not None, row[0] or 0, plain_leaf(row)), row[0]))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: plain_levels([x[0][2] for x in sorted(trees[s])]) for s in names}
    top = plain_levels([levels[s][-1][0] for s in names])
    found = []
    for k, s in enumerate(names):
        for rank, (key, doc_id) in enumerate(sorted(trees[s])):
            found.append((doc_id, key[2], levels[s][-1][0], top[-1][0], plain_path(levels[s], rank) + plain_path(top, k)))
    return found


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for i in range(n):
            text = rng.choice(["", None, f"Text {rng.random()} é", "x" * rng.randint(1, 3000)])
            rows.append((rng.randint(0, 10**6), source, rng.choice([None, "en", ""]), rng.choice([None, i]), text, "t", "r", "d"))
    rng.shuffle(rows)
    return rows


def found(proved):
    return sorted(
        ((r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]]) for r in proved.collect()),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[4]),
    )


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[4]))


def test_proofs_of_trees_of_all_heights(spark):
    rows = rows_of({None: 3, "": 1, "a": 17, "b": 16, "é": 273, "z": 2})
    rows += [(None, "a", None, None, None, "t", "r", "d"), rows[0], rows[0], (5, "a", "x", 1, "one", "", "", ""), (5, "a", "x", 1, "two", "", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    proved = manifest.proofs(manifest.build(docs))
    assert found(proved) == ordered(plain(rows))
    folds = proved.select((manifest.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"), manifest.siblings(F.col("path")).alias("all"), "path").collect()
    assert all(r["ok"] for r in folds)
    assert all(r["all"] == sha(*[x for s in r["path"] for x in s]) for r in folds)


def test_many_sources(spark):
    rows = rows_of({f"s{k}": 1 + k % 3 for k in range(40)})
    assert found(manifest.proofs(manifest.build(spark.createDataFrame(rows, SCHEMA)))) == ordered(plain(rows))


def test_one_row_and_none(spark):
    rows = rows_of({"only": 1})
    (one,) = manifest.proofs(manifest.build(spark.createDataFrame(rows, SCHEMA))).collect()
    assert one["leaf"] == one["subroot"] == one["root"] == plain_leaf(rows[0]) and one["path"] == []
    built = manifest.build(spark.createDataFrame([], SCHEMA))
    assert built.root is None and manifest.proofs(built).collect() == []


def test_some_requests_and_tampering(spark):
    rows = rows_of({"a": 300, "b": 40}, 2)
    docs = spark.createDataFrame(rows, SCHEMA)
    changed = manifest.leaf(text=F.concat(F.col("text"), F.lit("!")))
    built = manifest.build(docs, changed=changed)
    some = built.leaves.where("source = 'a' and rank in (0, 15, 16, 299) or source = 'b' and rank = 33")
    proved = manifest.proofs(built, some)
    wanted = {r["doc_id"] for r in some.collect()}
    assert found(proved) == ordered([r for r in plain(rows) if r[0] in wanted])
    bad = proved.select((F.col("changed") == F.col("leaf")).alias("same"), (manifest.folded(F.col("changed"), F.col("path")) == F.col("root")).alias("ok"))
    assert all(r["same"] == r["ok"] for r in bad.collect())
