"""Merkle manifest of a dataset: a content-addressed store of digests and their children.

Rows become leaves, the leaves of a source a tree, the sources' roots one more
tree. A store keeps, for every inner node, its digest and its children in
order. Proofs are found in that store: leaf requests descend from the root, at
each step the next digit of their rank selects the child to follow, and its
siblings are one more segment of the path. Requests that share the beginning
of their way share the lookups, so the root is looked up once however many
leaves are asked for. The reversed segments are the proof.

Only DataFrame functions. Texts never move: leaves are hashed where they are
read, and digests alone are shuffled. No group has more than ``FAN`` rows.

Cases: nulls are marked apart from empty values; rows repeated as a whole are
leaves of their own, next to each other, and share the store's records; rows
of one id are ordered by their digest; a source of one row has its leaf as
root; an empty table has no tree and gives no rows. Columns that are not named
do not enter a leaf, so clashing names do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from changefeed.llm.components import saved

DIGITS = 4
FAN = 1 << DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*values: Column) -> Column:
    """Lowercase hex sha256 of the values after each other."""
    return F.sha2(F.concat(*values), 256)


def marked(value: Column) -> Column:
    """A field as it enters a leaf: its bytes' number before it, null apart from the empty value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: tuple[str, ...] = FIELDS, **changed: Column) -> Column:
    """Digest of a row; ``changed`` gives fields other values."""
    return digest_of(*[marked(changed.get(name, F.col(name))) for name in fields])


def ranked(rows: DataFrame, group: str, order: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with _rank from 0 in ``group`` (nulls first, one group) and _n, the group's rows; and (group, _n) of all groups.

    Ranges of (group, order) go to tasks and are sorted there; a row's number
    in its task less that of its group's first row there, plus the group's
    rows in earlier tasks, is its rank. A group may span any number of tasks.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group), *[F.col(c) for c in order]]
    dealt = rows.repartitionByRange(width, *keys).sortWithinPartitions(*keys)
    rows = saved(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranked").withColumn("_task", F.shiftright("_at", 33))
    parts = rows.groupBy(group, "_task").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    by = W.partitionBy(group)
    before = F.sum("_rows").over(by.orderBy("_task")) - F.col("_rows")
    parts = parts.select(
        F.col(group).alias("_group"), F.col("_task").alias("_part"), "_first", before.alias("_before"), F.sum("_rows").over(by).alias("_n")
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_task") == F.col("_part"))
    placed = rows.join(parts, same).withColumn("_rank", F.col("_at") - F.col("_first") + F.col("_before"))
    return placed.drop("_at", "_task", "_group", "_part", "_first", "_before"), rows.groupBy(group).agg(F.count("*").alias("_n"))


def runs(nodes: DataFrame) -> DataFrame:
    """(tree, n, rank, digest) one level up, with the children of each node; trees of one node end here."""
    up = nodes.where("n > 1").groupBy("tree", "n", F.shiftright("rank", DIGITS).alias("rank"))
    up = up.agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("run"))
    up = up.select("tree", F.shiftright(F.col("n") + FAN - 1, DIGITS).alias("n"), "rank", F.col("run.digest").alias("children"))
    return up.withColumn("digest", F.sha2(F.array_join("children", ""), 256))


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def levels_of(n: Column, most: int) -> Column:
    """``height`` of a column; ``most`` is that of its largest value."""
    return sum((F.when(n > FAN**k, 1).otherwise(0) for k in range(most)), F.lit(0))


@dataclass
class Manifest:
    """Trees of a dataset. ``store``: per height, digest -> children; all written tables.

    ``leaves`` has tree, rank and n of each row, its source, leaf and the
    columns that ``build`` was asked to keep; ``sources`` has tree, source,
    subroot, rank and n (sources) of the top tree.
    """

    leaves: DataFrame
    sources: DataFrame
    store: list[DataFrame]
    top: list[DataFrame]
    root: str | None


def tree(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Records of each level, lowest first, and (tree, digest) of the roots."""
    store, done = [], nodes.where("n = 1").select("tree", "digest")
    for k in range(levels):
        nodes = saved(runs(nodes), f"level-{k}")
        # Equal digests have equal children.
        store.append(nodes.groupBy("digest").agg(F.first("children").alias("children")))
        done = done.unionByName(nodes.where("n = 1").select("tree", "digest"))
    return store, done


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, source: str = "source", id_col: str = "doc_id", **keep: Column) -> Manifest:
    """Leaves in order of id below their source, the sources in order of their bytes (null first)."""
    rows = docs.select(
        F.col(source).cast("string").alias("source"), F.col(id_col).alias("doc_id"), leaf(fields).alias("leaf"), *[c.alias(n) for n, c in keep.items()]
    )
    placed, sizes = ranked(rows, "source", ("doc_id", "leaf"))
    sizes = sizes.select("source", F.col("_n").alias("n"), F.lit(0).alias("_all"))
    named = ranked(sizes, "_all", ("source",))[0].select(F.col("source").alias("_source"), "n", F.col("_rank").alias("tree"), F.col("_n").alias("trees"))
    named = saved(named, "trees")
    most = named.agg(F.max("n").alias("n"), F.max("trees").alias("trees")).first()
    if most["n"] is None:
        none = placed.select(F.lit(0).cast("long").alias("tree"), F.col("_rank").alias("rank"), F.col("_n").alias("n"), "source", "doc_id", "leaf", *keep)
        return Manifest(none, none.select("tree", "source", F.col("leaf").alias("subroot"), "rank", "n"), [], [], None)
    sides = named.select("_source", "tree")
    leaves = placed.join(sides, F.col("source").eqNullSafe(F.col("_source")))
    leaves = saved(leaves.select("tree", F.col("_rank").alias("rank"), F.col("_n").alias("n"), "source", "doc_id", "leaf", *keep), "leaves")
    store, roots = tree(leaves.select("tree", "rank", "n", F.col("leaf").alias("digest")), height(most["n"]))
    tops = named.join(roots, "tree")
    tops = saved(tops.select("tree", F.col("_source").alias("source"), F.col("digest").alias("subroot"), F.col("tree").alias("rank"), F.col("trees").alias("n")), "subroots")
    top, root = tree(tops.select(F.lit(0).cast("long").alias("tree"), "rank", "n", F.col("subroot").alias("digest")), height(most["trees"]))
    return Manifest(leaves, tops, store, top, root.first()["digest"])


def segment(children: Column, digit: Column) -> Column:
    """The children not selected: those before it and those after it."""
    joined = lambda part: F.array_join(part, "")
    before = joined(F.slice(children, F.lit(1), digit))
    after = joined(F.slice(children, digit + 2, F.lit(FAN)))
    return F.struct(before.alias("before"), after.alias("after"))


def descend(front: DataFrame, asked: list[DataFrame], store: list[DataFrame]) -> DataFrame:
    """From nodes (tree, height, rank, digest, path, ...) to all nodes of height 1 or 0 that are asked for.

    ``asked[h]`` has (tree, rank, digits) of the nodes of height h on the way
    to requested leaves.
    """
    done = front.where("height <= 1")
    for h in range(len(store), 1, -1):
        now = front.where(F.col("height") == h).join(asked[h], ["tree", "rank"]).join(store[h - 1], "digest")
        now = now.withColumn("digit", F.explode("digits"))
        now = now.withColumn("path", F.concat("path", F.array(segment(F.col("children"), F.col("digit")))))
        now = now.withColumn("digest", F.element_at("children", F.col("digit") + 1)).withColumn("height", F.lit(h - 1))
        now = now.withColumn("rank", F.shiftleft("rank", DIGITS) + F.col("digit")).select(*front.columns)
        front = saved(front.where(F.col("height") < h).unionByName(now), "front")
        done = front.where("height <= 1")
    return done


def digits_of(requests: DataFrame, levels: int) -> list[DataFrame]:
    """For each height from 2: nodes on the way to the requests and the digits to follow; below that, nothing."""
    asked: list[DataFrame] = [None, None]  # type: ignore[list-item]
    ways = requests.select("tree", F.shiftright("rank", DIGITS).alias("rank")).distinct()
    for _ in range(2, levels + 1):
        here = ways.groupBy("tree", F.shiftright("rank", DIGITS).alias("rank"))
        asked.append(saved(here.agg(F.array_sort(F.collect_list(F.col("rank").bitwiseAND(FAN - 1).cast("int"))).alias("digits")), "asked"))
        ways = asked[-1].select("tree", "rank")
    return asked


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The rows of ``requests`` (of ``manifest.leaves``; None: all) with subroot, root and path.

    ``path`` leads from the leaf to the root: per level the digests of the
    siblings before and after the node, each joined. A level of one node has
    two empty strings.
    """
    requests = manifest.leaves if requests is None else requests
    path = "array<struct<before: string, after: string>>"
    columns = [F.col("wanted.member")[c].alias(c) for c in requests.columns]
    if manifest.root is None:
        return requests.select(*requests.columns, F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"), F.lit(None).cast(path).alias("path"))
    spark, up = requests.sparkSession, len(manifest.top)
    # Requests below one node of height 1 travel as one row, FAN of them unless rows of the request repeat.
    member = F.struct(F.col("rank").bitwiseAND(FAN - 1).cast("int").alias("digit"), F.struct(*requests.columns).alias("member"))
    below = requests.groupBy("tree", F.shiftright("rank", DIGITS).alias("rank"), "n").agg(F.collect_list(member).alias("wanted"))
    below = saved(below, "requests")
    trees = below.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank")).distinct()
    front = spark.createDataFrame([(0, up, 0, manifest.root)], "tree long, height int, rank long, digest string").withColumn("path", F.array().cast(path))
    front = descend(front, digits_of(trees, up), manifest.top)
    if up:
        wanted = trees.groupBy(F.shiftright("rank", DIGITS).alias("rank")).agg(F.collect_list(F.col("rank").bitwiseAND(FAN - 1).cast("int")).alias("digits"))
        front = front.join(wanted, "rank").join(manifest.top[0], "digest").withColumn("digit", F.explode("digits"))
        front = front.select(
            (F.shiftleft("rank", DIGITS) + F.col("digit")).alias("tree"),
            F.element_at("children", F.col("digit") + 1).alias("digest"),
            F.concat("path", F.array(segment(F.col("children"), F.col("digit")))).alias("path"),
        )
    levels = len(manifest.store)
    sizes = below.groupBy("tree").agg(F.max("n").alias("n"))
    front = front.select("tree", F.lit(0).cast("long").alias("rank"), "digest", "path", F.col("digest").alias("subroot")).join(sizes, "tree")
    front = saved(front.withColumn("height", levels_of(F.col("n"), levels)).drop("n"), "front")
    asked = digits_of(below.select("tree", F.shiftleft("rank", DIGITS).alias("rank")), levels)
    front = descend(front, asked, manifest.store)
    joined = front.join(below.drop("n"), ["tree", "rank"])
    alone = joined.where("height = 0").withColumn("wanted", F.explode("wanted")).select(*columns, "subroot", "path")
    if levels:
        found = joined.where("height = 1").join(manifest.store[0], "digest").withColumn("wanted", F.explode("wanted"))
        last = F.array(segment(F.col("children"), F.col("wanted.digit")))
        alone = alone.unionByName(found.select(*columns, "subroot", F.concat("path", last).alias("path")))
    return alone.select(*requests.columns, "subroot", F.lit(manifest.root).alias("root"), F.reverse("path").alias("path"))


def siblings(path: Column) -> Column:
    """Digest of all siblings of a path."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))
