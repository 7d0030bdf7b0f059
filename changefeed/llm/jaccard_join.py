"""Groups of documents whose word shingles overlap, by vertical partitioning.

A document's set holds the 64-bit hashes of its distinct word shingles. The
global order of shingles (that of their hashes) is cut into fragments of equal
width; every set falls into segments, one per fragment, and a fragment is one
group of segments. Fragments do two things on their own, each followed by a
sum over fragments:

* they find which shingles occur in two sets or more. Two sets can link only
  if each shares at least the threshold's part of its shingles with others;
  that leaves few candidates. Among a candidate's shingles, rarest first, a
  prefix must meet any partner's prefix, which gives candidate pairs;
* they count the partial overlaps of candidate pairs; the sum decides.

Documents with equal sets are one node. Only groups are wanted, so pairs
inside a group that other links already hold together are not tested. First
sets with an equal least shingle, by a few orders of the shingles, are tested
against one of them, which joins most near copies with a few pairs each. Then
the posting lists that still span several groups are taken: their members are
tested against a few hubs of the list, and again against more hubs while the
list spans several groups.
A list is given up only when all its members are in one group or all its pairs
across groups were tested, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from changefeed.llm.blobs import binary, flat
from changefeed.llm.chunks import ranges
from changefeed.llm.components import components, discarded, saved
from changefeed.llm.text import BLANKS, Slice, Windows, Words, mixed, per_doc, release, slices, windows_of

ORDERS = 8  # of shingles, by whose least ones sets are first tested
HUBS = 16  # of a list in the first round
GROWTH = 16  # how many times more hubs each further round has
PAIRS = 1_000_000  # that one part makes
LOT = PAIRS // 4  # pairs that a task looks at together, and rows of one part
SLAB = 2 * PAIRS  # of one fragment, that a task is given
SMALL = 16 << 20  # bytes of pairs that may be sent to all tasks
FRAGMENT = 1_000_000  # shingles of candidates that one fragment counts
BATCH_BYTES = 8 << 20  # of rows that a task hands over together


def shingle_sets(part: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document in rising order, and where each document's begin."""
    words = Words(part, BLANKS)
    first, doc = windows_of(words, width, short=True)
    last = np.minimum(first + width, words.at[1:][doc])
    values = Windows(words.hashes()).of(first, last)
    at = np.searchsorted(doc, np.arange(part.n + 1))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return values[new], np.searchsorted(doc[new], np.arange(part.n + 1))


def set_keys(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One 64-bit key per set, equal for equal sets."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mixed(values ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64, out=sums[1:])
    return mixed(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64)


_NODE = pa.struct([("n_shingles", pa.int64()), ("set_key", pa.int64())])


def nodes(docs: DataFrame, text_col: str = "text", width: int = 5, out: str = "shingles") -> DataFrame:
    """All columns of ``docs`` and a struct ``out``: n_shingles, set_key (null without words)."""

    def apply(column: pa.Array) -> pa.Array:
        counts, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for part in slices(column, lower=True):
            values, at = shingle_sets(part, width)
            counts.append(np.diff(at))
            keys.append(set_keys(values, at))
        n = np.concatenate(counts)
        return pa.StructArray.from_arrays([pa.array(n), pa.array(np.concatenate(keys), mask=n == 0)], fields=list(_NODE))

    return docs.withColumn(out, F.arrow_udf(apply, "n_shingles bigint, set_key bigint")(F.col(text_col)))


def _fragment(values: np.ndarray, fragments: int) -> np.ndarray:
    return ((values >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int32)


_BLOBS = "keys binary, sizes binary, counts binary, values binary"


def _blobs(place: int, keys: np.ndarray, sizes: np.ndarray, counts: np.ndarray, values: np.ndarray) -> tuple:
    """Segments of several sets as one row: a place to go to, set keys, set sizes, segment lengths, shingles."""
    return place, keys.tobytes(), sizes.astype(np.uint32).tobytes(), counts.astype(np.uint32).tobytes(), values.tobytes()


def _rows(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of a place and blobs, in batches of bounded size."""
    lot, size = [], 0
    for row in rows:
        lot.append(row)
        size += sum(map(len, row[1:]))
        if size >= BATCH_BYTES:
            yield _batch(lot, names)
            lot, size = [], 0
    if lot:
        yield _batch(lot, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 0 else pa.binary()) for k, c in enumerate(columns)], names)


_NAMES = ["fragment", "keys", "sizes", "counts", "values"]
_KINDS = (np.int64, np.uint32, np.uint32, np.uint64)


def _cut(n: np.ndarray, values: np.ndarray, fragments: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Sets (n values each, rising) cut at the fragment borders: the fragment, its sets, their segments' lengths, the values."""
    doc, piece = np.repeat(np.arange(len(n)), n), _fragment(values, fragments)
    order = np.argsort(piece, kind="stable")  # within a fragment by document, values rising
    values, doc, piece = values[order], doc[order], piece[order]
    ends = np.searchsorted(piece, np.arange(fragments + 1))
    for f in range(fragments):
        a, b = ends[f], ends[f + 1]
        if a < b:
            rows, counts = np.unique(doc[a:b], return_counts=True)
            yield f, rows, counts, values[a:b]


def _segments(batches: Iterator[pa.RecordBatch], width: int, fragments: int) -> Iterator[pa.RecordBatch]:
    """Sets cut at the fragment borders. A set's size goes with its first segment, the others have 0."""
    seen: set[int] = set()  # sets this task has sent already
    for batch in batches:
        for part in slices(batch.column(0), lower=True):
            values, at = shingle_sets(part, width)
            keys, n = set_keys(values, at), np.diff(at)
            wanted = np.zeros(part.n, bool)
            for i, key in enumerate(keys.tolist()):
                wanted[i] = n[i] > 0 and key not in seen
                if wanted[i]:
                    seen.add(key)
            values, keys, n = values[np.repeat(wanted, n)], keys[wanted], n[wanted]
            left = n.copy()
            rows = []
            for f, own, counts, some in _cut(n, values, fragments):
                rows.append(_blobs(f, keys[own], left[own], counts, some))
                left[own] = 0
            yield from _rows(iter(rows), _NAMES)


def _grouped(f: Callable[..., Iterator[pa.RecordBatch]], *rest) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``f(batches, *rest)`` as ``applyInArrow`` takes it: a group is read and handed over batch by batch."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches, *rest)
        release()

    return apply


def _blob_columns(batches: Iterator[pa.RecordBatch], names: list[str], kinds: tuple) -> list[np.ndarray]:
    """All rows' blobs of a group after each other, column by column; no batch is kept while the next is read."""
    found: list[list] = [[] for _ in names]
    for batch in batches:
        for name, kind, parts in zip(names, kinds, found, strict=True):
            parts.append(flat(batch.column(name), kind)[0])
    columns = []
    for kind, parts in zip(kinds, found, strict=True):
        columns.append(np.concatenate([np.zeros(0, kind), *parts]))
        parts.clear()
    return columns


def _shared(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Of one fragment: the shingles that two sets or more hold, with how many hold them, by bucket of sets.

    The segment that tells a set's size goes on, though it may hold no such shingle.
    """
    keys, sizes, counts, values = _blob_columns(batches, _NAMES[1:], _KINDS)
    only = np.zeros(len(keys), bool)
    only[np.unique(keys, return_index=True)[1]] = True  # other tasks may have sent the same set
    if not only.all():
        values = values[np.repeat(only, counts)]
        keys, sizes, counts = keys[only], sizes[only], counts[only]
    order = np.argsort(values)
    new = np.ones(len(values) + 1, bool)
    ranked = values[order]
    new[1:-1] = ranked[1:] != ranked[:-1]
    many = np.diff(np.flatnonzero(new))
    held = np.zeros(len(values), np.uint32)
    held[order] = np.repeat(np.minimum(many, 2**32 - 1).astype(np.uint32), many)
    del order, new, ranked, many
    keep = held >= 2
    counts = per_doc(keep, np.append(0, np.cumsum(counts, dtype=np.int64)))
    values, held = values[keep], held[keep]
    told = np.flatnonzero((counts > 0) | (sizes > 0))
    bucket = _bucket(keys[told], buckets)
    by = np.argsort(bucket, kind="stable")
    told, ends = told[by], np.searchsorted(bucket[by], np.arange(buckets + 1))
    item = ranges((np.cumsum(counts) - counts)[told], counts[told])
    values, held = values[item], held[item]
    keys, sizes, counts = keys[told], sizes[told], counts[told]
    at = np.append(0, np.cumsum(counts))

    def rows() -> Iterator[tuple]:
        for b, (x, y) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            if x < y:
                yield *_blobs(b, keys[x:y], sizes[x:y], counts[x:y], values[at[x] : at[y]]), held[at[x] : at[y]].tobytes()

    yield from _rows(rows(), ["bucket", *_NAMES[1:], "held"])


def _candidates(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """Of one bucket: sets that may have a partner, their shared shingles and the rarest of them.

    Shingles that nobody else holds come first in the order, so the prefix
    that a partner must meet is short of them.
    """
    keys, sizes, counts, values, held = _blob_columns(batches, [*_NAMES[1:], "held"], (*_KINDS, np.uint32))
    distinct, place = np.unique(keys, return_inverse=True)
    size = np.zeros(len(distinct), np.int64)
    np.maximum.at(size, place, sizes)
    owner = np.repeat(place, counts)
    order = np.lexsort((values, owner))
    values, held = values[order], held[order]
    held_by = np.bincount(owner, minlength=len(distinct))
    del order, owner, place
    some = held_by > 0
    distinct, size, held_by = distinct[some], size[some], held_by[some]
    ends = np.cumsum(held_by)
    begins = ends - held_by
    found: dict[str, list] = {"set_key": [], "n": [], "shared": [], "prefix": [], "least": []}
    seeds = mixed(np.arange(1, ORDERS + 1, dtype=np.uint64))
    least = np.stack([np.minimum.reduceat(mixed(values ^ seed), begins) for seed in seeds], 1).view(np.int64) if len(distinct) else []
    for key, n, a, b, mine in zip(distinct.tolist(), size.tolist(), begins.tolist(), ends.tolist(), least, strict=True):
        if 100 * (b - a) < share * n:
            continue
        length = (b - a) - (-(-share * n // 100)) + 1
        rarest = np.lexsort((values[a:b], held[a:b]))[:length]
        found["set_key"].append(key)
        found["n"].append(n)
        found["shared"].append(values[a:b].tobytes())
        found["prefix"].append(values[a:b][rarest].view(np.int64))
        found["least"].append(mine)
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(found.values(), kinds, strict=True)], list(found))


def _with_partners(batches: Iterator[pa.RecordBatch], fragments: int, slabs: int) -> Iterator[pa.RecordBatch]:
    """Sets and their partners, cut again: each fragment's row has the partners of its sets too.

    A fragment goes to ``slabs`` tasks, each with all segments and the partners of some sets.
    """
    for batch in batches:
        keys, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        values, counts = flat(batch.column(2), np.uint64)
        partners, many = flat(batch.column(3), np.int64)
        begin, slab = np.cumsum(many) - many, _bucket(keys, slabs)

        def rows() -> Iterator[tuple]:
            for f, own, size, some in _cut(counts, values, fragments):
                for k in range(slabs):
                    mine = np.where(slab[own] == k, many[own], 0)
                    yield *_blobs(f * slabs + k, keys[own], n[own], size, some), partners[ranges(begin[own], mine)].tobytes(), mine.astype(np.uint32).tobytes()

        yield from _rows(rows(), [*_NAMES, "partners", "many"])


_PAIRS = ["a", "b", "na", "nb", "overlap"]
_PAIR_KINDS = (np.int64, np.int64, np.uint32, np.uint32, np.uint32)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((mixed(keys.view(np.uint64)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _overlaps(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Of one slab of a fragment: how many shingles each set shares with its partners, by bucket of sets."""
    keys, n, counts, values, partners, many = _blob_columns(batches, [*_NAMES[1:], "partners", "many"], (*_KINDS, np.int64, np.uint32))
    if not len(partners):
        return
    order = np.argsort(keys)
    sorted_keys = keys[order]
    distinct, rank = np.unique(values, return_inverse=True)
    del values
    at = np.cumsum(counts, dtype=np.int64) - counts
    ends = np.cumsum(many, dtype=np.int64)
    held = np.repeat(np.arange(len(keys)) * len(distinct), counts) + rank  # rising: rows in order, values rising within a row
    for x in range(0, len(partners), LOT):
        some = partners[x : x + LOT]
        near = np.minimum(np.searchsorted(sorted_keys, some), len(keys) - 1)
        here = np.flatnonzero(sorted_keys[near] == some)  # else the partner has no shared shingle here
        a, b = np.searchsorted(ends, x + here, "right"), order[near[here]]
        overlap = np.zeros(len(a), np.int64)
        step = np.cumsum(counts[a], dtype=np.int64)
        begin = 0
        while begin < len(a):  # pairs in lots of bounded work
            base = step[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(step, base + 2 * LOT)))
            size = counts[a[begin:end]].astype(np.int64)
            pair, item = np.repeat(np.arange(begin, end), size), ranges(at[a[begin:end]], size)
            goal = b[pair] * np.int64(len(distinct)) + rank[item]
            found = held[np.minimum(np.searchsorted(held, goal), len(held) - 1)] == goal
            overlap[begin:end] = np.bincount(pair[found] - begin, minlength=end - begin)
            begin = end
        keep = overlap > 0
        a, b, overlap = a[keep], b[keep], overlap[keep]
        bucket = _bucket(keys[a], buckets)
        by = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[by], np.arange(buckets + 1))
        a, b, overlap = a[by], b[by], overlap[by]
        columns = [c.astype(k) for c, k in zip((keys[a], keys[b], n[a], n[b], overlap), _PAIR_KINDS, strict=True)]
        yield from _rows(_dealt(columns, bounds), ["bucket", *_PAIRS])


def _dealt(columns: list[np.ndarray], bounds: np.ndarray) -> Iterator[tuple]:
    """A row for each bucket that has some: its number, and the columns from one bound to the next as blobs."""
    for k, (x, y) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if x < y:
            yield k, *(c[x:y].tobytes() for c in columns)


def _links(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """Of one bucket: the pairs whose partial overlaps add up to a link."""
    a, b, na, nb, overlap = _blob_columns(batches, _PAIRS, _PAIR_KINDS)
    order = np.lexsort((b, a))
    a, b, na, nb, overlap = a[order], b[order], na[order], nb[order], overlap[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.append(np.flatnonzero(new), len(a))
    total = per_doc(overlap, at)
    link = 100 * total >= share * (na[new].astype(np.int64) + nb[new] - total)
    yield pa.RecordBatch.from_arrays([pa.array(a[new][link]), pa.array(b[new][link])], ["a", "b"])


def roots(docs: DataFrame, text_col: str = "text", width: int = 5, share: int = 80) -> DataFrame:
    """(node, root): the group, by its smallest set key, of every set that links
    with another one, 100 * intersection >= ``share`` * union."""
    spark = docs.sparkSession
    fragments = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = docs.select(F.col(text_col)).mapInArrow(lambda batches: _segments(batches, width, fragments), f"fragment int, {_BLOBS}")
    shared = cut.groupBy("fragment").applyInArrow(_grouped(_shared, fragments), f"bucket int, {_BLOBS}, held binary")
    found = shared.groupBy("bucket").applyInArrow(_grouped(_candidates, share), "set_key bigint, n bigint, shared binary, prefix array<bigint>, least array<bigint>")
    sets = saved(found, "sets")
    edges = verified(sets, saved(neighbours(sets, share), "pairs"), share)
    named = components(edges)
    rooted = sets.select("set_key", "n", "prefix").join(named.withColumnRenamed("node", "set_key"), "set_key", "left")
    postings = rooted.select(F.explode("prefix").alias("gram"), "set_key", "n", F.coalesce("root", "set_key").alias("root"))
    # Lists with the same members give the same pairs: one of them is enough.
    marks = F.xxhash64("set_key"), F.xxhash64("set_key", F.lit(1))
    lists = postings.groupBy("gram").agg(
        F.count("*").alias("size"), F.min("root").alias("x"), F.max("root").alias("y"), *[F.bit_xor(m).alias(f"m{k}") for k, m in enumerate(marks)]
    )
    lists = lists.where("x != y").groupBy("size", "m0", "m1").agg(F.min("gram").alias("gram"))
    postings = saved(postings.join(lists.select("gram", "size"), "gram"), "postings")
    low, high = 0, HUBS
    while not postings.isEmpty():
        pairs = hub_pairs(postings, low, high, share)
        if not pairs.isEmpty():
            linked = verified(sets, pairs, share)
            if not linked.isEmpty():
                edges = edges.union(linked)
                named = components(edges)
                postings = postings.drop("root").join(named.withColumnRenamed("node", "set_key"), "set_key", "left")
                postings = postings.withColumn("root", F.coalesce("root", "set_key"))
        low, high = high, high * GROWTH
        # A list stays open while it has members past the hubs and spans several groups.
        lists = postings.groupBy("gram").agg(F.max("size").alias("size"), F.min("root").alias("x"), F.max("root").alias("y"))
        lists = lists.where(F.col("size") > low + 1).where("x != y").select("gram")
        postings = saved(postings.select("gram", "set_key", "n", "root", "size").join(lists, "gram"), "postings")
    return named


def hub_pairs(postings: DataFrame, low: int, high: int, share: int) -> DataFrame:
    """(set_key, partners) as ``verified`` takes it, a written table: members of each posting list with its hubs, those of rank low to high.

    Long lists are dealt in slabs of members, each with all hubs, and lists and
    slabs to parts of bounded work. A part gives each pair once, in blobs by
    bucket of sets; a bucket joins the parts' blobs.
    """
    # Hubs by rank: Spark limits each gram's rows before and after the shuffle.
    place = F.row_number().over(W.partitionBy("gram").orderBy("set_key"))
    hubs = postings.withColumn("_place", place).where(F.col("_place") <= high).where(F.col("_place") > low)
    most, rows = postings.agg(F.sum(F.least("size", F.lit(high - low))), F.count("*")).first()  # pairs before equal ones are one
    parts, buckets = max(-(-most // PAIRS), -(-2 * rows // LOT)), -(-most // PAIRS)
    slabs = F.ceil(F.col("size") * F.least("size", F.lit(high - low)) / PAIRS).cast("int")
    columns = ["gram", "set_key", "n", "root", "hub", "slab"]
    members = postings.withColumn("slab", F.pmod(F.xxhash64("set_key"), slabs).cast("int")).withColumn("hub", F.lit(False))
    both = members.select(*columns).unionByName(hubs.withColumn("hub", F.lit(True)).withColumn("slab", F.explode(F.sequence(F.lit(0), slabs - 1))).select(*columns))
    dealt = both.withColumn("part", F.pmod(F.xxhash64("gram", "slab"), F.lit(parts)).cast("int"))
    found = dealt.groupBy("part").applyInArrow(_grouped(_hub_pairs, share, buckets), "bucket int, a binary, b binary")
    return saved(found.groupBy("bucket").applyInArrow(_grouped(_partners), "set_key bigint, partners binary").groupBy("set_key").agg(F.max("partners").alias("partners")), "pairs")


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, in order."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _hub_pairs(batches: Iterator[pa.RecordBatch], share: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Of one part: members with the smaller hubs of their lists, in other groups and of sizes that can link."""
    table = pa.Table.from_batches(batches)
    gram, key, n, root, slab = (table.column(c).to_numpy() for c in ("gram", "set_key", "n", "root", "slab"))
    hub = table.column("hub").to_numpy()
    del table
    order = np.lexsort((slab, gram))
    gram, key, n, root, slab, hub = gram[order], key[order], n[order], root[order], slab[order], hub[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (slab[1:] != slab[:-1])
    group = np.cumsum(new) - 1
    member, place = np.flatnonzero(~hub), np.flatnonzero(hub)
    begin = np.searchsorted(group[place], group[member])
    many = np.searchsorted(group[place], group[member], "right") - begin
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    step, x = np.cumsum(many), 0
    while x < len(member):  # pairs in lots of bounded size
        y = max(x + 1, int(np.searchsorted(step, (step[x - 1] if x else 0) + LOT)))
        left = np.repeat(member[x:y], many[x:y])
        right = place[np.arange(len(left)) - np.repeat(np.cumsum(many[x:y]) - many[x:y], many[x:y]) + np.repeat(begin[x:y], many[x:y])]
        fits = (key[left] > key[right]) & (root[left] != root[right])
        fits &= 100 * np.minimum(n[left], n[right]) >= share * np.maximum(n[left], n[right])
        a, b = _distinct(np.concatenate([a, key[left[fits]]]), np.concatenate([b, key[right[fits]]]))
        x = y
    bucket = _bucket(a, buckets)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    yield from _rows(_dealt([a[order], b[order]], ends), ["bucket", "a", "b"])


def _partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one bucket: each set with its partners, and the partners with none."""
    a, b = _distinct(*_blob_columns(batches, ["a", "b"], (np.int64, np.int64)))
    keys, at = np.unique(a, return_index=True)
    others = np.setdiff1d(b, keys)
    lists = binary(b, np.append(at, len(b)).astype(np.int64))
    lists = pa.concat_arrays([lists, pa.array([b""] * len(others), pa.binary())])
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([keys, others])), lists], ["set_key", "partners"])


def neighbours(sets: DataFrame, share: int) -> DataFrame:
    """(set_key, partners): every set with one that has the same least shingle, by each of ``ORDERS`` orders; another one by each order."""
    marks = sets.select("set_key", "n", F.posexplode("least").alias("k", "least"))
    hub = F.min_by(F.struct(F.col("set_key").alias("b"), F.col("n").alias("nb")), F.xxhash64("set_key", "k")).alias("hub")
    hubs = marks.groupBy("k", "least").agg(hub, F.count("*").alias("size")).where("size > 1").select("k", "least", "hub.b", "hub.nb")
    pairs = marks.join(hubs, ["k", "least"]).where("set_key != b")
    pairs = pairs.where(100 * F.least("n", "nb") >= share * F.greatest("n", "nb"))
    pairs = pairs.select(F.greatest("set_key", "b").alias("a"), F.least("set_key", "b").alias("b"))
    to_bytes = F.arrow_udf(_list_bytes, "binary")
    # At most one partner for each order, and those for which a set is the partner.
    partners = pairs.groupBy("a").agg(F.collect_set("b").alias("p")).select(F.col("a").alias("set_key"), to_bytes("p").alias("partners"))
    partners = partners.unionByName(pairs.select(F.col("b").alias("set_key"), F.lit(b"").alias("partners")).distinct())
    return partners.groupBy("set_key").agg(F.max("partners").alias("partners"))


def verified(sets: DataFrame, pairs: DataFrame, share: int) -> DataFrame:
    """The pairs that link, as a written table: partial overlaps by fragment, summed.

    ``pairs`` has a row for each set of a pair, with its partners' keys as bytes
    where it is the larger one.
    """
    # Few pairs go to the sets, with many both are shuffled: 8 bytes a pair, and the keys.
    told = pairs.agg(F.count("*").alias("keys"), F.sum(F.length("partners")).alias("bytes")).first()
    many = (told["bytes"] or 0) // 8
    partners = F.broadcast(pairs) if 8 * (2 * told["keys"] + many) <= SMALL else pairs
    rows = saved(sets.select("set_key", "n", "shared").join(partners, "set_key").select("set_key", "n", "shared", "partners"), "asked")
    # A pair has a partial overlap in each fragment at most, and one for each shingle of the larger set.
    sizes = rows.agg(F.sum(F.length("shared")), F.sum(F.length("shared").cast("double") * F.length("partners"))).first()
    fragments = max(1, -(-(sizes[0] or 0) // (8 * FRAGMENT)))
    partial = min(many * fragments, int(sizes[1] or 0) // 64)
    slabs = max(1, -(-partial // (fragments * SLAB)))
    buckets = max(1, -(-partial // (FRAGMENT // 2)))
    cut = rows.mapInArrow(lambda batches: _with_partners(batches, fragments, slabs), f"fragment int, {_BLOBS}, partners binary, many binary")
    counted = cut.groupBy("fragment").applyInArrow(_grouped(_overlaps, buckets), f"bucket int, {', '.join(f'{c} binary' for c in _PAIRS)}")
    linked = saved(counted.groupBy("bucket").applyInArrow(_grouped(_links, share), "a bigint, b bigint"), "links")
    discarded(rows)
    return linked


def _list_bytes(lists: pa.Array) -> pa.Array:
    at = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    return binary(values[at[0] : at[-1]].astype(np.int64), (at - at[0]).astype(np.int64))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, share: int = 80) -> DataFrame:
    """One row per row of ``docs``: its id as doc_id, n_shingles, component_id (smallest id of its group).

    Texts without words (null, empty) are alone: component_id is their own id.
    Repeated rows stay; equal texts are in one group. Null ids keep a row, with
    the group's smallest non-null id.
    """
    own = nodes(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), "_text", width)
    own = saved(own.select("doc_id", "shingles.n_shingles", "shingles.set_key"), "nodes")
    named = roots(docs.select(F.col(text_col)), text_col, width, share)
    sets = own.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("least"))
    sets = sets.join(named.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))
    least = sets.groupBy("root").agg(F.min("least").alias("component_id"))
    least = sets.select("set_key", "root").join(least, "root").select("set_key", "component_id")
    found = own.join(least, "set_key", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, share: int = 80) -> DataFrame:
    """(doc_id, mark), distinct, of the rows that are not the first of their group; mark is ``xxhash64`` of the text.

    The first has the smallest (doc_id, mark), null ids last. Texts without
    words are alone. Rows that repeat both id and text are one here.
    """
    own = nodes(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), "_text", width)
    own = saved(own.where("shingles.set_key IS NOT NULL").select("doc_id", F.xxhash64("_text").alias("mark"), "shingles.set_key"), "nodes")
    named = roots(docs.select(F.col(text_col)), text_col, width, share)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    sets = own.groupBy("set_key").agg(F.min(place).alias("first"))
    sets = sets.join(named.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))
    first = sets.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("_id"), F.col("first.mark").alias("_mark"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    return own.select("doc_id", "mark").distinct().join(first, same, "left_anti")
