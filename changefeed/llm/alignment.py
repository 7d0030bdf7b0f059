"""Tokens of two tokenizers aligned: common cuts, overlapping pairs, and how often a pair occurs.

The character offsets of one tokenizer and the spans of the other are coarse
cuts of the text. Where such a cut does not fit the token's own bytes (several
tokens of one character, byte-fallback tokens, the space put before a text),
it is refined by the decoded bytes. Places at which both end are group ends;
every stretch between two ends of either is one overlapping pair.

Neither tokenizer joins a character other than white space with a space or line
end after it, nor with a line end before it (checked when the vocabulary is
read), so texts are cut there, and each distinct chunk is encoded once.

Documents are read once. A slice keeps, as one row of a written table, its
distinct pairs and which chunks its documents have; the pairs are summed up
over all slices, and each slice asks for the sums of its own pairs. No text is
shuffled, and no task holds more than a slice (or one longer document).

Cases: texts that are null, empty, or that either vocabulary does not give
back byte for byte have no tokens and add to no count; repeated rows all
count; without rows the result is empty. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from changefeed.llm.blobs import packed, unpacked
from changefeed.llm.chunks import Numbers, chunks, ranges
from changefeed.llm.components import saved
from changefeed.llm.text import Slice, per_doc, slices

#: Distinct chunks (and bytes of them) that a worker remembers between slices.
MEMO_CHUNKS, MEMO_BYTES = 500_000, 32 << 20
#: Chunks that are new to a worker are encoded together, in texts of about this size.
JOINED_BYTES = 1 << 16


def byte_signs() -> dict[str, int]:
    """The byte for each character of a byte-level vocabulary: printable ones stand for themselves, others follow U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """A tokenizer's tokens as bytes, and its encoding of chunks with coarse cuts."""

    decoded: list[bytes]

    def finish(self) -> None:
        self.size = np.array([len(d) for d in self.decoded], np.int64)
        blank = [d for d in self.decoded if b" " in d[1:] or b"\n" in d[:-1] or b"\n" in d[1:]]
        across = [d for d in blank if cuts(np.frombuffer(d, np.uint8))[1:].any()]
        if across:
            raise ValueError(f"tokens over a place where texts are cut: {across[:3]}")

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids, and the byte of the text at which each token ends as far as the tokenizer says."""
        raise NotImplementedError

    def one(self, data: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and ends of a text; None if the tokens' bytes are not the text's.

        A text that does not begin with a space stands behind a word (and a
        line end), after which texts are cut too.
        """
        guard = b"" if data[:1] == b" " else b" a" if data[:1] == b"\n" else b" a\n"
        ids, coarse = self.encode((guard + data).decode())
        if b"".join([self.decoded[i] for i in ids]) != guard + data:
            return None
        own, cut = np.array(ids, np.int64), np.array(coarse, np.int64)
        # A coarse cut stands where the bytes of the tokens before it agree; others lie inside a character, and bytes tell where.
        fine = np.cumsum(self.size[own])
        ends = np.where(cut == fine, cut, fine) - len(guard)
        return own[ends > 0], ends[ends > 0]

    def tokens(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all chunks after each other, their ends (from each chunk's begin), how many a chunk has, and if its bytes come back.

        Chunks between which texts are cut anyway are encoded as one text.
        """
        size = np.array([len(c) for c in found], np.int64)
        place = np.cumsum(size) - size
        apart = ~cuts(np.frombuffer(b"".join(found), np.uint8))[place]
        begins, length = [], 0
        for k, (alone, n) in enumerate(zip(apart.tolist(), size.tolist(), strict=True)):
            if alone or length > JOINED_BYTES:
                begins.append(k)
                length = 0
            length += n
        todo, ids, ends, count = list(zip(begins, [*begins[1:], len(found)], strict=True)), {}, {}, np.zeros(len(found), np.int64)
        right = np.ones(len(found), bool)
        while todo:
            x, y = todo.pop()
            if (own := self.one(b"".join(found[x:y]))) is not None:
                ids[x], ends[x] = own
                stops = np.searchsorted(own[1], place[x:y] + size[x:y] - place[x], "right")
                count[x:y] = np.diff(stops, prepend=0)
                ends[x] = own[1] - np.repeat(place[x:y] - place[x], count[x:y])
            elif y == x + 1:
                right[x] = False
            else:
                todo += [(k, k + 1) for k in range(x, y)]
        order = sorted(ids)
        none = [np.zeros(0, np.int64)]
        return np.concatenate(none + [ids[x] for x in order]), np.concatenate(none + [ends[x] for x in order]), count, right


class ByteLevel(Vocabulary):
    """A byte-level vocabulary of tokenizers; special tokens are plain text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        signs = byte_signs()
        names = [self.model.id_to_token(i) or "" for i in range(self.model.get_vocab_size())]
        special = {i for i, t in self.model.get_added_tokens_decoder().items() if t.special}
        self.decoded = [b"" if i in special else bytes(signs[c] for c in name) for i, name in enumerate(names)]
        self.finish()

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        found = self.model.encode(text, add_special_tokens=False)
        ends = [end for _, end in found.offsets]
        if not text.isascii():
            points = np.frombuffer(text.encode(), np.uint8)
            place = np.append(np.flatnonzero((points & 0xC0) != 0x80), len(points))
            ends = place[ends].tolist()
        return found.ids, ends


class Pieces(Vocabulary):
    """A sentencepiece model with byte fallback; it puts the first space before a text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        self.decoded = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self.finish()

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        pieces = self.model.encode(text[1:], out_type="proto").pieces
        return [p.id for p in pieces], [p.end + 1 for p in pieces]


def cuts(data: np.ndarray) -> np.ndarray:
    """True at spaces and line ends after a character that no tokenizer takes for
    white space, and at such a character after a line end (some places are left uncut)."""
    before = np.concatenate([[0], data[:-1]])
    plain = (data > 0x20) & (data < 0x7F)
    # First bytes of longer characters, but of those that white space (or U+2581) begins with too.
    long = (data >= 0xC3) & ~np.isin(data, (0xE1, 0xE2, 0xE3, 0xEF))
    size = np.where(data >= 0xF0, 4, np.where(data >= 0xE0, 3, 2))
    ends = np.zeros(len(data) + 4, bool)  # after the last byte of a word's character
    ends[np.flatnonzero(plain) + 1] = True
    first = np.flatnonzero(long)
    ends[first + size[first]] = True
    return ((data == 0x20) | (data == 0x0A)) & ends[: len(data)] | (before == 0x0A) & (plain | long)


class Aligned:
    """What is known of distinct chunks: tokens, groups, text of the groups, pairs."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.a, self.b = a, b
        self.numbers = Numbers(MEMO_CHUNKS, MEMO_BYTES)
        self.clear()

    def clear(self) -> None:
        self.numbers.clear()
        self.facts = np.zeros((0, 5), np.int64)  # tokens a, tokens b, groups, pairs, 1 if the bytes do not come back
        self.written: list[str] = []
        self.pairs = np.zeros(0, np.uint64)

    def of(self, found: list[bytes]) -> np.ndarray:
        if self.numbers.full:
            self.clear()
        numbers, fresh = self.numbers.of(found)
        if fresh:
            self.learn(fresh)
        return numbers

    def learn(self, fresh: list[bytes]) -> None:
        ids_a, ends_a, n_a, right_a = self.a.tokens(fresh)
        ids_b, ends_b, n_b, right_b = self.b.tokens(fresh)
        right = right_a & right_b
        # Places in all good chunks after each other.
        size = np.where(right, [len(c) for c in fresh], 0)
        base = np.cumsum(size) - size
        keep_a, keep_b = np.repeat(right, n_a), np.repeat(right, n_b)
        n_a, n_b = np.where(right, n_a, 0), np.where(right, n_b, 0)
        ids_a, ends_a = ids_a[keep_a], ends_a[keep_a] + np.repeat(base, n_a)
        ids_b, ends_b = ids_b[keep_b], ends_b[keep_b] + np.repeat(base, n_b)
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        either = np.union1d(ends_a, ends_b)
        pairs = ids_a[np.searchsorted(ends_a, either)].astype(np.uint64) << np.uint64(32) | ids_b[np.searchsorted(ends_b, either)].astype(np.uint64)
        stop = base + size
        counted = lambda ends: np.searchsorted(ends, stop, "right") - np.searchsorted(ends, base, "right")
        self.facts = np.concatenate([self.facts, np.stack([n_a, n_b, counted(both), counted(either), ~right], 1)])
        self.pairs = np.concatenate([self.pairs, pairs])
        # a1,a2|b1;a3|b2,b3; as one list of parts, in order.
        group = np.concatenate([np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)])
        side = np.repeat([0, 1], [len(ids_a), len(ids_b)])
        order = np.lexsort((side, group))
        group, side = group[order], side[order]
        last = np.append((group[1:] != group[:-1]) | (side[1:] != side[:-1]), True) if len(group) else np.zeros(0, bool)
        marks = np.where(last, np.where(side == 0, "|", ";"), ",").tolist()
        words = np.concatenate([ids_a, ids_b])[order].tolist()
        parts = [f"{word}{mark}" for word, mark in zip(words, marks, strict=True)]
        at = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        self.written += ["".join(parts[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]


@cache
def _aligned(byte_level: str, pieces: str) -> Aligned:
    return Aligned(ByteLevel(byte_level), Pieces(pieces))


def _slice_row(part: Slice, ids: pa.Array, memo: Aligned, keep: bool) -> dict:
    """One slice: its documents' own figures, their chunks by number, the chunks' pairs, the pairs and their counts."""
    new = cuts(part.bytes)
    # A space alone at the end would be encoded as an empty text by the one that adds spaces.
    new[part.offsets[1:] - 2] = False
    local, found, at = chunks(part, new)
    # The newline at the end of documents is among the distinct chunks too, but in no document.
    used = np.unique(local)
    numbers = memo.of([found[k] for k in used.tolist()])
    place = np.zeros(len(found), np.int64)
    place[used] = np.arange(len(used))
    local = place[local]
    n = np.diff(at)
    bad = (per_doc(memo.facts[numbers, 4][local], at) > 0) | (np.diff(part.offsets) <= 2)  # the space and the newline alone
    good = np.repeat(~bad, n)
    local, n = local[good], np.where(bad, 0, n)
    at = np.concatenate([[0], np.cumsum(n)])
    figures = [per_doc(memo.facts[numbers, k][local], at) for k in range(4)]
    written, order = [memo.written[k] for k in numbers.tolist()], local.tolist()
    texts = ["".join([written[k] for k in order[x:y]])[:-1] for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
    # The order of a document's chunks no longer matters: common chunks get small numbers, and steps between sorted ones stay small.
    times = np.bincount(local, minlength=len(used))
    common = np.argsort(-times, kind="stable")
    place = np.empty(len(used), np.int64)
    place[common] = np.arange(len(used))
    numbers, times = numbers[common], times[common]
    doc = np.repeat(np.arange(part.n), n) * len(used)
    inside = np.sort(doc + place[local]) - doc
    steps = np.diff(inside, prepend=0)
    steps[at[:-1][n > 0]] = inside[at[:-1][n > 0]]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"] + ["groups"] * keep
    own = pa.StructArray.from_arrays([ids, *[pa.array(f) for f in figures], pa.array(digests), *([pa.array(texts)] if keep else [])], names)
    links = memo.facts[numbers, 3] * (times > 0)
    begin = np.cumsum(memo.facts[:, 3]) - memo.facts[:, 3]
    flat_pairs = memo.pairs[ranges(begin[numbers], links)]
    pairs, which = np.unique(flat_pairs, return_inverse=True)
    counts = np.bincount(which, np.repeat(times, links), len(pairs)).astype(np.int64)
    return {
        "docs": own,
        "n_chunks": packed(n),
        "chunks": packed(steps),
        "chunk_pairs": packed(links),
        "pair_of": packed(which),
        "pairs": pairs.astype(np.int64),
        "counts": counts,
    }


def sliced(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", groups: bool = False, slice_bytes: int = 2 << 20) -> DataFrame:
    """One row per slice of documents, with a number of its own."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.concat(F.lit(" "), F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    rows = rows.withColumn("slice", F.monotonically_increasing_id())
    fields = [rows.schema["doc_id"], *[StructField(k, LongType()) for k in ("n_a", "n_b", "n_groups", "n_links")], StructField("groups_sha256", StringType())]
    if groups:
        fields.append(StructField("groups", StringType()))
    blobs = [StructField(k, BinaryType()) for k in ("n_chunks", "chunks", "chunk_pairs", "pair_of")]
    lists = [StructField(k, ArrayType(LongType())) for k in ("pairs", "counts")]
    schema = StructType([StructField("slice", LongType()), StructField("docs", ArrayType(StructType(fields))), *blobs, *lists])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _aligned(byte_level, pieces)
        for batch in batches:
            for part in slices(batch["text"], size=slice_bytes):
                one = _slice_row(part, batch["doc_id"].slice(part.first, part.n), memo, groups)
                listed = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                arrays = [batch["slice"].slice(part.first, 1), listed(one["docs"]), *[pa.array([one[f.name]], pa.binary()) for f in blobs]]
                arrays += [listed(pa.array(one[f.name], pa.int64())) for f in lists]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(rows_of, schema)


def pair_counts(cut: DataFrame) -> DataFrame:
    """(pair, n, best): links of each pair of ids over all slices; best: no pair with its second id has more."""
    one = cut.select(F.inline(F.arrays_zip("pairs", "counts"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("n"))
    one = saved(one.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pairs")
    top = one.groupBy("b").agg(F.max("n").alias("most"))
    return saved(one.join(top, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def aligned(docs: DataFrame, byte_level: str, pieces: str, **options) -> DataFrame:
    """Per document n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and groups, if asked for)."""
    cut = saved(sliced(docs, byte_level, pieces, **options), "slices")
    asked = cut.select(F.col("slice").alias("asked"), F.explode("pairs").alias("pair")).join(pair_counts(cut), "pair")
    own = cut.schema["docs"].dataType.elementType
    schema = StructType([*own.fields, StructField("n_best", LongType()), StructField("count_sum", LongType())])

    def answered(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["pair"].to_numpy())
        n, best = right["n"].to_numpy()[order], right["best"].to_numpy()[order].astype(np.int64)
        size, steps, links, of = (unpacked(left[name][0].as_py()) for name in ("n_chunks", "chunks", "chunk_pairs", "pair_of"))
        at = np.concatenate([[0], np.cumsum(links)])
        sums, bests = per_doc(n[of], at), per_doc(best[of], at)
        at = np.concatenate([[0], np.cumsum(size)])
        total = np.concatenate([[0], np.cumsum(steps)])
        which = total[1:] - np.repeat(total[at[:-1]], size)
        found = left["docs"].combine_chunks().flatten()
        columns = [found.field(k) for k in range(len(own.fields))]
        return pa.Table.from_arrays([*columns, pa.array(per_doc(bests[which], at)), pa.array(per_doc(sums[which], at))], names=schema.names)

    return cut.drop("pairs", "counts").groupBy("slice").cogroup(asked.groupBy("asked")).applyInArrow(answered, schema)
