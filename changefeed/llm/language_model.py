"""Log probabilities of texts under a word bigram model of the whole corpus.

Counts of all words and word pairs of the training texts make a trie of
Elias-Fano levels with quantised, smoothed probabilities. The trie grows with
the corpus, so it is never in one place: shards by the hash of the context
each hold their part, and texts come to them only as the distinct n-grams of a
bucket of documents:

1. Documents fall into buckets by hash. A bucket lists its distinct words and
   pairs, sorted, with how often training texts have them: one row for each
   shard.
2. A shard adds up the lists of all buckets, builds its part of the trie, and
   answers every list with counts and one-byte codes in the list's own order.
3. A bucket meets its answers and scores its documents.

p(w | u) = max(c(u, w) - D, 0) / c(u) + D t(u) / c(u) * p(w), with
p(w) = (c(w) + 1) / (N + V + 1); t(u) counts distinct followers. The first
word follows a start mark that is no token; every text ends by an end token.
Words are told apart by 64-bit hashes, followers of one word by 40 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.llm.blobs import flat, planes, unplanes
from changefeed.llm.elias_fano import DECODED, NONE, Trie
from changefeed.llm.text import BLANKS, Words, slices

DISCOUNT = 0.75
BITS = 40
_START, _END = np.uint64(0x9D39247E33776D41), np.uint64(0x2AF7398005AAA5C7)


class Grams:
    """Tokens of some documents as places among their distinct words and pairs, both sorted."""

    def __init__(self, texts: pa.ChunkedArray, learn: np.ndarray):
        tokens, self.counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for part in slices(texts, lower=True):
            words = Words(part, BLANKS)
            own = np.full(len(words.start) + part.n, _END, np.uint64)
            own[np.arange(len(words.start)) + words.doc] = words.hashes()
            tokens.append(own)
            self.counts.append(words.counts + 1)
        token, n = np.concatenate(tokens), np.concatenate(self.counts)
        del tokens
        self.n = n
        self.at = np.concatenate([[0], np.cumsum(n)])
        weight = np.repeat(learn.astype(np.int64), n)
        self.words, token_at = np.unique(np.append(token, _START), return_inverse=True)
        self.token = token_at[:-1].astype(np.int32)
        self.word_counts = np.bincount(self.token, weight, len(self.words)).astype(np.int64)
        context = np.empty(len(token), np.int64)
        context[1:] = self.token[:-1]
        context[self.at[:-1][n > 0]] = token_at[-1]
        self.context = context.astype(np.int32)
        pair = (context.astype(np.uint64) << np.uint64(BITS)) | (token >> np.uint64(64 - BITS))
        self.pairs, pair_at = np.unique(pair, return_inverse=True)
        self.pair = pair_at.astype(np.int32)
        self.pair_counts = np.bincount(self.pair, weight, len(self.pairs)).astype(np.int64)

    def cuts(self, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each shard's words and pairs begin; shards follow the order of hashes."""
        shard = ((self.words >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        words = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
        return words, np.searchsorted(self.pairs, words.astype(np.uint64) << np.uint64(BITS))


_ASK = "shard int, bucket int, words binary, counts binary, many binary, followers binary, pair_counts binary"
_ANSWER = "bucket int, shard int, tokens bigint, types bigint, counts binary, rest binary, codes binary"


def _ask(table: pa.Table, shards: int) -> pa.Table:
    grams = Grams(table.column("text"), table.column("learn").to_numpy())
    bucket = table.column("bucket")[0].as_py()
    words, pairs = grams.cuts(shards)
    owner = (grams.pairs >> np.uint64(BITS)).astype(np.int64)
    many = np.bincount(owner, minlength=len(grams.words))
    rows: dict[str, list] = {name.split()[0]: [] for name in _ASK.split(", ")}
    for s in range(shards):
        a, b, c, d = words[s], words[s + 1], pairs[s], pairs[s + 1]
        rows["shard"].append(s)
        rows["bucket"].append(bucket)
        rows["words"].append(grams.words[a:b].tobytes())
        rows["counts"].append(planes(grams.word_counts[a:b], 8))
        rows["many"].append(planes(many[a:b], 8))
        rows["followers"].append(planes(grams.pairs[c:d], BITS // 8))
        rows["pair_counts"].append(planes(grams.pair_counts[c:d], 8))
    kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5
    return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(rows.items(), kinds, strict=True)})


def _answer(table: pa.Table) -> pa.Table:
    lists = []
    for row in table.to_pylist():
        words = np.frombuffer(row["words"], np.uint64)
        many = unplanes(row["many"], 8).astype(np.int64)
        owner = np.repeat(np.arange(len(words)), many)
        lists.append((row, words, owner, unplanes(row["followers"], BITS // 8)))
    every = np.concatenate([w for _, w, _, _ in lists])
    words, place = np.unique(every, return_inverse=True)
    counts = np.bincount(place, np.concatenate([unplanes(r["counts"], 8) for r, _, _, _ in lists]), len(words)).astype(np.int64)
    at = np.cumsum([0] + [len(w) for _, w, _, _ in lists])
    keys, sums = [], []
    for k, (row, _, owner, follower) in enumerate(lists):
        count = unplanes(row["pair_counts"], 8)
        seen = count > 0
        keys.append((place[at[k] + owner[seen]].astype(np.uint64) << np.uint64(BITS)) | follower[seen])
        sums.append(count[seen])
    pairs, same = np.unique(np.concatenate(keys), return_inverse=True)
    pair_counts = np.bincount(same, np.concatenate(sums), len(pairs)).astype(np.int64)
    del keys, sums, every, same
    context = (pairs >> np.uint64(BITS)).astype(np.int64)
    follower = pairs & np.uint64((1 << BITS) - 1)
    # The trie holds training n-grams only; a start mark has followers but no count.
    held = (counts > 0) | (np.bincount(context, minlength=len(words)) > 0)
    new = np.cumsum(held) - 1
    trie = Trie(words[held], counts[held], new[context], follower, pair_counts, BITS, DISCOUNT)
    out: dict[str, list] = {name.split()[0]: [] for name in _ANSWER.split(", ")}
    for row, own, owner, asked in lists:
        found, rest, codes = trie.look_up(own, owner, asked)
        out["bucket"].append(row["bucket"])
        out["shard"].append(row["shard"])
        out["tokens"].append(int(counts.sum()))
        out["types"].append(int((counts > 0).sum()))
        out["counts"].append(planes(found, 8))
        out["rest"].append(rest.tobytes())
        out["codes"].append(codes.tobytes())
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 3
    return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds, strict=True)})


def _score(docs: pa.Table, answers: pa.Table) -> pa.Table:
    grams = Grams(docs.column("text"), docs.column("learn").to_numpy())
    answers = answers.sort_by("shard")
    total, types = sum(answers.column("tokens").to_pylist()), sum(answers.column("types").to_pylist())
    counts = np.concatenate([unplanes(x, 8) for x in answers.column("counts").to_pylist()]).astype(np.int64)
    rest, _ = flat(answers.column("rest"), np.uint8)
    codes, _ = flat(answers.column("codes"), np.uint8)
    alone = (counts + 1) / (total + types + 1)
    p1 = alone[grams.token]
    lower = rest[grams.context]
    p = np.where(lower == NONE, p1, DECODED[codes[grams.pair]] + DECODED[lower] * p1)
    where = np.flatnonzero(grams.n > 0)

    def sums(values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(grams.n), values.dtype)
        if len(where):
            out[where] = np.add.reduceat(values, grams.at[:-1][where])
        return out

    return pa.table(
        {
            "doc_id": docs.column("doc_id"),
            "learn": docs.column("learn"),
            "n_tokens": pa.array(grams.n.astype(np.int64)),
            "n_known": pa.array(sums((counts[grams.token] > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(grams.n), total, np.int64)),
            "base_score": pa.array(sums(np.log10(p1))),
            "score": pa.array(sums(np.log10(np.minimum(p, 1.0)))),
        }
    )


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, learn, n_tokens, n_known, train_tokens, base_score, score for every row.

    ``learn`` says which rows the counts come from (null: not). Null texts are
    empty: one end token. Without training rows all counts are 0.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int"))
    asked = rows.groupBy("bucket").applyInArrow(lambda t: _ask(t, parts), _ASK)
    answers = asked.groupBy("shard").applyInArrow(_answer, _ANSWER)
    out = f"doc_id {kind}, learn boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return rows.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(_score, out)
