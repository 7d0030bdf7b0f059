"""Aligned tokens against the definitions, worked out on whole texts."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from changefeed.llm import alignment

HARD = [
    None,
    "",
    " ",
    "a",
    "it's  a   test .\n\n  x\t y ",
    "日本語 テキスト、 한국어　　x   y  z",
    "😀😀 \U0001f9d1‍\U0001f680 é é ß ﬁ Ａ",
    "<|endoftext|> <s> </s> <unk> <0x0A> <0xE2>",
    "a▁b ▁ c",
    "\x00\x01 \x7f \r\n\r\n ﻿ x",
    "x" * 5000 + " " * 300 + "y" * 3000,
    "12345 3.14159 a_b-c--d@e.fr http://x.y/?z=1&q=2",
    "cœur été ñandú Größe Ελλάδα Россия",
]


def paths():
    found = pytest.importorskip("public_tokenizers")
    return found.path("byte_bpe_50k.json"), found.path("piece_bpe_32k.model")


def whole(text):
    """(id, end) of both on a whole text, from decoded bytes alone; None where they do not come back."""
    a, b = (kind(path) for kind, path in zip((alignment.ByteLevel, alignment.Pieces), paths(), strict=True))

    def ends(ids, decoded):
        return list(zip(ids, np.cumsum([len(decoded[i]) for i in ids]).tolist(), strict=True)), b"".join(decoded[i] for i in ids)

    def one(text):
        if not text:
            return None
        first, joined = ends(a.model.encode(" " + text, add_special_tokens=False).ids, a.decoded)
        second, again = ends(b.model.encode(text), b.decoded)
        return (first, second) if joined == again == (" " + text).encode() else None

    return one(text) if text is None or isinstance(text, str) else [one(t) for t in text]


def plain(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each text."""
    found, links, counts = whole(list(texts)), [], collections.Counter()
    for one in found:
        own = []
        if one:
            starts = [[(i, end - size) for (i, end), size in zip(side, np.diff([0, *[e for _, e in side]]), strict=True)] for side in one]
            spans = [[(i, s, e) for (i, s), (_, e) in zip(st, side, strict=True)] for st, side in zip(starts, one, strict=True)]
            j = 0
            for x, s, e in spans[0]:
                while spans[1][j][2] <= s:
                    j += 1
                k = j
                while k < len(spans[1]) and spans[1][k][1] < e:
                    own.append((x, spans[1][k][0]))
                    k += 1
        links.append(own)
        counts.update(own)
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = []
    for one, own in zip(found, links, strict=True):
        if not one:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        common = sorted({e for _, e in one[0]} & {e for _, e in one[1]})
        parts, low = [], 0
        for cut in common:
            parts.append("|".join(",".join(str(i) for i, e in side if low < e <= cut) for side in one))
            low = cut
        rows.append((len(one[0]), len(one[1]), len(common), len(own), sum(counts[p] == best[p[1]] for p in own), sum(counts[p] for p in own), ";".join(parts)))
    return rows


def got(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    rows = sorted(alignment.aligned(docs, *paths(), groups=True, **options).collect(), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in rows] == list(range(len(texts)))
    assert all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in rows)
    return [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"]) for r in rows]


def test_hard_texts(spark):
    texts = HARD + HARD[3:7]
    assert got(spark, texts) == plain(texts)


def test_random_texts_in_small_slices(spark):
    rng = random.Random(5)
    signs = ["a", "the", "é", " ", " ", "  ", "\n", "\t", "日", "😀", "'s", "12", ".", "▁", " ", "　", "<s>", "-", "tion"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    assert got(spark, texts, slice_bytes=500) == plain(texts)


def test_small_memory_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(alignment, "MEMO_CHUNKS", 3)
    memo = alignment.Aligned(alignment.ByteLevel(paths()[0]), alignment.Pieces(paths()[1]))
    for _ in range(3):
        numbers = memo.of([b" one", b" two", b" three", b" four"])
        assert memo.facts[numbers, 0].tolist() == [1, 1, 1, 1] and len(memo.written) == 4


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, slice string, groups string")
    assert alignment.aligned(docs, *paths()).collect() == []
