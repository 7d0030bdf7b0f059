"""Hierarchical packing: token ids of whole texts, exact places, full windows, even steps."""

from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from changefeed.llm import hierarchical
from changefeed.llm.text import slices

HARD = [
    None,
    "",
    " \n ",
    "it's İ. x’s 5's '<|endoftext|>' a<|startoftext|>b <|ENDOFTEXT|>",
    "é. é.́ ΑΣ Σ. \x1c a\x85b c ...…. 12ab٣3 K Å",
    "don't'll''s a'b'S 'RE\t\tTabs  and\r\nlines ",
    "\U0001f600.\U0001f600a 한국어. 한. 日本　語",
    "z" * 3000,
]


def path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def whole(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path())
    return [model.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_ids_equal_those_of_whole_texts():
    import pyarrow as pa

    rng = random.Random(2)
    texts = HARD + ["".join(rng.choice("aB'é.,1 <|>#İ̇\n\t") for _ in range(rng.randint(1, 80))) for _ in range(300)]
    model = hierarchical.WordIds(path())
    for _ in range(2):
        for part in slices(pa.array(texts), size=700):
            ids, size = model.of(part)
            got = [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]
            assert got == whole(texts[part.first : part.first + part.n])


def checked(rows, ids, capacity):
    """The contract for ``rows``; ids: the tokens of each document, by doc_id."""
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        own = np.array(ids[r["doc_id"]], "<u4")
        assert r["doc_tokens"] == len(own) and zlib.crc32(own[r["start"] : r["start"] + r["length"]]) == r["ids_crc32"]
        sequences[r["sequence_id"]].append(r)
        pieces[r["doc_id"]].append((r["start"], r["length"]))
    for doc, own in ids.items():
        at = 0
        for start, length in sorted(pieces[doc]):
            assert start == at and length > 0
            at += length
        assert at == len(own)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity and at & (at - 1) == 0 and {r["window"] for r in own} == {at}
        assert len({r["step"] for r in own}) == 1


def test_packed(spark):
    rng = random.Random(3)
    texts = HARD + [" ".join(rng.choice(["one", "two", "Three,", "x1"]) for _ in range(rng.choice([1, 5, 30, 90, 400]))) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = hierarchical.packed(docs, path(), capacity=128, tiers=3, ids=True).collect()
    ids = {i: own + [2] for i, own in enumerate(whole(texts))}
    checked(rows, ids, 128)
    assert all(r["ids"] == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]] for r in rows)


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", 1)] * 5 + [(None, "a b", 2), (None, None, 3)], "doc_id long, text string, window int")
    rows = hierarchical.packed(docs, path(), capacity=8, tiers=2).collect()
    assert sum(r["length"] for r in rows) == 5 * 4 + 3 + 1
    assert hierarchical.packed(docs.limit(0), path()).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20), st.integers(1, 4))
def test_plans_place_every_token_once(counts, tiers):
    plan = hierarchical.Plan(counts, 64, tiers, step_windows=2)
    length = np.repeat(np.array(list(counts), np.int64), list(counts.values()))
    rank = np.concatenate([np.arange(n) for n in counts.values()] or [np.zeros(0, np.int64)]).astype(np.int64)
    found = plan.places(length, rank)
    rows = [dict(zip(found, values, strict=True)) for values in zip(*[v.tolist() for v in found.values()], strict=True)]
    ids = {k: list(range(n)) for k, n in enumerate(length.tolist())}
    for r in rows:
        r |= {"doc_id": r["doc"], "doc_tokens": len(ids[r["doc"]])}
        r["ids_crc32"] = zlib.crc32(np.array(ids[r["doc"]][r["start"] : r["start"] + r["length"]], "<u4"))
    checked(rows, ids, 64)
    # Steps of a window size differ by one window at most.
    steps = collections.Counter((r["window"], r["step"]) for r in rows if r["offset"] == 0)
    for size, *_ in plan.windows:
        sizes = [n for (w, _), n in steps.items() if w == size]
        assert not sizes or max(sizes) - min(sizes) <= 1 or size < 64 >> (tiers - 1)


def test_a_histogram_like_a_corpus_leaves_no_padding_and_few_cuts():
    rng = np.random.default_rng(1)
    sizes, counts = np.unique(np.minimum(4096, rng.lognormal(5.5, 1.2, 50_000).astype(int) + 1), return_counts=True)
    plan = hierarchical.Plan(dict(zip(sizes.tolist(), counts.tolist(), strict=True)))
    made = sum(n for _, _, n, _, _ in plan.windows)
    assert sum(size * n for size, _, n, _, _ in plan.windows) == int((sizes * counts).sum())
    cuts = int(plan.table[plan.table[:, 3] < plan.table[:, 0], 2].sum())
    assert cuts <= made
