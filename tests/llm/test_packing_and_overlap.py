"""Packing, decontamination, passages, shingle groups, PII and the language model against plain versions."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changefeed.llm import decontamination, jaccard_join, language_model, packing, pii, suffix_dedup
from changefeed.llm.components import components
from changefeed.llm.elias_fano import EliasFano

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


ODD = [
    "it's İ. x’s 5's '<|endoftext|>' a<|startoftext|>b <|ENDOFTEXT|>",
    "é. é.́ ΑΣ Σ. \x1c a\x85b c ...…. 12ab٣3",
    "",
    "don't'll''s a'b'S 'RE",
    "ſs ŉ'ŉ ĳĲ. ÀÈ×÷.×a",
    "\U0001f600.\U0001f600a 한국어. 한.",
    "a-b_c--d@e.f #x# ``q''",
]


def test_tokens_equal_those_of_whole_texts():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path())
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("aB'é.,1 <|>#İ̇\n") for _ in range(rng.randint(1, 80))) for _ in range(300)]
    got = packing._pieces(pa.array(texts), path(), 4096, 1, True).to_pylist()
    for text, pieces in zip(texts, got, strict=True):
        assert pieces[0]["ids"] == whole.encode(text, add_special_tokens=False).ids + [1], text


def test_packing_places_every_piece_once(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path())
    rng = random.Random(2)
    texts = [None, "", "word " * 9000] + [" ".join(rng.choice("alpha beta gamma 42 , .".split()) for _ in range(rng.choice([3, 30, 300, 1500]))) for _ in range(150)]
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(7, texts[7], 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece int")
    out = packing.packed(docs, path()).collect()
    bins = collections.defaultdict(list)
    pieces = collections.defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    total = 0
    for i, t in enumerate(texts):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        total += len(ids) * (2 if i == 7 else 1)
        own = sorted({(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces[i]})
        want = [(k, k * 4096, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for k, c in enumerate(ids[j : j + 4096] for j in range(0, len(ids), 4096))]
        assert own == want
    assert len(pieces[7]) == 2 * len({r["piece"] for r in pieces[7]})
    assert len(bins) <= math.ceil(total / 4096) * 1.1 + 1
    assert packing.packed(docs.limit(0), path()).count() == 0


def test_two_pieces_take_the_place_of_the_smallest():
    # Greedy alone: 60 + 30, a gap of 10. Two pieces of 20 fit instead of the 30.
    kinds = packing.plan({60: 1, 30: 1, 20: 2}, 100)
    assert kinds[0] == ([60, 20, 20], 1)
    assert sorted(x for items, n in kinds for x in items * n) == [20, 20, 30, 60]


def test_plan_uses_every_piece():
    rng = random.Random(3)
    for _ in range(30):
        counts = {rng.randint(1, 64): rng.randint(1, 40) for _ in range(rng.randint(0, 30))}
        used = collections.Counter()
        for items, n in packing.plan(counts, 64):
            assert sum(items) <= 64 and n > 0
            for x in items:
                used[x] += n
        assert used == collections.Counter(counts)


def brute_overlap(docs, items, window=13):
    grams = collections.defaultdict(set)
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if w else 0):
            grams[tuple(w[j : j + n])].add(str(i))
    sizes = {len(g) for g in grams}
    out = {}
    for i, t in docs:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if own := grams.get(tuple(w[j : j + n])):
                    hit.update(range(j, j + n))
                    found |= own
        out[i] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("block", [4_000_000, 300])
def test_decontamination(spark, block):
    rng = random.Random(4)
    voc = [f"w{i}" for i in range(40)] + ["É", "x-y", "ü1"]
    items = [(i, " ".join(rng.choice(voc) for _ in range(rng.choice([1, 5, 12, 13, 14, 40])))) for i in range(30)]
    items += [(30, None), (31, ""), (32, " . "), (33, items[3][1]), (None, "a b c")]
    docs = [(0, None), (1, ""), (2, "..."), (3, "w1 " * 5000)]
    for k in range(4, 120):
        t = [rng.choice(voc) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            w = rng.choice(items[:30])[1].split()
            a = rng.randint(0, 3)
            t += w[a : len(w) - rng.randint(0, 3)]
        docs.append((k, " ".join(t).upper() if k % 2 else ", ".join(t)))
    frame = spark.createDataFrame([(i, t, "mine") for i, t in docs], "doc_id long, text string, n_hit string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r["overlap"] for r in decontamination.judged(frame, bench, block_chars=block).collect()}
    want = brute_overlap(docs, [x for x in items if x[0] is not None])
    assert {i: (g["n_words"], g["n_hit"], sorted(g["items"]), g["contaminated"]) for i, g in got.items()} == want
    none = decontamination.judged(frame, bench.limit(0)).select("overlap.n_hit", "overlap.contaminated").distinct().collect()
    assert [tuple(r) for r in none] == [(0, False)]


def brute_passages(rows, least=50):
    held, texts = collections.defaultdict(set), {}
    for i, t in rows:
        if t is None or i is None:
            continue
        texts[i] = w = WORD.findall(t)
        for j in range(len(w) - least + 1):
            held[tuple(w[j : j + least])].add(i)
    out = []
    for i, w in texts.items():
        last = None
        for j in range(len(w) - least + 1):
            if len(held[tuple(w[j : j + least])]) > 1:
                if last and j <= last[1]:
                    last[1] = j + least
                else:
                    last = [j, j + least]
                    out.append((i, last))
    return sorted((i, a, b) for i, (a, b) in out)


def test_passages(spark):
    rng = random.Random(5)
    voc = [f"w{i}" for i in range(300)]
    passages = [[rng.choice(voc) for _ in range(rng.choice([48, 49, 50, 51, 55, 70, 120]))] for _ in range(14)]
    rows = [(0, None), (1, ""), (2, "a " * 49), (3, "a " * 80), (4, "a " * 95), (None, "a " * 70), (3, "a " * 80)]
    for k in range(5, 120):
        t = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            t += [rng.choice(voc) for _ in range(rng.randint(0, 30))] + p[rng.randint(0, 6) : len(p) - rng.randint(0, 6)]
        rows.append((k, " ".join(t)))
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start long")
    got = suffix_dedup.repeats(docs).collect()
    assert sorted((r["doc_id"], r["start_word"], r["end_word"]) for r in got) == brute_passages(rows)
    assert all(r["first_doc_id"] <= r["doc_id"] for r in got)
    assert suffix_dedup.repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("ids", [(1, 2), (2, 1), (1, 2, 3), (2, 1, 3), (3, 2, 1)])
def test_passage_that_one_document_holds_twice(spark, ids):
    count = iter(range(10_000))
    a, b, c, d, e = ([f"w{next(count)}" for _ in range(100)] for _ in range(5))
    p = [f"w{next(count)}" for _ in range(60)]
    texts = [a + p + b + p + c, a + p + b + d, e + a + p + b]
    rows = [(i, " ".join(t)) for i, t in zip(ids, texts, strict=False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.repeats(docs).collect()
    assert sorted((r["doc_id"], r["start_word"], r["end_word"]) for r in got) == brute_passages(rows)
    assert {r["first_doc_id"] for r in got} == {1}


def brute_groups(rows, width=5, share=80):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]):
                parent[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top(k)] = min(least.get(top(k), i), i)
    return sorted((i, len(sets[k]), least[top(k)]) for k, (i, _) in enumerate(rows))


def test_shingle_groups(spark):
    rng = random.Random(6)
    voc = [f"w{i}" for i in range(2000)]
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "a b"), (4, "A  b"), (5, "a b c"), (6, "x" * 20_000), (7, "z " * 500), (8, "z z z z z z")]
    for _ in range(6):
        base = [rng.choice(voc) for _ in range(rng.randint(8, 160))]
        for _ in range(rng.randint(1, 20)):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 30))):
                t[rng.randrange(len(t))] = rng.choice(voc)
            rows.append((len(rows), " ".join(t)))
    base = [rng.choice(voc) for _ in range(300)]
    rows += [(len(rows) + c, " ".join(base[c * 8 : c * 8 + 110])) for c in range(15)]  # a chain of links
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n long").repartition(3)
    assert sorted(tuple(r) for r in jaccard_join.groups(docs).collect()) == brute_groups(rows)
    assert jaccard_join.groups(docs.limit(0)).count() == 0


def by_place(batches):
    """The rows of each place (first column) as batches of one row."""
    groups = collections.defaultdict(list)
    for batch in batches:
        for k in range(batch.num_rows):
            groups[batch.column(0)[k].as_py()].append(batch.slice(k, 1))
    return [groups[k] for k in sorted(groups)]


@pytest.mark.parametrize("fragments, slabs", [(1, 1), (3, 4)])
def test_overlaps_of_many_pairs_in_bounded_memory(fragments, slabs):
    """Every set is a partner of every larger one: what a task holds must not grow with the pairs."""
    rng, n = np.random.default_rng(8), 1600
    held = [np.unique(rng.integers(0, 60, 40)) for _ in range(n)]
    values = np.sort(rng.integers(0, 2**63, 60).astype(np.uint64) * np.uint64(2))
    keys = np.sort(rng.choice(2**40, n, replace=False)) - 2**39
    rows = pa.RecordBatch.from_arrays(
        [pa.array(keys), pa.array([len(h) for h in held]), pa.array([values[h].tobytes() for h in held]), pa.array([keys[:k].tobytes() for k in range(n)])],
        ["set_key", "n", "shared", "partners"],
    )
    cut = by_place(jaccard_join._with_partners(iter([rows]), fragments, slabs))
    assert len(cut) == fragments * slabs
    assert sum(len(b.column("partners")[0].as_py()) for group in cut for b in group) == fragments * 8 * (n * (n - 1) // 2)
    counted, most = [], 0
    for group in cut:
        tracemalloc.start()
        counted += jaccard_join._overlaps(iter(group), 7)
        most = max(most, tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert most < 100e6
    links = [(a, b) for group in by_place(counted) for out in jaccard_join._links(iter(group), 40) for a, b in zip(*(c.to_pylist() for c in out.columns), strict=True)]
    marks = np.zeros((n, 60), int)
    for k, h in enumerate(held):
        marks[k, h] = 1
    both, size = marks @ marks.T, marks.sum(1)
    want = np.argwhere(np.tril(100 * both >= 40 * (size[:, None] + size - both), -1))
    assert len(want) > 1000
    assert sorted(links) == sorted((keys[a], keys[b]) for a, b in want)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 9), (5, 6), (6, 5), (7, 7), (20, 19), (19, 18), (18, 17), (17, 16)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5, 20: 16, 19: 16, 18: 16, 17: 16, 16: 16}


FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if k % 2 == 0 else 2 * d - 9 * (2 * d > 9) for k, d in enumerate(int(c) for c in reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute_spans(text):
    out = [(m.start(), n, kind, m.end()) for n, kind in enumerate(FORMS) for m in re.finditer(FORMS[kind], text or "") if valid(kind, m.group())]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out))


def test_personal_data(spark):
    texts = [None, "", "a@b.c@d.e", "a@b.c_d@e.f x@y@z.com", "é1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 0000255.1.1.1", "+1 (487) 555-7209 +12 +1.1.1.1.1.1.1.1.1 ++1234567890"]
    texts += ["4111 1111 1111 1111-4111-1111-1111-1111 4111111111111111", "\U0001f600\U0001f600 a.b@c-d.e.. 1.2.3.4@5.6", "a@" + "b." * 5000 + "c", "9" * 5000, "x" * 60_000 + "@y.z", "1." * 3000]
    rng = random.Random(7)
    texts += ["".join(rng.choice("ab@.1+ -(2é9\n_%3") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(2, texts[2], "x")], "doc_id long, text string, value string")
    rows = pii.extract(docs).select("doc_id", pii.digest(F.col("base")).alias("base")).collect()
    assert len(rows) == len(texts) + 1
    assert [r["base"] for r in sorted(rows, key=lambda r: r["doc_id"]) if r["doc_id"] != 2] == [brute_spans(t) for i, t in enumerate(texts) if i != 2]
    assert pii.extract(docs.limit(0)).count() == 0


def test_patterns_find_identifiers_that_no_seed_looks_like(spark):
    texts = [f'set api_token = "{hashlib.sha1(str(i).encode()).hexdigest()}" here' for i in range(8)]
    texts += ['now api_token = "abc-12345" ok', 'api_token = "hello"', "room: 10021a", "é mail: a.b@c.de", "size = 1234567", "version: 3"]
    texts += [f"size = {k}" for k in (7, 8, 9)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in pii.extract(docs).withColumn("hidden", F.lit(None)).collect()}
    found = {(i, s["value"]) for i, r in rows.items() for s in r["more"]}
    assert found == {(i, hashlib.sha1(str(i).encode()).hexdigest()) for i in range(8)} | {(8, "abc-12345")}
    span = rows[8]["more"][0]
    assert texts[8][span["start"] : span["end"]] == "abc-12345"


def test_patterns_spread_over_shared_values(spark):
    long = "the_" * 20 + "key"
    texts = [f"token={hashlib.sha1(str(i).encode()).hexdigest()} end" for i in range(20)]
    texts += [f"{label}=AB-{i}2345 end" for i in range(4) for label in ("token", "acct", long)]
    texts += [f'{{"token": "AB-{i}2345"}}' for i in range(4)]
    texts += ["acct=ZX-99", "acct=ZX-991", f"{long}=QQ-771", 'a "token": "JS-551" b', "url=http://a.b/?q=1&token=UR-661&z=2", "x " + "a-" * 50_000 + "=", "b-" * 50_000 + " 1"]
    # A label with two seeds and values of its own does not support itself.
    texts += [f"own={hashlib.sha1(str(-i).encode()).hexdigest()} end" for i in (1, 2)] + ["own=OW-123"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: [(s["start"], s["end"]) for s in r["more"]] for r in pii.extract(docs).collect()}
    got = {texts[i][a:b] for i, spans in rows.items() for a, b in spans}
    assert {"ZX-991", "QQ-771", "JS-551", "UR-661"} <= got
    assert not {"ZX-99", "OW-123"} & got
    assert {texts[i][a:b] for i in range(20, 36) for a, b in rows[i]} == {f"AB-{i}2345" for i in range(4)}


def test_redaction(spark):
    df = spark.createDataFrame([("é a@b.cd, 1.2.3.4!",), ("none",)], "t string").withColumn("spans", pii.found(F.col("t"), "email", pii.PATTERNS["email"], F.lit(True)))
    assert [r[0] for r in df.select(pii.redacted(F.col("t"), F.col("spans"))).collect()] == ["é <email>, 1.2.3.4!", "none"]


def test_elias_fano():
    rng = np.random.default_rng(8)
    for n, universe in ((1, 10), (0, 5), (50, 60), (1000, 1 << 40), (5000, 5001), (3000, 1 << 64)):
        top = min(universe, (1 << 63) - 1)
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        sequence = EliasFano(values, universe)
        assert (sequence[np.arange(n)] == values).all()
        asked = np.concatenate([values, rng.integers(0, top, 300, dtype=np.uint64)])
        for x, i in zip(asked.tolist(), sequence.find(asked).tolist(), strict=True):
            assert values[i] == x if i >= 0 else x not in values


def test_language_model(spark):
    rng = random.Random(9)
    voc = [f"v{i}" for i in range(60)]
    rows = [(0, None), (1, ""), (2, "NEVER seen"), (3, "v1 " * 3000)]
    rows += [(k, " ".join(rng.choice(voc[: rng.randint(2, 60)]) for _ in range(rng.randint(1, 80)))) for k in range(4, 120)]
    learns = {i: i % 7 != 2 for i, _ in rows}
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, bucket string")
    got = {r["doc_id"]: r for r in language_model.score(docs, F.col("doc_id") % 7 != 2).collect()}
    one, two, tokens = collections.Counter(), collections.Counter(), {}
    for i, t in rows:
        tokens[i] = w = WORD.findall((t or "").translate(LOWER)) + [None]
        if learns[i]:
            one.update(w)
            two.update(zip([0, *w], w, strict=False))
    total, types = sum(one.values()), len(one)
    after, kinds = collections.Counter(), collections.Counter()
    for (u, _), n in two.items():
        after[u] += n
        kinds[u] += 1
    for i, w in tokens.items():
        base = [(one[x] + 1) / (total + types + 1) for x in w]
        assert got[i]["n_tokens"] == len(w) and got[i]["train_tokens"] == total
        assert got[i]["n_known"] == sum(one[x] > 0 for x in w)
        assert got[i]["base_score"] == pytest.approx(sum(map(math.log10, base)), rel=1e-9)
        full = 0.0
        for u, x, p in zip([0, *w], w, base, strict=False):
            if after[u]:
                p = max(two[u, x] - 0.75, 0) / after[u] + 0.75 * kinds[u] / after[u] * p
            full += math.log10(p)
        assert abs(got[i]["score"] - full) <= 0.016 * len(w)  # half a code each
    none = language_model.score(docs, F.lit(False)).select("train_tokens", "n_known").distinct().collect()
    assert [tuple(r) for r in none] == [(0, 0)]
    assert language_model.score(docs.limit(0), F.lit(True)).count() == 0
