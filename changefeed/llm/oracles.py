"""SQL of the registered corpus queries that SQL can state."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Levels of the trees below: 16^5 rows of a source, 16^3 sources.
_LEAF_LEVELS, _TOP_LEVELS = 5, 3


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII expression."""
    byte = "list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))"
    codes = f"list_transform(str_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda a, b: {byte}), 4294967295)"


def _leaf(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v})::VARCHAR || ':' || {v} END" for v in values) + ")"


def _levels(name: str, levels: int) -> str:
    """name0 (tree, rank, n, digest) to name<levels>; ``name<k>s`` adds the digests of the siblings before and after."""
    parts = []
    for k in range(levels):
        same = "PARTITION BY tree, rank // 16 ORDER BY rank ROWS BETWEEN"
        before = f"coalesce(string_agg(digest, '') OVER ({same} UNBOUNDED PRECEDING AND 1 PRECEDING), '')"
        after = f"coalesce(string_agg(digest, '') OVER ({same} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')"
        parts.append(f"{name}{k}s AS (SELECT *, {before} AS before, {after} AS after FROM {name}{k})")
        up = f"SELECT tree, rank // 16 AS rank, (n + 15) // 16 AS n, sha256(string_agg(digest, '' ORDER BY rank)) AS digest FROM {name}{k} WHERE n > 1 GROUP BY ALL"
        parts.append(f"{name}{k + 1} AS ({up} UNION ALL SELECT * FROM {name}{k} WHERE n = 1)")
    return ",\n".join(parts)


def _manifest() -> str:
    steps, joins, at, digests = [], [], "start", []
    for name, levels, tree, rank in (("leaf", _LEAF_LEVELS, "w.tree", "w.rank"), ("top", _TOP_LEVELS, "0", "w.tree")):
        for k in range(levels):
            one = f"{name[0]}{k}"
            joins.append(f"JOIN {name}{k}s {one} ON {one}.tree = {tree} AND {one}.rank = {rank} >> {4 * k}")
            steps.append((f"{one}_", f"CASE WHEN {one}.n > 1 THEN sha256({one}.before || {at} || {one}.after) ELSE {at} END"))
            digests.append(f"CASE WHEN {one}.n > 1 THEN {one}.before || {one}.after ELSE '' END")
            at = f"{one}_"
    chain = ", ".join(f"{expression} AS {name}" for name, expression in steps)
    return f"""
WITH sources AS (SELECT source AS s, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM documents)),
rows AS (
  SELECT tree, doc_id, {_leaf('text')} AS leaf,
         CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS tampered
  FROM documents JOIN sources ON source IS NOT DISTINCT FROM s),
w AS (
  SELECT *, coalesce(tampered, leaf) AS start, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
         count(*) OVER (PARTITION BY tree) AS n FROM rows),
leaf0 AS (SELECT tree, rank, n, leaf AS digest FROM w),
{_levels('leaf', _LEAF_LEVELS)},
top0 AS (SELECT 0 AS tree, tree AS rank, count(*) OVER () AS n, digest FROM leaf{_LEAF_LEVELS}),
{_levels('top', _TOP_LEVELS)}
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM (
  SELECT w.doc_id, w.leaf, (SELECT digest FROM leaf{_LEAF_LEVELS} x WHERE x.tree = w.tree) AS subroot,
         (SELECT digest FROM top{_TOP_LEVELS}) AS root, sha256({' || '.join(digests)}) AS proof_sha256, {chain}, {at} AS folded_root
  FROM w {' '.join(joins)})"""


_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(table: str, key: str, pattern: str, lower: bool = True) -> str:
    """(key, w): the words of each text."""
    text = "coalesce(text, '')"
    text = f"translate({text}, '{_UPPER}', '{_LOWER}')" if lower else text
    return f"SELECT {key}, regexp_extract_all({text}, '{pattern}') AS w FROM {table}"


def _window(words: str, begin: str, size: str) -> str:
    return f"array_to_string({words}[{begin} : {begin} + {size} - 1], ' ')"


_DECONTAMINATION = f"""
WITH d AS ({_words('documents', 'doc_id', _ALNUM)}),
items AS (SELECT item_id, w, least(13, len(w)) AS size FROM ({_words('benchmark', 'item_id', _ALNUM)}) WHERE len(w) > 0),
grams AS (
  SELECT DISTINCT item_id, size, {_window('w', 'i', 'size')} AS gram
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM items)),
places AS (
  SELECT doc_id, size, i, {_window('w', 'i', 'size')} AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM items) WHERE len(w) >= size)),
found AS (SELECT doc_id, i, size, item_id FROM places JOIN grams USING (size, gram)),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) GROUP BY doc_id),
told AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN told USING (doc_id)"""

_JACCARD = f"""
WITH RECURSIVE d AS ({_words('documents', 'doc_id', _WORD)}),
grams AS (
  SELECT DISTINCT doc_id, {_window('w', 'i', 'least(5, len(w))')} AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
near AS (SELECT a, b FROM links UNION SELECT near.a, links.b FROM near JOIN links ON near.b = links.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(least_id, d.doc_id)) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS least_id FROM near GROUP BY a) USING (doc_id)"""

_QUALITY = f"""
WITH d AS ({_words('documents', 'doc_id', _WORD, lower=False)}),
repeats AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS k FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM (
        SELECT doc_id, i, {_window('w', 'i', '5')} AS gram
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5))) WHERE times > 1)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (
    SELECT doc_id, unnest(str_split(coalesce(text, ''), chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
       length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
       coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
       len(w) < 10 OR 100 * coalesce(repeats.n, 0) > 20 * len(w) AS base_failed
FROM d JOIN documents USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)"""

_TOKENS = f"""
WITH d AS ({_words('documents', 'doc_id', _WORD)}),
tokens AS (
  SELECT doc_id, {_crc32('doc_id::VARCHAR')} % 7 = 2 AS held_out, unnest(list_append(w, '')) AS token FROM d),
counts AS (SELECT token, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY token)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, (SELECT sum(c)::BIGINT FROM counts) AS train_tokens,
       round(sum(log10((coalesce(c, 0) + 1) / ((SELECT sum(c) FROM counts) + (SELECT count(*) FROM counts) + 1)::DOUBLE)), 4) AS base_score
FROM tokens LEFT JOIN counts USING (token) GROUP BY doc_id, held_out"""

ORACLES: dict[str, str] = {
    "op7_decontamination": _DECONTAMINATION,
    "op10_jaccard_join": _JACCARD,
    "op11_manifest": _manifest(),
    "quality_counts": _QUALITY,
    "token_scores": _TOKENS,
}
