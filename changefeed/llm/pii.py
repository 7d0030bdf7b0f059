"""Personal data in texts: fixed kinds by pattern, further identifiers by bootstrapping.

All of it is DataFrame and SQL functions.

Fixed kinds (email, ip, card, phone) are found with regular expressions and
checked. The bootstrapped kind is ``id``: values of labelled fields such as
``token = "..."``. Seeds are values of a fixed kind and long mixed strings of
letters and digits. A lexical pattern is a label with its sign. Patterns and
the values they introduce form a graph that is scored in rounds:

* a pattern's score is the mean score of its distinct values, so values that
  look like ordinary words or short numbers speak against it;
* a value's score is 1 for seeds, else 1 - prod(1 - score) over its patterns,
  and 0 if it has no digit or is short.

A pattern with a high score and enough distinct seeds is accepted. From then on
its identifier-like values count as seeds for the other patterns that have
them, so a round admits patterns without any seed of their own, one step further. After
the last round an accepted pattern marks all its identifier-like values, also
those no seed looks like.

A field's value is searched for further fields (``url=...?token=...``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.llm.components import saved

#: The kinds in their order and what they look like. The forms
#: never give back characters, so a long run is read once.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A label of any length, also in quotes. A long run without a sign is a match too, so that it is read once; ``_valid`` drops it.
_NAME, _LONG = r"(?<![A-Za-z0-9_])[A-Za-z_][A-Za-z0-9_.-]*+", r"(?<=[A-Za-z0-9_.-]{42})"
_SIGN = r"[\"']?\x20?[:=#]\x20?[\"']?"
FIELD = rf"{_NAME}(?:{_SIGN}[^\s\"']++|{_LONG})"
#: Fields inside a field's value, up to the next separator.
INNER = rf"{_NAME}(?:[:=#][^&;,?:=#]++={{0,2}}+(?=[&;,?]|$)|{_LONG})"
_LABEL = r"^([A-Za-z_][A-Za-z0-9_.-]*)[\"']?\x20?([:=#])"
_HEAD = rf"^[A-Za-z_][A-Za-z0-9_.-]*{_SIGN}"
_TAIL = r"[.,;:!?)\]}>|*#&$%]+$"
ID = "id"
_SPAN = "array<struct<kind: string, start: bigint, end: bigint, value: string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        number = _digits(value)
        return F.length(number).between(12, 19) & F.call_function("luhn_check", number)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "field":
        return value.rlike("[:=#]")
    return F.lit(True)


def _gate(kind: str, text: Column) -> Column:
    """A cheap test that every text with such a match passes."""
    return {
        "email": F.contains(text, F.lit("@")),
        "phone": F.contains(text, F.lit("+")),
        "field": text.rlike("[:=#]") & text.rlike("[0-9]"),
    }.get(kind, text.rlike("[0-9]"))


def found(text: Column, kind: str, pattern: str, gate: Column) -> Column:
    """All matches with their places in code points: the texts between matches give the lengths."""
    between = F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("long"))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(between, hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    none = F.array().cast(_SPAN)
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + piece["gap"]
        end = begin + F.coalesce(F.length(piece["hit"]), F.lit(0))
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), piece["hit"].alias("value"))
        keep = piece["hit"].isNotNull() & _valid(kind, piece["hit"])
        return F.struct(end.alias("at"), F.when(keep, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    return F.when(gate, F.aggregate(steps, start, step, lambda state: state["out"])).otherwise(none)


def _identifier(value: Column) -> Column:
    return value.rlike("[0-9]") & (F.length(value) >= 6)


def _seed(value: Column) -> Column:
    """A fixed kind as a whole, or 20 or more letters and digits mixed."""
    long_mix = value.rlike("^[A-Za-z0-9+/_-]{20,}={0,2}$") & value.rlike("[0-9].*[A-Za-z].*[0-9]|[A-Za-z].*[0-9].*[A-Za-z]")
    fixed = F.lit(False)
    for kind in KINDS:
        fixed = fixed | (value.rlike(f"^(?:{PATTERNS[kind]})$") & _valid(kind, value))
    return F.coalesce(long_mix | fixed, F.lit(False))


def scored_patterns(fields: DataFrame, rounds: int = 3, least_score: float = 0.6, least_seeds: int = 3) -> DataFrame:
    """(label, score, seeds) from (label, value) rows, by rounds over the graph of both.

    ``seeds`` counts the seeds and the values that another label, accepted in the round before, introduces.
    """
    edges = fields.groupBy("label", "value").agg(F.count("*").alias("n"))
    edges = saved(edges.select("label", "value", _identifier(F.col("value")).alias("like"), _seed(F.col("value")).alias("seed")), "edges")
    patterns = None
    for _ in range(rounds):
        if patterns is None:
            scores = edges.withColumn("s", F.col("seed").cast("double")).withColumn("known", F.col("seed"))
        else:
            # 1 - prod(1 - score) over the value's patterns, from sums of logarithms.
            doubt = F.sum(F.log1p(-F.least(F.col("score"), F.lit(0.999))))
            good = F.when((F.col("score") >= least_score) & (F.col("seeds") >= least_seeds), F.col("label"))
            values = edges.where("like AND NOT seed").join(patterns, "label").groupBy("value")
            values = values.agg((1 - F.exp(doubt)).alias("v"), F.min(good).alias("good"), F.max(good).alias("good_too"))
            scores = edges.join(values, "value", "left")
            # A label does not support itself: a value counts if an accepted label other than this one has it.
            other = F.coalesce((F.col("good") != F.col("label")) | (F.col("good_too") != F.col("label")), F.lit(False))
            scores = scores.withColumn("s", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("v", F.lit(0.0)))).withColumn("known", F.col("seed") | other)
        sums = scores.groupBy("label").agg(F.avg("s").alias("score"), F.sum(F.col("known").cast("long")).alias("seeds"))
        patterns = saved(sums, "patterns")
    return patterns


def extract(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 3,
    least_score: float = 0.6,
    least_seeds: int = 3,
) -> DataFrame:
    """A row per row of ``docs``: doc_id, row_key, base and more (arrays of kind, start, end, value).

    ``base`` has the fixed kinds, ``more`` the identifiers of accepted
    patterns that touch no base span; both by start, then kind. Places count
    code points, ends are exclusive. Null texts are empty. Rows with equal id
    and text have equal spans.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("text", text)
    hits = {kind: found(F.col("text"), kind, PATTERNS[kind], _gate(kind, F.col("text"))) for kind in KINDS}
    base = F.concat(*hits.values())
    order = {kind: k for k, kind in enumerate(KINDS)}

    def before(x: Column, y: Column) -> Column:
        rank = lambda c: F.coalesce(*[F.when(c["kind"] == kind, k) for kind, k in order.items()])
        by_start = (x["start"] > y["start"]).cast("int") - (x["start"] < y["start"]).cast("int")
        return F.when(by_start != 0, by_start).otherwise(rank(x) - rank(y))

    fields = found(F.col("text"), "field", FIELD, _gate("field", F.col("text")))
    key = F.xxhash64("doc_id", "text")
    table = saved(rows.select("doc_id", key.alias("row_key"), F.array_sort(base, before).alias("base"), fields.alias("fields")), "spans")
    head = F.length(F.regexp_extract("value", _HEAD, 0))
    one = table.where(F.size("fields") > 0).select("row_key", "base", F.inline("fields"))
    rest, at = F.substring(F.col("value"), head + 1, F.length("value")), F.col("start") + head
    within = F.transform(found(rest, "field", INNER, rest.rlike("[:=#]")), lambda s: F.struct((at + s["start"]).alias("start"), s["value"].alias("value")))
    one = one.select("row_key", "base", F.inline(F.concat(F.array(F.struct("start", "value")), within)))
    label = F.concat(F.lower(F.regexp_extract("value", _LABEL, 1)), F.regexp_extract("value", _LABEL, 2))
    value = F.regexp_replace(F.substring(F.col("value"), head + 1, F.length("value")), _TAIL, "")
    one = one.select("row_key", "base", label.alias("label"), value.alias("value"), (F.col("start") + head).alias("start"))
    one = saved(one.where("value != ''").distinct(), "fields")
    good = scored_patterns(one.select("label", "value"), rounds, least_score, least_seeds)
    good = good.where((F.col("score") >= least_score) & (F.col("seeds") >= least_seeds))
    end = F.col("start") + F.length("value")
    clear = ~F.exists("base", lambda b: (b["start"] < end) & (b["end"] > F.col("start")))
    new = one.where(_identifier(F.col("value"))).join(good.select("label"), "label").where(clear)
    span = F.struct(F.lit(ID).alias("kind"), F.col("start"), end.alias("end"), F.col("value"))
    more = new.groupBy("row_key").agg(F.array_sort(F.collect_set(span), lambda x, y: (x["start"] - y["start"]).cast("int")).alias("more"))
    joined = table.drop("fields").join(more, "row_key", "left")
    return joined.select("doc_id", "row_key", "base", F.coalesce("more", F.array().cast(_SPAN)).alias("more"))


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def all_spans(base: Column, more: Column) -> Column:
    """Both arrays by start; at one start base comes first."""
    return F.array_sort(
        F.concat(base, more),
        lambda x, y: F.when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
        .when(x["kind"] == y["kind"], F.lit(0))
        .otherwise(_rank(x["kind"]) - _rank(y["kind"])),
    )


def _rank(kind: Column) -> Column:
    return F.coalesce(*[F.when(kind == name, k) for k, name in enumerate((*KINDS, ID))])


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans give one mark.

    ``spans`` as ``all_spans`` orders them.
    """
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, span: Column) -> Column:
        inside = span["start"] < state["at"]
        end = F.greatest(state["at"], span["end"])
        gap = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        more = F.concat(state["out"], F.array(gap, F.concat(F.lit("<"), span["kind"], F.lit(">"))))
        return F.struct(end.alias("at"), F.when(inside, state["out"]).otherwise(more).alias("out"))

    def finish(state: Column) -> Column:
        rest = F.substring(text, (state["at"] + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(state["out"], ""), rest)

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)
