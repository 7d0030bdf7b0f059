"""The blocking quality gate: every record is accepted or rejected with reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from changefeed.functions import any_of, instant, is_blank, json_string, once, variant_text
from changefeed.schema import BRONZE, EVENT_DDL, REJECTS

# Patterns of the text test that ``strings="matched"`` selects.
STRING_PATTERNS = {
    "meta_id": r'"meta"\s*:\s*\{[^{}]*"id"\s*:\s*"',
    "wiki": r'"wiki"\s*:\s*"',
    "type": r'"type"\s*:\s*"',
}


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a record that must not pass for ``reason``."""

    reason: str
    broken: Column


def default_rules() -> list[Rule]:
    """The contract, over the columns of :func:`decode`.

    Fixed values: the names and the order of the reasons.
    """
    nothing_read = F.coalesce("meta_id", "wiki", "type").isNull() & F.col("event_time").isNull()
    return [
        # Only a record without a single usable field can be malformed, so the
        # text is parsed a second time for those alone.
        Rule("invalid_json", nothing_read & F.get_json_object("raw_json", "$").isNull()),
        Rule("missing_or_invalid_meta.id", is_blank(F.col("meta_id"))),
        Rule("missing_or_invalid_meta.dt", F.col("event_time").isNull()),
        Rule("missing_or_invalid_wiki", is_blank(F.col("wiki"))),
        Rule("missing_or_invalid_type", is_blank(F.col("type"))),
    ]


def decode(raw: DataFrame, strings: str = "typed") -> DataFrame:
    """Raw records to typed columns, one parse per record.

    ``strings`` says how ``meta.id``, ``wiki`` and ``type`` prove to be JSON
    strings: ``typed`` by the type of the token at that path, ``matched`` by a
    pattern on the raw text, which also accepts a matching key at another depth
    and refuses an id behind a nested object.
    """
    if strings == "typed":
        text = lambda name, token: json_string(token)
    elif strings == "matched":
        text = lambda name, token: F.when(
            F.col("raw_json").rlike(STRING_PATTERNS[name]), variant_text(token)
        )
    else:
        raise ValueError(f"strings must be 'typed' or 'matched', not {strings!r}")

    arrived = F.col("arrived_at") if "arrived_at" in raw.columns else F.lit(None).cast("timestamp")
    parsed = raw.select(
        "raw_json", arrived.alias("arrived_at"), once(F.from_json("raw_json", EVENT_DDL))
    )
    checked = F.struct(
        instant(F.col("meta.dt")).alias("event_time"),
        F.coalesce(
            instant(F.col("ingested_at")), F.col("arrived_at"), F.current_timestamp()
        ).alias("ingested_at"),
        text("wiki", F.col("wiki")).alias("wiki"),
        text("type", F.col("type")).alias("type"),
        text("meta_id", F.col("meta.id")).alias("meta_id"),
    )
    return parsed.select(
        "raw_json",
        "title",
        "user",
        F.coalesce("bot", F.lit(False)).alias("bot"),
        "server_name",
        once(checked),
    )


def judged(
    raw: DataFrame, rules: list[Rule] | None = None, strings: str = "typed"
) -> DataFrame:
    """Decoded records with ``rejected`` and ``reason``, for queries that need
    both outcomes of one parse."""
    rules = default_rules() if rules is None else rules
    reason = F.concat_ws("; ", *[F.when(rule.broken, F.lit(rule.reason)) for rule in rules])
    return decode(raw, strings).select(
        "*", any_of([rule.broken for rule in rules]).alias("rejected"), reason.alias("reason")
    )


def gate(
    raw: DataFrame, rules: list[Rule] | None = None, strings: str = "typed"
) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)`` over one plan; both work on streams too.

    The filters are on the rules themselves, so no list of reasons is put
    together for an accepted record.
    """
    records = judged(raw, rules, strings)
    accepted = records.filter(~F.col("rejected")).select(*BRONZE.column_names)
    rejected = records.filter("rejected").select(*REJECTS.column_names)
    return accepted, rejected


def envelope(rejected: DataFrame) -> DataFrame:
    """Rejects as JSON messages, one text column ``value``."""
    return rejected.select(F.to_json(F.struct("reason", "raw_json", "ingested_at")).alias("value"))
