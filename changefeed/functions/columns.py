"""Column helpers built from Spark's own functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def is_blank(value: Column) -> Column:
    """True for null, the empty string and a run of blanks."""
    return F.trim(F.coalesce(value, F.lit(""))) == ""


def variant_text(value: Column) -> Column:
    """The scalar in a variant as text, whatever its JSON type."""
    return F.try_variant_get(value, "$", "string")


def json_string(value: Column) -> Column:
    """The text of a variant that holds a JSON string, else null."""
    return F.when(F.schema_of_variant(value) == "STRING", variant_text(value))


def instant(text: Column) -> Column:
    """Text to timestamp; null instead of an error where it does not parse."""
    return F.try_to_timestamp(text)


def micros(time: Column) -> Column:
    return F.unix_micros(time)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def once(row: Column) -> Column:
    """Columns of ``row`` (a struct), computed once for all their uses.

    The optimizer pushes a filter below a projection by copying the projected
    expressions into it, so a filter on four parsed fields would parse each
    record four times over. A generator is not copied: it runs once per row,
    and later filters and projections read its output. On 1.6 million records
    this halved the time of the gate.
    """
    return F.inline(F.array(row))
