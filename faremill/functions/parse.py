"""Text to typed values. Malformed cells become NULL and are counted, not raised."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from faremill.schema import TRIP_TYPES

# Fixed value: the accepted timestamp text, milliseconds optional, no zone.
TIMESTAMP_TEXT = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{3})?\z"


def timestamp(text: Column) -> Column:
    """TIMESTAMP_NTZ of ISO text. The cast alone also takes other layouts, hence the pattern;
    it needs no session time zone, unlike a formatter-based parse."""
    return F.when(text.rlike(TIMESTAMP_TEXT), text.try_cast("timestamp_ntz"))


def number(text: Column, kind: str) -> Column:
    value = text.try_cast(kind)
    if kind == "double":  # NaN and infinities are not amounts
        return F.when(F.abs(value) < F.lit(float("inf")), value)
    return value


def cell(name: str) -> Column:
    """Typed value of a raw text column, by its declared type."""
    kind, text = TRIP_TYPES[name], F.col(name)
    if kind == "string":
        return text
    return timestamp(text) if kind == "timestamp_ntz" else number(text, kind)


def is_bad(name: str) -> Column:
    """True for a non-empty cell that does not parse."""
    return F.col(name).isNotNull() & (F.trim(F.col(name)) != "") & cell(name).isNull()
