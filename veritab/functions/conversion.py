"""Conversions whose rules differ from Spark's own casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")


def to_number(c: Column, fmt: str | None = None, precision: int = 38, scale: int = 0) -> Column:
    """DECIMAL(38,0) unless said otherwise; with a format the text is read by it first."""
    value = F.to_number(c, F.lit(fmt)) if fmt else c
    return value.cast(f"decimal({precision},{scale})")


def try_to_number(c: Column, fmt: str | None = None, precision: int = 38, scale: int = 0) -> Column:
    """As :func:`to_number`, NULL where the text is no number."""
    value = F.try_to_number(c, F.lit(fmt)) if fmt else c
    return value.try_cast(f"decimal({precision},{scale})")


def text_to_boolean(c: Column, strict: bool = True) -> Column:
    """true/t/yes/y/on/1 and their opposites, in any case; other text is an error, or NULL when not strict."""
    word = F.lower(c)
    other = F.raise_error(F.lit("text is not a boolean")).cast("boolean") if strict else F.lit(None).cast("boolean")
    return (
        F.when(c.isNull(), F.lit(None).cast("boolean"))
        .when(word.isin(*TRUE_WORDS), True)
        .when(word.isin(*FALSE_WORDS), False)
        .otherwise(other)
    )


def number_to_boolean(c: Column, strict: bool = True) -> Column:
    """Zero is false; NaN and infinity are an error, or NULL when not strict."""
    value = c.cast("double")
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    other = F.raise_error(F.lit("number is not a boolean")).cast("boolean") if strict else F.lit(None).cast("boolean")
    return F.when(value.isNull(), F.lit(None).cast("boolean")).when(bad, other).otherwise(value != 0.0)


def try_to_date(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def to_timestamp_any(c: Column, fmt: str | Column | None = None, scale: int | None = None) -> Column:
    """Timestamp from text by format (fixed or per row), or from a count of seconds / 10^scale seconds."""
    if scale is not None:
        return F.timestamp_micros((c.cast("decimal(38,0)") * 10 ** (6 - scale)).cast("long"))
    if fmt is None:
        return F.try_to_timestamp(c)
    return F.try_to_timestamp(c, F.lit(fmt) if isinstance(fmt, str) else fmt)


def to_time(c: Column) -> Column:
    """Time of day as ``HH:mm:ss`` text."""
    return F.date_format(c.cast("timestamp"), "HH:mm:ss")


def to_array(c: Column) -> Column:
    """One-element array; NULL stays NULL."""
    return F.when(c.isNotNull(), F.array(c))


def is_integer(c: Column) -> Column:
    """Is the text a whole number that fits an INT? NULL for NULL."""
    return F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(
        c.rlike("^-?[0-9]+$") & c.try_cast("int").isNotNull()
    )
