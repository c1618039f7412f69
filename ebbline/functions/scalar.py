"""Column expressions shared by the operators. All stay on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; a zero or missing denominator gives 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; undefined stays NULL so that it sorts last when descending."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def word_count(text: Column) -> Column:
    """1 + spaces inside the trimmed text; NULL and blank count 0, runs of spaces count each."""
    trimmed = F.trim(text)
    spaces = F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit("")))
    return F.when(text.isNull() | (F.length(trimmed) == 0), 0).otherwise(1 + spaces)


def to_event_time(value: Column) -> Column:
    """Unparsable or missing times become NULL; the row is kept."""
    return value.try_cast("timestamp_ntz")


def floor_to_day(value: Column) -> Column:
    return F.date_trunc("day", to_event_time(value)).cast("timestamp_ntz")


def parse_vector(text: Column) -> Column:
    """Text of a number list, with or without brackets and commas, to an array of doubles."""
    tokens = F.split(F.translate(text, "[],", "   "), r"\s+")
    numbers = F.transform(F.filter(tokens, lambda t: t != ""), lambda t: t.try_cast("double"))
    return F.coalesce(numbers, F.array().cast("array<double>"))


def uniform_key(seed: int | Column, *keys: str) -> Column:
    """52 uniform bits from the row keys: stable across retries, engines and partitionings,
    and exact as a double."""
    first = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    text = F.concat_ws(":", first, *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


UNIFORM_KEY_RANGE = 1 << 52


def is_close(a: Column, b: Column) -> Column:
    """Tolerance match, relative 1e-5 plus absolute 1e-8."""
    return F.abs(a - b) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(b)
