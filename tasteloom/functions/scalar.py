"""Column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_bits(text: Column) -> Column:
    """The first 32 bits of the md5 of ``text`` as a non-negative long."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def bucket(*columns: str, buckets: int = 100) -> Column:
    """A stable bucket in ``0 .. buckets - 1`` from the columns' text form."""
    parts = [F.col(c).cast("string") for c in columns]
    return F.pmod(text_bits(F.concat_ws(":", *parts)), F.lit(buckets).cast("long"))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; null when ``whole`` is zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, places)


def steady_round(value: Column, places: int) -> Column:
    """Round by decimal digits, so that the order of a sum cannot tip a tie."""
    return F.round(value.cast("decimal(18,9)"), places).cast("double")


def at_least_one(value: Column) -> Column:
    return F.greatest(value.cast("double"), F.lit(1.0))


def is_number(value: Column) -> Column:
    """Neither null nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def any_null(*columns: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns], F.lit(False))


def utc_day(epoch_seconds: Column) -> Column:
    """The day in UTC, whatever the session's time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(epoch_seconds / 86400).cast("int"))


def year_of(epoch_seconds: Column) -> Column:
    return F.year(utc_day(epoch_seconds))


def dot(left: Column, right: Column) -> Column:
    """Inner product of two float arrays, added up as doubles."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
