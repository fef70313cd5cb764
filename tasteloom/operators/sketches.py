"""Mergeable summaries: quantile sketches, distinct-count sketches, and bitmaps of dense codes.

Each kind is a table with one row per group, made with a map-side aggregation and small
enough to be kept.  A new day is summarised alone and merged with the stored table, so no old row is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLL_SIZE = 800  # parameter k of the quantile sketch: rank errors well below 1%
HLL_BITS = 16  # 2 ** 16 registers: a standard error of 0.4%


# ------------------------------------------------------------------ quantiles


def quantile_sketches(df: DataFrame, by: Sequence[str], column: str = "rating") -> DataFrame:
    """Per group ``by``: ``rows`` with a value, and a KLL ``sketch`` of the values."""
    value = F.col(column).cast("double")
    return df.filter(value.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double(value, KLL_SIZE).alias("sketch")
    )


def merge_quantiles(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of finer groups, or of several days, as sketches of the groups ``by``."""
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch", KLL_SIZE).alias("sketch"))


def quantiles(sketches: DataFrame, rank: float = 0.5, out: str = "median") -> DataFrame:
    """The value at ``rank`` of every sketch, its rank wrong by less than 1%."""
    estimate = F.kll_sketch_get_quantile_double("sketch", F.lit(rank))
    return sketches.filter("rows > 0").withColumn(out, estimate).drop("sketch")


# ------------------------------------------------------------------ distinct values, estimated


def column_figures(df: DataFrame) -> tuple[list[Column], list[Column]]:
    """Aggregates for all columns of ``df``, and the entries of ``column_sketches`` made of their results."""
    figures, entries = [F.count(F.lit(1)).alias("total")], []
    for i, c in enumerate(df.columns):
        hashed = F.when(F.col(c).isNotNull(), F.xxhash64(c))
        figures += [F.count_if(F.col(c).isNull()).alias(f"n{i}"), F.hll_sketch_agg(hashed, HLL_BITS).alias(f"s{i}")]
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"), F.col("total").alias("total_rows"),
                F.col(f"n{i}").alias("null_count"), F.col(f"s{i}").alias("sketch"),
            )
        )
    return figures, entries


def column_sketches(df: DataFrame) -> DataFrame:
    """Per column ``column_name, total_rows, null_count, sketch`` (HyperLogLog), in one aggregation without expanding rows."""
    figures, entries = column_figures(df)
    return df.agg(*figures).select(F.inline(F.array(*entries)))


def merge_columns(stored: DataFrame, *newer: DataFrame) -> DataFrame:
    """A stored table of ``column_sketches`` with those of newer rows."""
    every = stored
    for one in newer:
        every = every.unionByName(one)
    return every.groupBy("column_name").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("null_count").alias("null_count"), F.hll_union_agg("sketch").alias("sketch")
    )


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """``distinct_count`` in place of the sketch; null counts as one value, as in the profile."""
    null = F.when(F.col("null_count") > 0, 1).otherwise(0)
    return sketches.withColumn("distinct_count", F.hll_sketch_estimate("sketch") + null).drop("sketch")


# ------------------------------------------------------------------ distinct codes, exact


def code_bitmaps(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group ``by`` and range of 32,768 codes: a ``bitmap`` of the codes that occur.

    For whole numbers that lie close together, as dense codes do: each range in use takes 4 KB.
    """
    code = F.col(column).cast("long")
    return df.filter(code.isNotNull()).groupBy(*by, F.bitmap_bucket_number(code).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(code)).alias("bitmap")
    )


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of finer groups, or of several days, as bitmaps of the groups ``by``."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_codes(bitmaps: DataFrame, by: Sequence[str] = (), out: str = "distinct_count") -> DataFrame:
    """The exact number of different codes per group."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(out))
