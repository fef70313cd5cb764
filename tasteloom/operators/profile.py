"""Profiling: one aggregation for all columns, then one row per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.functions.scalar import percent


def _per_column(df: DataFrame, aggregates: dict[str, Column], row) -> DataFrame:
    """Aggregate once, then one struct per column, exploded."""
    one = df.agg(F.count(F.lit(1)).alias("_total"), *[a.alias(n) for n, a in aggregates.items()])
    return one.select(F.explode(F.array(*[row(c) for c in df.columns])).alias("r")).select("r.*")


def shape(df: DataFrame) -> DataFrame:
    """Row count, column count and column names."""
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows",
        F.lit(len(df.columns)).cast("long").alias("total_columns"),
        F.lit(",".join(df.columns)).alias("column_names"),
    )


def nulls(df: DataFrame) -> DataFrame:
    """Null count and percentage of every column."""
    return _per_column(
        df,
        {f"n_{c}": F.count_if(F.col(c).isNull()) for c in df.columns},
        lambda c: F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n_{c}").alias("null_count"),
            percent(F.col(f"n_{c}"), F.col("_total")).alias("null_pct"),
        ),
    )


def critical_nulls(df: DataFrame, above: float = 50.0) -> DataFrame:
    """Columns with more than ``above`` percent nulls."""
    return nulls(df).filter(F.col("null_pct") > above)


def _distinct(column: str, approx: bool) -> Column:
    counted = F.approx_count_distinct(column) if approx else F.count_distinct(F.col(column))
    return counted + F.max(F.col(column).isNull().cast("long"))


def distinct_values(df: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct values of every column; null counts as one value.

    Exact counts expand the rows once per column before the map-side
    aggregation; ``approx`` avoids that on wide or very large tables.
    """
    return _per_column(
        df,
        {f"d_{c}": F.coalesce(_distinct(c, approx), F.lit(0).cast("long")) for c in df.columns},
        lambda c: F.struct(F.lit(c).alias("column_name"), F.col(f"d_{c}").alias("distinct_count")),
    )


def types(df: DataFrame) -> DataFrame:
    """Type name and number of filled rows of every column."""
    names = dict(df.dtypes)
    return _per_column(
        df,
        {f"f_{c}": F.count(F.col(c)) for c in df.columns},
        lambda c: F.struct(
            F.lit(c).alias("column_name"),
            F.lit(names[c]).alias("data_type"),
            F.col(f"f_{c}").alias("filled_rows"),
        ),
    )


def profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Type, nulls and distinct values of every column from a single aggregation."""
    names = dict(df.dtypes)
    aggregates = {f"n_{c}": F.count_if(F.col(c).isNull()) for c in df.columns}
    aggregates |= {
        f"d_{c}": F.coalesce(_distinct(c, approx), F.lit(0).cast("long")) for c in df.columns
    }
    return _per_column(
        df,
        aggregates,
        lambda c: F.struct(
            F.lit(c).alias("column_name"),
            F.lit(names[c]).alias("data_type"),
            F.col("_total").alias("total_rows"),
            F.col(f"n_{c}").alias("null_count"),
            percent(F.col(f"n_{c}"), F.col("_total")).alias("null_pct"),
            F.col(f"d_{c}").alias("distinct_count"),
        ),
    )


def duplicate_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Total, distinct and surplus rows, over all columns or over ``keys``."""
    groups = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0).cast("long"))
    return groups.agg(
        total.alias("total_rows"), F.count(F.lit(1)).alias("distinct_rows")
    ).select(
        "total_rows",
        "distinct_rows",
        (F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        percent(F.col("total_rows") - F.col("distinct_rows"), F.col("total_rows")).alias(
            "duplicate_pct"
        ),
    )
