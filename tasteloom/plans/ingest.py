"""Load, check and lay out a rating feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteloom.operators.profile import duplicate_rows, profile, shape
from tasteloom.operators.sketches import column_figures, column_sketches
from tasteloom.shared import RanOnce, settle
from tasteloom.sources.writers import resize


def ingest_report(df: DataFrame) -> DataFrame:
    """Rows, columns, nulls, distinct values and duplicates as (metric, column_name, value)."""

    def rows(one: DataFrame, column, metrics: list[str]) -> DataFrame:
        pairs = [
            F.struct(F.lit(m).alias("metric"), column.alias("column_name"), F.col(m).cast("double").alias("value"))
            for m in metrics
        ]
        return one.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")

    whole = F.lit("*")
    return (
        rows(shape(df), whole, ["total_rows", "total_columns"])
        .unionByName(rows(profile(df), F.col("column_name"), ["null_count", "null_pct", "distinct_count"]))
        .unionByName(rows(duplicate_rows(df), whole, ["duplicate_rows"]))
    )


def ingest(df: DataFrame, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The feed in evenly sized partitions, and its report.

    The layout is written down once, and both the report and all later work read it from there.
    """
    laid_out = settle(resize(df, partitions), "feed")
    return laid_out, ingest_report(laid_out)


def ingest_sketched(df: DataFrame, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The feed in evenly sized partitions, and its column sketches from the pass that writes it.

    The second table is ``sketches.column_sketches``: rows, nulls and a sketch of the distinct values per
    column; keep it, and merge it with those of other days.  If a task of the pass ran more than once, the
    sketches are made from the written feed instead, since Spark would have counted its rows twice.
    """
    watch = Observation()
    figures, entries = column_figures(df)
    once = RanOnce(df.sparkSession)
    with once:
        laid_out = settle(resize(df.observe(watch, *figures), partitions), "feed")
    if not once.surely:
        return laid_out, column_sketches(laid_out)
    spark = df.sparkSession
    seen = spark.createDataFrame([tuple(watch.get.values())], T.StructType([
        T.StructField(name, T.BinaryType() if isinstance(value, bytes | bytearray) else T.LongType()) for name, value in watch.get.items()
    ]))
    return laid_out, seen.select(F.inline(F.array(*entries)))
