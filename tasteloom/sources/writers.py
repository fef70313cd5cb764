"""Sinks, partition layout, and holding a DataFrame in memory."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.shared import settle


def write_csv(df: DataFrame, path: str, header: bool = False) -> str:
    df.write.mode("overwrite").option("header", header).csv(path)
    return path


def write_csv_single(df: DataFrame, path: str, rows: int, header: bool = True) -> str:
    """One CSV file.  Only for bounded results: more than ``rows`` rows is an error."""
    kept = settle(df.limit(rows + 1), "single")
    if kept.count() > rows:
        raise ValueError(f"more than {rows} rows; write a distributed CSV instead")
    return write_csv(kept.coalesce(1), path, header)


def write_parquet(df: DataFrame, base: str, run: str | None = None) -> str:
    """Parquet, overwriting; ``run`` names the sub-folder of this run."""
    path = f"{base.rstrip('/')}/run={run}" if run else base
    df.write.mode("overwrite").parquet(path)
    return path


def write_run(df: DataFrame, base: str, run: str, column: str = "run") -> str:
    """The rows of one run below ``base``, replacing that run's folder and no other.

    Rows are staged and take the old ones' place when all of them are written, so a run
    that fails leaves what was there.
    """
    marked = df.withColumn(column, F.lit(run))
    marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(base)
    return base


def write_report(report: DataFrame, path: str) -> str:
    """A long-format report as JSON records."""
    report.write.mode("overwrite").json(path)
    return path


def write_tables(tables: Mapping[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """Several tables next to each other, one folder each."""
    paths = {name: f"{base.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        df.write.mode("overwrite").format(fmt).save(paths[name])
    return paths


def resize(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """A fixed number of partitions, or partitions of the session's advisory size.

    Without a number, Spark's rebalance hint sizes the partitions from the bytes
    that were shuffled and splits skewed ones; no size has to be guessed.
    """
    return df.repartition(partitions) if partitions else df.hint("rebalance")


@contextmanager
def held(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` in memory or on disk for the length of a ``with`` block."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def partition_stats(df: DataFrame) -> DataFrame:
    """Rows per partition."""
    return (
        df.groupBy(F.spark_partition_id().alias("partition"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def partition_summary(df: DataFrame) -> DataFrame:
    """Number of non-empty partitions, their average and largest row count."""
    return partition_stats(df).agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("rows").alias("rows"),
        F.round(F.avg("rows"), 2).alias("avg_rows"),
        F.max("rows").alias("max_rows"),
    )
