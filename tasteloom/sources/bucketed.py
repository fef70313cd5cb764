"""Facts that are joined on the same id again and again, laid out once.

The table is bucketed and sorted by the id and a slice.  The slice is 0 but for ids that own
very many rows: those are cut into slices, so no bucket holds one id's rows alone.  Joins on the id
then read buckets as they lie: the fact is not shuffled, however many joins follow; the first
one sorts each bucket within its task, the others find it sorted.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.shared import drop_tables, new_table, settle
from tasteloom.spread import hot_keys, null_slices, unused


class Bucketed:
    """A fact table laid out by ``key``; ``rows`` are its rows with the slice."""

    def __init__(self, fact: DataFrame, key: str, buckets: int, hot_rows: int | None = None):
        self.key, self.buckets = key, buckets
        self.slice, self._slices = unused(fact.columns, "slice", "slices")
        spark = fact.sparkSession
        self._columns = fact.columns
        self.hot = settle(hot_keys(fact, [key], hot_rows, self._slices), "hot")
        one = F.lit(1).cast("long")
        # Null ids match nothing, so any slice will do for them.
        number = F.when(F.col(key).isNull(), null_slices(fact, [key], hot_rows)).otherwise(F.coalesce(self._slices, one))
        mark = F.xxhash64(key, F.spark_partition_id(), *[c for c, kind in fact.dtypes if not kind.startswith("map")])
        cut = fact.join(F.broadcast(self.hot), key, "left").withColumn(self.slice, F.pmod(mark, number)).drop(self._slices)
        self.table = new_table()
        laid = cut.repartition(buckets, key, self.slice)
        laid.write.bucketBy(buckets, key, self.slice).sortBy(key, self.slice).format("parquet").saveAsTable(self.table)
        self.rows = spark.table(self.table)

    def join(self, dims: Sequence[DataFrame], how: str = "left") -> DataFrame:
        """The fact with one table after the other, each with at most one row per id; only these are shuffled."""
        one = F.lit(1).cast("long")
        out, columns = self.rows, list(self._columns)
        for dim in dims:
            every = F.explode(F.sequence(one - 1, F.coalesce(self._slices, one) - 1))
            wide = dim.join(F.broadcast(self.hot), self.key, "left").withColumn(self.slice, every).drop(self._slices)
            out = out.join(wide, [self.key, self.slice], how)
            columns += [c for c in dim.columns if c != self.key]
        return out.select(*columns)

    def drop(self) -> None:
        """Remove the table."""
        drop_tables(self.rows.sparkSession, [self.table])


@contextlib.contextmanager
def bucketed(fact: DataFrame, key: str, buckets: int, hot_rows: int | None = None) -> Iterator[Bucketed]:
    """``fact`` laid out by ``key`` for the length of a ``with`` block."""
    laid = Bucketed(fact, key, buckets, hot_rows)
    try:
        yield laid
    finally:
        laid.drop()
