"""Samples of an exact size, by the smallest keyed hashes.

Whether a row belongs to the sample depends on its keys and the other rows' keys alone, not on partitions, so a
task that runs again takes the same rows.  The samples of two tables, taken with one
seed, merge: the sample of both together is the sample of their samples.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.spread import place_rows, unused

DIGITS = 15  # hexadecimal digits of the hash
COARSE = 4  # of those, the digits by which the limit is found


def keyed_hash(keys: Sequence[str], seed: int = 42) -> Column:
    """60 bits from the seed and the keys; null has a hash of its own."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in keys]
    return F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, DIGITS)


def bottom_k(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """The ``n`` rows of ``df`` with the smallest hashes of ``keys``; all rows, if there are fewer.

    Rows are counted by the leading digits of their hash (65,536 numbers), which shows
    below which digits all rows belong to the sample and which digits are cut.  Only the rows with the
    cut digits, about one in 65,536, are put in order, over range partitions, so rows that repeat
    are no one task either.  Ties go by the other columns.
    """
    mark, lead, upto, at = unused(df.columns, "_hash", "_lead", "_upto", "_at")
    marked = df.withColumn(mark, keyed_hash(keys, seed)).withColumn(lead, F.substring(mark, 1, COARSE))
    counts = marked.groupBy(lead).agg(F.count(F.lit(1)).alias(upto))
    running = F.sum(upto).over(Window.orderBy(lead))  # over 65,536 rows at most
    full = counts.withColumn(upto, running).filter(F.col(upto) <= n)
    last = full.agg(F.max(lead), F.max(upto)).first()
    whole = F.col(lead) <= F.lit(last[0]) if last[0] is not None else F.lit(False)
    missing = n - (last[1] or 0)
    taken = marked.filter(whole).select(*df.columns)
    if missing <= 0:
        return taken
    cut = marked.filter(~whole).join(
        F.broadcast(counts.filter(~whole).agg(F.min(lead).alias(lead))), lead, "left_semi"
    )
    others = [F.col(c) for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    ordered = place_rows(cut, [F.col(mark), *others], at)
    return taken.unionByName(ordered.filter(F.col(at) < missing).select(*df.columns))


def sample_share(df: DataFrame, fraction: float, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """floor(fraction * rows) rows by ``bottom_k``."""
    return bottom_k(df, int(df.count() * fraction), keys, seed)
