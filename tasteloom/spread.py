"""Joins and row numbers that hold up when one key owns much of the data.

Spark's own skew-join handling needs both join inputs to come straight from a
shuffle.  A table aggregated on the join key does not, so a fact row joined back to
its per-key features would be sent, hot key and all, to one task.  The
functions here split such keys explicitly; keys that are not hot take the usual
path.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.shared import settle

# A key with more rows than this, and with more than one such part of all rows, is split into
# slices of about this size.
HOT_ROWS, HOT_PART = 2_000_000, 50_000


def unused(taken: Sequence[str], *names: str) -> list[str]:
    """One column name per entry of ``names`` that ``taken`` does not hold, in any case of letters."""
    held = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def _counts(df: DataFrame, keys: Sequence[str], rows: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(rows))


def _limit(counts: DataFrame, rows: str, hot_rows: int | None) -> Column:
    """Rows above which a key is hot: ``hot_rows`` if given, else it grows with the table."""
    if hot_rows:
        return F.lit(hot_rows).cast("long")
    share = F.ceil(F.sum(rows) / HOT_PART)
    return counts.agg(F.greatest(F.lit(HOT_ROWS).cast("long"), F.coalesce(share, F.lit(0).cast("long")))).scalar()


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    hot_rows: int | None = None,
    slices: str = "_slices",
    counted: DataFrame | None = None,
) -> DataFrame:
    """Keys with more rows than the limit and the number of slices for each, as column ``slices``.

    Every hot key is listed.  Without ``hot_rows`` each of them owns more than one part in
    ``HOT_PART`` of the rows, so there are fewer than 50,000 and the list can be broadcast.
    ``counted`` is ``df.groupBy(*keys).count()`` if it is at hand; it may lack null keys.
    """
    rows, limit = unused([*keys, slices], "_rows", "_limit")
    counts = _counts(df, keys, rows) if counted is None else counted.select(*keys, F.col("count").alias(rows))
    number = F.ceil(F.col(rows) / F.col(limit)).alias(slices)
    listed = counts.withColumn(limit, _limit(counts, rows, hot_rows)).filter(F.col(rows) > F.col(limit))
    return listed.select(*keys, number)


def null_slices(df: DataFrame, keys: Sequence[str], hot_rows: int | None) -> Column:
    """Slices for rows with a null key.  They match nothing; an outer join may put them anywhere."""
    (name,) = unused(keys, "_rows")
    counts = _counts(df, keys, name)
    none = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    rows = counts.agg(F.coalesce(F.sum(F.when(none, F.col(name))), F.lit(0).cast("long")).alias("n")).scalar()
    return F.greatest(F.lit(1).cast("long"), F.ceil(rows / _limit(counts, name, hot_rows)))


def spread_joins(
    fact: DataFrame,
    joins: Sequence[tuple[DataFrame, Sequence[str], str]],
    hot_rows: int | None = None,
    identity: Sequence[str] = (),
    counted: Sequence[DataFrame | None] | None = None,
) -> DataFrame:
    """Join ``fact`` to several tables, splitting the hot keys of ``fact``.

    Every join is ``(dim, keys, how)`` with ``how`` one of ``inner``, ``left``,
    ``left_semi``, ``left_anti``.  Keys are columns of ``fact`` and hot ones
    are found there, so ``fact`` is read once, plus once per join for the key columns
    alone; write an expensive ``fact`` down first (``shared.settle``).

    A row's slice comes from its keys, its input partition and the columns named by
    ``identity``, so it is the same when a task is run again, and no other column has to be read.
    Name columns if a hot key may fill whole input partitions, as after a shuffle on that key.
    A ``dim`` row of a hot key is repeated once per slice.

    ``counted`` has for every join the rows of ``fact`` per key, as ``hot_keys`` takes them, or ``None``.
    """
    one = F.lit(1).cast("long")
    columns = list(fact.columns)
    taken = [*columns, *(c for dim, _, _ in joins for c in dim.columns)]
    source, piece, slices = unused(taken, "_source", "_slice", "_slices")
    marks = dict.fromkeys([*(k for _, keys, _ in joins for k in keys), *identity])
    # The partition's number travels, not the hash: it is the same all over a partition, so it takes no room.
    out = fact.withColumn(source, F.spark_partition_id())
    mark = F.xxhash64(*marks, source)
    for (dim, keys, how), known in zip(joins, counted or [None] * len(joins), strict=True):
        keys = list(keys)
        # Only outer and anti joins keep rows with a null key.
        nulls = null_slices(fact, keys, hot_rows) if how in ("left", "left_anti") else one
        hot = F.broadcast(hot_keys(fact, keys, hot_rows, slices, known))
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        number = F.when(no_key, nulls).otherwise(F.coalesce(slices, one))
        left = out.join(hot, keys, "left").withColumn(piece, F.pmod(mark, number))
        every = F.explode(F.sequence(one - 1, F.coalesce(slices, one) - 1))
        right = dim.join(hot, keys, "left").withColumn(piece, every).drop(slices)
        joined = left.drop(slices).join(right, [*keys, piece], how)
        if how not in ("left_semi", "left_anti"):
            columns += [c for c in dim.columns if c not in keys]
        out = joined.select(*columns, source)
    return out.drop(source)


def spread_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot_rows: int | None = None,
    identity: Sequence[str] = (),
) -> DataFrame:
    """``spread_joins`` with a single table."""
    return spread_joins(fact, [(dim, keys, how)], hot_rows, identity)


def _placed(df: DataFrame, order: Sequence[Column], part: str, pos: str) -> DataFrame:
    """Rows sorted over range partitions, with the columns ``part`` and ``pos``.

    The input partition is the last sort key, so that identical copies can be
    spread over several ranges as well.  Adaptive execution may merge neighbouring
    ranges of little data; the order over all partitions stays.
    """
    src, at = unused([*df.columns, part, pos], "_src", "_at")
    source = df.withColumn(src, F.spark_partition_id())
    order = [*order, F.col(src)]
    placed = settle(
        source.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop(src)
        .withColumn(at, F.monotonically_increasing_id())
    )
    return (
        placed.withColumn(part, F.shiftright(at, 33))
        .withColumn(pos, F.col(at).bitwiseAND(F.lit((1 << 33) - 1)))
        .drop(at)
    )


def _offsets(placed: DataFrame, amount: Column, part: str, before: str) -> DataFrame:
    """Per range partition, the amount in the partitions before it.

    One row per partition, so the unpartitioned window and the broadcast are small.
    """
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    (name,) = unused([part, before], "_amount")
    totals = placed.groupBy(part).agg(amount.alias(name))
    return totals.select(part, F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(before))


def place_rows(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Global position (0, 1, 2, ...) of every row in ``order``, without one big task."""
    part, pos, before = unused([*df.columns, out], "_part", "_pos", "_before")
    placed = _placed(df, order, part, pos)
    offsets = _offsets(placed, F.count(F.lit(1)), part, before)
    return (
        placed.join(F.broadcast(offsets), part)
        .withColumn(out, F.col(before) + F.col(pos))
        .select(*df.columns, out)
    )


def running_total(df: DataFrame, order: Sequence[Column], amount: str, out: str) -> DataFrame:
    """Global running sum of ``amount`` in ``order``, without one big task."""
    part, pos, before, total = unused([*df.columns, out], "_part", "_pos", "_before", "_inside")
    placed = _placed(df, order, part, pos)
    offsets = _offsets(placed, F.sum(amount), part, before)
    inside = Window.partitionBy(part).orderBy(pos)
    return (
        placed.withColumn(total, F.sum(amount).over(inside))
        .join(F.broadcast(offsets), part)
        .withColumn(out, F.col(before) + F.col(total))
        .select(*df.columns, out)
    )


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    out: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """``row_number`` per key.  Hot keys are numbered over range partitions.

    All other keys take the plain window.
    """
    keys = list(keys)
    part, pos, piece, number, before = unused([*df.columns, out], "_part", "_pos", "_p", "_n", "_carried")
    twins = unused([*df.columns, out, part, pos, piece, number, before], *[f"_hot_{k}" for k in keys])
    hot = hot_keys(df, keys, hot_rows).select(*[F.col(k).alias(t) for k, t in zip(keys, twins, strict=True)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(t)) for k, t in zip(keys, twins, strict=True)])
    window = Window.partitionBy(*keys).orderBy(*order)
    cold = df.join(F.broadcast(hot), same, "left_anti").withColumn(
        out, F.row_number().over(window).cast("long")
    )
    placed = _placed(
        df.join(F.broadcast(hot), same, "left_semi"), [*[F.col(k) for k in keys], *order], part, pos
    )
    # A key reaches into a later partition only as that partition's first key, so
    # ``carried`` has at most one row per partition.
    earlier = (
        Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        placed.groupBy(part, *keys)
        .agg(F.count(F.lit(1)).alias(number))
        .withColumn(before, F.sum(number).over(earlier))
        .filter(F.col(before).isNotNull())
        .select(F.col(part).alias(piece), *[F.col(k).alias(t) for k, t in zip(keys, twins, strict=True)], before)
    )
    inside = Window.partitionBy(part, *keys).orderBy(pos)
    numbered = (
        placed.withColumn(number, F.row_number().over(inside))
        .join(F.broadcast(carried), (F.col(part) == F.col(piece)) & same, "left")
        .withColumn(out, F.col(number) + F.coalesce(before, F.lit(0).cast("long")))
    )
    return cold.unionByName(numbered.select(*cold.columns))
