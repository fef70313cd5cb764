"""Ranks, top-N per user and overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.operators.clean import PAIR, newest_first, scored_only
from tasteloom.spread import number_rows, place_rows, spread_join, unused


def numbered_latest(df: DataFrame, keys: Sequence[str] = PAIR, out: str = "rn") -> DataFrame:
    """Number the rows of every user and product, newest first."""
    return number_rows(df, keys, newest_first(df, keys), out)


def count_rank(df: DataFrame, count: str, out: str) -> DataFrame:
    """Dense rank by a row count, highest first, for a table of users or products.

    The counts add up to the number N of rating rows, so at most sqrt(2 N)
    different ones exist: 2.8 million for 4e12 rows.  That proves the bound for the
    unpartitioned window and the broadcast.
    """
    scores = df.select(count).distinct()
    ranks = scores.withColumn(out, F.dense_rank().over(Window.orderBy(F.desc(count))))
    return df.join(F.broadcast(ranks), count, "left").select(*df.columns, out)


def value_rank(df: DataFrame, score: str, out: str, descending: bool = True) -> DataFrame:
    """Dense rank by any score, for scores that may all be different.

    The different scores are placed over range partitions; a score's position is its rank, which goes
    back to the rows by a join that splits scores with very many rows.  A null score has no rank.
    """
    (position,) = unused([*df.columns, out], "_place")
    scores = df.select(score).filter(F.col(score).isNotNull()).distinct()
    placed = place_rows(scores, [F.desc(score) if descending else F.asc(score)], position)
    ranks = placed.select(score, (F.col(position) + 1).alias(out))
    return spread_join(df, ranks, [score], "left").select(*df.columns, out)


def top_k_with_ties(
    scored: DataFrame, k: int, user: str = "user_id", score: str = "prediction", out: str = "rank"
) -> DataFrame:
    """Rows with ``rank() <= k`` per user.  Ties are kept, so lists may be longer.

    Ranks are worked out on the counts per user and score, at most ``k`` of
    which matter per user, and then joined back.  A user with very many rows,
    or very many equal scores, never has to fit into one task.
    """
    known = scored_only(scored, score)
    counts = known.groupBy(user, score).agg(F.count(F.lit(1)).alias("_n"))
    by_score = Window.partitionBy(user).orderBy(F.desc(score))
    best = counts.withColumn("_row", F.row_number().over(by_score)).filter(F.col("_row") <= k)
    above = F.sum("_n").over(by_score.rowsBetween(Window.unboundedPreceding, -1))
    ranks = (
        best.withColumn(out, (F.coalesce(above, F.lit(0).cast("long")) + 1).cast("int"))
        .filter(F.col(out) <= k)
        .select(user, score, out)
    )
    return spread_join(known, ranks, [user, score])


def top_k(
    scored: DataFrame,
    k: int,
    user: str = "user_id",
    order: Sequence[Column] | None = None,
    out: str = "rank",
) -> DataFrame:
    """The first ``k`` rows per user at positions 1 to ``k``.

    Every input partition passes on at most ``k`` rows per user.
    """
    order = order or [F.desc("prediction"), F.col("product_id")]
    window = Window.partitionBy(user).orderBy(*order)
    return scored.withColumn(out, F.row_number().over(window)).filter(F.col(out) <= k)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows overall."""
    return df.orderBy(*order).limit(n)


def first_users(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` smallest user ids."""
    return df.select("user_id").distinct().orderBy("user_id").limit(n)
