"""Train and test rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.functions.scalar import bucket, percent
from tasteloom.operators.clean import PAIR
from tasteloom.shared import settle
from tasteloom.spread import unused


def _is_train(share: float, keys: Sequence[str]) -> Column:
    return bucket(*keys) < round(share * 100)


def split(
    df: DataFrame,
    share: float = 0.8,
    how: str = "hash",
    keys: Sequence[str] = PAIR,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows.

    ``hash`` decides by the keys alone: repeatable anywhere, and all rows of a pair end
    up on the same side.  ``random`` draws every row by ``seed``; the draw depends
    on how the rows lie in partitions, so the rows are written down first.
    """
    if how == "hash":
        low = _is_train(share, keys)
        return df.filter(low), df.filter(~low)
    if how == "random":
        train, test = settle(df).randomSplit([share, 1 - share], seed=seed)
        return train, test
    raise ValueError(f"unknown split {how!r}; use 'hash' or 'random'")


def settled_split(
    df: DataFrame, share: float = 0.8, how: str = "hash", keys: Sequence[str] = PAIR, seed: int = 42
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``df`` written down once, with its train and test rows as ``split`` deals them.

    By ``hash`` the side is written too, so the many later reads need no hash of every row again.
    """
    if how != "hash":
        whole = settle(df)
        return whole, *split(whole, share, how, keys, seed)
    (side,) = unused(df.columns, "_train")
    marked = settle(df.withColumn(side, _is_train(share, keys)))
    rows = [marked, marked.filter(F.col(side)), marked.filter(~F.col(side))]
    return tuple(part.drop(side) for part in rows)


def split_sizes(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows and share of both sides."""
    marked = train.select(F.lit("train").alias("part")).unionByName(
        test.select(F.lit("test").alias("part"))
    )
    sizes = marked.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    total = sizes.agg(F.sum("rows").alias("n")).scalar()
    return sizes.withColumn("share_pct", percent(F.col("rows"), total))
