"""Joins between ratings, features, recommendations and candidates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.operators.clean import PAIR, relevant
from tasteloom.spread import spread_join, spread_joins


def attach(df: DataFrame, features: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Add the features of a user or product to every row; hot keys are split."""
    return spread_join(df, features, [key], how)


def hits(recs: DataFrame, test: DataFrame, threshold: float = 4.0) -> DataFrame:
    """Relevant test rows whose pair was recommended."""
    wanted = relevant(test, threshold).select(*PAIR, "rating")
    # A pair occurs once on either side, so no key is hot.
    return wanted.join(recs.select(*PAIR).distinct(), list(PAIR))


def unseen(candidates: DataFrame, ratings: DataFrame) -> DataFrame:
    """Candidate pairs that have not been rated."""
    return candidates.join(ratings.select(*PAIR).distinct(), list(PAIR), "left_anti")


def candidate_counts(ratings: DataFrame) -> DataFrame:
    """Per user, how many products are rated and how many are candidates.

    Counts the pairs of all users and all products without forming them.
    """
    products = ratings.agg(F.count_distinct("product_id").alias("n")).scalar()
    return (
        ratings.groupBy("user_id")
        .agg(F.count_distinct("product_id").alias("seen"))
        .withColumn("candidates", products - F.col("seen"))
    )


def products_not_rated(ratings: DataFrame, user) -> DataFrame:
    """All products except the user's own."""
    own = ratings.filter(F.col("user_id") == F.lit(user)).select("product_id")
    return ratings.select("product_id").distinct().subtract(own.distinct())


def candidates_of(ratings: DataFrame, user) -> DataFrame:
    """One user with every product the user has not rated."""
    kind = ratings.schema["user_id"].dataType
    return products_not_rated(ratings, user).select(F.lit(user).cast(kind).alias("user_id"), "product_id")


def with_ids(df: DataFrame, indexes: Mapping[str, DataFrame]) -> DataFrame:
    """Replace code columns by the original ids; ``indexes`` goes by code column."""
    joins = [(index, [code], "inner") for code, index in indexes.items()]
    return spread_joins(df, joins).drop(*indexes)


def of_top_entities(df: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Rows of the listed users and products; both lists are short top-N lists."""
    return df.join(F.broadcast(users.select("user_id")), "user_id", "left_semi").join(
        F.broadcast(products.select("product_id")), "product_id", "left_semi"
    )


def distinct_of(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def with_each(df: DataFrame, short: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Every row of ``df`` with every row of ``short``, a top-N list, in ``order``.

    The list travels as one array value, so there is neither a join nor a shuffle.
    """
    placed = short.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    packed = placed.agg(F.sort_array(F.collect_list(F.struct("rank", *short.columns))).alias("all"))
    return df.select(*df.columns, F.explode(packed.scalar()).alias("_each")).select(
        *df.columns, "_each.*"
    )
