"""Inputs that several queries share; ``tables.py`` defines the same ones in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.operators import clean, model, ranking, split
from tasteloom.shared import settle
from tasteloom.sources import feeds
from tasteloom.spread import spread_join

LIST_LENGTH = 3


def clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One rating per user and product, written down once for all that follows."""
    return settle(clean.dedup(feeds.orders_feed(spark, folder)))


def train_test(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of ``clean_orders``, written down once with the side of every row."""
    _, known, held_out = split.settled_split(clean.dedup(feeds.orders_feed(spark, folder)))
    return known, held_out


def baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """Product mean, or the overall mean for a product that was not trained on."""
    overall = train.agg(F.avg("rating").alias("m")).scalar()
    return spread_join(test, model.mean_predictor(train), ["product_id"], "left").withColumn(
        "prediction", F.coalesce("prediction", overall)
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return predictions_of(*train_test(spark, folder))


def predictions_of(train: DataFrame, test: DataFrame) -> DataFrame:
    """The baseline's predictions, written down because ranking reads them several times."""
    return settle(baseline(train, test).select("user_id", "product_id", "rating", "prediction"))


def partial_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions with gaps: NaN for few ratings, null for even fewer."""
    train, test = train_test(spark, folder)
    means = train.groupBy("product_id").agg(
        F.avg("rating").alias("m"), F.count("rating").alias("n")
    )
    gaps = means.select(
        "product_id",
        F.when(F.col("n") >= 25, F.col("m"))
        .when(F.col("n") >= 20, F.lit(float("nan")))
        .alias("prediction"),
    )
    return spread_join(test, gaps, ["product_id"], "left").select(
        "user_id", "product_id", "rating", "prediction"
    )


def lists(spark: SparkSession, folder: str) -> DataFrame:
    """Per user the best scored test rows, ties kept."""
    return lists_of(predictions(spark, folder))


def lists_of(scored: DataFrame) -> DataFrame:
    return settle(ranking.top_k_with_ties(scored, LIST_LENGTH))


def recs(spark: SparkSession, folder: str) -> DataFrame:
    """At most ten recommendations per user, as (user_id, product_id, rating)."""
    scored = baseline(*train_test(spark, folder))
    best = ranking.top_k(scored, 10)
    return settle(best.select("user_id", "product_id", F.round("prediction", 4).alias("rating")))


def event_recs(spark: SparkSession, folder: str) -> DataFrame:
    """Every event user's ten best products by the user's own mean rating."""
    means = feeds.events_feed(spark, folder).groupBy("user_id", "product_id").agg(
        F.round(F.avg("rating"), 4).alias("rating")
    )
    order = [F.desc("rating"), F.col("product_id")]
    return ranking.top_k(means, 10, order=order).select("user_id", "product_id", "rating")
