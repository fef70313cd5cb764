"""User and product features, scaling, and the frame for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.operators.ranking import count_rank
from tasteloom.operators.relate import attach
from tasteloom.shared import settle
from tasteloom.spread import spread_joins


def user_features(df: DataFrame) -> DataFrame:
    """Per user: ratings, average, deviation (0 for one rating), distinct products."""
    return (
        df.groupBy("user_id")
        .agg(
            F.count("rating").alias("user_activity_score"),
            F.round(F.avg("rating"), 4).alias("user_avg_rating"),
            F.round(F.stddev_samp("rating"), 4).alias("user_rating_stddev"),
            F.count_distinct("product_id").alias("user_unique_products"),
        )
        .na.fill({"user_rating_stddev": 0.0})
    )


def product_features(df: DataFrame) -> DataFrame:
    """Per product: ratings, average, deviation (0 for one rating), minimum, maximum."""
    return (
        df.groupBy("product_id")
        .agg(
            F.count("rating").alias("product_popularity"),
            F.round(F.avg("rating"), 4).alias("product_avg_rating"),
            F.round(F.stddev_samp("rating"), 4).alias("product_rating_stddev"),
            F.min("rating").alias("product_min_rating"),
            F.max("rating").alias("product_max_rating"),
        )
        .na.fill({"product_rating_stddev": 0.0})
    )


def _zscore(df: DataFrame, column: str, floor: float | None, weight: str | None) -> Column:
    """(x - mean) / deviation; the statistics are one-row subqueries, never collected."""
    x = F.col(column).cast("double")
    if weight is None:
        stats = df.agg(F.avg(x).alias("m"), F.stddev_samp(x).alias("s"))
        mean, deviation = stats.select("m").scalar(), stats.select("s").scalar()
    else:
        w = F.col(weight).cast("double")
        mean = df.agg((F.sum(w * x) / F.sum(w)).alias("m")).scalar()
        squares = df.withColumn("_m", mean).agg(
            F.sqrt(F.try_divide(F.sum(w * (x - F.col("_m")) ** 2), F.sum(w) - 1)).alias("s")
        )
        deviation = squares.scalar()
    if floor is None:
        return F.try_divide(x - mean, deviation)
    # greatest() passes over a null deviation (a single row).
    return (x - mean) / F.greatest(deviation, F.lit(float(floor)))


def _minmax(df: DataFrame, column: str, floor: float | None) -> Column:
    x = F.col(column).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    low, high = ends.select("lo").scalar(), ends.select("hi").scalar()
    width = high - low
    return F.try_divide(x - low, width if floor is None else F.greatest(width, F.lit(float(floor))))


def scaled(
    df: DataFrame,
    column: str,
    out: str,
    method: str = "zscore",
    floor: float | None = 1.0,
    weight: str | None = None,
) -> DataFrame:
    """Add ``column`` on a z-score or min-max scale.

    The divisor is at least ``floor``; ``floor=None`` gives the textbook scores.
    With ``weight`` every row counts that many times in the statistics.
    """
    if method == "zscore":
        value = _zscore(df, column, floor, weight)
    elif method == "minmax":
        value = _minmax(df, column, floor)
    else:
        raise ValueError(f"unknown method {method!r}; use 'zscore' or 'minmax'")
    return df.withColumn(out, value)


def with_frequency(users: DataFrame, weighting: str = "rows") -> DataFrame:
    """Add ``interaction_frequency`` to the user features.

    ``rows`` takes the mean and deviation over rating rows, in which a user counts
    once per rating; ``users`` counts every user once.  The first needs no join with
    the ratings: the activity is its own weight.
    """
    weights = {"rows": "user_activity_score", "users": None}
    return scaled(
        users, "user_activity_score", "interaction_frequency", weight=weights[weighting]
    )


def interaction_frequency(df: DataFrame, weighting: str = "rows") -> DataFrame:
    """Every rating row with the scaled activity of its user."""
    df = settle(df)
    users = settle(with_frequency(settle(user_features(df)), weighting))
    return attach(df, users.select("user_id", "interaction_frequency"), "user_id")


def ranked_features(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User and product features with their ranks and the interaction frequency.

    Both tables are written once: the mean, the deviation and the ranks read them again.
    """
    users = count_rank(with_frequency(settle(user_features(df))), "user_activity_score", "user_rank")
    products = count_rank(settle(product_features(df)), "product_popularity", "product_rank")
    return settle(users), settle(products)


def _attach_both(df: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    return spread_joins(df, [(users, ["user_id"], "left"), (products, ["product_id"], "left")])


def rank_features(df: DataFrame) -> DataFrame:
    """Every rating row with the ranks of its user and its product."""
    df = settle(df)
    users, products = ranked_features(df)
    return _attach_both(
        df, users.select("user_id", "user_rank"), products.select("product_id", "product_rank")
    )


TRAINING_TYPES = {"user_id": "int", "product_id": "int", "rating": "float"}


def training_frame(df: DataFrame) -> DataFrame:
    """Ids as int and rating as float, the form MLlib's ALS takes.

    Rows that cannot be cast are left out; ``clean.cast_rejects`` with these types counts them.
    """
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in TRAINING_TYPES.items()]).na.drop()


def feature_frames(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The training frame, and every rating row with all features; the feed is read once for both."""
    df = settle(df, "feed")
    return training_frame(df), enrich(df)


def enrich(df: DataFrame) -> DataFrame:
    """Every rating row with all user and product features, frequency and ranks."""
    df = settle(df)
    users, products = ranked_features(df)
    return _attach_both(df, users, products)
