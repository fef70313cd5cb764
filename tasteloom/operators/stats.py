"""Exploratory statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.functions.scalar import at_least_one, utc_day, year_of
from tasteloom.spread import running_total


def basic_counts() -> list[Column]:
    return [
        F.count_distinct("user_id").alias("total_users"),
        F.count_distinct("product_id").alias("total_products"),
        F.count(F.lit(1)).alias("total_ratings"),
    ]


def basic_ratios() -> list[Column]:
    users, products, ratings = (F.col(c) for c in ("total_users", "total_products", "total_ratings"))
    cells = users.cast("double") * products.cast("double")
    return [
        F.round(ratings / at_least_one(users), 2).alias("avg_ratings_per_user"),
        F.round(ratings / at_least_one(products), 2).alias("avg_ratings_per_product"),
        F.round((1 - ratings / at_least_one(cells)) * 100, 4).alias("sparsity"),
    ]


def summary_figures(column: str = "rating") -> list[Column]:
    return [
        F.count(column).alias("count"),
        F.round(F.avg(column), 4).alias("mean"),
        F.round(F.stddev_samp(column), 4).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    ]


def year_figures() -> list[Column]:
    return [
        year_of(F.min("ts")).alias("earliest_year"),
        year_of(F.max("ts")).alias("latest_year"),
    ]


def basic_stats(df: DataFrame) -> DataFrame:
    """Users, products, ratings, ratings per user and product, and sparsity."""
    return df.agg(*basic_counts()).select("*", *basic_ratios())


def rating_summary(df: DataFrame, column: str = "rating") -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum."""
    return df.agg(*summary_figures(column))


def rating_histogram(df: DataFrame, column: str = "rating") -> DataFrame:
    """Rows per rating value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(column)


def median_of_counts(counts: DataFrame, column: str, rows: str) -> DataFrame:
    """The lower median of values that occur ``rows`` times each.

    The counts are added up in value order over range partitions; the
    median is the first value that reaches half of the rows.
    """
    totals = running_total(counts, [F.col(column)], rows, "_upto")
    half = totals.agg(F.sum(rows).alias("n")).scalar() / 2
    return totals.filter(F.col("_upto") >= half).agg(F.min(column).alias("median"))


def median(df: DataFrame, column: str = "rating", exact: bool = True) -> DataFrame:
    """The lower median, exactly or with a rank error of at most 1%."""
    known = df.filter(F.col(column).isNotNull())
    if not exact:
        return known.agg(F.percentile_approx(column, 0.5, 100).alias("median"))
    counts = known.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return median_of_counts(counts, column, "_n")


def top_rated(df: DataFrame, n: int = 20, min_count: int = 5) -> DataFrame:
    """Products by average rating, then number of reviews; few reviews do not count."""
    return (
        df.groupBy("product_id")
        .agg(F.count("rating").alias("review_count"), F.round(F.avg("rating"), 4).alias("avg_rating"))
        .filter(F.col("review_count") >= min_count)
        .orderBy(F.desc("avg_rating"), F.desc("review_count"), "product_id")
        .limit(n)
    )


def most_active(df: DataFrame, n: int = 20) -> DataFrame:
    """Users by number of ratings."""
    return (
        df.groupBy("user_id")
        .agg(
            F.count("rating").alias("rating_count"),
            F.round(F.avg("rating"), 4).alias("avg_rating"),
            F.round(F.stddev_samp("rating"), 4).alias("rating_stddev"),
        )
        .orderBy(F.desc("rating_count"), "user_id")
        .limit(n)
    )


def most_reviewed(df: DataFrame, n: int = 10) -> DataFrame:
    """Products by number of ratings."""
    return (
        df.groupBy("product_id")
        .agg(F.count("rating").alias("review_count"), F.round(F.avg("rating"), 4).alias("avg_rating"))
        .orderBy(F.desc("review_count"), "product_id")
        .limit(n)
    )


def by_period(df: DataFrame, unit: str = "year") -> DataFrame:
    """Ratings per year, or per year and month, in UTC."""
    if unit not in ("year", "month"):
        raise ValueError(f"unknown unit {unit!r}; use 'year' or 'month'")
    parts = {"year": year_of(F.col("ts"))}
    if unit == "month":
        parts["month"] = F.month(utc_day(F.col("ts")))
    return (
        df.select(*[p.alias(name) for name, p in parts.items()], "rating")
        .groupBy(*parts)
        .agg(F.count("rating").alias("rating_count"))
        .orderBy(*parts)
    )


def year_range(df: DataFrame) -> DataFrame:
    """Earliest and latest year."""
    return df.agg(*year_figures())


def product_stats(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Count, average, deviation, minimum and maximum per product, by count."""
    out = df.groupBy("product_id").agg(
        F.count("rating").alias("popularity_score"),
        F.round(F.avg("rating"), 4).alias("avg_rating"),
        F.round(F.stddev_samp("rating"), 4).alias("rating_stddev"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
    )
    return out.orderBy(F.desc("popularity_score"), "product_id") if ordered else out


def user_stats(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Count, average, deviation and distinct products per user, by count."""
    out = df.groupBy("user_id").agg(
        F.count("rating").alias("activity_score"),
        F.round(F.avg("rating"), 4).alias("avg_rating"),
        F.round(F.stddev_samp("rating"), 4).alias("rating_stddev"),
        F.count_distinct("product_id").alias("unique_products"),
    )
    return out.orderBy(F.desc("activity_score"), "user_id") if ordered else out


def popularity_score(df: DataFrame) -> DataFrame:
    """Average rating times the logarithm of one plus the number of ratings."""
    return (
        df.groupBy("product_id")
        .agg(F.avg("rating").alias("avg_rating"), F.count("rating").alias("num_ratings"))
        .withColumn("score", F.col("avg_rating") * F.ln(F.col("num_ratings") + 1))
    )
