"""Queries for aggregations, windows and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasteloom.operators import features, ranking, stats
from tasteloom.plans import explore
from tasteloom.registry import inputs
from tasteloom.registry.book import query
from tasteloom.sources import feeds


def orders(spark, folder):
    return feeds.orders_feed(spark, folder)


BASIC = """SELECT u AS total_users, p AS total_products, n AS total_ratings,
       round(n / greatest(u, 1), 2) AS avg_ratings_per_user,
       round(n / greatest(p, 1), 2) AS avg_ratings_per_product,
       round((1 - n / greatest(cast(u AS double) * p, 1)) * 100, 4) AS sparsity
    FROM (SELECT count(DISTINCT user_id) AS u, count(DISTINCT product_id) AS p, count(*) AS n
          FROM orders_feed)"""
SUMMARY = """SELECT count(rating) AS count, round(avg(rating), 4) AS mean,
       round(stddev_samp(rating), 4) AS stddev, min(rating) AS min, max(rating) AS max
    FROM {feed}"""
HISTOGRAM = "SELECT rating, count(*) AS count FROM {feed} GROUP BY 1"
PER_YEAR = """SELECT cast(year(to_timestamp(ts) AT TIME ZONE 'UTC') AS int) AS year,
       count(rating) AS rating_count FROM orders_feed GROUP BY 1"""
YEARS = "SELECT min(year) AS earliest_year, max(year) AS latest_year FROM (" + PER_YEAR + ")"


@query("basic_stats", BASIC)
def basic_stats(spark, folder):
    return stats.basic_stats(orders(spark, folder))


@query("rating_summary", SUMMARY.format(feed="events_feed"))
def rating_summary(spark, folder):
    return stats.rating_summary(feeds.events_feed(spark, folder))


@query("rating_histogram", HISTOGRAM.format(feed="events_feed"))
def rating_histogram(spark, folder):
    return stats.rating_histogram(feeds.events_feed(spark, folder))


@query("median_approx")
def median_approx(spark, folder):
    return stats.median(feeds.events_feed(spark, folder), exact=False)


@query("median_exact", "SELECT quantile_disc(rating, 0.5) AS median FROM events_feed")
def median_exact(spark, folder):
    return stats.median(feeds.events_feed(spark, folder))


@query(
    "top_rated_products",
    """SELECT product_id, count(rating) AS review_count, round(avg(rating), 4) AS avg_rating
       FROM orders_feed GROUP BY 1 HAVING count(rating) >= 5
       ORDER BY avg_rating DESC, review_count DESC, product_id LIMIT 20""",
)
def top_rated_products(spark, folder):
    return stats.top_rated(orders(spark, folder))


@query(
    "most_active_users",
    """SELECT user_id, count(rating) AS rating_count, round(avg(rating), 4) AS avg_rating,
              round(stddev_samp(rating), 4) AS rating_stddev
       FROM orders_feed GROUP BY 1 ORDER BY rating_count DESC, user_id LIMIT 20""",
)
def most_active_users(spark, folder):
    return stats.most_active(orders(spark, folder))


@query(
    "most_reviewed_products",
    """SELECT product_id, count(rating) AS review_count, round(avg(rating), 4) AS avg_rating
       FROM orders_feed GROUP BY 1 ORDER BY review_count DESC, product_id LIMIT 10""",
)
def most_reviewed_products(spark, folder):
    return stats.most_reviewed(orders(spark, folder))


@query("ratings_per_year", PER_YEAR)
def ratings_per_year(spark, folder):
    return stats.by_period(orders(spark, folder), "year")


@query("year_range", YEARS)
def year_range(spark, folder):
    return stats.year_range(orders(spark, folder))


@query(
    "ratings_per_month",
    """SELECT cast(year(to_timestamp(ts) AT TIME ZONE 'UTC') AS int) AS year,
              cast(month(to_timestamp(ts) AT TIME ZONE 'UTC') AS int) AS month,
              count(rating) AS rating_count FROM orders_feed GROUP BY 1, 2""",
)
def ratings_per_month(spark, folder):
    return stats.by_period(orders(spark, folder), "month")


@query(
    "product_popularity",
    """SELECT product_id, count(rating) AS popularity_score, round(avg(rating), 4) AS avg_rating,
              round(stddev_samp(rating), 4) AS rating_stddev,
              min(rating) AS min_rating, max(rating) AS max_rating
       FROM orders_feed GROUP BY 1""",
)
def product_popularity(spark, folder):
    return stats.product_stats(orders(spark, folder))


@query(
    "user_activity",
    """SELECT user_id, count(rating) AS activity_score, round(avg(rating), 4) AS avg_rating,
              round(stddev_samp(rating), 4) AS rating_stddev,
              count(DISTINCT product_id) AS unique_products
       FROM orders_feed GROUP BY 1""",
)
def user_activity(spark, folder):
    return stats.user_stats(orders(spark, folder))


@query("user_features", "SELECT * FROM user_features")
def user_features(spark, folder):
    return features.user_features(orders(spark, folder))


@query("product_features", "SELECT * FROM product_features")
def product_features(spark, folder):
    return features.product_features(orders(spark, folder))


@query(
    "popularity_score",
    """SELECT product_id, avg(rating) AS avg_rating, count(rating) AS num_ratings,
              round(avg(rating) * ln(count(rating) + 1), 9) AS score FROM orders_feed GROUP BY 1""",
)
def popularity_score(spark, folder):
    return stats.popularity_score(orders(spark, folder)).withColumn("score", F.round("score", 9))


def _long(section, source, columns):
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{c}' AS metric, cast({c} AS double) AS value FROM ({source})"
        for c in columns
    )


@query(
    "eda_bundle",
    " UNION ALL ".join(
        [
            _long("basic", BASIC, ["total_users", "total_products", "total_ratings",
                                   "avg_ratings_per_user", "avg_ratings_per_product", "sparsity"]),
            _long("rating", SUMMARY.format(feed="orders_feed"), ["count", "mean", "stddev", "min", "max"]),
            _long("rating", "SELECT quantile_disc(rating, 0.5) AS median FROM orders_feed", ["median"]),
            "SELECT 'rating_value', cast(rating AS varchar), cast(count(*) AS double) FROM orders_feed GROUP BY rating",
            f"SELECT 'year', cast(year AS varchar), cast(rating_count AS double) FROM ({PER_YEAR})",
            _long("time", YEARS, ["earliest_year", "latest_year"]),
            """SELECT 'month', strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y-%m'), cast(count(*) AS double)
               FROM orders_feed GROUP BY 2""",
            """SELECT 'most_reviewed', cast(product_id AS varchar), n FROM (
               SELECT product_id, cast(count(rating) AS double) AS n FROM orders_feed GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)""",
        ]
    ),
)
def eda_bundle(spark, folder):
    return explore.explore_report(orders(spark, folder))


@query(
    "rownum_latest",
    """SELECT event_id, user_id, product_id, rating, ts,
              row_number() OVER (PARTITION BY user_id, product_id
                                 ORDER BY ts DESC, rating DESC, event_id) AS rn FROM events_feed""",
)
def rownum_latest(spark, folder):
    return ranking.numbered_latest(feeds.events_feed(spark, folder))


@query("user_rank", "SELECT user_id, user_activity_score, user_rank FROM ranked_users")
def user_rank(spark, folder):
    users = features.user_features(orders(spark, folder)).select("user_id", "user_activity_score")
    return ranking.count_rank(users, "user_activity_score", "user_rank")


@query("product_rank", "SELECT product_id, product_popularity, product_rank FROM ranked_products")
def product_rank(spark, folder):
    products = features.product_features(orders(spark, folder)).select("product_id", "product_popularity")
    return ranking.count_rank(products, "product_popularity", "product_rank")


@query("topk_rank_per_user", "SELECT user_id, product_id, rating, prediction, rank FROM lists")
def topk_rank_per_user(spark, folder):
    return inputs.lists(spark, folder)


@query(
    "topk_rownum_per_user",
    """SELECT user_id, product_id, rating, prediction, cast(rn AS int) AS rank
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                    ORDER BY prediction DESC, product_id) AS rn FROM predictions) WHERE rn <= 5""",
)
def topk_rownum_per_user(spark, folder):
    return ranking.top_k(inputs.predictions(spark, folder), 5)


@query(
    "global_topn",
    """SELECT user_id, product_id, rating, prediction FROM predictions
       ORDER BY prediction DESC, user_id, product_id LIMIT 50""",
)
def global_topn(spark, folder):
    order = [F.desc("prediction"), F.col("user_id"), F.col("product_id")]
    return ranking.top_n(inputs.predictions(spark, folder), order, 50)


@query("limit_users", "SELECT DISTINCT user_id FROM orders_feed ORDER BY user_id LIMIT 100")
def limit_users(spark, folder):
    return ranking.first_users(orders(spark, folder), 100)
