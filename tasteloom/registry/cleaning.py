"""Queries for projection, predicates and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasteloom.operators import clean
from tasteloom.registry import inputs
from tasteloom.registry.book import query
from tasteloom.registry.tables import hundredth
from tasteloom.sources import feeds

NO_NULLS = "user_id IS NOT NULL AND product_id IS NOT NULL AND rating IS NOT NULL AND ts IS NOT NULL"
NEWEST = "ORDER BY ts DESC NULLS LAST, rating DESC NULLS LAST"
ONE_PER_PAIR = f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, product_id {NEWEST}) AS rn
                   FROM dirty_feed WHERE {NO_NULLS}) WHERE rn = 1"""


@query("select_required", "SELECT user_id, product_id, rating, ts FROM events_feed")
def select_required(spark, folder):
    return clean.pick(feeds.events_feed(spark, folder))


@query("drop_any_null", f"SELECT * FROM dirty_feed WHERE {NO_NULLS}")
def drop_any_null(spark, folder):
    return clean.without_nulls(feeds.dirty_feed(spark, folder))


@query(
    "drop_key_null",
    """SELECT * FROM dirty_feed
       WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND rating IS NOT NULL""",
)
def drop_key_null(spark, folder):
    return clean.without_nulls(feeds.dirty_feed(spark, folder), clean.REQUIRED)


@query(
    "fill_numeric_zero",
    "SELECT user_id, product_id, coalesce(rating, 0.0) AS rating, coalesce(ts, 0) AS ts FROM dirty_feed",
)
def fill_numeric_zero(spark, folder):
    return clean.fill_numbers(feeds.dirty_feed(spark, folder))


@query(
    "fill_stddev_zero",
    """SELECT user_id, product_id, count(rating) AS ratings,
              coalesce(round(stddev_samp(rating), 4), 0.0) AS rating_stddev
       FROM events_feed GROUP BY 1, 2""",
)
def fill_stddev_zero(spark, folder):
    grouped = feeds.events_feed(spark, folder).groupBy("user_id", "product_id").agg(
        F.count("rating").alias("ratings"), F.round(F.stddev_samp("rating"), 4).alias("rating_stddev")
    )
    return clean.fill_column(grouped, "rating_stddev")


@query("filter_range", "SELECT * FROM events_feed WHERE rating BETWEEN 0.5 AND 5.0")
def filter_range(spark, folder):
    return clean.in_range(feeds.events_feed(spark, folder))


@query("filter_positive", "SELECT * FROM events_feed WHERE rating > 0")
def filter_positive(spark, folder):
    return clean.positive(feeds.events_feed(spark, folder))


LATEST_EVENT = """SELECT event_id, user_id, product_id, rating, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, product_id
              ORDER BY ts DESC, rating DESC, event_id) AS rn FROM events_feed) WHERE rn = 1"""


@query("dedup_latest", LATEST_EVENT)
def dedup_latest(spark, folder):
    return clean.dedup(feeds.events_feed(spark, folder), "latest")


@query("dedup_exact", "SELECT DISTINCT user_id, product_id, rating, ts FROM orders_feed")
def dedup_exact(spark, folder):
    return clean.dedup(feeds.orders_feed(spark, folder), "exact")


@query(
    "dedup_key_any",
    """SELECT event_id, user_id, product_id, rating, ts FROM (
       SELECT *, row_number() OVER (PARTITION BY user_id, product_id ORDER BY event_id DESC) AS rn
       FROM events_feed) WHERE rn = 1""",
)
def dedup_key_any(spark, folder):
    """Any row per pair will do; the order makes it the one with the highest event id."""
    return clean.dedup(feeds.events_feed(spark, folder), order=[F.desc("event_id")])


@query(
    "cast_types",
    """SELECT try_cast(user_id AS int) AS user_id, try_cast(product_id AS int) AS product_id,
              cast(rating AS float) AS rating, ts FROM dirty_feed
       WHERE try_cast(user_id AS int) IS NOT NULL AND try_cast(product_id AS int) IS NOT NULL
         AND rating IS NOT NULL""",
)
def cast_types(spark, folder):
    types = clean.CleanRules().types
    return clean.coerce(feeds.dirty_feed(spark, folder), types, clean.REQUIRED)


@query(
    "cast_rejects",
    """SELECT 'user_id' AS column_name, 'int' AS type, count(*) FILTER (WHERE user_id IS NOT NULL
              AND try_cast(user_id AS int) IS NULL) AS rejected FROM dirty_feed
       UNION ALL SELECT 'product_id', 'int', count(*) FILTER (WHERE product_id IS NOT NULL
              AND try_cast(product_id AS int) IS NULL) FROM dirty_feed
       UNION ALL SELECT 'rating', 'float', count(*) FILTER (WHERE rating IS NOT NULL
              AND try_cast(rating AS float) IS NULL) FROM dirty_feed""",
)
def cast_rejects(spark, folder):
    return clean.cast_rejects(feeds.dirty_feed(spark, folder), clean.CleanRules().types)


@query(
    "drop_missing_predictions",
    """SELECT user_id, product_id, rating, prediction FROM partial_predictions
       WHERE prediction IS NOT NULL AND NOT isnan(prediction)""",
)
def drop_missing_predictions(spark, folder):
    return clean.scored_only(inputs.partial_predictions(spark, folder))


@query("filter_relevant", "SELECT user_id, product_id, rating, ts FROM test WHERE rating >= 4.0")
def filter_relevant(spark, folder):
    return clean.relevant(inputs.train_test(spark, folder)[1])


@query("filter_entity", "SELECT user_id, product_id, rating, ts FROM orders_feed WHERE user_id = 42")
def filter_entity(spark, folder):
    return clean.of_entity(feeds.orders_feed(spark, folder), "user_id", 42)


@query(
    "sample_fraction",
    f"SELECT * FROM events_feed WHERE {hundredth('cast(event_id AS varchar)')} < 10",
)
def sample_fraction(spark, folder):
    return clean.sample_by_key(feeds.events_feed(spark, folder), ["event_id"], 10)


@query(
    "clean_ratings",
    f"""SELECT cast(user_id AS int) AS user_id, cast(product_id AS int) AS product_id,
               cast(rating AS float) AS rating, ts
        FROM ({ONE_PER_PAIR}) WHERE user_id <> 'U-bad' AND rating BETWEEN 0.5 AND 5.0""",
)
def clean_ratings(spark, folder):
    return clean.clean(feeds.dirty_feed(spark, folder))


AUDIT = f"""SELECT step_no, step, removed, round(removed / total * 100, 2) AS removed_pct, rows_left FROM (
          SELECT 1 AS step_no, 'null' AS step, t - a AS removed, a AS rows_left, t AS total FROM
            (SELECT count(*) AS t, count(*) FILTER (WHERE {NO_NULLS}) AS a FROM dirty_feed)
          UNION ALL
          SELECT 2, 'duplicate', a - b, b, t FROM
            (SELECT count(*) AS t, count(*) FILTER (WHERE {NO_NULLS}) AS a FROM dirty_feed),
            (SELECT count(*) AS b FROM ({ONE_PER_PAIR}))
          UNION ALL
          SELECT 3, 'type', b - c, c, t FROM (SELECT count(*) AS t FROM dirty_feed),
            (SELECT count(*) AS b, count(*) FILTER (WHERE user_id <> 'U-bad') AS c FROM ({ONE_PER_PAIR}))
          UNION ALL
          SELECT 4, 'range', c - d, d, t FROM (SELECT count(*) AS t FROM dirty_feed),
            (SELECT count(*) AS c, count(*) FILTER (WHERE rating BETWEEN 0.5 AND 5.0) AS d
             FROM ({ONE_PER_PAIR}) WHERE user_id <> 'U-bad'))"""


@query("clean_audit", AUDIT)
def clean_audit(spark, folder):
    return clean.clean_audit(feeds.dirty_feed(spark, folder))
