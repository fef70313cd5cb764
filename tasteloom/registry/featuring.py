"""Queries for features and normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasteloom.operators import clean, features
from tasteloom.registry.book import query
from tasteloom.sources import feeds


@query(
    "interaction_frequency",
    """SELECT f.user_id, f.product_id, f.rating, f.ts, u.interaction_frequency
       FROM orders_feed f JOIN ranked_users u USING (user_id)""",
)
def interaction_frequency(spark, folder):
    rows = features.interaction_frequency(feeds.orders_feed(spark, folder))
    return rows.withColumn("interaction_frequency", F.round("interaction_frequency", 6))


@query(
    "normalize_zscore",
    """SELECT user_id, product_id, rating, ts,
              round((rating - (SELECT avg(rating) FROM orders_feed))
                    / (SELECT greatest(stddev_samp(rating), 1.0) FROM orders_feed), 6) AS normalized_rating
       FROM orders_feed""",
)
def normalize_zscore(spark, folder):
    rows = features.scaled(feeds.orders_feed(spark, folder), "rating", "normalized_rating")
    return rows.withColumn("normalized_rating", F.round("normalized_rating", 6))


@query(
    "normalize_minmax",
    """SELECT user_id, product_id, rating, ts,
              round((rating - (SELECT min(rating) FROM orders_feed))
                    / (SELECT greatest(max(rating) - min(rating), 1.0) FROM orders_feed), 6)
              AS normalized_rating
       FROM orders_feed""",
)
def normalize_minmax(spark, folder):
    rows = features.scaled(feeds.orders_feed(spark, folder), "rating", "normalized_rating", "minmax")
    return rows.withColumn("normalized_rating", F.round("normalized_rating", 6))


@query(
    "rank_features",
    """SELECT f.user_id, f.product_id, f.rating, f.ts, u.user_rank, p.product_rank
       FROM orders_feed f JOIN ranked_users u USING (user_id) JOIN ranked_products p USING (product_id)""",
)
def rank_features(spark, folder):
    return features.rank_features(feeds.orders_feed(spark, folder))


@query(
    "als_training_frame",
    """SELECT cast(user_id AS int) AS user_id, cast(product_id AS int) AS product_id,
              cast(rating AS float) AS rating FROM orders_feed""",
)
def als_training_frame(spark, folder):
    return features.training_frame(feeds.orders_feed(spark, folder))


@query(
    "training_rejects",
    """SELECT 'user_id' AS column_name, 'int' AS type, count(*) FILTER (WHERE user_id IS NOT NULL
              AND try_cast(user_id AS int) IS NULL) AS rejected FROM dirty_feed
       UNION ALL SELECT 'product_id', 'int', count(*) FILTER (WHERE product_id IS NOT NULL
              AND try_cast(product_id AS int) IS NULL) FROM dirty_feed
       UNION ALL SELECT 'rating', 'float', count(*) FILTER (WHERE rating IS NOT NULL
              AND try_cast(rating AS float) IS NULL) FROM dirty_feed""",
)
def training_rejects(spark, folder):
    """What the training frame leaves out because it cannot be cast."""
    return clean.cast_rejects(feeds.dirty_feed(spark, folder), features.TRAINING_TYPES)


@query(
    "feature_table",
    """SELECT f.user_id, f.product_id, f.rating, f.ts, u.* EXCLUDE (user_id), p.* EXCLUDE (product_id)
       FROM orders_feed f JOIN ranked_users u USING (user_id) JOIN ranked_products p USING (product_id)""",
)
def feature_table(spark, folder):
    rows = features.enrich(feeds.orders_feed(spark, folder))
    return rows.withColumn("interaction_frequency", F.round("interaction_frequency", 6))
