"""Queries for joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasteloom.operators import clean, encode, features, recommend, relate, stats
from tasteloom.registry import inputs
from tasteloom.registry.book import query
from tasteloom.sources import feeds

ONE_USER = 42


@query("join_user_features", "SELECT f.*, u.* EXCLUDE (user_id) FROM orders_feed f LEFT JOIN user_features u USING (user_id)")
def join_user_features(spark, folder):
    feed = feeds.orders_feed(spark, folder)
    return relate.attach(feed, features.user_features(feed), "user_id")


@query(
    "join_product_features",
    "SELECT f.*, p.* EXCLUDE (product_id) FROM orders_feed f LEFT JOIN product_features p USING (product_id)",
)
def join_product_features(spark, folder):
    feed = feeds.orders_feed(spark, folder)
    return relate.attach(feed, features.product_features(feed), "product_id")


@query("join_hits", "SELECT user_id, product_id, rating FROM lists WHERE rating >= 4.0")
def join_hits(spark, folder):
    known, held_out = inputs.train_test(spark, folder)
    return relate.hits(inputs.lists_of(inputs.predictions_of(known, held_out)), held_out)


@query(
    "anti_join_seen",
    """SELECT u.user_id, b.product_id FROM (SELECT DISTINCT user_id FROM orders_feed) u
       CROSS JOIN best_products b
       WHERE NOT EXISTS (SELECT 1 FROM orders_feed s
                         WHERE s.user_id = u.user_id AND s.product_id = b.product_id)""",
)
def anti_join_seen(spark, folder):
    feed = feeds.orders_feed(spark, folder)
    popular = recommend.recommend_popular(feed, relate.distinct_of(feed, "user_id"))
    return relate.unseen(popular, feed).select("user_id", "product_id")


@query(
    "cross_candidates",
    """SELECT u.user_id, count(s.product_id) AS seen, count(*) - count(s.product_id) AS candidates
       FROM (SELECT DISTINCT user_id FROM orders_feed) u
       CROSS JOIN (SELECT DISTINCT product_id FROM orders_feed) p
       LEFT JOIN (SELECT DISTINCT user_id, product_id FROM orders_feed) s
            ON s.user_id = u.user_id AND s.product_id = p.product_id
       GROUP BY 1""",
)
def cross_candidates(spark, folder):
    return relate.candidate_counts(feeds.orders_feed(spark, folder))


NOT_RATED = f"""SELECT DISTINCT product_id FROM orders_feed
    EXCEPT SELECT product_id FROM orders_feed WHERE user_id = {ONE_USER}"""


@query("cross_one_user", f"SELECT cast({ONE_USER} AS bigint) AS user_id, product_id FROM ({NOT_RATED})")
def cross_one_user(spark, folder):
    return relate.candidates_of(feeds.orders_feed(spark, folder), ONE_USER)


@query("subtract_seen", NOT_RATED)
def subtract_seen(spark, folder):
    return relate.products_not_rated(feeds.orders_feed(spark, folder), ONE_USER)


@query("join_id_map", "SELECT user_id, product_id, rating FROM recs")
def join_id_map(spark, folder):
    recs = inputs.recs(spark, folder)
    indexes = {c: encode.dense_index(recs, c, out) for c, out in encode.CODES.items()}
    coded = encode.encode(recs, indexes).select("user_idx", "item_idx", "rating")
    by_code = {encode.CODES[c]: index for c, index in indexes.items()}
    return relate.with_ids(coded, by_code).select("user_id", "product_id", "rating")


@query(
    "semi_top_entities",
    """SELECT user_id, product_id, rating, ts FROM orders_feed
       WHERE user_id IN (SELECT user_id FROM orders_feed GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 50)
         AND product_id IN (SELECT product_id FROM orders_feed GROUP BY 1
                            ORDER BY count(*) DESC, 1 LIMIT 50)""",
)
def semi_top_entities(spark, folder):
    feed = feeds.orders_feed(spark, folder)
    return relate.of_top_entities(
        feed, stats.most_active(feed, 50), stats.most_reviewed(feed, 50)
    ).select("user_id", "product_id", "rating", "ts")


@query("distinct_entities", "SELECT DISTINCT user_id, product_id FROM orders_feed")
def distinct_entities(spark, folder):
    return relate.distinct_of(feeds.orders_feed(spark, folder), *clean.PAIR)


@query(
    "distinct_users_products",
    """SELECT 'user' AS kind, user_id AS id FROM (SELECT DISTINCT user_id FROM orders_feed)
       UNION ALL SELECT 'product', product_id FROM (SELECT DISTINCT product_id FROM orders_feed)""",
)
def distinct_users_products(spark, folder):
    feed = feeds.orders_feed(spark, folder)
    users = relate.distinct_of(feed, "user_id").select(F.lit("user").alias("kind"), F.col("user_id").alias("id"))
    products = relate.distinct_of(feed, "product_id").select(
        F.lit("product").alias("kind"), F.col("product_id").alias("id")
    )
    return users.unionByName(products)
