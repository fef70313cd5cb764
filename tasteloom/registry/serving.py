"""Queries for the serving tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasteloom.functions.catalog import PICTURE_PATH
from tasteloom.operators import serving
from tasteloom.registry import inputs
from tasteloom.registry.book import query
from tasteloom.registry.tables import placeholder_sql
from tasteloom.sources import feeds


def named(spark, folder):
    return serving.with_category(
        serving.with_names(inputs.recs(spark, folder), feeds.catalogue_feed(spark, folder))
    )


@query("serve_users", "SELECT DISTINCT cast(user_id AS varchar) AS user_id FROM recs")
def serve_users(spark, folder):
    return serving.users_list(inputs.recs(spark, folder))


@query(
    "serve_with_fallback",
    """SELECT r.user_id, r.product_id, r.rating, false AS is_fallback
       FROM event_recs r WHERE r.user_id IN (SELECT c_custkey FROM customer)
       UNION ALL
       SELECT c.c_custkey, b.product_id, b.rating, true
       FROM customer c CROSS JOIN (SELECT product_id, rating FROM event_recs
                                   ORDER BY rating DESC, product_id, user_id LIMIT 50) b
       WHERE c.c_custkey NOT IN (SELECT user_id FROM event_recs)""",
)
def serve_with_fallback(spark, folder):
    requested = feeds.table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return serving.lists_or_fallback(inputs.event_recs(spark, folder), requested)


@query("enrich_category", "SELECT user_id, product_id, rating, product_name, category FROM named_recs")
def enrich_category(spark, folder):
    return named(spark, folder)


@query("enrich_price", "SELECT user_id, product_id, rating, product_name, category, price FROM priced_recs")
def enrich_price(spark, folder):
    return serving.with_price(named(spark, folder))


BEFORE, AFTER = PICTURE_PATH.split("{}")


@query(
    "enrich_image",
    f"""SELECT p.*, CASE WHEN product_id IN (SELECT product_id FROM manifest)
                         THEN '{BEFORE}' || product_id || '{AFTER}'
                         ELSE {placeholder_sql('category')} END AS image_url
        FROM priced_recs p""",
)
def enrich_image(spark, folder):
    return serving.enriched(
        inputs.recs(spark, folder),
        feeds.catalogue_feed(spark, folder),
        feeds.picture_manifest(spark, folder),
    )


def _pages_sql(where, order, size):
    return f"""SELECT *, cast(floor((position - 1) / {size}) + 1 AS bigint) AS page
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS position
             FROM priced_recs WHERE {where})"""


@query("serve_filter_sort_page", _pages_sql("lower(product_name) LIKE '%g%'", "price, product_id", 2))
def serve_filter_sort_page(spark, folder):
    priced = serving.with_price(named(spark, folder))
    return serving.pages(priced, text="G", sort="price_low", size=2)


@query(
    "serve_category_page",
    _pages_sql("category = 'Electronics'", "rating DESC, product_id", 15),
)
def serve_category_page(spark, folder):
    return serving.pages(serving.with_price(named(spark, folder)), category="Electronics")


@query(
    "serve_dashboard",
    """SELECT user_id, count(*) AS items, cast(round(cast(avg(rating) AS decimal(18, 9)), 2) AS double) AS avg_score,
              cast(round(cast(least(avg(rating) / 15 * 100, 100) AS decimal(18, 9)), 4) AS double)
              AS confidence_pct
       FROM recs GROUP BY 1""",
)
def serve_dashboard(spark, folder):
    return serving.dashboard(inputs.recs(spark, folder))


@query("serve_category_mix", "SELECT user_id, category, count(*) AS items FROM named_recs GROUP BY 1, 2")
def serve_category_mix(spark, folder):
    return serving.category_mix(named(spark, folder))
