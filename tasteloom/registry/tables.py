"""The shared inputs as DuckDB SQL."""

from __future__ import annotations

import re

from tasteloom.functions import catalog
from tasteloom.sources.feeds import NOUNS


def hundredth(text: str) -> str:
    return f"(cast('0x' || substr(md5({text}), 1, 8) AS bigint) % 100)"


def category_sql(name: str) -> str:
    rules = "".join(
        " WHEN " + " OR ".join(f"lower({name}) LIKE '%{w}%'" for w in words) + f" THEN '{category}'"
        for category, words in catalog.CATEGORY_WORDS.items()
    )
    return f"CASE{rules} ELSE '{catalog.OTHER_CATEGORY}' END"


def price_sql(category: str, product: str) -> str:
    bits = f"cast('0x' || substr(md5(cast({product} AS varchar)), 1, 8) AS bigint)"
    rules = "".join(
        f" WHEN {category} = '{name}' THEN {bits} % {high - low} + {low}"
        for name, (low, high) in catalog.PRICE_RANGES.items()
    )
    return f"CASE{rules} END"


def placeholder_sql(category: str) -> str:
    rules = "".join(
        f" WHEN {category} = '{name}' THEN '{url}'" for name, url in catalog.PLACEHOLDERS.items()
    )
    return f"CASE{rules} END"


NOUN_LIST = ", ".join(f"'{n}'" for n in NOUNS)

# In order of dependence.
TABLES = {
    "orders_feed": """
        SELECT o_custkey AS user_id, l_partkey AS product_id,
               cast(floor((l_quantity - 1) / 10) + 1 AS double) AS rating,
               cast(epoch(o_orderdate) AS bigint) AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "events_feed": """
        SELECT event_id, user_id, cast(json_extract_string(props, '$.k') AS int) AS product_id,
               cast(floor(value / 5) / 2.0 AS double) AS rating,
               cast(floor(epoch(ts)) AS bigint) AS ts
        FROM events""",
    "dirty_feed": """
        SELECT CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 'U-bad'
                    ELSE cast(user_id AS varchar) END AS user_id,
               CASE WHEN event_id % 41 <> 0 THEN cast(product_id AS varchar) END AS product_id,
               CASE WHEN event_id % 43 <> 0 THEN rating END AS rating,
               CASE WHEN event_id % 47 <> 0 THEN ts END AS ts
        FROM events_feed""",
    "catalogue": f"""
        SELECT p_partkey AS product_id,
               p_name || ' ' || [{NOUN_LIST}][cast(p_partkey % {len(NOUNS)} + 1 AS int)] AS product_name
        FROM part""",
    "manifest": "SELECT p_partkey AS product_id FROM part WHERE p_size <= 25",
    "clean_orders": """
        SELECT user_id, product_id, rating, ts
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, product_id
                     ORDER BY ts DESC NULLS LAST, rating DESC NULLS LAST) AS rn FROM orders_feed)
        WHERE rn = 1""",
    "marked": f"SELECT *, {hundredth('concat(user_id, chr(58), product_id)')} AS b FROM clean_orders",
    "train": "SELECT user_id, product_id, rating, ts FROM marked WHERE b < 80",
    "test": "SELECT user_id, product_id, rating, ts FROM marked WHERE b >= 80",
    "predictions": """
        SELECT t.user_id, t.product_id, t.rating,
               coalesce(p.m, (SELECT avg(rating) FROM train)) AS prediction
        FROM test t LEFT JOIN (SELECT product_id, avg(rating) AS m FROM train GROUP BY 1) p
             USING (product_id)""",
    "partial_predictions": """
        SELECT t.user_id, t.product_id, t.rating,
               CASE WHEN n >= 25 THEN m WHEN n >= 20 THEN cast('nan' AS double) END AS prediction
        FROM test t LEFT JOIN (SELECT product_id, avg(rating) AS m, count(rating) AS n
                               FROM train GROUP BY 1) p USING (product_id)""",
    "lists": """
        SELECT * FROM (SELECT user_id, product_id, rating, prediction,
               cast(rank() OVER (PARTITION BY user_id ORDER BY prediction DESC) AS int) AS rank
               FROM predictions) WHERE rank <= 3""",
    "recs": """
        SELECT user_id, product_id, round(prediction, 4) AS rating
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                     ORDER BY prediction DESC, product_id) AS rn FROM predictions)
        WHERE rn <= 10""",
    "event_recs": """
        SELECT user_id, product_id, rating
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                     ORDER BY rating DESC, product_id) AS rn
              FROM (SELECT user_id, product_id, round(avg(rating), 4) AS rating
                    FROM events_feed GROUP BY 1, 2))
        WHERE rn <= 10""",
    "named_recs": f"""
        SELECT r.user_id, r.product_id, r.rating, c.product_name,
               {category_sql('c.product_name')} AS category
        FROM recs r LEFT JOIN catalogue c USING (product_id)""",
    "priced_recs": f"""
        SELECT *, {price_sql('category', 'product_id')} AS price FROM named_recs""",
    "user_features": """
        SELECT user_id, count(rating) AS user_activity_score,
               round(avg(rating), 4) AS user_avg_rating,
               coalesce(round(stddev_samp(rating), 4), 0.0) AS user_rating_stddev,
               count(DISTINCT product_id) AS user_unique_products
        FROM orders_feed GROUP BY user_id""",
    "product_features": """
        SELECT product_id, count(rating) AS product_popularity,
               round(avg(rating), 4) AS product_avg_rating,
               coalesce(round(stddev_samp(rating), 4), 0.0) AS product_rating_stddev,
               min(rating) AS product_min_rating, max(rating) AS product_max_rating
        FROM orders_feed GROUP BY product_id""",
    "row_activity": """
        SELECT f.*, u.user_activity_score FROM orders_feed f JOIN user_features u USING (user_id)""",
    "activity_stats": """
        SELECT avg(user_activity_score) AS m,
               greatest(stddev_samp(user_activity_score), 1.0) AS s FROM row_activity""",
    "ranked_users": """
        SELECT u.*,
               round((user_activity_score - (SELECT m FROM activity_stats))
                     / (SELECT s FROM activity_stats), 6) AS interaction_frequency,
               cast(dense_rank() OVER (ORDER BY user_activity_score DESC) AS int) AS user_rank
        FROM user_features u""",
    "ranked_products": """
        SELECT p.*, cast(dense_rank() OVER (ORDER BY product_popularity DESC) AS int) AS product_rank
        FROM product_features p""",
    "best_products": """
        SELECT product_id, row_number() OVER (ORDER BY score DESC, product_id) AS rank
        FROM (SELECT product_id, round(avg(rating) * ln(count(rating) + 1), 9) AS score
              FROM orders_feed GROUP BY 1)
        QUALIFY rank <= 10""",
}


def with_tables(sql: str) -> str:
    """Prefix ``sql`` with the tables it uses, directly or through others."""
    needed: set[str] = set()

    def add(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                add(TABLES[name])

    add(sql)
    if not needed:
        return sql
    listed = ", ".join(f"{n} AS ({TABLES[n]})" for n in TABLES if n in needed)
    return f"WITH {listed} {sql}"
