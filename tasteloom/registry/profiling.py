"""Queries for profiling and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasteloom.operators import profile
from tasteloom.plans import ingest
from tasteloom.registry.book import query
from tasteloom.registry.storing import CSV_COLUMNS, _csv
from tasteloom.sources import feeds, readers

DIRTY = ["user_id", "product_id", "rating", "ts"]


def _each(columns, select, source):
    return " UNION ALL ".join(f"SELECT {select.format(c=c)} FROM {source}" for c in columns)


NULL_COUNT = "count(*) FILTER (WHERE {c} IS NULL)"
NULL_PCT = "round(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100, 2)"
DISTINCT = "count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"
NULLS = f"'{{c}}' AS column_name, {NULL_COUNT} AS null_count, {NULL_PCT} AS null_pct"


@query(
    "profile_shape",
    """SELECT count(*) AS total_rows, cast(4 AS bigint) AS total_columns,
              'user_id,product_id,rating,ts' AS column_names FROM dirty_feed""",
)
def profile_shape(spark, folder):
    return profile.shape(feeds.dirty_feed(spark, folder))


@query("profile_nulls", _each(DIRTY, NULLS, "dirty_feed"))
def profile_nulls(spark, folder):
    return profile.nulls(feeds.dirty_feed(spark, folder))


@query(
    "profile_distinct",
    _each(DIRTY, f"'{{c}}' AS column_name, cast({DISTINCT} AS bigint) AS distinct_count", "dirty_feed"),
)
def profile_distinct(spark, folder):
    return profile.distinct_values(feeds.dirty_feed(spark, folder))


@query(
    "profile_types",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS filled_rows FROM dirty_feed"
        for c, t in zip(DIRTY, ["string", "string", "double", "bigint"], strict=True)
    ),
)
def profile_types(spark, folder):
    return profile.types(feeds.dirty_feed(spark, folder))


@query(
    "profile_critical_nulls",
    f"""SELECT * FROM (
          {_each(["user_id", "high_rating"], NULLS,
                 "(SELECT user_id, CASE WHEN rating > 5 THEN rating END AS high_rating FROM dirty_feed)")}
        ) WHERE null_pct > 50""",
)
def profile_critical_nulls(spark, folder):
    high = F.when(F.col("rating") > 5, F.col("rating")).alias("high_rating")
    return profile.critical_nulls(feeds.dirty_feed(spark, folder).select("user_id", high))


@query(
    "duplicate_rows",
    """SELECT cast(sum(n) AS bigint) AS total_rows, count(*) AS distinct_rows,
              cast(sum(n) - count(*) AS bigint) AS duplicate_rows,
              round((sum(n) - count(*)) / cast(sum(n) AS double) * 100, 2) AS duplicate_pct
       FROM (SELECT count(*) AS n FROM orders_feed GROUP BY user_id, product_id, rating, ts)""",
)
def duplicate_rows(spark, folder):
    return profile.duplicate_rows(feeds.orders_feed(spark, folder))


def _report_sql():
    columns = ["product_id", "user_id", "rating", "ts"]
    names = dict(zip(columns, CSV_COLUMNS, strict=True))
    whole = [
        "SELECT 'total_rows' AS metric, '*' AS column_name, cast(count(*) AS double) AS value FROM orders_feed",
        "SELECT 'total_columns', '*', 4.0",
        """SELECT 'duplicate_rows', '*', cast(sum(n - 1) AS double)
           FROM (SELECT count(*) AS n FROM orders_feed GROUP BY user_id, product_id, rating, ts)""",
    ]
    for c in columns:
        for metric, value in (("null_count", NULL_COUNT), ("null_pct", NULL_PCT), ("distinct_count", DISTINCT)):
            whole.append(
                f"SELECT '{metric}', '{names[c]}', cast({value.format(c=c)} AS double) FROM orders_feed"
            )
    return " UNION ALL ".join(whole)


@query("ingest_report", _report_sql())
def ingest_report(spark, folder):
    raw = readers.read_ratings_csv(
        spark, _csv(spark, folder, False), readers.RATING_SCHEMA, header=False
    )
    return ingest.ingest(raw)[1]
