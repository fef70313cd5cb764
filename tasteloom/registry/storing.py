"""Queries for sources, sinks and layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasteloom.operators import stats
from tasteloom.operators.evaluate import error_metrics, long_form
from tasteloom.operators.features import training_frame
from tasteloom.operators.model import FAST, fit, load_model, predict, save_model
from tasteloom.registry import inputs
from tasteloom.registry.book import query
from tasteloom.shared import new_path, settle
from tasteloom.sources import feeds, readers, writers

CSV_COLUMNS = ["product_id", "user_id", "rating", "timestamp"]
FEED_SQL = "SELECT user_id, product_id, rating, ts FROM orders_feed"
LONG = {"user_id": "bigint", "product_id": "bigint", "timestamp": "bigint"}


def _csv(spark, folder, header):
    """The orders feed as CSV files in the shared folder, in the usual column order."""
    feed = feeds.orders_feed(spark, folder).withColumnRenamed("ts", "timestamp")
    return writers.write_csv(feed.select(*CSV_COLUMNS), new_path(spark, "ratings-csv"), header)


def _as_feed(df):
    typed = df.withColumns({c: F.col(c).cast(t) for c, t in LONG.items()})
    return typed.select("user_id", "product_id", "rating", F.col("timestamp").alias("ts"))


@query("scan_csv_header", FEED_SQL)
def scan_csv_header(spark, folder):
    return _as_feed(readers.read_ratings_csv(spark, _csv(spark, folder, True)))


@query(
    "scan_csv_schema",
    """SELECT cast(product_id AS varchar) AS product_id, cast(user_id AS varchar) AS user_id,
              rating, ts AS timestamp FROM orders_feed""",
)
def scan_csv_schema(spark, folder):
    path = _csv(spark, folder, False)
    return readers.read_ratings_csv(spark, path, readers.RATING_SCHEMA, header=False)


@query("scan_csv_positional", FEED_SQL)
def scan_csv_positional(spark, folder):
    path = _csv(spark, folder, False)
    return _as_feed(readers.read_ratings_csv(spark, path, header=False, names=CSV_COLUMNS))


@query("scan_head", FEED_SQL + " ORDER BY ts, user_id, product_id, rating LIMIT 10000")
def scan_head(spark, folder):
    feed = feeds.orders_feed(spark, folder)
    return readers.first_rows(feed, ["ts", "user_id", "product_id", "rating"], 10_000)


@query("scan_json", "SELECT cast(user_id AS varchar) AS user_id, product_id, rating FROM recs")
def scan_json(spark, folder):
    path = writers.write_report(inputs.recs(spark, folder), new_path(spark, "recs-json"))
    return readers.read_recommendations_json(spark, path)


@query(
    "frame_from_rows",
    """SELECT label, count(*) AS ratings
       FROM orders_feed JOIN (VALUES (1.0, 'poor'), (2.0, 'fair'), (3.0, 'good'),
            (4.0, 'very good'), (5.0, 'excellent')) v(r, label) ON rating = r GROUP BY label""",
)
def frame_from_rows(spark, folder):
    rows = [(1.0, "poor"), (2.0, "fair"), (3.0, "good"), (4.0, "very good"), (5.0, "excellent")]
    labels = readers.rows_frame(spark, rows, "rating double, label string")
    counts = stats.rating_histogram(feeds.orders_feed(spark, folder))
    return counts.join(F.broadcast(labels), "rating").select("label", F.col("count").alias("ratings"))


@query(
    "sink_csv",
    """SELECT product_id, count(rating) AS popularity_score, round(avg(rating), 4) AS avg_rating
       FROM orders_feed GROUP BY 1""",
)
def sink_csv(spark, folder):
    table = stats.product_stats(feeds.orders_feed(spark, folder), ordered=False)
    path = writers.write_csv(
        table.select("product_id", "popularity_score", "avg_rating"), new_path(spark, "popularity")
    )
    return spark.read.schema("product_id bigint, popularity_score bigint, avg_rating double").csv(path)


@query(
    "sink_csv_single",
    """SELECT user_id, count(rating) AS rating_count FROM orders_feed
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
)
def sink_csv_single(spark, folder):
    table = stats.most_active(feeds.orders_feed(spark, folder), 20).select("user_id", "rating_count")
    path = writers.write_csv_single(table, new_path(spark, "active"), rows=20)
    return spark.read.option("header", True).schema("user_id bigint, rating_count bigint").csv(path)


@query("sink_parquet", "SELECT user_id, product_id, rating, 'r1' AS run FROM recs")
def sink_parquet(spark, folder):
    base = new_path(spark, "recs")
    writers.write_parquet(inputs.recs(spark, folder), base, run="r1")
    return spark.read.parquet(base)


@query(
    "sink_json_report",
    """SELECT unnest(['rmse', 'mae']) AS metric, unnest([
              round(sqrt(avg((rating - prediction) ** 2)), 6),
              round(avg(abs(rating - prediction)), 6)]) AS value FROM predictions""",
)
def sink_json_report(spark, folder):
    report = long_form("metrics", error_metrics(inputs.predictions(spark, folder)),
                       {"rmse": "rmse", "mae": "mae"})
    path = writers.write_report(report, new_path(spark, "report"))
    return spark.read.schema("metric string, value double").json(path)


@query("model_save_load")
def model_save_load(spark, folder):
    train, test = inputs.train_test(spark, folder)
    model = fit(training_frame(train), FAST)
    again = load_model(save_model(model, new_path(spark, "als")))
    return predict(again, training_frame(test))


@query(
    "model_reload",
    """SELECT count(*) AS predictions, 0 AS changed FROM test
       WHERE user_id IN (SELECT user_id FROM train) AND product_id IN (SELECT product_id FROM train)""",
)
def model_reload(spark, folder):
    """Predictions that differ after the model was written and read again."""
    train, test = inputs.train_test(spark, folder)
    model = fit(training_frame(train), FAST)
    again = load_model(save_model(model, new_path(spark, "als")))
    before = predict(model, training_frame(test)).withColumnRenamed("prediction", "before")
    after = predict(again, training_frame(test))
    both = before.join(after, ["user_id", "product_id", "rating"])
    changed = F.count_if(F.col("before") != F.col("prediction")).cast("int")
    return both.agg(F.count(F.lit(1)).alias("predictions"), changed.alias("changed"))


@query("repartition_target", FEED_SQL)
def repartition_target(spark, folder):
    return writers.resize(feeds.orders_feed(spark, folder))


def _session_partitions(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("repartition_fixed", FEED_SQL)
def repartition_fixed(spark, folder):
    return writers.resize(feeds.orders_feed(spark, folder), _session_partitions(spark))


@query(
    "persist_level",
    "SELECT rating, count(*) AS ratings, count(DISTINCT user_id) AS users FROM orders_feed GROUP BY 1",
)
def persist_level(spark, folder):
    with writers.held(feeds.orders_feed(spark, folder)) as feed:
        ratings = feed.groupBy("rating").agg(F.count(F.lit(1)).alias("ratings"))
        users = feed.select("rating", "user_id").distinct().groupBy("rating").agg(F.count("user_id").alias("users"))
        return settle(ratings.join(users, "rating"))


@query("partition_stats")
def partition_stats(spark, folder):
    return writers.partition_stats(writers.resize(feeds.orders_feed(spark, folder)))


@query("partition_rows", "SELECT count(*) AS rows, 7 AS partitions, true AS largest_within FROM orders_feed")
def partition_rows(spark, folder):
    """Rows dealt to seven partitions: none has more than its share, but for one row per partition they came from."""
    feed = settle(feeds.orders_feed(spark, folder), "feed")
    sources = writers.partition_stats(feed).agg(F.count(F.lit(1))).scalar()
    summary = writers.partition_summary(writers.resize(feed, 7))
    return summary.select(
        "rows", F.col("partitions").cast("int").alias("partitions"),
        (F.col("max_rows") <= F.ceil(F.col("rows") / 7) + sources).alias("largest_within"),
    )


@query("preview", FEED_SQL + " ORDER BY user_id, product_id, ts, rating LIMIT 20")
def preview(spark, folder):
    feed = feeds.orders_feed(spark, folder)
    return readers.first_rows(feed, ["user_id", "product_id", "ts", "rating"], 20)
