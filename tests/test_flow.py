"""The whole way, from a CSV file to written recommendations."""

import glob
from dataclasses import replace

from pyspark.sql import functions as F

from tasteloom.operators.model import FAST
from tasteloom.plans import flow
from tasteloom.shared import shared_root
from tasteloom.sources import feeds, readers, writers


def test_run(spark, small, tmp_path):
    feed = feeds.dirty_feed(spark, small).select("product_id", "user_id", "rating", F.col("ts").alias("timestamp"))
    source = writers.write_csv(feed, str(tmp_path / "feed"))
    raw = readers.read_ratings_csv(spark, source, readers.RATING_SCHEMA, header=False)
    raw = raw.withColumnRenamed("timestamp", "ts")
    before = set(glob.glob(f"{shared_root(spark)}/tasteloom/*"))
    written = flow.run(raw, str(tmp_path / "out"), "r1", spec=replace(FAST, rank=3, iterations=2), n=5)
    assert set(glob.glob(f"{shared_root(spark)}/tasteloom/*")) == before
    ratings = spark.read.parquet(written.clean)
    audit = spark.read.json(written.reports["audit"])
    assert audit.orderBy(F.desc("step_no")).first().rows_left == ratings.count() == 383
    lists = spark.read.parquet(written.recommendations)
    assert lists.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 5
    assert lists.join(ratings, ["user_id", "product_id"], "left_semi").count() == 0
    metrics = {r.metric for r in spark.read.json(written.reports["evaluation"]).collect()}
    assert {"rmse", "mae", "r2", "precision_at_5", "recall_at_5", "coverage", "diversity"} <= metrics


def test_a_sampled_run_audits_what_it_cleans(spark, small, tmp_path):
    raw = feeds.dirty_feed(spark, small)
    spec = replace(FAST, rank=3, iterations=2)
    written = flow.run(raw, str(tmp_path / "out"), "r1", spec=spec, n=5, sample=0.5, explore=False)
    audit = spark.read.json(written.reports["audit"]).orderBy("step_no").collect()
    assert audit[0].rows_left + audit[0].removed == raw.count() // 2
    assert audit[-1].rows_left == spark.read.parquet(written.clean).count()


def test_run_popular(spark, small, tmp_path):
    raw = feeds.orders_feed(spark, small)
    path = flow.run_popular(raw, str(tmp_path / "popular"), head=3_000, users=7, n=4)
    lists = spark.read.option("header", True).csv(path)
    assert lists.count() == 28
    assert lists.select("product_id").distinct().count() == 4


def test_run_popular_takes_all_rows_and_users_by_default(spark, small, tmp_path):
    raw = feeds.orders_feed(spark, small)
    path = flow.run_popular(raw, str(tmp_path / "popular"), n=3)
    lists = spark.read.option("header", True).csv(path)
    assert lists.count() == 3 * raw.select("user_id").distinct().count()
