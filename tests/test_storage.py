"""Sources, sinks, layout and the shared folder."""

import os
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tasteloom.plans.ingest import ingest
from tasteloom.shared import FREE_SHUFFLES, new_path, remove, scratch, settle, shared_root, store
from tasteloom.sources import readers, writers
from tests.helpers import rows


def test_shared_folder_is_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    assert new_path(spark, "x").startswith(root)
    assert new_path(spark, "x") != new_path(spark, "x")


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session_without_setting(master):
    return SimpleNamespace(conf={"spark.sql.warehouse.dir": "file:/w"}, sparkContext=FakeContext(master))


def test_only_a_local_session_falls_back_to_its_warehouse():
    local = session_without_setting("local[2]")
    assert shared_root(local) == "file:/w/shared" == shared_root(local)
    with pytest.raises(RuntimeError):
        shared_root(session_without_setting("yarn"))


def test_settle_keeps_rows_and_cuts_the_plan(spark, ratings):
    again = settle(ratings.withColumn("n", F.col("rating") * 2))
    assert rows(again) == rows(ratings.withColumn("n", F.col("rating") * 2))
    assert again.inputFiles()


def test_csv_round_trips(spark, ratings, tmp_path):
    feed = ratings.select("product_id", "user_id", "rating", F.col("ts").alias("timestamp"))
    plain = writers.write_csv(feed, str(tmp_path / "plain"))
    titled = writers.write_csv(feed, str(tmp_path / "titled"), header=True)
    as_text = rows(feed.withColumns({c: F.col(c).cast("string") for c in ("product_id", "user_id")}))
    assert rows(readers.read_ratings_csv(spark, plain, readers.RATING_SCHEMA, header=False)) == as_text
    assert rows(readers.read_ratings_csv(spark, titled)) == rows(feed)
    names = ["product_id", "user_id", "rating", "timestamp"]
    assert rows(readers.read_ratings_csv(spark, plain, header=False, names=names)) == rows(feed)


def test_malformed_csv_fields_become_null(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("p1,u1,four,12\np2,u2,3.5,x\n")
    df = readers.read_ratings_csv(spark, str(path), readers.RATING_SCHEMA, header=False)
    assert rows(df) == [("p1", "u1", None, 12), ("p2", "u2", 3.5, None)]


def test_single_csv_is_one_file_and_bounded(ratings, tmp_path):
    path = writers.write_csv_single(ratings, str(tmp_path / "one"), rows=7)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    with pytest.raises(ValueError):
        writers.write_csv_single(ratings, str(tmp_path / "more"), rows=6)


def test_parquet_runs_and_tables(spark, ratings, tmp_path):
    base = str(tmp_path / "runs")
    writers.write_parquet(ratings, base, "a")
    writers.write_parquet(ratings.limit(2), base, "b")
    assert spark.read.parquet(base).groupBy("run").count().count() == 2
    paths = writers.write_tables({"x": ratings, "y": ratings.limit(1)}, str(tmp_path / "tables"))
    assert spark.read.parquet(paths["x"]).count() == 7


def test_json_user_ids_are_text(spark, ratings, tmp_path):
    path = writers.write_report(ratings.select("user_id", "product_id", "rating"), str(tmp_path / "r"))
    df = readers.read_recommendations_json(spark, path)
    assert dict(df.dtypes)["user_id"] == "string"
    assert df.count() == 7


def test_scratch_tables_go_at_the_end(spark, ratings):
    with scratch(spark):
        path = settle(ratings).inputFiles()[0].removeprefix("file:").removeprefix("//").rpartition("/")[0]
        assert os.path.isdir(path)
    assert not os.path.exists(path)


def shuffle_files(spark) -> set[str]:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if os.path.basename(f).startswith("shuffle_")}


def test_settle_leaves_no_shuffle_files(spark, ratings):
    before, setting = shuffle_files(spark), spark.conf.get(FREE_SHUFFLES)
    counts = ratings.repartition(3).groupBy("user_id").count()
    settled = settle(counts, "free")
    until = time.monotonic() + 20
    while shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(FREE_SHUFFLES) == setting
    assert rows(settled) == rows(counts)


def test_held_rows_can_be_settled_and_read_again(ratings):
    with writers.held(ratings.groupBy("user_id").count()) as kept:
        assert rows(settle(kept, "held")) == rows(kept)
        assert rows(settle(kept.filter("count > 1"), "held")) == rows(kept.filter("count > 1"))


def test_stored_table_can_be_removed_early(spark, ratings):
    path = new_path(spark, "early")
    assert rows(store(ratings, path)) == rows(ratings)
    remove(spark, [path])
    assert not os.path.exists(path)


def test_layout_keeps_rows(ratings):
    assert rows(writers.resize(ratings)) == rows(ratings)
    assert rows(writers.resize(ratings, 3)) == rows(ratings)
    summary = writers.partition_summary(writers.resize(ratings, 3)).first()
    assert summary.rows == 7 and summary.partitions <= 3


def test_held_releases(ratings):
    with writers.held(ratings) as kept:
        assert kept.is_cached
    assert not ratings.is_cached


def test_ingest(ratings):
    laid_out, report = ingest(ratings.unionByName(ratings), 2)
    found = {(r.metric, r.column_name): r.value for r in report.collect()}
    assert found["total_rows", "*"] == 14 and found["duplicate_rows", "*"] == 7
    assert laid_out.count() == 14
    assert readers.first_rows(ratings, ["ts"], 2).count() == 2
