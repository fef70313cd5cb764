"""Joins and numbering with hot keys against the plain forms."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tasteloom import spread
from tasteloom.operators import encode
from tasteloom.operators.model import AlsSpec
from tasteloom.plans.train import train
from tasteloom.spread import (
    hot_keys,
    number_rows,
    place_rows,
    running_total,
    spread_join,
    spread_joins,
)
from tests.helpers import plan_of, rows


@pytest.fixture
def fact(spark):
    """A third of the rows have key 0, and half of those are copies of one row."""
    hot = spark.range(200).select(F.lit(0).cast("long").alias("k"), F.least("id", F.lit(100)).alias("v"))
    cold = spark.range(400).select((F.col("id") % 40 + 1).alias("k"), F.col("id").alias("v"))
    none = spark.range(30).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("v"))
    return hot.unionByName(cold).unionByName(none).repartition(5)


@pytest.fixture
def dim(spark):
    return spark.range(0, 30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("d"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [3, 50, None])
def test_spread_join_equals_join(fact, dim, how, hot_rows):
    assert rows(spread_join(fact, dim, ["k"], how, hot_rows)) == rows(fact.join(dim, "k", how))


def test_two_joins_at_once(fact, dim):
    other = dim.select(F.col("k").alias("v"), F.col("d").alias("e"))
    both = spread_joins(fact, [(dim, ["k"], "left"), (other, ["v"], "left")], 5)
    plain = fact.join(dim, "k", "left").join(other, "v", "left").select("k", "v", "d", "e")
    assert rows(both) == rows(plain)


def test_two_key_columns(fact):
    counts = fact.groupBy("k", "v").agg(F.count("*").alias("n"))
    joined = spread_join(fact.na.drop(), counts, ["k", "v"], hot_rows=10)
    assert rows(joined) == rows(fact.na.drop().join(counts, ["k", "v"]))


def test_hot_keys_lists_only_large_keys(fact):
    assert rows(hot_keys(fact, ["k"], 50)) == [(0, 4)]


def test_every_hot_key_is_split(spark):
    """There may be more hot keys than any fixed list would hold."""
    df = spark.range(180_000).select((F.col("id") % 60_000).alias("k"))
    found = hot_keys(df, ["k"], 2)
    assert found.count() == 60_000
    assert found.filter("_slices <> 2").count() == 0


def test_no_key_is_hot_in_an_empty_table(spark):
    assert hot_keys(spark.range(0).toDF("k"), ["k"]).count() == 0


def test_only_used_columns_are_read(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    counts = lines.groupBy("l_partkey").agg(F.count("*").alias("n"))
    joined = spread_join(lines, counts, ["l_partkey"], "left").select("l_partkey", "n")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "l_partkey" in plan and "l_comment" not in plan and "l_quantity" not in plan


def test_hot_key_is_spread_over_partitions(spark, fact, dim):
    """Even the copies of one row land in several partitions."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = spread_join(fact, dim, ["k"], hot_rows=10).filter("k = 0 and v = 100")
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1


@pytest.mark.parametrize("hot_rows", [3, 50, None])
def test_number_rows_equals_window(fact, hot_rows):
    numbered = number_rows(fact, ["k"], [F.desc("v")], "n", hot_rows)
    window = Window.partitionBy("k").orderBy(F.desc("v"))
    assert rows(numbered) == rows(fact.withColumn("n", F.row_number().over(window).cast("long")))


@pytest.mark.parametrize("partitions", ["1", "3", "7"])
def test_place_rows_does_not_depend_on_partitions(spark, fact, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        placed = rows(place_rows(fact, [F.col("v"), F.col("k")], "at"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    window = Window.orderBy("v", "k")
    assert placed == rows(fact.withColumn("at", (F.row_number().over(window) - 1).cast("long")))


def test_running_total(spark):
    df = spark.range(100).select(F.col("id").alias("v"), (F.col("id") % 7).alias("w"))
    got = {r.v: r.t for r in running_total(df, [F.col("v")], "w", "t").collect()}
    total = 0
    for v in range(100):
        total += v % 7
        assert got[v] == total


def test_internal_names_may_be_columns(spark):
    """Columns named like those that the functions add for themselves keep their values."""
    names = ["_mark", "_slice", "_slices", "_rows", "_limit", "_src", "_at", "_part", "_pos", "_before", "_amount", "_inside", "_p", "_n", "_carried", "_hot_k"]
    fact = spark.range(60).select((F.col("id") % 3).alias("k"), "id", *[F.lit(f"own {n}").alias(n) for n in names])
    dim = spark.createDataFrame([(0, "a", 1), (1, "b", 2)], "k long, label string, _mark_ int")
    joined = spread_join(fact, dim, ["k"], "left", hot_rows=5)
    assert joined.columns == [*fact.columns, "label", "_mark_"]
    order = [F.col("id")]
    for df in (joined, place_rows(fact, order, "o"), running_total(fact, order, "id", "o"), number_rows(fact, ["k"], order, "o", hot_rows=5)):
        got = df.collect()
        assert len(got) == 60 and all(r[n] == f"own {n}" for r in got for n in names)
    assert {(r["id"], r["o"]) for r in number_rows(fact, ["k"], order, "o", hot_rows=5).collect()} == {(i, i // 3 + 1) for i in range(60)}


def test_joins_send_the_partition_instead_of_a_hash(spark):
    """A hash of every row does not compress, and it was sent through each join."""
    fact = spark.range(1_000).select((F.col("id") % 7).alias("a"), (F.col("id") % 11).alias("b"))
    dims = [spark.range(20).select(F.col("id").alias(k), F.col("id").alias(f"of_{k}")) for k in "ab"]
    joined = spread_joins(fact, [(d, [k], "inner") for d, k in zip(dims, "ab", strict=True)], hot_rows=50)
    assert joined.count() == 1_000
    sent = [line for line in plan_of(joined).splitlines() if "_mark" in line]
    assert not sent


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_known_counts_split_the_same_keys(fact, dim, how):
    known = fact.na.drop().groupBy("k").count()
    assert rows(hot_keys(fact, ["k"], 50, counted=known)) == rows(hot_keys(fact, ["k"], 50))
    joined = spread_joins(fact, [(dim, ["k"], how)], 50, counted=[known])
    assert rows(joined) == rows(fact.join(dim, "k", how))


def test_coding_does_not_count_again(ratings):
    """The index has counted the rows of every id; the same codes come without another pass."""
    counted = encode.dense_index(ratings, "user_id", "user_idx", counted=True)
    plain, known = {"user_id": counted.drop("count")}, {"user_id": counted.select("user_id", "count")}
    assert rows(counted.select("user_id", "count")) == rows(ratings.groupBy("user_id").count())
    again, once = encode.encode(ratings, plain), encode.encode(ratings, plain, known)
    assert rows(once) == rows(again)
    passes = lambda df: len(re.findall(r"partial_count\(1\)", plan_of(df)))
    assert passes(once) == passes(again) - 2


def test_training_counts_ids_once(ratings, monkeypatch):
    def again(df, keys, rows):
        raise AssertionError(f"rows per {keys} are counted again")

    monkeypatch.setattr(spread, "_counts", again)
    trained = train(ratings, AlsSpec(rank=2, iterations=1))
    assert trained.coded.count() == ratings.count()
    assert [index.columns for index in trained.indexes.values()] == [["user_id", "user_idx"], ["product_id", "item_idx"]]
