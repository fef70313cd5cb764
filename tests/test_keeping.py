"""Samples of exact size, mergeable summaries, watched passes, bucketed facts, rejects and run folders."""

import re
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteloom.operators import clean, profile, ranking, sampling, sketches
from tasteloom.operators.clean import CleanRules
from tasteloom.plans import ingest
from tasteloom.shared import RanOnce, new_path, settle
from tasteloom.sources import readers, writers
from tasteloom.sources.bucketed import bucketed
from tests.helpers import plan_of, rows


@pytest.fixture
def numbers(spark):
    """Ids 0 to 1999, and 1000 copies of one more row."""
    hot = spark.range(1_000).select(F.lit(5_000).cast("long").alias("id"), F.lit(None).cast("string").alias("note"))
    return spark.range(2_000).select("id", (F.col("id") % 7).cast("string").alias("note")).unionByName(hot)


# ------------------------------------------------------------------ samples


@pytest.mark.parametrize("n", [0, 1, 700, 2_500, 2_999, 3_000, 9_999])
def test_bottom_k_has_the_exact_size_and_the_smallest_hashes(numbers, n):
    picked = rows(sampling.bottom_k(numbers, n, ["id"]))
    assert len(picked) == min(n, 3_000)
    every = numbers.withColumn("h", sampling.keyed_hash(["id"])).orderBy("h", "id", "note").limit(n).drop("h")
    assert picked == rows(every)


def test_bottom_k_does_not_depend_on_partitions(numbers):
    assert rows(sampling.bottom_k(numbers.repartition(13), 400, ["id"])) == rows(sampling.bottom_k(numbers.coalesce(1), 400, ["id"]))


def test_samples_merge(numbers):
    parts = [sampling.bottom_k(numbers.filter(F.col("id") % 3 == i), 300, ["id"]) for i in range(3)]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert rows(sampling.bottom_k(union, 300, ["id"])) == rows(sampling.bottom_k(numbers, 300, ["id"]))


def test_sample_of_columns_that_clash_and_of_nothing(spark, numbers):
    odd = numbers.withColumn("_hash", F.lit("h")).withColumn("_lead", F.lit("l")).withColumn("_AT", F.lit(1)).withColumn("_upto", F.lit(2))
    picked = sampling.bottom_k(odd, 10, ["id", "note"])
    assert picked.columns == odd.columns and {tuple(r)[2:] for r in picked.collect()} == {("h", "l", 1, 2)}
    assert sampling.bottom_k(numbers.limit(0), 10, ["id"]).collect() == []
    assert sampling.sample_share(numbers, 0.25, ["id"]).count() == 750


def test_seeds_give_different_samples(numbers):
    assert rows(sampling.bottom_k(numbers, 50, ["id"], 1)) != rows(sampling.bottom_k(numbers, 50, ["id"], 2))


# ------------------------------------------------------------------ summaries


def test_sketched_median_of_merged_groups(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), ((F.col("id") * 7_919) % 60_000).cast("double").alias("rating"))
    daily = settle(sketches.quantile_sketches(df, ["day"]))
    assert daily.count() == 30
    for q in (0.1, 0.5, 0.99):
        (found,) = sketches.quantiles(sketches.merge_quantiles(daily), q, "x").collect()
        assert found.rows == 60_000 and abs(found.x - q * 60_000) < 600
    weekly = sketches.quantiles(sketches.merge_quantiles(daily.withColumn("week", F.floor(F.col("day") / 7)), ["week"]))
    assert {r.week: r.rows for r in weekly.collect()} == {0: 14_000, 1: 14_000, 2: 14_000, 3: 14_000, 4: 4_000}


def test_quantile_sketch_of_few_and_no_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 9.0), ("a", 2.0), ("b", None)], "k string, rating double")
    assert rows(sketches.quantiles(sketches.quantile_sketches(df, ["k"]))) == [("a", 3, statistics.median_low([1.0, 2.0, 9.0]))]


def test_merged_column_sketches_stand_for_all_rows(spark):
    df = spark.range(30_000).select((F.col("id") % 9_000).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("b"), F.lit(None).cast("int").alias("c"))
    one = sketches.column_sketches(df.filter("a % 2 = 0"))
    merged = sketches.merge_columns(one, sketches.column_sketches(df.filter("a % 2 = 1")), sketches.column_sketches(df.limit(0)))
    counted = ["column_name", "total_rows", "null_count"]
    assert rows(merged, *counted) == rows(sketches.column_sketches(df), *counted)
    exact = {r.column_name: r.distinct_count for r in profile.distinct_values(df).collect()}
    for r in sketches.distinct_estimates(merged).collect():
        assert abs(r.distinct_count - exact[r.column_name]) <= 0.02 * exact[r.column_name]


def test_bitmaps_count_exactly(spark):
    codes = [-70_000, -1, 0, 1, 1, 32_767, 32_768, 32_769, 10**12, None]
    df = spark.createDataFrame([(i % 2, c) for i, c in enumerate(codes)], "k int, code long")
    daily = sketches.code_bitmaps(df, "code", ["k"])
    assert rows(sketches.distinct_codes(daily, ["k"])) == rows(df.groupBy("k").agg(F.count_distinct("code")))
    assert rows(sketches.distinct_codes(sketches.merge_bitmaps(daily))) == [(8,)]


def test_only_bitmaps_are_shuffled(spark):
    """Rows are turned into bitmaps before the exchange."""
    daily = sketches.code_bitmaps(spark.range(100).select("id"), "id")
    plan = daily._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert re.search(r"Exchange [^\n]*\n[^\n]*Aggregate\([^\n]*partial_bitmap_construct_agg", plan)


# ------------------------------------------------------------------ ranks


@pytest.mark.parametrize("descending", [True, False])
def test_value_rank_is_the_dense_rank(spark, descending):
    df = spark.range(500).select("id", F.when(F.col("id") % 11 > 0, (F.col("id") * 37 % 101) / 7).alias("score"), F.lit("x").alias("_place"))
    order = F.desc("score") if descending else F.asc("score")
    want = df.filter("score IS NOT NULL").withColumn("r", F.dense_rank().over(Window.orderBy(order)).cast("long"))
    none = df.filter("score IS NULL").withColumn("r", F.lit(None).cast("long"))
    assert rows(ranking.value_rank(df, "score", "r", descending)) == rows(want.unionByName(none))


def test_value_rank_has_no_window_over_all_rows(spark):
    df = settle(spark.range(500).select("id", (F.col("id") / 7).alias("score")))
    plan = plan_of(ranking.value_rank(df, "score", "r"))
    # The windows are over one row per range partition.
    assert "dense_rank" not in plan and "row_number" not in plan


# ------------------------------------------------------------------ watched passes


@pytest.fixture
def dirty(spark):
    raw = [("1", "2", 5.0, 1), ("1", "2", 4.0, 2), ("1", None, 4.0, 2), ("x", "2", 3.0, 1), ("2", "2", 9.0, 1), ("2", "2", 9.0, 1), ("3", "2", None, 1)]
    return spark.createDataFrame(raw * 3 + [("9", "9", 1.0, 1)], "user_id string, product_id string, rating double, ts long")


@pytest.mark.parametrize(
    "rules", [CleanRules(), CleanRules(nulls="keys", duplicates="exact"), CleanRules(filter_first=True)]
)
def test_watched_audit_equals_the_audit(dirty, rules):
    watched = clean.Watched(dirty, rules)
    with watched.writing:
        written = settle(watched.rows)
    assert watched.writing.surely
    assert rows(written) == rows(clean.clean(dirty, rules))
    assert rows(watched.audit()) == rows(clean.clean_audit(dirty, rules))


def test_watched_audit_without_a_sure_pass_reads_again(dirty):
    watched = clean.Watched(dirty)
    assert rows(watched.audit()) == rows(clean.clean_audit(dirty))


def test_a_failed_block_is_not_sure(spark):
    fails = F.udf(lambda x: 1 // (x - 50), "long")
    once = RanOnce(spark)
    with pytest.raises(Exception), once:  # noqa: B017
        spark.range(100).select(fails("id")).collect()
    assert not once.surely
    quiet = RanOnce(spark)
    with quiet:
        pass
    assert not quiet.surely  # nothing ran that could be known


def test_sketches_from_the_pass_that_writes(dirty):
    feed, kept = ingest.ingest_sketched(dirty)
    assert rows(feed) == rows(dirty)
    assert rows(sketches.distinct_estimates(kept)) == rows(sketches.distinct_estimates(sketches.column_sketches(dirty)))


# ------------------------------------------------------------------ bucketed facts


def test_bucketed_joins_equal_plain_ones_and_shuffle_no_fact(spark):
    """A hot id, null ids, ids without a match; the fact's side of both joins has no exchange."""
    fact = spark.range(3_000).select(
        F.when(F.col("id") % 10 > 0, F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 90)).alias("u"),
        "id", F.lit("s").alias("slice"),
    )
    one = spark.range(80).select(F.col("id").alias("u"), (F.col("id") * 2).alias("a"))
    two = spark.range(10, 95).select(F.col("id").alias("u"), (F.col("id") * 3).alias("b"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed(settle(fact), "u", 8, hot_rows=100) as laid:
            sizes = laid.rows.groupBy("u", laid.slice).count().filter("u IS NOT NULL")
            assert sizes.agg(F.max("count")).first()[0] < 250 and rows(laid.hot.filter("u IS NOT NULL")) == [(7, 10)]
            for how in ("left", "inner"):
                joined = laid.join([one, two], how)
                assert rows(joined) == rows(fact.join(one, "u", how).join(two, "u", how))
                # Both exchanges are those of the small tables; the fact comes from its buckets.
                plan = laid.join([one, two], how)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
                assert plan.count("Exchange hashpartitioning") == 2 and "Bucketed: true" in plan
                assert all("Bucketed" not in part.split("Range")[0] for part in plan.split("Exchange hashpartitioning")[1:])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# ------------------------------------------------------------------ files


def test_malformed_lines_are_kept(spark):
    path, aside = new_path(spark, "lines"), new_path(spark, "aside")
    good = ["p1,u1,5.0,10", "p2,u2,,", "\"p,3\",u3,1,3"]
    bad = ["p1,u1,five,10", "p1,u1", "a,b,1.0,2,3", "p1,u1,1.0,ten"]
    spark.createDataFrame([(x,) for x in good + bad], "value string").write.text(path)
    kept = readers.divert(spark, path, aside)
    assert sorted(r[0] for r in spark.read.text(aside).collect()) == sorted(bad)
    assert rows(kept) == sorted([("p1", "u1", 5.0, 10), ("p2", "u2", None, None), ("p,3", "u3", 1.0, 3)], key=repr)
    assert kept.schema == T.StructType(readers.RATING_SCHEMA.fields)


def test_a_failed_run_leaves_the_old_one(spark):
    base = new_path(spark, "runs")
    df = spark.range(100)
    writers.write_run(df, base, "a")
    writers.write_run(df.filter("id < 10"), base, "b")
    fails = F.udf(lambda x: x // (x - 50), "long")
    with pytest.raises(Exception):  # noqa: B017
        writers.write_run(df.select(fails("id").alias("id")), base, "b")
    count = lambda: {r.run: r["count"] for r in spark.read.parquet(base).groupBy("run").count().collect()}
    assert count() == {"a": 100, "b": 10}
    writers.write_run(df.filter("id < 3"), base, "b")
    assert count() == {"a": 100, "b": 3}
