"""Cleaning operators and their edge cases."""

import itertools

import pytest
from pyspark.sql import functions as F

from tasteloom.operators import clean, profile
from tasteloom.sources import feeds
from tests.helpers import rows

SCHEMA = "user_id string, product_id string, rating double, ts long"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_bounds_are_inclusive_and_gaps_are_dropped(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.5, 5.0, 5.5, float("nan"), None)], "rating double")
    assert rows(clean.in_range(df)) == [(0.5,), (5.0,)]


def test_malformed_ids_are_rejected(spark):
    df = frame(spark, ("A1HGH7NF01K3W7", "1", 3.0, 1), ("007", "2", 3.0, 1), ("", "3", 3.0, 1))
    kept = clean.coerce(df, {"user_id": "int", "product_id": "int"}, clean.REQUIRED)
    assert rows(kept, "user_id", "product_id") == [(7, 2)]
    assert clean.coerce(df, {"user_id": "int"}).filter("user_id is null").count() == 2


def test_latest_breaks_ties_by_rating(spark):
    df = frame(spark, ("1", "1", 2.0, 9), ("1", "1", 4.0, 9), ("1", "1", 5.0, 8), ("1", "1", 1.0, None))
    assert rows(clean.dedup(df), "rating", "ts") == [(4.0, 9)]


def test_modes(ratings):
    twice = ratings.unionByName(ratings)
    assert clean.dedup(twice, "exact").count() == 7
    assert clean.dedup(twice, "any").count() == 6
    with pytest.raises(ValueError):
        clean.dedup(ratings, "first")


def test_unknown_strategies_are_errors():
    with pytest.raises(ValueError):
        clean.CleanRules(nulls="impute")
    with pytest.raises(ValueError):
        clean.CleanRules(duplicates="any")


def test_missing_columns_are_left_out(ratings):
    assert clean.pick(ratings.drop("ts", "rating")).columns == ["user_id", "product_id"]


def test_empty_input(spark):
    empty = frame(spark).filter("false")
    assert clean.clean(empty).count() == 0
    assert [r.rows_left for r in clean.clean_audit(empty).collect()] == [0, 0, 0, 0]
    assert rows(profile.duplicate_rows(empty)) == [(0, 0, 0, None)]
    assert {r.distinct_count for r in profile.profile(empty).collect()} == {0}


def test_all_null_column(spark):
    df = frame(spark, (None, "1", 1.0, 1), (None, "2", 1.0, 1))
    found = {r.column_name: r for r in profile.profile(df).collect()}
    assert (found["user_id"].null_pct, found["user_id"].distinct_count) == (100.0, 1)
    assert [r.column_name for r in profile.critical_nulls(df).collect()] == ["user_id"]


@pytest.mark.parametrize(
    "nulls, duplicates, first",
    list(itertools.product(["any", "keys"], ["latest", "exact"], [False, True])),
)
def test_audit_counts_what_clean_removes(spark, small, nulls, duplicates, first):
    rules = clean.CleanRules(nulls=nulls, duplicates=duplicates, filter_first=first)
    df = feeds.dirty_feed(spark, small)
    audit = clean.clean_audit(df, rules).orderBy("step_no").collect()
    assert audit[-1].rows_left == clean.clean(df, rules).count()
    assert sum(r.removed for r in audit) + audit[-1].rows_left == df.count()
    kept = clean.without_nulls(clean.pick(df), None if nulls == "any" else clean.REQUIRED)
    assert audit[0].rows_left == kept.count()
    if first:
        kept = clean.in_range(kept)
        assert audit[1].rows_left == kept.count()
    duplicate = next(r for r in audit if r.step == "duplicate")
    assert duplicate.rows_left == clean.dedup(kept, duplicates).count()


@pytest.mark.parametrize(
    "nulls, duplicates, first",
    list(itertools.product(["any", "keys"], ["latest", "exact"], [False, True])),
)
@pytest.mark.parametrize("kind", ["double", "string"])
def test_audit_agrees_on_values_at_the_edges(spark, kind, nulls, duplicates, first):
    """Ratings that the cast rounds into the range, texts that cannot be cast, ids beyond int."""
    rules = clean.CleanRules(nulls=nulls, duplicates=duplicates, filter_first=first)
    ratings = ["5.00000001", "0.4999999999", "5.1", "3", "3", None]
    if kind == "string":
        ratings += ["abc", "", "4"]
    rows_ = [(str(i % 7), "1", r, i) for i, r in enumerate(ratings)]
    rows_ += [("99999999999", "1", "4", 1), ("x", "1", "4", None), ("1", "1", "4", 0)]
    df = spark.createDataFrame(rows_, "user_id string, product_id string, rating string, ts long")
    df = df.withColumn("rating", F.col("rating").cast(kind))
    audit = clean.clean_audit(df, rules).orderBy("step_no").collect()
    assert audit[-1].rows_left == clean.clean(df, rules).count()
    assert sum(r.removed for r in audit) + audit[-1].rows_left == df.count()


def test_sample_by_key_is_stable(spark, small):
    df = feeds.events_feed(spark, small)
    once = rows(clean.sample_by_key(df, ["event_id"], 20))
    assert once == rows(clean.sample_by_key(df.repartition(5), ["event_id"], 20))


def test_scored_only(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "prediction double")
    assert rows(clean.scored_only(df)) == [(1.0,)]


def test_fill(spark):
    df = frame(spark, ("1", None, None, None))
    assert rows(clean.fill_numbers(df)) == [("1", None, 0.0, 0)]
    assert clean.fill_column(df, "rating", 2.0).first().rating == 2.0


def test_relevant_and_positive(spark):
    df = spark.createDataFrame([(4.0,), (3.5,), (0.0,), (-1.0,)], "rating double")
    assert clean.relevant(df).count() == 1
    assert clean.positive(df).count() == 2
    assert clean.of_entity(df, "rating", 3.5).count() == 1
    assert df.filter(F.col("rating") > 0).count() == 2
