"""Physical plans: pushdown, early cuts, no pairs of everything, no single big task."""

import re

import pytest

from tasteloom.operators import clean, features, profile, ranking, relate, stats
from tasteloom.registry import BOOK
from tasteloom.sources import feeds
from tests.helpers import plan_of

# Queries that join, rank or scale.
JOINING = [
    "anti_join_seen", "chart_bundle", "chart_heatmap", "chart_rating_kde", "coverage_candidates",
    "cross_candidates", "cross_one_user", "encode_frequency", "enrich_image", "evaluation_report",
    "feature_table", "flatten_recommendations", "interaction_frequency", "join_hits", "join_id_map",
    "join_product_features", "median_exact", "normalize_zscore", "prediction_yield",
    "rank_features", "recommend_one_user", "recommend_popular", "recommend_unseen",
    "rownum_latest", "semi_top_entities", "serve_filter_sort_page", "serve_with_fallback",
    "subtract_seen", "topk_rank_per_user", "user_rank",
]


@pytest.fixture
def large(spark):
    """Plan joins as if no table were small enough to broadcast by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", JOINING)
def test_no_nested_loops(spark, small, large, name):
    plan = plan_of(BOOK[name].run(spark, small))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_columns_and_filters_reach_the_scan(spark, small):
    plan = plan_of(clean.of_entity(feeds.orders_feed(spark, small), "user_id", 42).select("user_id"))
    assert "EqualTo(o_custkey,42)" in plan
    assert "l_extendedprice" not in plan and "l_quantity" not in plan


def test_dedup_and_top_k_cut_before_the_shuffle(spark, small):
    feed = feeds.orders_feed(spark, small)
    for df in (clean.dedup(feed), ranking.top_k(feed.withColumnRenamed("rating", "prediction"), 3)):
        plan = plan_of(df)
        assert plan.count("WindowGroupLimit") >= 2


def test_profile_and_audit_scan_once(spark, small):
    feed = feeds.dirty_feed(spark, small)
    for df in (profile.profile(feed), clean.clean_audit(feed), profile.nulls(feed)):
        plan = plan_of(df)
        assert len(re.findall(r"Scan parquet", plan.split("\n\n\n")[0])) == 1


def test_features_are_not_forced_into_a_broadcast(spark, small, large):
    feed = feeds.orders_feed(spark, small)
    plan = plan_of(relate.attach(feed, features.user_features(feed), "user_id"))
    assert "SortMergeJoin" in plan


def test_top_lists_need_no_global_sort(spark, small):
    plan = plan_of(stats.top_rated(feeds.orders_feed(spark, small)))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
