"""Statistics, ranks, features and charts on small inputs."""

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteloom.operators import charts, features, ranking, relate, stats
from tasteloom.plans import explore
from tests.helpers import rows

SCHEMA = "user_id long, product_id long, rating double, ts long"


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def single(spark):
    return spark.createDataFrame([(1, 2, 3.0, 4)], SCHEMA)


def test_empty(empty):
    first = stats.basic_stats(empty).first()
    assert (first.total_users, first.total_ratings, first.avg_ratings_per_user) == (0, 0, 0.0)
    assert stats.median(empty).first().median is None
    assert stats.year_range(empty).first().earliest_year is None
    assert features.enrich(empty).count() == 0
    assert [r.rows for r in charts.bins(empty, "rating", 4).collect()] == [0, 0, 0, 0]


def test_single_row(single):
    user = features.user_features(single).first()
    assert (user.user_rating_stddev, user.user_activity_score) == (0.0, 1)
    assert stats.most_active(single).first().rating_stddev is None
    row = features.enrich(single).first()
    assert (row.interaction_frequency, row.user_rank, row.product_rank) == (0.0, 1, 1)
    assert features.scaled(single, "rating", "z").first().z == 0.0
    assert features.scaled(single, "rating", "z", floor=None).first().z is None
    assert [r.rows for r in charts.bins(single, "rating", 3).collect()] == [1, 0, 0]


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0, 1.0, 2.0, 2.0], [5.0, 1.0, 4.0, 4.0, 0.5]])
def test_median_is_the_lower_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "rating double")
    assert stats.median(df).first().median == statistics.median_low(values)


def test_approximate_median_has_a_small_rank_error(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("rating"))
    assert abs(stats.median(df, exact=False).first().median - 5_000) <= 100


def test_zscore_floor_and_weighting(ratings):
    values = [r.rating for r in ratings.collect()]
    mean, deviation = statistics.mean(values), statistics.stdev(values)
    got = features.scaled(ratings, "rating", "z").first()
    assert got.z == pytest.approx((got.rating - mean) / max(deviation, 1.0))
    users = features.user_features(ratings)
    activity = {r.user_id: r.user_activity_score for r in users.collect()}
    per_row = [activity[r.user_id] for r in ratings.collect()]
    for weighting, sample in (("rows", per_row), ("users", list(activity.values()))):
        one = features.with_frequency(users, weighting).filter("user_id = 1").first()
        expected = (activity[1] - statistics.mean(sample)) / max(statistics.stdev(sample), 1.0)
        assert one.interaction_frequency == pytest.approx(expected)


def test_unknown_names_are_errors(ratings):
    with pytest.raises(ValueError):
        features.scaled(ratings, "rating", "z", "log")
    with pytest.raises(ValueError):
        stats.by_period(ratings, "week")


def test_ranks_with_ties(spark):
    df = spark.createDataFrame(
        [(1, 1, 5.0), (1, 2, 5.0), (1, 3, 4.0), (1, 4, 3.0), (2, 1, 1.0), (2, 2, None), (2, 3, float("nan"))],
        "user_id long, product_id long, prediction double",
    )
    assert rows(ranking.top_k_with_ties(df, 1), "user_id", "product_id", "rank") == [
        (1, 1, 1), (1, 2, 1), (2, 1, 1),
    ]
    assert rows(ranking.top_k_with_ties(df, 3), "user_id", "product_id", "rank") == [
        (1, 1, 1), (1, 2, 1), (1, 3, 3), (2, 1, 1),
    ]
    exact = ranking.top_k(df.filter("user_id = 1"), 2)
    assert rows(exact, "product_id", "rank") == [(1, 1), (2, 2)]


def test_candidates(ratings):
    counts = {r.user_id: (r.seen, r.candidates) for r in relate.candidate_counts(ratings).collect()}
    assert counts == {1: (2, 2), 2: (2, 2), 3: (1, 3), 4: (1, 3)}
    assert rows(relate.candidates_of(ratings, 1)) == [(1, 12), (1, 13)]
    everything = ratings.select(F.lit(9).cast("long").alias("user_id"), "product_id", "rating", "ts")
    assert relate.products_not_rated(ratings.unionByName(everything), 9).count() == 0


def test_with_each_keeps_the_order(spark, ratings):
    short = spark.createDataFrame([("a", 1), ("b", 3), ("c", 2)], "name string, score long")
    out = relate.with_each(ratings.select("user_id").distinct(), short, [F.desc("score")])
    assert out.count() == 12
    assert rows(out.filter("user_id = 1"), "rank", "name") == [(1, "b"), (2, "c"), (3, "a")]


def test_density_integrates_to_about_one(spark):
    df = spark.range(1_000).select((F.randn(seed=1) * 2).alias("rating"))
    points = charts.kde(df, "rating", 400).orderBy("point").collect()
    step = points[1].x - points[0].x
    assert math.isclose(sum(p.density for p in points) * step, 1.0, abs_tol=0.02)


def plain_density(values, points=200):
    """The density of the values themselves at every point."""
    x = np.sort(np.array(values))
    width = x.std(ddof=1) * len(x) ** -0.2
    at = x[0] + np.arange(points) * (x[-1] - x[0]) / (points - 1)
    return np.array([np.exp(-0.5 * ((p - x) / width) ** 2).sum() for p in at]) / (len(x) * width * math.sqrt(2 * math.pi))


def test_density_equals_that_of_the_values(spark):
    df = spark.range(2_000).select((F.randn(seed=2) * 3).alias("prediction"))
    exact = plain_density([r[0] for r in df.collect()])
    close = charts.kde(df, "prediction", digits=12).orderBy("point").collect()
    assert np.abs(np.array([r.density for r in close]) - exact).max() < 1e-6 * exact.max()


def test_density_with_one_hot_user(spark):
    # Users with 1 to 19 rows and one with a third of all rows.
    score = F.when(F.col("id") == 0, 500_000).otherwise(F.col("id") % 19 + 1).cast("double")
    users = spark.range(100_000).select(score.alias("activity_score"))
    exact = plain_density([r[0] for r in users.collect()])
    close = charts.kde(users, "activity_score", digits=12).orderBy("point").collect()
    assert exact[0] > 0.002
    assert np.abs(np.array([r.density for r in close]) - exact).max() < 1e-4 * exact[0]


def test_density_without_spread_or_rows(spark):
    same = spark.range(5).select(F.lit(2.0).alias("rating"))
    assert {(r.x, r.density) for r in charts.kde(same, "rating", 3).collect()} == {(2.0, None)}
    assert charts.kde(same.limit(0)).collect() == []
    assert charts.kde(same.select(F.lit(None).cast("double").alias("rating"))).collect() == []


def test_heatmap_wide_has_the_cells_of_the_long_form(ratings):
    wide = {r.user_id: r.asDict() for r in charts.heatmap_wide(ratings, 3, 2).collect()}
    for cell in charts.heatmap(ratings, 3, 2).collect():
        assert wide[cell.user_id][str(cell.product_id)] == cell.mean_rating


def test_exploration_is_saved(spark, ratings, tmp_path):
    paths = explore.save_exploration(ratings, str(tmp_path))
    assert spark.read.csv(paths["top_rated_products"], schema="p long").count() == 0
    assert spark.read.csv(paths["user_activity"]).count() == 4
    assert spark.read.json(paths["summary"]).filter("metric = 'median'").first().value == 3.0


def test_report_without_timestamps(ratings):
    sections = {r.section for r in explore.explore_report(ratings.drop("ts")).collect()}
    assert sections == {"basic", "rating", "rating_value", "most_reviewed"}
    assert "ratings_per_year" not in explore.explore(ratings.drop("ts"))


def test_years_do_not_depend_on_the_time_zone(spark):
    df = spark.createDataFrame([(1.0, 946684799), (1.0, 946684800)], "rating double, ts long")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert rows(stats.by_period(df)) == [(1999, 1), (2000, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
