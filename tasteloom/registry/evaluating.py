"""Queries for metrics and chart tables."""

from __future__ import annotations

from tasteloom.operators import charts, evaluate, model, stats
from tasteloom.plans import explore, train
from tasteloom.registry import inputs
from tasteloom.registry.book import query
from tasteloom.registry.modelling import fitted
from tasteloom.shared import settle
from tasteloom.sources import feeds
from tasteloom.spread import spread_join

RMSE = "round(sqrt(avg((rating - prediction) ** 2)), 6)"
MAE = "round(avg(abs(rating - prediction)), 6)"
R2 = "round(1 - avg((rating - prediction) ** 2) / var_pop(rating), 6)"
HITS = "(SELECT count(*) FROM lists WHERE rating >= 4.0)"
RECOMMENDED = "(SELECT count(*) FROM lists)"
RELEVANT = "(SELECT count(*) FROM test WHERE rating >= 4.0)"
PRECISION = f"round({HITS} / greatest({RECOMMENDED}, 1), 6)"
RECALL = f"round({HITS} / greatest({RELEVANT}, 1), 6)"


def open_products(feed):
    return f"""SELECT count(*) AS total_products, count(*) FILTER (WHERE open) AS reachable_products,
        round(count(*) FILTER (WHERE open) / count(*) * 100, 2) AS coverage_pct
      FROM (SELECT product_id, count(DISTINCT user_id) < (SELECT count(DISTINCT user_id) FROM {feed}) AS open
            FROM {feed} GROUP BY 1)"""


LIST_COVERAGE = """SELECT t AS total_products, r AS recommended_products,
    round(r / t * 100, 2) AS coverage_pct
  FROM (SELECT count(DISTINCT product_id) AS t FROM train),
       (SELECT count(DISTINCT product_id) AS r FROM lists)"""
SPREAD = "SELECT round(coalesce(stddev_samp(prediction), 0), 6) AS diversity FROM predictions"


def _errors(spark, folder):
    return evaluate.error_metrics(inputs.predictions(spark, folder))


def _ranking(spark, folder):
    known, held_out = inputs.train_test(spark, folder)
    return evaluate.ranking_metrics(inputs.lists_of(inputs.predictions_of(known, held_out)), held_out)


@query("metric_rmse", f"SELECT count(*) AS scored, {RMSE} AS rmse FROM predictions")
def metric_rmse(spark, folder):
    return _errors(spark, folder).select("scored", "rmse")


@query("metric_mae", f"SELECT count(*) AS scored, {MAE} AS mae FROM predictions")
def metric_mae(spark, folder):
    return _errors(spark, folder).select("scored", "mae")


@query("metric_r2", f"SELECT count(*) AS scored, {R2} AS r2 FROM predictions")
def metric_r2(spark, folder):
    return _errors(spark, folder).select("scored", "r2")


@query(
    "precision_at_k",
    f"SELECT {RECOMMENDED} AS recommended, {HITS} AS hits, {PRECISION} AS precision",
)
def precision_at_k(spark, folder):
    return _ranking(spark, folder).select("recommended", "hits", "precision")


@query("recall_at_k", f"SELECT {RELEVANT} AS relevant, {HITS} AS hits, {RECALL} AS recall")
def recall_at_k(spark, folder):
    return _ranking(spark, folder).select("relevant", "hits", "recall")


@query("coverage_candidates", open_products("events_feed"))
def coverage_candidates(spark, folder):
    return evaluate.coverage_candidates(feeds.events_feed(spark, folder))


@query("coverage_topk", LIST_COVERAGE)
def coverage_topk(spark, folder):
    known, held_out = inputs.train_test(spark, folder)
    return evaluate.coverage_lists(inputs.lists_of(inputs.predictions_of(known, held_out)), known)


@query("diversity_stddev", SPREAD)
def diversity_stddev(spark, folder):
    return evaluate.score_spread(inputs.predictions(spark, folder))


@query(
    "prediction_yield",
    """SELECT count(*) AS test_rows, count(m) AS scored_rows, count(*) - count(m) AS cold_start_rows,
              round(count(m) / count(*) * 100, 2) AS scored_pct
       FROM test LEFT JOIN (SELECT product_id, avg(rating) AS m FROM train GROUP BY 1
                            HAVING count(rating) >= 24) USING (product_id)""",
)
def prediction_yield(spark, folder):
    known, held_out = inputs.train_test(spark, folder)
    scored = spread_join(held_out, model.mean_predictor(known, 24), ["product_id"], "left")
    return model.prediction_yield(held_out, scored, ["user_id", "product_id"])


def _metrics(pairs, section="metrics"):
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{name}' AS metric, cast(({value}) AS double) AS value"
        for name, value in pairs.items()
    )


REPORT = " UNION ALL ".join(
    [
        _metrics({"train_size": "SELECT count(*) FROM train", "test_size": "SELECT count(*) FROM test"},
                 "dataset"),
        _metrics(
            {
                "rmse": f"SELECT {RMSE} FROM predictions",
                "mae": f"SELECT {MAE} FROM predictions",
                "r2": f"SELECT {R2} FROM predictions",
                "precision_at_3": f"SELECT {PRECISION}",
                "recall_at_3": f"SELECT {RECALL}",
                "coverage": f"SELECT coverage_pct FROM ({open_products('train')})",
                "list_coverage": f"SELECT coverage_pct FROM ({LIST_COVERAGE})",
                "diversity": SPREAD,
            }
        ),
    ]
)


def _report(known, held_out, scored):
    return evaluate.evaluate(scored, inputs.lists_of(scored), known, held_out, inputs.LIST_LENGTH)


def _scored(spark, folder):
    known, held_out = inputs.train_test(spark, folder)
    return known, held_out, inputs.predictions_of(known, held_out)


@query("evaluation_report", REPORT)
def evaluation_report(spark, folder):
    return _report(*_scored(spark, folder))


@query("als_evaluation")
def als_evaluation(spark, folder):
    return train.evaluation_report(fitted(spark, folder), 10)


def bins_sql(column, source, n):
    """An n-bin histogram: every bin, with its edges and its rows."""
    return f"""SELECT cast(b AS int) AS bin, round(lo + b * ((hi - lo) / {n}), 6) AS lower,
        round(lo + (b + 1) * ((hi - lo) / {n}), 6) AS upper, coalesce(c, 0) AS rows
      FROM range({n}) g(b), (SELECT min({column}) AS lo, max({column}) AS hi FROM {source})
      LEFT JOIN (SELECT least(cast(floor(({column} - lo) / (hi - lo) * {n}) AS bigint), {n - 1}) AS k,
                        count(*) AS c
                 FROM {source}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {source})
                 GROUP BY 1) h ON h.k = b"""


RATING_BINS = f"""SELECT *, (SELECT round(avg(rating), 2) FROM events_feed) AS mean,
    (SELECT round(stddev_samp(rating), 2) FROM events_feed) AS std,
    (SELECT round(min(rating), 1) FROM events_feed) AS min,
    (SELECT round(max(rating), 1) FROM events_feed) AS max
  FROM ({bins_sql("rating", "events_feed", 20)})"""


def density_sql(column, source):
    """The density of the values themselves, without any grid."""
    return f"""SELECT cast(p AS int) AS point, round(lo + p * ((hi - lo) / 199), 6) AS x,
        round(sum(w * exp(-0.5 * ((lo + p * ((hi - lo) / 199) - v) / h) ** 2)
                  / (n * h * sqrt(2 * 3.141592653589793))), 5) AS density
      FROM range(200) g(p),
           (SELECT {column} AS v, count(*) AS w FROM {source} WHERE {column} IS NOT NULL GROUP BY 1),
           (SELECT min({column}) AS lo, max({column}) AS hi, count({column}) AS n,
                   stddev_samp({column}) * count({column}) ** (-0.2) AS h FROM {source})
      GROUP BY p, lo, hi"""


KDE = density_sql("rating", "events_feed")
TOP = """SELECT product_id, count(rating) AS review_count, round(avg(rating), 4) AS avg_rating
  FROM {feed} GROUP BY 1 HAVING count(rating) >= 5
  ORDER BY avg_rating DESC, review_count DESC, product_id LIMIT 20"""
USERS = """(SELECT user_id, cast(count(rating) AS double) AS activity_score,
    round(avg(rating), 4) AS avg_rating FROM {feed} GROUP BY 1)"""


def user_density_sql(feed):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS chart, * FROM ({density_sql(c, USERS.format(feed=feed))})"
        for c in ("activity_score", "avg_rating")
    )


def activity_sql(feed):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS chart, * FROM ({bins_sql(c, USERS.format(feed=feed), 20)})"
        for c in ("activity_score", "avg_rating")
    )


def heatmap_sql(feed):
    return f"""SELECT user_id, product_id, round(avg(rating), 4) AS mean_rating FROM {feed}
      WHERE user_id IN (SELECT user_id FROM {feed} GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 50)
        AND product_id IN (SELECT product_id FROM {feed} GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 50)
      GROUP BY 1, 2"""


GROUPS = f"""SELECT CASE WHEN metric IN ('rmse', 'mae') THEN 'error' ELSE 'ranking' END AS chart,
    metric, value FROM ({REPORT})
  WHERE metric IN ('rmse', 'mae', 'precision_at_3', 'recall_at_3')"""
SCORE_BINS = f"""SELECT *, (SELECT round(avg(prediction), 4) FROM predictions) AS mean
  FROM ({bins_sql("prediction", "predictions", 30)})"""


@query("chart_rating_bins", RATING_BINS)
def chart_rating_bins(spark, folder):
    return charts.rating_bins(feeds.events_feed(spark, folder))


@query("chart_rating_kde", KDE)
def chart_rating_kde(spark, folder):
    return charts.kde(feeds.events_feed(spark, folder))


@query("chart_user_density", user_density_sql("orders_feed"))
def chart_user_density(spark, folder):
    users = settle(stats.user_stats(feeds.orders_feed(spark, folder), ordered=False), "users")
    return charts.activity_densities(users)


@query("chart_score_density", density_sql("prediction", "predictions"))
def chart_score_density(spark, folder):
    return charts.score_density(inputs.predictions(spark, folder))


@query("chart_top_products", TOP.format(feed="events_feed"))
def chart_top_products(spark, folder):
    return stats.top_rated(feeds.events_feed(spark, folder))


@query("chart_user_activity", activity_sql("orders_feed"))
def chart_user_activity(spark, folder):
    return charts.activity_bins(stats.user_stats(feeds.orders_feed(spark, folder), ordered=False))


@query("chart_heatmap", heatmap_sql("events_feed"))
def chart_heatmap(spark, folder):
    return charts.heatmap(feeds.events_feed(spark, folder))


@query("chart_heatmap_wide")
def chart_heatmap_wide(spark, folder):
    return charts.heatmap_wide(feeds.events_feed(spark, folder))


@query("chart_metrics", GROUPS)
def chart_metrics(spark, folder):
    return charts.metric_groups(_report(*_scored(spark, folder)))


@query("chart_score_bins", SCORE_BINS)
def chart_score_bins(spark, folder):
    return charts.score_bins(inputs.predictions(spark, folder))


@query(
    "chart_bundle",
    f"""SELECT 'rating_bins' AS chart, lower AS x, cast(rows AS double) AS y FROM ({RATING_BINS})
        UNION ALL SELECT 'rating_density', x, density FROM ({KDE})
        UNION ALL SELECT 'top_products', cast(product_id AS double), avg_rating
                  FROM ({TOP.format(feed="events_feed")})
        UNION ALL SELECT 'user_activity:' || chart, lower, cast(rows AS double)
                  FROM ({activity_sql("events_feed")})
        UNION ALL SELECT 'user_density:' || chart, x, density FROM ({user_density_sql("events_feed")})
        UNION ALL SELECT 'score_density', x, density FROM ({density_sql("prediction", "predictions")})
        UNION ALL SELECT 'heatmap:' || user_id, cast(product_id AS double), mean_rating
                  FROM ({heatmap_sql("events_feed")})
        UNION ALL SELECT 'score_bins', lower, cast(rows AS double) FROM ({SCORE_BINS})
        UNION ALL SELECT 'metrics:' || chart || ':' || metric, 0.0, value FROM ({GROUPS})""",
)
def chart_bundle(spark, folder):
    known, held_out, scored = _scored(spark, folder)
    report = _report(known, held_out, scored)
    return explore.chart_points(explore.chart_tables(feeds.events_feed(spark, folder), scored, report))
