"""Metrics of predictions and of recommendation lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.functions.scalar import at_least_one
from tasteloom.operators.clean import relevant, scored_only
from tasteloom.operators.relate import hits


def _rows(df: DataFrame) -> Column:
    """The row count of ``df`` as a one-row subquery."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def _error_figures(rating: str = "rating") -> list[Column]:
    y, p = F.col(rating).cast("double"), F.col("prediction").cast("double")
    return [
        F.avg((y - p) ** 2).alias("mse"),
        F.avg(F.abs(y - p)).alias("mean_error"),
        F.var_pop(y).alias("spread"),
    ]


def _errors() -> list[Column]:
    """RMSE, MAE and R2 from the figures."""
    return [
        F.round(F.sqrt("mse"), 6).alias("rmse"),
        F.round("mean_error", 6).alias("mae"),
        F.round(1 - F.try_divide(F.col("mse"), F.col("spread")), 6).alias("r2"),
    ]


def _precision_recall() -> list[Column]:
    return [
        F.round(F.col("hits") / at_least_one(F.col("recommended")), 6).alias("precision"),
        F.round(F.col("hits") / at_least_one(F.col("relevant")), 6).alias("recall"),
    ]


def error_metrics(predictions: DataFrame, rating: str = "rating") -> DataFrame:
    """RMSE, MAE and R2 in one aggregation."""
    figures = scored_only(predictions).agg(F.count(F.lit(1)).alias("scored"), *_error_figures(rating))
    return figures.select("scored", *_errors())


def ranking_metrics(recs: DataFrame, test: DataFrame, threshold: float = 4.0) -> DataFrame:
    """Precision and recall of the lists in ``recs``, over all users together.

    Relevant test rows that no list could contain still count for recall.
    """
    found = hits(recs, test, threshold)
    return (
        recs.agg(F.count(F.lit(1)).alias("recommended"))
        .select(
            "recommended",
            _rows(found).alias("hits"),
            _rows(relevant(test, threshold)).alias("relevant"),
        )
        .select("*", *_precision_recall())
    )


def _coverage(reached: Column, total: Column) -> Column:
    return F.round(reached / at_least_one(total) * 100, 2)


def _open_products(train: DataFrame) -> DataFrame:
    """Every product with its rows and whether some user has not rated it.

    Raters are counted; the pairs of users and products are never formed.
    """
    everybody = train.agg(F.count_distinct("user_id").alias("n")).scalar()
    raters = train.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("raters")
    )
    return raters.withColumn("open", F.col("raters") < everybody)


def coverage_candidates(train: DataFrame) -> DataFrame:
    """Products that are an unseen candidate for at least one user."""
    return (
        _open_products(train)
        .agg(
            F.count(F.lit(1)).alias("total_products"),
            F.count_if("open").alias("reachable_products"),
        )
        .withColumn("coverage_pct", _coverage(F.col("reachable_products"), F.col("total_products")))
    )


def coverage_lists(recs: DataFrame, train: DataFrame) -> DataFrame:
    """Products of the catalogue that occur in at least one list."""
    total = train.agg(F.count_distinct("product_id").alias("n")).scalar()
    return (
        recs.agg(F.count_distinct("product_id").alias("recommended_products"))
        .select(total.alias("total_products"), "recommended_products")
        .withColumn("coverage_pct", _coverage(F.col("recommended_products"), F.col("total_products")))
    )


def _diversity() -> Column:
    spread = F.stddev_samp(F.col("prediction").cast("double"))
    return F.round(F.coalesce(spread, F.lit(0.0)), 6).alias("diversity")


def score_spread(predictions: DataFrame) -> DataFrame:
    """Standard deviation of the predictions; 0 when there are fewer than two."""
    return scored_only(predictions).agg(_diversity())


def long_form(section: str, one_row: DataFrame, columns: dict[str, str]) -> DataFrame:
    """A one-row table as rows of (section, metric, value)."""
    pairs = [
        F.struct(F.lit(name).alias("metric"), F.col(column).cast("double").alias("value"))
        for column, name in columns.items()
    ]
    return one_row.select(F.lit(section).alias("section"), F.explode(F.array(*pairs)).alias("r")).select(
        "section", "r.*"
    )


def _side_by_side(parts: Sequence[DataFrame]) -> DataFrame:
    """The figures of several one-row tables in one row; each table is worked out once."""
    named = [long_form("", p, {c: c for c in p.columns}) for p in parts]
    names = [c for p in parts for c in p.columns]
    figure = [F.max(F.when(F.col("metric") == c, F.col("value"))).alias(c) for c in names]
    return reduce(DataFrame.unionByName, named).agg(*figure)


def evaluate(
    predictions: DataFrame, recs: DataFrame, train: DataFrame, test: DataFrame, k: int = 10,
    threshold: float = 4.0,
) -> DataFrame:
    """Sizes and all metrics as (section, metric, value).

    Each input is read once for all of its figures, and once more where pairs are compared
    (``recs`` and ``test``) or all users counted (``train``).
    """
    rows = F.count(F.lit(1))
    figures = _side_by_side(
        [
            scored_only(predictions).agg(*_error_figures(), _diversity()),
            recs.agg(rows.alias("recommended"), F.count_distinct("product_id").alias("listed")),
            hits(recs, test, threshold).agg(rows.alias("hits")),
            test.agg(rows.alias("test_size"), F.count_if(F.col("rating") >= threshold).alias("relevant")),
            _open_products(train).agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("train_size"),
                rows.alias("products"),
                F.count("product_id").alias("known_products"),
                F.count_if("open").alias("reachable"),
            ),
        ]
    )
    metrics = figures.select(
        "*",
        *_errors(),
        *_precision_recall(),
        _coverage(F.col("reachable"), F.col("products")).alias("coverage"),
        _coverage(F.col("listed"), F.col("known_products")).alias("list_coverage"),
    )
    names = {
        "train_size": "train_size", "test_size": "test_size", "rmse": "rmse", "mae": "mae", "r2": "r2",
        "precision": f"precision_at_{k}", "recall": f"recall_at_{k}",
        "coverage": "coverage", "list_coverage": "list_coverage", "diversity": "diversity",
    }
    section = F.when(F.col("metric").endswith("_size"), "dataset").otherwise("metrics")
    return long_form("metrics", metrics, names).withColumn("section", section)
