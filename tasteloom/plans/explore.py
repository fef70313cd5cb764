"""All exploratory tables of a feed, and their scalar figures as one report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.functions.scalar import utc_day, year_of
from tasteloom.operators import charts, stats
from tasteloom.operators.evaluate import long_form
from tasteloom.shared import settle
from tasteloom.sources.writers import write_csv, write_csv_single, write_report


def explore(df: DataFrame) -> dict[str, DataFrame]:
    """Every exploratory table by name; nothing runs until a table is used."""
    tables = {
        "basic_statistics": stats.basic_stats(df),
        "rating_distribution": stats.rating_summary(df),
        "rating_value_counts": stats.rating_histogram(df),
        "top_rated_products": stats.top_rated(df),
        "most_active_users": stats.most_active(df),
        "most_reviewed_products": stats.most_reviewed(df),
        "product_popularity": stats.product_stats(df),
        "user_activity": stats.user_stats(df),
    }
    if "ts" in df.columns:
        tables["ratings_per_year"] = stats.by_period(df, "year")
        tables["ratings_per_month"] = stats.by_period(df, "month")
        tables["year_range"] = stats.year_range(df)
    return tables


def explore_report(df: DataFrame) -> DataFrame:
    """The scalar figures and the short histograms as (section, metric, value).

    The feed is read three times: once for all scalar figures, once for the rows per
    rating and month, from which all histograms and the median follow, and once for the products with most ratings.
    """
    timed = "ts" in df.columns
    figures = [*stats.basic_counts(), *stats.summary_figures()]
    groups = {"rating": F.col("rating")}
    sections = {
        "basic": ["total_users", "total_products", "total_ratings",
                  "avg_ratings_per_user", "avg_ratings_per_product", "sparsity"],
        "rating": ["count", "mean", "stddev", "min", "max"],
    }
    if timed:
        figures += stats.year_figures()
        groups["year"] = year_of(F.col("ts"))
        groups["month"] = F.date_format(utc_day(F.col("ts")), "yyyy-MM")
        sections["time"] = ["earliest_year", "latest_year"]
    scalars = df.agg(*figures).select("*", *stats.basic_ratios())
    entries = [
        F.struct(
            F.lit(section).alias("section"),
            F.lit(name).alias("metric"),
            F.col(name).cast("double").alias("value"),
        )
        for section, names in sections.items()
        for name in names
    ]
    out = scalars.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    counts = settle(
        df.select(*[c.alias(name) for name, c in groups.items()])
        .groupBy(*groups)
        .agg(F.count(F.lit(1)).alias("rows"))
    )

    def counted(section: str, key: str) -> DataFrame:
        return counts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum("rows").alias("n")).select(
            F.lit(section).alias("section"),
            F.col(key).cast("string").alias("metric"),
            F.col("n").cast("double").alias("value"),
        )

    values = counts.filter(F.col("rating").isNotNull()).groupBy("rating").agg(F.sum("rows").alias("n"))
    out = out.unionByName(
        long_form("rating", stats.median_of_counts(values, "rating", "n"), {"median": "median"})
    ).unionByName(counted("rating_value", "rating"))
    top = stats.most_reviewed(df).select(
        F.lit("most_reviewed").alias("section"),
        F.col("product_id").cast("string").alias("metric"),
        F.col("review_count").cast("double").alias("value"),
    )
    out = out.unionByName(top)
    return out.unionByName(counted("year", "year")).unionByName(counted("month", "month")) if timed else out


def save_exploration(df: DataFrame, base: str) -> dict[str, str]:
    """Write the top lists as single CSV files, the full tables as distributed CSV
    and the report as JSON."""
    tables = explore(df)
    paths = {}
    for name in ("top_rated_products", "most_active_users"):
        paths[name] = write_csv_single(tables[name], f"{base}/{name}", rows=20, header=False)
    for name in ("product_popularity", "user_activity"):
        paths[name] = write_csv(tables[name], f"{base}/{name}")
    paths["summary"] = write_report(explore_report(df), f"{base}/summary")
    return paths


def chart_tables(ratings: DataFrame, predictions: DataFrame, report: DataFrame) -> dict[str, DataFrame]:
    """One table per chart.

    The ratings' columns and the users' figures are written once, since several charts read them.
    """
    ratings = settle(ratings.select("user_id", "product_id", "rating"), "ratings")
    users = settle(stats.user_stats(ratings, ordered=False), "users")
    return {
        "rating_bins": charts.rating_bins(ratings),
        "rating_density": charts.kde(ratings),
        "top_products": stats.top_rated(ratings),
        "user_activity": charts.activity_bins(users),
        "user_density": charts.activity_densities(users),
        "heatmap": charts.heatmap(ratings),
        "score_bins": charts.score_bins(predictions),
        "score_density": charts.score_density(predictions),
        "metrics": charts.metric_groups(report),
    }


def chart_points(tables: dict[str, DataFrame]) -> DataFrame:
    """All charts in one table of (chart, x, y) points."""
    axes = {
        "rating_bins": ("lower", "rows"),
        "rating_density": ("x", "density"),
        "top_products": ("product_id", "avg_rating"),
        "user_activity": ("lower", "rows"),
        "user_density": ("x", "density"),
        "heatmap": ("product_id", "mean_rating"),
        "score_bins": ("lower", "rows"),
        "score_density": ("x", "density"),
        "metrics": ("metric", "value"),
    }
    out = None
    for name, table in tables.items():
        x, y = axes[name]
        if name in ("user_activity", "user_density", "metrics"):
            label = F.concat(F.lit(f"{name}:"), F.col("chart"))
        elif name == "heatmap":
            label = F.concat(F.lit("heatmap:"), F.col("user_id").cast("string"))
        else:
            label = F.lit(name)
        numeric = name != "metrics"
        part = table.select(
            (label if numeric else F.concat(label, F.lit(":"), F.col(x))).alias("chart"),
            (F.col(x).cast("double") if numeric else F.lit(0.0)).alias("x"),
            F.col(y).cast("double").alias("y"),
        )
        out = part if out is None else out.unionByName(part)
    return out
