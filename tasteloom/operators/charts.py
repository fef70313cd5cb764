"""The tables behind the charts, aggregated on the cluster."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.operators.ranking import top_n
from tasteloom.operators.relate import of_top_entities

GRID = 1_024  # grid cells a bandwidth
REACH = 8  # bandwidths beyond which a value does not count: its part there is below 1e-13


def bins(df: DataFrame, column: str, n: int, figures: Mapping[str, Column] | None = None) -> DataFrame:
    """An ``n``-bin histogram from minimum to maximum; the last bin is closed.

    Empty bins are listed.  Without any spread all rows fall into the first bin.
    ``figures`` are aggregates of ``x``, the column's value, repeated on every bin; they
    share one pass with the minimum and the maximum.
    """
    value = F.col(column).cast("double")
    known = df.filter(value.isNotNull()).select(value.alias("x"))
    wanted = {"_lo": F.min("x"), "_hi": F.max("x"), **(figures or {})}
    stats = known.agg(*[c.alias(name) for name, c in wanted.items()])
    one = stats.select(F.struct("*").alias("one")).scalar()
    low, high = one["_lo"], one["_hi"]
    place = F.coalesce(F.floor(F.try_divide(F.col("x") - low, high - low) * n), F.lit(0).cast("long"))
    placed = known.select(F.least(place, F.lit(n - 1).cast("long")).alias("bin"))
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("_n"))
    grid = df.sparkSession.range(n).select(F.col("id").alias("bin"))
    step = (high - low) / n
    return grid.join(F.broadcast(counts), "bin", "left").select(
        F.col("bin").cast("int").alias("bin"),
        F.round(low + F.col("bin") * step, 6).alias("lower"),
        F.round(low + (F.col("bin") + 1) * step, 6).alias("upper"),
        F.coalesce("_n", F.lit(0).cast("long")).alias("rows"),
        *[one[name].alias(name) for name in figures or {}],
    )


def rating_bins(df: DataFrame, column: str = "rating", n: int = 20) -> DataFrame:
    """The rating histogram, with the figures of the text box on every bin."""
    figures = {
        "mean": F.round(F.avg("x"), 2),
        "std": F.round(F.stddev_samp("x"), 2),
        "min": F.round(F.min("x"), 1),
        "max": F.round(F.max("x"), 1),
    }
    return bins(df, column, n, figures)


def kde(df: DataFrame, column: str = "rating", points: int = 200, digits: int = 5) -> DataFrame:
    """Gaussian density at evenly spaced points from minimum to maximum; Scott's rule sets the bandwidth.

    Every value gives its weight to the two nearest edges of a grid of ``GRID`` cells a
    bandwidth, in proportion to its nearness (linear binning), so the error is about one part in 8 * GRID ** 2.
    Only edges that hold weight are rows, whatever the range: one far value adds two.  An edge
    meets the points within ``REACH`` bandwidths, found from their numbers, and tasks send a sum per point.
    Without any spread the density is null, as the bandwidth is zero.
    """
    x = F.col(column).cast("double")
    known = df.filter(x.isNotNull()).select(x.alias("x"))
    figures = known.agg(
        F.count(F.lit(1)).alias("n"),
        F.stddev_samp("x").alias("s"),
        F.min("x").alias("lo"),
        F.max("x").alias("hi"),
    )
    one = figures.select(F.struct("*").alias("one")).scalar()
    n, low = one["n"], one["lo"]
    step = (one["hi"] - low) / (points - 1)
    width = F.nullif(one["s"] * F.pow(n.cast("double"), F.lit(-0.2)), F.lit(0.0))
    cell = width / GRID
    place = known.select(((F.col("x") - low) / cell).alias("p")).filter(F.col("p").isNotNull())
    share = F.col("p") - F.floor("p")
    edges = place.select(
        F.inline(
            F.array(
                F.struct(F.floor("p").alias("edge"), (1 - share).alias("w")),
                F.struct((F.floor("p") + 1).alias("edge"), share.alias("w")),
            )
        )
    ).groupBy("edge").agg(F.sum("w").alias("w"))
    at = F.col("edge") * cell
    first = F.greatest(F.ceil((at - REACH * width) / step), F.lit(0).cast("long"))
    last = F.least(F.floor((at + REACH * width) / step), F.lit(points - 1).cast("long"))
    near = edges.select("edge", "w", first.alias("first"), last.alias("last")).filter("first <= last")
    met = near.select("edge", "w", F.explode(F.sequence("first", "last")).alias("id"))
    bell = F.exp(-0.5 * F.pow((F.col("id") * step - F.col("edge") * cell) / width, F.lit(2.0)))
    sums = met.select("id", (F.col("w") * bell).alias("y")).groupBy("id").agg(F.sum("y").alias("y"))
    scale = n * width * F.lit((2 * 3.141592653589793) ** 0.5)
    grid = df.sparkSession.range(points).filter(n > 0)
    return grid.join(F.broadcast(sums), "id", "left").select(
        F.col("id").cast("int").alias("point"),
        F.round(low + F.col("id") * step, 6).alias("x"),
        F.round(F.coalesce("y", F.lit(0.0)) / scale, digits).alias("density"),
    )


def activity_bins(users: DataFrame, n: int = 20) -> DataFrame:
    """Histograms of the users' rating counts and of their average ratings."""
    def part(column: str) -> DataFrame:
        return bins(users, column, n).select(F.lit(column).alias("chart"), "*")

    return part("activity_score").unionByName(part("avg_rating"))


def activity_densities(users: DataFrame) -> DataFrame:
    """Density curves of the users' rating counts and of their average ratings."""
    def part(column: str) -> DataFrame:
        return kde(users, column).select(F.lit(column).alias("chart"), "*")

    return part("activity_score").unionByName(part("avg_rating"))


def score_density(predictions: DataFrame) -> DataFrame:
    """The density curve of the predictions."""
    return kde(predictions, "prediction")


def _largest(df: DataFrame, key: str, n: int) -> DataFrame:
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return top_n(counts, [F.desc("_n"), F.col(key)], n).select(key)


def heatmap(df: DataFrame, users: int = 50, products: int = 50) -> DataFrame:
    """Mean rating of the most active users for the most rated products."""
    kept = of_top_entities(df, _largest(df, "user_id", users), _largest(df, "product_id", products))
    return kept.groupBy("user_id", "product_id").agg(F.round(F.avg("rating"), 4).alias("mean_rating"))


def heatmap_wide(df: DataFrame, users: int = 50, products: int = 50) -> DataFrame:
    """The heatmap with one column per product (at most ``products`` columns)."""
    cells = heatmap(df, users, products)
    names = [r[0] for r in cells.select("product_id").distinct().orderBy("product_id").collect()]
    return cells.groupBy("user_id").pivot("product_id", names).agg(F.first("mean_rating"))


def metric_groups(report: DataFrame) -> DataFrame:
    """The error metrics and the ranking metrics of an evaluation report."""
    metric = F.col("metric")
    group = F.when(metric.isin("rmse", "mae"), F.lit("error")).when(
        metric.contains("precision") | metric.contains("recall"), F.lit("ranking")
    )
    return report.select(group.alias("chart"), "metric", "value").filter(F.col("chart").isNotNull())


def score_bins(predictions: DataFrame, n: int = 30) -> DataFrame:
    """The histogram of the predictions, with their mean on every bin."""
    return bins(predictions, "prediction", n, {"mean": F.round(F.avg("x"), 4)})
