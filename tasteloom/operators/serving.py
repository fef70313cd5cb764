"""Tables for serving recommendations: lists, names, categories, prices, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.functions.catalog import PICTURE_PATH, category_of, placeholder_of, price_of
from tasteloom.functions.scalar import steady_round
from tasteloom.operators.ranking import top_n
from tasteloom.operators.relate import with_each
from tasteloom.spread import spread_join


def users_list(recs: DataFrame) -> DataFrame:
    """All users with recommendations, as text, sorted."""
    return recs.select(F.col("user_id").cast("string").alias("user_id")).distinct().orderBy("user_id")


def lists_or_fallback(recs: DataFrame, requested: DataFrame, fallback: int = 50) -> DataFrame:
    """The lists of the requested users; users without one get the best rows overall."""
    wanted = requested.select("user_id").distinct()
    own = recs.join(wanted, "user_id", "left_semi").select(
        "user_id", "product_id", "rating", F.lit(False).alias("is_fallback")
    )
    order = [F.desc("rating"), F.col("product_id"), F.col("source_user")]
    best = top_n(recs.select("product_id", "rating", F.col("user_id").alias("source_user")), order, fallback)
    others = wanted.join(recs.select("user_id").distinct(), "user_id", "left_anti")
    filled = with_each(others, best, order).select(
        "user_id", "product_id", "rating", F.lit(True).alias("is_fallback")
    )
    return own.unionByName(filled)


def with_names(recs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Add the product names; a product in everybody's list is a hot key."""
    return spread_join(recs, catalogue.select("product_id", "product_name"), ["product_id"], "left")


def with_category(recs: DataFrame) -> DataFrame:
    return recs.withColumn("category", category_of(F.col("product_name")))


def with_price(recs: DataFrame) -> DataFrame:
    return recs.withColumn("price", price_of(F.col("category"), F.col("product_id")))


def _pictured(manifest: DataFrame) -> DataFrame:
    return manifest.select("product_id").distinct().withColumn("_own", F.lit(True))


def with_picture(recs: DataFrame, manifest: DataFrame) -> DataFrame:
    """The product's own picture if the manifest has one, else the category's."""
    return _with_url(spread_join(recs, _pictured(manifest), ["product_id"], "left"))


def _with_url(marked: DataFrame) -> DataFrame:
    before, after = PICTURE_PATH.split("{}")
    own = F.concat(F.lit(before), F.col("product_id").cast("string"), F.lit(after))
    return marked.withColumn(
        "image_url", F.when(F.col("_own"), own).otherwise(placeholder_of(F.col("category")))
    ).drop("_own")


def enriched(recs: DataFrame, catalogue: DataFrame, manifest: DataFrame) -> DataFrame:
    """Name, category, price and picture for every recommendation."""
    # Names and pictures have the same key, so they are one table, joined once.
    names = catalogue.select("product_id", "product_name").join(_pictured(manifest), "product_id", "full")
    named = spread_join(recs, names, ["product_id"], "left")
    return _with_url(with_price(with_category(named)))


def pages(
    recs: DataFrame,
    category: str = "All",
    text: str = "",
    sort: str = "rating_desc",
    size: int = 15,
) -> DataFrame:
    """Filtered and sorted lists, cut into pages of ``size`` per user.

    A user's list is a top-N list, so numbering it takes a plain window.
    """
    kept = recs.filter(F.lower("product_name").contains(text.lower()))
    if category != "All":
        kept = kept.filter(F.col("category") == category)
    orders = {
        "rating_desc": [F.desc("rating"), F.col("product_id")],
        "price_low": [F.col("price"), F.col("product_id")],
    }
    window = Window.partitionBy("user_id").orderBy(*orders[sort])
    placed = kept.withColumn("position", F.row_number().over(window).cast("long"))
    return placed.withColumn("page", (F.floor((F.col("position") - 1) / size) + 1).cast("long"))


def dashboard(recs: DataFrame) -> DataFrame:
    """Per user: items, mean score, and the mean as a share of 15, at most 100%."""
    mean = F.avg("rating")
    return recs.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("items"),
        steady_round(mean, 2).alias("avg_score"),
        steady_round(F.least(mean / 15 * 100, F.lit(100.0)), 4).alias("confidence_pct"),
    )


def category_mix(recs: DataFrame) -> DataFrame:
    """Items per user and category."""
    return recs.groupBy("user_id", "category").agg(F.count(F.lit(1)).alias("items"))
