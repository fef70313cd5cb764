"""Rating feeds over the given tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Last word of the product names in the catalogue feed, by ``p_partkey % 8``.
NOUNS = [
    "Gaming Laptop", "Notebook", "Gym Bag", "Smartphone",
    "Running Shoe", "TV Stand", "Desk Lamp", "Camera Strap",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def orders_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings 1.0 to 5.0 from the ordered quantities; large and sparse.

    Both join inputs are plain scans, so adaptive execution splits a skewed order key.
    """
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("double").alias("rating"),
        F.unix_timestamp("o_orderdate").alias("ts"),
    )


def events_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings from 0.0 in steps of 0.5, many out of range; pairs repeat."""
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").cast("int").alias("product_id"),
        (F.floor(F.col("value") / 5) / 2.0).cast("double").alias("rating"),
        F.unix_timestamp("ts").alias("ts"),
    )


def dirty_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event id, text user id with nulls and malformed ones, and text product id."""
    events = events_feed(spark, folder)
    none = F.lit(None).cast("string")
    user = F.when(F.col("event_id") % 37 == 0, none).when(F.col("event_id") % 53 == 0, F.lit("U-bad"))
    return events.select(
        "event_id", user.otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.col("product_id").cast("string").alias("product_id"),
    )


def dirty_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The events feed with text ids, nulls and malformed user ids."""

    def every(n: int):
        return F.col("event_id") % n == 0

    return events_feed(spark, folder).select(
        F.when(every(37), F.lit(None).cast("string"))
        .when(every(53), F.lit("U-bad"))
        .otherwise(F.col("user_id").cast("string"))
        .alias("user_id"),
        F.when(~every(41), F.col("product_id").cast("string")).alias("product_id"),
        F.when(~every(43), F.col("rating")).alias("rating"),
        F.when(~every(47), F.col("ts")).alias("ts"),
    )


def catalogue_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Product id and name; the names cover every category rule."""
    nouns = F.array(*[F.lit(n) for n in NOUNS])
    noun = F.element_at(nouns, (F.col("p_partkey") % len(NOUNS) + 1).cast("int"))
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat_ws(" ", F.col("p_name"), noun).alias("product_name"),
    )


def picture_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of the products that have a picture file of their own."""
    return (
        table(spark, folder, "part")
        .filter(F.col("p_size") <= 25)
        .select(F.col("p_partkey").alias("product_id"))
    )
