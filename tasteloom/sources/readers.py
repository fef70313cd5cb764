"""Reading ratings and recommendations from files, and from literal rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteloom.shared import settle

RATING_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
    ]
)
RECOMMENDATION_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("rating", T.DoubleType()),
    ]
)


def read_ratings_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    header: bool = True,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """A ratings CSV.

    With ``schema`` the file is read once; without it the types are inferred, which
    reads it twice.  ``names`` renames the columns by position.
    """
    reader = (
        spark.read.option("header", header)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return df.toDF(*names) if names else df


REJECTED = "rejected_line"


def divert(
    spark: SparkSession, path: str, rejects: str, schema: T.StructType = RATING_SCHEMA, header: bool = False
) -> DataFrame:
    """The well-formed rows of a ratings CSV; the lines that are not are written to ``rejects`` as text.

    A line is malformed if it has too many or too few fields, or a field that its type cannot hold.  The file
    is parsed once, without inferring types.
    """
    rows = settle(_with_lines(spark, path, schema, header), "parsed")
    bad = F.col(REJECTED).isNotNull()
    rows.filter(bad).select(REJECTED).write.mode("overwrite").text(rejects)
    return rows.filter(~bad).drop(REJECTED)


def _with_lines(spark: SparkSession, path: str, schema: T.StructType, header: bool) -> DataFrame:
    wide = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    options = {"header": header, "encoding": "UTF-8", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
    return spark.read.options(**options).schema(wide).csv(path)


def read_recommendations_json(
    spark: SparkSession, path: str, schema: T.StructType = RECOMMENDATION_SCHEMA
) -> DataFrame:
    """One JSON record per line; user ids always come out as text."""
    df = spark.read.schema(schema).json(path)
    return df.withColumn("user_id", F.col("user_id").cast("string"))


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``.  The order should be total."""
    return df.orderBy(*order).limit(n)


def rows_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A DataFrame of a few literal rows."""
    return spark.createDataFrame(list(rows), schema)
