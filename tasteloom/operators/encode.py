"""Integer codes for user and product ids."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.spread import place_rows, spread_joins

CODES = {"user_id": "user_idx", "product_id": "item_idx"}


def md5_code(bits: int = 32) -> Callable[[Column], Column]:
    """The leading ``bits`` (a multiple of four) of an id's MD5: the same code in any system."""
    return lambda text: F.conv(F.substring(F.md5(text), 1, bits // 4), 16, 10).cast("long")


def hash_codes(
    df: DataFrame, codes: Mapping[str, str] = CODES, code: Callable[[Column], Column] = F.hash
) -> DataFrame:
    """Add hashes of the ids as text, Spark's own of 32 bits if no ``code`` is given.  Different ids can share a code."""
    return df.withColumns({out: code(F.col(c).cast("string")) for c, out in codes.items()})


def hash_collisions(
    df: DataFrame, codes: Mapping[str, str] = CODES, code: Callable[[Column], Column] = F.hash
) -> DataFrame:
    """Per id column: ids, distinct codes, and ids that share a code with another."""
    parts = []
    for column in codes:
        ids = df.select(F.col(column).cast("string").alias("id")).na.drop().distinct()
        by_code = ids.groupBy(code(F.col("id")).alias("code")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            by_code.agg(
                F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("ids"),
                F.count(F.lit(1)).alias("codes"),
                F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0).cast("long")).alias(
                    "colliding_ids"
                ),
            ).select(F.lit(column).alias("column_name"), "ids", "codes", "colliding_ids")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def dense_index(df: DataFrame, column: str, out: str, counted: bool = False) -> DataFrame:
    """Ids with codes 0, 1, 2, ...: most frequent first, then by the id's text.

    The index stays a DataFrame and no task sees more than one range of the ids.
    If ``counted``, it keeps the rows of every id as ``count``.
    """
    counts = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    )
    order = [F.desc("_n"), F.col(column).cast("string").asc()]
    placed = place_rows(counts, order, "_at")
    more = [F.col("_n").alias("count")] if counted else []
    return placed.select(column, F.col("_at").cast("int").alias(out), *more)


def encode(
    df: DataFrame, indexes: Mapping[str, DataFrame], counted: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Add the codes of every index; rows with an id outside an index are dropped.

    ``counted`` has the rows of ``df`` per id, as ``id, count``, for ids whose rows are counted already.
    """
    joins = [(index, [column], "inner") for column, index in indexes.items()]
    return spread_joins(df, joins, counted=[(counted or {}).get(column) for column in indexes])


def cast_codes(df: DataFrame, codes: Mapping[str, str] = CODES) -> DataFrame:
    """Numeric ids straight to int codes; rows without a valid code are dropped.

    ``clean.cast_rejects`` with the id columns as ``int`` counts the ids that are left out.
    """
    cast = df.withColumns({out: F.col(c).try_cast("int") for c, out in codes.items()})
    return cast.na.drop(subset=list(codes.values()))


def index_cardinality(df: DataFrame, codes: Mapping[str, str] = CODES) -> DataFrame:
    """Distinct codes of users and items."""
    return df.agg(*[F.count_distinct(out).alias(f"distinct_{out}") for out in codes.values()])
