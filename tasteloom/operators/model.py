"""MLlib's ALS: specification, fit, prediction, storage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.functions.scalar import is_number, percent
from tasteloom.operators.clean import scored_only
from tasteloom.shared import shared_root


# Ratings in one block of users or items, which the solver holds in arrays.  An iteration sends
# every factor to each block that needs it, so more blocks than memory asks for cost shuffles.
BLOCK_ROWS = 20_000_000


@dataclass(frozen=True)
class AlsSpec:
    """Settings of an ALS fit.

    ``alpha`` matters only with ``implicit``.  Without ``blocks`` their number follows the
    ratings, ``BLOCK_ROWS`` to a block, 10 at least.  The shuffle files of all iterations since
    the last checkpoint stay on disk, ``checkpoint_every`` of them; a checkpoint is one copy of
    the item factors and changes no result.
    """

    rank: int = 10
    iterations: int = 15
    reg: float = 0.1
    nonnegative: bool = True
    cold_start: str = "drop"
    implicit: bool = False
    alpha: float = 1.0
    blocks: int | None = None
    checkpoint_every: int = 2
    seed: int = 42
    user: str = "user_id"
    item: str = "product_id"
    rating: str = "rating"

    def estimator(self, rows: int = 0) -> ALS:
        blocks = self.blocks or max(10, -(-rows // BLOCK_ROWS))
        return ALS(
            rank=self.rank,
            maxIter=self.iterations,
            regParam=self.reg,
            nonnegative=self.nonnegative,
            coldStartStrategy=self.cold_start,
            implicitPrefs=self.implicit,
            alpha=self.alpha,
            numUserBlocks=blocks,
            numItemBlocks=blocks,
            checkpointInterval=self.checkpoint_every,
            seed=self.seed,
            userCol=self.user,
            itemCol=self.item,
            ratingCol=self.rating,
        )


# Rank and iterations of the three presets.
FULL = AlsSpec(rank=10, iterations=15)
BLOCKED = AlsSpec(rank=8, iterations=3, blocks=20, user="user_idx", item="item_idx")
FAST = AlsSpec(rank=5, iterations=10)


def fit(train: DataFrame, spec: AlsSpec = FULL) -> ALSModel:
    """Fit ALS on int ids; the factors are checkpointed in the shared folder."""
    shared_root(train.sparkSession)
    rows = train.select(spec.user, spec.item, F.col(spec.rating).cast("float").alias(spec.rating))
    return spec.estimator(0 if spec.blocks else rows.count()).fit(rows)


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Score the pairs; pairs of unknown users or items are dropped."""
    return scored_only(model.transform(pairs))


def prediction_yield(test: DataFrame, predictions: DataFrame, keys: list[str]) -> DataFrame:
    """Test rows, scored rows and rows without a prediction (cold start)."""
    scored = predictions.filter(is_number(F.col("prediction"))).select(*keys).distinct()
    marked = test.join(scored.withColumn("_hit", F.lit(1)), keys, "left")
    return marked.agg(
        F.count(F.lit(1)).alias("test_rows"), F.count("_hit").alias("scored_rows")
    ).select(
        "test_rows",
        "scored_rows",
        (F.col("test_rows") - F.col("scored_rows")).alias("cold_start_rows"),
        percent(F.col("scored_rows"), F.col("test_rows")).alias("scored_pct"),
    )


def save_model(model: ALSModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)


def mean_predictor(train: DataFrame, min_ratings: int = 1) -> DataFrame:
    """Mean rating of every product with enough ratings: the baseline to beat."""
    return (
        train.groupBy("product_id")
        .agg(F.avg("rating").alias("prediction"), F.count("rating").alias("_n"))
        .filter(F.col("_n") >= min_ratings)
        .drop("_n")
    )
