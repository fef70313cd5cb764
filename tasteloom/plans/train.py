"""From ratings to a model, its evaluation and its recommendations."""

from __future__ import annotations

import time
from dataclasses import dataclass, replace

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.operators.encode import CODES, dense_index, encode
from tasteloom.operators.evaluate import error_metrics, evaluate, long_form
from tasteloom.operators.model import (
    FULL,
    AlsSpec,
    fit,
    load_model,
    predict,
    prediction_yield,
    save_model,
)
from tasteloom.operators.recommend import recommend_unseen
from tasteloom.operators.relate import with_ids
from tasteloom.operators.split import settled_split
from tasteloom.shared import new_path, settle


@dataclass(frozen=True)
class Trained:
    """A fitted model with the rows and indexes it belongs to."""

    model: ALSModel
    coded: DataFrame
    train: DataFrame
    test: DataFrame
    indexes: dict[str, DataFrame]
    spec: AlsSpec
    seconds: float

    def predictions(self) -> DataFrame:
        return predict(self.model, self.test)

    def lists(self, n: int = 10) -> DataFrame:
        """The best ``n`` products per user that the user has not rated, with the original ids."""
        best = recommend_unseen(self.model, self.coded, n, self.spec.user, self.spec.item)
        return decode(settle(best), self.indexes)

    def coded_lists(self, n: int = 10) -> DataFrame:
        """Lists for evaluation: only what was trained on is left out, held-out rows may appear."""
        return recommend_unseen(self.model, self.train, n, self.spec.user, self.spec.item)


def decode(df: DataFrame, indexes: dict[str, DataFrame]) -> DataFrame:
    """Codes back to the original ids."""
    return with_ids(df, {CODES[column]: index for column, index in indexes.items()})


def train(ratings: DataFrame, spec: AlsSpec = FULL, share: float = 0.8, how: str = "hash") -> Trained:
    """Index the ids, split the rows, fit ALS on the training rows.

    The ratings are written down once for both indexes and the coding, which takes the rows per
    id from the indexes, and the coded rows once for the split, the fit, the predictions and the
    lists.  The model is written down too, so that a lost executor does not mean another fit.
    """
    ratings = settle(ratings.select("user_id", "product_id", "rating"))
    spec = replace(spec, user=CODES["user_id"], item=CODES["product_id"])
    whole = {column: dense_index(ratings, column, code, counted=True) for column, code in CODES.items()}
    indexes = {column: index.drop("count") for column, index in whole.items()}
    counted = {column: index.select(column, "count") for column, index in whole.items()}
    coded, train_rows, test_rows = settled_split(encode(ratings, indexes, counted), share, how)
    started = time.monotonic()
    path = save_model(fit(train_rows, spec), new_path(ratings.sparkSession, "als"))
    seconds = time.monotonic() - started
    return Trained(load_model(path), coded, train_rows, test_rows, indexes, spec, seconds)


def train_report(trained: Trained, path: str | None = None) -> DataFrame:
    """Sizes, settings, errors and fit time; ``path`` also saves the model.

    The predictions are written down, since each part of the report reads them.
    """
    if path:
        save_model(trained.model, path)
    keys = [trained.spec.user, trained.spec.item]
    predictions = settle(trained.predictions().select(*keys, "rating", "prediction"), "predictions")
    counts = prediction_yield(trained.test, predictions, keys)
    sizes = trained.train.agg(F.count(F.lit(1)).alias("train_rows")).select(
        "train_rows",
        F.lit(trained.spec.rank).alias("rank"),
        F.lit(trained.spec.iterations).alias("iterations"),
        F.lit(trained.spec.reg).alias("reg"),
        F.lit(trained.seconds).alias("fit_seconds"),
    )
    return (
        long_form("settings", sizes, {c: c for c in sizes.columns})
        .unionByName(long_form("test", counts, {c: c for c in counts.columns}))
        .unionByName(long_form("error", error_metrics(predictions), {c: c for c in ("rmse", "mae", "r2")}))
    )


def evaluation_report(trained: Trained, k: int = 10) -> DataFrame:
    """The full evaluation of the model with lists of unseen products."""
    coded = {trained.spec.user: "user_id", trained.spec.item: "product_id"}

    def plain(df: DataFrame) -> DataFrame:
        return df.drop("user_id", "product_id").withColumnsRenamed(coded)

    lists = settle(plain(trained.coded_lists(k)))
    return evaluate(
        plain(trained.predictions()), lists, plain(trained.train), plain(trained.test), k
    )
