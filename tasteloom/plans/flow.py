"""The whole way from a ratings file to written recommendations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tasteloom.operators import clean, ranking, recommend
from tasteloom.operators.clean import CleanRules
from tasteloom.operators.model import FULL, AlsSpec, save_model
from tasteloom.operators.sampling import sample_share
from tasteloom.plans.explore import save_exploration
from tasteloom.plans.train import evaluation_report, train, train_report
from tasteloom.shared import scratch, settle
from tasteloom.sources.readers import first_rows
from tasteloom.sources.writers import write_csv, write_csv_single, write_parquet, write_report


@dataclass(frozen=True)
class Written:
    """Where a run has put its tables."""

    clean: str
    model: str
    reports: dict[str, str]
    recommendations: str


def run(
    raw: DataFrame,
    base: str,
    run_id: str,
    rules: CleanRules = CleanRules(),
    spec: AlsSpec = FULL,
    n: int = 10,
    sample: float | None = None,
    explore: bool = True,
) -> Written:
    """Clean, explore, train, evaluate, recommend; everything goes below ``base``.

    The clean table is written once, with its audit from the same pass, and every later step reads it.  ``sample``
    cleans, audits and trains on a share of the raw rows, of exact size.  Recommendations go to a folder of the run.  Intermediate
    tables are removed at the end.
    """
    with scratch(raw.sparkSession):
        return _run(raw, base.rstrip("/"), run_id, rules, spec, n, sample, explore)


def _run(
    raw: DataFrame, base: str, run_id: str, rules: CleanRules, spec: AlsSpec, n: int, sample: float | None, explore: bool
) -> Written:
    rows = settle(sample_share(raw, sample, raw.columns), "sample") if sample else raw
    watched = clean.Watched(rows, rules)
    with watched.writing:
        clean_path = write_parquet(watched.rows, f"{base}/clean")
    ratings = raw.sparkSession.read.parquet(clean_path)
    reports = {"audit": write_report(watched.audit(), f"{base}/audit")}
    if explore:
        reports |= save_exploration(ratings, f"{base}/exploration")
    trained = train(ratings, spec)
    model_path = save_model(trained.model, f"{base}/model")
    reports["training"] = write_report(train_report(trained), f"{base}/training")
    reports["evaluation"] = write_report(evaluation_report(trained, n), f"{base}/evaluation")
    lists = write_parquet(trained.lists(n), f"{base}/recommendations", run_id)
    return Written(clean_path, model_path, reports, lists)


def run_popular(
    raw: DataFrame, path: str, head: int | None = None, users: int | None = None, n: int = 10
) -> str:
    """Popular products for every user as CSV.

    ``head`` takes the first rows only and ``users`` the first users only; with ``users`` the result
    is bounded and is written as a single file.
    """
    with scratch(raw.sparkSession):
        rows = first_rows(raw, raw.columns, head) if head else raw
        known = settle(clean.positive(clean.fill_numbers(clean.dedup(rows, "exact"))))
        people = ranking.first_users(known, users) if users else known.select("user_id").distinct()
        lists = recommend.recommend_popular(known, people, n)
        return write_csv_single(lists, path, rows=users * n) if users else write_csv(lists, path, header=True)
