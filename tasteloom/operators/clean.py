"""Cleaning: columns, nulls, duplicates, types and ranges, and an audit of all."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tasteloom.functions.scalar import any_null, bucket, is_number, percent
from tasteloom.shared import RanOnce

PAIR = ("user_id", "product_id")
REQUIRED = ("user_id", "product_id", "rating")


@dataclass(frozen=True)
class CleanRules:
    """What ``clean`` and ``clean_audit`` do.

    ``nulls``: ``any`` drops rows with a null in any column, ``keys`` only those
    with a null in a required column.  ``duplicates``: ``latest`` keeps the newest row per
    user and product, ``exact`` drops identical rows.  With
    ``filter_first`` the range filter comes before the duplicates are dropped, so
    an older valid rating survives a newer invalid one.
    """

    required: Sequence[str] = REQUIRED
    optional: Sequence[str] = ("ts",)
    nulls: str = "any"
    duplicates: str = "latest"
    types: Mapping[str, str] = field(
        default_factory=lambda: {"user_id": "int", "product_id": "int", "rating": "float"}
    )
    low: float = 0.5
    high: float = 5.0
    filter_first: bool = False

    def __post_init__(self) -> None:
        if self.nulls not in ("any", "keys"):
            raise ValueError(f"unknown null strategy {self.nulls!r}; use 'any' or 'keys'")
        if self.duplicates not in ("latest", "exact"):
            raise ValueError(f"unknown duplicate mode {self.duplicates!r}; use 'latest' or 'exact'")


def pick(
    df: DataFrame, required: Sequence[str] = REQUIRED, optional: Sequence[str] = ("ts",)
) -> DataFrame:
    """The required columns that exist, then the optional ones that exist."""
    return df.select(*[c for c in (*required, *optional) if c in df.columns])


def without_nulls(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column, or in ``keys``."""
    return df.na.drop(subset=list(keys) if keys else None)


def fill_numbers(df: DataFrame, value: float = 0) -> DataFrame:
    """Replace nulls in the numeric columns."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    return df.na.fill(value, subset=numeric)


def fill_column(df: DataFrame, column: str, value: float = 0.0) -> DataFrame:
    return df.na.fill({column: value})


def in_range(df: DataFrame, low: float = 0.5, high: float = 5.0, column: str = "rating") -> DataFrame:
    """Rows with ``low <= column <= high``; nulls go too."""
    return df.filter(F.col(column).between(low, high))


def positive(df: DataFrame, column: str = "rating") -> DataFrame:
    return df.filter(F.col(column) > 0)


def relevant(df: DataFrame, threshold: float = 4.0, column: str = "rating") -> DataFrame:
    return df.filter(F.col(column) >= threshold)


def of_entity(df: DataFrame, column: str, value) -> DataFrame:
    """All rows of one user or product."""
    return df.filter(F.col(column) == F.lit(value))


def scored_only(df: DataFrame, column: str = "prediction") -> DataFrame:
    """Rows whose prediction is neither null nor NaN."""
    return df.filter(is_number(F.col(column)))


def sample_by_key(df: DataFrame, keys: Sequence[str], percentage: int) -> DataFrame:
    """Rows whose key hash falls into the first ``percentage`` of 100 buckets."""
    return df.filter(bucket(*keys) < percentage)


def newest_first(df: DataFrame, keys: Sequence[str] = PAIR) -> list[Column]:
    """A total order per key: newest, then highest rating, then the other columns."""
    leading = [c for c in ("ts", "rating") if c in df.columns]
    rest = [c for c in df.columns if c not in (*leading, *keys)]
    return [F.desc_nulls_last(c) for c in leading] + [F.asc_nulls_last(c) for c in rest]


def dedup(
    df: DataFrame,
    mode: str = "latest",
    keys: Sequence[str] = PAIR,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Drop duplicates.

    ``latest`` keeps the first row per key in ``order`` (newest first by
    default); ``exact`` drops identical rows; ``any`` keeps whichever row
    per key Spark meets first.  All three cut rows down before the shuffle, so a
    key with very many rows costs one row per input partition.
    """
    if mode == "exact":
        return df.dropDuplicates()
    if mode == "any":
        return df.dropDuplicates(list(keys))
    if mode != "latest":
        raise ValueError(f"unknown mode {mode!r}; use 'latest', 'exact' or 'any'")
    window = Window.partitionBy(*keys).orderBy(*(order or newest_first(df, keys)))
    return df.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


def coerce(
    df: DataFrame,
    types: Mapping[str, str],
    required: Sequence[str] = (),
) -> DataFrame:
    """Cast columns; what cannot be cast becomes null.

    Rows in which a ``required`` column ends up null are dropped.
    """
    cast = df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})
    return without_nulls(cast, required) if required else cast


def cast_rejects(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column the values that are there but cannot be cast: ``column_name, type, rejected``."""
    present = {c: t for c, t in types.items() if c in df.columns}
    counts = df.agg(
        *[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in present.items()]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("type"), F.col(c).alias("rejected"))
        for c, t in present.items()
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _rating_in_bounds(rules: CleanRules) -> Column:
    """Whether the rating, as it is after the cast, is in the range; false if it cannot be cast."""
    rating = F.col("rating")
    if "rating" in rules.types:
        rating = rating.try_cast(rules.types["rating"])
    return F.coalesce(rating.between(rules.low, rules.high), F.lit(False))


def clean(df: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """Pick, drop nulls, drop duplicates, cast, filter the range."""
    return _steps(df, rules, lambda rows, step: rows)


def _steps(df: DataFrame, rules: CleanRules, seen: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The steps of ``clean``; ``seen`` gets the rows that each one leaves."""
    picked = seen(pick(df, rules.required, rules.optional), "total")
    kept = seen(without_nulls(picked, None if rules.nulls == "any" else rules.required), "null")
    if rules.filter_first:
        kept = seen(kept.filter(_rating_in_bounds(rules)), "early_range")
    unique = seen(dedup(kept, rules.duplicates), "duplicate")
    typed = seen(coerce(unique, rules.types, rules.required), "type")
    return typed if rules.filter_first else seen(in_range(typed, rules.low, rules.high), "range")


class Watched:
    """``clean`` with its audit taken by the pass that writes the clean rows.

    Write ``rows`` once, inside ``with watched.writing:``; ``audit`` then has the rows of ``clean_audit``.  Spark adds
    up what every finished task has seen, and tasks that run again are added twice.  So when any task of the
    write failed, as with a lost executor, ``audit`` falls back to ``clean_audit``, which reads the feed again.
    """

    def __init__(self, df: DataFrame, rules: CleanRules = CleanRules()):
        self.df, self.rules = df, rules
        self.writing = RanOnce(df.sparkSession)
        self._seen: dict[str, Observation] = {}
        self.rows = _steps(df, rules, self._watch)

    def _watch(self, rows: DataFrame, step: str) -> DataFrame:
        self._seen[step] = Observation()
        return rows.observe(self._seen[step], F.count(F.lit(1)).alias("rows"))

    def audit(self) -> DataFrame:
        """Rows left and removed after every step."""
        if not self.writing.surely:
            return clean_audit(self.df, self.rules)
        left = {step: seen.get["rows"] for step, seen in self._seen.items()}
        steps = list(left)
        removed = [F.lit(left["total"]).cast("long").alias("total")]
        for before, step in zip(steps, steps[1:], strict=False):
            removed.append(F.lit(left[before] - left[step]).cast("long").alias(step))
        return _audit_rows(self.df.sparkSession.range(1).select(*removed), steps[1:])


def clean_audit(df: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """Rows left and rows removed after every step of ``clean``.

    One aggregation per duplicate group replaces a count after every step: a group
    loses all but one row as duplicates, and the row that stays decides about type
    and range.  Rows an earlier step drops are gathered in one group per step.
    """
    picked = pick(df, rules.required, rules.optional)
    columns = picked.columns
    checked = columns if rules.nulls == "any" else list(rules.required)
    in_bounds = _rating_in_bounds(rules)
    early = F.when(any_null(*checked), F.lit("null"))
    if rules.filter_first:
        early = early.when(~in_bounds, F.lit("range"))
    group = list(PAIR) if rules.duplicates == "latest" else columns
    tagged = picked.withColumn("_early", early)
    alive = F.col("_early").isNull()
    newest = F.struct(*[c for c in ("ts", "rating") if c in columns])
    groups = (
        tagged.withColumns({f"_g_{c}": F.when(alive, F.col(c)) for c in group})
        .groupBy("_early", *[f"_g_{c}" for c in group])
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max(F.when(alive, newest))["rating"].alias("rating"),
        )
    )
    castable = F.lit(True)
    for c in rules.required:
        if c in rules.types:
            value = F.col("rating") if c == "rating" else F.col(f"_g_{c}")
            castable = castable & value.try_cast(rules.types[c]).isNotNull()
    removed = groups.agg(
        F.sum("_n").alias("total"),
        F.sum(F.when(F.col("_early") == "null", F.col("_n"))).alias("null"),
        F.sum(F.when(F.col("_early") == "range", F.col("_n"))).alias("early_range"),
        F.sum(F.when(alive, F.col("_n") - 1)).alias("duplicate"),
        F.count_if(alive & ~castable).alias("type"),
        F.count_if(alive & castable & ~in_bounds).alias("range"),
    ).na.fill(0)
    middle = ["duplicate", "type"]
    return _audit_rows(removed, ["null", "early_range", *middle] if rules.filter_first else ["null", *middle, "range"])


def _audit_rows(removed: DataFrame, steps: Sequence[str]) -> DataFrame:
    """One row per step from one row of the rows that each removes, and their ``total``."""
    gone = F.lit(0).cast("long")
    rows = []
    for number, step in enumerate(steps, 1):
        gone = gone + F.col(step)
        rows.append(
            F.struct(
                F.lit(number).alias("step_no"),
                F.lit(step.removeprefix("early_")).alias("step"),
                F.col(step).alias("removed"),
                percent(F.col(step), F.col("total")).alias("removed_pct"),
                (F.col("total") - gone).alias("rows_left"),
            )
        )
    return removed.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
