"""Where intermediate tables go: the folder every executor can reach.

The folder is the session's ``spark.checkpoint.dir``.  Only a ``local[...]`` session without
that setting uses a folder in its warehouse.  What a run writes there can be removed with it
(``scratch``); the rest goes when the Python process ends.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
# Spark's setting to delete the shuffle files of a query when it has ended.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_made: list[str] = []
_tables: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The shared folder; also makes it the context's checkpoint folder."""
    context = spark.sparkContext
    root = spark.conf.get(SETTING, None)
    current = context.getCheckpointDir()
    if not root and current:
        return current
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared"
    if current is None:
        context.setCheckpointDir(root)
    return root


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    path = f"{shared_root(spark).rstrip('/')}/tasteloom/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextlib.contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind: what they wrote takes their place."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def store(df: DataFrame, path: str) -> DataFrame:
    """``df`` as written to ``path``; the caller may ``remove`` the path when nothing reads it any more."""
    spark = df.sparkSession
    with _shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and go on from the written rows.

    Used where a plan reads the same rows more than once and either computing them
    again would be dear or both reads must agree even if an executor is lost in between
    (range partitions, random splits).  Later reads still prune columns.
    """
    return store(df, new_path(df.sparkSession, label))


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate tables, wherever the shared folder is."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def new_table() -> str:
    """A table name that no earlier run has used; what is left of such tables goes when the process ends."""
    _tables.append(f"tasteloom_{uuid.uuid4().hex}")
    return _tables[-1]


def drop_tables(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        _tables.remove(name)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside the block are deleted at its end."""
    before = len(_made)
    try:
        yield
    finally:
        remove(spark, _made[before:])
        del _made[before:]


class RanOnce:
    """A block of Spark work; afterwards ``surely`` says whether every task of it ran once and without failing."""

    KEY = "spark.jobGroup.id"

    def __init__(self, spark: SparkSession):
        self._context = spark.sparkContext
        self._group = f"tasteloom-{uuid.uuid4().hex}"
        self.surely = False

    def __enter__(self) -> RanOnce:
        self._before = self._context.getLocalProperty(self.KEY)
        self._context.setLocalProperty(self.KEY, self._group)
        return self

    def __exit__(self, *error: object) -> None:
        self._context.setLocalProperty(self.KEY, self._before)
        tracker = self._context.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(self._group)]
        stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
        # Skipped stages have no tasks; what is no longer known counts as run again.
        calm = all(s is not None and s.currentAttemptId == 0 and s.numFailedTasks == 0 for s in stages)
        self.surely = bool(jobs) and all(jobs) and calm and error[0] is None


@atexit.register
def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and (_made or _tables):
        with contextlib.suppress(Exception):  # the session may have ended before
            drop_tables(spark, list(_tables))
            remove(spark, _made)
