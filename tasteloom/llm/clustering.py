"""Centroid clustering on whole numbers, with a PCA-rotated lower bound that rules centroids out.

Every vector is stored once, next to its leading coordinates along the principal axes of all
vectors and the norm of what is left.  For a vector v and a centroid c,

    |v - c|^2  >=  |lead(v) - lead(c)|^2 + (rest(v) - rest(c))^2,

so most centroids are ruled out on a few coordinates.  The survivors are verified in whole
numbers, which decide: the axes, fitted in floating point, change the work and never the result.

A round sends one sum per centroid and component and task; the driver holds the centroids, a
number of values that the parameters fix.  Sums are exact, so a task that runs again, on another
executor, yields the same centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import small_table
from tasteloom.shared import settle

SCALE = 1024  # whole steps per unit
DIMS = 64
CENTROIDS = 8
ROUNDS = 10
SEED = 3
LEAD = 16  # coordinates along the principal axes that are stored
SLACK = 1e-9  # of the squared lengths; far above the rounding of the bound


def largest(dims: int) -> int:
    """The largest component, in steps, for which a squared distance surely fits a long."""
    return isqrt((2**63 - 1) // dims) // 2


def whole_vectors(embeddings: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``whole``, every component as floor(scale * x); only usable vectors.

    Vectors that are null, of another length, or hold a null, non-finite or out-of-range
    component (``largest``: its squares would not fit a long) are left out.
    """
    limit = float(largest(dims))
    steps = F.transform("embedding", lambda x: x.cast("double") * float(scale))
    usable = F.forall(steps, lambda x: F.coalesce(F.abs(x) < limit, F.lit(False)))
    kept = embeddings.filter((F.size("embedding") == dims) & usable)
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(steps, lambda x: F.floor(x).cast("int")).alias("whole")
    )


def seeds(vectors: DataFrame, centroids: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id; ties go to the smaller vector, null ids come last."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(mark.alias("mark"), "whole").orderBy(F.asc_nulls_last("mark"), "whole").limit(centroids)
    return np.array([r["whole"] for r in first.collect()], dtype=np.int64)


def _matrix(column, kind) -> np.ndarray:
    """An Arrow list column, all lists of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind).reshape(len(column), -1)


def axes(vectors: DataFrame, dims: int, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and leading principal axes (dims x lead) of all vectors; tasks send sums of products."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            if batch.num_rows:
                one = np.hstack([_matrix(batch.column(0), np.float64), np.ones((batch.num_rows, 1))])
                total += one.T @ one
        cells = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel())], ["cell", "total"])

    cells = vectors.select("whole").mapInArrow(sums, "cell long, total double").groupBy("cell").agg(F.sum("total"))
    total = np.zeros((dims + 1) ** 2)
    for cell, value in cells.collect():
        total[cell] = value
    total = total.reshape(dims + 1, dims + 1)
    n = max(total[dims, dims], 1.0)
    mean = total[dims, :dims] / n
    _, turned = np.linalg.eigh(total[:dims, :dims] / n - np.outer(mean, mean))
    return mean, np.ascontiguousarray(turned[:, ::-1][:, :lead])


def project(whole: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and the norm of the rest."""
    moved = whole - mean
    lead = moved @ turn
    return lead, np.sqrt(np.maximum((moved * moved).sum(axis=1) - (lead * lead).sum(axis=1), 0.0))


def rotated(vectors: DataFrame, mean: np.ndarray, turn: np.ndarray) -> DataFrame:
    """``vectors`` with ``lead`` and ``rest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lead, rest = project(_matrix(batch.column(1), np.float64), mean, turn)
                limits = np.arange(len(rest) + 1, dtype=np.int32) * lead.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(limits), pa.array(lead.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(rest)], ["vec_id", "whole", "lead", "rest"])

    return vectors.mapInArrow(run, "vec_id long, whole array<int>, lead array<double>, rest double")


def nearest(
    whole: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, mean: np.ndarray, turn: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid (ties: smaller), the exact squared distance, and the pairs verified."""

    def exact(rows: np.ndarray, c: np.ndarray) -> np.ndarray:
        apart = rows - c
        return (apart * apart).sum(axis=1)

    c_lead, c_rest = project(centroids.astype(np.float64), mean, turn)
    low = np.empty((len(whole), len(centroids)))
    size = (lead * lead).sum(axis=1) + rest * rest
    for j in range(len(centroids)):
        apart = lead - c_lead[j]
        bound = (apart * apart).sum(axis=1) + (rest - c_rest[j]) ** 2
        low[:, j] = bound - SLACK * (size + c_lead[j] @ c_lead[j] + c_rest[j] ** 2)
    number = low.argmin(axis=1)
    best = exact(whole, centroids[number])
    verified, tried = len(whole), number.copy()
    for j in range(len(centroids)):
        may = np.flatnonzero((low[:, j] <= best) & (tried != j))
        verified += len(may)
        far = exact(whole[may], centroids[j])
        wins = (far < best[may]) | ((far == best[may]) & (j < number[may]))
        best[may[wins]], number[may[wins]] = far[wins], j
    return number, best, verified


def _assigned(stored: DataFrame, centroids: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and ``distance`` of every stored vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                parts = _matrix(batch.column(1), np.int64), _matrix(batch.column(2), np.float64), batch.column(3).to_numpy()
                number, far, _ = nearest(*parts, centroids, mean, turn)
                columns = [batch.column(0), pa.array(number.astype(np.int32)), pa.array(far)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return stored.mapInArrow(run, "vec_id long, cluster int, distance long")


def _moved(stored: DataFrame, centroids: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floor of the mean of each one's vectors."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                whole = _matrix(batch.column(0), np.int64)
                number, _, _ = nearest(whole, _matrix(batch.column(1), np.float64), batch.column(2).to_numpy(), centroids, mean, turn)
                np.add.at(total, number, whole)
                rows += np.bincount(number, minlength=k)
        cells, n = np.arange(k * dims), np.repeat(rows, dims)
        some = n > 0
        arrays = [pa.array(cells[some]), pa.array(total.ravel()[some]), pa.array(n[some])]
        yield pa.RecordBatch.from_arrays(arrays, ["cell", "total", "n"])

    # Sums of many tasks may outgrow a long.
    wide = F.sum(F.col("total").cast("decimal(38,0)"))
    found = stored.select("whole", "lead", "rest").mapInArrow(sums, "cell long, total long, n long")
    out = centroids.copy().ravel()
    for cell, total, n in found.groupBy("cell").agg(wide, F.sum("n")).collect():
        out[cell] = int(total) // n
    return out.reshape(k, dims)


def cluster(
    embeddings: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS,
    scale: int = SCALE, seed: int = SEED, lead: int = LEAD,
) -> DataFrame:
    """Lloyd's rounds on whole numbers, from the vectors with the smallest hashes.

    Needs ``vec_id`` and ``embedding``; other columns are ignored, whatever their names.  Returns, per
    vector that takes part, ``vec_id, cluster, distance`` (squared), ``cluster_inertia`` and ``inertia``
    (its sums; null if a sum does not fit a long) and ``centroid_sha256``.

    Rows of vectors that are null, of another length, or hold null, non-finite or out-of-range components (see
    ``whole_vectors``) are left out.  A null id is kept and is no seed before others.  Repeated rows each count
    and each come out.  Fewer vectors than ``centroids`` give as many centroids; an empty table gives none and
    no rows.  Ties go to the smaller number.  A very long vector has another length than ``dims``.
    """
    spark = embeddings.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    vectors = settle(whole_vectors(embeddings, dims, scale), "whole")
    now = seeds(vectors, centroids, seed)
    if not len(now):
        return spark.createDataFrame([], schema)
    mean, turn = axes(vectors, dims, min(lead, dims))
    stored = settle(rotated(vectors, mean, turn), "rotated")
    for _ in range(rounds):
        moved = _moved(stored, now, mean, turn)
        if (moved == now).all():
            break  # all later rounds would repeat this one
        now = moved
    found = settle(_assigned(stored, now, mean, turn), "assigned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("wide"))
    marks = [
        {"cluster": i, "centroid_sha256": hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()}
        for i, c in enumerate(now.tolist())
    ]
    named = small_table(spark, marks, "cluster int, centroid_sha256 string").join(F.broadcast(sums), "cluster")
    every = sums.agg(F.sum("wide").alias("wide")).scalar()
    named = named.select(
        "cluster", F.col("wide").try_cast("long").alias("cluster_inertia"), every.try_cast("long").alias("inertia"), "centroid_sha256"
    )
    return found.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
