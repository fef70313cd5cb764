"""Nearest neighbours by inner product, with randomly rotated one-bit codes.

A unit vector is rotated at random; the signs of its coordinates are its code, packed into
bytes.  With two numbers per vector (its length, and how far the code points in its direction)
the product of code and rotated query is an unbiased estimate of the inner product, and
its error has a bound that holds with a chosen certainty.  The candidates of the largest estimates
are scored on the original vectors; of the others, only those whose upper bound reaches the
k-th best score so far.

The codes of all vectors are made once and written (``index``).  Queries and candidates meet in
blocks: every block of candidates is a row with codes and vectors, and every block of queries a
row with vectors.  A task works through its pairs of blocks one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.shared import settle

NEAREST = 20
BLOCK_BYTES = 8 << 20  # of vectors in a block of candidates
QUERIES = 1024  # in a block of queries
FIRST = 4  # times as many classes as are asked for are scored before the bounds choose
TASKS = 100_000  # that the pairs of blocks are dealt over; a task's pairs come one after the other
CERTAINTY = 2.0  # width of the error bound in standard deviations: few of the nearest fall outside, most others are ruled out
SEED = 11


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Norms of rows that are not zero; squares of very large or small components do not matter."""
    top = np.abs(vectors).max(axis=1)
    return top * np.linalg.norm(vectors / top[:, None], axis=1)


def codes(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated unit vectors, their lengths, and code times direction."""
    length = lengths(vectors)
    turned = (vectors / length[:, None]) @ turn
    bits = turned > 0
    aligned = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(bits, axis=1), length, aligned


def estimates(
    query: np.ndarray, packed: np.ndarray, length: np.ndarray, aligned: np.ndarray, turn: np.ndarray, certainty: float
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x candidates) and their error bounds."""
    dim = query.shape[1]
    signs = np.unpackbits(packed, axis=1, count=dim).astype(np.float32) * 2 - 1
    size = np.linalg.norm(query, axis=1)
    product = (query @ turn).astype(np.float32) @ signs.T / np.float32(np.sqrt(dim))
    scale = (length / aligned).astype(np.float32)
    error = length * np.sqrt(np.maximum(1 / aligned**2 - 1, 0) / max(dim - 1, 1)) * certainty
    # The last term covers rounding in single precision.
    bound = size[:, None] * (error + 1e-5 * length)[None, :]
    return product * scale[None, :], bound.astype(np.float32)


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _classes(rows: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector with its ``keep`` smallest ids.

    Ids of equal vectors tie, so larger ones can never be among the nearest.  Spark cuts a group
    down to ``keep`` rows before it is sent (window group limit).
    """
    order = Window.partitionBy("vec").orderBy("vec_id")
    short = rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= keep)
    return short.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def index(classes: DataFrame, dim: int, seed: int = SEED) -> DataFrame:
    """``classes`` (column ``vec``, ``dim`` components each) with ``code``, the packed sign bits, and the
    correction scalars ``length`` and ``aligned``."""
    schema = ", ".join(f"{name} {kind}" for name, kind in classes.dtypes)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn = rotation(dim, seed)
        for frame in frames:
            if len(frame):
                packed, length, aligned = codes(np.stack(frame["vec"]), turn)
                yield frame.assign(code=[bits.tobytes() for bits in packed], length=length, aligned=aligned)

    return classes.mapInPandas(run, f"{schema}, code binary, length double, aligned double")


def _pack(rows: DataFrame, number: Column, key: str) -> DataFrame:
    """Rows ``(id or ids, vec)`` as one row per block."""
    return rows.groupBy(number.alias(key)).agg(F.collect_list(F.struct(*rows.columns)).alias(f"{key}_rows"))


def search(
    embeddings: DataFrame, queries: Column, nearest: int = NEAREST, certainty: float = CERTAINTY,
    block_bytes: int = BLOCK_BYTES, seed: int = SEED,
) -> DataFrame:
    """The ``nearest`` rows of ``embeddings`` for every row that ``queries`` (a Boolean column) selects.

    Needs ``vec_id`` and ``embedding``; returns ``query_id, rank, vec_id, score``, nearest first, ties to
    the smaller id.  The score is the inner product of the original vectors in double
    precision.  Vectors that are null, zero, or hold null or non-finite components, and rows
    without an id, take no part; vectors of another length than the query are no candidates.
    Rows that repeat an id with the same vector count once.
    """
    vec = F.transform("embedding", lambda x: x.cast("double"))
    rows = (
        embeddings.select(F.col("vec_id").cast("long"), vec.alias("vec"), queries.alias("is_query"))
        .filter(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    )
    rows = settle(rows.dropDuplicates(["vec_id", "vec"]), "vectors")
    classes = settle(_classes(rows.select("vec_id", "vec"), nearest + 1), "classes")
    sizes = classes.groupBy(F.size("vec").alias("dim")).count().collect()  # one row per vector length
    found = None
    for dim, count in [(r["dim"], r["count"]) for r in sizes]:
        part = _search_dim(
            rows.filter(F.size("vec") == dim), classes.filter(F.size("vec") == dim), dim, count,
            nearest, certainty, block_bytes, seed,
        )
        found = part if found is None else found.unionByName(part)
    if found is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return found


def _search_dim(
    rows: DataFrame, classes: DataFrame, dim: int, count: int, nearest: int, certainty: float, block_bytes: int, seed: int
) -> DataFrame:
    blocks = -(-count * dim * 8 // block_bytes)
    coded = settle(index(classes, dim, seed), "codes")
    candidates = _pack(coded, F.pmod(F.xxhash64("vec"), F.lit(blocks)), "c")
    asking = rows.filter("is_query")
    groups = max(1, -(-asking.count() // QUERIES))
    asked = _pack(asking.select("vec_id", "vec"), F.pmod(F.xxhash64("vec_id"), F.lit(groups)), "q")
    # Every block of queries visits every block of candidates.
    visits = asked.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
    met = visits.join(candidates, "c").select("q_rows", "c_rows")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn = rotation(dim, seed)
        for frame in frames:
            for q_rows, c_rows in zip(frame["q_rows"], frame["c_rows"], strict=True):
                yield _nearest_in(q_rows, c_rows, turn, nearest, certainty)

    part = met.repartition(min(blocks * groups, TASKS)).mapInPandas(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        part.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def _nearest_in(q_rows, c_rows, turn: np.ndarray, nearest: int, certainty: float) -> pd.DataFrame:
    """The nearest of one block of candidates for each query of one block."""
    q_ids = [r["vec_id"] for r in q_rows]
    query = np.stack([r["vec"] for r in q_rows])
    vectors = np.stack([r["vec"] for r in c_rows])
    ids = [np.asarray(r["ids"]) for r in c_rows]
    packed = np.frombuffer(b"".join(r["code"] for r in c_rows), dtype=np.uint8).reshape(len(c_rows), -1)
    length, aligned = (np.array([r[name] for r in c_rows]) for name in ("length", "aligned"))
    # Only the order counts here: relative to the queries' lengths and the block's longest vector, single precision holds all.
    size, most = lengths(query), length.max()
    estimate, bound = estimates(query / size[:, None], packed, length / most, aligned, turn, certainty)
    # One class may hold the query alone, so one more class than `nearest` is kept.
    k = min(nearest + 1, len(vectors))
    few = min(FIRST * k, len(vectors))
    first = np.argpartition(estimate, len(vectors) - few, axis=1)[:, len(vectors) - few :]
    upper = estimate + bound
    room = np.empty_like(vectors)
    out_q, out_v, out_s = [], [], []
    for i, q in enumerate(q_ids):
        # The most promising are scored first; only what may reach the k-th best of them is scored besides.
        tried = (vectors[first[i]] * query[i]).sum(axis=1)
        least = np.partition(tried, few - k)[few - k] / size[i] / most
        may = upper[i] >= least - 1e-6 * abs(least)
        may[first[i]] = True
        alive = np.flatnonzero(may)
        # A sum along rows gives equal vectors equal scores.
        score = np.multiply(vectors[alive], query[i], out=room[: len(alive)]).sum(axis=1)
        best = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        best = best[np.argsort(-score[best], kind="stable")]
        take_v, take_s = [], []
        for j in best:
            # Stop when there are enough and no tie is left.
            if len(take_v) >= nearest and score[j] < take_s[-1]:
                break
            own = ids[alive[j]]
            own = own[own != q]
            take_v += own.tolist()
            take_s += [score[j]] * len(own)
        v, s = np.array(take_v, dtype=np.int64), np.array(take_s)
        top = np.lexsort((v, -s))[:nearest]
        out_q += [q] * len(top)
        out_v.append(v[top])
        out_s.append(s[top])
    return pd.DataFrame(
        {"query_id": np.array(out_q, dtype=np.int64), "vec_id": np.concatenate(out_v or [np.array([], dtype=np.int64)]),
         "score": np.concatenate(out_s or [np.array([])])}
    )
