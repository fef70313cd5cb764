"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard has many places on a ring of 2**32 points; a row belongs to the next place
clockwise of its hash.  A shard takes rows up to its bound.  What does not fit goes on
clockwise to the next place whose shard has room.  With the bounds set to the row count divided
by the shards, rounded up or down, every shard ends exactly full, and only rows of overfull
stretches leave their first shard.

Rows are ordered along the ring by a distributed sort; what the driver sees is one
count per place on the ring, a number fixed by the parameters.  All work on rows is
DataFrame operations.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import small_table
from tasteloom.shared import settle
from tasteloom.spread import place_rows

SHARDS = 16
PLACES = 64  # virtual nodes per shard
RING = 1 << 32
PREFIX = 12  # leading bits by which a row finds its place on the ring


def ring(shards: int, places: int = PLACES) -> list[tuple[int, int]]:
    """Points and shards in clockwise order; a shard's points do not depend on the other shards."""

    def scatter(x: int) -> int:
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):
            x = ((x ^ (x >> shift)) * factor) & 0xFFFFFFFFFFFFFFFF
        return x

    return sorted((scatter((s << 32 | p) + 1) % RING, s) for s in range(shards) for p in range(places))


def bounds(rows: int, shards: int) -> list[int]:
    """How many rows each shard takes: they add up to ``rows`` and differ by one at most."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def overflow(counts: list[int], owners: list[int], limits: list[int]) -> list[dict]:
    """Which stretch of rows each shard takes, when full shards pass rows on clockwise.

    ``counts`` has the rows of each place on the ring, in order.  Rows are named by their global
    position along the ring; a stretch is ``first`` to ``last`` and lies within one place.
    """
    room, used = list(limits), [0] * len(limits)
    out: list[dict] = []
    waiting: list[tuple[int, int, int]] = []  # place, first, last
    at = 0

    def take(shard: int, stretches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        rest = []
        for place, first, last in stretches:
            n = min(room[shard], last - first + 1)
            if n:
                out.append(
                    {"place": place, "first": first, "last": first + n - 1, "shard": shard, "slot": used[shard]}
                )
                room[shard] -= n
                used[shard] += n
            if first + n <= last:
                rest.append((place, first + n, last))
        return rest

    for place, (n, shard) in enumerate(zip(counts, owners, strict=True)):
        own = [(place, at, at + n - 1)] if n else []
        at += n
        waiting = take(shard, own) + take(shard, waiting)
    while waiting:  # past the end of the ring
        for shard in owners:
            waiting = take(shard, waiting)
    return out


def _with_place(df: DataFrame, points: list[tuple[int, int]]) -> DataFrame:
    """Add ``place``: the number of the first point at or after the row's hash ``at``, wrapping around."""
    edges = [p for p, _ in points]
    shift = 32 - PREFIX
    rows = []
    for prefix in range(1 << PREFIX):
        low = bisect_left(edges, prefix << shift)
        high = bisect_left(edges, (prefix + 1) << shift)
        rows.append({"prefix": prefix, "low": low, "edges": edges[low:high]})
    index = small_table(df.sparkSession, rows, "prefix: bigint, low: bigint, edges: array<bigint>")
    passed = F.size(F.filter("edges", lambda e: e < F.col("at")))
    place = F.pmod(F.col("low") + passed, F.lit(len(edges)))
    return (
        df.join(F.broadcast(index), F.shiftright("at", shift) == F.col("prefix"))
        .withColumn("place", place.cast("long"))
        .drop("prefix", "low", "edges")
    )


def assign(df: DataFrame, key: str, shards: int = SHARDS, places: int = PLACES) -> DataFrame:
    """Add ``shard`` and ``slot`` to every row of ``df``, by the hash of column ``key``.

    Every shard gets the same number of rows, give or take one; slots count from 0 without gaps.
    A null key has a place on the ring like any other.  Rows with the same key stand together
    on the ring and may fill more than one shard, so one key may own any share of the rows.
    Repeated rows each get a slot; an empty table stays empty.  Columns named ``shard`` or ``slot`` are replaced, all
    others stay: rows travel as one struct, so their names meet no other.
    """
    spark = df.sparkSession
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    hashed = F.pmod(F.xxhash64(F.col(key)), F.lit(RING))
    points = ring(shards, places)
    on_ring = df.select(F.struct(*kept).alias("row"), hashed.alias("at"))
    # After the last point comes the first one: the rows there stand in front, so that places ascend.
    turn = F.when(F.col("at") > points[-1][0], F.col("at") - RING).otherwise(F.col("at"))
    order = [F.col("turn"), F.col("row")]
    ordered = place_rows(_with_place(on_ring.withColumn("turn", turn), points), order, "number")
    ordered = settle(ordered.select("row", "place", "number"), "ring")
    counts = [0] * len(points)
    for r in ordered.groupBy("place").count().collect():  # one row per place on the ring
        counts[r["place"]] = r["count"]
    stretches = overflow(counts, [s for _, s in points], bounds(sum(counts), shards))
    schema = "place: bigint, first: bigint, last: bigint, shard: int, slot: bigint"
    where = small_table(spark, stretches, schema)
    inside = F.col("number").between(F.col("first"), F.col("last"))
    return ordered.join(F.broadcast(where), (ordered["place"] == where["place"]) & inside).select(
        "row.*", "shard", (F.col("slot") + F.col("number") - F.col("first")).alias("slot")
    )
