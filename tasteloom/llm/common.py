"""Column expressions and array helpers shared by the operators of this package."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.shared import settle

# Characters that separate words: space, tab, line feed, vertical tab, form feed, return.
BLANK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and everything else as it is."""
    only_ascii = F.octet_length(text) == F.length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(number: str = "doc_id", text: str = "text") -> Column:
    """128 bits that stand for a row's id and text; equal rows share them, null is like empty."""
    parts = (F.coalesce(F.col(number).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    return F.unhex(F.md5(F.concat_ws(":", *parts).cast("binary")))


def word_array(text: Column, gap: str = BLANK) -> Column:
    """The words of ``text``; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gap), "")


def word_hashes(text: Column, gap: str = BLANK) -> Column:
    """One 64-bit hash per word of ``text``, in order."""
    return F.transform(word_array(text, gap), lambda w: F.xxhash64(w))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def small_table(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """A bounded list of the driver's as a relation, without RDDs or Python workers."""
    text = F.lit(json.dumps(list(rows)))
    return spark.range(1).select(F.inline(F.from_json(text, f"array<struct<{schema}>>")))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (``a``, ``b``): ``node`` and ``root``, its smallest node.

    Every round each node goes to the smallest node around it, and on to where that one goes; then
    links are drawn between the nodes that are left, without repeats.  So links get few fast.  What
    a round makes is written; joins have plain shuffles on both sides, so adaptive
    execution can split a node with very many links.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    links = settle(edges.filter("a <> b").select(low, high).distinct(), "links")
    found = None
    while found is None or not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hop = both.groupBy("a").agg(F.min("b").alias("m"))
        hop = settle(hop.select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "hop")
        up = hop.select(F.col("node").alias("root"), F.col("root").alias("top"))
        hop = settle(hop.join(up, "root").select("node", F.col("top").alias("root")), "hop")
        if found is None:
            found = hop
        else:
            on = hop.select(F.col("node").alias("root"), F.col("root").alias("top"))
            found = settle(found.join(on, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "found")
        one = hop.select(F.col("node").alias("a"), F.col("root").alias("x"))
        two = hop.select(F.col("node").alias("b"), F.col("root").alias("y"))
        drawn = links.join(one, "a").join(two, "b").filter("x <> y")
        links = settle(drawn.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    return found


def shared_keys(keyed: DataFrame, key: str, value: str) -> DataFrame:
    """Rows ``(key, value)``, both longs, of keys that occur more than once.

    A key may own any share of the rows: its rows are spread over several tasks.

    After a sort over range partitions a row is alone only if neither neighbour has its key.
    The first and last key of a partition may go on in the next one, so they always stay,
    and a few keys that occur once come out as well.
    """
    order = (key, value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_k, rest_c = np.array([], dtype=np.int64), np.array([], dtype=np.int64)
        first = True
        for batch in batches:
            k = np.concatenate([rest_k, batch.column(0).to_numpy()])
            c = np.concatenate([rest_c, batch.column(1).to_numpy()])
            if not len(k):
                continue
            # The last row waits for its successor; the one before it is kept for comparison.
            same = k[1:] == k[:-1]
            stay = np.zeros(len(k), dtype=bool)
            stay[1:] |= same
            stay[:-1] |= same
            begin = 0 if first else 1
            if first:
                stay |= k == k[0]
            end = len(k) - 1
            out = np.flatnonzero(stay[begin:end]) + begin
            if len(out):
                yield pa.RecordBatch.from_arrays([pa.array(k[out]), pa.array(c[out])], list(order))
            first = False
            rest_k, rest_c = k[max(0, end - 1) :], c[max(0, end - 1) :]
            if end == 0:
                first = True
        if len(rest_k):
            yield pa.RecordBatch.from_arrays([pa.array(rest_k[-1:]), pa.array(rest_c[-1:])], list(order))

    placed = keyed.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.mapInArrow(run, f"{key} bigint, {value} bigint")


def lists_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and row limits of an Arrow list column of longs; a null row is empty."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    limits = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=limits[1:])
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), limits
