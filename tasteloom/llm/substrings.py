"""Repeated passages, found by hashes of content-defined blocks and of windows of words.

This is no Lempel-Ziv parse: nothing is factored greedily and no match is extended.  Documents are
compared with reference blocks, the blocks of text at their first place in the corpus:

1. Content cuts a document into chunks of 19 or more words (a cut is where the hash of the next
   words is least within 18 places on both sides).  A block is two neighbouring chunks, so every
   window of 20 words lies in one block.
2. Whole blocks are compared first: all words of a block that stands earlier are covered.  What remains are the reference blocks, each at its first place.
3. A passage may cover part of a reference block.  All windows of these blocks are looked up one by one, but only if their anchor, the least hash of five words in the
   window, occurs elsewhere too; equal windows have equal anchors.
4. A window found earlier covers its words.  Neighbouring covered words are one duplicate span.

A first place is never inside a block that stands earlier, so looking up windows of
reference blocks among windows of reference blocks misses nothing.  Blocks and windows are
compared by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import lists_of, mix, shared_keys, word_array
from tasteloom.shared import new_path, remove, settle, store

WINDOW = 20
ANCHOR = 5
AT_ONCE = 400_000  # words handled together in a task
BASE, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
LAST = (1 << 63) - 1
EMPTY = hashlib.sha256(b"").hexdigest()


def _least(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` values from each place on; beyond the end nothing counts."""
    out, have = a, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out, np.concatenate([out[step:], np.full(step, NONE)]))
        have += step
    return out


class Parsed:
    """Hashes, chunks and anchors of several documents that lie one after the other.

    Between documents stands a gap that is wider than any look around, so that none sees the
    words of another.
    """

    def __init__(self, words: list[np.ndarray], window: int):
        self.window = window
        gap = 2 * window
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + gap)])[:-1] + gap
        self.lengths = lengths
        total = int((lengths + gap).sum()) + gap
        flat = np.zeros(total, dtype=np.uint64)
        left = np.zeros(total, dtype=np.int64)  # words from here to the document's end
        for w, s in zip(words, self.starts, strict=True):
            flat[s : s + len(w)] = w
            left[s : s + len(w)] = np.arange(len(w), 0, -1)
        self.left = left
        powers = np.full(total, BASE, dtype=np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        self.back = np.full(total, INVERSE, dtype=np.uint64)
        self.back[0] = 1
        self.back = np.cumprod(self.back)
        one, two = mix(flat + np.uint64(1)), mix(flat ^ np.uint64(0x5851F42D4C957F2D))
        self.sums = [np.concatenate([[np.uint64(0)], np.cumsum(x * powers)]) for x in (one, two)]
        grams = self.hashes(0, np.arange(total - gap), ANCHOR)
        value = np.full(total, NONE)
        value[: total - gap] = np.where(left[: total - gap] >= ANCHOR, grams, NONE)
        self.anchor = _least(value, window - ANCHOR + 1)  # of the window that starts here
        self.anchor[left < window] = NONE
        reach = window - 2
        around = _least(value, reach)
        before = np.concatenate([np.full(reach, NONE), around[:-reach]])
        after = np.concatenate([around[1:], [NONE]])
        cut = (value < before) & (value <= after)
        cut[self.starts[lengths > 0]] = True
        self.cuts = np.flatnonzero(cut & (left > 0))
        self.value = value

    def hashes(self, which: int, start: np.ndarray, length) -> np.ndarray:
        """64-bit hashes of the words from ``start`` on."""
        sums = self.sums[which]
        return mix((sums[start + length] - sums[start]) * self.back[start])

    def blocks(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the blocks of document ``i``; none if it has no window."""
        s, n = self.starts[i], self.lengths[i]
        if n < self.window:
            return np.array([], dtype=np.int64), np.array([], dtype=np.int64)
        a, b = np.searchsorted(self.cuts, [s, s + n])
        cuts = self.cuts[a:b]
        ends = np.concatenate([cuts[1:], [s + n]])
        return (cuts[:-1], ends[1:]) if len(cuts) > 1 else (cuts, ends)

    def anchors(self, i: int) -> np.ndarray:
        """Hashes of all anchors in document ``i``, one for each place."""
        s, n = self.starts[i], self.lengths[i]
        if n < self.window:
            return np.array([], dtype=np.uint64)
        width = self.window - ANCHOR + 1
        windows = self.anchor[s - width + 1 : s + n].copy()
        windows[windows == NONE] = 0
        # A place is an anchor if it is the least of some window that holds it.
        most = ~_least(~windows, width)[: n]
        value = self.value[s : s + n]
        return value[(value == most) & (value != NONE)]


def _parsed(batch_words: tuple[np.ndarray, np.ndarray], window: int) -> Iterator[tuple[int, int, Parsed]]:
    """Stretches of rows with about ``AT_ONCE`` words: first row, row after the last, parse."""
    flat, limits = batch_words
    a, rows = 0, len(limits) - 1
    while a < rows:
        b = max(a + 1, int(np.searchsorted(limits, limits[a] + AT_ONCE, side="right")) - 1)
        yield a, b, Parsed([flat[limits[i] : limits[i + 1]] for i in range(a, b)], window)
        a = b


def _identified(docs: DataFrame) -> DataFrame:
    """``doc_id, o, t, text``: ``(o, t)`` is the place in the order of documents, null ids last."""
    number = F.col("doc_id").cast("long")
    return docs.select(
        number.alias("doc_id"),
        F.coalesce(number, F.lit(LAST)).alias("o"),
        F.xxhash64(number, F.col("text")).alias("t"),
        "text",
    )


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _lists(parts: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate([*parts, np.array([], dtype=kind)]).astype(kind)
    return pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64) if kind == np.uint64 else values))


def parse(docs: DataFrame, window: int) -> DataFrame:
    """Blocks and anchors per document, with the digest of all its words."""
    rows = _identified(docs).withColumn("words", word_array(F.col("text")))
    rows = rows.select(
        "doc_id", "o", "t", F.size("words").cast("long").alias("n_words"),
        F.sha2(F.array_join("words", " ").cast("binary"), 256).alias("whole"), _hashed(F.col("words")).alias("hashes"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2, at, anchors = [], [], [], []
            for a, b, p in _parsed(lists_of(batch.column(5)), window):
                for i in range(b - a):
                    start, end = p.blocks(i)
                    h1.append(p.hashes(0, start, end - start))
                    h2.append(p.hashes(1, start, end - start))
                    at.append(start - p.starts[i])
                    anchors.append(p.anchors(i))
            lists = [_lists(h1, np.uint64), _lists(h2, np.uint64), _lists(at, np.int32), _lists(anchors, np.uint64)]
            names = ["doc_id", "o", "t", "n_words", "whole", "h1", "h2", "at", "anchors"]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(5)] + lists, names)

    return rows.mapInArrow(
        run,
        "doc_id bigint, o bigint, t bigint, n_words bigint, whole string, h1 array<bigint>, h2 array<bigint>, "
        "at array<int>, anchors array<bigint>",
    )


def first_places(rows: DataFrame, out: str) -> DataFrame:
    """Of rows ``(h1, h2, o, t, at)`` the first place of each hash, gathered per document."""
    first = rows.groupBy("h1", "h2").agg(F.min(F.struct("o", "t", "at")).alias("p"))
    return first.select("p.*").groupBy("o", "t").agg(F.collect_list("at").alias(out))


def _judged(starts: np.ndarray, ends: np.ndarray, joined: str) -> tuple[np.ndarray, np.ndarray, int, str]:
    """Starts and ends of the spans, number of covered words, digest of the others."""
    words = joined.split(" ") if joined else []
    mark = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, ends, -1)
    gone = np.cumsum(mark[:-1]) > 0
    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    kept = joined if not gone.any() else " ".join(words[i] for i in np.flatnonzero(~gone))
    digest = hashlib.sha256(kept.encode()).hexdigest()
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), int(gone.sum()), digest


RESULT_NAMES = ["span_starts", "span_ends", "n_removed", "kept_sha256"]
RESULT = "span_starts array<int>, span_ends array<int>, n_removed bigint, kept_sha256 string"


def _result(judged: list) -> list[pa.Array]:
    """The columns of ``RESULT``; None for a row without a result yet."""
    none = np.array([], dtype=np.int64)
    return [
        _lists([none if j is None else j[0] for j in judged], np.int32),
        _lists([none if j is None else j[1] for j in judged], np.int32),
        pa.array([None if j is None else j[2] for j in judged], pa.int64()),
        pa.array([None if j is None else j[3] for j in judged], pa.string()),
    ]


def look_up(docs: DataFrame, known: DataFrame, window: int) -> DataFrame:
    """Covered words by blocks, and windows still to look up, of the documents in ``known``.

    ``known`` has ``o, t, refs`` (block starts that are first places) and ``doubles`` (anchors that
    occur elsewhere).  A document with windows to look up takes its words along (``joined``); one
    without any has its result here; one without covered words or windows is left out.
    """
    # The text is sent as it is, the words are cut after the join.
    rows = _identified(docs).join(known, ["o", "t"]).withColumn("words", word_array(F.col("text")))
    rows = rows.select("o", "t", _hashed(F.col("words")).alias("hashes"), "refs", "doubles", F.array_join("words", " ").alias("joined"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs, ref_ends = lists_of(_longs(batch.column(3)))
            doubles, double_ends = lists_of(batch.column(4))
            out, starts, ends, w1, w2, at, texts, judged = [], [], [], [], [], [], [], []
            for a, b, p in _parsed(lists_of(batch.column(2)), window):
                for i in range(b - a):
                    s, n = p.starts[i], int(p.lengths[i])
                    row = a + i
                    start, end = p.blocks(i)
                    own = np.isin(start - s, refs[ref_ends[row] : ref_ends[row + 1]].astype(np.int64))
                    places = np.arange(s, s + max(0, n - window + 1))
                    mine = np.isin(p.anchor[places], doubles[double_ends[row] : double_ends[row + 1]])
                    if len(start):
                        # The block of a window is that of the chunk in which it starts.
                        mine &= own[np.minimum(np.searchsorted(start, places, side="right") - 1, len(own) - 1)]
                    places = places[mine]
                    covered = (start - s)[~own], (end - s)[~own]
                    if not len(covered[0]) and not len(places):
                        continue
                    joined = batch.column(5)[row].as_py()
                    out.append(row)
                    starts.append(covered[0])
                    ends.append(covered[1])
                    w1.append(p.hashes(0, places, window))
                    w2.append(p.hashes(1, places, window))
                    at.append(places - s)
                    texts.append(joined if len(places) else None)
                    judged.append(None if len(places) else _judged(*covered, joined))
            lists = [_lists(starts, np.int32), _lists(ends, np.int32), _lists(w1, np.uint64), _lists(w2, np.uint64), _lists(at, np.int32)]
            ids = [batch.column(c).take(pa.array(out, pa.int64())) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*ids, *lists, pa.array(texts, pa.string()), *_result(judged)],
                ["o", "t", "starts", "ends", "w1", "w2", "at", "joined", *RESULT_NAMES],
            )

    return rows.mapInArrow(
        run,
        "o bigint, t bigint, starts array<int>, ends array<int>, w1 array<bigint>, w2 array<bigint>, at array<int>, "
        "joined string, " + RESULT,
    )


def finish(rows: DataFrame, window: int) -> DataFrame:
    """Spans and digest from ``starts, ends`` (covered blocks), ``again`` (windows) and the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, block_limits = lists_of(_longs(batch.column(2)))
            ends, _ = lists_of(_longs(batch.column(3)))
            again, again_limits = lists_of(_longs(batch.column(4)))
            judged = []
            for row in range(batch.num_rows):
                x = slice(block_limits[row], block_limits[row + 1])
                y = again[again_limits[row] : again_limits[row + 1]].astype(np.int64)
                begin = np.concatenate([blocks[x].astype(np.int64), y])
                end = np.concatenate([ends[x].astype(np.int64), y + window])
                judged.append(_judged(begin, end, batch.column(5)[row].as_py()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *_result(judged)], ["o", "t", *RESULT_NAMES])

    return rows.select("o", "t", "starts", "ends", "again", "joined").mapInArrow(run, "o bigint, t bigint, " + RESULT)


def _longs(column) -> pa.Array:
    return column.cast(pa.list_(pa.int64()))


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Duplicate spans of every row of ``docs`` (``doc_id``, ``text``).

    Columns: ``doc_id, n_words, n_removed, span_starts, span_ends`` (word numbers from 0, end
    exclusive) and ``kept_sha256``, the digest of the words outside the spans.  Earlier means a smaller
    id, or the same document and an earlier start; rows with the same id and different
    texts are ordered by a hash, null ids come last, and rows with equal id and text are one
    document with one result.  A null text has no words.  Other columns do not matter; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    place = new_path(spark, "parsed")
    parsed = store(parse(docs, window), place)
    facts = settle(parsed.select("doc_id", "o", "t", "n_words", "whole"), "facts")
    blocks = parsed.select("o", "t", F.inline(F.arrays_zip("h1", "h2", "at")))
    refs = settle(first_places(blocks, "refs"), "refs")
    doubles = shared_keys(parsed.select(F.explode("anchors").alias("anchor"), "t"), "anchor", "t")
    doubles = settle(doubles.groupBy("t").agg(F.collect_set("anchor").alias("doubles")), "doubles")
    # Blocks and anchors are the largest table of all; nothing reads them from here on.
    remove(spark, [place])
    marked = facts.select("o", "t").distinct().join(doubles, "t")
    found = settle(look_up(docs, marked.join(refs, ["o", "t"], "left"), window), "lookups")
    windows = found.select("o", "t", F.inline(F.arrays_zip(F.col("w1").alias("h1"), F.col("w2").alias("h2"), "at")))
    firsts = settle(first_places(windows, "firsts"), "firsts")
    left = found.filter(F.col("joined").isNotNull()).select("o", "t", "starts", "ends", "at", "joined")
    left = left.join(firsts, ["o", "t"], "left")
    again = F.when(F.col("firsts").isNull(), F.col("at")).otherwise(F.array_except("at", "firsts"))
    early = found.filter(F.col("joined").isNull()).select("o", "t", *RESULT_NAMES)
    done = finish(left.withColumn("again", again), window).unionByName(early).dropDuplicates(["o", "t"])
    none = F.array().cast("array<int>")
    return facts.join(done, ["o", "t"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("span_starts", none).alias("span_starts"),
        F.coalesce("span_ends", none).alias("span_ends"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )
