"""Importance resampling towards a target distribution, over hashed runs of words.

Words are looked up by an Aho-Corasick automaton.  Its patterns are words with the delimiter on
both sides, so it finds whole words only, and each carries its CRC-32 and length in bytes.
A run of words gets its CRC from those of its words (CRC-32 is linear, so the CRC of a
concatenation follows from both CRCs and the second length); no run is ever put together.
The words between two findings are not in the automaton yet: they are worked out directly, and go into the
automaton as long as there is room, so its size is bounded and the result never depends on it.

Every document is scanned once.  Its buckets, two bytes per run, are written down; counting and
scoring read those.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import row_key
from tasteloom.shared import settle
from tasteloom.spread import place_rows, spread_join, unused

BUCKETS = 10_000
LONGEST = 1  # words in the longest run that is a feature
LEAST_WORDS = 20  # of documents that may be drawn
PERCENT = 10
SEED = 2024
WORDS = 100_000  # words an automaton takes at most; the others are worked out each time
PIECE = 4_000_000  # bytes that are scanned at once

# Lower-case A-Z; every other byte below 128 that is no digit and no letter separates words.
_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


class Lexicon:
    """An automaton over the words met so far, at most ``most``; payloads are CRC-32 and length."""

    def __init__(self, most: int = WORDS):
        self.most = most
        self.known: dict[bytes, int] = {}
        self.met: set[bytes] = set()
        self._build()

    def _build(self) -> None:
        for word in self.met:
            if len(self.known) < self.most:
                self.known[word] = len(self.known)
        self.met = set()
        self.crc = np.array([zlib.crc32(w) for w in self.known], dtype=np.int64)
        self.size = np.array([len(w) for w in self.known], dtype=np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for word, number in self.known.items():
            self.automaton.add_word(f" {word.decode('latin-1')} ", number)
        if self.known:
            self.automaton.make_automaton()

    def _learn(self, words: list[bytes]) -> None:
        if len(self.known) < self.most:
            self.met.update(words)
            # Growing by half keeps the time for building in proportion to the words.
            if len(self.met) > max(2_000, len(self.known) // 2):
                self._build()

    def _scan(self, piece: bytes) -> tuple[np.ndarray, np.ndarray]:
        """CRC-32 and length of every word of a piece in which all separators are spaces."""
        text = b" " + piece + b" "
        found = np.empty((0, 2), dtype=np.int64)
        if self.known:
            hits = self.automaton.iter(text.decode("latin-1"))
            found = np.fromiter(chain.from_iterable(hits), dtype=np.int64).reshape(-1, 2)
        ends, number = found[:, 0], found[:, 1]
        crc, size = self.crc[number], self.size[number]
        starts = ends - size - 1
        # Stretches between the delimiters of neighbouring findings hold words not in the automaton, or none.
        left, right = np.concatenate([[0], ends]), np.concatenate([starts, [len(text) - 1]])
        new: list[bytes] = []
        before: list[int] = []
        for i in np.flatnonzero(right > left):
            words = text[left[i] : right[i]].split()
            new += words
            before += [i] * len(words)
        if new:
            crc = np.insert(crc, before, [zlib.crc32(w) for w in new])
            size = np.insert(size, before, [len(w) for w in new])
            self._learn(new)
        return crc, size

    def scan(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """CRC-32 and length in bytes of every word of a text, in order."""
        text = text.translate(_PLAIN)
        parts, at = [], 0
        while at < len(text) or not parts:
            # A piece ends at a separator, so that no word is cut.
            cut = text.find(b" ", at + PIECE) if len(text) - at > PIECE else -1
            cut = len(text) if cut < 0 else cut
            parts.append(self._scan(text[at:cut]))
            at = cut + 1
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


# ------------------------------------------------------------------ CRC-32 of concatenations

_POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, reflected


def _byte_shift() -> np.ndarray:
    """What one zero byte after the message does to each bit of its CRC."""
    out = np.arange(32, dtype=np.uint64)
    out = np.uint64(1) << out
    for _ in range(8):
        out = (out >> np.uint64(1)) ^ np.where(out & np.uint64(1), np.uint64(_POLYNOMIAL), np.uint64(0))
    return out


def _apply(columns: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The linear map with these images of single bits."""
    out = np.zeros_like(crc)
    for bit in range(32):
        out ^= np.where((crc >> np.uint64(bit)) & np.uint64(1), columns[bit], np.uint64(0))
    return out


def joined_crc(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings in a row, from both CRCs and the length of the second."""
    out, columns, left = first.astype(np.uint64), _byte_shift(), size.astype(np.int64)
    while len(left) and left.max() > 0:
        odd = (left & 1).astype(bool)
        out[odd] = _apply(columns, out[odd])
        columns, left = _apply(columns, columns), left >> 1
    return out ^ second.astype(np.uint64)


def runs(crc: np.ndarray, size: np.ndarray, longest: int) -> np.ndarray:
    """CRC-32 of all runs of 1 to ``longest`` words that stand next to each other, joined by one space."""
    out = [crc.astype(np.uint64)]
    one, space = out[0], np.uint64(zlib.crc32(b" "))
    for n in range(2, longest + 1):
        if len(crc) < n:
            break
        before = joined_crc(out[-1][: len(crc) - n + 1], np.full(len(crc) - n + 1, space), np.ones(len(crc) - n + 1))
        out.append(joined_crc(before, one[n - 1 :], size[n - 1 :]))
    return np.concatenate(out)


# ------------------------------------------------------------------ tables

_lexicons: dict[int, Lexicon] = {}


def _codes(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def coded(texts: DataFrame, buckets: int, longest: int, words: int) -> DataFrame:
    """``texts``, whose last column is a text, with ``n_words`` and ``codes`` (the buckets of its features) in place of it."""
    kind = _codes(buckets)
    kept = "".join(f"{name} {of}, " for name, of in texts.dtypes[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Workers go on to other tasks, so what one has learnt serves them all.
        lexicon = _lexicons.setdefault(words, Lexicon(words))
        for batch in batches:
            counts, out = [], []
            for value in batch.column(batch.num_columns - 1):
                crc, size = lexicon.scan(value.as_buffer().to_pybytes() if value.is_valid else b"")
                counts.append(len(crc))
                out.append((runs(crc, size, longest) % np.uint64(buckets)).astype(kind).tobytes())
            columns = [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "n_words", "codes"])

    return texts.mapInArrow(run, f"{kept}n_words long, codes binary")


def _flat(column, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All codes of an Arrow binary column and the limits of its rows."""
    values = column.to_pylist()
    limits = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum([len(v) for v in values], out=limits[1:])
    return np.frombuffer(b"".join(values), dtype=kind), limits // np.dtype(kind).itemsize


def bucket_counts(table: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows; tasks send one sum per bucket."""
    kind = _codes(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            flat, _ = _flat(batch.column(0), kind)
            total += np.bincount(flat, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    found = table.select("codes").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in found.collect():  # at most one row per bucket
        out[bucket] = n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much more frequent a bucket is in the target, counts smoothed by one."""
    buckets, all_own, all_target = len(own), int(own.sum()), int(target.sum())
    out = [
        math.floor(1000 * math.log(float(t + 1) * float(all_own + buckets) / (float(s + 1) * float(all_target + buckets))))
        for s, t in zip(own.tolist(), target.tolist(), strict=True)
    ]
    return np.array(out, dtype=np.int64)


def weighed(table: DataFrame, gain: np.ndarray) -> DataFrame:
    """``n_features`` and ``weight`` in place of ``codes``."""
    kind = _codes(len(gain))
    kept = ", ".join(f"`{name}` {kind_}" for name, kind_ in table.dtypes[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, limits = _flat(batch.column(batch.num_columns - 1), kind)
            total = np.concatenate([[0], np.cumsum(gain[flat])])
            columns = [*batch.columns[:-1], pa.array(np.diff(limits)), pa.array(total[limits[1:]] - total[limits[:-1]])]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "n_features", "weight"])

    return table.mapInArrow(run, f"{kept}, n_features long, weight long")


def scores(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, least_words: int = LEAST_WORDS,
    percent: int = PERCENT, seed: int = SEED, words: int = WORDS,
) -> DataFrame:
    """Every row's ``doc_id, row, n_words, n_features, weight, score, rank``.

    ``docs`` needs ``doc_id`` and ``text``, ``target`` needs ``text``; other columns are ignored, whatever their names.
    ``row`` stands for id and text.  A score is the weight plus Gumbel noise that the id alone
    decides.  Of the N rows with ``least_words`` words, the floor(percent * N / 100) highest scores are
    drawn, ties to the smaller id (null last); ``rank`` counts them from 1 and is null for all others.

    A null text has no words; a null id has the noise of an empty one.  Rows that repeat, or share
    an id, are each scored and ranked.  An empty target leaves the smoothing; empty ``docs`` give no rows.  Texts
    of any length are scanned whole, in pieces of bounded size.
    """
    own = settle(coded(docs.select("doc_id", row_key().alias("row"), "text"), buckets, longest, words), "coded")
    wanted = settle(coded(target.select("text"), buckets, longest, words), "target")
    table = weighed(own, gains(bucket_counts(own, buckets), bucket_counts(wanted, buckets)))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = table.withColumn("score", F.col("weight") + noise).withColumn("may", F.col("n_words") >= least_words)
    order = [F.desc("may"), F.desc("score"), F.asc_nulls_last("doc_id"), F.col("row")]
    placed = place_rows(scored, order, "at")
    drawn = F.floor(placed.agg(F.count_if("may")).scalar() * percent / 100)
    rank = F.when(F.col("may") & (F.col("at") < drawn), F.col("at") + 1)
    return placed.select("doc_id", "row", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def draw(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that ``scores`` draws, all their columns as they are.

    Rows with equal id and text stay together: if one of them is drawn, so are the others.
    """
    (row,) = unused(docs.columns, "row")
    drawn = scores(docs, target, **settings).filter(F.col("rank").isNotNull()).select(F.col("row").alias(row)).distinct()
    return spread_join(docs.withColumn(row, row_key()), drawn, [row], "left_semi").select(*docs.columns)
