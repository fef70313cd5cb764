"""Byte-level BPE: encoding by a perfect-hash lookup and a heap of merges, and decoding.

A text is cut by the tokenizer's pattern; every piece is encoded for itself.  A piece
that is a token is found in one step in a minimal perfect hash over the vocabulary
(hash and displace: every key has a slot of its own, as many slots as keys).  The others
start as single bytes in a doubly linked list; a heap gives the pair of lowest rank, leftmost
first, until no adjacent pair is a token.

Texts meet in chunks whose different words are encoded once, and results of frequent words and pieces are
remembered per Python worker, in dictionaries of bounded size.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

# Pieces (about 200 bytes each) and words (about 30) remembered per Python worker.  Frequent ones are met
# early, so a full memory stays as it is; what it lacks is worked out each time.
PIECES, WORDS = 600_000, 1_000_000
CHUNK = 5_000_000  # characters of texts that are looked at together
PORTION = 1_000_000  # characters, or ids, that are worked on at once


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


class PerfectHash:
    """A minimal perfect hash of byte strings to numbers.

    Keys are dealt to buckets by one hash.  For each bucket, the largest first, a
    displacement is searched that sends all its keys to free slots; a bucket with a
    single key, dealt last, names a free slot outright.
    """

    def __init__(self, table: dict[bytes, int]):
        keys = list(table)
        self.size = max(1, len(keys))
        self.buckets = max(1, len(keys) // 3)
        members: list[list[tuple[int, bytes]]] = [[] for _ in range(self.buckets)]
        for key in keys:
            h = xxhash.xxh3_64_intdigest(key)
            members[(h >> 32) % self.buckets].append((h, key))
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * self.size
        self.values = [-1] * self.size
        order = sorted(range(self.buckets), key=lambda b: -len(members[b]))
        free = iter(range(self.size))
        for b in order:
            own = members[b]
            shift = 0
            if len(own) == 1:
                slots = [next(s for s in free if self.keys[s] is None)]
                shift = -1 - slots[0]
            else:
                while True:
                    slots = [self._slot(h, shift) for h, _ in own]
                    if all(self.keys[s] is None for s in slots) and len(set(slots)) == len(slots):
                        break
                    shift += 1
            self.shift[b] = shift
            for slot, (_, key) in zip(slots, own, strict=True):
                self.keys[slot], self.values[slot] = key, table[key]

    def _slot(self, h: int, shift: int) -> int:
        if shift < 0:
            return -1 - shift
        return (((h ^ (shift * 0x9E3779B97F4A7C15)) * 0xFF51AFD7ED558CCD) >> 24 & 0xFFFFFFFF) % self.size

    def get(self, key: bytes) -> int:
        """The number of ``key``, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        slot = self._slot(h, self.shift[(h >> 32) % self.buckets])
        return self.values[slot] if self.keys[slot] == key else -1


def joins(ranks: dict[bytes, int]) -> dict[int, int]:
    """The token that a left and a right token make together, for all that make one."""
    out = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                out[left << 32 | right] = rank
    return out


def merge_heap(piece: bytes, single: list[int], join) -> list[int]:
    """Tokens of one piece: merge the adjacent pair of lowest rank until none makes a token.

    ``single`` has the token of each byte, ``join`` gives the token of a pair or None.
    """
    ids = [single[b] for b in piece]
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    # Rank and place in one number; the place takes the low 32 bits.
    heap = [r << 32 | i for i in range(n - 1) if (r := join(ids[i] << 32 | ids[i + 1])) is not None]
    heapify(heap)
    while heap:
        top = heappop(heap)
        i, rank = top & 0xFFFFFFFF, top >> 32
        j = after[i]
        # A pair that has changed since it was put on the heap is out of date.
        if ids[i] < 0 or j >= n or join(ids[i] << 32 | ids[j]) != rank:
            continue
        ids[i], ids[j] = rank, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := join(rank << 32 | ids[k])) is not None:
                heappush(heap, r << 32 | i)
        h = before[i]
        if h >= 0 and (r := join(ids[h] << 32 | rank)) is not None:
            heappush(heap, r << 32 | h)
    return [i for i in ids if i >= 0]


class Pieces(dict):
    """Ids (little-endian 32-bit, as bytes) of a piece of the pattern, worked out when missing."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.whole = PerfectHash(ranks)
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.join = joins(ranks).get

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        one = self.whole.get(raw)
        ids = [one] if one >= 0 else merge_heap(raw, self.single, self.join)
        made = pack(f"<{len(ids)}I", *ids)
        if len(raw) <= 64 and len(self) < PIECES:
            self[piece] = made
        return made


class Encoder:
    """Ids of texts by the ranks in the file at ``path``; every match of ``pattern`` is encoded by itself."""

    def __init__(self, path: str, pattern: str):
        self.piece = Pieces(read_ranks(path))
        self.find = regex.compile(pattern).findall
        # Words met before, and the ids of each after a space.
        self.known = pa.array([], pa.large_string())
        self.values, self.sizes = np.array([], dtype="<u4"), np.array([], dtype=np.int64)

    def of(self, text: str) -> bytes:
        return b"".join(map(self.piece.__getitem__, self.find(text)))

    def __call__(self, text: str | None) -> bytes:
        """Ids of a text as little-endian 32-bit integers; a null text has none."""
        return self.many([text])[0]

    def many(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of several texts.  Texts meet in chunks of bounded length, and each chunk's different words are looked up once."""
        out: list[list[bytes]] = [[] for _ in texts]
        chunk: list[str] = []
        rows: list[int] = []
        size = 0

        def done() -> None:
            for row, ids in zip(rows, self._chunk(chunk), strict=True):
                out[row].append(ids)

        for row, text in enumerate(texts):
            for part in portions(text or ""):
                if _ALONE.search(part):
                    # Spaces among white space: no cut before a space.  What came before it must not be overtaken.
                    chunk.append("")
                    rows.append(row)
                    done()
                    chunk, rows, size = [], [], 0
                    out[row].append(self.of(part))
                    continue
                chunk.append(part)
                rows.append(row)
                size += len(part)
                if size > CHUNK:
                    done()
                    chunk, rows, size = [], [], 0
        done()
        return [b"".join(parts) for parts in out]

    def _chunk(self, texts: list[str]) -> list[bytes]:
        """Ids of texts in which the pattern cuts before every space."""
        if not texts:
            return []
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        limits = cut.offsets.to_numpy()
        firsts = limits[:-1]
        coded = cut.flatten().dictionary_encode()
        values, sizes, place = self._words(coded.dictionary)
        number = place[coded.indices.to_numpy()]
        # A text's first part has no space before it.
        number[limits[:-1]] = len(sizes) + np.arange(len(texts))
        first = [self.of(t.partition(" ")[0]) for t in texts]
        values = np.concatenate([values, np.frombuffer(b"".join(first), dtype="<u4")])
        sizes = np.concatenate([sizes, np.array([len(p) // 4 for p in first])])
        raw = gather(values, sizes, number).tobytes()
        ends = 4 * np.concatenate([[0], np.cumsum(sizes[number])])[limits]
        return [raw[a:b] for a, b in pairwise(ends.tolist())]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of known and new words in a row, how many each has, and where each of ``words`` stands among them."""
        place = pc.index_in(words, value_set=self.known)
        new = words.filter(place.is_null())
        made, lengths = self._spelt(new.to_pylist())
        values, sizes = np.concatenate([self.values, made]), np.concatenate([self.sizes, lengths])
        numbers = place.fill_null(-1).to_numpy().astype(np.int64)
        numbers[numbers < 0] = len(self.known) + np.arange(len(new))
        if len(self.known) < WORDS:
            short = pc.less_equal(pc.binary_length(new), 64).to_numpy(zero_copy_only=False)
            kept = np.flatnonzero(short)[: WORDS - len(self.known)]
            self.values = np.concatenate([self.values, gather(made, lengths, kept)])
            self.sizes = np.concatenate([self.sizes, lengths[kept]])
            self.known = pa.concat_arrays([self.known, new.take(pa.array(kept))])
        return values, sizes, numbers

    def _spelt(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word after a space, in a row, and how many each has.

        The words are cut together, and their different pieces are looked up once.  A piece that begins
        with a space begins a word, since words hold none.
        """
        if any(not w or w[0].isspace() for w in words):
            parts = [self.of(" " + w) for w in words]
        else:
            coded = pa.array(self.find("".join(f" {w}" for w in words)), pa.large_string()).dictionary_encode()
            pieces, number = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            parts = [self.piece[p] for p in pieces]
            begins = np.flatnonzero(np.array([p[0] == " " for p in pieces], dtype=bool)[number])
            if len(begins) == len(words):
                sizes = np.array([len(p) // 4 for p in parts], dtype=np.int64)
                values = gather(np.frombuffer(b"".join(parts), dtype="<u4"), sizes, number)
                return values, np.add.reduceat(sizes[number], begins) if len(words) else sizes
            parts = [self.of(" " + w) for w in words]
        return np.frombuffer(b"".join(parts), dtype="<u4"), np.array([len(p) // 4 for p in parts], dtype=np.int64)


def gather(values: np.ndarray, sizes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """``values`` holds runs of these ``sizes``, one after the other; the runs that ``number`` names, in a row."""
    starts = np.cumsum(sizes) - sizes
    taken = sizes[number]
    ends = np.cumsum(taken)
    if not len(ends) or not ends[-1]:
        return values[:0]
    # The place of each value: its run's beginning, and how far it is into the run.
    return values[np.arange(ends[-1]) + np.repeat(starts[number] - (ends - taken), taken)]


# A space with white space or an end of the text on both sides.
_ALONE = re.compile(r" (?!\S)(?<!\S )")
# A space between characters that are no white space.
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def portions(text: str) -> Iterator[str]:
    """A text in parts of bounded length that the pattern cuts as it cuts the whole.

    Patterns of this kind match a space only together with what follows it or as part of a run of white
    space, so a text may be cut before a space that has no white space on either side.
    """
    at = 0
    while len(text) - at > PORTION:
        cut = _BETWEEN.search(text, at + PORTION)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


@lru_cache(maxsize=4)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


class Decoder:
    """Bytes of many ids at once, from one array with all tokens."""

    def __init__(self, path: str):
        spelled = {i: b for b, i in read_ranks(path).items()}
        tokens = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def __call__(self, ids: bytes | None) -> bytes:
        every = np.frombuffer(ids or b"", dtype="<u4")
        parts = (every[at : at + PORTION] for at in range(0, len(every), PORTION))
        return b"".join(gather(self.bytes, self.sizes, part).tobytes() for part in parts)


@lru_cache(maxsize=4)
def _decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(text: Column, path: str, pattern: str) -> Column:
    """Binary column: the ids of ``text`` as little-endian 32-bit integers.

    ``path`` is a rank file that every executor can read.  Null and empty texts give no ids;
    a text is always encoded whole, whatever its length.
    """

    @F.pandas_udf(BinaryType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(_encoder(path, pattern).many(texts.tolist()), dtype=object)

    return run(text)


def decode(ids: Column, path: str) -> Column:
    """Binary column: the bytes that the ids of ``encode`` stand for; null gives no bytes."""

    @F.pandas_udf(BinaryType())
    def run(rows: pd.Series) -> pd.Series:
        return pd.Series(list(map(_decoder(path), rows)), dtype=object)

    return run(ids)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` of every row.  Other columns do not matter.

    One row per input row, repeated rows included; a null text counts as empty; an
    empty table gives no rows.
    """
    coded = docs.select("doc_id", encode(F.col("text"), path, pattern).alias("ids"))
    return coded.select("doc_id", "ids", decode(F.col("ids"), path).alias("decoded"))
