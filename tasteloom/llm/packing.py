"""Best-fit packing of token sequences by linear grouping.

Every document becomes token ids and an end mark.  Pieces are packed so that few
sequences of a fixed length are needed:

1. Large pieces (by default longer than a third of a sequence) are sorted and cut into groups of equal
   cardinality; every length is rounded up to the largest of its group.
2. Over these few sizes, configurations (which sizes share a sequence) are chosen, each
   used as often as its sizes last.
3. The actual pieces take the places of the rounded ones, which leaves more room.
4. The small pieces go, longest first, to the sequence with the least sufficient room.

All of this needs only how many pieces there are of each length, at most ``capacity``
numbers, whatever the size of the corpus.  The outcome is a list of sequence kinds
with the lengths in each and the number of such sequences.  Pieces find their places by
their rank among pieces of equal length, so nothing but the list of kinds is broadcast.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import small_table
from tasteloom.shared import settle
from tasteloom.spread import place_rows

CAPACITY = 2048
GROUPS = 64  # sizes that large pieces are rounded to
# Fixed value: where byte-level tokenizers cut a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


# ---------------------------------------------------------------- tokens and pieces


# Characters of which every Unicode version since 5.0 says alike whether they are letters, numbers, white space or none
# of these, so that libraries with different tables cut texts alike: ASCII, Latin, Cyrillic, kana, Chinese and
# Korean, dashes, quotes and dots.
_SETTLED = re.compile(
    "[\\x00-\\x7F\u00A1-\u00AC\u00AE-\u024F\u0400-\u0481\u048A-\u04FF\u2010-\u2027\u3041-\u3096\u30A1-\u30FA"
    "\u4E00-\u9FA5\uAC00-\uD7A3]*"
)


class _Tokens:
    """Ids (little-endian 32-bit) of a text, as the tokenizer file at ``path`` gives them.

    A text goes whole to the ``tokenizers`` library, but for texts of settled characters where the file is plain
    byte-level BPE: those go to a faster library with the same vocabulary.  ``marks`` finds the tokens that the
    file adds to its model, such as an end mark; texts are cut at them before anything else.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.fast, self.marks = Tokenizer.from_file(path), _fast_ids(path), _marks(path)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        return self.fast(text) if self.fast is not None and _SETTLED.fullmatch(text) else self.whole(text)

    def of(self, text: str) -> bytes:
        if self.marks is None or not self.marks.search(text):
            return self.plain(text)
        if not self.marks.pattern:
            return self.whole(text)
        out, at = [], 0
        for mark in self.marks.finditer(text):
            out += [self.plain(text[at : mark.start()]), self.whole(mark[0])]
            at = mark.end()
        return b"".join([*out, self.plain(text[at:])])


def _fast_ids(path: str) -> Callable[[str], bytes] | None:
    """A faster way to the same ids, if the file is of a kind that allows it.

    It is for plain byte-level BPE whose ids follow the order of the merges.
    """
    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    model, cut_by = described["model"], described.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(
        [described.get("normalizer"), described.get("truncation"), described.get("post_processor"), model.get("dropout"),
         model.get("unk_token"), model.get("continuing_subword_prefix"), model.get("end_of_word_suffix"), model.get("ignore_merges")]
    )
    if not plain or cut_by.get("type") != "ByteLevel" or cut_by.get("add_prefix_space") or not cut_by.get("use_regex"):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if len(model["vocab"]) != 256 + len(merges) or any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    import tiktoken

    # Bytes that print stand for themselves, the others for the characters from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = sorted(set(range(256)) - set(shown))
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()}
    coder = tiktoken.Encoding("packing", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
    return lambda text: np.asarray(coder.encode_to_numpy(text, disallowed_special=()), dtype="<u4").tobytes()


def _marks(path: str) -> re.Pattern | None:
    """What finds the file's added tokens in a text, the longest first; None if it has none.

    Only tokens that stand for their exact characters, wherever they are, can be found this way.
    """
    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    added = [t for t in described.get("added_tokens") or [] if t["content"]]
    if not added:
        return None
    if described.get("normalizer") or any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
        return re.compile("")  # every text goes whole to the tokenizer
    if len({bool(t.get("normalized")) for t in added}) > 1:
        return re.compile("")  # looked for one kind after the other
    return re.compile("|".join(re.escape(t) for t in sorted((t["content"] for t in added), key=len, reverse=True)))


@lru_cache(maxsize=2)
def _tokens(path: str) -> _Tokens:
    return _Tokens(path)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids: full ones, but the first may be shorter."""
    head = n % capacity or min(n, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece of every row of ``docs``, with the CRC-32 of its ids.

    A null text counts as empty and is one piece, the end mark alone.  Repeated rows give
    repeated pieces.  Only texts longer than ``capacity`` are cut.  Ids are the file's own, so its added
    tokens get their own id wherever a text holds them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = _tokens(path), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tokens.of(text.as_py() or "") + end
                for i, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc, i, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])))
            if rows:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE_SCHEMA)


# ---------------------------------------------------------------- plan over lengths


def _groups(counts: Counter, large: int, groups: int) -> list[list[list[int]]]:
    """Linear grouping: runs ``[length, count]``, longest first, of equally many pieces each."""
    lengths = sorted((n for n in counts if n > large), reverse=True)
    total = sum(counts[n] for n in lengths)
    out: list[list[list[int]]] = []
    size = max(1, -(-total // groups))
    room = 0
    for n in lengths:
        left = counts[n]
        while left:
            if not room:
                out.append([])
                room = size
            take = min(left, room)
            out[-1].append([n, take])
            left -= take
            room -= take
    return out


def _configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Which groups share a sequence, and how often; sizes descend.

    Takes the largest size that is left, fills up with the one or two sizes that leave
    least room, and uses this as often as the counts allow.  Each turn uses up a size.
    """
    left = list(counts)
    out = []
    for first in range(len(sizes)):
        while left[first]:
            left[first] -= 1
            room = capacity - sizes[first]
            best, fill = [first], 0
            alive = [g for g in range(first, len(sizes)) if left[g] and sizes[g] <= room]
            for g in alive:
                if sizes[g] > fill:
                    best, fill = [first, g], sizes[g]
                left[g] -= 1
                rest = room - sizes[g]
                h = next((h for h in alive if h >= g and left[h] and sizes[h] <= rest), None)
                if h is not None and sizes[g] + sizes[h] > fill:
                    best, fill = [first, g, h], sizes[g] + sizes[h]
                left[g] += 1
            left[first] += 1
            need = Counter(best)
            times = min(left[g] // k for g, k in need.items())
            for g, k in need.items():
                left[g] -= k * times
            out.append((best, times))
    return out


def _substitute(groups: list[list[list[int]]], chosen: list[tuple[list[int], int]]) -> Counter:
    """Sequence kinds (descending lengths) with actual pieces in place of the rounded ones."""
    kinds: Counter = Counter()

    def take(g: int, k: int) -> None:
        groups[g][0][1] -= k
        if not groups[g][0][1]:
            groups[g].pop(0)

    for members, times in chosen:
        need = Counter(members)
        while times:
            lengths: list[int] = []
            step = min([times, *(groups[g][0][1] // k for g, k in need.items())])
            if step:
                for g, k in need.items():
                    lengths += [groups[g][0][0]] * k
                    take(g, k * step)
            else:  # a sequence takes the last of one length and the first of the next
                step = 1
                for g in members:
                    lengths.append(groups[g][0][0])
                    take(g, 1)
            kinds[tuple(sorted(lengths, reverse=True))] += step
            times -= step
    return kinds


def _best_fit(kinds: Counter, small: dict[int, int], capacity: int) -> Counter:
    """Small pieces, longest first, into the kind with the least sufficient room."""
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    order: list[int] = []

    def put(kind: tuple[int, ...], room: int, times: int) -> None:
        if room not in rooms:
            rooms[room] = []
            insort(order, room)
        rooms[room].append((kind, times))

    for kind, times in kinds.items():
        put(kind, capacity - sum(kind), times)
    for n in sorted(small, reverse=True):
        left = small[n]
        while left:
            at = bisect_left(order, n)
            if at < len(order):
                room = order[at]
                kind, times = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    order.pop(at)
            else:
                room, kind, times = capacity, (), left
            each = min(room // n, left)
            full = min(times, left // each)
            if times > full:
                put(kind, room, times - full) if kind else None
            put(kind + (n,) * each, room - each * n, full)
            left -= full * each
    out: Counter = Counter()
    for same in rooms.values():
        for kind, times in same:
            out[kind] += times
    return out


def _plan(counts: Counter, capacity: int, groups: int, large: int) -> Counter:
    runs = _groups(counts, large, groups)
    sizes = [g[0][0] for g in runs]
    chosen = _configurations(sizes, [sum(c for _, c in g) for g in runs], capacity)
    kinds = _substitute([[list(r) for r in g] for g in runs], chosen)
    return _best_fit(kinds, {n: c for n, c in counts.items() if n <= large}, capacity)


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Counter:
    """Sequence kinds (a tuple of lengths) and how many sequences are of each kind.

    Large means longer than a third, a quarter or a half of a sequence, whichever needs the
    fewest sequences.
    """
    counts = Counter({n: c for n, c in counts.items() if c})
    tries = [_plan(counts, capacity, g, capacity // part) for part in (3, 4, 2) for g in (groups, 4 * groups)]
    return min(tries, key=lambda kinds: sum(kinds.values()))


def places(kinds: Counter, counts: dict[int, int]) -> list[dict]:
    """Where pieces go: for each stretch of pieces of one length, its sequences and offsets.

    Positions are global: pieces stand in order of length.  ``per`` pieces of a stretch share
    a sequence, one after the other.
    """
    at, total = {}, 0
    for n in sorted(counts):
        at[n], total = total, total + counts[n]
    out, sequence = [], 0
    for kind in sorted(kinds, reverse=True):
        times, offset = kinds[kind], 0
        for n, per in sorted(Counter(kind).items(), reverse=True):
            out.append(
                {"length": n, "first": at[n], "last": at[n] + per * times - 1, "per": per,
                 "sequence": sequence, "base": offset}
            )
            at[n] += per * times
            offset += per * n
        sequence += times
    return out


# ---------------------------------------------------------------- the operator


def pack(found: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every row of ``found`` by its ``length``.

    Lengths are from 1 to ``capacity``.  Needs ``doc_id`` and ``piece`` for a stable order; null
    ids and repeated rows are packed like others.  An empty table gives no rows.
    """
    spark = found.sparkSession
    ordered = place_rows(found, [F.col("length"), F.col("doc_id"), F.col("piece")], "_place")
    # At most `capacity` rows.
    counts = {r["length"]: r["count"] for r in ordered.groupBy("length").count().collect()}
    schema = "length bigint, first bigint, last bigint, per bigint, sequence bigint, base bigint"
    where = small_table(spark, places(plan(counts, capacity, groups), counts), schema)
    rank = F.col("_place") - F.col("first")
    return (
        ordered.alias("p")
        .join(
            F.broadcast(where.withColumnRenamed("length", "_length")),
            (F.col("length") == F.col("_length")) & F.col("_place").between(F.col("first"), F.col("last")),
        )
        .select(
            *found.columns,
            (F.col("sequence") + F.floor(rank / F.col("per"))).cast("long").alias("sequence_id"),
            (F.col("base") + F.pmod(rank, F.col("per")) * F.col("length")).cast("long").alias("offset"),
        )
    )


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, groups: int = GROUPS
) -> DataFrame:
    """Tokenize ``docs`` (``doc_id``, ``text``) and pack the pieces; other columns do not matter.

    ``path`` is a tokenizer file that every executor can read.  The result has one row per piece:
    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.
    """
    # Written once: the range partitions sample their input before they read it.
    return pack(settle(pieces(docs, path, capacity, end_id), "pieces"), capacity, groups)
