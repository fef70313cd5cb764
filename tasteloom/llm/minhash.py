"""Near-duplicate documents by circulant MinHash, with an exact check.

1. A document is the set of its distinct shingles.  Documents with equal sets form a class;
   from here on only classes matter.
2. Circulant MinHash: one permutation scatters shingles over a circle, a second one,
   shifted by 0, 1, 2, ... places, gives all coordinates of the signature.  The coordinates of a
   shingle are neighbours in one table, so a signature is a minimum over slices of it.
3. Bands of coordinates are bucket keys.  Sorted by key over range partitions, a bucket of any size
   needs no task of its own.
4. Buckets are blocks.  Classes of large ones are first compared exactly with the smallest class of
   one of their large buckets; those that such links join to a bucket's smallest class are cut into slices that meet
   only the slices of the bucket's other classes, not each other.  Inside a block signatures are
   compared, in the first band that two classes share; classes without a plausible partner go.
5. The sets of the others meet in the same blocks and are compared exactly.  A block passes
   on links that connect what it found to be linked, not every pair.
6. Connected components give each document its group.

A pair at the threshold shares no band with a chance of (1 - 0.8**6)**40 = 5e-6, and one more
similar far less.  Every pair that shares a band is either compared exactly or has
signatures that differ by more than five standard deviations from the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import components, lists_of, lower_ascii, mix, row_key, shared_keys, word_hashes
from tasteloom.shared import settle
from tasteloom.spread import spread_join, unused

WORDS = 5  # in a shingle
SIMILARITY = 80  # per cent
BANDS, ROWS = 40, 6
CIRCLE = 1 << 20
SLICE = 256  # classes of a bucket in one slice
SLACK = 0.14  # signatures that agree in less than the similarity less this are not compared further
FEW = 200_000  # rows named by 24 bytes each that may be broadcast
SEED = 7


def _table(seed: int, coordinates: int) -> np.ndarray:
    """Row p: the values that a shingle at place p has under the shifted permutations."""
    second = np.random.default_rng(seed).permutation(CIRCLE).astype(np.int32)
    ring = np.concatenate([second, second[:coordinates]])
    return np.lib.stride_tricks.sliding_window_view(ring, coordinates)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of ``size`` words; all words as one if there are fewer."""
    n = min(size, len(words))
    if not n:
        return np.array([], dtype=np.uint64)
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - n + 1 + k])
    return np.unique(out)


def signature(found: np.ndarray, table: np.ndarray, seed: int) -> np.ndarray:
    places = (mix(found + np.uint64(seed)) & np.uint64(CIRCLE - 1)).astype(np.int64)
    out = table[places[:1024]].min(axis=0)
    for i in range(1024, len(places), 1024):
        np.minimum(out, table[places[i : i + 1024]].min(axis=0), out=out)
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band and signature; the band's number is part of it."""
    grid = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), grid.shape[:2]).copy()
    for k in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + grid[:, :, k])
    return keys


FEATURES = "doc_id bigint, row binary, n bigint, key binary, bands array<bigint>, marks binary, sig binary"


def features(docs: DataFrame, words: int, bands: int, rows: int, seed: int) -> DataFrame:
    """Set size, set key, band keys, their low halves (``marks``) and low signature bytes per row."""
    hashed = docs.select(F.col("doc_id").cast("long"), row_key().alias("row"), word_hashes(lower_ascii(F.col("text"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(seed, bands * rows)
        for batch in batches:
            flat, limits = lists_of(batch.column(2))
            sets = [shingles(flat[a:b], words) for a, b in zip(limits, limits[1:])]
            full = [i for i, s in enumerate(sets) if len(s)]
            signs = np.zeros((len(full), bands * rows), dtype=np.int32)
            for at, i in enumerate(full):
                signs[at] = signature(sets[i], table, seed)
            keys = band_keys(signs, bands, rows)
            lows = signs.astype(np.uint8)
            key: list = [None] * len(sets)
            marks: list = [None] * len(sets)
            sig: list = [None] * len(sets)
            for at, i in enumerate(full):
                key[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                marks[i] = keys[at].astype("<u4").tobytes()
                sig[i] = lows[at].tobytes()
            ends = np.zeros(len(sets) + 1, dtype=np.int32)
            ends[1:][full] = bands
            lists = pa.ListArray.from_arrays(np.cumsum(ends).astype(np.int32), keys.reshape(-1).view(np.int64))
            sizes = pa.array([len(s) for s in sets], pa.int64())
            columns = [batch.column(0), batch.column(1), sizes, pa.array(key, pa.binary()), lists]
            columns += [pa.array(marks, pa.binary()), pa.array(sig, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n", "key", "bands", "marks", "sig"])

    return hashed.mapInArrow(run, FEATURES)


def crowded(members: DataFrame, size: int) -> DataFrame:
    """Members of buckets that hold more than ``size``: ``key, cls`` and ``rep``, the bucket's smallest class."""
    totals = members.groupBy("key").agg(F.count(F.lit(1)).alias("_all"), F.min("cls").alias("rep"))
    return spread_join(members, totals.filter(F.col("_all") > size).select("key", "rep"), ["key"])


def star_links(crowd: DataFrame, heads: DataFrame, docs: DataFrame, words: int, similarity: int) -> DataFrame:
    """Pairs ``a, b`` of a class in ``crowd`` and the representative that shares most buckets with it, if their full
    sets are similar.  What this leaves unlinked is compared in blocks all the same."""
    often = crowd.filter("cls <> rep").groupBy("cls", "rep").agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by("rep", F.struct(F.col("n"), -F.col("rep"))).alias("rep")
    pairs = settle(often.groupBy("cls").agg(best), "pairs")
    wanted = heads.select("row", "cls").join(crowd.select("cls").distinct(), "cls", "left_semi")
    sets = settle(sets_of(docs, settle(wanted, "wanted"), words, FEW), "crowd-sets")
    other = sets.join(pairs.select(F.col("rep").alias("cls")).distinct(), "cls", "left_semi")
    other = settle(other.select(F.col("cls").alias("rep"), F.col("words").alias("other")), "rep-sets")
    # A representative may be in any share of the pairs.
    both = spread_join(sets.join(pairs, "cls"), other, ["rep"])
    sized = both.select("cls", "rep", F.size("words").alias("n"), F.size("other").alias("m"), F.size(F.array_intersect("words", "other")).alias("common"))
    return sized.filter(100 * F.col("common") >= similarity * (F.col("n") + F.col("m") - F.col("common"))).select(
        F.col("rep").alias("a"), F.col("cls").alias("b")
    )


def at_home(crowd: DataFrame, groups: DataFrame) -> DataFrame:
    """``crowd`` with ``home``: the class is in the group (``node``, ``root``) of its bucket's representative."""
    own = groups.select(F.col("node").alias("cls"), F.col("root").alias("own"))
    lead = groups.select(F.col("node").alias("rep"), F.col("root").alias("lead"))
    marked = spread_join(crowd.join(own, "cls", "left"), lead, ["rep"], "left")
    return marked.select("key", "cls", F.coalesce(F.col("own") == F.col("lead"), F.lit(False)).alias("home"))


def blocks_of(members: DataFrame, size: int, marked: DataFrame | None = None) -> DataFrame:
    """Rows ``(key, cls)`` with the blocks ``one``, ``two`` in which slices of their bucket meet.

    A bucket of ``size`` members at most is one block.  ``marked`` (``key, cls, home``) has the members of all
    larger ones.  Classes at home there are linked already, so their slices meet only the others'.
    """
    totals = members.groupBy("key").agg(F.count(F.lit(1)).alias("_all")).filter(F.col("_all").between(2, size))
    zero = F.lit(0)
    small = spread_join(members, totals, ["key"]).select("key", "cls", zero.alias("slice"), zero.alias("one"), zero.alias("two"))
    if marked is None:
        return small
    slices = lambda which: F.ceil(F.count_if(which) / size).cast("int")
    counts = marked.groupBy("key").agg(slices(F.col("home")).alias("_homes"), slices(~F.col("home")).alias("_others"))
    cut = spread_join(marked, counts, ["key"])
    place = F.xxhash64("cls")
    abroad = F.col("_homes") + F.pmod(place, F.col("_others"))
    cut = cut.withColumn("slice", F.when(F.col("home"), F.pmod(place, F.col("_homes"))).otherwise(abroad).cast("int"))
    met = F.sequence(F.when(F.col("home"), F.col("_homes")).otherwise(0), F.col("_homes") + F.col("_others") - 1)
    some = cut.filter(~F.col("home") | (F.col("_others") > 0)).select("key", "cls", "slice", F.explode(met).alias("_other"))
    return small.unionByName(
        some.select("key", "cls", "slice", F.least("slice", "_other").alias("one"), F.greatest("slice", "_other").alias("two"))
    )


def _in_blocks(rows: DataFrame, work, schema: str) -> DataFrame:
    """Apply ``work`` (a dict of column lists to an Arrow batch or None) to every block of ``rows``.

    Blocks are read one after the other from sorted partitions; no more than one is held.
    """
    names = rows.columns
    keys = ["key", "one", "two"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(names.index(k)).to_numpy() for k in keys]
            change = np.zeros(batch.num_rows, dtype=bool)
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(change).tolist()]
            for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                now = tuple(c[a] for c in cols)
                if last is not None and now != last:
                    if (done := work(pa.Table.from_batches(held))) is not None:
                        yield done
                    held = []
                last = now
                held.append(batch.slice(a, b - a))
        if held and (done := work(pa.Table.from_batches(held))) is not None:
            yield done

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def plausible(members: DataFrame, feats: DataFrame, bands: int, rows: int, similarity: int) -> DataFrame:
    """Members of blocks that have a partner there: ``key, one, two, cls``.

    A partner's signature agrees well enough, its size allows the similarity, and this is the
    first band that the two share, so a pair counts in one bucket only.
    """
    least = similarity / 100 - SLACK
    joined = members.join(feats.select("cls", "n", "marks", "sig"), "cls")
    joined = joined.select("key", "one", "two", "slice", "cls", "n", "marks", "sig")

    def work(block: pa.Table) -> pa.RecordBatch | None:
        m = block.num_rows
        if m < 2:
            return None
        number = lambda name: block.column(name).to_numpy()
        grid = lambda name, kind, w: np.frombuffer(
            b"".join(block.column(name).to_pylist()), dtype=kind
        ).reshape(m, w)
        n, piece = number("n"), number("slice")
        marks, sig = grid("marks", "<u4", bands), grid("sig", np.uint8, bands * rows)
        one, two = int(number("one")[0]), int(number("two")[0])
        # The band of this bucket is where the members agree: its mark is the key's low half.
        here = np.flatnonzero((marks == np.uint32(int(number("key")[0]) & 0xFFFFFFFF)).all(axis=0))[0]
        active = np.zeros(m, dtype=bool)
        for a in range(0, m, 64):
            s = slice(a, min(a + 64, m))
            ok = 100 * np.minimum(n[s, None], n) >= similarity * np.maximum(n[s, None], n)
            ok &= (piece[s, None] != piece) if one != two else (np.arange(m)[s, None] != np.arange(m))
            if here:
                ok &= ~(marks[s, None, :here] == marks[None, :, :here]).any(axis=2)
            x, y = np.nonzero(ok)
            good = (sig[a + x] == sig[y]).mean(axis=1) >= least
            active[a + x[good]] = active[y[good]] = True
        if not active.any():
            return None
        keep = block.select(["key", "one", "two", "cls"]).filter(pa.array(active)).combine_chunks()
        return keep.to_batches()[0]

    return _in_blocks(joined, work, "key bigint, one int, two int, cls bigint")


def links_in(sets: list[np.ndarray], similarity: int) -> list[tuple[int, int]]:
    """Pairs that connect all sets that are linked: each with the first one of its group."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if m == 2:
        common = np.zeros((2, 2), dtype=np.int64)
        common[0, 1] = common[1, 0] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
    else:
        owner = np.repeat(np.arange(m), sizes)
        _, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[number] > 1
        owner, number = owner[shared], number[shared]
        _, number = np.unique(number, return_inverse=True)
        common = np.zeros((m, m), dtype=np.float64)
        order = np.argsort(number, kind="stable")
        owner, number = owner[order], number[order]
        step = 4096
        for low in range(0, int(number[-1]) + 1 if len(number) else 0, step):
            a, b = np.searchsorted(number, [low, low + step])
            some = np.zeros((m, step), dtype=np.float32)
            some[owner[a:b], number[a:b] - low] = 1
            common += some @ some.T
        common = np.rint(common).astype(np.int64)
    linked = 100 * common >= similarity * (sizes[:, None] + sizes - common)
    root = list(range(m))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        x, y = find(int(a)), find(int(b))
        if x != y:
            root[max(x, y)] = min(x, y)
    return [(find(x), x) for x in range(m) if find(x) != x]


def exact_links(active: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs ``a, b`` that connect the classes whose full sets are similar, within the blocks of ``active``."""
    joined = active.join(sets, "cls").select("key", "one", "two", "cls", "words")

    def work(block: pa.Table) -> pa.RecordBatch | None:
        block = block.sort_by("cls")
        cls = block.column("cls").to_numpy()
        flat, limits = lists_of(block.column("words").combine_chunks())
        found = links_in([flat[a:b] for a, b in zip(limits, limits[1:])], similarity)
        if not found:
            return None
        a, b = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(cls[list(a)]), pa.array(cls[list(b)])], ["a", "b"])

    return _in_blocks(joined, work, "a bigint, b bigint")


def sets_of(docs: DataFrame, wanted: DataFrame, words: int, few: int = 0) -> DataFrame:
    """Shingle sets (``cls``, ``words``) of the rows that ``wanted`` (``row``, ``cls``) names.

    Up to ``few`` of them are broadcast, so texts stay where they are; with more, texts are shuffled.
    """
    keyed = docs.select(row_key().alias("row"), "text")
    if few and wanted.count() <= few:
        texts = keyed.join(F.broadcast(wanted), "row").select("cls", "text")
    else:
        # Rows that are equal in id and text share a key, and there may be any number of them.
        texts = spread_join(keyed, wanted, ["row"]).select("cls", "text")
    once = texts.dropDuplicates(["cls"]).select("cls", word_hashes(lower_ascii(F.col("text"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, limits = lists_of(batch.column(1))
            sets = [shingles(flat[a:b], words) for a, b in zip(limits, limits[1:])]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = np.concatenate([*sets, np.array([], dtype=np.uint64)]).view(np.int64)
            lists = pa.ListArray.from_arrays(ends, values)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["cls", "words"])

    return once.mapInArrow(run, "cls bigint, words array<bigint>")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
    slice_size: int = SLICE, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``) with its group of near duplicates.

    Columns: ``doc_id``, ``row`` (key of id and text), ``n_shingles``, ``component_id`` (smallest id
    reachable over links), ``kept`` (id equals component_id), ``first`` (exactly one row of
    each group).  A text without words, or null, is linked with nothing.  Null ids are the
    smallest of a group only if it has no other; repeated rows are in one group.  Other columns do
    not matter; an empty table gives no rows.
    """
    feats = features(docs, words, bands, rows, seed).withColumn("uid", F.monotonically_increasing_id())
    feats = settle(feats, "features")
    full = feats.filter("n > 0")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "uid")
    classes = full.groupBy("key").agg(F.min("uid").alias("cls"), F.min(order).alias("least"))
    own = settle(spread_join(full.select("uid", "doc_id", "row", "n", "key"), classes, ["key"]).drop("key"), "classes")
    heads = own.filter("uid = cls").select("cls", "row", "least")
    as_class = feats.withColumnRenamed("uid", "cls")
    keyed = as_class.select("cls", "bands").join(heads.select("cls"), "cls", "left_semi")
    keyed = keyed.select(F.explode("bands").alias("key"), "cls")
    members = settle(shared_keys(keyed, "key", "cls"), "buckets")
    crowd = settle(crowded(members, slice_size), "crowd")
    star, marked = None, None
    if not crowd.isEmpty():
        star = settle(star_links(crowd, heads, docs, words, similarity), "star")
        marked = settle(at_home(crowd, components(star)), "marked")
    active = settle(plausible(blocks_of(members, slice_size, marked), as_class, bands, rows, similarity), "active")
    wanted = heads.select("row", "cls").join(active.select("cls").distinct(), "cls", "left_semi")
    sets = settle(sets_of(docs, wanted, words), "sets")
    found = exact_links(active, sets, similarity)
    groups = components(settle(found if star is None else found.unionByName(star), "found"))
    tops = groups.join(heads.select("cls", "least"), F.col("node") == F.col("cls")).groupBy("root").agg(F.min("least").alias("top"))
    # One group may own any share of the classes.
    of_class = spread_join(groups, settle(tops, "tops"), ["root"]).select(F.col("node").alias("cls"), "top")
    linked = own.join(of_class, "cls", "left").withColumn("top", F.coalesce("top", "least"))
    alone = feats.filter("n = 0").select("uid", "doc_id", "row", "n").withColumn("top", order)
    whole = linked.select("uid", "doc_id", "row", "n", "top").unionByName(alone)
    return whole.select(
        "doc_id",
        "row",
        F.col("n").alias("n_shingles"),
        F.col("top.doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("top.doc_id")).alias("kept"),
        (F.col("uid") == F.col("top.uid")).alias("first"),
    )


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, the one with the smallest id.

    Rows without words stay.  All columns come through unchanged, whatever their names; texts of any length are taken
    whole; an empty table stays empty.
    """
    size, key, copy = unused(docs.columns, "_n", "_row", "_copy")
    found = near_duplicates(docs, **parameters).filter("first")
    stay = found.groupBy("row").agg(F.max("n_shingles").alias("n")).toDF(key, size)
    keyed = docs.withColumn(key, row_key()).join(stay, key)
    # Rows that are equal throughout share a key; only one of them stays, unless they have no words.
    number = F.when(F.col(size) > 0, F.lit(-1).cast("long")).otherwise(F.monotonically_increasing_id())
    return keyed.withColumn(copy, number).dropDuplicates([key, copy]).select(*docs.columns)
