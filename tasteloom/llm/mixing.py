"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are shuffled by a hash and laid end to end; a source that takes more words than
it has starts again.  Its words are cut into blocks of equally many words.  The blocks of all
sources, source after source, stand on the points 0 to N - 1 of a cumulative scale, and slot
i of the schedule takes the block at the i-th point of the van der Corput sequence (the bits of i
reversed).  So every stretch of the mix holds every source in its share, up to a few blocks.  Slots
are ranked per source, and the rank names the block that is joined.

Word positions and blocks are whole numbers worked out by range-partitioned running totals, so no source,
however large, is one task, and a run gives the same mix again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.shared import settle
from tasteloom.spread import place_rows, running_total, spread_join

WEIGHTS = (1, 2, 3)  # of the sources in code point order, repeating
MOST = 3  # times that a source may be taken whole
BLOCK = 512  # words per block
SEED = 13
CHUNK = 1 << 16  # slots that are ranked together
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Per row ``doc_id``, ``size`` in words, ``key`` (of the source; sorts by code point, null last) and ``mark``, by which it is shuffled."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = F.coalesce(F.concat(F.lit("0"), F.col("source").cast("string")), F.lit("1"))
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.select("doc_id", size.alias("size"), key.alias("key"), mark.alias("mark"))


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source ``key``, ``source_size``, ``target`` (double) and ``goal``, the words to take.

    Shares of the sum of all sizes go by weight.  A source stops at ``most`` times its size; what it
    leaves is shared by weight among the others, until none is above.  Whether a
    source is above is decided on whole numbers.
    """
    sums = place_rows(rows.groupBy("key").agg(F.sum("size").alias("source_size")), [F.col("key")], "number")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    sources = settle(
        sums.select("key", "source_size", weight.cast("decimal(38,0)").alias("w"), (F.col("source_size") * most).cast("decimal(38,0)").alias("cap")),
        "sources",
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    # One aggregate a round; a source that is full stays full, because the others' shares only grow.
    share, over = int(total), 1
    free = F.lit(True)
    while True:
        row = sources.filter(free).agg(F.coalesce(F.sum("w"), F.lit(0))).first()
        taken = sources.filter(~free).agg(F.coalesce(F.sum("cap"), F.lit(0))).first()
        share, over = int(total) - int(taken[0]), max(int(row[0]), 1)
        left = F.lit(share).cast("decimal(38,0)")
        still = free & (F.col("w") * left <= F.col("cap") * F.lit(over).cast("decimal(20,0)"))
        if sources.filter(free & ~still).isEmpty():
            break
        free = still
    even = F.lit(share).cast("double") * F.col("w").cast("double") / F.lit(over).cast("double")
    target = F.when(free, even).otherwise(F.col("cap").cast("double"))
    goal = F.least(F.round(target).cast("long"), F.col("cap").cast("long"))
    return settle(sources.select("key", "source_size", target.alias("target"), goal.alias("goal")), "targets")


def schedule(goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """Slots ``(slot, key, block)`` in which each source's blocks stand; ``slot`` gives the order and has gaps.

    ``goals`` has ``key`` and ``goal``; a source gets ``goal / block`` slots, rounded up.
    """
    blocks = goals.filter("goal > 0").select("key", F.ceil(F.col("goal") / block).cast("long").alias("n"))
    placed = settle(running_total(blocks, [F.col("key")], "n", "upto"), "scale")
    total = placed.agg(F.max("upto")).first()[0] or 0
    bits = max(int(total - 1).bit_length(), 1)
    # A source with very many blocks is dealt out in chunks first.
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))).alias("chunk")
    chunks = placed.select("key", "n", (F.col("upto") - F.col("n")).alias("base"), first).repartition("key", "chunk")
    low, high = F.col("chunk") * CHUNK, F.least(F.col("n"), (F.col("chunk") + 1) * CHUNK) - 1
    points = chunks.select("key", "base", F.explode(F.sequence(low, high)).alias("own"))
    point = F.bin(F.col("base") + F.col("own"))
    slot = F.conv(F.reverse(F.lpad(point, bits, "0")), 2, 10).cast("long")
    slots = points.select("key", slot.alias("slot")).withColumn("part", F.floor(F.col("slot") / CHUNK))
    # A slot's rank in its source: the slots of earlier parts, and its place in its own part.
    counts = slots.groupBy("key", "part").agg(F.count(F.lit(1)).alias("here"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("key", "part", F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("key", "part").orderBy("slot"))
    # Exploded rows are more than the planner takes them for, so it must not choose a broadcast.
    ranked = slots.withColumn("inside", inside).join(before.hint("merge"), ["key", "part"])
    return ranked.select("slot", "key", (F.col("before") + F.col("inside") - 1).alias("block"))


def laid(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """``rows`` with their source's ``goals`` and ``start``, the words before them in its shuffled order."""
    placed = settle(running_total(rows, [F.col("key"), F.col("mark"), F.col("doc_id"), F.col("size")], "size", "upto"), "laid")
    first = placed.groupBy("key").agg(F.min(F.col("upto") - F.col("size")).alias("first"))
    both = goals.join(first, "key")
    joined = spread_join(placed, both, ["key"], identity=["mark"])
    return joined.withColumn("start", F.col("upto") - F.col("size") - F.col("first")).drop("upto", "first")


def spans(placed: DataFrame, block: int = BLOCK, most: int = MOST) -> DataFrame:
    """The stretches of words that blocks take: ``key, block, doc_id, start`` (of the row), ``at, words``.

    A row appears once per time it is taken and block it reaches into.
    """
    turn = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(most - 1).cast("long"))).alias("turn")
    times = placed.filter("size > 0").select("key", "doc_id", "start", "size", "source_size", "goal", turn)
    low = F.col("turn") * F.col("source_size") + F.col("start")
    high = F.least(low + F.col("size"), F.col("goal"))
    taken = times.withColumn("low", low).withColumn("high", high).filter("low < high")
    reached = F.explode(F.sequence(F.floor(F.col("low") / block), F.floor((F.col("high") - 1) / block))).alias("block")
    cut = taken.select("key", "doc_id", "start", "low", "high", reached)
    begin, end = F.greatest("low", F.col("block") * block), F.least("high", (F.col("block") + 1) * block)
    return cut.select(
        "key", "block", "doc_id", "start", (begin - F.col("low")).alias("at"), (end - begin).alias("words")
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, block: int = BLOCK, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """The mix, and what it takes of every row.

    Needs ``doc_id``, ``text`` and ``source``; other columns are ignored, whatever their names.  The first table
    has one row per stretch of words: ``slot`` (order of the mix), ``key`` (source: ``0`` and its name, ``1`` for
    null), ``doc_id``, ``at`` (first word within its document) and ``words``.  The second has one row per row of ``docs``:
    ``doc_id, size, source_size, target, taken``.

    Null and empty texts have no words and are taken 0 times; a source without words has the target 0.  Null
    sources are one source, the last.  Null ids are shuffled like an empty id.  Rows that repeat each count as rows of
    their own; ties in the shuffle go by id and size.  Very long texts reach over as many blocks as they need.  An empty
    table gives two empty ones.
    """
    rows = settle(sized(docs, seed), "sized")
    goals = targets(rows, weights, most)
    placed = settle(laid(rows, goals), "placed")
    slots = settle(schedule(goals, block), "slots")
    mixed = settle(spans(placed, block, most).join(slots.hint("merge"), ["key", "block"]), "mix")
    # A row with words is the only one of its source that starts where it does.
    amounts = mixed.groupBy("key", "start").agg(F.sum("words").alias("taken"))
    full = placed.filter("size > 0").join(amounts, ["key", "start"], "left")
    columns = ["doc_id", "size", "source_size", "target"]
    each = full.select(*columns, F.coalesce("taken", F.lit(0).cast("long")).alias("taken")).unionByName(
        placed.filter("size = 0").select(*columns, F.lit(0).cast("long").alias("taken"))
    )
    return mixed.select("slot", "key", "doc_id", "at", "words"), each
