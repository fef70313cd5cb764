"""Quality rules as a cascade that stops at the first rejection.

A rule is a Boolean column (true: reject) over measures of the text.  On a sample every
rule's cost (seconds per row, over the time of reading) and selectivity (share of rows
rejected) is estimated; rules then run in order of rejections per cost.  The order decides only
how much work is done, never the verdict.  Everything is column expressions.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import let, word_array
from tasteloom.shared import settle

SAMPLE_ROWS = 2_000  # different texts on which costs are estimated
SEED = 9
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``reject`` makes a Boolean column from the measures (``measures``) of a text."""

    name: str
    reject: Callable[[Mapping[str, Column]], Column]


# ------------------------------------------------------------------ measures


def n_words(words: Column) -> Column:
    return F.size(words).cast("long")


def word_chars(words: Column) -> Column:
    """Code points in words."""
    return F.length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")


def n_dup_lines(lines: Column) -> Column:
    """Lines with a word that are equal to an earlier line; only where lines repeat they are looked at one by one."""
    zero = F.lit(0).cast("long")

    def repeats(x: Column) -> Column:
        return (F.size(x) - F.size(F.array_distinct(x))).cast("long")

    def of(x: Column) -> Column:
        return F.when(repeats(x) == 0, zero).otherwise(let(F.filter(x, lambda y: y.rlike(r"[^\x20\x09-\x0D]")), repeats))

    return let(F.array_remove(lines, ""), of)


def n_repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that stand twice or more in the text.

    Words are hashed, and windows of hashes; only a text that has fewer different windows than
    windows is looked at further.  There windows are sorted by hash, so equal ones are
    neighbours, and the words that they cover are counted by position.
    """
    zero = F.lit(0).cast("long")

    def windows(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - window)
        return F.transform(at, lambda i: F.xxhash64(*[h[i + k] for k in range(window)]))

    def covered(w: Column) -> Column:
        placed = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeats(s: Column) -> Column:
            last = F.size(s) - 1

            def twin(x: Column, i: Column) -> Column:
                before = F.when(i > 0, s[F.greatest(i - 1, F.lit(0))]["h"] == x["h"]).otherwise(False)
                after = F.when(i < last, s[F.least(i + 1, last)]["h"] == x["h"]).otherwise(False)
                return before | after

            return F.array_sort(F.transform(F.filter(s, twin), lambda x: x["i"]))

        def total(p: Column) -> Column:
            # A window covers `window` words, or up to the start of the next one.
            def cover(x: Column, i: Column) -> Column:
                following = F.coalesce(F.try_element_at(p, i + 2), x + window)
                return F.least(F.lit(window), following - x)

            return F.aggregate(F.transform(p, cover), zero, lambda a, x: a + x)

        return let(let(placed, repeats), total)

    def repeated(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), zero).otherwise(covered(w))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashes, lambda h: F.when(F.size(h) < window, zero).otherwise(let(windows(h), repeated)))


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The measures of a text that is not null and has these ``words``; one that nothing reads costs nothing."""
    lines = F.split(text, "\n")
    return {
        "n_words": n_words(words),
        "word_chars": word_chars(words),
        "n_symbols": n_symbols(text),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": n_dup_lines(lines),
        "n_repeat_words": n_repeat_words(words),
    }


def with_words(text: Column, body: Callable[[Mapping[str, Column]], Column]) -> Column:
    """``body`` of the measures of ``text``, which is cut into words once; a null text is empty."""
    return let(word_array(text), lambda w: body(measures(F.coalesce(text, F.lit("")), w)))


# ------------------------------------------------------------------ rules


def too_short(of: Mapping[str, Column]) -> Column:
    return of["n_words"] < 10


def too_repetitive(of: Mapping[str, Column]) -> Column:
    return of["n_repeat_words"] * 100 > of["n_words"] * 20


def too_many_symbols(of: Mapping[str, Column]) -> Column:
    """More than a tenth of the characters are symbols."""
    return of["n_symbols"] * 10 > of["word_chars"]


def odd_words(of: Mapping[str, Column]) -> Column:
    """The mean word is longer than 30 characters: no prose."""
    return of["word_chars"] > of["n_words"] * 30


def too_many_same_lines(of: Mapping[str, Column]) -> Column:
    """More than half of ten or more lines are equal to an earlier one."""
    return (of["n_lines"] >= 10) & (of["n_dup_lines"] * 2 > of["n_lines"])


RULES = (
    Rule("too_short", too_short),
    Rule("too_repetitive", too_repetitive),
    Rule("too_many_symbols", too_many_symbols),
    Rule("odd_words", odd_words),
    Rule("too_many_same_lines", too_many_same_lines),
)


def sampled(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The ``rows`` different texts with the smallest hashes, each once, as ``text``.

    Hashes come first: those in the lowest stretch, which holds twice as many as are wanted, are sorted
    and cut, without any text.  Then the texts up to the last hash are taken.  So the sample depends on the texts
    alone, and no task gets more than what is kept.
    """
    total = max(docs.count(), 1)
    width = min((1 << 64) * 2 * rows // total, (1 << 64) - 1)
    mark = F.xxhash64(F.lit(SEED), F.coalesce("text", F.lit("")))
    marked = docs.select("text", mark.alias("h"))

    def last(below: int | None) -> tuple[int, int | None]:
        some = marked if below is None else marked.filter(F.col("h") <= below)
        kept = some.select("h").distinct().orderBy("h").limit(rows)
        return kept.agg(F.count(F.lit(1)), F.max("h")).first()

    found, upto = last(width - (1 << 63))  # the stretch begins at the smallest long
    if found < rows:  # many rows repeat, so the stretch held too few different texts
        found, upto = last(None)
    few = marked.filter(F.col("h") <= upto) if found else marked.limit(0)
    return few.dropDuplicates(["h"]).select("text")


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """Rules with seconds and share of texts rejected, on a sample of so many texts; best rejection per cost first.

    The sample is written once.  Reading it and cutting it into words is timed first and subtracted.
    """
    rows = settle(sampled(docs, sample), "sample")
    few = rows.count()

    def timed(reject: Callable[[Mapping[str, Column]], Column]) -> tuple[float, int]:
        started = time.monotonic()
        found = rows.agg(F.count_if(with_words(F.col("text"), reject))).first()[0]
        return time.monotonic() - started, found

    timed(lambda of: of["n_words"] < 0)
    base, _ = timed(lambda of: of["n_words"] < 0)
    out = []
    for rule in rules:
        seconds, found = timed(rule.reject)
        out.append((rule, max(seconds - base, 1e-4), found / max(few, 1)))
    return sorted(out, key=lambda x: (-x[2] / x[1], x[0].name))


def verdict(of: Mapping[str, Column], ordered: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does; later rules are not worked out."""
    out = F.lit(None).cast("string")
    for rule in reversed(ordered):
        out = F.when(F.coalesce(rule.reject(of), F.lit(False)), F.lit(rule.name)).otherwise(out)
    return out


def cascade(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE_ROWS, measured: bool = False, out: str = "rejected_by"
) -> DataFrame:
    """``docs`` with column ``out``: the first rule, in the estimated order, that rejects the row.

    The order rests on measured seconds, so where several rules reject a row another one may be named
    next time; whether one is named does not change.  A rule that comes after a rejection is not
    worked out for that row.  With ``measured`` the result has the measures besides, as struct ``measures``: all of
    them are worked out, once, and the rules read them.

    Null and empty texts have no words and fall to the shortness rule.  Texts of any length are taken
    whole.  Repeated rows are judged alike; an empty table stays empty.  Columns of these names are
    replaced, others stay.
    """
    ordered = [rule for rule, _, _ in estimate(docs, rules, sample)]
    if not measured:
        return docs.withColumn(out, with_words(F.col("text"), lambda of: verdict(of, ordered)))
    every = with_words(F.col("text"), lambda of: F.struct(*[c.alias(name) for name, c in of.items()]))
    known = docs.withColumn("measures", every)
    return known.withColumn(out, verdict({c: F.col("measures")[c] for c in measures(F.lit(""), F.array(F.lit("")))}, ordered))
