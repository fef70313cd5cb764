"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a window of words, wherever lines end: for each template windows of twice its word
count, one at every quarter of a window, so a notice with half as many words again is seen whole.
A template is found in a block if at least ``threshold`` of its distinct words stand in the
block, those that name the license (``NAMES``) among them.  The join follows the prefix-filter scheme:

* words are ordered by how many blocks hold them, the rarest first, over all documents;
* to share ``need`` of its ``m`` words with a template, a block must hold one of the
  template's ``m - need + 1`` rarest (prefix filter);
* a block with fewer than ``need`` words of any template is left out, and so are all blocks of a
  text that has fewer than ``need`` of the template's words (length filter);
* the place of the shared word in both orders bounds the words that can still be shared
  (positional filter);
* what is left is verified on the whole sets.  No block that meets the threshold is lost.

Words that stand in no template can never be shared, so blocks are kept as the words that
they have in common with the templates.  Besides, places where fixed phrases stand are counted.
Everything is DataFrame operations; the templates are a bounded parameter.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import let, lower_ascii, small_table, word_array
from tasteloom.shared import settle

# Between words: ASCII characters other than digits and letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
THRESHOLD = 0.8

# Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Short notices as licenses ask for them; the label says which license.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "mit": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "gpl-notice": "this work is licensed under the gnu general public license version",
    "gpl-program": "this program is free software you can redistribute it and or modify it under the terms of the "
    "gnu general public license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license",
    "cc-notice": "this work is licensed under a creative commons attribution license",
    "cc-by-nc": "licensed under cc by nc 4 0",
}


# Words of a template without which its notice speaks of another license.
NAMES = {
    "apache-2.0": "apache",
    "mit": "mit",
    "gpl-notice": "gnu general public",
    "gpl-program": "gnu general public",
    "mpl-2.0": "mozilla",
    "cc-notice": "creative commons attribution",
    "cc-by-nc": "cc by nc",
}


def _needed(size: int, threshold: float) -> int:
    return max(1, -int(-size * threshold // 1))


def phrase_places(text: Column, phrase: str) -> Column:
    """Word numbers (from 0) at which the words of ``phrase`` stand one after the other."""
    parts = phrase.split()

    def places(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - len(parts))

        def same(i: Column) -> Column:
            test = w[i] == parts[0]
            for k, p in enumerate(parts[1:], 1):
                test = test & (w[i + k] == p)
            return test

        return F.when(F.size(w) < len(parts), F.array().cast("array<int>")).otherwise(F.filter(at, same))

    return let(word_array(lower_ascii(text), GAP), places)


def _may_hold(text: Column, phrases: Mapping[str, str]) -> Column:
    """Whether any phrase can be there: a cheap test that is never false wrongly."""
    if not phrases:
        return F.lit(False)
    joined = "|".join(ANY_CASE_GAP.join(map(re.escape, p.split())) for p in phrases)
    return text.rlike(f"(?i)(?:{joined})")


def _step(template: str) -> int:
    """Words from one window for ``template`` to the next."""
    return max(1, _span(template) // 4)


def _span(template: str) -> int:
    """Words in a window for ``template``."""
    return 2 * len(template.split())


def _blocks(words: Column, templates: Mapping[str, str], threshold: float) -> Column:
    """Blocks of a text's ``words``: the window's ``span`` and the template words it holds, no block twice."""
    known = sorted({w for t in templates.values() for w in t.split()})
    sets = {label: sorted(set(t.split())) for label, t in templates.items()}
    need = {label: _needed(len(own), threshold) for label, own in sets.items()}

    def of_span(w: Column, held: Column, span: int) -> Column:
        labels = [label for label, t in templates.items() if _span(t) == span]
        least, step = min(need[label] for label in labels), _step(templates[labels[0]])
        enough = [F.size(F.array_intersect(held, F.array(*map(F.lit, sets[x])))) >= need[x] for x in labels]
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - span + step - 1, F.lit(0)), F.lit(step))
        windows = F.transform(
            starts, lambda i: F.array_sort(F.array_distinct(F.filter(F.slice(w, i + 1, span), lambda x: x.isin(known))))
        )
        kept = F.array_distinct(F.filter(windows, lambda b: F.size(b) >= least))
        out = F.transform(kept, lambda b: F.struct(F.lit(span).alias("span"), b.alias("words")))
        return F.when(reduce(Column.__or__, enough), out).otherwise(none)

    none = F.array().cast("array<struct<span:int,words:array<string>>>")
    spans = sorted({_span(t) for t in templates.values() if t.split()})

    def all_spans(w: Column) -> Column:
        held = F.array_intersect(w, F.array(*map(F.lit, known)))
        return let(held, lambda h: F.concat(none, *[of_span(w, h, span) for span in spans]))

    return let(words, all_spans) if spans else none


def read_blocks(
    docs: DataFrame, templates: Mapping[str, str], phrases: Mapping[str, str], threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document: ``doc_id, n_words, places`` (label and word number), ``blocks``."""
    text = F.coalesce("text", F.lit(""))
    empty = F.array().cast("array<struct<label:string,at:int>>")

    def labelled(phrase: str, label: str) -> Column:
        return F.transform(
            phrase_places(text, phrase), lambda i: F.struct(F.lit(label).alias("label"), i.alias("at"))
        )

    found = F.concat(empty, *[labelled(p, label) for p, label in phrases.items()])
    count = F.size(word_array(text, ANY_CASE_GAP)).cast("long")
    return docs.select(
        "doc_id",
        count.alias("n_words"),
        F.when(_may_hold(text, phrases), found).otherwise(empty).alias("places"),
        _blocks(word_array(lower_ascii(text), GAP), templates, threshold).alias("blocks"),
    )


def join_templates(
    blocks: DataFrame, templates: Mapping[str, str], threshold: float, names: Mapping[str, str] = NAMES
) -> DataFrame:
    """Blocks (``uid, span, words``) and the templates they contain: ``uid, label, containment``.

    A template is looked for in the windows of its own span.  ``names`` has the words of a template that have to be
    there, whatever the threshold.
    """
    spark = blocks.sparkSession
    held = blocks.select(F.explode("words").alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in held.collect()}  # at most as many as words in the templates
    order = sorted({w for t in templates.values() for w in t.split()}, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for label, text in templates.items():
        ranks = sorted({rank[w] for w in text.split()})
        must = sorted({rank[w] for w in names.get(label, "").split()})
        need = _needed(len(ranks), threshold)
        for at, r in enumerate(ranks[: len(ranks) - need + 1]):
            rows.append(
                {"_word": r, "label": label, "_span": _span(text), "_at": at, "_need": need, "_all": ranks, "_must": must}
            )
    if not rows:
        return blocks.select("uid", F.lit("").alias("label"), F.lit(0.0).alias("containment")).filter(F.lit(False))
    index = small_table(spark, rows, "_word: int, label: string, _span: int, _at: int, _need: int, _all: array<int>, _must: array<int>")
    lookup = F.create_map(*[F.lit(x) for w, i in rank.items() for x in (w, i)])
    least = min(r["_need"] for r in rows)
    prefixes = sorted({r["_word"] for r in rows})
    sets = blocks.filter(F.size("words") >= least).select(
        "uid", "span", F.sort_array(F.transform("words", lambda w: lookup[w])).alias("_own")
    )
    starts = F.filter(
        F.transform("_own", lambda r, i: F.struct(r.alias("r"), i.alias("i"))), lambda x: x["r"].isin(prefixes)
    )
    candidates = (
        sets.withColumn("_start", F.explode(starts))
        .join(F.broadcast(index), (F.col("_start.r") == F.col("_word")) & (F.col("span") == F.col("_span")))
        .filter(F.size("_own") >= F.col("_need"))
        .filter(F.least(F.size("_all") - F.col("_at"), F.size("_own") - F.col("_start.i")) >= F.col("_need"))
    )
    shared = F.size(F.array_intersect("_own", "_all"))
    named = F.size(F.array_except("_must", "_own")) == 0
    return candidates.filter((shared >= F.col("_need")) & named).select(
        "uid", "label", (shared / F.size("_all")).alias("containment")
    )


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    threshold: float = THRESHOLD,
    names: Mapping[str, str] = NAMES,
) -> DataFrame:
    """One row per row of ``docs``: phrase places and template matches over the whole text.

    Columns: ``doc_id, n_words, places`` (array of label and word number), ``found`` (array of
    template label and containment, distinct).  A null or empty text has no words and no
    matches; texts of any length are taken whole; repeated rows and rows with the same or a null id are judged each
    for itself; other columns do not matter; an empty table gives an empty result.
    """
    read = settle(
        read_blocks(docs, templates, phrases, threshold).withColumn("uid", F.monotonically_increasing_id()), "blocks"
    )
    blocks = read.select("uid", F.inline("blocks"))
    matches = (
        join_templates(blocks, templates, threshold, names)
        .groupBy("uid", "label")
        .agg(F.max("containment").alias("containment"))
        .groupBy("uid")
        .agg(F.sort_array(F.collect_list(F.struct("label", "containment"))).alias("found"))
    )
    none = F.array().cast("array<struct<label:string,containment:double>>")
    return (
        read.select("uid", "doc_id", "n_words", "places")
        .join(matches, "uid", "left")
        .select("doc_id", "n_words", "places", F.coalesce("found", none).alias("found"))
    )
