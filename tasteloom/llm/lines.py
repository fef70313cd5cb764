"""Removal of lines that many sites share, by sketches of distinct sites per line.

Every line hash gets a HyperLogLog sketch of the sites that hold it; sketches merge by
aggregation, map side first.  A line whose estimate is clearly above the threshold is
boilerplate, one clearly below is not, and for lines near it the distinct sites are counted
exactly.  Only lines with as many rows as the threshold are sketched, since the others
cannot reach it.  The first place of a boilerplate line (smallest document, then line number) may
stay, so that no sentence vanishes from the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import let, row_key
from tasteloom.shared import settle
from tasteloom.spread import unused

ENDS = " \t\n\x0b\x0c\r"  # white space, as between words
SITES = 10  # a line on as many distinct sites is boilerplate
LOG_K = 12  # 4,096 registers: a standard error of 1.6%
MARGIN = 0.15  # estimates within this share of the threshold (at least 2 sites) are counted exactly


def line_rows(docs: DataFrame, site: str = "source") -> DataFrame:
    """Lines that are not blank: ``line`` (128-bit key), ``site``, ``doc_id``, ``row``, ``at`` (from 0).

    White space (``ENDS``) at the ends of a line does not count.  A null site is a site of its own.
    """
    rows = docs.select(
        "doc_id",
        row_key().alias("row"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split("text", "\n")).alias("at", "_line"),
    ).withColumn("_line", F.btrim("_line", F.lit(ENDS))).filter(F.col("_line") != "")
    return rows.select(F.unhex(F.md5("_line")).alias("line"), "site", "doc_id", "row", "at")


def wide_lines(rows: DataFrame, sites: int = SITES, log_k: int = LOG_K, margin: float = MARGIN) -> DataFrame:
    """Lines of ``rows`` on at least ``sites`` distinct sites: ``line``, ``n_sites``, ``exact``.

    Read ``rows`` from a written table, as it is used three times.  The margin is at least nine
    standard errors, so which lines qualify is exact; ``n_sites`` is an estimate where ``exact``
    is false.
    """
    often = rows.groupBy("line").count().filter(F.col("count") >= sites).select("line")
    held = rows.select("line", "site").join(settle(often, "often"), "line", "left_semi")
    slack = max(2.0, margin * sites)
    estimate = F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log_k)))
    likely = held.groupBy("line").agg(estimate.alias("n_sites")).filter(F.col("n_sites") >= sites - slack)
    likely = settle(likely, "sketches")
    near = likely.filter(F.col("n_sites") <= sites + slack).select("line")
    # Distinct pairs first: one line's rows are combined before they are sent.
    pairs = rows.select("line", "site").join(near, "line", "left_semi").distinct()
    counted = pairs.groupBy("line").agg(F.count(F.lit(1)).alias("n_sites")).filter(F.col("n_sites") >= sites)
    sure = likely.filter(F.col("n_sites") > sites + slack)
    return sure.withColumn("exact", F.lit(False)).unionByName(counted.withColumn("exact", F.lit(True)))


def remove_lines(
    docs: DataFrame, sites: int = SITES, site: str = "source", keep_first: bool = True,
    counts: tuple[str, str] = ("n_lines", "n_removed"),
) -> DataFrame:
    """``docs`` without boilerplate lines in ``text``, plus how many lines there were and how many went (``counts``).

    Other lines stay as they are, blank ones too.  A null text stays null (0 lines); a text
    whose lines all go becomes empty, its row stays.  Rows with equal id and text are one
    document.  With ``keep_first`` a line stays at its first place; null ids come first.
    Texts and lines of any length are taken whole.  Columns with the names in ``counts`` are replaced, all others stay;
    an empty table stays empty.
    """
    rows = settle(line_rows(docs, site), "lines")
    wide = settle(wide_lines(rows, sites).select("line"), "wide")
    hits = rows.join(wide, "line", "left_semi")
    if keep_first:
        place = F.struct("doc_id", "row", "at")
        hits = settle(hits, "hits")
        first = hits.groupBy("line").agg(F.min(place).alias("p")).select("p.row", "p.at")
        hits = hits.join(first, ["row", "at"], "left_anti")
    gone = settle(hits.groupBy("row").agg(F.collect_set("at").alias("gone")), "gone")
    kept = docs.drop(*counts)
    key, cut = unused(docs.columns, "_row", "_gone")
    joined = kept.withColumn(key, row_key()).join(gone.toDF(key, cut), key, "left")
    lines = F.split("text", "\n")

    def without(parts: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(cut))
        return F.array_join(F.transform(stay, lambda i: parts[i]), "\n")

    text = F.when(F.col(cut).isNull(), F.col("text")).otherwise(let(lines, without))
    columns = [text.alias("text") if c == "text" else F.col(c) for c in kept.columns]
    return joined.select(
        *columns,
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias(counts[0]),
        F.coalesce(F.size(cut), F.lit(0)).cast("long").alias(counts[1]),
    )
