"""Secret scans with a ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content.  The ledger records
which rule versions have been run on which blob, and what they found.  A scan looks only at
pairs of blob and rule version that the ledger does not have, each blob once however
many paths and versions hold it, and joins the findings back to all paths.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.shared import settle
from tasteloom.spread import unused

Spans = list[tuple[int, int]]
FINDINGS = "array<struct<rule:string,start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """``find`` gives start and end (code points, end exclusive) of what it finds in a text."""

    kind: str
    version: int
    find: Callable[[str], Spans]

    @property
    def name(self) -> str:
        return f"{self.kind}/{self.version}"


# The patterns of the first three kinds.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
# Kinds of this module's own.
_KEY_BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
_HOST_TOKEN = re.compile(r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}")
_WEB_TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")


def _assign(text: str) -> Spans:
    if ":" not in text and "=" not in text:
        return []
    return [m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]


def _plain(pattern: re.Pattern, needed: str) -> Callable[[str], Spans]:
    def find(text: str) -> Spans:
        return [m.span() for m in pattern.finditer(text)] if needed in text else []

    return find


RULES = (
    Rule("assign", 1, _assign),
    Rule("access", 1, _plain(_ACCESS, "AKIA")),
    Rule("hex", 1, _plain(_HEX, "")),
    Rule("key_block", 1, _plain(_KEY_BLOCK, "-----BEGIN ")),
    Rule("host_token", 1, _plain(_HOST_TOKEN, "gh")),
    Rule("web_token", 1, _plain(_WEB_TOKEN, "eyJ")),
)
BASE = RULES[:3]


def blob_of(text: Column) -> Column:
    """The address of a text; a null text is the empty blob."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _run(text: Column, todo: Column, rules: Sequence[Rule]) -> Column:
    by_name = {r.name: r for r in rules}

    @F.pandas_udf(FINDINGS)
    def scan(texts: pd.Series, names: pd.Series) -> pd.Series:
        out = []
        for t, wanted in zip(texts, names, strict=True):
            out.append([{"rule": n, "start": a, "end": b} for n in wanted for a, b in by_name[n].find(t or "")])
        return pd.Series(out, dtype=object)

    return scan(text, todo)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """New ledger rows for the texts of ``versions`` (column ``text``).

    A ledger row is ``blob``, ``rules`` (names with versions that were run) and ``findings``.  A
    blob that the ledger has, with all rules, is not scanned again; one that lacks some
    rules is scanned with these only.  Copies reach the scan as one row.
    """
    every = F.array(*[F.lit(r.name) for r in rules])
    text = F.coalesce("text", F.lit(""))
    blobs = versions.select(blob_of(F.col("text")).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    if ledger is None:
        todo = blobs.withColumn("rules", every)
    else:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
        left = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
        todo = blobs.join(seen, "blob", "left").withColumn("rules", left).filter(F.size("rules") > 0)
    return todo.select("blob", "rules", _run(F.col("text"), F.col("rules"), rules).alias("findings"))


def findings_of(ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``blob`` and ``spans`` (by start, then order of the rules) of blobs in which ``rules`` found something."""
    place = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)])
    kind = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.kind)])
    names = [r.name for r in rules]
    found = (
        ledger.filter(F.size("findings") > 0)
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("findings")).alias("all"))
    )
    wanted = F.filter("all", lambda f: f["rule"].isin(names))
    spans = F.sort_array(
        F.transform(
            wanted,
            lambda f: F.struct(
                f["start"].alias("start"), place[f["rule"]].alias("place"),
                f["end"].alias("end"), kind[f["rule"]].alias("kind"),
            ),
        )
    )
    return found.select("blob", spans.alias("spans")).filter(F.size("spans") > 0)


def scan_history(
    versions: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES, out: str = "spans"
) -> tuple[DataFrame, DataFrame]:
    """Findings for every row of ``versions``, and the ledger with the new rows.

    The first result has all columns of ``versions`` plus ``out`` (array of ``start, place, end,
    kind``; null where nothing was found); an input column of that name is replaced, all others stay.  Null texts
    count as empty, long ones are scanned whole.  Repeated rows each get the findings; an empty table gives an empty result.
    """
    new = settle(scan_unseen(versions, ledger, rules), "ledger")
    whole = new if ledger is None else ledger.select(*new.columns).unionByName(new)
    found = settle(findings_of(whole, rules), "findings")
    kept = versions.drop(out)
    (blob,) = unused([*versions.columns, out], "_blob")
    joined = kept.withColumn(blob, blob_of(F.col("text"))).join(found.toDF(blob, out), blob, "left")
    return joined.select(*kept.columns, out), whole


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span replaced by ``mark``; overlapping spans become one."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for t, some in zip(texts, found, strict=True):
            if t is None or some is None or not len(some):
                out.append(t)
                continue
            parts, end = [], 0
            for a, b in sorted((s["start"], s["end"]) for s in some):
                if a >= end:
                    parts += [t[end:a], mark]
                end = max(end, b)
            out.append("".join([*parts, t[end:]]))
        return pd.Series(out, dtype=object)

    return F.when(spans.isNull(), text).otherwise(run(text, spans))
