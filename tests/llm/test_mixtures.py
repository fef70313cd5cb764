"""Clustering, resampling and mixing against plain versions, on hard rows, and by their own promises."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteloom.llm import clustering, mixing, resampling
from tests.llm.test_contracts import hard_rows

DOCS = "doc_id long, text string, source string, row string, key string, start long, block int, _mark string, n_words string, mark string"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    """Documents with other columns whose names the operators use themselves."""
    clash = ("clash", "clash", 7, 7, "clash", "clash", "clash")
    return spark.createDataFrame([(i, t, s, *clash) for i, t, s in rows], DOCS)


def odd_documents():
    rows = [(r[0], r[1], r[3]) for r in hard_rows()]
    rows += [(None, "some text here", None), (None, None, None), (None, "other words", "ümläut"), (3, rows[10][1], "site1")]
    return rows + [rows[10], rows[10], rows[0], rows[0], (900, "", "nothing"), (901, None, "nothing")]


# ------------------------------------------------------------------ clustering


def plain_clusters(rows, k=8, rounds=10, dims=64):
    limit = clustering.largest(dims)
    kept = []
    for number, vec in rows:
        if vec is None or len(vec) != dims or any(x is None or not abs(x * 1024) < limit for x in vec):
            continue
        kept.append((number, [math.floor(1024 * x) for x in vec]))

    def mark(row):
        return (row[0] is None, hashlib.sha256(f"3:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])

    centroids = [v for _, v in sorted(kept, key=mark)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        members = defaultdict(list)
        for (_, v), (_, j) in zip(kept, assign()):
            members[j].append(v)
        centroids = [
            [sum(x) // len(members[j]) for x in zip(*members[j])] if members[j] else c for j, c in enumerate(centroids)
        ]
    found = assign()
    sums = Counter()
    for d, j in found:
        sums[j] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, j, d, sums[j], sum(sums.values()), names[j]) for (i, _), (d, j) in zip(kept, found)), key=repr
    )


def vectors(spark, rows):
    table = spark.createDataFrame([(i, v, 1, "x", "x") for i, v in rows], "vec_id long, embedding array<float>, label int, whole string, cluster string")
    found = clustering.cluster(table)
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert found.columns == columns
    return sorted((tuple(r) for r in found.collect()), key=repr)


def float32(draw, dims=64, spread=1.0, middle=0.0):
    return [float(np.float32(draw.gauss(middle, spread))) for _ in range(dims)]


def test_clusters_of_odd_vectors(spark):
    draw = random.Random(3)
    rows = [(i, float32(draw, middle=(i % 5) * 0.4)) for i in range(120)]
    bad = list(rows[0][1])
    rows += [(200, None), (201, []), (202, bad[:63]), (203, [*bad, 1.0]), (204, [None, *bad[1:]])]
    rows += [(205, [math.nan, *bad[1:]]), (206, [math.inf, *bad[1:]]), (207, [1e30, *bad[1:]]), (208, bad * 2_000)]
    rows += [(None, bad), (None, bad), (1, bad), rows[5], rows[5], (300, [0.0] * 64), (301, [-0.0] * 64), (302, [-1e-9] * 64)]
    assert vectors(spark, rows) == plain_clusters(rows)


def test_ties_go_to_the_smaller_cluster(spark):
    """Equal vectors are equal seeds; all rows stay with the first of them and the others keep their place."""
    rows = [(i, [1.0] * 64) for i in range(30)] + [(50 + i, [2.0] * 64) for i in range(3)]
    assert vectors(spark, rows) == plain_clusters(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_centroids(spark, n):
    draw = random.Random(n)
    rows = [(i, float32(draw)) for i in range(n)]
    assert vectors(spark, rows) == plain_clusters(rows)


def test_large_components_stay_exact(spark):
    """Squares near the end of a long, with differences in the last place."""
    draw = random.Random(9)
    most = clustering.largest(64) / 1024
    rows = [(i, [draw.choice([-1, 1]) * (int(most * 0.999) - draw.randint(0, 3)) + 0.0 for _ in range(64)]) for i in range(40)]
    got, want = vectors(spark, rows), plain_clusters(rows)
    fits = [r if r[4] < 2**63 else (*r[:3], r[3] if r[3] < 2**63 else None, None, r[5]) for r in want]
    assert got == sorted(fits, key=repr)


def test_bound_rules_centroids_out():
    """On grouped vectors few pairs are verified, and the result is that of all pairs."""
    draw = np.random.default_rng(4)
    middles = draw.normal(0, 2_000, (8, 64))
    whole = (middles[draw.integers(0, 8, 4_000)] + draw.normal(0, 300, (4_000, 64))).astype(np.int64)
    centroids = (middles + draw.normal(0, 100, (8, 64))).astype(np.int64)
    mean = whole.mean(axis=0)
    turn = np.linalg.eigh(np.cov(whole.T))[1][:, ::-1][:, :16]
    lead, rest = clustering.project(whole.astype(float), mean, turn)
    number, far, verified = clustering.nearest(whole, lead, rest, centroids, mean, turn)
    every = ((whole[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()
    assert verified < 1.1 * len(whole)


# ------------------------------------------------------------------ resampling


def plain_words(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return WORD.findall(low)


def plain_scores(docs, target, buckets=10_000, longest=1, least=20, percent=10, seed=2024):
    def features(text):
        w = plain_words(text)
        return [zlib.crc32(b" ".join(w[i : i + n])) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    own, wanted = Counter(), Counter()
    for _, text, _ in docs:
        own.update(features(text))
    for text in target:
        wanted.update(features(text))
    s, t = sum(own.values()), sum(wanted.values())

    def gain(b):
        return math.floor(1000 * math.log((wanted[b] + 1.0) * (s + buckets) / ((own[b] + 1.0) * (t + buckets))))

    rows = []
    for i, text, _ in docs:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, features(text)))
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(features(text)), weight, weight + noise, None, len(plain_words(text))])
    may = [r for r in rows if r[5] >= least]
    may.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(may[: percent * len(may) // 100]):
        r[4] = place + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


BENCH = ["alpha1 beta2 Gamma,3 of the", None, "", "the license dë7 of of OF"]


@pytest.mark.parametrize("longest", [1, 3])
@pytest.mark.parametrize("words", [7, 100_000])
def test_scores_of_odd_documents(spark, longest, words):
    """Any bound of the automaton gives the same rows; runs get their CRC from those of their words."""
    rows = odd_documents()
    target = spark.createDataFrame([(t, "x") for t in BENCH], "text string, codes string")
    found = resampling.scores(documents(spark, rows), target, longest=longest, percent=40, words=words)
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    got = sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)
    assert got == plain_scores(rows, BENCH, longest=longest, percent=40)


def test_no_documents_or_no_target(spark):
    none = documents(spark, [])
    target = spark.createDataFrame([(t,) for t in BENCH], "text string")
    assert resampling.scores(none, target).collect() == []
    assert resampling.draw(none, target).collect() == []
    rows = [(i, f"{'word ' * 30}{i}", "a") for i in range(20)]
    found = resampling.scores(documents(spark, rows), target.limit(0)).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_scores(rows, [])


def test_draw_prefers_the_target_and_keeps_columns(spark):
    draw = random.Random(1)
    like = lambda words: " ".join(draw.choice(words) for _ in range(40))
    near, far = ["heat", "rotor", "valve", "pump"], ["song", "poem", "verse", "rhyme"]
    rows = [(i, like(near if i % 10 == 0 else far), f"s{i % 3}") for i in range(300)]
    docs = documents(spark, rows)
    target = spark.createDataFrame([(like(near),) for _ in range(20)], "text string")
    drawn = resampling.draw(docs, target)
    assert drawn.columns == docs.columns
    got = [tuple(r) for r in drawn.collect()]
    assert len(got) == 30 and all(r[0] % 10 == 0 for r in got) and set(got) <= {tuple(r) for r in docs.collect()}


def test_lexicon_in_pieces(monkeypatch):
    """Words at the ends of pieces, and text of separators only."""
    monkeypatch.setattr(resampling, "PIECE", 16)
    lexicon = resampling.Lexicon(50)
    draw = random.Random(2)
    for _ in range(200):
        text = "".join(draw.choice("aB9 .\n\0éλ") for _ in range(draw.randint(0, 120))).encode()
        crc, size = lexicon.scan(text)
        words = [w.lower() if w.isascii() else bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", text)]
        assert crc.tolist() == [zlib.crc32(w) for w in words] and size.tolist() == [len(w) for w in words]
    assert len(lexicon.known) <= 50


def test_crc_of_a_concatenation():
    draw = random.Random(6)
    parts = [(draw.randbytes(draw.randint(0, 30)), draw.randbytes(draw.choice([0, 1, 2, 300, 70_000]))) for _ in range(40)]
    crc = lambda i: np.array([zlib.crc32(p[i]) for p in parts])
    got = resampling.joined_crc(crc(0), crc(1), np.array([len(b) for _, b in parts]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in parts]


# ------------------------------------------------------------------ mixing


def plain_targets(sizes, most=3):
    """Shares in exact fractions, reshared source by source."""
    keys = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(keys)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in keys if s not in full]
        rest = total - sum(most * sizes[s] for s in full)
        over = sum(weight[s] for s in free)
        above = [s for s in free if Fraction(rest * weight[s], over) > most * sizes[s]]
        if not above:
            return {s: float(most * sizes[s]) if s in full else rest * weight[s] / over for s in keys}
        full |= set(above)


def checked_mix(spark, rows, **settings):
    mixed, each = mixing.mix(documents(spark, rows), **settings)
    got = [tuple(r) for r in each.collect()]
    sizes, taken = Counter(), Counter()
    size_of = {}
    for i, text, source in rows:
        sizes[source] += len(TOKEN.findall(text or ""))
        size_of[i] = size_of.get(i, 0) + len(TOKEN.findall(text or ""))
    want = plain_targets(sizes)
    by_size = {}
    assert sorted((r[0], r[1]) for r in got if r[0] is not None) == sorted(
        (i, len(TOKEN.findall(t or ""))) for i, t, _ in rows if i is not None
    )
    for (i, size, source_size, target, words) in got:
        assert 0 <= words <= 3 * size
        by_size[(source_size, target)] = by_size.get((source_size, target), 0) + words
    for source, size in sizes.items():
        (key,) = [k for k in by_size if k[0] == size and abs(k[1] - want[source]) < 1e-6 * max(1, want[source])][:1]
        twins = sum(s == size and abs(want[o] - want[source]) < 1e-6 for o, s in sizes.items())
        assert abs(by_size[key] - twins * want[source]) <= twins
    for r in mixed.collect():
        taken[r["doc_id"]] += r["words"]
        assert r["words"] > 0 and r["at"] >= 0 and r["at"] + r["words"] <= size_of[r["doc_id"]]
    assert taken == Counter({i: n for i, n in _sum((r[0], r[4]) for r in got).items() if n})
    return mixed, got


def _sum(pairs):
    out = Counter()
    for k, v in pairs:
        out[k] += v
    return out


@pytest.mark.parametrize("block", [1, 7, 512])
def test_mix_of_odd_documents(spark, block):
    checked_mix(spark, odd_documents(), block=block)


def test_mix_with_one_hot_source_and_tiny_ones(spark):
    draw = random.Random(12)
    rows = [(i, "w " * draw.randint(1, 300), "hot") for i in range(400)]
    rows += [(1_000 + i, "w " * draw.randint(0, 9), f"s{i}") for i in range(40)]
    _, first = checked_mix(spark, rows, block=64)
    _, again = checked_mix(spark, rows, block=64)
    assert sorted(first, key=repr) == sorted(again, key=repr)


def test_every_stretch_of_the_mix_holds_its_shares(spark):
    """In each tenth of the slots a source stands as often as in the whole, up to a few blocks."""
    rows = [(i, "w " * 50, f"s{i % 4}") for i in range(4_000)]
    mixed, _ = checked_mix(spark, rows, block=100)
    slots = sorted({(r["slot"], r["key"]) for r in mixed.collect()})
    assert len({s for s, _ in slots}) == len(slots)
    total = Counter(k for _, k in slots)
    tenth = len(slots) // 10
    for i in range(10):
        here = Counter(k for _, k in slots[i * tenth : (i + 1) * tenth])
        assert all(abs(here[k] - n / 10) <= 12 for k, n in total.items())


def test_blocks_hold_equally_many_words(spark):
    rows = [(i, "w " * (i % 90), f"s{i % 3}") for i in range(1_000)]
    mixed, _ = checked_mix(spark, rows, block=64)
    per = mixed.groupBy("key", "slot").agg(F.sum("words").alias("n")).groupBy("key").agg(F.collect_list("n")).collect()
    for _, words in per:
        assert sorted(words)[1:] == [64] * (len(words) - 1) and min(words) <= 64


def test_empty_mix(spark):
    mixed, each = mixing.mix(documents(spark, []))
    assert mixed.collect() == [] and each.collect() == []
    assert each.columns == ["doc_id", "size", "source_size", "target", "taken"]


