from __future__ import annotations

import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabloom.llm import mixing, quality, queries

SF = "/root/testdata/sf0.01"


def plain_statistics(text):
    """The same statistics, a character and a word at a time."""
    text = text or ""
    kinds = Counter(int(quality.KIND[b]) for b in text.encode())
    chars = len(text)
    letters = kinds[quality.LOWER] + kinds[quality.UPPER] + kinds[quality.LEAD]
    words = [w for w in text.replace("\n", " ").replace("\t", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    n, k = len(words), quality.STEADY
    sizes = [len(w.encode()) for w in words]
    mean = sum(sizes) / max(n, 1)
    spread = math.sqrt(max(sum(s * s for s in sizes) / max(n, 1) - mean * mean, 0))
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    most = max(Counter(words).values(), default=0)
    share = lambda part, whole: math.log(quality.SMALL + part / (whole + k))
    return [
        math.log(n + k), math.log1p(mean), math.log1p(spread), share(kinds[quality.OTHER], chars), share(kinds[quality.UPPER], letters),
        share(kinds[quality.DIGIT], chars), share(kinds[quality.SHOUT], chars), share(repeats, n), math.log1p(len(set(words))) / math.log1p(max(n, 1)),
        math.log(chars / (kinds[quality.BREAK] + 1) + 100), share(kinds[quality.POINT], chars), share(most, n),
    ]


def test_statistics_against_plain_python():
    texts = ["", None, " ", "a", "A b", "one one two\nTHREE!! 4,5", "é à\t\x0bü ###", "x " * 500, "end", "end", "\n\n", "日本 語"]
    got = quality.document_statistics(pa.array(texts))
    assert np.allclose(got, [plain_statistics(t) for t in texts], atol=1e-9)
    assert np.allclose(quality.document_statistics(pa.array(texts)[3:7]), got[3:7])


def test_score_is_the_density_ratio(spark):
    rng = np.random.default_rng(1)
    d = len(quality.NAMES)
    x = np.vstack([rng.normal(0, 1, (60, d)), rng.normal(1.5, 0.5, (90, d))])
    y = [0] * 60 + [1] * 90
    stats = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, stats array<double>")
    labels = spark.createDataFrame([(i, c) for i, c in enumerate(y)] + [(None, 1), (3, None), (4, 7)], "id long, label int")
    model = quality.fit_quality(stats, labels)
    got = {r.id: r.s for r in stats.select("id", model.score(F.col("stats")).alias("s")).collect()}
    own = [np.cov(x[np.array(y) == c].T) for c in (0, 1)]
    together = (own[0] * 59 + own[1] * 89) / 148
    logs = []
    for c in (0, 1):
        cov = 0.7 * own[c] + 0.3 * together
        cov = 0.95 * cov + 0.05 * (np.trace(cov) / d + 1e-6) * np.eye(d)
        gap = x - x[np.array(y) == c].mean(axis=0)
        logs.append(math.log([60, 90][c] / 150) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (gap @ np.linalg.inv(cov) * gap).sum(axis=1))
    want = 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -500, 500)))
    assert np.allclose([got[i] for i in range(150)], want, atol=1e-6)


def test_missing_classes_and_empty_tables(spark):
    stats = quality.with_statistics(spark.createDataFrame([(1, "a b", "x"), (None, None, "y")], "doc_id long, text string, stats string"))
    assert stats.count() == 2
    stats = stats.select(F.col("row.doc_id").alias("id"), "stats")
    labels = "id long, label int"
    assert quality.fit_quality(stats, spark.createDataFrame([], labels)).only == 1.0
    assert quality.fit_quality(stats, spark.createDataFrame([(1, 1)], labels)).only == 1.0
    assert quality.fit_quality(stats, spark.createDataFrame([(1, 0)], labels)).only == 0.0
    assert quality.with_statistics(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_quality_query_on_held_out_documents(spark):
    out = queries.op5_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    assert right > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_period_keeps_every_lag_below_one_block():
    for weights, parts in (({"a": 1, "b": 1, "c": 1}, 10), ({"a": 0.7, "b": 0.2, None: 0.1}, 100), ({str(k): k + 1 for k in range(20)}, 1000), ({"x": 5}, 7), ({"a": 1e-9, "b": 1}, 50)):
        shares = mixing.whole_shares(weights, parts)
        assert sum(shares.values()) == parts and min(shares.values()) >= 1
        done = Counter()
        for t, s in enumerate(mixing.period(shares, parts), start=1):
            done[s] += 1
            for x, n in shares.items():
                assert abs(done[x] * parts - n * t) < parts
        assert done == shares


def rows_of(df):
    return [(r.row, r.mixed) for r in df.collect()]


def test_mix_is_whole_and_keeps_to_its_windows(spark):
    data = [(i, "hot" if i % 3 else f"s{i % 7}", "t", 1, 2) for i in range(900)] + [(None, None, None, 1, 2)] * 4 + [(5, "hot", "t", 1, 2)]
    docs = spark.createDataFrame(data, "doc_id long, source string, text string, slot int, h int")
    old, mixing.BUCKET_ROWS = mixing.BUCKET_ROWS, 50  # many buckets for each source
    try:
        weights = {"hot": 2.0, None: 0.5, "s0": 0.5, "s3": 1.0, "s6": 1.0, "s1": 0}
        first = rows_of(mixing.mix(docs, weights, block_rows=4, parts=60))
        again = rows_of(mixing.mix(docs.repartition(5), weights, block_rows=4, parts=60))
    finally:
        mixing.BUCKET_ROWS = old
    assert sorted(map(str, first)) == sorted(map(str, again)) and len(first) == len(data)
    shares = mixing.whole_shares(weights, 60)
    slots, places = {}, defaultdict(list)
    for row, m in first:
        n = shares.get(row.source)
        if n is None:
            assert m.slot is None and m.block is None and m.place is None and row.source == "s1" or row.source not in weights
            continue
        assert m.release == (m.block - 1) * 60 // n and m.deadline == -(-m.block * 60 // n)
        assert m.release <= m.slot < m.deadline
        assert slots.setdefault(m.slot, (row.source, m.block)) == (row.source, m.block)
        places[m.slot].append(m.place)
    assert all(sorted(p) == list(range(len(p))) and len(p) <= 4 for p in places.values())
    counts = Counter(r.source for r, _ in first)
    blocks = Counter(s for s, _ in slots.values())
    for s in shares:
        assert blocks[s] == -(-counts[s] // 4)
    # less than one block off until the first source runs out
    ends = min(max(t for t, (x, _) in slots.items() if x == s) for s in shares)
    done = Counter()
    for t in range(ends + 1):
        done[slots[t][0]] += 1
        for s, n in shares.items():
            assert abs(done[s] - n * (t + 1) / 60) < 1


def test_mix_keeps_to_the_weights_themselves(spark):
    sizes = {"a": 5200, "b": 2600, "c": 60, None: 1}
    data = [(f"{s}{i}", s) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(data, "doc_id string, source string")
    weights = {"a": 2**0.5, "b": 0.5**0.5, "c": 0.013, None: 1e-5}
    got = mixing.mix(docs, weights, block_rows=1).select("row.source", "mixed.*").collect()
    assert len(got) == len(data)
    owner = {r.slot: r.source for r in got}
    assert len(owner) == len(data)
    total, done = sum(map(Fraction, weights.values())), Counter()
    ends = min(max(t for t, x in owner.items() if x == s) for s in sizes if s)
    assert ends > 4000
    for t in range(ends + 1):
        done[owner[t]] += 1
        for s, w in weights.items():
            assert abs(done[s] - Fraction(w) / total * (t + 1)) < 1


def test_schedule_is_shuffled_and_not_broadcast(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("string").alias("source"))
    plan = mixing.mix(docs, {"0": 1.0, "1": 2.0, "2": 0.5})._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "block0" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_mix_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, source string")
    assert mixing.tempered_weights(docs) == {}
    assert mixing.mix(docs, {}).count() == 0
    assert mixing.mix(docs, {"a": 1.0}).count() == 0


@pytest.mark.parametrize("weights", [{}, {"zzz": 1.0}, {"a": float("nan")}])
def test_sources_without_weight_stay(spark, weights):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string")
    got = mixing.mix(docs, weights).collect()
    assert len(got) == 2 and all(r.mixed.slot is None for r in got)
