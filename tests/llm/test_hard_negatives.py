from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import hard_negatives as H


def brute(rows, anchor, scale=256, positives=5, negatives=5, least=80):
    known = {}
    for i, label, vec in rows:
        if i is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        whole = (label, [math.floor(scale * x) if abs(scale * x) < 2**53 else int(scale * x) for x in vec])
        known[i] = min(known.get(i, whole), whole)
    out = set()
    for a, (label, v) in known.items():
        if not anchor(a):
            continue
        score = {i: sum(x * y for x, y in zip(v, w, strict=False)) for i, (_, w) in known.items() if i != a}
        by = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in by if known[i][0] == label][:positives]:
            fits = [i for i in by if known[i][0] != label and least * score[p] <= 100 * score[i] <= 100 * score[p]]
            for rank, n in enumerate(fits[:negatives], 1):
                out.add((a, p, rank, n, score[p], score[n]))
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, label int, embedding array<{kind}>")


@pytest.mark.parametrize("seed, dims, spread", [(0, 64, 0.3), (1, 3, 1.0), (2, 70, 0.2), (3, 1, 1.0), (4, 16, 0.02), (5, 130, 0.5)])
def test_against_all_pairs(spark, monkeypatch, seed, dims, spread):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, dims))
    rows = []
    for i in range(400):
        label = int(rng.integers(4))
        x = (centres[label if rng.random() > 0.2 else int(rng.integers(4))] + spread * rng.standard_normal(dims)) / math.sqrt(dims)
        rows.append((i - 50, label, np.float32(x).tolist()))
    monkeypatch.setattr(H, "ROWS", 37)
    monkeypatch.setattr(H, "ANCHORS", 5)
    got = H.hard_negatives(frame(spark, rows), F.col("id") % 10 == 0, block=7, part=90)
    want = brute(rows, lambda i: i % 10 == 0)
    assert want and rows_of(got) == want


def test_ties_copies_and_odd_rows(spark):
    same = [0.5, -0.25, 0.125]
    rows = [(i, i % 3, same) for i in range(90)]  # all scores tie
    rows += [(200, 0, [0.0, 0.0, 0.0]), (201, 1, []), (202, 2, [1.0]), (203, 0, [1.0, 2.0, 3.0, 4.0]), (204, None, same), (205, 1, None)]
    rows += [(None, 1, same), (206, 1, [1.0, None, 2.0]), (207, 1, [math.nan, 0.0, 0.0]), (208, 1, [math.inf, 0.0, 0.0]), (209, 1, [-1.0, -1.0, -1.0])]
    rows += [(210, 2, same), (210, 1, [0.1, 0.2, 0.3]), (210, 1, [0.1, 0.2, 0.3])] * 2
    clash = frame(spark, rows).selectExpr("*", "1 as id", "2 as vec", "'x' as code", "3 as place")
    got = H.hard_negatives(clash, F.col("id") % 5 == 0)
    assert rows_of(got) == brute(rows, lambda i: i % 5 == 0)


def test_large_components(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 2, (rng.integers(-6, 7, 3) * 10.0**p).tolist()) for p in (3, 5, 6) for i in range(int(p) * 100, int(p) * 100 + 40)]
    got = H.hard_negatives(frame(spark, rows, "double"), F.col("id") % 10 == 0)
    assert rows_of(got) == brute(rows, lambda i: i % 10 == 0)
    huge = [(0, 0, [1e300, 1.0]), (10, 0, [1e308, 0.0]), (1, 1, [1e300, 0.0]), (2, 1, [-1e300, 0.0])]
    assert {r[5] for r in rows_of(H.hard_negatives(frame(spark, huge, "double"), F.col("id") % 10 == 0))} == {(1 << 63) - 1}


def test_intervals_hold_the_scores():
    rng = np.random.default_rng(9)
    for dims in (1, 5, 64, 100):
        x, y = (np.floor(256 * rng.standard_normal((60, dims))) for _ in range(2))
        x[0], y[0] = 0, 0
        a = H.Anchors(np.arange(60), np.zeros(60), y)
        low, high = a.interval(np.arange(60), *H.encode(x, H.rotation(dims)))
        score = H.products(x, y)
        assert (low <= score).all() and (score <= high).all()
        far = H.encode(y, H.rotation(dims))
        low, high = a.interval(np.arange(60), *far)
        assert (np.diag(high) >= np.diag(H.products(y, y))).all()


def test_empty_and_no_anchor(spark):
    assert H.hard_negatives(frame(spark, []), F.col("id") % 100 == 0).collect() == []
    assert H.hard_negatives(frame(spark, [(1, 0, [1.0])]), F.col("id") % 100 == 0).collect() == []
    assert H.hard_negatives(frame(spark, [(100, 0, [1.0])]), F.col("id") % 100 == 0).collect() == []
