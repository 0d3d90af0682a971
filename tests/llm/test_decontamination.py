from __future__ import annotations

import math
import random
import re

import pytest

from tabloom.llm import decontamination as D
from tabloom.llm import queries

SF = "/root/testdata/sf0.001"


def brute(docs, items, overlap=13, share=0.8):
    tok = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for d, text in docs:
        w = tok(text)
        for k, item in items:
            g = tok(item)
            m = min(overlap, len(g))
            for s in range(len(g) - m + 1) if m else ():
                for at in range(len(w) - m + 1):
                    n = sum(a == b for a, b in zip(g[s : s + m], w[at : at + m], strict=True))
                    if n >= math.ceil(round(share * m, 9)):
                        out[d, k] = max(out.get((d, k), 0), n / m)
    return out


def test_masks_lose_nothing():
    for window in range(1, 14):
        assert D.lossless(D.masks_for(window, 13), window, 0.8), window
    assert not D.lossless(("11111111",), 13, 0.8)


@pytest.mark.parametrize("limit", [D.BROADCAST_SEEDS, 0])
def test_leaks_against_brute_force(spark, limit):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate([1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 20, 40, 13])] + [(90, None), (91, " .,"), (None, "alpha beta Gamma delta epsilon"), (92, "ab cd")] * 2
    docs = []
    for d in range(150):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 50))]
        g = re.findall(r"\w+", rng.choice(items[:16])[1])
        lo = rng.randrange(0, max(1, len(g) - 12))
        piece = g[lo : lo + rng.choice([11, 12, 13, 40])]
        for _ in range(rng.randrange(0, 4)):
            piece[rng.randrange(len(piece))] = "sub"
        at = rng.randrange(0, len(w) + 1)
        docs.append((d, (" ".join(w[:at]) + " " + ", ".join(piece) + "! " + " ".join(w[at:])).upper() if d % 2 else " ".join(w[:at] + piece + w[at:])))
    docs += [(900, None), (901, ""), (None, "x ALPHA, beta gamma delta epsilon"), (902, "alpha sub gamma delta epsilon"), (902, "alpha sub gamma delta epsilon"), (903, "ab-cd")]
    df = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, h int, item string")
    bench = spark.createDataFrame([(*r, "q") for r in items], "item_id long, text string, h string")
    got = D.find_leaks(df, bench, broadcast_seeds=limit)
    rows = {(r.doc_id, r.item_id): r.best for r in got.collect()}
    assert got.count() == len(rows)
    assert rows == pytest.approx(brute(docs, items))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_unsafe_masks_are_refused_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join("abcdefghijklmnopqrst"))], "item_id long, text string")
    with pytest.raises(ValueError, match="miss"):
        D.find_leaks(docs, bench, long_masks=("1111111111111",))
    assert D.find_leaks(docs, bench.where("false")).count() == 0
    assert D.find_leaks(docs.where("false"), bench).count() == 0


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    # by brute force only where a document and an item have three words in a row in common
    near = lambda t: {tuple(w[i : i + 3]) for w in [re.findall(r"[^\W_]+", (t or "").lower())] for i in range(len(w) - 2)}
    marks = [(k, t, near(t)) for k, t in items]
    want = {}
    for d, t in docs:
        have = near(t)
        want |= brute([(d, t)], [(k, x) for k, x, m in marks if len(m & have) >= 2])
    assert {(r.doc_id, r.item_id): r.best for r in queries.op3_decontamination(spark, SF).collect()} == pytest.approx(want)
    assert want
