from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tabloom.llm import near_dedup as N
from tabloom.llm import queries
from tabloom.llm.components import components, forest

SF = "/root/testdata/sf0.01"


def shingles(text, width):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows, width, percent=80):
    """component by comparing all pairs that share a shingle."""
    sets = {d: shingles(t, width) for d, t in rows}
    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = set()
    for ds in where.values():
        for i, a in enumerate(ds):
            for b in ds[:i]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    if min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])):
                        n = len(sets[a] & sets[b])
                        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                            x, y = find(a), find(b)
                            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("width", [1, 2, 5])
def test_shingle_sets(width):
    texts = ["", None, " \t", "a", "A a a", "a b c d e f", "é\x0bÉ é", "x  y\nx y x y", "\x85 z", "abc", "ab c"]
    codes, offsets = N.shingle_sets(pa.array(texts), width)
    seen = {}
    for i, t in enumerate(texts):
        own = codes[offsets[i] : offsets[i + 1]]
        want = shingles(t, width)
        assert len(own) == len(want) == len(set(own.tolist())) and (np.diff(own.astype(object)) > 0).all()
        assert seen.setdefault(want, own.tolist()) == own.tolist()
    assert len({tuple(v) for v in seen.values()}) == len(seen)


def test_components_against_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1300)] + [(5000, 4000 + i) for i in range(100)] + [(7, 7)]
    a, b = np.array(edges).T
    want = dict(zip(*(x.tolist() for x in forest(a, b)), strict=True))
    df = spark.createDataFrame(edges, "a long, b long").repartition(9)
    for task_links in (10**6, 20):
        found = components(df, task_links=task_links).collect()
        assert {r.node: r.component for r in found} == want and len(found) == len(want)
    assert components(df.where("false")).count() == 0


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, n = [], 0
    base = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(60):  # a large group of near copies around the threshold
        w = list(base)
        for _ in range(rng.randrange(0, 14)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((n, " ".join(w)))
        n += 1
    for _ in range(150):
        w = [rng.choice(vocabulary[: rng.choice([5, 400])]) for _ in range(rng.choice([1, 2, 3, 8, 20, 70, 200]))]
        for _ in range(rng.choice([1, 1, 2, 3])):
            v = list(w)
            for _ in range(rng.randrange(0, 1 + len(w) // 12)):
                v[rng.randrange(len(v))] = rng.choice(vocabulary)
            rows.append((n, rng.choice([" ", "  ", "\n"]).join(v)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width, sent", [(2, N.SENT_IDS), (5, N.SENT_IDS), (5, 3)])
def test_near_dedup_against_brute_force(spark, monkeypatch, width, sent):
    monkeypatch.setattr(N, "SENT_IDS", sent)
    rows = corpus(width) + [(9000, ""), (9001, None), (9002, " \n")]
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], "doc_id long, text string, n long, component_id int")
    got = N.near_dedup(df, width=width).collect()
    want = brute(rows, width)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_odd_rows(spark):
    rows = [(None, "a b c"), (None, None), (1, "a b c"), (1, "a b c"), (2, "a B c"), (3, ""), (4, None)]
    got = N.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, 0, True), (0, 2, 0, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True),
    ]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert N.near_dedup(empty).count() == 0
    with pytest.raises(ValueError):
        N.near_dedup(empty, percent=50)


def test_one_id_with_unrelated_texts(spark):
    words = lambda a: " ".join(f"w{a}x{i}" for i in range(60))
    rows = [(3, words(1) + " end"), (5, words(1)), (5, words(2)), (7, words(2) + " end"), (8, words(3)), (8, words(3) + " end"), (9, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = N.near_dedup(df, tag_col="tag").join(df.select("text", N.text_tag().alias("tag")).distinct(), "tag").collect()
    by = {(r.doc_id, r.text): (r.component_id, r.kept) for r in got}
    assert len(got) == len(rows)
    assert by[3, rows[0][1]] == (3, True) and by[5, rows[1][1]] == (3, False)
    assert by[5, rows[2][1]] == (5, True) and by[7, rows[3][1]] == (5, False)
    assert sorted(by[8, t] for t in (rows[4][1], rows[5][1])) == [(8, False), (8, True)]
    assert by[9, None] == by[9, ""] == (9, True)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op9_near_dedup(spark, SF).collect()}
    # common shingles would make this quadratic; a pair at 0.8 shares one of the rarest fifth of either set
    sets = {d: shingles(t, 2) for d, t in rows}
    assert {d: n for d, (n, _) in got.items()} == {d: len(s) for d, s in sets.items()}
    often = {}
    for s in sets.values():
        for x in s:
            often[x] = often.get(x, 0) + 1
    lists = {}
    for d, s in sets.items():
        for x in sorted(s, key=lambda x: (often[x], x))[: len(s) - -(-len(s) * 4 // 5) + 1]:
            lists.setdefault(x, []).append(d)
    edges = []
    for ds in lists.values():
        for i, a in enumerate(ds):
            for b in ds[:i]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                    edges.append((a, b))
    a, b = np.array(edges).T
    roots = dict(zip(*(x.tolist() for x in forest(a, b)), strict=True))
    assert {d: c for d, (_, c) in got.items()} == {d: roots.get(d, d) for d in sets}


def test_parities_lose_no_pair_at_the_threshold(spark):
    """Sets that reach the threshold pass for sure, sets of a few hundred values that are far from it don't."""
    rng = np.random.default_rng(3)
    sets, want = [], []
    for n in (1, 4, 60, 300, 1500):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for gone in sorted({0, n // 12, n // 10, n // 9, n // 5, n // 2}):
            sets.append(np.unique(np.concatenate([base[gone:], rng.integers(0, 1 << 63, gone, dtype=np.uint64)])))
    codes, offsets = np.concatenate(sets), np.cumsum([0, *[len(x) for x in sets]])
    rows = [(i, len(x), p) for i, (x, p) in enumerate(zip(sets, N.parities(codes, offsets).to_pylist(), strict=True))]
    facts = spark.createDataFrame(rows, "c long, n long, parity array<long>")
    pairs = spark.createDataFrame([(a, b) for b in range(len(sets)) for a in range(b)], "a long, b long")
    got = {(r.a, r.b) for r in N.alike_pairs(pairs, facts, 80).collect()}
    for a, b in [(a, b) for b in range(len(sets)) for a in range(b)]:
        common, n, m = len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b])
        if 100 * common >= 80 * (n + m - common):
            want.append((a, b))
        if 60 <= max(n, m) <= 400 and 100 * common < 50 * (n + m - common):
            assert (a, b) not in got
    assert want and set(want) <= got


@pytest.mark.parametrize("members", [40, 100])
def test_groups_below_the_threshold_make_no_pairs(spark, members):
    """Sets of over 256 values at a similarity of 0.5 that meet under many rare values: all pairs of a group came out."""
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 1 << 63, 220, dtype=np.uint64)
    sets = [np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, 110, dtype=np.uint64)])) for _ in range(members)]
    codes, offsets = np.concatenate(sets), np.cumsum([0, *[len(x) for x in sets]])
    parity = spark.createDataFrame([(i, p) for i, p in enumerate(N.parities(codes, offsets).to_pylist())], "c long, parity array<long>")
    listed = spark.createDataFrame([(v, i, len(x), 0, None) for i, x in enumerate(sets) for v in range(5)], "value long, c long, n long, place long, head array<long>")
    roots = spark.createDataFrame([], "node long, component long")
    assert N.open_pairs(listed, roots, parity, 80).count() == 0
    undecided = listed.selectExpr("value", "c", "n", "c as root", "true as short").join(parity, "c")
    assert N._short_pairs(undecided, 80).count() == 0
