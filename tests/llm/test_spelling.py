from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabloom.llm import spelling as S


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words: dict[str, int]) -> set[tuple]:
    out = {}
    for w, n in words.items():
        others = [(-m, x) for x, m in words.items() if near(w, x)]
        best = min(others, default=None)
        form = best[1] if best and -best[0] >= 2 * n else None
        out[w] = (form, n, len(others), words[form] if form else None)
    root = {}
    for w in out:
        x = w
        while out[x][0]:
            x = out[x][0]
        root[w] = x
    return {(w, f, root[w], n, k, m) for w, (f, n, k, m) in out.items()}


def rows_of(df) -> set[tuple]:
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", range(6))
def test_random_words(spark, seed):
    rng = random.Random(seed)
    letters = ["ab", "abc", "aé×b", "abcdefgh", "a", "xyÿ漢"][seed]
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(4, 4 + seed + 3))): rng.choice([1, 2, 3, 4, 8, 16, 40]) for _ in range(200)}
    got = S.spelling_groups(spark.createDataFrame(list(words.items()), "word string, n long").repartition(3))
    assert rows_of(got) == brute(words)


def test_long_and_repetitive_words(spark):
    x = "ab" * 4000
    words = {"a" * 5000: 8, "a" * 5001: 2, "a" * 4999 + "b": 1, x: 5, "c" + x: 2, x[:4000] + "z" + x[4001:]: 1, "short": 3, "shore": 9, "abc": 4, "abd": 9}
    got = rows_of(S.spelling_groups(spark.createDataFrame(list(words.items()), "word string, n long")))
    three = {w: n for w, n in words.items() if len(w) < 4}  # near to nothing
    assert got == brute({w: n for w, n in words.items() if len(w) >= 4}) | {(w, None, w, n, 0, None) for w, n in three.items()}


def test_pivots_are_two_disjoint_bigrams_of_the_least_cost():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(4, 12))) for _ in range(400)]
    word, place, gram, sizes = S.bigrams(pa.array(words))
    assert sizes.tolist() == [len(w) for w in words]
    rank = np.arange(S.GRAMS)[::-1].copy()
    inside, pivots, last = S.prefixes(word, place, gram, rank, len(words))
    own = rank[gram]
    chosen = {}
    for i in pivots.tolist():
        chosen.setdefault(int(word[i]), []).append(i)
    for w in range(len(words)):
        mine = np.flatnonzero(word == w)
        three = mine[np.lexsort((place[mine], own[mine]))][:3]
        assert last[w] == own[three[2]]
        best = min(own[i] + own[j] for i in three for j in three if place[j] - place[i] >= 2)
        a, b = chosen[w]
        assert abs(place[a] - place[b]) >= 2 and own[a] + own[b] == best and {a, b} <= set(three.tolist())


def counted(docs: list[tuple]) -> Counter:
    out = Counter()
    for d, text in docs:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
                continue
            if len(run) >= 5:
                h = zlib.crc32(f"{d}:{run}".encode())
                if d is not None and h % 97 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                out[run] += 1
            run = ""
    return Counter({w: n for w, n in out.items() if len(w) >= 5 and n >= 3})


def test_counted_words(spark):
    rng = random.Random(2)
    stems = ["Straße", "ÉTUDE", "école", "naïve", "hello", "World×", "four", "aÿbcde", "tailĀtail", "x-rays", "it's", "sevenths"]
    docs = [(i, " ".join(rng.choice(stems) for _ in range(rng.randint(0, 30)))) for i in range(300)]
    docs += [(None, "hello hello hello"), (7, None), (8, ""), (9, "1234 !!"), (10, "hello," * 2000), (10, "hello," * 2000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 as n", "'x' as word", "2 as run", "3 as id")
    got = S.counted_words(df)
    rows = [(r.word, r.n) for r in got.collect()]
    assert len(rows) == len(dict(rows)) and dict(rows) == dict(counted(docs))
    assert any(w not in {s.lower() for s in stems} for w, _ in rows)  # some runs were altered
    plain = {r.word for r in S.counted_words(df, alter=0).collect()}
    assert "étude" not in plain and "Étude" in plain


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.spelling_groups(S.counted_words(empty)).collect() == []
    nulls = spark.createDataFrame([(None, None), (1, None)], "doc_id long, text string")
    assert S.spelling_groups(S.counted_words(nulls)).collect() == []
