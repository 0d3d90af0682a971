from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tabloom.llm import arrays, queries
from tabloom.llm import suffix_dedup as S
from tabloom.llm.arrays import portions, prefix_hash, text_bytes

SF = "/root/testdata/sf0.01"


def brute(rows, window):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        if d is not None:
            for i in range(len(b) - window + 1):
                w = b[i : i + window]
                first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        if d is not None:
            for i in range(len(b) - window + 1):
                if first[b[i : i + window]] < d:
                    gone[i : i + window] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(b) else 0
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def corpus(seed, alphabet="abé "):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [word(rng.choice([9, 10, 11, 25, 80])) for _ in range(12)]
    rows = []
    for d in range(160):
        parts = [rng.choice([word(rng.randrange(0, 30)), rng.choice(shared), shared[0][: rng.randrange(1, 10)]]) for _ in range(rng.randrange(0, 8))]
        rows.append((d, "".join(parts)))
    rows += [(200 + i, rows[i % 7][1]) for i in range(20)] + [(300, "ab" * 200), (301, "ba" * 150), (302, "a" * 99), (303, "a" * 60)]
    rng.shuffle(rows)
    return rows


def test_suffix_order_against_plain_sort():
    rng = np.random.default_rng(1)
    for depth, letters in ((1, 2), (7, 2), (8, 3), (20, 2), (50, 1), (50, 26)):
        body = rng.integers(97, 97 + letters, 900).astype(np.uint8)
        at = rng.permutation(len(body) - depth + 1)
        order = S.SuffixOrder(body, prefix_hash(body), depth)
        line = order.sort(at)
        text = body.tobytes()
        keys = [text[i : i + depth] for i in line.tolist()]
        assert keys == sorted(text[i : i + depth] for i in at.tolist())
        ext = order.extension(line[:-1], line[1:])
        for a, b, n in zip(keys, keys[1:], ext.tolist(), strict=False):
            assert a[:n] == b[:n] and (n == depth or a[n] != b[n])


def test_fragments_hold_every_window_once():
    texts = ["", "abc", "x" * 50, None, "The cat. " * 30, "é" * 40, "end"]
    body, offsets = text_bytes(pa.array(texts))
    start, size, anchor, code = S.fragments(body, offsets, 20)
    windows = S.spread(start, size - 19)
    want = [i for a, b in zip(offsets[:-1], offsets[1:], strict=True) for i in range(a, b - 19)]
    assert windows.tolist() == want
    text = body.tobytes()
    by = {}
    for a, z, m in zip(start.tolist(), size.tolist(), anchor.tolist(), strict=True):
        for i in range(a, a + z - 19):
            assert by.setdefault(text[i : i + 20], m) == m


@pytest.mark.parametrize("window", [10, 50])
@pytest.mark.parametrize("small", [False, True])
def test_suffix_dedup_against_brute_force(spark, window, small, monkeypatch):
    if small:  # many portions, groups and lots
        for name, value in (("FLUSH", 1500), ("GROUP", 2000), ("SORT", 300), ("TEXTS", 900)):
            monkeypatch.setattr(S, name, value)
    rows = corpus(window) + [(None, "a" * 120), (None, None), (7000, None), (7001, "")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, tag int, id string").repartition(5)
    assert result(S.suffix_dedup(df, window=window)) == brute(rows, window)


def test_common_phrase_between_different_words_is_spread(spark, monkeypatch):
    for name, value in (("GROUP", 2000), ("HOT", 50), ("SEEN", 2)):
        monkeypatch.setattr(S, name, value, raising=False)
    plain = S._meet

    def bounded(*args):
        run = plain(*args)

        def checked(group):
            if sum(group.column("raw").to_pylist()) > 25_000:
                raise AssertionError("a group holds all that is around the phrase")
            return run(group)

        return checked

    monkeypatch.setattr(S, "_meet", bounded)
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefghijklm") for _ in range(n))
    around = lambda phrase, n: [word(60) + phrase + word(60) for _ in range(n)]
    texts, often = [], 0
    while often < 30:  # a phrase whose gram is the anchor nearly everywhere
        phrase = word(14)
        anchor = np.concatenate([S.fragments(*text_bytes(pa.array([t])), 50)[2] for t in around(phrase, 30)])
        often = np.unique(anchor, return_counts=True)[1].max()
    rows = list(enumerate(around(phrase, 600)))
    rows += [(600 + d, "x" + rows[d][1][20:110] + "y") for d in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(S.suffix_dedup(df)) == brute(rows, 50)


def test_rows_with_one_id_and_kept_bytes(spark):
    long = "0123456789abcdefghijklmnopqrstuvwxyz"
    rows = [(5, long + "A"), (5, long + "A"), (5, "B" + long), (3, "zz" + long[4:30] + "!"), (9, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.suffix_dedup(df, window=10)
    assert result(got) == brute(rows, 10)
    assert {bytes(r.kept) for r in got.where("doc_id = 5").collect()} == {b"0123uvwxyzA", b"B0123uvwxyz"}
    assert S.suffix_dedup(df.where("false")).count() == 0


def test_collisions_are_told_apart():
    """With hashes that see nothing, byte comparisons decide."""
    rng = np.random.default_rng(3)
    body = rng.integers(97, 99, 400).astype(np.uint8)
    start, size = np.arange(0, 400, 20), np.full(20, 20)
    kind = S.classes_of(body, start, size, np.zeros(20, np.uint64))
    text = body.tobytes()
    first = {}
    assert kind.tolist() == [first.setdefault(text[a : a + 20], i) for i, a in enumerate(start.tolist())]
    owner = np.arange(20)[::-1].copy()
    h = np.zeros(401, np.uint64)
    fragment, at = S.repeated_windows(body, start, size, owner, h, 6)
    low = {}
    for f, a in enumerate(start.tolist()):
        for i in range(a, a + 15):
            low[text[i : i + 6]] = min(low.get(text[i : i + 6], 99), owner[f])
    want = sorted((f, i) for f, a in enumerate(start.tolist()) for i in range(a, a + 15) if owner[f] > low[text[i : i + 6]])
    assert sorted(zip(fragment.tolist(), at.tolist(), strict=True)) == want


def test_long_text_in_stretches(spark, monkeypatch):
    rng = random.Random(8)
    base = "".join(rng.choice("abcdefgh") for _ in range(5000))
    rows = [(1, base), (2, "x" + base[100:4000] + "y"), (3, base[3990:] + "q")]
    plain = S._stretches
    monkeypatch.setattr(S, "_stretches", lambda b, o, w: plain(b, o, w, 600))
    body, offsets = text_bytes(pa.array([t for _, t in rows]))
    seen = [i + lo for lo, piece, inner in S._stretches(body, offsets, 50) for s, z, *_ in [S.fragments(piece, inner, 50)] for i in S.spread(s, z - 49).tolist()]
    assert seen == [i for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) for i in range(a, b - 49)]


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(queries.op7_suffix_dedup(spark, SF)) == brute(rows, 50)


def test_suffixes_are_sorted_in_parts(monkeypatch):
    """A large group of windows around one phrase was compared at once, with dozens of arrays as long as the group."""
    rng = np.random.default_rng(5)
    phrase = rng.integers(97, 123, 70, dtype=np.uint8)
    pieces = [np.concatenate([rng.integers(97, 99, 12, dtype=np.uint8), phrase]) for _ in range(150)]
    body = np.concatenate(pieces)
    at = np.concatenate([np.arange(len(p) - 50 + 1) for p in pieces]) + np.repeat(np.arange(150) * 82, 33)
    sizes, plain = [], S.SuffixOrder.extension
    monkeypatch.setattr(S, "PART", 64, raising=False)
    monkeypatch.setattr(S.SuffixOrder, "extension", lambda self, i, j: (sizes.append(len(i)), plain(self, i, j))[1])
    line = S.SuffixOrder(body, prefix_hash(body), 50).sort(at)
    texts = [body[p : p + 50].tobytes() for p in line.tolist()]
    assert texts == sorted(texts) and sorted(line.tolist()) == sorted(at.tolist())
    start, size = np.arange(150) * 82, np.full(150, 82)
    fragment, where = S.repeated_windows(body, start, size, np.arange(150), prefix_hash(body), 50)
    first: dict[bytes, int] = {}
    want = {p for p in at.tolist() if first.setdefault(body[p : p + 50].tobytes(), p // 82) < p // 82}
    assert set(where.tolist()) == want and (where // 82 == fragment).all()
    assert max(sizes) <= 64


def test_a_task_leaves_nothing_behind():
    """Workers that wait kept tables of up to 128 MB."""
    S.powers(1 << 20)
    list(portions(iter([pa.RecordBatch.from_arrays([pa.array(["some text"])], ["text"])]), lambda b: b.column(0)))
    assert not arrays._powers
