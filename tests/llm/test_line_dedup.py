from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tabloom.llm import line_dedup as D
from tabloom.llm import queries
from tabloom.llm.arrays import prefix_hash

SF = "/root/testdata/sf0.001"
BLANKS = " \t\x0b\x0c\r"


def plain(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line).strip(BLANKS)


def shingles(line, width):
    return {line[i : i + width] for i in range(max(1, len(line) - width + 1))} if line else set()


def brute(rows, width=7, percent=80):
    """id to numbers of dropped lines, comparing all lines that share a shingle."""
    where = {}
    for d, t in rows:
        if d is not None:
            for k, line in enumerate((t or "").split("\n")):
                if plain(line):
                    where.setdefault(plain(line), []).append((d, k))
    sets = {x: shingles(x, width) for x in where}
    lists, parent = {}, {x: x for x in where}
    for x, s in sets.items():
        for g in s:
            lists.setdefault(g, []).append(x)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = set()
    for xs in lists.values():
        for i, a in enumerate(xs):
            for b in xs[:i]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    n = len(sets[a] & sets[b])
                    if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                        parent[find(a)] = find(b)
    groups = {}
    for x, places in where.items():
        groups.setdefault(find(x), []).extend(places)
    out = {}
    for places in groups.values():
        for d, k in places:
            if (d, k) != min(places):
                out.setdefault(d, set()).add((k, *min(places)))
    return out


def test_lines_and_shingles_against_plain_python():
    texts = ["", None, "one", " A b \n\nC\n", "\n", "x\r\ny\t", "é" * 9 + "\n日本", "  ", "end"]
    points, offsets = D.characters(pa.array(texts))
    text, number, start, stop = D.lines_of(points, offsets)
    got = [(t, k, "".join(map(chr, points[a:b]))) for t, k, a, b in zip(text.tolist(), number.tolist(), start.tolist(), stop.tolist(), strict=True)]
    assert got == [(t, k, plain(x)) for t, s in enumerate(texts) for k, x in enumerate((s or "").split("\n"))]
    line, code = D.shingles_of(prefix_hash(points), start, stop, 3)
    by = {}
    for i, (_, _, x) in enumerate(got):
        own = code[line == i].tolist()
        grams = [x[j : j + 3] for j in range(max(1, len(x) - 2))] if x else []
        assert len(own) == len(grams)
        for g, c in zip(grams, own, strict=True):
            assert by.setdefault(g, c) == c
    assert len(set(by.values())) == len(by)
    alone = D._second(D.characters(pa.array(["end"]))[0], np.array([0]), np.array([3]))[0]
    assert (D._second(points, start, stop)[[i for i, g in enumerate(got) if g[2] == "end"]] == alone).all()
    sets = D.line_sets([x.encode() for *_, x in got], 3)
    assert [len(s) for s in sets] == [len(shingles(x, 3)) for *_, x in got]


def test_invalid_utf8_stays_with_its_text():
    texts = ["Ünlike lines\nété".encode(), b"bad \xff\xc3 byte", "日本".encode(), b""]
    points, offsets = D.characters(pa.array(texts, pa.binary()))
    got = [points[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    alone = [D.characters(pa.array([t], pa.binary()))[0].tolist() for t in texts]
    assert got == alone and got[1] == list(texts[1]) and got[2] == [0x65E5, 0x672C]


def test_signatures_follow_similarity():
    rng = np.random.default_rng(5)
    hits, meets, n = 0, 0, 300
    for _ in range(n):
        base = rng.integers(0, 1 << 63, 110).astype(np.uint64)
        a, b = base[:99], base[11:]  # 88 of 110 in common
        code = D.mixed(np.concatenate([a, b]))
        s = D.signatures(np.repeat([0, 1], [99, 99]), code, 2, 64)
        hits += (s[0] == s[1]).mean()
        k = D.band_keys(s, 16)
        meets += bool((k[0] == k[1]).any())
    assert abs(hits / n - 0.8) < 0.03 and meets >= n - 2
    tiny = D.signatures(np.array([0, 1, 2, 2]), D.mixed(np.array([5, 5, 6, 7], np.uint64)), 4, 64)
    assert (tiny[0] == tiny[1]).all() and (tiny[:3] != np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 9)))
    base = [" ".join(word() for _ in range(rng.choice([1, 2, 15, 40]))) for _ in range(25)]
    rows = []
    for d in range(120):
        lines = []
        for _ in range(rng.randrange(0, 6)):
            x = rng.choice([*base, base[2], base[2], " ".join(word() for _ in range(20))])
            w = x.split(" ")
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = word()
            lines.append(rng.choice(["", "  "]) + " ".join(w).upper() if d % 3 else " ".join(w))
            if rng.random() < 0.2:
                lines.append("")
        rows.append((d, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("flush", [300, 10**6])
def test_line_report_against_brute_force(spark, flush, monkeypatch):
    monkeypatch.setattr(D, "FLUSH", flush)
    monkeypatch.setattr(D, "GROUP", 5000)
    rows = corpus(flush) + [(500, None), (501, "\n \n")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, id int, tag string").repartition(4)
    got = {r.doc_id: r for r in D.line_report(df).collect()}
    want = brute(rows)
    assert len(got) == len(rows)
    for d, t in rows:
        r = got[d]
        assert r.n_lines == len((t or "").split("\n"))
        assert {(k, x.doc_id, x.line) for k, x in zip(r.dropped_lines, r.kept_from, strict=True)} == want.get(d, set())
        assert r.n_dropped == len(want.get(d, ()))


def test_drop_lines_and_odd_rows(spark):
    rows = [(1, "keep me here\n\nSame line of text", "a"), (2, "same line of text \nother words", "b"), (None, "same line of text", "c"), (3, None, "d"), (4, "same line of text", "e"), (4, "same line of text", "e"), (5, "x\nfirst", "f"), (5, "x\nsecond", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lines string")
    got = sorted(((r.row.doc_id or 0, r.row.lines, r.text, r.n_dropped) for r in D.drop_lines(df).collect()), key=str)
    five = [g for g in got if g[0] == 5]
    assert sorted(g[2] for g in five) in (["first", "x\nsecond"], ["second", "x\nfirst"])
    assert [g for g in got if g[0] != 5] == [
        (0, "c", "same line of text", 0), (1, "a", "keep me here\n\nSame line of text", 0), (2, "b", "other words", 1),
        (3, "d", "", 0), (4, "e", "", 1), (4, "e", "", 1),
    ]
    empty = df.where("false")
    assert D.drop_lines(empty).count() == 0 and D.line_report(empty).count() == 0
    assert D.line_report(spark.createDataFrame([(1, "lonely")], "doc_id long, text string")).collect()[0].n_dropped == 0


def test_common_shingle_is_counted_before_it_is_shuffled(spark):
    lines = ["the common part " + x * 3 for x in ("abcdefg", "hijklmn", "opqrstu")]
    bodies = spark.createDataFrame([(i, x.encode()) for i, x in enumerate(lines)], "node long, body binary")
    listed = D.rare_lists(bodies, 7, 80, lambda df, label: df) if "keep" in D.rare_lists.__code__.co_varnames else D.rare_lists(bodies, 7, 80)
    assert "InArrow" in (plan := listed._jdf.queryExecution().toString()) and "FlatMapGroupsInArrow" not in plan
    sets = [shingles(x, 7) for x in lines]
    often = [sum(g in s for s in sets) for g in sets[0]]
    # own shingles of the first line fill its first places, so it is listed under none
    assert often.count(1) > len(sets[0]) // 5 and listed.count() == 0


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(rows)
    got = {r.doc_id: {(k, x.doc_id, x.line) for k, x in zip(r.dropped_lines, r.kept_from, strict=True)} for r in queries.op10_line_dedup(spark, SF).collect()}
    assert {d: s for d, s in got.items() if s} == want and want


def test_smallest_member_meets_all_of_other_portions(spark):
    """a is in one portion, b1 < b2 in another: b2 is linked to b1 there, b1 to a, and only a and b2 are near."""
    rng = random.Random(1)

    def facts(line):
        points, offsets = D.characters(pa.array([line]))
        h = prefix_hash(points)
        return int(D._nodes(h, offsets[:-1], offsets[1:]).view(np.int64)[0]), int(D.signatures(*D.shingles_of(h, offsets[:-1], offsets[1:], 7), 1, 1)[0, 0])

    def edited(line, place):
        return line[:place] + "#" + line[place + 1 :]

    while True:
        b2 = "".join(rng.choice("abcdefgh") for _ in range(120))
        a, b1 = edited(b2, 30), edited(b2, 80)
        (x, i), (y, j), (z, k) = facts(a), facts(b1), facts(b2)
        if x < y < z and i == j == k:
            break
    one, two = [(1, a)], [(2, b1 + "\n" + b2)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(one + two, 2), "doc_id long, text string")
    # with one band of one row, all three are in the only bucket that any of them has
    dropped = D.duplicate_lines(D._tagged(docs, "doc_id", "text"), bands=1, rows=1).collect()
    assert {(r.id, r.line) for r in dropped} == {(d, n) for d, lines in brute(one + two).items() for n, *_ in lines} == {(2, 0), (2, 1)}


def test_one_pass_gives_lines_and_links():
    """The lines go with the bucket entries, so the texts are taken apart once for both."""
    lines = ["the same long line of text here", "", "another line that is quite different"]
    texts = ["\n".join(lines), lines[0].upper() + "\n ", "the same long line of text hers"]
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6, 7], pa.int64()), pa.array([0, 0, 0], pa.int64()), pa.array(texts)], ["id", "tag", "text"])
    groups = {}
    for part in D._dealt(7, 16, 4, 3, 10**6)(iter([batch])):
        for row in pa.Table.from_batches([part]).to_pylist():
            groups.setdefault(row["bucket"], []).append(row)
    rows = [r for g in groups.values() for r in D._meet(pa.Table.from_pylist(g, part.schema)).to_pylist()]
    got = {(r["id"], r["line"]): r["node"] for r in rows if r["line"] is not None}
    assert set(got) == {(5, 0), (5, 1), (5, 2), (6, 0), (6, 1), (7, 0)} and got[5, 1] is None and got[6, 1] is None
    assert got[5, 0] == got[6, 0] and len(set(got.values())) == 4
    links = {(r["x"], r["z"]) for r in rows if r["value"] is not None}
    assert links == {(max(got[5, 0], got[7, 0]), min(got[5, 0], got[7, 0]))}


def test_buckets_of_two_are_settled(spark):
    """Two members alone are linked with each other, so they have been compared."""
    members = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (2, 11), (2, 12), (3, 10), (3, 11), (3, 13)], "value long, c long")
    roots = spark.createDataFrame([(11, 10), (13, 10)], "node long, component long")
    assert sorted((r.value, r.c, r.root) for r in D._undecided(members, roots).collect()) == [(2, 10, 10), (2, 11, 10), (2, 12, 12)]


def test_small_tables_of_counts_and_bits_lose_nothing(spark, monkeypatch):
    """Lists for every bucket of three, with shingles that share cells and a sieve that lets most lines pass."""
    for name, value in (("SHORT", 2), ("CELLS", 8), ("SIEVE", 64), ("FLUSH", 300), ("GROUP", 5000)):
        monkeypatch.setattr(D, name, value)
    rows = corpus(7)
    got = {r.doc_id: {(k, x.doc_id, x.line) for k, x in zip(r.dropped_lines, r.kept_from, strict=True)} for r in D.line_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert {d: s for d, s in got.items() if s} == brute(rows)
