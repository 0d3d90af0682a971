from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tabloom.llm import packing as P
from tabloom.llm import queries

PATH = queries.tokenizer_path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [x.ids + [0] for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_are_those_of_the_tokenizer(reference):
    rng = random.Random(1)
    common = [" ", "  ", "\n", "a", "bc", "'s", "é", ".", "1", "²", "ª", "×", "'LL", "ǅ", "¼", "\n\n", "·", "µ", "'re", "-", "Wort"]
    rare = ["\t", "漢", "\x85", "\xa0", " ", "<|endoftext|>", "𝒳", "́", "​", "\x1c", "\r\n"]
    texts = ["".join(rng.choice(common + rare * (i % 3 == 0)) for _ in range(rng.randint(0, 24))) for i in range(6000)]
    texts += [f"{chr(c)} a{chr(c)}1{chr(c)}\n{chr(c)}'s" for c in [*range(32, 127), *range(0xA1, 0x250)]]
    texts += ["", " ", "x" * 50_000, " " * 30_000, "\n" * 5_000 + "a", "ab " * 20_000, "漢" * 9_000]
    ids = P.Ids(PATH, 0)
    assert ids.quick is not None and sum(not P.odd_text(t) for t in texts) > 4000
    assert ids.encode(texts) == reference(texts)


def test_other_vocabularies_are_left_to_the_tokenizer():
    described = {"model": {"type": "BPE", "vocab": {"a": 0}, "merges": []}, "pre_tokenizer": {"type": "Whitespace"}}
    assert P.byte_ranks(described) is None
    ids = P.Ids(queries.tokenizer_path("word_bpe_49k.json"), 0)
    assert ids.quick is None and ids.encode(["Hello there"])[0] == [*ids.tokenizer.encode("Hello there", add_special_tokens=False).ids, 0]


def test_cuts():
    assert P.cuts(5, 10) == [(0, 5)] and P.cuts(10, 10) == [(0, 10)]
    assert P.cuts(11, 10) == [(0, 1), (1, 10)] and P.cuts(30, 10) == [(0, 10), (10, 10), (20, 10)]


def brute_best_two_fit(lengths: list[int], most: int) -> list[list[int]]:
    """The same rule with lists and no tables: the multisets of the sequences."""
    left, out = sorted(lengths, reverse=True), []
    while left:
        room, seq = most, []

        def fill():
            nonlocal room
            while fit := [x for x in left if x <= room]:
                left.remove(fit[0])
                seq.append(fit[0])
                room -= fit[0]

        fill()
        if room and left:
            least, wide = seq[-1], room + seq[-1]
            best = None
            for i, a in enumerate(left):
                for b in left[i + 1 :]:
                    if least < a + b <= wide and (best is None or (a + b, a) > best):
                        best = (a + b, a)
            if best:
                seq.pop()
                for x in (best[1], best[0] - best[1]):
                    left.remove(x)
                    seq.append(x)
                left.append(least)
                left.sort(reverse=True)
                room = wide - best[0]
                fill()
        out.append(sorted(seq))
    return out


@pytest.mark.parametrize("seed", range(5))
def test_best_two_fit_against_plain_lists(seed):
    rng = random.Random(seed)
    for _ in range(80):
        most = rng.choice([5, 10, 37, 100])
        lengths = [rng.randint(1, most) for _ in range(rng.randint(1, 70))]
        sequence, offset = P.best_two_fit(np.array(lengths), most)
        made = [[] for _ in range(int(sequence.max()) + 1)]
        for i in np.lexsort((offset, sequence)):
            assert offset[i] == sum(made[sequence[i]])
            made[sequence[i]].append(lengths[i])
        assert [sorted(m) for m in made] == brute_best_two_fit(lengths, most)


def check_whole(rows, docs, most, reference):
    """Pieces put together are the documents, places are gapless, sequences are not too long."""
    want = {}
    for (d, _), ids in zip(docs, reference([t for _, t in docs]), strict=True):
        n = len(ids)
        first = n % most or most
        for k, (a, b) in enumerate([(0, min(n, first)), *((x, x + most) for x in range(first, n, most))]):
            key = (d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
            want[key] = want.get(key, 0) + 1
    got, places = {}, {}
    for r in rows:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        got[key] = got.get(key, 0) + 1
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= most
    return len(places), sum(r.length for r in rows)


def test_query_packs_tightly(spark, reference):
    rows = queries.op13_sequence_packing(spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    made, tokens = check_whole(rows, docs, 2048, reference)
    assert made <= -(-tokens // 2048) * 1.005 + 1


def test_odd_rows_and_sequences(spark, reference):
    docs = [(1, None), (2, ""), (3, "word " * 9000), (None, "null id"), (5, "same"), (5, "same"), (5, "other text"), (6, "x" * 5000), (7, "漢字 " * 50)]
    docs += [(100 + i, "a few words " * (i % 40)) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as length", "2 as piece", "'x' as ids", "3 as start")
    packed = P.pack_documents(df, PATH, most=64, group=50)
    rows = packed.selectExpr("*", "crc32(ids) as ids_crc32").collect()
    check_whole(rows, docs, 64, reference)
    made = {r.sequence_id: r for r in P.sequences(packed).collect()}
    for r in rows:
        s = made[r.sequence_id]
        assert bytes(s.ids)[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids) and len(s.ids) == 4 * s.length


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert P.pack_documents(empty, PATH).collect() == []
