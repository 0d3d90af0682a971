from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tabloom.llm import language as L
from tabloom.llm import queries

SF = "/root/testdata/sf0.01"


def test_words_and_grams_against_plain_python():
    texts = ["Ab c", None, "", "x", "no1two-é É", "12 .", "ΣΑΣ a", "end", "end"]
    stream, offsets = L.letter_stream(pa.array(texts)[0:])
    words = L.words_of(stream, offsets)
    table = L._letters()
    want = []
    for t in texts:
        low = "".join(chr(table[ord(c)]) if table[ord(c)] else " " for c in t or "")
        want.append(low.split())
    got = [["".join(map(chr, stream[words.start[i] : words.stop[i]])) for i in range(a, b)] for a, b in itertools.pairwise(words.offsets)]
    assert got == want
    flat = [w for ws in want for w in ws]
    assert len(set(words.code.tolist())) == len(set(flat))
    by_word = [set() for _ in flat]
    places_of = {}
    for n, (places, word) in zip(L.GRAMS, L.grams_of(stream, words), strict=True):
        counts = np.bincount(word, minlength=len(flat))
        assert counts.tolist() == [len(w) + 3 - n if len(w) + 3 - n > 0 else 0 for w in flat]
        for p, i in zip(places.tolist(), word.tolist(), strict=True):
            by_word[i].add((n, p))
        assert (np.diff(word) >= 0).all()
    for w, s in zip(flat, by_word, strict=True):
        assert places_of.setdefault(w, s) == s


def test_forward_backward_against_all_paths(monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(L, "LANE", 3)
    step = rng.uniform(0.1, 2, (3, 3))
    sizes = [1, 0, 7, 2, 3, 6]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    potential = rng.uniform(0.01, 1, (sum(sizes), 3))
    got = L.forward_backward(potential, step, offsets)
    for a, b in itertools.pairwise(offsets):
        total = np.zeros((b - a, 3))
        for path in itertools.product(range(3), repeat=b - a):
            weight = step[:, path[0]].sum() if path else 0
            for t, c in enumerate(path):
                weight *= potential[a + t, c] * (step[path[t - 1], c] if t else 1)
            for t, c in enumerate(path):
                total[t, c] += weight
        if b > a:
            assert np.allclose(got[a:b], total / total.sum(axis=1, keepdims=True))
    assert L.forward_backward(np.zeros((0, 3)), step, np.zeros(1, np.int64)).shape == (0, 3)


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(6)
    score, move = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3))

    def log_total(score, move):
        out = 0
        for s in score:
            ahead = np.exp(move).sum(axis=0) * np.exp(s[0])
            for row in s[1:]:
                ahead = (ahead @ np.exp(move)) * np.exp(row)
            out += np.log(ahead.sum())
        return out

    post, pairs = L._expected(score, move)
    eps = 1e-6
    for i in np.ndindex(score.shape):
        up = score.copy()
        up[i] += eps
        assert abs((log_total(up, move) - log_total(score, move)) / eps - post[i]) < 1e-4
    assert abs(pairs.sum() - 6) < 1e-9


SPANS = {"aa": ["lorem ipsum dolor sit amet"] * 5, "bb": ["zwei kühe stehen schön"] * 5}


def model():
    return L.fit_language(SPANS, sequences=300)


def test_passages_of_a_mixed_text(spark):
    rows = [(1, "lorem dolor sit amet ipsum, zwei kühe stehen schön zwei!", 5, "c"), (2, None, 5, "c"), (3, "12 !", 5, "c"), (4, "Kühe ZWEI", 5, "c"), (None, "ipsum " * 3000, 5, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found int, lang string")
    got = {r.row.doc_id: r.found for r in L.identify(docs, model()).collect()}
    assert [(p.lang, p.first_word, p.words) for p in got[1].passages] == [("aa", 0, 5), ("bb", 5, 5)]
    assert (got[2].lang, got[2].score) == (got[3].lang, got[3].score) == ("und", 0.0)
    assert got[4].lang == "bb" and got[4].score > 0.9
    assert got[None].lang == "aa" and got[None].passages[0].words == 3000
    nothing = L.identify(docs, None).collect()
    assert {(r.found.lang, r.found.score) for r in nothing} == {("und", 0.0)}
    assert L.identify(docs.where("false"), model()).count() == 0


def test_one_language_and_no_teachers(spark):
    one = L.fit_language({"xx": ["some words here"]}, sequences=20)
    docs = spark.createDataFrame([(1, "anything"), (2, "")], "doc_id long, text string")
    assert [r.found.lang for r in L.identify(docs, one).orderBy("row.doc_id").collect()] == ["xx", "und"]
    assert L.fit_language({}) is None and L.fit_language({"xx": ["1 2", ""]}) is None
    odd = spark.createDataFrame([(1, None, "en"), (None, "a b", "en"), (2, "a b", None)], "doc_id long, text string, lang string")
    assert L.teaching_spans(odd) == {}


def test_spans_are_bounded(spark):
    rows = [(i, chr(0x4E00 + i) * 200_000, "zh") for i in range(3)] + [(7, "a copy of a text", "en")] * 500 + [(8, f"text number {i}", "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    spans = L.teaching_spans(docs, docs_per_language=300, spans_per_doc=4)
    assert set(spans) == {"zh", "en"} and max(len(s) for v in spans.values() for s in v) <= L.SPAN * (L.LONGEST + 1)
    assert len(spans["zh"]) <= 12 and spans["en"].count("a copy of a text") <= 1
    few = L.teaching_spans(docs, docs_per_language=20, spans_per_doc=4)
    assert all(len(v) <= 160 for v in few.values())
    assert few == L.teaching_spans(docs.repartition(2), docs_per_language=20, spans_per_doc=4)


def test_query_on_held_out_documents(spark):
    out = queries.op2_language(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    assert out.count() == docs.count()
    rows = out.join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
    assert out.where((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
