from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tabloom.llm import mixing

from test_decontamination import brute as leaks
from test_line_dedup import brute as lines
from test_near_dedup import brute as near
from test_quality_mixing import plain_statistics

SF = "/root/testdata/sf0.001"


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def cut(rows):
    drop = lines(rows)
    out = []
    for d, t in rows:
        gone = {k for k, *_ in drop.get(d, ())}
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
        if not gone or re.search(r"[^\x20\x09-\x0D]", left):
            out.append((d, left if gone else t))
    return out


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = P.quality_stage(spark, docs, SF).cache()
    assert good.columns == docs.columns and good.dtypes == docs.dtypes
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    right = sum((d in kept) == (q == 1) for d, q in labels.items())
    assert right / len(labels) > 0.95 and len(plain_statistics("x"))
    want = cut(pairs(good))
    got = P.line_stage(spark, good, SF).cache()
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    assert sorted(pairs(got)) == sorted(want)
    assert got.where("n_chars != length(text)").count() == 0
    groups = near(want, 5)
    want = [(d, t) for d, t in want if groups[d][1] == d]
    got = P.near_stage(spark, got, SF).cache()
    assert got.dtypes == docs.dtypes and sorted(pairs(got)) == sorted(want)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    tainted = {d for d, t in want if any(leaks([(d, t)], [(i, x)]) for i, x in items if len(set(x.lower().split()) & set(t.lower().split())) > 8)}
    want = [(d, t) for d, t in want if d not in tainted]
    got = P.decontamination_stage(spark, got, SF).cache()
    assert got.dtypes == docs.dtypes and sorted(pairs(got)) == sorted(want) and tainted
    last = P.mixing_stage(spark, got, SF)
    assert last.columns[: len(docs.columns)] == docs.columns and sorted(pairs(last)) == sorted(want)
    sizes = Counter(r.source for r in got.collect())
    shares = mixing.whole_shares({s: n**0.5 for s, n in sizes.items()}, 1000)
    for r in last.collect():
        assert r.mix_release <= r.mix_slot < r.mix_deadline
        assert r.mix_release == (r.mix_block - 1) * 1000 // shares[r.source]
    assert sorted(pairs(P.run(spark, SF))) == sorted(want)


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_odd_rows_and_empty_tables(spark, name, stage):
    rows = [(1, "some words of a usual kind, here.", None, None, None, "x"), (None, None, "en", "a", 0, "y"), (None, "other words, quite unlike.", None, "a", 3, None), (2, "", "en", "a", 0, "z"), (2, "", "en", "a", 0, "z"), (3, "word " * 20_000, "en", "b", 1, "x"), (4, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, mix_slot string")
    odd = docs.select("*", F.lit(1).alias("row"), F.lit("k").alias("key"), F.lit(2).alias("stats"), F.lit(3).alias("component_id"), F.lit(4).alias("tag"))
    out = stage(spark, odd, SF)
    assert out.columns[: len(odd.columns)] == odd.columns
    got = out.collect()
    assert len({r.doc_id for r in got}) >= 3 and any(r.doc_id is None for r in got)
    assert stage(spark, odd.where("false"), SF).count() == 0


def test_near_stage_keeps_texts_apart_that_share_an_id(spark):
    words = lambda a: " ".join(f"w{a}x{i}" for i in range(60))
    rows = [(3, words(1) + " end"), (5, words(1)), (5, words(2)), (7, words(2) + " end")]
    got = P.near_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(pairs(got)) == [rows[0], rows[2]]


def test_copies_without_an_id(spark):
    """Near copies, three of them without an id: the one that has an id stays, and lines that it has go from the others."""
    body = [f"line number {i} of a text that is about things {i * 7919}" for i in range(30)]
    rows = [(8, "\n".join(body)), (None, "\n".join([*body[:-1], "another end of it"])), (None, "\n".join(body)), (None, "\n".join(body)), (None, "quite other words"), (9, "not like it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(pairs(P.near_stage(spark, docs, SF)), key=str) == sorted([rows[0], rows[4], rows[5]], key=str)
    left = sorted(pairs(P.line_stage(spark, docs, SF)), key=str)
    assert left == sorted([rows[0], (None, "another end of it"), rows[4], rows[5]], key=str)


def test_whole_texts_go_to_tasks_in_small_batches(spark, tmp_path, monkeypatch):
    """Each task held 10,000 whole texts on both sides of Python."""
    import corpus_pipeline

    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(name)
    spark.createDataFrame([(1, "a text")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", lambda s, docs, d: seen.append(int(s.conf.get(name))) or docs)])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 1
    assert seen == [1000] and spark.conf.get(name) == before


@pytest.mark.parametrize("stage, module, name", [("line_stage", "line_dedup", "drop_lines"), ("near_stage", "near_dedup", "near_dedup")])
def test_stages_called_one_by_one_have_small_batches(spark, monkeypatch, stage, module, name):
    """The limit held in ``run`` only, and not for who calls the stages."""
    conf, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(conf)
    plain = getattr(getattr(P, module), name)
    monkeypatch.setattr(getattr(P, module), name, lambda *a, **b: seen.append(int(spark.conf.get(conf))) or plain(*a, **b))
    docs = spark.createDataFrame([(1, "a text"), (2, "another")], "doc_id long, text string")
    assert getattr(P, stage)(spark, docs, SF).count() == 2
    assert seen == [P.BATCH_ROWS] and spark.conf.get(conf) == before
