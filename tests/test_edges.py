"""Odd keys, infinities, file layouts, dates, and one algorithm at every size."""

from __future__ import annotations

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom import fit, read_csv, read_json, run, stratified_split
from tabloom.operators import adversarial as net
from tabloom.operators import medians as m

SMALL = dict(batch_size=16, latent_dim=4, hidden=8)


def test_composite_keys_with_separators_and_nulls(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("<null>", "x"), ("", "1:-"), (None, None), ("-", None)] * 1
    rows = [(a, b, i % 2) for i, (a, b) in enumerate(rows * 1)] + [(f"k{i}", "x", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "k1 string, k2 string, t int")
    split = stratified_split(df, "t", 0.25, keys=["k1", "k2"])
    assert split.train.count() + split.test.count() == len(rows)
    assert split.train.intersectAll(split.test).count() == 0


@pytest.mark.parametrize("share", [0.2, 0.35, 0.6])
def test_median_search_with_infinities_and_poor_samples(spark, monkeypatch, share):
    monkeypatch.setattr(m, "SAMPLE", 40)
    rng = random.Random(8)
    values = [-math.inf if rng.random() < share else rng.choice([math.inf, 1.0, rng.random()]) for _ in range(2001)]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "v double, g int")
    got = m.medians(df, ["v"], "g", direct_cells=0, final_values=30)
    for g in range(3):
        own = sorted(values[g::3])
        lo, hi = own[(len(own) - 1) // 2], own[len(own) // 2]
        want = (lo + hi) / 2
        assert got[g]["v"] == want or (math.isnan(got[g]["v"]) and math.isnan(want))
    finite = [v for v in values if math.isfinite(v)]
    plain = spark.createDataFrame([(v,) for v in finite], "v double")
    assert m.medians(plain, ["v"], direct_cells=0, final_values=30)[None]["v"] == pytest.approx(statistics.median(finite))


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,text\n1,"one\ntwo ""x"""\n2,plain\n')
    rows = read_csv(spark, str(tmp_path / "a.csv")).orderBy("k").collect()
    assert [(r.k, r.text) for r in rows] == [(1.0, 'one\ntwo "x"'), (2.0, "plain")]


@pytest.mark.parametrize("orient", ["lines", "records"])
def test_json_keeps_file_order(spark, tmp_path, orient):
    objects = ['{"z": "p", "b": 1, "a": "q"}', '{"z": "r", "b": 2, "new": "s", "a": "t"}']
    (tmp_path / "t.json").write_text("\n".join(objects) if orient == "lines" else "[" + ",\n".join(objects) + "]")
    df = read_json(spark, str(tmp_path / "t.json"), orient=orient)
    assert df.columns == ["z", "b", "a", "new"]
    assert sorted((r.z, r.b, r.a, r.new) for r in df.collect()) == [("p", 1, "q", None), ("r", 2, "t", "s")]


def test_rounds_and_steps_do_not_depend_on_shards(spark):
    df = spark.range(960).select((F.col("id") % 97).cast("double").alias("x"), F.rand(3).alias("y"))
    one, many = (fit(df, epochs=6, rounds=3, shard_rows=n, **SMALL) for n in (5000, 32))
    assert one.metrics[0][3] == 1 and many.metrics[0][3] >= 25
    assert one.steps == many.steps == {None: 6 * 60}
    assert len(one.metrics) == len(many.metrics) == 6
    assert all(np.isfinite(x.states[None]).all() for x in (one, many))


def test_more_batches_than_rows_reshuffle():
    layout = net.shapes(4, 8, 2)
    state = net.initial_state(layout, np.random.default_rng(1))
    data = np.random.default_rng(2).uniform(-1, 1, (20, 2)).astype(np.float32)
    _, steps, losses = net.train_shard(state, 0, data, layout, 3, 8, 1e-3, np.random.default_rng(3), 7)
    assert steps == 21 and np.isfinite(losses).all()


def test_run_with_dates_timestamps_and_truth_values(spark, tmp_path):
    df = spark.range(120).select(
        (F.col("id") % 2).cast("int").alias("label"),
        F.rand(1).alias("x"),
        (F.col("id") % 7).cast("double").alias("y"),
        F.expr("date_add(date'2020-01-01', cast(id as int))").alias("day"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id % 5 as int))").alias("at"),
        (F.col("id") % 3 == 0).alias("flag"),
        F.concat(F.lit("c"), F.col("id") % 4).alias("kind"),
    )
    result = run(spark, df, "label", str(tmp_path / "out"), n=50, epochs=2, **{k: v for k, v in SMALL.items()})
    assert result.synthetic.count() == 50
    assert set(result.reports["features"]["left_out"]) == {"day", "at"}
    for name in ("correlations", "correlation_triangle", "target_correlations", "classes_before", "classes_after"):
        assert spark.read.parquet(str(tmp_path / "out/charts" / name)).count() > 0
    assert spark.read.parquet(str(tmp_path / "out/model/models")).count() == 2
