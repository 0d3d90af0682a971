from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom import SynthModel, ValidationError, continue_fit, fit, run, sample, synthesize
from tabloom.operators import adversarial as net
from tabloom.operators import synthesis as s

SMALL = dict(latent_dim=8, hidden=16, batch_size=32, learning_rate=0.002)


def table(spark, parts=4, n=400):
    rng = np.random.default_rng(0)
    data = [(float(rng.normal(10 + 20 * (i % 2), 2)), float(rng.exponential(3)), int(rng.integers(0, 3)), "ab"[i % 2]) for i in range(n)]
    return spark.createDataFrame(data, "x double, y double, z int, k string").repartition(parts)


def test_quotas():
    assert s.class_quotas([0, 1, 2], 1000) == {0: 334, 1: 333, 2: 333}
    assert s.class_quotas([0, 1], 1) == {0: 1, 1: 1}
    assert s.class_quotas([0, 1], 1, strict_n=True) == {0: 1, 1: 0}
    assert s.class_quotas([0, 1], 1000) == {0: 500, 1: 500}


def test_gradients_match_finite_differences():
    layout = net.shapes(3, 5, 2)
    rng = np.random.default_rng(0)
    flat = net.initial_state(layout, rng)[: net.weight_count(layout)]
    rows, truth = rng.normal(size=(6, 2)), np.array([[1.0], [0], [1], [0], [0], [1]])

    def loss(w):
        logit = net._judge(net.views(w, layout), rows)[1]
        return net._softplus(np.where(truth > 0, -logit, logit)).sum() / 6

    weights = net.views(flat, layout)
    hidden, logit = net._judge(weights, rows)
    grads = net._judge_gradients(weights, rows, hidden, (net._sigmoid(logit) - truth) / 6)[1]
    got = np.concatenate([g.ravel() for g in grads])
    start = net.weight_count(layout[:4])
    for i in range(0, len(got), 3):
        step = np.zeros_like(flat)
        step[start + i] = 1e-6
        assert got[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-6, abs=1e-6)


def test_fit_and_sample_by_class(spark):
    df = table(spark)
    model = fit(df, ["x", "y", "z"], "k", epochs=60, **SMALL)
    out = sample(spark, model, 1001).cache()
    assert out.columns == ["x", "y", "z", "k"]
    limits = df.groupBy("k").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in "xyz" for f in (F.min, F.max)])
    bad = out.join(limits, "k").where(" or ".join(f"{c} < min_{c} - 1e-6 or {c} > max_{c} + 1e-6" for c in "xyz"))
    assert bad.count() == 0
    assert {r["k"]: r["count"] for r in out.groupBy("k").count().collect()} == {"a": 501, "b": 500}
    metrics = model.metrics_table(spark)
    assert metrics.count() == 120 and metrics.where("isnan(loss_g) or isnan(loss_d)").count() == 0
    summary = s.fit_summary(metrics).collect()
    assert all(r["total_epochs"] == 60 and r["convergence_ratio"] > 0 for r in summary)


def test_training_beats_no_training(spark):
    df = table(spark, n=1000)
    real = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.avg("y").alias("m")).collect()}

    def error(epochs):
        out = synthesize(df, 1000, ["x", "y", "z"], "k", epochs=epochs, **{**SMALL, "learning_rate": 1e-9 if epochs == 1 else 0.002})
        return sum(abs(r["m"] - real[r["k"]]) for r in out.groupBy("k").agg(F.avg("y").alias("m")).collect())

    assert error(150) < error(1) / 2


def test_result_does_not_depend_on_layout(spark):
    states = [fit(table(spark, p), ["x", "y"], "k", epochs=6, shard_rows=64, rounds=2, **SMALL) for p in (1, 5)]
    for k in ("a", "b"):
        assert np.allclose(states[0].states[k], states[1].states[k])
    a, b = sample(spark, states[0], 9000), sample(spark, states[0], 9000).repartition(3)
    assert a.exceptAll(b).count() == 0
    assert states[0].metrics[0][3] > 1  # several shards


def test_copies_spread_over_shards(spark):
    base = spark.range(2000).select(F.when(F.col("id") < 1500, 1.0).otherwise(F.col("id").cast("double")).alias("x"), F.lit(0).alias("k"))
    shards = s.pack_shards(base, ["x"], "k", {0: 2000}, 500)
    sizes = [sum(r["copies"]) for r in shards.collect()]
    assert sum(sizes) == 2000 and max(max(r["copies"]) for r in shards.collect()) <= s.COPIES and len(sizes) > 1


def test_whole_table_model_save_load_and_continue(spark, tmp_path):
    df = table(spark).drop("k")
    model = fit(df, epochs=5, **SMALL)
    assert model.by is None and list(model.counts) == [None]
    model.save(spark, str(tmp_path / "m"))
    back = SynthModel.load(spark, str(tmp_path / "m"))
    assert np.allclose(back.states[None], model.states[None]) and back.metrics == model.metrics
    assert sample(spark, back, 50).exceptAll(sample(spark, model, 50)).count() == 0
    new, out = continue_fit(df, back, epochs=3, batch_size=32)
    assert out.count() == 400 and new.steps[None] == model.steps[None] + 3 * (400 // 32)
    by = fit(table(spark), ["x"], "k", epochs=2, **SMALL)
    by.save(spark, str(tmp_path / "k"))
    assert SynthModel.load(spark, str(tmp_path / "k")).counts == by.counts


def test_small_classes_nulls_and_bad_arguments(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "a"), (float("inf"), "a"), (5.0, "b"), (2.0, None)], "x double, k string")
    out = synthesize(df, 4, ["x"], "k", epochs=2, **SMALL)
    assert {r["k"] for r in out.collect()} == {"a", "b"} and all(r["x"] == pytest.approx(5, abs=1e-6) for r in out.collect() if r["k"] == "b")
    with pytest.raises(ValidationError):
        synthesize(df, 0, ["x"], "k")
    with pytest.raises(ValidationError):
        fit(df, ["x"], "k", epochs=0)


def test_full_run_writes_everything(spark, tmp_path):
    rng = np.random.default_rng(2)
    lines = ["PassengerId,Survived,Pclass,Sex,Age,Cabin"]
    for i in range(300):
        age = "" if i % 7 == 0 else f"{rng.normal(30, 10):.1f}"
        lines.append(f"{i},{int(rng.random() < 0.4)},{rng.integers(1, 4)},{'male' if rng.random() < 0.6 else 'female'},{age},{'' if i % 2 else f'C{i % 5}'}")
    (tmp_path / "in.csv").write_text("\n".join(lines))
    out = str(tmp_path / "out")
    r = run(spark, str(tmp_path / "in.csv"), "survived", out, n=100, epochs=3, latent_dim=8, hidden=16)
    assert r.train.count() == 240 and r.test.count() == 60 and r.synthetic.count() == 100
    assert r.synthetic.columns[:2] == ["pclass", "age"] or set(r.synthetic.columns) >= {"pclass", "age", "sex_male", "sex_female", "survived"}
    meta = r.reports["comparison"]["_metadata"]
    assert meta["total_variables"] == 5 and {"pclass", "age", "sex", "real_freq", "synthetic_freq"} <= set(r.reports["comparison"])
    for name in ("cleaned", "train", "test", "balanced", "synthetic"):
        assert spark.read.parquet(f"{out}/data/{name}").count() > 0
    for name in ("cleaning", "classes", "correlation", "features", "comparison"):
        assert json.loads("\n".join(x[0] for x in spark.read.text(f"{out}/reports/{name}").collect()))
    for name in ("categories", "histograms", "target"):
        assert spark.read.parquet(f"{out}/charts/{name}").count() > 0


def test_odd_names_and_categories_go_all_the_way(spark):
    rng = np.random.default_rng(3)
    titles = ["Mr. X", "Ms `Y`", 'Dr "Z"', "a b"]
    rows = [(int(i % 2), float(rng.normal()), titles[rng.integers(4)], float(rng.integers(0, 9))) for i in range(400)]
    raw = spark.createDataFrame(rows, "target int, `Size (cm)` double, `the.title` string, n double")
    r = run(spark, raw, "target", n=60, epochs=2, latent_dim=4, hidden=8)
    assert "the_title_Mr. X" in r.synthetic.columns and r.synthetic.count() == 60
    assert r.reports["comparison"]["the_title"]["categories"] == sorted(titles)
    plain = spark.createDataFrame([(1.0, "a"), (2.0, "b")] * 20, "`x.y` double, `k.l` string")
    assert synthesize(plain, 6, ["x.y"], "k.l", epochs=1, **SMALL).columns == ["x.y", "k.l"]


def test_an_interrupted_fit_goes_on_behind_its_last_round(spark, tmp_path, monkeypatch):
    from tabloom.operators import synthesis

    df = spark.range(600).select(F.expr("concat('c', id % 2)").alias("k"), (F.col("id") % 97).cast("double").alias("x"), F.rand(3).alias("y"))
    options = dict(epochs=8, rounds=4, shard_rows=100, batch_size=32, latent_dim=4, hidden=8)
    whole = fit(df, ["x", "y"], "k", **options)
    train, rounds = synthesis._train_round, []

    def failing(*args):
        rounds.append(1)
        if len(rounds) == 3:
            raise RuntimeError("the driver is lost")
        return train(*args)

    monkeypatch.setattr(synthesis, "_train_round", failing)
    folder = str(tmp_path / "journal")
    with pytest.raises(RuntimeError, match="lost"):
        fit(df, ["x", "y"], "k", journal=folder, **options)
    found = fit(df, ["x", "y"], "k", journal=folder, **options)
    assert len(rounds) == 5  # two, the failing one, and the two that were left
    again = fit(df, ["x", "y"], "k", journal=folder, **options)
    assert len(rounds) == 5
    for model in (found, again):
        assert model.steps == whole.steps and [m[:4] for m in sorted(model.metrics)] == [m[:4] for m in sorted(whole.metrics)]
        for k in whole.states:
            assert np.allclose(model.states[k], whole.states[k], rtol=0, atol=1e-9)
    fit(df.where("id is not null") if "id" in df.columns else df.limit(500), ["x", "y"], "k", journal=folder, **options)
    assert len(rounds) == 9  # other data: a journal of its own


def test_tiny_shards_of_equal_rows_are_dealt_out_by_their_number(spark):
    """They were dealt out by their bytes, which are few where rows repeat, and so trained by few tasks."""
    from pyspark.sql import functions as F

    from tabloom.operators.synthesis import pack_shards

    df = spark.range(4000).selectExpr("cast(id % 1000 as double) as x", "0 as class")
    shards = pack_shards(df, ["x"], "class", {0: 4000}, 50)
    files = [r["count"] for r in shards.groupBy(F.input_file_name()).count().collect()]
    assert len(files) == 8 * spark.sparkContext.defaultParallelism and sum(files) == shards.count() and max(files) <= 3
    assert shards.selectExpr("sum(aggregate(copies, 0, (a, c) -> a + c))").first()[0] == 4000
