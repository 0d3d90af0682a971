"""Runs that were cut short and started again in the same folder."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom import run
from tabloom.plans import full_run, stages
from tabloom.sources.writers import plain

STAGES = ["cleaning", "correlation", "split", "balancing", "generation", "comparison"]
SMALL = dict(n=60, epochs=2, latent_dim=4, hidden=8, batch_size=32)


def lines(n=300, shift=0.0):
    rng = np.random.default_rng(2)
    rows = ["PassengerId,Survived,Pclass,Sex,Age"]
    for i in range(n):
        age = "" if i % 7 == 0 else f"{rng.normal(30 + shift, 10):.1f}"
        rows.append(f"{i},{int(rng.random() < 0.4)},{rng.integers(1, 4)},{'male' if rng.random() < 0.6 else 'female'},{age}")
    return "\n".join(rows)


def content(r):
    tables = [r.cleaned, r.train, r.test, r.balanced, r.synthetic, r.comparison.table, r.comparison.frequencies, r.comparison.score]
    return [(t.columns, sorted(map(str, t.collect()))) for t in tables]


def test_a_second_run_reads_all_stages(spark, tmp_path, monkeypatch):
    source, out = tmp_path / "in.csv", str(tmp_path / "out")
    source.write_text(lines())
    first = run(spark, str(source), "survived", out, **SMALL)
    assert first.reused == []
    for name in ("clean_stage", "correlation_stage", "analyze_and_balance", "generation_stage", "comparison_stage"):
        monkeypatch.setattr(stages, name, lambda *_, **__: pytest.fail("a stage is done again"))
    second = run(spark, str(source), "survived", out, **SMALL)
    assert second.reused == STAGES
    assert content(second) == content(first)
    assert [f.metadata for f in second.synthetic.schema.fields] == [f.metadata for f in first.synthetic.schema.fields]
    assert plain(second.reports) == plain(first.reports)
    assert second.model.steps == first.model.steps and all(np.array_equal(second.model.states[k], first.model.states[k]) for k in first.model.states)


def test_other_settings_and_other_data_redo_what_hangs_on_them(spark, tmp_path):
    source, out = tmp_path / "in.csv", str(tmp_path / "out")
    source.write_text(lines())
    run(spark, str(source), "survived", out, **SMALL)
    assert run(spark, str(source), "survived", out, drift_limit=0.4, **SMALL).reused == STAGES[:5]
    assert run(spark, str(source), "survived", out, **(SMALL | dict(n=70))).reused == STAGES[:4]
    assert run(spark, str(source), "survived", out, resume=False, **SMALL).reused == []
    source.write_text(lines(320, 1.0))
    again = run(spark, str(source), "survived", out, **SMALL)
    assert again.reused == [] and again.cleaned.count() == 320


def test_a_run_that_lost_its_driver_goes_on(spark, tmp_path, monkeypatch):
    source, out = tmp_path / "in.csv", str(tmp_path / "out")
    source.write_text(lines())
    whole = run(spark, str(source), "survived", str(tmp_path / "whole"), **SMALL)
    balance = stages.analyze_and_balance

    def lost(*args, **options):
        balance(*args, **options)  # all is written but the manifest
        raise RuntimeError("the driver is lost")

    monkeypatch.setattr(full_run.stages, "analyze_and_balance", lost)
    with pytest.raises(RuntimeError, match="lost"):
        run(spark, str(source), "survived", out, **SMALL)
    monkeypatch.undo()
    (tmp_path / "out" / "data" / "test" / "_SUCCESS").unlink()  # and a table that isn't whole
    found = run(spark, str(source), "survived", out, **SMALL)
    assert found.reused == ["cleaning", "correlation"]
    assert content(found) == content(whole)


def test_a_folder_another_run_has_begun_to_write_is_not_trusted(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    df = spark.range(200).select("id", F.expr("id % 2").alias("k"), (F.col("id") % 17).cast("double").alias("x"), F.expr("id * id % 23").alias("y"))
    other = df.withColumn("x", F.col("x") + 1)
    first = run(spark, df, "k", out, keys=["id"], **SMALL)
    clean = stages.clean_stage

    def lost(*args, **options):
        clean(*args, **options)
        raise RuntimeError("the driver is lost")

    monkeypatch.setattr(full_run.stages, "clean_stage", lost)
    with pytest.raises(RuntimeError, match="lost"):
        run(spark, other, "k", out, keys=["id"], **SMALL)
    monkeypatch.undo()
    found = run(spark, df.repartition(3), "k", out, keys=["id"], **SMALL)
    assert "cleaning" not in found.reused
    assert found.cleaned.agg(F.sum("x")).first() == df.agg(F.sum("x")).first()
    assert found.reports["cleaning"] == first.reports["cleaning"]
