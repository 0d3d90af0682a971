"""From a raw table to a scored synthetic one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tabloom import defaults as D
from tabloom.operators.checks import check_settings
from tabloom.operators.comparison import fidelity_score
from tabloom.operators.features import prepare_features
from tabloom.operators.sampling import stratified_split
from tabloom.operators.selection import with_hashes
from tabloom.operators.synthesis import SynthModel
from tabloom.plans import stages
from tabloom.plans.resume import StageLog, source_key
from tabloom.scratch import materialize
from tabloom.sources import file_format, read_table


@dataclass
class Run:
    cleaned: DataFrame
    train: DataFrame
    test: DataFrame
    balanced: DataFrame
    synthetic: DataFrame
    model: SynthModel
    comparison: stages.Comparison
    reports: dict[str, dict[str, Any]] = field(default_factory=dict)
    reused: list[str] = field(default_factory=list)
    """stages that were read back; their reports are plain JSON"""


def run(
    spark: SparkSession,
    source: str | DataFrame,
    target: str = D.TARGET,
    out_dir: str | None = None,
    *,
    fmt: str | None = None,
    n: int = D.SYNTHETIC_ROWS,
    test_size: float = D.TEST_SIZE,
    seed: int = D.SEED,
    keys: Sequence[str] | None = None,
    epochs: int = D.EPOCHS,
    batch_size: int = D.BATCH_SIZE,
    latent_dim: int = D.LATENT_DIM,
    learning_rate: float = D.LEARNING_RATE,
    stratified: bool = True,
    max_categories: int = D.MAX_CATEGORIES,
    drift_limit: float = D.NUMERIC_DRIFT,
    correlation_columns: Sequence[str] | None = None,
    one_hot_limit: int = D.MAX_ONE_HOT,
    resume: bool = True,
    **fit_settings,
) -> Run:
    """Clean, correlate, split, balance, prepare, fit and sample, compare.

    Every stage's table is stored (in ``out_dir``, else in the shared scratch
    folder) and read from there, so a lost executor costs a task, not the run.

    With ``out_dir`` a run can be gone on with: started again there with the same source and settings, it reads the stages that were written to their
    end, goes on behind the last round of a fit that was cut short, and does the rest. ``resume=False`` does everything.
    """
    check_settings(
        test_size=test_size, seed=seed, epochs=epochs, batch_size=batch_size, latent_dim=latent_dim,
        learning_rate=learning_rate, n=n, max_categories=max_categories, drift_limit=drift_limit,
    )
    path = source if isinstance(source, str) else ""
    if path:
        fmt = fmt or file_format(path)
    resume = resume and out_dir is not None
    log = StageLog(spark, out_dir if resume else None, source_key(spark, source, fmt) if resume else "")
    if resume:
        fit_settings.setdefault("journal", f"{out_dir}/journal")
    reports: dict[str, dict[str, Any]] = {}

    def cleaning():
        raw = read_table(spark, path, fmt) if path else source
        if path and fmt != "parquet":
            raw = materialize(raw, "typed")  # parse text once, read columns from then on
        table, report = stages.clean_stage(raw, target, out_dir, path)
        return [table], report

    (cleaned,), reports["cleaning"] = log.stage("cleaning", dict(target=target), ["data/cleaned"], cleaning)
    columns = None if correlation_columns is None else list(correlation_columns)
    _, reports["correlation"] = log.stage(
        "correlation", dict(columns=columns), [], lambda: ([], stages.correlation_stage(cleaned, target, out_dir, columns))
    )

    hashed: list[DataFrame | None] = []

    def splitting():
        split = stratified_split(with_hashes(cleaned, keys, seed), target, test_size, seed, keys, hashed=True)
        hashed.append(split.hashed_train)
        return [stages._store(split.train, out_dir, "train"), stages._store(split.test, out_dir, "test")], {}

    chosen = dict(seed=seed, keys=None if keys is None else list(keys))
    (train, test), _ = log.stage("split", dict(test_size=test_size, **chosen), ["data/train", "data/test"], splitting)

    def balancing():
        table, report = stages.analyze_and_balance(train, target, out_dir, seed, keys, hashed[0] if hashed else None)
        return [table], report

    (balanced,), reports["analysis"] = log.stage("balancing", chosen, ["data/balanced"], balancing)
    training = dict(stratified=stratified, seed=seed, epochs=epochs, batch_size=batch_size, latent_dim=latent_dim, learning_rate=learning_rate)
    models: list[SynthModel] = []

    def generating():
        features = prepare_features(balanced, target, one_hot_limit=one_hot_limit)
        report = {"columns": features.columns, "identifiers": features.dropped, "left_out": features.left_out}
        stages._report(spark, report, out_dir, "features")
        table, model = stages.generation_stage(features, target, n, out_dir, **training, **fit_settings)
        models.append(model)
        return [table], report

    settled = {k: v for k, v in fit_settings.items() if k != "journal"}  # where progress is kept changes no result
    made, reports["features"] = log.stage(
        "generation", dict(n=n, one_hot_limit=one_hot_limit, **training, **settled), ["data/synthetic", "model/models", "model/metrics"], generating
    )
    synthetic, model = made[0], models[0] if models else SynthModel.load(spark, f"{out_dir}/model")
    limits = dict(max_categories=max_categories, drift_limit=drift_limit)

    def comparing():
        told = stages.comparison_stage(train, synthetic, target, out_dir, seed=seed, **limits)
        return [told.table, told.frequencies], told.report

    (table, frequencies), reports["comparison"] = log.stage("comparison", dict(seed=seed, **limits), ["data/comparison", "data/frequencies"], comparing)
    comparison = stages.Comparison(table, frequencies, fidelity_score(table), reports["comparison"])
    return Run(cleaned, train, test, balanced, synthetic, model, comparison, reports, log.reused)
