"""The stages of a full run; each can be called on its own."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tabloom import defaults as D
from tabloom.functions.columns import col, string_columns
from tabloom.functions.local import keep_small, local_table
from tabloom.operators import comparison as cmp
from tabloom.operators.checks import check_balancing, check_comparison, check_correlation, quality_report
from tabloom.operators.cleaning import clean, cleaning_report
from tabloom.operators.correlation import correlation_report, lower_triangle
from tabloom.operators.features import Features
from tabloom.operators.sampling import Balanced, bootstrap_labels, undersample, validation_report
from tabloom.operators.selection import with_hashes
from tabloom.operators.synthesis import SynthModel, fit, sample
from tabloom.scratch import materialize
from tabloom.sources import write_report, write_table


def _store(df: DataFrame, out_dir: str | None, name: str) -> DataFrame:
    """Write a stage's table once; the next stages read the file, not the lineage."""
    if out_dir is None:
        return materialize(df, name)
    path = write_table(df, f"{out_dir}/data/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _report(spark: SparkSession, report: dict[str, Any], out_dir: str | None, name: str) -> None:
    if out_dir is not None:
        write_report(spark, report, f"{out_dir}/reports/{name}")


def clean_stage(
    raw: DataFrame, target: str, out_dir: str | None = None, source: str = ""
) -> tuple[DataFrame, dict[str, Any]]:
    """Clean, store, report with quality checks of the stored table."""
    cleaned = clean(raw, target)
    table = _store(cleaned.table, out_dir, "cleaned")
    quality = quality_report(table, "cleaned table", duplicates=0)
    report = {**cleaning_report(cleaned, table, source, quality), "quality_report": quality}
    _report(raw.sparkSession, report, out_dir, "cleaning")
    return table, report


def correlation_stage(
    table: DataFrame, target: str, out_dir: str | None = None, columns: Sequence[str] | None = None
) -> dict[str, Any]:
    check_correlation(table)
    report = correlation_report(table, target, columns)
    _report(table.sparkSession, report, out_dir, "correlation")
    if out_dir is not None:
        # the report holds the whole matrix already; it is as large as the square of the number of columns
        names = list(report["correlation_matrix"])
        cells = [
            (i, j, a, b, report["correlation_matrix"][b][a]) for i, a in enumerate(names) for j, b in enumerate(names)
        ]
        schema = "i int, j int, variable_1 string, variable_2 string, correlation double"
        matrix = local_table(table.sparkSession, cells, schema)
        write_table(matrix, f"{out_dir}/charts/correlations")
        write_table(lower_triangle(matrix), f"{out_dir}/charts/correlation_triangle")
        write_table(cmp.target_correlation_bars(matrix, target), f"{out_dir}/charts/target_correlations")
    return report


def analyze_and_balance(
    train: DataFrame,
    target: str,
    out_dir: str | None = None,
    seed: int = D.SEED,
    keys: Sequence[str] | None = None,
    hashed: DataFrame | None = None,
) -> tuple[DataFrame, dict[str, Any]]:
    """Class analysis, undersampling and its validation; ``hashed`` are the rows of ``train`` with their hashes, where they are at hand."""
    check_balancing(train, target)
    hashed = with_hashes(train, keys, seed) if hashed is None else hashed
    balanced: Balanced = undersample(hashed, target, seed=seed, keys=keys, hashed=True)
    table = _store(balanced.table, out_dir, "balanced")
    before, after = balanced.counts_before, balanced.counts_after
    report = {
        "class_analysis": {
            "original_distribution": before,
            "minority_class": min(before, key=lambda c: before[c]),
            "imbalance_ratio": min(before.values()) / max(before.values()),
        },
        "balancing": balanced.report(),
        "validation": validation_report(before, after),
    }
    _report(train.sparkSession, report, out_dir, "classes")
    if out_dir is not None:
        write_table(cmp.class_bars(train, target), f"{out_dir}/charts/classes_before")
        write_table(cmp.class_bars(table, target), f"{out_dir}/charts/classes_after")
    return table, report


def generation_stage(
    features: Features,
    target: str,
    n: int,
    out_dir: str | None = None,
    *,
    stratified: bool = True,
    seed: int = D.SEED,
    **settings,
) -> tuple[DataFrame, SynthModel]:
    """Fit per class, sample, undo the scaling; the class stays on the synthetic rows."""
    spark = features.table.sparkSession
    # scaling alone costs less than writing what it gives; one-hot columns can be many
    prepared = materialize(features.table, "features") if features.one_hot_values else features.table
    model = fit(prepared, features.columns, target if stratified else None, seed=seed, **settings)
    if out_dir is not None:
        model.save(spark, f"{out_dir}/model")
    synthetic = features.scaler.inverse(sample(spark, model, n, seed=seed))
    # names of one-hot columns keep saying where they come from, in the stored table too
    dummies = {f.name: f.metadata for f in features.table.schema.fields if f.metadata}
    named = synthetic.select(*[col(c).alias(c, metadata=dummies.get(c, {})) for c in synthetic.columns])
    return _store(named, out_dir, "synthetic"), model


@dataclass
class Comparison:
    """The comparison as tables (small, stored) and as a nested report."""

    table: DataFrame
    frequencies: DataFrame
    score: DataFrame
    report: dict[str, Any]


def comparison_stage(
    real: DataFrame,
    synthetic: DataFrame,
    target: str,
    out_dir: str | None = None,
    *,
    seed: int = D.SEED,
    max_categories: int = D.MAX_CATEGORIES,
    drift_limit: float = D.NUMERIC_DRIFT,
    legacy_target_entries: bool = True,
) -> Comparison:
    """Real rows against synthetic ones.

    The synthetic class is compared through labels drawn from the real target,
    one per synthetic row; the class kept on the synthetic rows takes no part.
    """
    check_comparison(real, synthetic, max_categories, drift_limit)
    spark = real.sparkSession
    features = synthetic.drop(target)
    labels = bootstrap_labels(real, target, synthetic.count(), seed)
    numeric = cmp.common_numeric_columns(real, features)
    categorical = string_columns(real)
    # at most max_categories rows per column, and one row per column
    frequencies = keep_small(cmp.category_frequencies(real, features, categorical, max_categories))
    target_freqs = keep_small(cmp.target_frequencies(real, labels, target))
    table = keep_small(
        cmp.comparison_table(
            real, features, numeric=numeric, categorical=categorical, target=target, synthetic_target=labels,
            drift_limit=drift_limit, legacy_target_entries=legacy_target_entries, frequencies=frequencies,
        )
    )
    report = cmp.comparison_report(table, frequencies, target_freqs)
    _report(spark, report, out_dir, "comparison")
    if out_dir is not None:
        write_table(table, f"{out_dir}/data/comparison")
        write_table(frequencies, f"{out_dir}/data/frequencies")
        write_table(cmp.category_bars(frequencies), f"{out_dir}/charts/categories")
        write_table(cmp.histograms(real, features, numeric), f"{out_dir}/charts/histograms")
        write_table(cmp.category_bars(target_freqs), f"{out_dir}/charts/target")
    return Comparison(table, frequencies, cmp.fidelity_score(table), report)

