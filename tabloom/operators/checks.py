"""Checks of tables and arguments; each raises ``ValidationError``."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom import defaults as D
from tabloom.errors import ValidationError
from tabloom.functions.columns import col, numeric_columns, present
from tabloom.operators.cleaning import duplicate_count, resolve_target
from tabloom.operators.profiling import missing_profile

BALANCING_METHODS = ["random_undersampling"]


def has_rows(df: DataFrame, rows: int = D.MIN_ROWS) -> bool:
    """Whether the table has at least ``rows`` rows and is not empty; reads no more than that."""
    needed = max(1, rows)
    return df.limit(needed).count() >= needed


def check_table(df: DataFrame, name: str = "table", rows: int = D.MIN_ROWS) -> None:
    found = df.limit(rows).count()
    if found == 0:
        raise ValidationError(f"{name} is empty")
    if found < rows:
        raise ValidationError(f"{name} has too few rows: {found} < {rows}")


def check_target(df: DataFrame, target: str) -> DataFrame:
    """Target present (a case variant is renamed) and at most half null; returns the table."""
    df = resolve_target(df, target)
    if target not in df.columns:
        raise ValidationError(f"target {target} not found among {df.columns}")
    row = df.agg(F.count("*").alias("rows"), F.count_if(present(df, target).isNull()).alias("nulls")).first()
    if row["rows"] and row["nulls"] / row["rows"] > D.MAX_NULL_FRACTION:
        raise ValidationError(f"target {target} is missing in {row['nulls']} of {row['rows']} rows")
    return df


def check_correlation(df: DataFrame) -> None:
    check_table(df, "table for correlation")
    check_table(df, "table for correlation", D.MIN_CORRELATION_ROWS)
    if len(numeric_columns(df)) < 2:
        raise ValidationError("correlation needs at least 2 numeric columns")


def check_balancing(df: DataFrame, target: str, method: str = BALANCING_METHODS[0]) -> None:
    check_table(df, "table for balancing")
    df = check_target(df, target)
    if method not in BALANCING_METHODS:
        raise ValidationError(f"unsupported balancing method: {method}")
    two = df.agg(F.min(col(target)).alias("low"), F.max(col(target)).alias("high")).first()
    if two["low"] == two["high"]:
        raise ValidationError(f"target {target} needs at least 2 classes")


def check_comparison(
    real: DataFrame,
    synthetic: DataFrame,
    max_categories: int = D.MAX_CATEGORIES,
    drift_limit: float = D.NUMERIC_DRIFT,
) -> None:
    check_table(real, "real table")
    check_table(synthetic, "synthetic table")
    _positive(max_categories=max_categories)
    _fraction(drift_limit=drift_limit)


def check_split(test_size: float, seed: int | None = None) -> None:
    _fraction(test_size=test_size)
    if seed is not None and seed < 0:
        raise ValidationError(f"seed must not be negative: {seed}")


def check_synthesis(epochs: int, batch_size: int, latent_dim: int, learning_rate: float, n: int) -> None:
    _positive(epochs=epochs, batch_size=batch_size, latent_dim=latent_dim, n=n)
    _fraction(learning_rate=learning_rate)


def check_settings(
    *,
    test_size: float = D.TEST_SIZE,
    seed: int = D.SEED,
    epochs: int = D.EPOCHS,
    batch_size: int = D.BATCH_SIZE,
    latent_dim: int = D.LATENT_DIM,
    learning_rate: float = D.LEARNING_RATE,
    n: int = D.SYNTHETIC_ROWS,
    max_categories: int = D.MAX_CATEGORIES,
    drift_limit: float = D.NUMERIC_DRIFT,
) -> None:
    """All arguments of a full run."""
    check_split(test_size, seed)
    check_synthesis(epochs, batch_size, latent_dim, learning_rate, n)
    _positive(max_categories=max_categories)
    _fraction(drift_limit=drift_limit)


def _positive(**values: float) -> None:
    for name, v in values.items():
        if v <= 0:
            raise ValidationError(f"{name} must be positive: {v}")


def _fraction(**values: float) -> None:
    for name, v in values.items():
        if not 0 < v < 1:
            raise ValidationError(f"{name} must be between 0 and 1: {v}")


def check_report(df: DataFrame, target: str) -> DataFrame:
    """The table checks as data, from one pass: (check, found, passed)."""
    one = df.agg(
        F.count("*").cast("double").alias("rows"),
        F.try_divide(F.count_if(present(df, target).isNull()), F.count("*")).alias("target_null_fraction"),
        F.min(col(target)).eqNullSafe(F.max(col(target))).alias("single_class"),
    )
    numeric = F.lit(float(len(numeric_columns(df))))

    def entry(name, found, passed):
        return F.struct(F.lit(name).alias("check"), found.alias("found"), F.coalesce(passed, F.lit(False)).alias("passed"))

    rows, nulls = F.col("rows"), F.col("target_null_fraction")
    single = F.col("single_class").cast("double")
    return one.select(
        F.inline(
            F.array(
                entry("min_rows", rows, rows >= D.MIN_ROWS),
                entry("min_correlation_rows", rows, rows >= D.MIN_CORRELATION_ROWS),
                entry("target_null_fraction", nulls, nulls <= D.MAX_NULL_FRACTION),
                entry("two_classes", single, single == 0),
                entry("two_numeric_columns", numeric, numeric >= 2),
            )
        )
    )


def quality_report(df: DataFrame, name: str = "table", duplicates: int | None = None) -> dict[str, Any]:
    """Shape, nulls, duplicates, types and roles as a nested report.

    Pass ``duplicates`` where they are known, it saves a shuffle of the table.
    """
    check_table(df, name)
    columns = missing_profile(df).orderBy("position").collect()
    return {
        "shape": [columns[0]["rows"], len(columns)],
        "missing_values": {r["column"]: r["nulls"] for r in columns},
        "missing_percentage": {r["column"]: r["null_fraction"] for r in columns},
        "duplicates": duplicate_count(df).first()[0] if duplicates is None else duplicates,
        "data_types": {r["column"]: r["dtype"] for r in columns},
        "numeric_columns": [r["column"] for r in columns if r["role"] == "numeric"],
        "categorical_columns": [r["column"] for r in columns if r["role"] == "categorical"],
        "high_missing_columns": [r["column"] for r in columns if r["high_missing"]],
    }
