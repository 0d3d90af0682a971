"""Cleaning: trim, markers, names, types, imputation, duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.defaults import DRIVER_CLASSES, MISSING_MARKERS
from tabloom.errors import ValidationError
from tabloom.functions.columns import (
    col,
    is_infinite,
    normalized_name,
    numeric_columns,
    present,
    string_columns,
    strip,
    to_double,
)
from tabloom.functions.local import local_table
from tabloom.operators.medians import class_medians, medians
from tabloom.sources.readers import infer_text_types


def strip_strings(df: DataFrame) -> DataFrame:
    names = string_columns(df)
    return df.withColumns({c: strip(col(c)) for c in names}) if names else df


def markers_to_null(df: DataFrame, markers: Sequence[str] = tuple(MISSING_MARKERS)) -> DataFrame:
    """Exact, case-sensitive markers of missing text become null; types stay."""
    names = string_columns(df)
    if not names:
        return df
    return df.withColumns({c: F.when(~col(c).isin(list(markers)), col(c)) for c in names})


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case names with runs of other characters as ``_``; clashes are an error."""
    names = [normalized_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValidationError(f"column names collide after normalization: {clashes}")
    return df.toDF(*names)


def resolve_target(df: DataFrame, target: str) -> DataFrame:
    """Rename a case variant of ``target`` to the requested spelling."""
    if target in df.columns:
        return df
    variants = [c for c in df.columns if c.lower() == target.lower()]
    return df.withColumnRenamed(variants[-1], target) if variants else df


def numeric_to_double(df: DataFrame) -> DataFrame:
    """Every numeric column as double, NaN as null."""
    names = numeric_columns(df)
    return df.withColumns({c: to_double(col(c)) for c in names}) if names else df


def null_counts(df: DataFrame) -> dict[str, int]:
    """Nulls per column, and the row count under ``None``, in one pass."""
    aggs = [F.count_if(present(df, c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    row = df.agg(F.count("*").alias("rows"), *aggs).first()
    return {None: row["rows"], **{c: row[f"n{i}"] for i, c in enumerate(df.columns)}}


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, Any]:
    """Most frequent non-null value per column, the smallest one on ties.

    Counts go through a shuffle of distinct values with partial counts, so hot
    values collapse before it; no task holds all values of a column.
    """
    found: dict[str, Any] = {}
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    for names in by_type.values():
        cells = df.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("column"), col(c).alias("value")) for c in names]))
        ).where(F.col("value").isNotNull())
        counts = cells.groupBy("column", "value").agg((-F.count("*")).alias("order"))
        best = counts.groupBy("column").agg(F.min(F.struct("order", "value")).alias("best"))
        found.update({r["column"]: r["best"]["value"] for r in best.collect()})
    return found


def fill_values(
    df: DataFrame, *, exact: bool = True, counts: dict[str, int] | None = None
) -> dict[str, Any]:
    """What imputation puts into each column that has nulls: median or mode.

    A column without any value has no entry and stays null.
    """
    counts = counts if counts is not None else null_counts(df)
    rows = counts[None]
    with_nulls = [c for c in df.columns if 0 < counts[c] < rows]
    numeric = [c for c in numeric_columns(df) if c in with_nulls]
    others = [c for c in with_nulls if c not in numeric]
    fills: dict[str, Any] = {}
    if numeric:
        fills.update(medians(df, numeric, rows=rows, exact=exact)[None])
    if others:
        fills.update(modes(df, others))
    return {c: fills[c] for c in df.columns if fills.get(c) is not None}


def fill(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    if not values:
        return df
    return df.withColumns(
        {c: F.coalesce(present(df, c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items()}
    )


def impute(df: DataFrame, *, exact: bool = True) -> DataFrame:
    """Numeric nulls by the median, all others by the mode."""
    return fill(df, fill_values(df, exact=exact))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row duplicates; nulls count as equal. Copies collapse before the shuffle."""
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows."""
    groups = df.groupBy(*[col(c) for c in df.columns]).agg((F.count("*") - 1).alias("extra"))
    return groups.agg(F.coalesce(F.sum("extra"), F.lit(0)).cast("bigint").alias("duplicates"))


@dataclass
class Cleaned:
    """A cleaned table (lazy) and what was learned on the way."""

    table: DataFrame
    fills: dict[str, Any]
    rows_before: int
    columns_before: list[str]
    nulls_before: dict[str, int] = field(default_factory=dict)

    @property
    def unfilled(self) -> list[str]:
        """Columns that hold no value at all and so stay null."""
        return [c for c, n in self.nulls_before.items() if n and n == self.rows_before]


def clean(
    df: DataFrame,
    target: str | None = None,
    *,
    markers: Sequence[str] = tuple(MISSING_MARKERS),
    recast: bool = False,
    exact: bool = True,
) -> Cleaned:
    """Trim, markers, names, target spelling, doubles, imputation, duplicates - in this order.

    A number column polluted by a marker was read as text and stays text, unless
    ``recast`` asks to type it again.
    """
    before = list(df.columns)
    step = normalize_names(markers_to_null(strip_strings(df), markers))
    if target is not None:
        step = resolve_target(step, target)
    if recast:
        step = infer_text_types(step)
    step = numeric_to_double(step)
    counts = null_counts(step)
    fills = fill_values(step, exact=exact, counts=counts)
    rows = counts.pop(None)
    return Cleaned(drop_duplicates(fill(step, fills)), fills, rows, before, counts)


def cleaning_report(
    cleaned: Cleaned, table: DataFrame | None = None, source: str = "", quality: dict[str, Any] | None = None
) -> dict[str, Any]:
    """Nested report. Pass the written table, or its quality report, to avoid computing things twice."""
    table = cleaned.table if table is None else table
    if quality is None:
        after = null_counts(table)
        rows = after.pop(None)
    else:
        rows, after = quality["shape"][0], quality["missing_values"]
    removed = cleaned.rows_before - rows
    return {
        "load_info": {
            "file": source.rstrip("/").rsplit("/", 1)[-1],
            "original_shape": [cleaned.rows_before, len(cleaned.columns_before)],
            "original_columns": cleaned.columns_before,
        },
        "duplicates": {"before": removed, "removed": removed},
        "final_info": {
            "final_shape": [rows, len(table.columns)],
            "missing_values": after,
            "data_types": dict(table.dtypes),
        },
        "fills": cleaned.fills,
        "unfilled_columns": cleaned.unfilled,
    }


def preprocess_numeric(df: DataFrame, by: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Per class: nulls by the median, then infinities by the median of what is finite."""
    names = [c for c in (columns or numeric_columns(df)) if c != by]
    aggs = []
    for i, c in enumerate(names):
        v = to_double(col(c))
        aggs += [F.count_if(v.isNull()).alias(f"null{i}"), F.count_if(is_infinite(v)).alias(f"inf{i}")]
    seen = df.agg(F.count("*").alias("rows"), *aggs).first()
    df = df.withColumns({c: to_double(col(c)) for c in names})
    nulls = [c for i, c in enumerate(names) if seen[f"null{i}"]]
    infinite = [c for i, c in enumerate(names) if seen[f"inf{i}"]]
    return fill_by_class(df, nulls, infinite, by, seen["rows"])


def fill_by_class(df: DataFrame, nulls: Sequence[str], infinite: Sequence[str], by: str | None, rows: int) -> DataFrame:
    """The filling itself, for columns known to hold nulls or infinities."""
    df = _fill_by_class(df, nulls, by, rows)
    if infinite:
        df = df.withColumns({c: F.when(~is_infinite(col(c)), col(c)) for c in infinite})
        df = _fill_by_class(df, infinite, by, rows)
    return df


def _fill_by_class(df: DataFrame, columns: Sequence[str], by: str | None, rows: int) -> DataFrame:
    if not columns:
        return df
    if by is None:
        found = medians(df, columns, rows=rows)
        return fill(df, {c: v for c, v in found[None].items() if v is not None})
    names = df.columns
    table = class_medians(df, columns, by, rows=rows)
    table = table.select(F.col("group").alias("_class"), *[F.col(f"m{i}").alias(f"_m{i}") for i in range(len(columns))])
    if table.count() <= DRIVER_CLASSES:
        table = F.broadcast(table)
    joined = df.join(table, col(by) == F.col("_class"), "left")
    filled = {c: F.coalesce(col(c), F.col(f"_m{i}")) for i, c in enumerate(columns)}
    return joined.withColumns(filled).select(*[col(c) for c in names])
