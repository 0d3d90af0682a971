"""Pearson correlation over numeric and label-coded columns, and what follows from it."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.defaults import STRONG_CORRELATION, VERY_STRONG_CORRELATION
from tabloom.functions.columns import col, numeric_columns, string_columns
from tabloom.functions.local import compiled_methods, local_table
from tabloom.operators.encoding import LabelCodes, label_codes
from tabloom.scratch import materialize

# tasks get this module's functions by value, so workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MATRIX_SCHEMA = "i int, j int, variable_1 string, variable_2 string, correlation double"
# numbers that a task keeps for one panel of rows of the matrix (6 for each cell)
PANEL_NUMBERS = 8_000_000
# groups in which the tasks' sums meet first
FAN_IN = 32
MOMENTS = ["n", "mx", "my", "xx", "yy", "xy"]
MOMENTS_SCHEMA = "i int, " + ", ".join(f"{m} array<double>" for m in MOMENTS)


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] | None = None, codes: LabelCodes | None = None
) -> DataFrame:
    """All pairs (i, j, variable_1, variable_2, correlation) as a stored table.

    Text columns are replaced by their label codes. Pairs use the rows where
    both values exist; a column that is constant or has an infinity on these rows correlates with nothing (null).

    One pass at any usual width, with nulls or without: each task multiplies blocks of values and of their presence
    (X'X, X'M, (X*X)'M, M'M), which are counts, means and centred sums of all pairs at once; these add up exactly and without cancellation in two
    levels. Above some 1100 columns the matrix is made in panels of rows, a pass for each, so what a task holds is bounded.
    """
    wanted = list(columns or [c for c in df.columns if c in set(numeric_columns(df)) | set(string_columns(df))])
    text = [c for c in wanted if c in string_columns(df)]
    spark = df.sparkSession
    df = df.select(*[col(c) for c in wanted])
    if text:
        df = (codes or label_codes(df, text)).encode(df)
    df = df.select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(wanted)])
    k = len(wanted)
    if not k:
        return local_table(spark, [], MATRIX_SCHEMA)
    height = max(1, min(k, PANEL_NUMBERS // (6 * k)))
    cells = None
    for first in range(0, k, height):
        moments = _moments(df, k, range(first, min(k, first + height)))
        cells = moments if cells is None else cells.unionByName(moments)
    names = F.array(*[F.lit(c) for c in wanted]) if k <= 1000 else F.split(F.lit("\0".join(wanted)), "\0")
    out = cells.select("i", F.posexplode(_pearson()).alias("j", "correlation"))
    out = out.select("i", "j", F.get(names, F.col("i")).alias("variable_1"), F.get(names, F.col("j")).alias("variable_2"), "correlation")
    with compiled_methods(spark):  # a wide table is often made by very many expressions
        return materialize(out.coalesce(max(1, k * k // 1_000_000)), "correlation")


def _moments(df: DataFrame, k: int, rows: range) -> DataFrame:
    """A row for each of ``rows`` with its moments with all k columns."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for values in _blocks(batches, k):
            new = block_moments(values, rows)
            held = new if held is None else merged(held, new)
        if held is not None:
            yield _moment_batch(np.arange(rows.start, rows.stop), held)

    def total(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in parts:
            for r in range(part.num_rows):
                new = np.stack([_list(part.column(m), r) for m in MOMENTS])
                held = new if held is None else merged(held, new)
        yield _moment_batch(np.array([key[0].as_py()]), held[:, None])

    parts = df.mapInArrow(local, MOMENTS_SCHEMA)
    # each task's rows first meet a few others', then all
    some = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(FAN_IN)))
    some = some.groupBy("i", "salt").applyInArrow(total, MOMENTS_SCHEMA)
    return some.groupBy("i").applyInArrow(total, MOMENTS_SCHEMA)


def _list(column: pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False)


def _moment_batch(numbers: np.ndarray, moments: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(numbers.astype(np.int32))]
    n, k = moments.shape[1:]
    columns += [pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k, dtype=np.int32)), pa.array(m.ravel())) for m in moments]
    return pa.RecordBatch.from_arrays(columns, ["i", *MOMENTS])


def _blocks(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[np.ndarray]:
    """Rows of k values as matrices of some 8 MB; missing values are NaN."""
    size = max(256, 1_000_000 // k)
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            values = np.empty((k, part.num_rows))
            for c in range(k):
                values[c] = part.column(c).to_numpy(zero_copy_only=False)
            yield values.T


def block_moments(values: np.ndarray, rows: range) -> np.ndarray:
    """(moment, row, column): pairs' counts, means of the row's and of the column's variable, and centred sums of squares and products."""
    there = ~np.isnan(values)
    infinite = np.isinf(values)
    # numbers near each column's middle value lose nothing when they are squared; a constant column becomes exact zeros
    middle = np.zeros(values.shape[1])
    usable = there & ~infinite
    for c in np.flatnonzero(usable.any(axis=0)):
        some = values[usable[:, c], c][:999]
        middle[c] = np.partition(some, len(some) // 2)[len(some) // 2]
    whole = bool(usable.all())
    x = values - middle if whole else np.where(usable, values - middle, 0.0)
    with np.errstate(invalid="ignore", over="ignore"):
        own, mask = slice(rows.start, rows.stop), there.astype(np.float64)
        if whole:  # every pair has all rows, so its sums are those of its columns
            shape, square = (len(rows), x.shape[1]), x**2
            n = np.full(shape, float(len(x)))
            sy, syy = (np.broadcast_to(np.ones(len(x)) @ v, shape) for v in (x, square))
            sx, sxx = (np.broadcast_to((np.ones(len(x)) @ v[:, own])[:, None], shape) for v in (x, square))
        else:
            n = mask[:, own].T @ mask
            sx, sxx = x[:, own].T @ mask, (x[:, own] ** 2).T @ mask
            sy, syy = mask[:, own].T @ x, mask[:, own].T @ (x**2)
        sxy = x[:, own].T @ x
        size = np.maximum(n, 1)
        xx, yy, xy = sxx - sx * sx / size, syy - sy * sy / size, sxy - sx * sy / size
        # constant on the shared rows, up to rounding
        xx, yy = np.where(xx <= 1e-12 * sxx, 0.0, xx), np.where(yy <= 1e-12 * syy, 0.0, yy)
        mx, my = sx / size + middle[own, None], sy / size + middle
    if infinite.any():  # nothing is known of pairs that have one on their rows
        odd = infinite.astype(np.float64)
        xy[(odd[:, own].T @ mask + mask[:, own].T @ odd) > 0] = np.nan
    return np.stack([n, mx, my, xx, yy, xy])


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of both parts together."""
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    with np.errstate(invalid="ignore", over="ignore"):
        dx, dy, weight = b[1] - a[1], b[2] - a[2], a[0] * share
        empty = weight == 0  # one part has no rows: its means don't count
        mx, my = (np.where(a[0] == 0, q, np.where(b[0] == 0, p, p + share * (q - p))) for p, q in ((a[1], b[1]), (a[2], b[2])))
        more = [np.where(empty, 0.0, weight * p * q) for p, q in ((dx, dx), (dy, dy), (dx, dy))]
    return np.stack([n, mx, my, a[3] + b[3] + more[0], a[4] + b[4] + more[1], a[5] + b[5] + more[2]])


def _pearson() -> Column:
    """Correlations of a row of moments with all columns; exactly 1 on the diagonal."""
    cells = F.arrays_zip(*MOMENTS)

    def one(m: Column, j: Column) -> Column:
        r = m["xy"] / (F.sqrt(m["xx"]) * F.sqrt(m["yy"]))
        known = (m["xx"] > 0) & (m["yy"] > 0) & ~F.isnan(m["xy"])
        return F.when(known, F.when(F.col("i") == j, 1.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))))

    return F.transform(cells, one)


def upper(matrix: DataFrame) -> DataFrame:
    return matrix.where("i < j")


def lower_triangle(matrix: DataFrame) -> DataFrame:
    """The cells a triangle chart shows: below the diagonal."""
    return matrix.where("i > j")


def target_correlations(matrix: DataFrame, target: str) -> DataFrame:
    """Correlation of every other variable with the target, strongest first, with its sign."""
    r = F.col("correlation")
    return (
        matrix.where((F.col("variable_2") == target) & (F.col("variable_1") != target))
        .select("i", F.col("variable_1").alias("variable"), r, F.when(r < 0, "negative").otherwise("positive").alias("sign"))
        .orderBy(F.abs(r).desc_nulls_last(), "i")
        .drop("i")
    )


def strong_pairs(matrix: DataFrame, limit: float = STRONG_CORRELATION) -> DataFrame:
    """Pairs above the limit, with key, rounded value and strength."""
    r = F.col("correlation")
    return upper(matrix).where(F.abs(r) > limit).select(
        F.concat("variable_1", F.lit("_vs_"), "variable_2").alias("pair"),
        F.round(r, 3).alias("correlation"),
        F.when(F.abs(r) > VERY_STRONG_CORRELATION, "strong").otherwise("moderate").alias("strength"),
    )


def extreme_pairs(matrix: DataFrame, k: int = 5, highest: bool = True) -> DataFrame:
    """The ``k`` strongest or weakest pairs, each list from strong to weak; undefined pairs left out."""
    size = F.abs("correlation")
    known = upper(matrix).where("correlation is not null")
    order = [size.desc(), F.col("i"), F.col("j")] if highest else [size.asc(), F.col("i").desc(), F.col("j").desc()]
    chosen = known.orderBy(*order).limit(k)
    return chosen.orderBy(size.desc(), "i", "j").select(
        F.concat("variable_1", F.lit(" - "), "variable_2").alias("variables"), F.round("correlation", 3).alias("correlation")
    )


def target_extremes(matrix: DataFrame, target: str) -> DataFrame:
    """Most positive, most negative and strongest variable for the target."""
    r = F.col("correlation")
    known = matrix.where((F.col("variable_2") == target) & (F.col("variable_1") != target) & r.isNotNull())

    def best(order: Column) -> Column:
        return F.min(F.struct(order.alias("o"), F.col("i"), F.col("variable_1").alias("variable"), r.alias("r")))

    one = known.agg(best(-r).alias("most_positive"), best(r).alias("most_negative"), best(-F.abs(r)).alias("strongest_absolute"))

    def entry(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("kind"), F.col(name)["variable"].alias("variable"), F.round(value, 3).alias("correlation"))

    return one.select(
        F.inline(
            F.array(
                entry("most_positive", F.col("most_positive")["r"]),
                entry("most_negative", F.col("most_negative")["r"]),
                entry("strongest_absolute", F.abs(F.col("strongest_absolute")["r"])),
            )
        )
    ).where("variable is not null")


def correlation_report(df: DataFrame, target: str | None = None, columns: Sequence[str] | None = None) -> dict[str, Any]:
    """Matrix, target correlations, strong pairs, patterns and small code tables as a nested report.

    Code tables of columns too large to broadcast stay on the cluster:
    ``label_codes(df).mapping(spark)`` gives them as a table.
    """
    names = [c for c in (columns or df.columns) if c in string_columns(df)]
    codes = label_codes(df, names) if names else LabelCodes({}, {}, 0)
    matrix = correlation_matrix(df, columns, codes)
    table: dict[str, dict[str, float | None]] = {}
    for r in matrix.orderBy("j", "i").collect():
        table.setdefault(r["variable_2"], {})[r["variable_1"]] = r["correlation"]
    report: dict[str, Any] = {
        "correlation_matrix": table,
        "label_encoders_mapping": {
            c: {"classes": v, "encoded_values": list(range(len(v)))} for c, v in codes.small.items()
        },
        "large_encoders": list(codes.large),
        "strong_correlations": {
            r["pair"]: {"correlation": r["correlation"], "strength": r["strength"]} for r in strong_pairs(matrix).collect()
        },
        "patterns_analysis": {
            "highest_correlations": extreme_pairs(matrix).collect(),
            "lowest_correlations": extreme_pairs(matrix, highest=False).collect(),
            "target_analysis": {},
            "variable_groups": {},
        },
    }
    if target in table:
        report["target_correlations"] = {
            r["variable"]: r["correlation"] for r in target_correlations(matrix, target).collect()
        }
        report["patterns_analysis"]["target_analysis"] = {
            r["kind"]: {"variable": r["variable"], "correlation": r["correlation"]}
            for r in target_extremes(matrix, target).collect()
        }
    return report
