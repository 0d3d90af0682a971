"""Scaling with inverses; parameters are small and plain."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.defaults import DRIVER_CLASSES, EPSILON
from tabloom.functions.columns import col, numeric_columns, to_double
from tabloom.functions.local import local_table
from tabloom.operators.profiling import is_continuous
from tabloom.scratch import materialize


@dataclass
class StandardScaler:
    """Mean and population standard deviation per column; a zero deviation divides by 1."""

    mean: dict[str, float]
    scale: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (col(c).cast("double") - F.lit(m)) / F.lit(self.scale[c]) for c, m in self.mean.items()})

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: col(c) * F.lit(self.scale[c]) + F.lit(m) for c, m in self.mean.items()})


def fit_standard(df: DataFrame, columns: Sequence[str] | None = None) -> StandardScaler:
    """One pass. Without ``columns``, the continuous ones: numeric with a value besides 0 and 1.

    Columns without any value are left out.
    """
    names = list(columns if columns is not None else numeric_columns(df))
    if not names:
        return StandardScaler({}, {})
    aggs = []
    for i, c in enumerate(names):
        v = to_double(col(c))
        aggs += [F.avg(v).alias(f"m{i}"), F.stddev_pop(v).alias(f"s{i}"), is_continuous(v).alias(f"c{i}")]
    row = df.agg(*aggs).first()
    fitted = [(i, c) for i, c in enumerate(names) if row[f"m{i}"] is not None and (columns is not None or row[f"c{i}"])]
    return StandardScaler({c: row[f"m{i}"] for i, c in fitted}, {c: row[f"s{i}"] or 1.0 for i, c in fitted})


@dataclass
class MinMaxScaler:
    """Minimum and maximum per class and column; maps to [-1, 1] and back."""

    columns: list[str]
    by: str | None
    limits: dict[Any, dict[str, tuple[float, float]]] | DataFrame
    """class (``None`` without classes) -> column -> (min, max); beyond ``DRIVER_CLASSES`` classes a table (_class, _lo0, _hi0, _lo1, ...)"""

    def _apply(self, df: DataFrame, formula) -> DataFrame:
        if self.by is None:
            lims = self.limits[None]
            return df.withColumns(
                {c: formula(col(c).cast("double"), F.lit(lims[c][0]).cast("double"), F.lit(lims[c][1]).cast("double")) for c in self.columns}
            )
        if isinstance(self.limits, DataFrame):
            return self._scaled(df, self.limits, formula)
        fields = [T.StructField("_class", df.schema[self.by].dataType)]
        for i in range(len(self.columns)):
            fields += [T.StructField(f"_lo{i}", T.DoubleType()), T.StructField(f"_hi{i}", T.DoubleType())]
        data = [(k, *[x for c in self.columns for x in lims[c]]) for k, lims in self.limits.items()]
        # one row per class, at most DRIVER_CLASSES
        return self._scaled(df, F.broadcast(local_table(df.sparkSession, data, T.StructType(fields))), formula)

    def _scaled(self, df: DataFrame, limits: DataFrame, formula) -> DataFrame:
        names = df.columns
        joined = df.join(limits, col(self.by) == F.col("_class"), "left")
        scaled = {c: formula(col(c).cast("double"), F.col(f"_lo{i}"), F.col(f"_hi{i}")) for i, c in enumerate(self.columns)}
        return joined.withColumns(scaled).select(*[col(n) for n in names])

    def transform(self, df: DataFrame) -> DataFrame:
        """2 (x - min) / (max - min) - 1; a constant column becomes -1."""
        return self._apply(df, lambda x, lo, hi: (x - lo) * 2 / _width(lo, hi) - 1)

    def inverse(self, df: DataFrame) -> DataFrame:
        return self._apply(df, lambda x, lo, hi: (x + 1) / 2 * _width(lo, hi) + lo)


def _width(lo: Column, hi: Column) -> Column:
    return F.when(hi == lo, F.lit(EPSILON)).otherwise(hi - lo)


def fit_min_max(df: DataFrame, columns: Sequence[str], by: str | None = None) -> MinMaxScaler:
    aggs = []
    for i, c in enumerate(columns):
        v = to_double(col(c))
        aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    if by is None:
        rows = [(None, df.agg(*aggs).first())]
    else:
        by_class = df.where(col(by).isNotNull()).groupBy(col(by).alias("_class")).agg(*aggs)
        found = by_class.limit(DRIVER_CLASSES + 1).collect()
        if len(found) > DRIVER_CLASSES:
            names = [F.col(f"{side}{i}").alias(f"_{side}{i}") for i in range(len(columns)) for side in ("lo", "hi")]
            return MinMaxScaler(list(columns), by, materialize(by_class.select("_class", *names), "class-limits"))
        rows = [(r["_class"], r) for r in found]
    limits = {k: {c: (r[f"lo{i}"], r[f"hi{i}"]) for i, c in enumerate(columns)} for k, r in rows}
    return MinMaxScaler(list(columns), by, limits)
