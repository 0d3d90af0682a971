"""Profiles of tables and columns, column roles, class distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.defaults import COMPARE_ID_NAME_PARTS, ID_NAME_PARTS, ID_UNIQUENESS, MAX_CLASSES, MAX_NULL_FRACTION
from tabloom.errors import ValidationError
from tabloom.functions.columns import (
    DISTINCT_ERROR,
    approx_distinct,
    col,
    distinct_hash,
    is_infinite,
    numeric_columns,
    present,
    rows_from_one,
    to_double,
)
from tabloom.functions.local import local_table

# estimates within this share of the limit are counted exactly
NEAR_LIMIT = 6 * DISTINCT_ERROR


def role(df: DataFrame, column: str) -> str:
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return "numeric"
    return "categorical" if isinstance(kind, T.StringType) else "other"


def _per_column(df: DataFrame, columns: Sequence[str], measures) -> DataFrame:
    """One aggregate over the table, one output row per column."""
    aggs, structs = [F.count("*").alias("rows")], []
    for i, c in enumerate(columns):
        found = measures(present(df, c))
        aggs += [v.alias(f"{name}_{i}") for name, v in found.items()]
        structs.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column"),
                F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                F.lit(role(df, c)).alias("role"),
                F.col("rows"),
                *[F.col(f"{name}_{i}").alias(name) for name in found],
            )
        )
    return rows_from_one(df.agg(*aggs), structs)


def missing_profile(df: DataFrame) -> DataFrame:
    """Type, role, nulls and null fraction of every column."""
    found = _per_column(df, df.columns, lambda c: {"nulls": F.count_if(c.isNull())})
    return found.withColumn("null_fraction", F.try_divide(F.col("nulls"), F.col("rows"))).withColumn(
        "high_missing", F.coalesce(F.col("null_fraction") > MAX_NULL_FRACTION, F.lit(False))
    )


def high_missing(df: DataFrame, limit: float = MAX_NULL_FRACTION) -> DataFrame:
    return missing_profile(df).where(F.col("null_fraction") > limit)


def summary(df: DataFrame) -> DataFrame:
    """Shape, types, nulls and roles: one row per column."""
    return missing_profile(df).select("position", "column", "dtype", "role", "rows", "nulls")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("bigint"))


def numeric_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean, sample standard deviation, minimum and maximum of every numeric column."""

    def measures(c):
        v = to_double(c)
        return {"mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v)}

    return _per_column(df, columns or numeric_columns(df), measures).drop("dtype", "role")


def training_quality(df: DataFrame) -> DataFrame:
    """Nulls, infinities and constancy of every column.

    A column is constant when it has at most one distinct value besides null,
    which minimum = maximum shows without counting distinct values.
    """
    numeric = set(numeric_columns(df))
    aggs, structs = [F.count("*").alias("rows")], []
    for i, c in enumerate(df.columns):
        v = to_double(col(c)) if c in numeric else col(c)
        infinite = F.count_if(is_infinite(v)) if c in numeric else F.lit(0).cast("bigint")
        aggs += [
            F.count_if(v.isNull()).alias(f"nulls_{i}"),
            F.min(v).eqNullSafe(F.max(v)).alias(f"constant_{i}"),
            infinite.alias(f"infinite_{i}"),
        ]
        structs.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column"),
                F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                F.col("rows"),
                *[F.col(f"{m}_{i}").alias(m) for m in ("nulls", "infinite", "constant")],
            )
        )
    return rows_from_one(df.agg(*aggs), structs)


def constant_columns(df: DataFrame) -> DataFrame:
    return training_quality(df).where("constant").select("position", "column")


def is_continuous(v: Column) -> Column:
    """Aggregate: whether a column holds anything but 0, 1 and nulls."""
    return F.coalesce(F.bool_or(~v.isin(0.0, 1.0)), F.lit(False))


def continuous_profile(df: DataFrame) -> DataFrame:
    """Numeric columns holding anything but 0 and 1 are continuous."""
    return _per_column(df, numeric_columns(df), lambda c: {"continuous": is_continuous(to_double(c))}).select("position", "column", "continuous")


def continuous_columns(df: DataFrame) -> list[str]:
    if not numeric_columns(df):
        return []
    return [r["column"] for r in continuous_profile(df).orderBy("position").collect() if r["continuous"]]


def id_like_profile(
    df: DataFrame,
    name_parts: Sequence[str] = tuple(ID_NAME_PARTS),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Columns that look like identifiers, by name or by uniqueness (small local table).

    Uniqueness is screened by sketches in one pass; only columns whose estimate
    is near the limit are counted exactly, each in a pruned scan of its own.
    """
    columns = list(columns or df.columns)
    by_name = {c: any(p.lower() in c.lower() for p in name_parts) for c in columns}
    others = [c for c in columns if not by_name[c]]
    verdict = dict(by_name)
    estimates: dict[str, int] = {}
    if others:
        hashes = df.select(*[distinct_hash(present(df, c)).alias(f"h{i}") for i, c in enumerate(others)])
        aggs = [approx_distinct(F.col(f"h{i}")).alias(f"d{i}") for i in range(len(others))]
        row = hashes.agg(F.count("*").alias("rows"), *aggs).first()
        rows = max(1, row["rows"])
        near = []
        for i, c in enumerate(others):
            estimates[c] = row[f"d{i}"]
            ratio = estimates[c] / rows
            verdict[c] = ratio > ID_UNIQUENESS
            if abs(ratio / ID_UNIQUENESS - 1) <= NEAR_LIMIT:
                near.append(c)
        counts = [
            df.select(present(df, c).alias("v")).where("v is not null").distinct().agg(F.lit(c).alias("column"), F.count("*").alias("n"))
            for c in near
        ]
        if counts:
            union = counts[0]
            for other in counts[1:]:
                union = union.unionAll(other)
            verdict.update({r["column"]: r["n"] / rows > ID_UNIQUENESS for r in union.collect()})
    data = [(i, c, by_name[c], bool(verdict[c]), estimates.get(c)) for i, c in enumerate(columns)]
    schema = "position int, column string, by_name boolean, id_like boolean, distinct_estimate bigint"
    return local_table(df.sparkSession, data, schema)


def id_like_columns(df: DataFrame, name_parts: Sequence[str] = tuple(ID_NAME_PARTS)) -> list[str]:
    return [r["column"] for r in id_like_profile(df, name_parts).collect() if r["id_like"]]


def common_numeric_columns(real: DataFrame, synthetic: DataFrame, skip_id_like: bool = True) -> list[str]:
    """Numeric columns of ``real`` also found in ``synthetic``, without ID-like ones."""
    names = [c for c in numeric_columns(real) if c in synthetic.columns]
    if not skip_id_like or not names:
        return names
    found = id_like_profile(real, COMPARE_ID_NAME_PARTS, names).collect()
    return [r["column"] for r in found if not r["id_like"]]


# --- classes ---------------------------------------------------------------


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows per class, nulls left out."""
    return (
        df.select(present(df, target).alias("class"))
        .where("class is not null")
        .groupBy("class")
        .agg(F.count("*").alias("rows"))
    )


def class_analysis(df: DataFrame, target: str) -> DataFrame:
    """Minority class (smallest value on ties), min/max ratio and severity, as one row."""
    return (
        class_distribution(df, target)
        .agg(
            F.count("*").alias("classes"),
            F.sum("rows").alias("rows"),
            F.min(F.struct("rows", "class")).getField("class").alias("minority_class"),
            F.try_divide(F.min("rows"), F.max("rows")).alias("imbalance_ratio"),
        )
        .withColumn(
            "severity",
            F.when(F.col("imbalance_ratio") > 0.3, "moderate")
            .when(F.col("imbalance_ratio") > 0.1, "severe")
            .otherwise("extreme"),
        )
        .withColumn("strategy", F.lit("random_undersampling"))
    )


def class_counts(df: DataFrame, target: str) -> dict:
    """Class counts on the driver, sorted by class; too many classes or null labels are errors."""
    found = df.groupBy(present(df, target).alias("class")).agg(F.count("*").alias("rows")).limit(MAX_CLASSES + 1).collect()
    return checked_counts({r["class"]: r["rows"] for r in found}, target)


def checked_counts(counts: dict, target: str) -> dict:
    if len(counts) > MAX_CLASSES:
        raise ValidationError(f"{target} has more than {MAX_CLASSES} classes")
    if None in counts:
        raise ValidationError(f"{target} has {counts[None]} rows without a class")
    return dict(sorted(counts.items()))
