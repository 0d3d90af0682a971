"""Two tables compared by column: drift, frequencies, histograms, score."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabloom import defaults as D
from tabloom.functions.columns import (
    approx_distinct,
    col,
    distinct_hash,
    is_infinite,
    long_values,
    numeric_columns,
    present,
    rows_from_one,
    string_columns,
    text_or_nan,
    to_double,
)
from tabloom.functions.local import local_table
from tabloom.operators.correlation import target_correlations
from tabloom.operators.profiling import common_numeric_columns

# tasks get this module's functions by value, so workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

REAL, SYNTHETIC = "real", "synthetic"
FREQUENCY_SCHEMA = "variable string, category string, real_freq double, synthetic_freq double, in_real boolean, in_synthetic boolean"


def _tagged(real: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Both tables as one, with the side in ``_side``; no keys are matched."""
    return real.withColumn("_side", F.lit(REAL)).unionAll(synthetic.withColumn("_side", F.lit(SYNTHETIC)))


# --- numeric ---------------------------------------------------------------


def numeric_drift(
    real: DataFrame, synthetic: DataFrame, columns: Sequence[str], limit: float = D.NUMERIC_DRIFT
) -> DataFrame:
    """Means, sample deviations and relative differences per column, from one pass over both tables."""
    columns = list(columns)
    both = _tagged(
        real.select(*[to_double(col(c)).alias(f"c{i}") for i, c in enumerate(columns)]),
        synthetic.select(*[to_double(col(c)).alias(f"c{i}") for i, c in enumerate(columns)]),
    )
    # each row counts for its own side only
    moments, aggs, structs = [], [], []
    for i, c in enumerate(columns):
        moments += [F.avg(f"c{i}").alias(f"mean_{i}"), F.stddev_samp(f"c{i}").alias(f"std_{i}")]
        fields = [F.lit(i).alias("position"), F.lit(c).alias("variable")]
        for side in (REAL, SYNTHETIC):
            aggs += [F.max(F.when(F.col("_side") == side, F.col(f"{m}_{i}"))).alias(f"{side}_{m}_{i}") for m in ("mean", "std")]
            fields += [F.col(f"{side}_mean_{i}").alias(f"{side}_mean"), F.col(f"{side}_std_{i}").alias(f"{side}_std")]
        structs.append(F.struct(*fields))
    if not columns:
        return local_table(
            real.sparkSession,
            [],
            "position int, variable string, real_mean double, real_std double, synthetic_mean double, "
            "synthetic_std double, rel_mean_diff double, std_rel_diff double, high_drift boolean",
        )
    return drift_from_moments(rows_from_one(both.groupBy("_side").agg(*moments).agg(*aggs), structs), limit)


def drift_from_moments(moments: DataFrame, limit: float = D.NUMERIC_DRIFT) -> DataFrame:
    """Relative differences from means and deviations; a zero deviation counts as 1e-8."""
    safe = {f"{s}_std": F.when(F.col(f"{s}_std") == 0, D.EPSILON).otherwise(F.col(f"{s}_std")) for s in (REAL, SYNTHETIC)}
    df = moments.withColumns(safe)
    mean_diff = F.abs(F.col("synthetic_mean") - F.col("real_mean")) / (F.abs("real_mean") + D.EPSILON)
    std_diff = F.abs(F.col("synthetic_std") - F.col("real_std")) / F.col("real_std")
    df = df.withColumns({"rel_mean_diff": mean_diff, "std_rel_diff": std_diff})
    high = [F.coalesce(F.col(c) > limit, F.lit(False)) for c in ("rel_mean_diff", "std_rel_diff")]
    return df.withColumn("high_drift", high[0] | high[1])


# --- categorical -----------------------------------------------------------


@dataclass
class DummySource:
    """One-hot columns standing for a text column: column name -> category."""

    columns: dict[str, str]


def dummy_source(synthetic: DataFrame, column: str) -> DummySource | None:
    """One-hot columns of ``column``: by metadata, else by the name prefix ``column_``."""
    by_metadata = {
        f.name: f.metadata["dummy_value"] for f in synthetic.schema.fields if f.metadata.get("dummy_of") == column
    }
    if by_metadata:
        return DummySource(by_metadata)
    prefix = f"{column}_"
    # a name keeps what is left once every occurrence of the prefix is gone
    by_name = {c: c.replace(prefix, "") for c in synthetic.columns if c.startswith(prefix)}
    return DummySource(by_name) if by_name else None


def category_frequencies(
    real: DataFrame,
    synthetic: DataFrame,
    columns: Sequence[str],
    max_categories: int | None = D.MAX_CATEGORIES,
) -> DataFrame:
    """Aligned proportions (variable, category, real_freq, synthetic_freq), absent = 0.

    Missing values are the category ``nan``. The synthetic side may hold one-hot
    columns instead. Variables without a counterpart, or with more than
    ``max_categories`` categories on both sides together, are left out; sketches
    keep long lists from being counted at all. ``None`` sets no limit.
    """
    columns = list(columns)
    dummies = {c: dummy_source(synthetic, c) for c in columns}
    plain = [c for c in columns if dummies[c] is None and c in synthetic.columns]
    one_hot = [c for c in columns if dummies[c] is not None]
    wanted = [c for c in columns if c in plain or c in one_hot]
    spark = real.sparkSession
    if not wanted:
        return local_table(spark, [], FREQUENCY_SCHEMA)

    n = {}
    for side, df, names in ((REAL, real, wanted), (SYNTHETIC, synthetic, plain)):
        screen = names if max_categories is not None else []
        hashes = df.select(*[distinct_hash(text_or_nan(col(c))).alias(f"h{i}") for i, c in enumerate(screen)])
        aggs = [approx_distinct(F.col(f"h{i}")).alias(f"d{i}") for i in range(len(screen))]
        row = hashes.agg(F.count("*").alias("rows"), *aggs).first()
        n[side] = row["rows"]
        if max_categories is not None:
            many = {c for i, c in enumerate(names) if row[f"d{i}"] > 1.2 * max_categories + 5}
            wanted = [c for c in wanted if c not in many]
            plain = [c for c in plain if c not in many]
    one_hot = [c for c in one_hot if c in wanted]
    if not wanted:
        return local_table(spark, [], FREQUENCY_SCHEMA)

    cells = long_values(real, wanted, [F.lit(REAL).alias("_side")], text=True)
    if plain:
        cells = cells.unionAll(long_values(synthetic, plain, [F.lit(SYNTHETIC).alias("_side")], text=True))
    real_n, syn_n = max(1, n[REAL]), max(1, n[SYNTHETIC])
    counts = cells.groupBy(F.col("column").alias("variable"), F.col("value").alias("category")).agg(
        (F.count_if(F.col("_side") == REAL) / F.lit(real_n)).alias("real_freq"),
        (F.count_if(F.col("_side") == SYNTHETIC) / F.lit(syn_n)).alias("synthetic_freq"),
        (F.count_if(F.col("_side") == REAL) > 0).alias("in_real"),
        (F.count_if(F.col("_side") == SYNTHETIC) > 0).alias("in_synthetic"),
    )
    if one_hot:
        pairs = [(c, name, category) for c in one_hot for name, category in dummies[c].columns.items()]
        means = synthetic.agg(*[F.avg(col(name)).alias(f"m{i}") for i, (_, name, _) in enumerate(pairs)])
        soft = rows_from_one(
            means,
            [
                F.struct(F.lit(c).alias("variable"), F.lit(cat).alias("category"), F.col(f"m{i}").alias("m"))
                for i, (c, _, cat) in enumerate(pairs)
            ],
        ).select(
            "variable", "category", F.lit(0.0).alias("real_freq"), F.col("m").alias("synthetic_freq"),
            F.lit(False).alias("in_real"), F.lit(True).alias("in_synthetic"),
        )
        # a category comes at most once from each side, so max() only aligns the two
        counts = counts.unionAll(soft).groupBy("variable", "category").agg(
            *[F.max(c).alias(c) for c in ("real_freq", "synthetic_freq")],
            *[F.bool_or(c).alias(c) for c in ("in_real", "in_synthetic")],
        )
    if max_categories is None:
        return counts
    # the screen above bounds the categories of a variable, and so the window
    size = F.count("*").over(W.partitionBy("variable"))
    return counts.withColumn("_size", size).where(F.col("_size") <= max_categories).drop("_size")


def frequency_drift(frequencies: DataFrame, limit: float = D.CATEGORICAL_DRIFT) -> DataFrame:
    """Largest difference, categories above the limit, ratio and flag per variable.

    ``max_real_difference`` looks only at categories of the real side, as the score does.
    """
    diff = F.abs(F.col("real_freq") - F.col("synthetic_freq"))
    return (
        frequencies.groupBy("variable")
        .agg(
            F.max(diff).alias("max_difference"),
            F.max(F.when(F.col("in_real"), diff)).alias("max_real_difference"),
            F.count_if(diff > limit).alias("high_drift_categories"),
            F.count("*").alias("total_categories"),
        )
        .withColumn("high_drift_ratio", F.try_divide("high_drift_categories", "total_categories"))
        .withColumn("high_drift", F.col("max_difference") > limit)
    )


def align_frequencies(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two tables (category, proportion) over the union of their categories, absent = 0, sorted."""
    a = left.select(F.col(left.columns[0]).alias("category"), F.col(left.columns[1]).alias("left"))
    b = right.select(F.col(right.columns[0]).alias("category"), F.col(right.columns[1]).alias("right"))
    return a.join(b, "category", "full").na.fill(0.0, ["left", "right"]).orderBy("category")


def proportions(df: DataFrame, column: str) -> DataFrame:
    """Share of every category, missing values as ``nan``."""
    rows = df.count()
    return df.groupBy(text_or_nan(col(column)).alias("category")).agg((F.count("*") / F.lit(max(1, rows))).alias("proportion"))


def categorical_drift(
    real: DataFrame,
    synthetic: DataFrame,
    columns: Sequence[str],
    limit: float = D.CATEGORICAL_DRIFT,
    max_categories: int | None = D.MAX_CATEGORIES,
) -> DataFrame:
    return frequency_drift(category_frequencies(real, synthetic, columns, max_categories), limit)


def _target_table(df: DataFrame, target: str) -> DataFrame:
    return df.select(col(target).cast("string").alias(target))


def target_frequencies(real: DataFrame, synthetic: DataFrame, target: str) -> DataFrame:
    """Aligned class proportions of two label columns of the same name."""
    return category_frequencies(_target_table(real, target), _target_table(synthetic, target), [target], None)


# --- scorecard -------------------------------------------------------------

_ENTRY = [
    "position", "variable", "type", "real_mean", "synthetic_mean", "real_std", "synthetic_std",
    "rel_mean_diff", "std_rel_diff", "total_categories", "max_difference", "high_drift", "failed",
]


def comparison_table(
    real: DataFrame,
    synthetic: DataFrame,
    *,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    target: str | None = None,
    synthetic_target: DataFrame | None = None,
    max_categories: int = D.MAX_CATEGORIES,
    skip_id_like: bool = True,
    drift_limit: float = D.NUMERIC_DRIFT,
    legacy_target_entries: bool = True,
    frequencies: DataFrame | None = None,
) -> DataFrame:
    """One row per compared variable; ``frequencies`` may pass in those of the categorical columns.

    ``failed`` is what the score counts: a numeric variable by its relative mean
    difference, a categorical one by its largest difference over real
    categories. With ``legacy_target_entries`` the two class frequency tables of
    the target count as two entries that never fail; without it the target is
    one categorical entry.
    """
    if numeric is None:
        numeric = common_numeric_columns(real, synthetic, skip_id_like)
    if categorical is None:
        categorical = string_columns(real)
    parts = []
    if numeric:
        drift = numeric_drift(real, synthetic, numeric, drift_limit)
        parts.append(
            drift.withColumns(
                {
                    "type": F.lit("numeric"),
                    "total_categories": F.lit(None).cast("bigint"),
                    "max_difference": F.lit(None).cast("double"),
                    "failed": F.coalesce(F.col("rel_mean_diff") > D.NUMERIC_DRIFT, F.lit(False)),
                }
            )
        )
    nothing = {
        c: F.lit(None).cast("double")
        for c in ("real_mean", "synthetic_mean", "real_std", "synthetic_std", "rel_mean_diff", "std_rel_diff")
    }

    def categorical_part(drift: DataFrame, names: Sequence[str], start: int) -> DataFrame:
        order = F.array(*[F.lit(c) for c in names])
        return drift.withColumns(
            {
                **nothing,
                "position": (F.array_position(order, F.col("variable")) + F.lit(start - 1)).cast("int"),
                "type": F.lit("categorical"),
                "failed": F.coalesce(F.col("max_real_difference") > D.CATEGORICAL_DRIFT, F.lit(False)),
            }
        )

    if categorical:
        if frequencies is None:
            frequencies = category_frequencies(real, synthetic, categorical, max_categories)
        parts.append(categorical_part(frequency_drift(frequencies), categorical, len(numeric)))
    if target is not None and synthetic_target is not None:
        at = len(numeric) + len(categorical)
        if legacy_target_entries:
            entries = local_table(
                real.sparkSession,
                [(at, "real_freq"), (at + 1, "synthetic_freq")], "position int, variable string"
            )
            parts.append(
                entries.withColumns(
                    {
                        **nothing,
                        "type": F.lit("target_frequencies"),
                        "total_categories": F.lit(None).cast("bigint"),
                        "max_difference": F.lit(None).cast("double"),
                        "high_drift": F.lit(False),
                        "failed": F.lit(False),
                    }
                )
            )
        else:
            drift = frequency_drift(target_frequencies(real, synthetic_target, target))
            parts.append(categorical_part(drift, [target], at))
    if not parts:
        return numeric_drift(real, synthetic, []).withColumns(
            {"type": F.lit("numeric"), "total_categories": F.lit(0).cast("bigint"), "max_difference": F.lit(0.0), "failed": F.lit(False)}
        ).select(*_ENTRY)
    table = parts[0].select(*_ENTRY)
    for p in parts[1:]:
        table = table.unionAll(p.select(*_ENTRY))
    return table


def quality_band(score: Column) -> Column:
    return (
        F.when(score >= 90, "excellent")
        .when(score >= 80, "very_good")
        .when(score >= 70, "good")
        .when(score >= 60, "acceptable")
        .otherwise("needs_work")
    )


def fidelity_score(comparison: DataFrame) -> DataFrame:
    """Entries, failed entries, share that passes in percent (0 without entries) and its band."""
    one = comparison.agg(F.count("*").alias("total_variables"), F.count_if("failed").alias("high_drift_variables"))
    passed = F.col("total_variables") - F.col("high_drift_variables")
    score = F.coalesce(F.try_divide(passed, F.col("total_variables")) * 100, F.lit(0.0))
    return one.withColumn("fidelity", F.round(score, 2)).withColumn("quality_level", quality_band(score))


def quality_summary(comparison: DataFrame) -> DataFrame:
    """The score with the number of numeric and categorical variables."""
    counts = comparison.agg(
        F.count("*").alias("total_variables"),
        F.count_if("failed").alias("high_drift_variables"),
        F.count_if(F.col("type") == "numeric").alias("total_numeric"),
        F.count_if(F.col("type") == "categorical").alias("total_categorical"),
    )
    passed = F.col("total_variables") - F.col("high_drift_variables")
    score = F.coalesce(F.try_divide(passed, F.col("total_variables")) * 100, F.lit(0.0))
    return counts.withColumn("fidelity", F.round(score, 2)).withColumn("overall_quality", quality_band(score))


def quality_variables(comparison: DataFrame) -> DataFrame:
    """What the quality report lists per variable."""
    return comparison.where(F.col("type").isin("numeric", "categorical")).select(
        "variable", "type", "rel_mean_diff", "std_rel_diff", F.col("total_categories").alias("categories_count")
    )


def comparison_report(comparison: DataFrame, frequencies: DataFrame, target_freqs: DataFrame | None = None) -> dict[str, Any]:
    """Nested report from the (small) comparison and frequency tables."""
    freqs: dict[str, tuple[dict, dict]] = {}
    for r in frequencies.orderBy("variable", "category").collect():
        real, syn = freqs.setdefault(r["variable"], ({}, {}))
        if r["in_real"]:
            real[r["category"]] = r["real_freq"]
        if r["in_synthetic"]:
            syn[r["category"]] = r["synthetic_freq"]
    report: dict[str, Any] = {}
    rows = comparison.orderBy("position").collect()
    for r in rows:
        if r["type"] == "numeric":
            names = ["type", "real_mean", "synthetic_mean", "real_std", "synthetic_std", "rel_mean_diff", "std_rel_diff", "high_drift"]
            report[r["variable"]] = {k: r[k] for k in names}
        elif r["type"] == "categorical" and r["variable"] in freqs:
            real, syn = freqs[r["variable"]]
            report[r["variable"]] = {
                "type": "categorical",
                "categories": sorted(set(real) | set(syn)),
                "real_freq": real,
                "synthetic_freq": syn,
                "max_difference": r["max_difference"],
                "high_drift": r["high_drift"],
            }
        elif r["type"] == "target_frequencies" and target_freqs is not None:
            report[r["variable"]] = {
                t["category"]: t[r["variable"]] for t in target_freqs.orderBy("category").collect()
            }
    total, failed = len(rows), sum(r["failed"] for r in rows)
    score = (total - failed) / total * 100 if total else 0.0
    report["_metadata"] = {
        "total_variables": total,
        "high_drift_variables": failed,
        "fidelity": round(score, 2),
        "quality_level": band_of(score),
    }
    return report


def band_of(score: float) -> str:
    """The band of a score already on the driver."""
    for limit, name in ((90, "excellent"), (80, "very_good"), (70, "good"), (60, "acceptable")):
        if score >= limit:
            return name
    return "needs_work"


# --- charts as tables ------------------------------------------------------


def target_correlation_bars(matrix: DataFrame, target: str) -> DataFrame:
    """Bars of the correlations with the target, strongest first: value, sign, label."""
    return target_correlations(matrix, target).withColumn("label", F.format_string("%.3f", F.col("correlation")))


def class_bars(df: DataFrame, target: str) -> DataFrame:
    """Counts per class, missing ones left out."""
    return df.where(col(target).isNotNull()).groupBy(col(target).cast("string").alias("class")).agg(F.count("*").alias("rows"))


def category_bars(frequencies: DataFrame) -> DataFrame:
    """Aligned proportions as (variable, category, side, proportion)."""
    return frequencies.select(
        "variable",
        "category",
        F.inline(
            F.array(
                F.struct(F.lit(REAL).alias("side"), F.col("real_freq").alias("proportion")),
                F.struct(F.lit(SYNTHETIC).alias("side"), F.col("synthetic_freq").alias("proportion")),
            )
        ),
    )


def histograms(
    real: DataFrame, synthetic: DataFrame, columns: Sequence[str], bins: int = D.HISTOGRAM_BINS
) -> DataFrame:
    """Proportions in equal bins over the common range: (variable, bin, center, real, synthetic).

    The last bin is closed, missing values count in the denominator, a range of
    one value is widened by 0.5 on both sides. Bin numbers follow the bin edges
    exactly: a value within rounding of an edge is placed by comparing with it.
    """
    columns = list(columns)
    both = _tagged(
        real.select(*[to_double(col(c)).alias(f"c{i}") for i, c in enumerate(columns)]),
        synthetic.select(*[to_double(col(c)).alias(f"c{i}") for i, c in enumerate(columns)]),
    )
    aggs = [F.count_if(F.col("_side") == s).alias(s) for s in (REAL, SYNTHETIC)]
    for i in range(len(columns)):
        v = F.col(f"c{i}")
        finite = F.when(~is_infinite(v), v)
        aggs += [F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}")]
    seen = both.agg(*aggs).first()
    ranges, grid = {}, []
    for i, c in enumerate(columns):
        lo, hi = seen[f"lo{i}"], seen[f"hi{i}"]
        if lo is None:
            continue
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        ranges[i] = (lo, hi)
        step = (hi - lo) / bins
        edges = [lo + b * step for b in range(bins)] + [hi]
        grid += [(c, b, (edges[b] + edges[b + 1]) / 2) for b in range(bins)]
    table = local_table(real.sparkSession, grid, "variable string, bin int, center double")
    if not ranges:
        return table.withColumns({REAL: F.lit(0.0), SYNTHETIC: F.lit(0.0)})
    names = F.array(*[F.lit(c) for c in columns])
    parts = [df.select(F.lit(s == REAL).alias("_side"), *[col(columns[i]).cast("double").alias(f"c{i}") for i in ranges]) for s, df in ((REAL, real), (SYNTHETIC, synthetic))]
    cells = parts[0].unionAll(parts[1])
    counts = (
        cells.mapInArrow(_bin_counter(ranges, bins), "i int, bin int, real bigint, synthetic bigint")
        .groupBy(F.get(names, F.col("i")).alias("variable"), "bin")
        .agg(*[F.sum(s).alias(f"_{s}") for s in (REAL, SYNTHETIC)])
    )
    # both sides hold columns x bins rows
    return table.join(counts, ["variable", "bin"], "left").select(
        "variable",
        "bin",
        "center",
        *[(F.coalesce(F.col(f"_{s}"), F.lit(0)) / F.lit(max(1, seen[s]))).alias(s) for s in (REAL, SYNTHETIC)],
    )


def _bin_counter(ranges: dict[int, tuple[float, float]], bins: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts a task's values in the bins of their columns, for each side; columns x bins numbers are all it holds and tells."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, len(ranges), bins), np.int64)
        for batch in batches:
            side = batch.column(0).to_numpy(zero_copy_only=False)
            for k, (lo, hi) in enumerate(ranges.values()):
                values = batch.column(k + 1).to_numpy(zero_copy_only=False)
                for s, own in enumerate((side, ~side)):
                    if own.any():
                        found[s, k] += bin_counts(values if own.all() else values[own], lo, hi, bins)
        k, b = np.nonzero(found.any(axis=0))
        numbers = np.array(list(ranges))[k]
        columns = [pa.array(numbers.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(found[0, k, b]), pa.array(found[1, k, b])]
        yield pa.RecordBatch.from_arrays(columns, ["i", "bin", REAL, SYNTHETIC])

    return count


def bin_counts(values: np.ndarray, lo: float, hi: float, bins: int) -> np.ndarray:
    """Values in each of ``bins`` equal bins from ``lo`` to ``hi``; missing ones (NaN) and those outside are in none."""
    step = (hi - lo) / bins
    if not 0 < step < np.inf:  # doubles don't tell such bins apart
        return np.zeros(bins, np.int64)
    v = values[(values >= lo) & (values <= hi)]
    guess = np.minimum(np.floor((v - lo) / step), bins - 1)
    # the edge rule decides where rounding of the division is off by one
    low = v < lo + guess * step
    high = ~low & (guess < bins - 1) & (v >= lo + (guess + 1) * step)
    return np.bincount((guess - low + high).astype(np.int64), minlength=bins)


# --- generated data --------------------------------------------------------


def generated_validation(original: DataFrame, synthetic: DataFrame) -> dict[str, Any]:
    """Shapes, columns, types, nulls and basic statistics of two tables as a nested report."""
    shapes, nulls = {}, {}
    for name, df in (("original", original), ("synthetic", synthetic)):
        row = df.agg(F.count("*").alias("rows"), *[F.count_if(present(df, c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
        shapes[name] = [row["rows"], len(df.columns)]
        nulls[name] = sum(row[f"n{i}"] for i in range(len(df.columns)))
    return {
        "shape_comparison": shapes,
        "column_comparison": {
            "original_columns": original.columns,
            "synthetic_columns": synthetic.columns,
            "columns_match": original.columns == synthetic.columns,
        },
        "data_types_match": original.dtypes == synthetic.dtypes,
        "missing_values": nulls,
        "numeric_stats_comparison": {
            r["variable"]: {k: r[k] for k in ("original_mean", "synthetic_mean", "original_std", "synthetic_std", "mean_difference")}
            for r in generated_statistics(original, synthetic).collect()
        },
    }


def generated_statistics(original: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Per common numeric column: both means and deviations, and the mean difference."""
    names = [c for c in numeric_columns(original) if c in synthetic.columns]
    both = _tagged(
        original.select(*[to_double(col(c)).alias(f"c{i}") for i, c in enumerate(names)]),
        synthetic.select(*[to_double(col(c)).alias(f"c{i}") for i, c in enumerate(names)]),
    )
    if not names:
        return local_table(
            original.sparkSession,
            [], "variable string, original_mean double, synthetic_mean double, original_std double, synthetic_std double, mean_difference double"
        )
    aggs, structs = [], []
    for i, c in enumerate(names):
        fields = [F.lit(c).alias("variable")]
        for measure, fn in (("mean", F.avg), ("std", F.stddev_samp)):
            for side, tag in (("original", REAL), ("synthetic", SYNTHETIC)):
                aggs.append(fn(F.when(F.col("_side") == tag, F.col(f"c{i}"))).alias(f"{side}_{measure}_{i}"))
                fields.append(F.col(f"{side}_{measure}_{i}").alias(f"{side}_{measure}"))
        structs.append(F.struct(*fields))
    return rows_from_one(both.agg(*aggs), structs).withColumn(
        "mean_difference", F.abs(F.col("original_mean") - F.col("synthetic_mean"))
    )
