"""Two-sample tests: Kolmogorov-Smirnov and Mann-Whitney, exact statistics at any size."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.columns import col, to_double
from tabloom.functions.local import local_table
from tabloom.operators.ranks import totals_before

RESULT_SCHEMA = "test string, statistic double, p_value double, significant boolean"


def rank_statistics(real: DataFrame, synthetic: DataFrame, column: str, synthetic_column: str | None = None) -> DataFrame:
    """One row: sizes, largest distance of the distribution functions, U of the first sample, tie sum.

    Equal values collapse into counts before anything is ordered, so hot values
    are no burden; the ordered pass runs over ranges of distinct values.
    """
    a = real.select(to_double(col(column)).alias("value"), F.lit(1).cast("bigint").alias("n1"), F.lit(0).cast("bigint").alias("n2"))
    b = synthetic.select(
        to_double(col(synthetic_column or column)).alias("value"), F.lit(0).cast("bigint").alias("n1"), F.lit(1).cast("bigint").alias("n2")
    )
    counts = a.unionAll(b).where("value is not null").groupBy("value").agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2"))
    ordered, sizes = totals_before(counts, "value", ["n1", "n2"])
    size1, size2 = sizes["n1"] or 0, sizes["n2"] or 0
    # twice the mid rank, so that everything stays whole
    twice_rank = "cast(2 * (n1_before + n2_before) + n1 + n2 + 1 as decimal(20, 0))"
    t = "cast(n1 + n2 as double)"
    return ordered.agg(
        F.lit(size1).cast("bigint").alias("size1"),
        F.lit(size2).cast("bigint").alias("size2"),
        F.max(
            F.abs(F.expr(f"try_divide(n1_before + n1, {size1}L) - try_divide(n2_before + n2, {size2}L)"))
        ).alias("ks_statistic"),
        F.sum(F.expr(f"cast(n1 as decimal(18, 0)) * {twice_rank}")).alias("twice_rank_sum"),
        F.sum(F.expr(f"{t} * {t} * {t} - {t}")).alias("tie_sum"),
    ).select(
        "size1",
        "size2",
        "ks_statistic",
        F.expr(
            "cast(twice_rank_sum - cast(size1 as decimal(18, 0)) * cast(size1 + 1 as decimal(18, 0)) as double) / 2"
        ).alias("u_statistic"),
        "tie_sum",
    )


def two_sample_tests(
    real: DataFrame, synthetic: DataFrame, column: str, alpha: float = 0.05, synthetic_column: str | None = None
) -> DataFrame:
    """Statistic, asymptotic two-sided p-value and verdict of both tests; nulls are left out."""
    r = rank_statistics(real, synthetic, column, synthetic_column).first()
    spark = real.sparkSession
    if r is None or not r["size1"] or not r["size2"]:
        return local_table(spark, [], RESULT_SCHEMA)
    ks_p = kolmogorov_p(r["ks_statistic"], r["size1"], r["size2"])
    mw_p = mann_whitney_p(r["u_statistic"], r["size1"], r["size2"], r["tie_sum"])
    return local_table(
        spark,
        [
            ("kolmogorov_smirnov", r["ks_statistic"], ks_p, ks_p < alpha),
            ("mann_whitney", r["u_statistic"], mw_p, mw_p < alpha),
        ],
        RESULT_SCHEMA,
    )


def kolmogorov_p(d: float, n1: int, n2: int) -> float:
    """Kolmogorov's limiting distribution at sqrt(n1 n2 / (n1 + n2)) d."""
    x = math.sqrt(n1 * n2 / (n1 + n2)) * d
    if x < 0.2:
        return 1.0
    total = sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))
    return min(1.0, max(0.0, 2 * total))


def mann_whitney_p(u: float, n1: int, n2: int, tie_sum: float) -> float:
    """Normal approximation with tie correction and continuity correction 0.5."""
    n = n1 + n2
    variance = n1 * n2 / 12 * ((n + 1) - tie_sum / (n * (n - 1)))
    if variance <= 0:
        return 1.0
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / math.sqrt(variance)
    return min(1.0, math.erfc(z / math.sqrt(2)))
