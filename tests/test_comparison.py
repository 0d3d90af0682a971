from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom import comparison_table, fidelity_score, one_hot, two_sample_tests
from tabloom.operators import comparison as c
from tabloom.operators import two_sample as t


def by_flag(cleaned):
    return cleaned.table.where("flag = 0"), cleaned.table.where("flag = 1")


def test_drift_of_cleaned_table(cleaned):
    real, syn = by_flag(cleaned)
    r = c.numeric_drift(real, syn, ["score_pct_", "flag"]).orderBy("position").collect()
    assert r[0]["real_mean"] == 155 and r[0]["synthetic_mean"] == pytest.approx(58.333333, abs=1e-6)
    assert r[0]["real_std"] == pytest.approx(341.7706, abs=1e-4) and r[0]["synthetic_std"] == pytest.approx(18.929694, abs=1e-6)
    assert r[0]["rel_mean_diff"] == pytest.approx(0.623656, abs=1e-6) and r[0]["std_rel_diff"] == pytest.approx(0.944613, abs=1e-6)
    assert r[0]["high_drift"] and r[1]["real_std"] == 1e-8


def test_golden_moments(spark):
    rows = [
        ("sibsp", 0.49297752808988765, 1.0607197670677073, 0.8640969734145759, 1.8451645173952855),
        ("fare", 31.819826264044945, 48.05910427661551, 40.67708656734228, 60.45421622150521),
        ("single", 1.0, None, 1.0, None),
    ]
    df = spark.createDataFrame(rows, "variable string, real_mean double, real_std double, synthetic_mean double, synthetic_std double")
    r = {x["variable"]: x for x in c.drift_from_moments(df).collect()}
    assert r["sibsp"]["rel_mean_diff"] == pytest.approx(0.7528120789491625) and r["sibsp"]["std_rel_diff"] == pytest.approx(0.7395400507111564)
    assert r["sibsp"]["high_drift"] and not r["fare"]["high_drift"] and not r["single"]["high_drift"]
    assert r["fare"]["rel_mean_diff"] == pytest.approx(0.278356651825032) and r["fare"]["std_rel_diff"] == pytest.approx(0.2579139193595186)


def test_golden_frequencies(spark):
    real = {"S": 0.7275280898876404, "C": 0.1952247191011236, "Q": 0.07724719101123595}
    syn = {"S": 0.8510540723800659, "C": 0.14901520311832428, "Q": 0.012214613147079945}
    df = spark.createDataFrame([("e", k, real[k], syn[k], True, True) for k in real], c.FREQUENCY_SCHEMA)
    r = c.frequency_drift(df).first()
    assert r["max_difference"] == pytest.approx(0.12352598249242552) and not r["high_drift"] and r["total_categories"] == 3


def test_frequencies_of_cleaned_table(cleaned):
    real, syn = by_flag(cleaned)
    f = {(r["category"]): (r["real_freq"], r["synthetic_freq"]) for r in c.category_frequencies(real, syn, ["kind"]).collect()}
    assert f == {"red": (0.75, 0.0), "blue": (0.25, pytest.approx(2 / 3)), "green": (0.0, pytest.approx(1 / 3))}
    d = c.categorical_drift(real, syn, ["kind"]).first()
    assert d["max_difference"] == 0.75 and d["high_drift"] and d["high_drift_categories"] == 3
    assert c.category_frequencies(real, syn, ["kind"], 2).count() == 0


def test_one_hot_side_by_metadata_and_by_prefix(spark, cleaned):
    real = cleaned.table
    dummies = one_hot(real.select("kind", "grade")).withColumn("kind_of", F.lit(9.0))
    f = c.category_frequencies(real, dummies, ["kind"])
    assert all(r["real_freq"] == pytest.approx(r["synthetic_freq"]) for r in f.collect()) and f.count() == 3
    plain = dummies.select(*[F.col(x).alias(x, metadata={}) for x in dummies.columns])
    g = {r["category"]: r["synthetic_freq"] for r in c.category_frequencies(real, plain, ["kind"]).collect()}
    assert g["of"] == 9 and len(g) == 4
    # missing values are a category of their own on the plain side
    nulls = spark.createDataFrame([(None,), ("a",)], "k string")
    assert {r["category"] for r in c.category_frequencies(nulls, nulls, ["k"]).collect()} == {"nan", "a"}


def test_soft_one_hot_only_counts_real_categories_in_the_score(spark):
    real = spark.createDataFrame([("a",)] * 10, "k string")
    syn = spark.createDataFrame([(0.9, 0.5)], "k_a double, k_b double")
    row = comparison_table(real, syn).first()
    assert row["max_difference"] == 0.5 and row["high_drift"] and not row["failed"]


def test_score_with_and_without_legacy_entries(spark):
    # five numeric columns, two of them drifted; two categorical; the target
    real = spark.createDataFrame(
        [(float(i % 3), float(i % 5), i % 2, i % 4, float(i % 7), "xy"[i % 2], "pqr"[i % 3], i % 2) for i in range(420)],
        "a double, b double, c int, d int, e double, s string, t string, y int",
    )
    syn = real.withColumn("c", F.col("c") + 5).withColumn("d", F.col("d") * 9)
    features = syn.drop("y")
    table = comparison_table(real, features, target="y", synthetic_target=real)
    assert [r["variable"] for r in table.orderBy("position").collect()] == ["a", "b", "c", "d", "e", "s", "t", "real_freq", "synthetic_freq"]
    s = fidelity_score(table).first()
    assert (s["total_variables"], s["high_drift_variables"], s["fidelity"], s["quality_level"]) == (9, 2, 77.78, "good")
    plain = comparison_table(real, features, target="y", synthetic_target=real, legacy_target_entries=False)
    assert fidelity_score(plain).first()["fidelity"] == 75.0
    q = c.quality_summary(table).first()
    assert (q["total_numeric"], q["total_categorical"], q["overall_quality"]) == (5, 2, "good")
    assert c.quality_variables(table).count() == 7
    report = c.comparison_report(table, c.category_frequencies(real, features, ["s", "t"]), c.target_frequencies(real, real, "y"))
    assert report["_metadata"]["fidelity"] == 77.78 and report["real_freq"] == {"0": 0.5, "1": 0.5}
    assert report["t"]["categories"] == ["p", "q", "r"] and report["c"]["high_drift"]


def test_empty_comparison_scores_zero(spark):
    real = spark.createDataFrame([(1,)], "x int")
    s = fidelity_score(comparison_table(real, real.select(F.lit("a").alias("z")))).first()
    assert s["fidelity"] == 0 and s["quality_level"] == "needs_work"


def test_histogram_edges_match_numpy(spark):
    rng = random.Random(3)
    edges = np.linspace(-1.1, 3.7, 31)
    a = [rng.uniform(-1.1, 3.7) for _ in range(300)] + [float(e) for e in edges] + [None]
    b = [float(e) for e in edges[3:20]] + [0.1 * i for i in range(20)]
    real, syn = spark.createDataFrame([(x,) for x in a], "x double"), spark.createDataFrame([(x,) for x in b], "x double")
    got = c.histograms(real, syn, ["x"]).orderBy("bin").collect()
    want_a = np.histogram([x for x in a if x is not None], 30, (-1.1, 3.7))
    want_b = np.histogram(b, 30, (-1.1, 3.7))[0]
    assert [round(r["real"] * len(a)) for r in got] == list(want_a[0])
    assert [round(r["synthetic"] * len(b)) for r in got] == list(want_b)
    assert [r["center"] for r in got] == pytest.approx(list((want_a[1][1:] + want_a[1][:-1]) / 2))


def test_histograms_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    real = spark.createDataFrame([(inf, None, 1), (1.0, None, 2), (nan, None, 2), (None, None, None), (4.0, None, 3)], "x double, y double, z int")
    syn = spark.createDataFrame([(2.0, None, 3), (-inf, None, 4)], "x double, y double, z int")
    got = {(r["variable"], r["bin"]): (r["real"], r["synthetic"]) for r in c.histograms(real, syn, ["x", "y", "z"], 3).collect()}
    assert got == {
        ("x", 0): (0.2, 0.0), ("x", 1): (0.0, 0.5), ("x", 2): (0.2, 0.0),
        ("z", 0): (0.2, 0.0), ("z", 1): (0.4, 0.0), ("z", 2): (0.2, 1.0),
    }
    huge = spark.createDataFrame([(-1.7e308,), (1.7e308,)], "x double")
    assert [r["real"] for r in c.histograms(huge, huge, ["x"], 3).collect()] == [0, 0, 0]


def test_histogram_goldens(spark):
    one = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,)], "x double")
    assert [r["real"] * 4 for r in c.histograms(one, one, ["x"], 3).orderBy("bin").collect()] == [1, 1, 2]
    same = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    got = c.histograms(same, same, ["x"], 3).orderBy("bin").collect()
    assert [r["real"] * 2 for r in got] == [0, 2, 0] and got[1]["center"] == 5


def test_two_sample_goldens(spark):
    a, b = (spark.createDataFrame([(float(x),) for x in v], "x double") for v in ([1, 2, 3, 4], [3, 4, 5, 6]))
    r = {x["test"]: x for x in two_sample_tests(a, b, "x").collect()}
    assert r["kolmogorov_smirnov"]["statistic"] == 0.5 and r["mann_whitney"]["statistic"] == 2.0
    assert two_sample_tests(a, b.limit(0), "x").count() == 0


def test_two_sample_against_brute_force(spark):
    rng = random.Random(5)
    a = [rng.choice([2.0, rng.gauss(0, 2)]) for _ in range(300)]
    b = [rng.choice([2.0, round(rng.gauss(0.5, 2), 1)]) for _ in range(200)]
    r = t.rank_statistics(
        spark.createDataFrame([(x,) for x in a + [None]], "x double"), spark.createDataFrame([(x,) for x in b], "y double"), "x", "y"
    ).first()
    values = sorted({*a, *b})
    ks = max(abs(sum(x <= v for x in a) / len(a) - sum(y <= v for y in b) / len(b)) for v in values)
    u = sum((x > y) + 0.5 * (x == y) for x, y in itertools.product(a, b))
    ties = sum(n**3 - n for n in ((a + b).count(v) for v in values))
    assert r["ks_statistic"] == pytest.approx(ks) and r["u_statistic"] == u and r["tie_sum"] == ties


def test_p_values():
    # limiting distribution: P(K > 1.358) is about 0.05; normal: z = 1.96
    assert t.kolmogorov_p(1.358 / math.sqrt(50), 100, 100) == pytest.approx(0.05, abs=1e-3)
    assert t.kolmogorov_p(0.0, 10, 10) == 1.0
    sd = math.sqrt(100 * 100 / 12 * 201)
    assert t.mann_whitney_p(5000 + 1.959964 * sd + 0.5, 100, 100, 0) == pytest.approx(0.05, abs=1e-4)
    assert t.mann_whitney_p(5000, 100, 100, 200**3 - 200) == 1.0


def test_bars_and_generated_validation(spark, cleaned):
    real, syn = by_flag(cleaned)
    assert {(r["class"], r["rows"]) for r in c.class_bars(cleaned.table, "flag").collect()} == {("0.0", 8), ("1.0", 3)}
    assert c.category_bars(c.category_frequencies(real, syn, ["kind"])).count() == 6
    v = c.generated_validation(real, syn.drop("code"))
    assert v["shape_comparison"] == {"original": [8, 6], "synthetic": [3, 5]}
    assert not v["column_comparison"]["columns_match"] and not v["data_types_match"]
    stats = v["numeric_stats_comparison"]["score_pct_"]
    assert stats["mean_difference"] == pytest.approx(155 - 58.3333333) and stats["original_std"] == pytest.approx(341.7706, abs=1e-4)


def test_aligned_frequencies_and_correlation_bars(spark, cleaned):
    from tabloom import correlation_matrix

    a = spark.createDataFrame([("x", 0.5), ("z", 0.5)], "c string, f double")
    b = spark.createDataFrame([("y", 1.0)], "c string, f double")
    assert [tuple(r) for r in c.align_frequencies(a, b).collect()] == [("x", 0.5, 0.0), ("y", 0.0, 1.0), ("z", 0.5, 0.0)]
    assert {r["category"]: r["proportion"] for r in c.proportions(cleaned.table, "grade").collect()} == pytest.approx({"A": 6 / 11, "B": 5 / 11}, abs=0.1)
    first = c.target_correlation_bars(correlation_matrix(cleaned.table), "flag").first()
    assert (first["variable"], first["sign"], first["label"]) == ("kind", "negative", "-0.555")
