from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabloom import ValidationError
from tabloom.operators import checks as k
from tabloom.operators import profiling as p


def test_missing_profile_and_summary(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, "x")], "a double, b string")
    rows = {r["column"]: r for r in p.missing_profile(df).collect()}
    assert (rows["a"]["nulls"], rows["b"]["nulls"]) == (1, 2)
    assert rows["a"]["role"] == "numeric" and rows["b"]["high_missing"] and not rows["a"]["high_missing"]
    assert [r["column"] for r in p.high_missing(df).collect()] == ["b"]
    assert p.shape(df).first().asDict() == {"rows": 3, "columns": 2}
    assert p.summary(df).count() == 2


def test_numeric_stats_and_training_quality(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, 5, "x"), (2.0, 5, "x"), (inf, 5, None)], "a double, b int, c string")
    q = {r["column"]: r for r in p.training_quality(df).collect()}
    assert q["a"]["infinite"] == 1 and q["c"]["nulls"] == 1
    assert q["b"]["constant"] and q["c"]["constant"] and not q["a"]["constant"]
    assert {r["column"] for r in p.constant_columns(df).collect()} == {"b", "c"}
    s = {r["column"]: r for r in p.numeric_stats(df.where("a < 3")).collect()}
    assert s["a"]["mean"] == 1.5 and s["a"]["std"] == pytest.approx(0.5**0.5) and s["b"]["std"] == 0
    assert p.numeric_stats(df.limit(1)).first()["std"] is None


def test_roles_on_cleaned_table(cleaned):
    assert p.id_like_columns(cleaned.table) == ["item_id", "score_pct_"]
    assert p.continuous_columns(cleaned.table) == ["item_id", "score_pct_"]
    assert p.common_numeric_columns(cleaned.table, cleaned.table.select("flag", "score_pct_")) == ["flag"]
    assert p.common_numeric_columns(cleaned.table, cleaned.table, False) == ["item_id", "score_pct_", "flag"]


def test_id_like_near_the_limit_is_exact(spark):
    # 1000 rows: 900 distinct is not above 0.9, 901 is
    df = spark.range(1000).select(F.least("id", F.lit(899)).alias("u"), F.least("id", F.lit(900)).alias("v"))
    got = {r["column"]: r["id_like"] for r in p.id_like_profile(df, []).collect()}
    assert got == {"u": False, "v": True}


def test_continuous_excludes_flags_and_empty(spark):
    df = spark.createDataFrame([(0, 0.5, None), (1, 1.0, None), (None, 0.0, None)], "f int, x double, e double")
    assert p.continuous_columns(df) == ["x"]


def test_classes(cleaned):
    rows = {r["class"]: r["rows"] for r in p.class_distribution(cleaned.table, "flag").collect()}
    assert rows == {0.0: 8, 1.0: 3}
    a = p.class_analysis(cleaned.table, "flag").first()
    assert a["minority_class"] == 1.0 and a["imbalance_ratio"] == 3 / 8 and a["severity"] == "moderate"


def test_table_checks(spark, cleaned):
    t = cleaned.table
    k.check_table(t)
    assert k.has_rows(t) and not k.has_rows(t, 12)
    for bad in (t.limit(0), t.limit(3)):
        with pytest.raises(ValidationError):
            k.check_table(bad)
    assert "FLAG" in k.check_target(t, "FLAG").columns
    with pytest.raises(ValidationError):
        k.check_target(t, "nope")
    with pytest.raises(ValidationError):
        k.check_target(t.withColumn("flag", F.when(F.col("item_id") < 4, 1)), "flag")
    with pytest.raises(ValidationError):
        k.check_correlation(t)
    k.check_correlation(t.unionAll(t).unionAll(t))
    k.check_balancing(t, "flag")
    for bad in (lambda: k.check_balancing(t, "flag", "SMOTE"), lambda: k.check_balancing(t.where("flag = 0").unionAll(t.where("flag = 0")), "flag")):
        with pytest.raises(ValidationError):
            bad()
    k.check_comparison(t, t)
    for args in ((0, 0.3), (30, 0.0), (30, 1.0)):
        with pytest.raises(ValidationError):
            k.check_comparison(t, t, *args)


def test_argument_checks():
    k.check_settings()
    for bad in ({"test_size": 0}, {"test_size": 1}, {"seed": -1}, {"epochs": 0}, {"batch_size": -1}, {"learning_rate": 1}, {"n": 0}, {"max_categories": 0}):
        with pytest.raises(ValidationError):
            k.check_settings(**bad)


def test_reports(cleaned):
    report = k.quality_report(cleaned.table)
    assert report["shape"] == [11, 6] and report["duplicates"] == 0 and report["categorical_columns"] == ["grade", "kind", "code"]
    passed = {r["check"]: r["passed"] for r in k.check_report(cleaned.table, "flag").collect()}
    assert passed == {
        "min_rows": True, "min_correlation_rows": False, "target_null_fraction": True, "two_classes": True, "two_numeric_columns": True,
    }


def test_nan_counts_as_missing(spark):
    from tabloom import impute

    nan = float("nan")
    df = spark.createDataFrame([(1.0, 1), (nan, 2), (None, 3), (4.0, 4)], "x double, i int")
    rows = {r["column"]: r["nulls"] for r in p.missing_profile(df).collect()}
    assert rows == {"x": 2, "i": 0}
    assert sorted(r["x"] for r in impute(df).collect()) == [1.0, 2.5, 2.5, 4.0]
    assert k.check_report(df, "x").where("check = 'target_null_fraction'").first()["found"] == 0.5
    assert {r["column"]: r["mean"] for r in p.numeric_stats(df).collect()} == {"x": 2.5, "i": 2.5}
