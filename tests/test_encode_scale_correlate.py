from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom import ValidationError, correlation_matrix, correlation_report, fit_min_max, fit_standard, label_encode, one_hot, prepare_features
from tabloom.operators import correlation as cor
from tabloom.operators import sparse
from tabloom.operators import encoding
from tabloom.operators.encoding import label_codes


def test_codes_of_cleaned_table(spark, cleaned):
    codes = label_codes(cleaned.table)
    assert codes.small == {"grade": ["A", "B"], "kind": ["blue", "green", "red"], "code": ["7", "8", "9"]}
    got = {(r["column"], r["value"], r["code"]) for r in codes.mapping(spark).collect()}
    assert ("kind", "red", 2) in got and len(got) == 8
    row = label_encode(cleaned.table).orderBy("item_id").first()
    assert (row["grade"], row["kind"], row["code"]) == (0, 2, 0)


def test_large_columns_are_ranked_without_collecting(spark, monkeypatch):
    monkeypatch.setattr(encoding, "BROADCAST_VALUES", 10)
    words = [f"w{i * 7919 % 1000:03d}" for i in range(1000)] + ["é", "Z", None] + ["hot"] * 500
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id int, w string").repartition(5)
    codes = label_codes(df)
    assert not codes.small and list(codes.large) == ["w"]
    expected = {v: i for i, v in enumerate(sorted({w or "nan" for w in words}))}
    assert {r["value"]: r["code"] for r in codes.mapping(spark).collect()} == expected
    got = {r["id"]: r["w"] for r in codes.encode(df).collect()}
    assert got == {i: expected[w or "nan"] for i, w in enumerate(words)}


def test_one_hot_names_nulls_and_limits(spark):
    df = spark.createDataFrame([("b", 1, "u.v"), (None, 2, "w"), ("a", 3, "w")], "s string, n int, t string")
    out = one_hot(df)
    assert out.columns == ["n", "s_a", "s_b", "t_u.v", "t_w"]
    assert [tuple(r) for r in out.orderBy("n").collect()] == [(1, 0, 1, 1, 0), (2, 0, 0, 0, 1), (3, 1, 0, 0, 1)]
    assert out.schema["t_u.v"].metadata == {"dummy_of": "t", "dummy_value": "u.v"}
    with pytest.raises(ValidationError):
        encoding.one_hot_values(df, ["t"], 1)


def test_standard_scaling_round_trip(cleaned):
    scaler = fit_standard(cleaned.table, ["score_pct_"])
    assert scaler.mean["score_pct_"] == pytest.approx(128.636364, abs=1e-6)
    assert scaler.scale["score_pct_"] == pytest.approx(276.134774, abs=1e-6)
    back = scaler.inverse(scaler.transform(cleaned.table))
    for a, b in zip(back.orderBy("item_id").collect(), cleaned.table.orderBy("item_id").collect()):
        assert a["score_pct_"] == pytest.approx(b["score_pct_"])


def test_constant_column_scales_by_one(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r[0] for r in fit_standard(df).transform(df).collect()] == [0, 0]
    assert [r[0] for r in fit_min_max(df, ["x"]).transform(df).collect()] == [-1, -1]


def test_min_max_of_cleaned_table(cleaned):
    scaler = fit_min_max(cleaned.table, ["score_pct_"])
    got = [r["score_pct_"] for r in scaler.transform(cleaned.table).orderBy("item_id").collect()]
    want = [-1, -0.929293, -0.959596, -0.939394, -0.919192, -0.89899, -0.929293, -0.858586, 1, -0.979798, -0.949495]
    assert got == pytest.approx(want, abs=1e-6)
    by = fit_min_max(cleaned.table, ["score_pct_"], "flag")
    assert by.limits[1.0]["score_pct_"] == (45.0, 80.0)
    back = by.inverse(by.transform(cleaned.table)).orderBy("item_id").collect()
    assert [r["score_pct_"] for r in back] == pytest.approx([10, 45, 30, 40, 50, 60, 45, 80, 1000, 20, 35])


def test_correlation_of_cleaned_table(cleaned):
    m = correlation_matrix(cleaned.table)
    r = {(x["variable_1"], x["variable_2"]): x["correlation"] for x in m.collect()}
    assert r[("kind", "flag")] == pytest.approx(-0.555136, abs=1e-6)
    assert r[("grade", "code")] == pytest.approx(-0.403253, abs=1e-6)
    assert r[("score_pct_", "item_id")] == pytest.approx(0.313367, abs=1e-6)
    assert r[("flag", "flag")] == 1.0 and len(r) == 36
    assert [tuple(x) for x in cor.strong_pairs(m).collect()] == [("kind_vs_flag", -0.555, "moderate")]
    top = [x["variables"] for x in cor.extreme_pairs(m).collect()]
    assert top[:3] == ["kind - flag", "grade - code", "kind - code"]
    low = [abs(x["correlation"]) for x in cor.extreme_pairs(m, highest=False).collect()]
    assert low == sorted(low, reverse=True) and len(low) == 5
    first = cor.target_correlations(m, "flag").first()
    assert (first["variable"], first["sign"]) == ("kind", "negative")
    kinds = {x["kind"]: x["variable"] for x in cor.target_extremes(m, "flag").collect()}
    assert kinds["most_negative"] == "kind" and kinds["strongest_absolute"] == "kind"
    assert cor.lower_triangle(m).count() == 15


def test_pairwise_nulls_and_constants_match_pandas(spark, monkeypatch):
    monkeypatch.setattr(cor, "PANEL_NUMBERS", 60)  # panels of two rows
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(1e6, 1, (200, 4)), columns=list("abcd"))
    pdf["b"] += pdf["a"] * 0.5
    pdf.loc[pdf.index % 3 == 0, "b"] = np.nan
    pdf.loc[pdf.index % 5 != 0, "c"] = np.nan
    pdf["d"] = 0.1
    # constant wherever b exists
    pdf["e"] = np.where(pdf["b"].isna(), pdf["a"], 0.3)
    want = pdf.corr()
    got = correlation_matrix(spark.createDataFrame(pdf)).collect()
    for r in got:
        w = want.loc[r["variable_1"], r["variable_2"]]
        if r["correlation"] is None:
            assert np.isnan(w) or abs(w) < 1e-6 or "e" in (r["variable_1"], r["variable_2"])
        elif r["variable_1"] != r["variable_2"]:
            assert r["correlation"] == pytest.approx(w, abs=1e-9)


def test_correlation_report(cleaned):
    report = correlation_report(cleaned.table, "flag")
    assert report["label_encoders_mapping"]["kind"] == {"classes": ["blue", "green", "red"], "encoded_values": [0, 1, 2]}
    assert list(report["target_correlations"])[0] == "kind"
    assert report["patterns_analysis"]["variable_groups"] == {}
    assert report["patterns_analysis"]["target_analysis"]["most_negative"]["variable"] == "kind"


def test_feature_chain(cleaned):
    f = prepare_features(cleaned.table.withColumn("w", F.col("flag") + 2), "flag")
    assert f.dropped == ["item_id", "score_pct_"]
    assert f.columns == ["w", "grade_A", "grade_B", "kind_blue", "kind_green", "kind_red", "code_7", "code_8", "code_9"]
    assert list(f.scaler.mean) == ["w"] and f.table.columns[-1] == "flag"
    assert sum(r["w"] for r in f.table.collect()) == pytest.approx(0)


def test_wide_table_with_nulls_and_infinities(spark):
    rng = np.random.default_rng(4)
    values = rng.normal(1e5, 1, (400, 80)) * 10.0 ** rng.integers(-6, 6, 80)
    values[:, 1:] += values[:, :1]
    values[rng.random(values.shape) < 0.2] = np.nan
    values[:, 7] = 3.25
    values[values[:, 9] == values[:, 9], 11] = 0.1  # constant wherever the other is
    order = np.argsort(values[:, 0])  # parts of the table differ in size
    pdf = pd.DataFrame(values[order], columns=[f"c{i}" for i in range(80)])
    want = pdf.corr().to_numpy()
    pdf.loc[5, "c3"], pdf.loc[11, "c4"], pdf.loc[11, "c5"] = np.inf, -np.inf, np.nan
    got = {(r["i"], r["j"]): r["correlation"] for r in correlation_matrix(spark.createDataFrame(pdf).repartition(5)).collect()}
    assert len(got) == 6400
    finite = pdf.corr().to_numpy()  # of pairs without an infinity on their rows
    for (i, j), r in got.items():
        odd = any(np.isinf(pdf.iloc[x, [i, j]].astype(float)).any() and not pdf.iloc[x, [i, j]].isna().any() for x in (5, 11))
        if odd or 7 in (i, j) or {i, j} == {9, 11}:
            assert r is None
        else:
            assert r == pytest.approx(finite[i, j] if {i, j} & {4, 5} else want[i, j], abs=1e-6)


def test_moments_do_not_cancel():
    rng = np.random.default_rng(2)
    x = np.concatenate([np.zeros(500), 1e9 + rng.normal(0, 1, 500)])
    values = np.stack([x, x + rng.normal(0, 1, 1000)], axis=1)
    parts = [cor.block_moments(v, range(2)) for v in np.array_split(values, 7)]
    total = parts[0]
    for p in parts[1:]:
        total = cor.merged(total, p)
    late = cor.merged(cor.block_moments(values[500:700], range(2)), cor.block_moments(values[700:], range(2)))
    for m, v in ((total, values), (late, values[500:])):
        r = m[5, 0, 1] / np.sqrt(m[3, 0, 1] * m[4, 0, 1])
        assert r == pytest.approx(np.corrcoef(v.T)[0, 1], abs=1e-9)


def test_large_and_small_codes_agree_on_a_whole_table(spark, cleaned, monkeypatch):
    small = label_encode(cleaned.table)
    monkeypatch.setattr(encoding, "BROADCAST_VALUES", 1)
    large = label_encode(cleaned.table)
    assert small.columns == large.columns and small.dtypes == large.dtypes
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_sparse_one_hot_agrees_with_the_columns(spark, monkeypatch):
    rng = np.random.default_rng(8)
    pick = lambda v: v[int(rng.integers(len(v)))]
    rows = [(i, pick(["x", "y", None, "nan", "", "é"]), f"v{int(rng.integers(200))}" if i % 3 else "hot") for i in range(500)]
    df = spark.createDataFrame(rows, "k long, a string, b string")
    wide = one_hot(df)
    names = [c for c in wide.columns if c != "k"]
    want = {r["k"]: [i for i, n in enumerate(names) if r[n]] for r in wide.collect()}
    for limit in (20_000, 3):
        monkeypatch.setattr(sparse, "BROADCAST_VALUES", limit)
        monkeypatch.setattr(sparse, "HOT_SHARE", 10)
        hot = sparse.fit_sparse_one_hot(df)
        assert hot.size == len(names) and hot.sent["b"] == (limit > 3)
        there = hot.transform(df).cache()
        assert {r["k"]: r["one_hot"] for r in there.collect()} == want and there.count() == 500
        assert sorted(map(str, hot.inverse(there).select("k", "a", "b").collect())) == sorted(map(str, df.collect()))
        assert [f"{r['column']}_{r['value']}" for r in hot.dictionary().orderBy("index").collect()] == names


def test_sparse_one_hot_of_very_many_values(spark):
    df = spark.range(120_000).select(F.expr("concat('v', id % 100000)").alias("c"), "id")
    hot = sparse.fit_sparse_one_hot(df)
    assert hot.size == 100_000
    assert hot.inverse(hot.transform(df)).exceptAll(df.select("id", "c")).count() == 0


def test_wide_correlation_runs_in_methods_that_the_jvm_compiles(spark, monkeypatch):
    name, seen, original = "spark.sql.codegen.hugeMethodLimit", [], cor.materialize
    monkeypatch.setattr(cor, "materialize", lambda df, label: seen.append(int(spark.conf.get(name))) or original(df, label))
    before = spark.conf.get(name)
    cells = [f"case when id % {k + 3} = 1 then null when id = 7 then double('NaN') else id % {k + 2} end as w{k}" for k in range(40)]
    df = spark.range(200).selectExpr(*cells)
    got = {(r["variable_1"], r["variable_2"]): r["correlation"] for r in cor.correlation_matrix(df).collect()}
    assert seen == [8000] and spark.conf.get(name) == before
    want = df.toPandas().corr()
    assert all(got[(a, b)] == pytest.approx(want.loc[a, b]) for a in df.columns for b in df.columns)
