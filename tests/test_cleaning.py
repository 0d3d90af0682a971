from __future__ import annotations

import json
import math
import statistics

import pytest
from pyspark.sql import functions as F

from tabloom import ValidationError, clean, cleaning_report, read_csv, read_json, read_table, write_report, write_table
from tabloom.operators import cleaning as c
from tabloom.operators.medians import medians


def test_messy_table_types_and_names(spark, messy_path):
    raw = read_csv(spark, messy_path)
    table = c.numeric_to_double(c.normalize_names(c.markers_to_null(c.strip_strings(raw))))
    assert table.columns == ["item_id", "grade", "score_pct_", "kind", "code", "flag"]
    assert dict(table.dtypes) == {
        "item_id": "double", "grade": "string", "score_pct_": "double", "kind": "string", "code": "string", "flag": "double",
    }
    counts = c.null_counts(table)
    assert counts == {None: 12, "item_id": 0, "grade": 2, "score_pct_": 2, "kind": 1, "code": 1, "flag": 0}


def test_clean_fills_and_duplicates(cleaned):
    assert cleaned.fills == {"grade": "A", "score_pct_": 45.0, "kind": "red", "code": "7"}
    report = cleaning_report(cleaned, source="x/messy.csv")
    assert report["duplicates"] == {"before": 1, "removed": 1}
    assert report["final_info"]["final_shape"] == [11, 6]
    assert report["load_info"]["file"] == "messy.csv"
    scores = [r[0] for r in cleaned.table.orderBy("item_id").select("score_pct_").collect()]
    assert scores == [10, 45, 30, 40, 50, 60, 45, 80, 1000, 20, 35]


def test_recast_types_polluted_numbers(spark, messy_path):
    assert dict(clean(read_csv(spark, messy_path), recast=True).table.dtypes)["code"] == "double"


def test_python_white_space_is_stripped(spark):
    df = spark.createDataFrame([("\t a b  \n\x1c",)], "s string")
    assert c.strip_strings(df).first()[0] == "a b"


def test_name_collision_and_target(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(ValidationError):
        c.normalize_names(df)
    df = spark.createDataFrame([(1,)], "survived int")
    assert c.resolve_target(df, "Survived").columns == ["Survived"]
    assert c.normalize_names(spark.createDataFrame([(1,)], "`Score (pct)` int")).columns == ["score_pct_"]


def test_nan_is_missing_and_empty_column_stays(spark):
    df = spark.createDataFrame([(1.0, None, None), (float("nan"), None, "x"), (3.0, None, "x")], "a double, b string, c string")
    result = clean(df)
    assert sorted(r["a"] for r in result.table.collect()) == [1.0, 2.0, 3.0]
    assert result.unfilled == ["b"]


def test_csv_quotes_booleans_and_na(spark, tmp_path):
    path = tmp_path / "q.CSV"
    path.write_text('n,t,b,e,m\n1,"say ""hi"", x",True,,1\nnull,N/A,False,,inf\n-2.5e3,b,true,,3d\n')
    df = read_table(spark, str(path))
    assert dict(df.dtypes) == {"n": "double", "t": "string", "b": "boolean", "e": "double", "m": "string"}
    rows = df.collect()
    assert rows[0]["t"] == 'say "hi", x' and rows[1]["n"] is None and rows[1]["t"] is None and rows[2]["n"] == -2500


def test_json_layouts(spark, tmp_path):
    records = [{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]
    (tmp_path / "r.json").write_text(json.dumps(records, indent=1))
    (tmp_path / "l.jsonl").write_text("\n".join(map(json.dumps, records)))
    (tmp_path / "c.json").write_text(json.dumps({"b": {"0": "x", "1": "y"}, "a": {"0": 1, "1": 2}}))
    expected = {(1, "x"), (2, "y")}
    assert {(r.a, r.b) for r in read_table(spark, str(tmp_path / "r.json")).collect()} == expected
    assert {(r.a, r.b) for r in read_table(spark, str(tmp_path / "l.jsonl")).collect()} == expected
    wide = read_json(spark, str(tmp_path / "c.json"), orient="columns")
    assert wide.columns == ["b", "a"] and {(r.a, r.b) for r in wide.collect()} == expected
    with pytest.raises(ValidationError):
        read_table(spark, str(tmp_path / "x.xlsx"))


def test_sinks_round_trip(spark, tmp_path, cleaned):
    for fmt in ("parquet", "csv", "json"):
        path = write_table(cleaned.table, str(tmp_path / f"t.{fmt}"), fmt)
        back = read_table(spark, path, fmt, **({"orient": "lines"} if fmt == "json" else {}))
        assert back.count() == 11 and set(back.columns) == set(cleaned.table.columns)
    path = write_report(spark, {"a": (1, float("nan")), "é": {1: [True]}}, str(tmp_path / "rep"))
    text = "\n".join(r[0] for r in spark.read.text(path).collect())
    assert json.loads(text) == {"a": [1, None], "é": {"1": [True]}}


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 1001])
def test_searched_median_equals_sorting(spark, n):
    import random

    rng = random.Random(n)
    a = [rng.choice([0.0, 5.0, rng.gauss(0, 100)]) for _ in range(n)]
    b = [float(int(rng.expovariate(0.1))) for _ in range(n)]
    df = spark.createDataFrame(list(zip(a, b, [i % 3 for i in range(n)])), "a double, b double, g int")
    found = medians(df, ["a", "b"], direct_cells=0, final_values=5)[None]
    assert found["a"] == pytest.approx(statistics.median(a), abs=1e-12)
    assert found["b"] == statistics.median(b)
    by = medians(df, ["a", "b"], "g", direct_cells=0, final_values=5)
    direct = medians(df, ["a", "b"], "g")
    assert set(by) == set(direct)
    for g in by:
        assert by[g]["a"] == pytest.approx(direct[g]["a"]) and by[g]["b"] == direct[g]["b"]


def test_searched_median_with_one_hot_value(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("x"))
    values = sorted(7.0 if i % 3 == 0 else float(i) for i in range(30_000))
    assert medians(df, ["x"], direct_cells=0, final_values=100)[None]["x"] == statistics.median(values)


def test_preprocess_fills_nulls_then_infinities(spark):
    inf = math.inf
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("a", inf), ("a", 10.0), ("b", 5.0), ("b", -inf), ("b", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    out = c.preprocess_numeric(df, "k")
    got = sorted((r.k, r.x) for r in out.collect())
    # a: null -> median(1,3,10,inf)=6.5, then inf -> median(1,3,6.5,10)=4.75; b: null -> -inf, then both -> 5
    assert got == [("a", 1.0), ("a", 3.0), ("a", 4.75), ("a", 6.5), ("a", 10.0), ("b", 5.0), ("b", 5.0), ("b", 5.0)]


def test_medians_of_many_classes(spark, monkeypatch):
    """Small groups by the built-in median, large ones by search in batches; nulls, infinities and empty groups included."""
    import random

    from tabloom.operators import cleaning, medians

    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", "c", "d"]) if i % 2 else f"k{i % 90}", rng.choice([None, rng.random(), float("inf"), 0.5])) for i in range(1200)]
    rows += [("empty", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    direct = {r["group"]: r["m0"] for r in medians.class_medians(df, ["v"], "k").collect()}
    assert direct == {k: m["v"] for k, m in medians.medians(df, ["v"], "k").items()}
    filled = sorted(map(str, cleaning.preprocess_numeric(df, "k").collect()))
    monkeypatch.setattr(medians, "GROUP_ROWS", 50)
    monkeypatch.setattr(medians, "DRIVER_CLASSES", 2)
    monkeypatch.setattr(cleaning, "DRIVER_CLASSES", 2)
    found = medians.class_medians(df, ["v"], "k", direct_cells=0, final_values=20)
    assert {r["group"]: r["m0"] for r in found.collect()} == direct
    assert sorted(map(str, cleaning.preprocess_numeric(df, "k").collect())) == filled
