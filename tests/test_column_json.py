"""Column-oriented JSON over many splits against the json module."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tabloom import ValidationError, read_json
from tabloom.sources import columnar


def wanted(*files):
    rows, names = [], []
    for text in files:
        told = json.loads(text)
        names += [c for c, v in told.items() if v and c not in names]
        for label in {label for v in told.values() if v for label in v}:
            rows.append({c: v[label] for c, v in told.items() if v and label in v})
    as_text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v, separators=(",", ":"), ensure_ascii=False)
    return sorted(str(sorted((c, as_text(r[c])) for c in r if r[c] is not None)) for r in rows)


def cells(df):
    return sorted(str(sorted((c, v) for c, v in r.asDict().items() if v is not None)) for r in df.collect())


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(n)), spark.conf.set("spark.sql.files.openCostInBytes", "0"))
    for k, v in old.items():
        spark.conf.set(k, v)


TEXTS = ["plain", "a,b", 'say "x", {y}', "back\\slash\\", "", "}{,", '","', "käse 日本,語", "line\nbreak, two", ",,,", "\\,\"", "[1,2"]


@pytest.mark.parametrize("seed", range(4))
def test_equal_to_the_json_module(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    files = []
    for f in range(2):
        labels = [str(i) if seed % 2 else f"r,{i}\"" for i in range(rng.randrange(1, 60))]
        pick = lambda: rng.choice([rng.choice(TEXTS), rng.randrange(100), None, True, rng.random() > 2, {"k": [1, {"z": "a,}"}]}, []])
        table = {name: {x: pick() for x in labels if rng.random() < 0.8} for name in ("a", "b c", 'odd "n", {', "d")}
        text = json.dumps(table, ensure_ascii=bool(f), indent=[None, 1][seed // 2], separators=[(",", ":"), (", ", ": ")][seed % 2])
        (tmp_path / f"{f}.json").write_text(text, encoding="utf-8")
        files.append(text)
    small_splits(rng.choice([40, 97, 300]))
    assert cells(columnar.read_column_json(spark, str(tmp_path))) == wanted(*files)


def test_types_order_and_emptiness(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"z": {"0": 1, "1": 2.5}, "none": {}, "k": {"0": "x", "1": null}, "yes": {"0": true, "1": false}}\n')
    df = read_json(spark, str(tmp_path / "a.json"), orient="columns")
    assert df.dtypes == [("z", "double"), ("k", "string"), ("yes", "boolean")]
    assert sorted(map(tuple, df.collect())) == [(1.0, "x", True), (2.5, None, False)]
    (tmp_path / "b.json").write_text('{"a": {"0": 1, "1": "x}')
    with pytest.raises(ValidationError):
        read_json(spark, str(tmp_path / "b.json"), orient="columns")


def test_one_line_is_read_by_many_tasks(spark, tmp_path, small_splits):
    n = 40_000
    table = {"x": {str(i): i for i in range(n)}, "t": {str(i): f"text, {i}" for i in range(n)}}
    (tmp_path / "big.json").write_text(json.dumps(table))
    small_splits(64 << 10)
    text = spark.read.option("lineSep", ",").text(str(tmp_path / "big.json"))
    assert text.rdd.getNumPartitions() > 10
    df = read_json(spark, str(tmp_path / "big.json"), orient="columns")
    assert df.where(F.col("t") == F.concat(F.lit("text, "), F.col("x").cast("long"))).count() == df.count() == n
