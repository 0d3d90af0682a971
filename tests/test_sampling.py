from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabloom import ValidationError, bootstrap_labels, stratified_split, undersample
from tabloom.operators import sampling as s
from tabloom.operators import selection
from tabloom.operators.sampling import balance_validation, split_quotas, validation_report
from tabloom.operators.selection import take_per_group


def table(spark, classes, parts=4):
    data = [(i, c) for c, n in classes.items() for i in range(n)]
    return spark.createDataFrame([(j, c, f"r{j}") for j, (_, c) in enumerate(data)], "id int, k string, t string").repartition(parts)


def test_golden_quotas():
    assert split_quotas({0: 549, 1: 342}) == {0: 110, 1: 69}
    with pytest.raises(ValidationError):
        split_quotas({0: 10, 1: 1})
    with pytest.raises(ValidationError):
        split_quotas({0: 2, 1: 2, 2: 2}, 0.2)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(2, 10_000), min_size=1, max_size=8), st.floats(0.05, 0.95))
def test_quotas_are_proportional(sizes, test_size):
    counts = dict(enumerate(sizes))
    total = sum(sizes)
    try:
        quota = split_quotas(counts, round(test_size, 3))
    except ValidationError:
        return
    for c, n in counts.items():
        assert 0 <= quota[c] <= n
        train_share = n * (total - sum(quota.values())) / total
        assert abs((n - quota[c]) - train_share) < 1


def test_split_is_an_exact_partition_by_hash(spark):
    df = table(spark, {"a": 549, "b": 342})
    s = stratified_split(df, "k", keys=["id"])
    train, test = s.train.collect(), s.test.collect()
    assert Counter(r.k for r in test) == {"a": 110, "b": 69} and Counter(r.k for r in train) == {"a": 439, "b": 273}
    assert s.train.columns[-1] == "k"
    assert {r.id for r in train} | {r.id for r in test} == set(range(891)) and not {r.id for r in train} & {r.id for r in test}
    rank = lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest()
    assert {r.id for r in test if r.k == "a"} == set(sorted(range(549), key=rank)[:110])


def test_split_does_not_depend_on_partitions(spark):
    sets = [{r.id for r in stratified_split(table(spark, {"a": 50, "b": 31}, p), "k").test.collect()} for p in (1, 3, 7)]
    assert sets[0] == sets[1] == sets[2]
    other = {r.id for r in stratified_split(table(spark, {"a": 50, "b": 31}), "k", seed=7).test.collect()}
    assert other != sets[0]


def test_equal_rows_without_a_key(spark):
    # two thirds of the rows are copies of two rows
    df = spark.createDataFrame([("x", "a")] * 300 + [("y", "b")] * 100 + [(f"z{i}", "a") for i in range(101)], "v string, k string")
    s = stratified_split(df, "k", 0.3)
    train, test = Counter(map(tuple, s.train.select("v", "k").collect())), Counter(map(tuple, s.test.select("v", "k").collect()))
    assert train + test == Counter(map(tuple, df.collect()))
    assert Counter(k for (_, k), n in test.items() for _ in range(n)) == s.test_counts
    for q in (1, 150, 299, 300, 301, 400, 401):
        sel = take_per_group(df.where("k = 'a'"), "k", lambda n: {"a": q})
        assert sel.chosen().count() == q and sel.others().count() == 401 - q


def test_many_copies_are_made_in_chunks(spark, monkeypatch):
    from tabloom.operators import selection

    monkeypatch.setattr(selection, "COPIES_PER_ROW", 7)
    monkeypatch.setattr(selection, "NEAR_ROWS", 5)
    df = spark.createDataFrame([("x", "a")] * 100, "v string, k string")
    sel = take_per_group(df, "k", lambda n: {"a": 31})
    assert sel.chosen().count() == 31 and sel.others().count() == 69


def test_wrong_key_and_null_class_are_errors(spark):
    df = spark.createDataFrame([(1, "a", i) for i in range(10)], "id int, k string, x int")
    with pytest.raises(ValidationError):
        take_per_group(df, "k", lambda n: {"a": 3}, ["id"])
    with pytest.raises(ValidationError):
        undersample(df.withColumn("k", F.when(F.col("x") > 3, "a")), "k")
    with pytest.raises(ValidationError):
        undersample(df, "k", "ADASYN")


def test_zero_quota(spark):
    sel = take_per_group(table(spark, {"a": 5, "b": 4}), "k", lambda n: {"a": 0, "b": 4})
    assert Counter(r.k for r in sel.chosen().collect()) == {"b": 4} and sel.others().count() == 5


def test_undersample_and_reports(spark):
    df = table(spark, {"a": 439, "b": 273})
    b = undersample(df, "k", keys=["id"])
    assert Counter(r.k for r in b.table.collect()) == {"a": 273, "b": 273}
    assert b.report() == {
        "method": "random_undersampling", "new_distribution": {"a": 273, "b": 273}, "samples_removed": 166,
        "original_samples": 712, "balanced_samples": 546,
    }
    assert {tuple(r) for r in b.report_table().collect()} == {("a", 439, 273, 166), ("b", 273, 273, 0)}
    v = balance_validation(df, b.table, "k").first()
    assert v["original_imbalance_ratio"] == pytest.approx(1.6080586080586081) and v["balanced_imbalance_ratio"] == 1 and v["is_balanced"]
    assert v.asDict() == validation_report(b.counts_before, b.counts_after)


def test_bootstrap_follows_frequencies(spark):
    df = table(spark, {"a": 900, "b": 100})
    got = bootstrap_labels(df, "k", 5000)
    counts = Counter(r.k for r in got.collect())
    assert sum(counts.values()) == 5000 and 400 < counts["b"] < 600
    again = bootstrap_labels(df.repartition(3), "k", 5000)
    assert got.exceptAll(again).count() == 0


def test_longer_prefixes_find_the_same_rows(spark, monkeypatch):
    from tabloom.operators import selection

    df = table(spark, {"a": 3000, "b": 500})
    want = {r.id for r in take_per_group(df, "k", lambda n: {"a": 777, "b": 5}, ["id"]).chosen().collect()}
    monkeypatch.setattr(selection, "PREFIX_DIGITS", 1)
    monkeypatch.setattr(selection, "NEAR_ROWS", 2)
    got = {r.id for r in take_per_group(df, "k", lambda n: {"a": 777, "b": 5}, ["id"]).chosen().collect()}
    assert got == want and len(got) == 782


def test_null_places_matter_in_whole_rows(spark):
    df = spark.createDataFrame([(None, "x", "a"), ("x", None, "a")] * 5, "u string, v string, k string")
    sel = take_per_group(df, "k", lambda n: {"a": 5})
    both = sel.chosen().unionAll(sel.others())
    assert sel.chosen().count() == 5 and both.exceptAll(df).count() == 0 and both.count() == 10


def test_stored_hashes_choose_the_same_rows_of_many_classes(spark, monkeypatch):
    df = table(spark, {c: 40 + 3 * i for i, c in enumerate("abcdef")})

    def rows(split, low):
        return [sorted(map(tuple, t.collect())) for t in (split.train, split.test, low.table)]

    plain = stratified_split(df, "k", keys=["id"])
    want = rows(plain, undersample(plain.train, "k", keys=["id"]))
    for classes in (10, 2):  # their numbers on the driver, or as tables
        monkeypatch.setattr(selection, "DRIVER_CLASSES", classes)
        split = stratified_split(selection.with_hashes(df, ["id"]), "k", keys=["id"], hashed=True)
        assert rows(split, undersample(split.hashed_train, "k", keys=["id"], hashed=True)) == want


def _sides(split):
    return sorted(map(tuple, split.train.collect())), sorted(map(tuple, split.test.collect()))


def test_many_classes_as_tables_choose_the_same_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, f"c{rng.choice([1, 2, 3, 3, 3, 4, 5, 5, 6])}" if i % 3 else "c0", rng.random()) for i in range(900)]
    df = spark.createDataFrame(rows, "k long, target string, x double")
    copies = df.select("target", (F.col("k") % 4).alias("y"))
    few = [
        _sides(s.stratified_split(df, "target", 0.3, 5, ["k"])), _sides(s.stratified_split(copies, "target", 0.25)),
        sorted(map(tuple, s.undersample(df, "target", keys=["k"]).table.collect())),
    ]
    small = s.undersample(df, "target", keys=["k"])
    labels = sorted(map(tuple, s.bootstrap_labels(df, "target", 2000).collect()))
    monkeypatch.setattr(selection, "DRIVER_CLASSES", 2)
    monkeypatch.setattr(selection, "NEAR_ROWS", 1)  # also longer prefixes
    monkeypatch.setattr(s, "FEW_CLASSES", 2)
    monkeypatch.setattr(s, "RANGE_DRAWS", 37)
    many = [
        _sides(s.stratified_split(df, "target", 0.3, 5, ["k"])), _sides(s.stratified_split(copies, "target", 0.25)),
        sorted(map(tuple, s.undersample(df, "target", keys=["k"]).table.collect())),
    ]
    assert few == many
    big = s.undersample(df, "target", keys=["k"])
    assert big.report()["samples_removed"] == small.report()["samples_removed"]
    assert sorted(map(tuple, big.report_table().collect())) == sorted(map(tuple, small.report_table().collect()))
    assert sorted(map(tuple, s.bootstrap_labels(df, "target", 2000).collect())) == labels
    with pytest.raises(ValidationError, match="do not identify"):
        s.stratified_split(df, "target", 0.3, 5, ["target"])
    with pytest.raises(ValidationError, match="without a class"):
        s.stratified_split(df.withColumn("target", F.expr("nullif(target, 'c3')")), "target", 0.3, 5, ["k"])
    with pytest.raises(ValidationError, match="fewer than 2"):
        s.stratified_split(df.unionByName(spark.createDataFrame([(9999, "lone", 0.0)], df.schema)), "target", 0.3, 5, ["k"])


def test_hundred_thousand_classes_are_split_exactly(spark):
    df = spark.range(400_000).select("id", F.expr("id % 100000").alias("target"))
    split = s.stratified_split(df, "target", 0.5, 1, ["id"])
    assert split.test.count() == 200_000
    assert split.test.groupBy("target").count().agg(F.min("count"), F.max("count"), F.count("*")).first() == (2, 2, 100_000)


def test_costly_table_of_many_classes_is_made_twice(spark, monkeypatch):
    """Once to count its classes and once to be stored; it was made by every pass, and both sides of a split joined it with their cuts."""
    from tabloom.operators import selection

    monkeypatch.setattr(selection, "DRIVER_CLASSES", 2)
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    df = spark.range(240).selectExpr("id", "id % 12 as k").mapInArrow(count, "id long, k long")
    split = s.stratified_split(df, "k", 0.25, 7, ["id"])
    assert (split.train.count(), split.test.count()) == (180, 60)
    assert split.train.join(split.test, "id").count() == 0 and made.value == 480
