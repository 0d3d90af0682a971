"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

import check
from registry import all_queries, all_sql
from registry.inputs import real_lines, drifted_lines, table
from tabloom import clean, stratified_split
from tabloom.operators import comparison as c
from tabloom.operators import profiling as p

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def single_partition_inputs(text):
    """The operator below every exchange into one partition."""
    lines = [re.sub(r"^[\s:+\-*]*(\(\d+\) )?", "", x) for x in text.splitlines()]
    return [below for line, below in zip(lines, lines[1:]) if line.startswith("Exchange SinglePartition")]


def test_split_needs_no_shuffle_of_rows(spark):
    split = stratified_split(table(spark, SF, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", keys=["o_orderkey"])
    for side in (split.train, split.test):
        text = plan(side)
        assert "Exchange hashpartitioning" not in text and "Sort" not in text and "Window" not in text


def test_columns_and_filters_reach_the_scan(spark):
    text = plan(c.numeric_drift(real_lines(spark, SF), drifted_lines(spark, SF), ["l_discount"]))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all(set(x.split(":")[0] for x in s.split(",")) <= {"l_discount", "l_linestatus"} for s in schemas)
    assert "EqualTo(l_linestatus,F)" in text


def test_duplicates_collapse_before_the_shuffle(spark):
    text = plan(clean(table(spark, SF, "lineitem").select("l_quantity", "l_returnflag")).table)
    assert text.count("HashAggregate") == 2


@pytest.mark.parametrize(
    "make",
    [
        lambda df: p.missing_profile(df),
        lambda df: p.numeric_stats(df),
        lambda df: p.training_quality(df),
        lambda df: p.class_analysis(df, "l_returnflag"),
        lambda df: c.comparison_table(df, df, numeric=["l_tax"], categorical=["l_returnflag"]),
    ],
)
def test_only_partial_results_meet_in_one_task(spark, make):
    text = plan(make(table(spark, SF, "lineitem")))
    below = single_partition_inputs(text)
    assert below and all("partial_" in x for x in below)


@pytest.mark.parametrize("name", ["label_encode_text", "two_sample_statistics", "median_search", "undersample", "sample_bounds"])
def test_no_cross_joins(spark, name):
    text = plan(all_queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


SLOW = {"full_run_scorecard", "synthesize", "synthesize_whole_table", "continue_fit", "generated_validation", "fit_summary"}


@pytest.mark.parametrize("name", sorted(set(all_queries()) - SLOW))
def test_query_agrees_with_its_sql(spark, name):
    problem, rows, _ = check.compare(spark, check.connect(SF), SF, name, all_queries()[name], all_sql().get(name))
    assert problem is None and rows > 0


def test_running_totals_are_shuffled_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tabloom.operators import ranks

    monkeypatch.setattr(ranks, "RANGE_VALUES", 300)
    values = spark.range(2000).select((F.col("id") * 7919 % 2003).alias("v"), (F.col("id") % 5).alias("n"), F.lit(1).cast("long").alias("one"))
    out, totals = ranks.totals_before(values.repartition(6), "v", ["n", "one"])
    text = plan(out)
    assert "hashpartitioning" not in text and "Sort" not in text and "Window" not in text
    rows, n, one = sorted(out.collect()), 0, 0
    for r in rows:
        assert (r["n_before"], r["one_before"]) == (n, one)
        n, one = n + r["n"], one + 1
    assert totals == {"n": n, "one": 2000} and len(rows) == 2000 and out.columns == ["v", "n", "one", "n_before", "one_before"]
    none, nothing = ranks.totals_before(values.where("false"), "v", ["n"])
    assert none.count() == 0 and nothing == {"n": 0}


def test_ranges_of_long_texts_are_bounded_by_bytes(spark, monkeypatch):
    """One range held all texts, as there were fewer than RANGE_VALUES of them."""
    from pyspark.sql import functions as F

    from tabloom.operators import ranks

    ranges, original = [], ranks.local_table
    monkeypatch.setattr(ranks, "local_table", lambda s, rows, schema: ranges.append(len(rows)) or original(s, rows, schema))
    monkeypatch.setattr(ranks, "RANGE_BYTES", 20_000)
    texts = spark.range(400).select(F.concat(F.md5(F.col("id").cast("string")), F.repeat(F.lit("x"), 468)).alias("v"), F.lit(1).cast("long").alias("one"))
    out, totals = ranks.totals_before(texts, "v", ["one"])
    assert [r["one_before"] for r in sorted(out.collect())] == list(range(400)) and totals == {"one": 400}
    ordered = texts.select(F.struct(F.lit(1).alias("a"), "v").alias("v"), "one")
    assert ranks.totals_before(ordered, "v", ["one"])[1] == {"one": 400}
    assert ranges == [10, ranges[1]] and ranges[1] >= 10


def test_rows_are_hashed_once_for_all_choices(spark):
    """Each of the seven passes of a run's split and balancing made all hashes anew."""
    from tabloom import undersample
    from tabloom.operators.selection import with_hashes

    keys, target = ["o_orderkey", "o_custkey"], "o_orderstatus"
    df = table(spark, SF, "orders").select(*keys, target)
    split = stratified_split(with_hashes(df, keys), target, keys=keys, hashed=True)
    low = undersample(split.hashed_train, target, keys=keys, hashed=True).table
    plain = stratified_split(df, target, keys=keys)
    for got, want in ((split.train, plain.train), (split.test, plain.test), (low, undersample(plain.train, target, keys=keys).table)):
        assert "md5" not in plan(got) and "md5" in plan(want)
        assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    copies = df.select(target, target).toDF("a", target)  # without a key
    split, plain = stratified_split(with_hashes(copies), target, hashed=True), stratified_split(copies, target)
    assert split.hashed_train is None
    assert sorted(map(tuple, split.test.collect())) == sorted(map(tuple, plain.test.collect()))


def test_stages_of_a_run_read_hashes(spark, tmp_path, monkeypatch):
    from tabloom import run
    from tabloom.plans import full_run, stages

    made = []
    for place in (full_run, stages):
        original = place.with_hashes
        monkeypatch.setattr(place, "with_hashes", lambda *a, original=original, place=place: made.append(place.__name__) or original(*a))
    df = spark.range(120).selectExpr("id", "id % 2 as k", "cast(id * 37 % 41 as double) as x")
    run(spark, df, "k", str(tmp_path / "out"), n=20, keys=["id"], epochs=1, latent_dim=2, hidden=2, batch_size=16)
    assert made == ["tabloom.plans.full_run"]


def test_a_histogram_takes_no_cells_apart(spark):
    """Each cell became a row, which went through an aggregation by name and bin."""
    both = spark.range(500).selectExpr("cast(id * 7 % 13 as double) as a", "if(id % 5 = 0, null, cast(id as double)) as b", "cast('NaN' as double) as c")
    text = plan(c.histograms(both, both.where("b < 100"), ["a", "b", "c"]))
    assert "Generate" not in text and "MapInArrow" in text


def test_sketches_read_finished_hashes(spark):
    """Their arguments are interpreted, so hashing there took most of the time."""
    import pyspark.sql.classic.dataframe as classic

    seen, first = [], classic.DataFrame.first
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(classic.DataFrame, "first", lambda df: seen.append(plan(df)) or first(df))
        p.id_like_profile(table(spark, SF, "orders").select("o_custkey", "o_totalprice")).collect()
    sketches = re.findall(r"partial_hll_sketch_agg\(([^,]*),", seen[0])
    assert len(sketches) == 2 and all(re.fullmatch(r"h\d#\d+L", x) for x in sketches)


def test_labels_are_drawn_by_compiled_code(spark):
    from tabloom.operators import sampling as s

    counts = {"a": 5, "b": 0, "c": 90, "d": 5}
    got = s.bootstrap_from_counts(spark, counts, 400, "k", "string")
    assert "lambda" not in plan(got)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(s, "FEW_CLASSES", 0)
        want = s.bootstrap_from_counts(spark, counts, 400, "k", "string")
        assert "lambda" in plan(want)
    assert got.collect() == want.collect()


def test_lines_of_a_run_are_deduplicated_once(spark, monkeypatch):
    """Both runs and all their passes over the lines did it anew."""
    from registry import reports

    class Seen(Exception):
        pass

    def look(spark, raw, *args, **options):
        assert "Aggregate" not in plan(raw) and raw.count() == raw.dropDuplicates(reports.LINE_KEYS).count()
        raise Seen

    monkeypatch.setattr(reports, "run", look)
    with pytest.raises(Seen):
        reports.run_artefacts(spark, SF)


def test_the_sum_of_hashes_is_exact(spark):
    from pyspark.sql import functions as F

    from tabloom.functions.columns import hash_total

    extremes = [2**63 - 1, -(2**63), -1, 0, 2**32, -(2**32) - 1, 2**63 - 1]
    df = spark.createDataFrame([(x,) for x in extremes], "h bigint")
    assert hash_total(df, F.col("h")) == (7, sum(extremes))
    assert hash_total(df.where("false"), F.col("h")) == (0, None)
