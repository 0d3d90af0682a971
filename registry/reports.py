"""What checks raise, what a run leaves in its folder, and reports that were written and read back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from registry.inputs import MESSY_ORDERS, REAL, drifted_lines, real_lines, table
from registry.profiling import _sparse_orders
from registry.shaping import _PAIRS, CORRELATED
from registry.synthesis import CLASS, LINE_KEYS, SETTINGS
from tabloom import ValidationError, read_json, run, write_report
from tabloom.operators import checks
from tabloom.operators.correlation import correlation_report
from tabloom.scratch import materialize, new_path


def _error(check, *args, **options):
    try:
        check(*args, **options)
    except ValidationError as e:
        return str(e)
    return None


def check_errors(spark, sf):
    """Every check on tables that pass and on ones that don't: what it raises."""
    lines, orders, nation, region = (table(spark, sf, n) for n in ("lineitem", "orders", "nation", "region"))
    real, other = real_lines(spark, sf), drifted_lines(spark, sf)
    data = [
        ("rows", "orders", None if checks.has_rows(orders) else "too few"),
        ("rows", "region", None if checks.has_rows(region) else "too few"),
        ("table", "orders", _error(checks.check_table, orders, "orders")),
        ("table", "region", _error(checks.check_table, region, "region")),
        ("table", "empty", _error(checks.check_table, lines.where("l_quantity < 0"), "lines")),
        ("target", "orders", _error(checks.check_target, orders, "O_ORDERSTATUS")),
        ("target", "rare", _error(checks.check_target, _sparse_orders(spark, sf), "rare")),
        ("target", "region", _error(checks.check_target, region.select("r_name", "r_regionkey"), "size")),
        ("correlation", "lineitem", _error(checks.check_correlation, lines)),
        ("correlation", "nation", _error(checks.check_correlation, nation)),
        ("correlation", "one number", _error(checks.check_correlation, orders.select("o_totalprice", "o_orderstatus"))),
        ("balancing", "lineitem", _error(checks.check_balancing, lines, CLASS)),
        ("balancing", "one class", _error(checks.check_balancing, lines.where("l_returnflag = 'A'"), CLASS)),
        ("balancing", "method", _error(checks.check_balancing, lines, CLASS, "smote")),
        ("comparison", "lineitem", _error(checks.check_comparison, real, other)),
        ("comparison", "empty", _error(checks.check_comparison, real, other.where("l_quantity < 0"))),
        ("comparison", "limit", _error(checks.check_comparison, real, other, drift_limit=float(region.count()))),
        ("split", "share", _error(checks.check_split, float(region.count()))),
        ("split", "seed", _error(checks.check_split, 0.2, -region.count())),
        ("synthesis", "rows", _error(checks.check_synthesis, 1, 1, 1, 0.1, lines.where("l_quantity < 0").count())),
        ("settings", "defaults", _error(checks.check_settings, n=lines.count())),
        ("settings", "categories", _error(checks.check_settings, max_categories=-region.count())),
    ]
    return spark.createDataFrame(data, "check string, case string, error string")


def run_artefacts(spark, sf):
    """Rows of the tables and numbers of the reports that a run leaves, told by a second run that reads its stages."""
    raw = table(spark, sf, "lineitem").select(*LINE_KEYS, "l_quantity", "l_extendedprice", CLASS).dropDuplicates(LINE_KEYS)
    raw = materialize(raw, "lines")  # both runs read it several times
    out, n = new_path(spark, "run"), raw.count()
    run(spark, raw, CLASS, out, n=n, keys=LINE_KEYS, **SETTINGS)
    result = run(spark, raw, CLASS, out, n=n, keys=LINE_KEYS, **SETTINGS)
    tables = {"data/cleaned": result.cleaned, "data/train": result.train, "data/test": result.test, "data/balanced": result.balanced, "data/synthetic": result.synthetic}
    for name in ("charts/classes_before", "charts/classes_after", "charts/target", "model/models", "model/metrics"):
        tables[name] = spark.read.parquet(f"{out}/{name}")
    found = [(name, t.count()) for name, t in tables.items()]
    cleaning, classes = (json.loads(spark.read.text(f"{out}/reports/{name}", wholetext=True).first()[0]) for name in ("cleaning", "classes"))
    found.append(("cleaning rows", cleaning["final_info"]["final_shape"][0]))
    found.append(("cleaning nulls", sum(cleaning["final_info"]["missing_values"].values())))
    found.append(("removed", classes["balancing"]["samples_removed"]))
    found += [(f"before {k}", v) for k, v in classes["class_analysis"]["original_distribution"].items()]
    found += [(f"after {k}", v) for k, v in classes["balancing"]["new_distribution"].items()]
    return spark.createDataFrame(found, "artefact string, found bigint")


def correlation_report_cells(spark, sf):
    """The matrix of a report that was written as JSON, read back by Spark."""
    path = write_report(spark, correlation_report(table(spark, sf, "lineitem"), columns=CORRELATED), new_path(spark, "report"))
    cells = spark.read.text(path, wholetext=True).select(F.from_json(F.get_json_object("value", "$.correlation_matrix"), "map<string,map<string,double>>").alias("m"))
    rows = cells.select(F.explode("m").alias("variable_2", "column")).select("variable_2", F.explode("column").alias("variable_1", "r"))
    return rows.select("variable_1", "variable_2", F.round("r", 8).alias("correlation"))


def report_table_round_trip(spark, sf):
    """A report table as JSON lines, nulls included."""
    told = table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("events"), F.min(F.when(F.col("value") > 1e9, F.col("value"))).alias("huge"))
    path = write_report(spark, told, new_path(spark, "report"))
    return spark.read.schema("event_type string, events bigint, huge double").json(path)


def column_json_round_trip(spark, sf):
    """Orders as column-oriented JSON documents, each of up to 50,000 keys, read back."""
    orders = table(spark, sf, "orders").withColumn("bucket", F.expr("o_orderkey div 50000"))
    cells = lambda c: F.map_from_entries(F.collect_list(F.struct(F.col("o_orderkey").cast("string"), F.col(c)))).alias(c)
    whole = orders.groupBy("bucket").agg(*[cells(c) for c in ("o_orderkey", "o_totalprice", "o_orderpriority")])
    path = new_path(spark, "column-json")
    whole.select("bucket", F.to_json(F.struct("o_orderkey", "o_totalprice", "o_orderpriority")).alias("value")).write.partitionBy("bucket").text(path)
    return read_json(spark, path, orient="columns")


QUERIES = {
    "column_json_round_trip": column_json_round_trip,
    "check_errors": check_errors,
    "run_artefacts": run_artefacts,
    "correlation_report_cells": correlation_report_cells,
    "report_table_round_trip": report_table_round_trip,
}

_LINES = ", ".join(LINE_KEYS)
_NEGATIVE = "(select count(*) from lineitem where l_quantity < 0)"
_REGIONS = "(select count(*) from region)"

SQL = {
    "column_json_round_trip": "select cast(o_orderkey as double) as o_orderkey, o_totalprice, o_orderpriority from orders",
    "check_errors": f"""
        with {MESSY_ORDERS}, {REAL},
        rare as (select count(*) as n, count(*) - count(case when priority in ('1-URGENT', '2-HIGH') then cust end) as gone from messy),
        r as (select {_REGIONS} as n), a as (select count(distinct l_returnflag) as k from lineitem where l_returnflag = 'A'),
        k as (select count(distinct l_returnflag) as k, count(l_returnflag) / count(*) as there from lineitem)
        select 'rows' as "check", 'orders' as "case", case when (select count(*) from orders) < 10 then 'too few' end as error
        union all select 'rows', 'region', case when n < 10 then 'too few' end from r
        union all select 'table', 'orders', case when (select count(*) from orders) = 0 then 'orders is empty' end
        union all select 'table', 'region', case when n < 10 then 'region has too few rows: ' || n || ' < 10' end from r
        union all select 'table', 'empty', case when {_NEGATIVE} = 0 then 'lines is empty' end
        union all select 'target', 'orders', case when count(o_orderstatus) < count(*) / 2 then 'missing' end from orders
        union all select 'target', 'rare', case when gone > n / 2 then 'target rare is missing in ' || gone || ' of ' || n || ' rows' end from rare
        union all select 'target', 'region', 'target size not found among [' || string_agg('''' || column_name || '''', ', ' order by column_name) || ']' from (
          select unnest(['r_name', 'r_regionkey']) as column_name)
        union all select 'correlation', 'lineitem', case when (select count(*) from lineitem) < 30 then 'too few' end
        union all select 'correlation', 'nation', case when count(*) < 30 then 'table for correlation has too few rows: ' || count(*) || ' < 30' end from nation
        union all select 'correlation', 'one number', case when count(*) >= 30 then 'correlation needs at least 2 numeric columns' end from orders
        union all select 'balancing', 'lineitem', case when k < 2 or there < 0.5 then 'too few classes' end from k
        union all select 'balancing', 'one class', case when k = 1 then 'target l_returnflag needs at least 2 classes' end from a
        union all select 'balancing', 'method', case when k > 0 then 'unsupported balancing method: smote' end from k
        union all select 'comparison', 'lineitem', case when (select count(*) from re) < 10 or (select count(*) from sy) < 10 then 'too few' end
        union all select 'comparison', 'empty', case when (select count(*) from sy where l_quantity < 0) = 0 then 'synthetic table is empty' end
        union all select 'comparison', 'limit', 'drift_limit must be between 0 and 1: ' || n || '.0' from r
        union all select 'split', 'share', 'test_size must be between 0 and 1: ' || n || '.0' from r
        union all select 'split', 'seed', 'seed must not be negative: ' || -n from r
        union all select 'synthesis', 'rows', case when {_NEGATIVE} <= 0 then 'n must be positive: ' || {_NEGATIVE} end
        union all select 'settings', 'defaults', case when (select count(*) from lineitem) = 0 then 'n must be positive: 0' end
        union all select 'settings', 'categories', 'max_categories must be positive: ' || -n from r""",
    "run_artefacts": f"""
        with lines as (select distinct on ({_LINES}) {_LINES}, l_quantity, l_extendedprice, l_returnflag from lineitem),
        c as (select l_returnflag as k, count(*) as n from lines group by 1),
        t as (select sum(n) as total, ceil(0.2 * sum(n)) as test, sum(n) - ceil(0.2 * sum(n)) as train, count(*) as classes from c),
        f as (select k, n, floor(n * train / total) as base, n * train / total - floor(n * train / total) as frac, train from c cross join t),
        q as (select k, base + case when row_number() over (order by frac desc, k) <= train - sum(base) over () then 1 else 0 end as keep from f),
        m as (select min(keep) as least from q),
        named as (
          select 'data/cleaned' as artefact, total as found from t
          union all select 'data/train', train from t
          union all select 'data/test', test from t
          union all select 'data/balanced', least * classes from t cross join m
          union all select 'data/synthetic', total from t
          union all select 'charts/classes_before', classes from t
          union all select 'charts/classes_after', classes from t
          union all select 'charts/target', 2 * classes from t
          union all select 'model/models', classes from t
          union all select 'model/metrics', {SETTINGS["epochs"]} * classes from t
          union all select 'cleaning rows', total from t
          union all select 'cleaning nulls', count(*) * 3 - count(l_quantity) - count(l_extendedprice) - count(l_returnflag) from lines
          union all select 'removed', train - least * classes from t cross join m
          union all select 'before ' || k, keep from q
          union all select 'after ' || k, least from q cross join m)
        select artefact, cast(found as bigint) as found from named""",
    "correlation_report_cells": f"with {_PAIRS} select variable_1, variable_2, round(r, 8) as correlation from pairs",
    "report_table_round_trip": "select event_type, count(*) as events, min(case when value > 1e9 then value end) as huge from events group by 1",
}
