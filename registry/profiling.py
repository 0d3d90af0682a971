from __future__ import annotations

from pyspark.sql import functions as F

from registry.inputs import LABELLED, MESSY_NUMBERS, MESSY_ORDERS, labelled_documents, messy_numbers, messy_orders, table
from tabloom.operators import checks
from tabloom.operators import cleaning as c
from tabloom.operators import profiling as p


def _typed_orders(spark, sf):
    return c.numeric_to_double(c.normalize_names(c.markers_to_null(c.strip_strings(messy_orders(spark, sf)))))


def _sparse_orders(spark, sf):
    """A column kept for two of five priorities only: more than half of it is missing."""
    return _typed_orders(spark, sf).withColumn(
        "rare", F.expr("case when priority in ('1-URGENT', '2-HIGH') then cust end")
    )


def missing(spark, sf):
    return p.missing_profile(_sparse_orders(spark, sf)).withColumn("null_fraction", F.round("null_fraction", 9))


def stats(spark, sf):
    return p.numeric_stats(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]).select(
        "column", "rows", *[F.round(m, 4).alias(m) for m in ("mean", "std", "min", "max")]
    )


def _with_constant(spark, sf):
    return messy_numbers(spark, sf).select("l_linestatus", "price", "quantity", F.lit(7).alias("one"))


def training_quality(spark, sf):
    return p.training_quality(_with_constant(spark, sf)).select("column", "rows", "nulls", "infinite", "constant")


def _roles_input(spark, sf):
    return table(spark, sf, "orders").withColumn("urgent", F.expr("int(o_orderpriority = '1-URGENT')"))


def id_like(spark, sf):
    return p.id_like_profile(_roles_input(spark, sf), ["custkey"]).select("column", "by_name", "id_like")


def common_numeric(spark, sf):
    real, other = _roles_input(spark, sf), _roles_input(spark, sf).drop("urgent")
    names = p.common_numeric_columns(real, other)
    return spark.createDataFrame([(n,) for n in names], "column string")


def table_quality(spark, sf):
    """Shape, nulls, copies and roles of a table with copies, from the nested report."""
    df = table(spark, sf, "lineitem").selectExpr(
        "l_quantity", "l_discount", "case when l_tax > 0.06 then null else l_tax end as l_tax", "l_returnflag"
    )
    r = checks.quality_report(df)
    data = [(*r["shape"], r["duplicates"], r["missing_values"]["l_tax"], len(r["numeric_columns"]), len(r["categorical_columns"]))]
    return spark.createDataFrame(
        data, "rows bigint, columns bigint, duplicates bigint, nulls bigint, numeric_columns bigint, categorical_columns bigint"
    )


QUERIES = {
    "table_quality": table_quality,
    "missing_profile": missing,
    "high_missing": lambda spark, sf: p.high_missing(_sparse_orders(spark, sf)).select("column", "nulls", "rows"),
    "table_summary": lambda spark, sf: p.summary(_typed_orders(spark, sf)),
    "table_shape": lambda spark, sf: p.shape(table(spark, sf, "lineitem")),
    "numeric_stats": stats,
    "training_quality": training_quality,
    "constant_columns": lambda spark, sf: p.constant_columns(_with_constant(spark, sf)).select("column"),
    "id_like_columns": id_like,
    "continuous_columns": lambda spark, sf: p.continuous_profile(_roles_input(spark, sf)).select("column", "continuous"),
    "common_numeric_columns": common_numeric,
    "class_distribution": lambda spark, sf: p.class_distribution(labelled_documents(spark, sf), "quality"),
    "class_analysis": lambda spark, sf: p.class_analysis(labelled_documents(spark, sf), "quality").withColumn(
        "imbalance_ratio", F.round("imbalance_ratio", 9)
    ),
    "table_checks": lambda spark, sf: checks.check_report(_sparse_orders(spark, sf), "rare").withColumn("found", F.round("found", 9)),
}


def _profile_row(i, name, dtype, role, rows="messy"):
    return (
        f"select {i} as position, '{name}' as \"column\", '{dtype}' as dtype, '{role}' as role, "
        f"count(*) as rows, count(*) - count({name}) as nulls from {rows}"
    )


_COLUMNS = [
    ("order_key", "double", "numeric"), ("total_price_", "double", "numeric"), ("cust", "double", "numeric"),
    ("status", "string", "categorical"), ("priority", "string", "categorical"), ("rare", "double", "numeric"),
]
_SPARSE = f"{MESSY_ORDERS}, sparse as (select *, case when priority in ('1-URGENT', '2-HIGH') then cust end as rare from messy)"
_PROFILE = " union all ".join(_profile_row(i, *c, "sparse") for i, c in enumerate(_COLUMNS))
_STATS = " union all ".join(
    f"select '{c}' as \"column\", count(*) as rows, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, "
    f"round(cast(min({c}) as double), 4) as min, round(cast(max({c}) as double), 4) as max from lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")
)
_QUALITY = " union all ".join(
    f"select '{c}' as \"column\", count(*) as rows, count(*) - count({c}) as nulls, {inf} as infinite, count(distinct {c}) <= 1 as constant from m"
    for c, inf in (
        ("l_linestatus", "cast(0 as bigint)"),
        ("price", "count(*) filter (where isinf(price))"),
        ("quantity", "count(*) filter (where isinf(quantity))"),
        ("one", "cast(0 as bigint)"),
    )
)
_WITH_CONSTANT = f"{MESSY_NUMBERS}, m as (select l_linestatus, price, quantity, 7 as one from messy)"
_ROLES = "r as (select *, cast(o_orderpriority = '1-URGENT' as int) as urgent from orders)"
_ID_LIKE = " union all ".join(
    f"select '{c}' as \"column\", {by} as by_name, ({by} or count(distinct {c}) > 0.9 * greatest(1, count(*))) as id_like from r"
    for c, by in (
        ("o_orderkey", "false"), ("o_custkey", "true"), ("o_orderstatus", "false"), ("o_totalprice", "false"),
        ("o_orderdate", "false"), ("o_orderpriority", "false"), ("urgent", "false"),
    )
)

SQL = {
    "table_quality": """
        with t as (select l_quantity, l_discount, case when l_tax > 0.06 then null else l_tax end as l_tax, l_returnflag from lineitem)
        select count(*) as rows, cast(4 as bigint) as columns, count(*) - (select count(*) from (select distinct * from t)) as duplicates,
               count(*) - count(l_tax) as nulls, cast(3 as bigint) as numeric_columns, cast(1 as bigint) as categorical_columns
        from t""",
    "missing_profile": f"with {_SPARSE} select *, round(nulls / rows, 9) as null_fraction, nulls / rows > 0.5 as high_missing from ({_PROFILE})",
    "high_missing": f"with {_SPARSE} select \"column\", nulls, rows from ({_PROFILE}) where nulls / rows > 0.5",
    "table_summary": f"with {MESSY_ORDERS} " + " union all ".join(_profile_row(i, *c) for i, c in enumerate(_COLUMNS[:5])),
    "table_shape": "select count(*) as rows, cast(11 as bigint) as columns from lineitem",
    "numeric_stats": _STATS,
    "training_quality": f"with {_WITH_CONSTANT} {_QUALITY}",
    "constant_columns": f"with {_WITH_CONSTANT} select \"column\" from ({_QUALITY}) where constant",
    "id_like_columns": f"with {_ROLES} {_ID_LIKE}",
    "continuous_columns": f"with {_ROLES} "
    + " union all ".join(
        f"select '{c}' as \"column\", coalesce(bool_or({c} not in (0, 1)), false) as continuous from r"
        for c in ("o_orderkey", "o_custkey", "o_totalprice", "urgent")
    ),
    "common_numeric_columns": f"""
        with {_ROLES}, d as (
          select 'o_orderkey' as "column", count(distinct o_orderkey) as n, count(*) as rows from r
          union all select 'o_custkey', count(distinct o_custkey), count(*) from r
          union all select 'o_totalprice', count(distinct o_totalprice), count(*) from r)
        select "column" from d where n <= 0.9 * rows""",
    "class_distribution": f"with {LABELLED} select quality as class, count(*) as rows from labelled group by 1",
    "class_analysis": f"""
        with {LABELLED}, n as (select quality as class, count(*) as n from labelled group by 1),
        a as (select count(*) as classes, cast(sum(n) as bigint) as rows, min(n) / max(n) as r from n)
        select classes, rows, (select class from n order by n, class limit 1) as minority_class, round(r, 9) as imbalance_ratio,
               case when r > 0.3 then 'moderate' when r > 0.1 then 'severe' else 'extreme' end as severity,
               'random_undersampling' as strategy
        from a""",
    "table_checks": f"""
        with {_SPARSE}, a as (select count(*) as n, count(rare) as k, count(distinct rare) as d from sparse)
        select 'min_rows' as "check", cast(n as double) as found, n >= 10 as passed from a
        union all select 'min_correlation_rows', cast(n as double), n >= 30 from a
        union all select 'target_null_fraction', round((n - k) / n, 9), (n - k) / n <= 0.5 from a
        union all select 'two_classes', cast(d <= 1 as int), d > 1 from a
        union all select 'two_numeric_columns', 4.0, true from a""",
}
