"""Encoding, scaling and correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.inputs import MESSY_NUMBERS, messy_numbers, table
from tabloom.operators import correlation as cor
from tabloom.operators import encoding as e
from tabloom.operators.comparison import target_correlation_bars
from tabloom.operators.features import prepare_features
from tabloom.operators.scaling import fit_min_max, fit_standard
from tabloom.operators.sparse import fit_sparse_one_hot

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SCALED = ["l_quantity", "l_discount", "l_extendedprice"]
CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_returnflag", "l_linestatus"]
TARGET = "l_quantity"


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")


def label_encode(spark, sf):
    return e.label_encode(_orders(spark, sf))


def encoder_map(spark, sf):
    return e.label_codes(_orders(spark, sf)).mapping(spark)


def label_encode_text(spark, sf):
    """Whole document texts as categories: too large to broadcast, ranked in ranges."""
    df = table(spark, sf, "documents").select("doc_id", "text")
    return e.label_encode(df).select("doc_id", F.col("text").alias("code"))


def one_hot(spark, sf):
    return e.one_hot(_orders(spark, sf).withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')")))


def one_hot_sparse(spark, sf):
    """Whole texts and languages of documents as positions of one vector, and read back from them."""
    df = table(spark, sf, "documents").select("doc_id", "lang", F.expr("case when doc_id % 11 = 0 then null else text end as text"))
    hot = fit_sparse_one_hot(df, ["lang", "text"])
    back = hot.inverse(hot.transform(df).withColumn("positions", F.array_join("one_hot", ",")))
    return back.select("doc_id", "lang", "text", "positions", F.lit(hot.size).cast("bigint").alias("size"))


def one_hot_dictionary(spark, sf):
    df = table(spark, sf, "orders").selectExpr("cast(o_custkey as string) as customer", "o_orderpriority")
    return fit_sparse_one_hot(df).dictionary()


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(*KEYS, "l_linestatus", *SCALED)


def _rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def standard_scale(spark, sf):
    df = _lines(spark, sf)
    return _rounded(fit_standard(df, SCALED).transform(df), SCALED)


def standard_round_trip(spark, sf):
    df = _lines(spark, sf)
    scaler = fit_standard(df, SCALED)
    return _rounded(scaler.inverse(scaler.transform(df)), SCALED, 4)


def min_max_scale(spark, sf):
    df = _lines(spark, sf)
    return _rounded(fit_min_max(df, SCALED, "l_linestatus").transform(df), SCALED)


def min_max_many(spark, sf):
    """Limits of each order's lines: beyond sf0.001 they stay a table."""
    df = table(spark, sf, "lineitem").select(*KEYS, "l_quantity")
    scaler = fit_min_max(df, ["l_quantity"], "l_orderkey")
    there = scaler.transform(df).withColumn("scaled", F.col("l_quantity"))
    return scaler.inverse(there).select(*KEYS, F.round("scaled", 6).alias("l_quantity"), F.round("l_quantity", 4).alias("back"))


def min_max_round_trip(spark, sf):
    df = _lines(spark, sf)
    scaler = fit_min_max(df, SCALED, "l_linestatus")
    return _rounded(scaler.inverse(scaler.transform(df)), SCALED, 4)


def feature_preparation(spark, sf):
    """ID-like columns dropped, priorities one-hot, customer numbers scaled."""
    df = table(spark, sf, "orders")
    f = prepare_features(df, "o_orderstatus", id_name_parts=["orderkey", "totalprice"])
    # the key is dropped as an identifier, so rows are compared as a multiset
    return f.table.withColumn("o_custkey", F.round("o_custkey", 6))


def _matrix(spark, sf):
    return cor.correlation_matrix(table(spark, sf, "lineitem"), CORRELATED)


def corr_matrix(spark, sf):
    return _matrix(spark, sf).select("variable_1", "variable_2", F.round("correlation", 8).alias("correlation"))


def corr_pairwise(spark, sf):
    """Columns with missing values and a constant one."""
    df = messy_numbers(spark, sf).select(
        F.expr("if(price = double('Infinity'), null, price)").alias("price"), "quantity", "l_linenumber", F.lit(3).alias("three")
    )
    return cor.correlation_matrix(df).select("variable_1", "variable_2", F.round("correlation", 8).alias("correlation"))


def _wide_cells() -> list[tuple[str, str, str]]:
    """(name, value, condition under which it is missing) of 72 columns over lineitem, as SQL for both sides."""
    kinds = ["l_quantity", "l_extendedprice", "l_partkey % 97", "l_suppkey % 13 * l_linenumber", "l_quantity * l_discount", "l_orderkey % 31 - l_quantity"]
    return [(f"w{k}", f"cast(({kinds[k % 6]}) + (l_partkey % {k + 2}) as double)", f"(l_orderkey + l_linenumber) % {k + 5} = 0 or l_suppkey % {k + 3} = 1") for k in range(72)]


def _wide(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(*[f"case when {gap} then null else {value} end as {name}" for name, value, gap in _wide_cells()])


def corr_wide(spark, sf):
    """72 columns, each with missing values of its own."""
    return cor.correlation_matrix(_wide(spark, sf)).select("variable_1", "variable_2", F.round("correlation", 7).alias("correlation"))


#: Rows on which two of the columns are infinite.
_ENDLESS = "(l_orderkey + l_linenumber) % 499 = 7"


def corr_infinite(spark, sf):
    """Twelve of them, two with infinities: pairs that have one on their rows have no correlation."""
    cells = [f"case when {gap} then null {f'when {_ENDLESS} then double(\"{sign}Infinity\")' if sign is not None else ''} else {value} end as {name}" for name, value, gap, sign in _endless()]
    df = table(spark, sf, "lineitem").selectExpr(*cells)
    return cor.correlation_matrix(df).select("variable_1", "variable_2", F.round("correlation", 7).alias("correlation"))


def _endless() -> list[tuple]:
    """The first cells; the third and the last have an infinity, and the fourth is missing wherever it is."""
    signs = {"w2": "", "w11": "-"}
    return [(n, v, f"{gap} or {_ENDLESS}" if n == "w3" else gap, signs.get(n)) for n, v, gap in _wide_cells()[:12]]


def corr_target(spark, sf):
    return cor.target_correlations(_matrix(spark, sf), TARGET).withColumn("correlation", F.round("correlation", 8))


def corr_target_bars(spark, sf):
    return target_correlation_bars(_matrix(spark, sf), TARGET).select("variable", "sign", "label")


QUERIES = {
    "corr_target_bars": corr_target_bars,
    "label_encode": label_encode,
    "encoder_map": encoder_map,
    "label_encode_text": label_encode_text,
    "one_hot": one_hot,
    "one_hot_sparse": one_hot_sparse,
    "one_hot_dictionary": one_hot_dictionary,
    "standard_scale": standard_scale,
    "standard_round_trip": standard_round_trip,
    "min_max_scale": min_max_scale,
    "min_max_many_classes": min_max_many,
    "min_max_round_trip": min_max_round_trip,
    "feature_preparation": feature_preparation,
    "corr_matrix": corr_matrix,
    "corr_pairwise_nulls": corr_pairwise,
    "corr_wide": corr_wide,
    "corr_infinite": corr_infinite,
    "corr_target": corr_target,
    "corr_strong": lambda spark, sf: cor.strong_pairs(_matrix(spark, sf), 0.001),
    "corr_highest": lambda spark, sf: cor.extreme_pairs(_matrix(spark, sf)),
    "corr_lowest": lambda spark, sf: cor.extreme_pairs(_matrix(spark, sf), highest=False),
    "corr_extremes": lambda spark, sf: cor.target_extremes(_matrix(spark, sf), TARGET),
    "corr_triangle": lambda spark, sf: cor.lower_triangle(_matrix(spark, sf)).select(
        "variable_1", "variable_2", F.round("correlation", 8).alias("correlation")
    ),
}


def _triangle(names: list[str], cells: str, unknown: str = "false") -> str:
    """All pairs from one aggregation; ``unknown`` is what a pair mustn't have on any row."""
    def cell(a, b):
        r = f"round({'1.0' if a == b else f'corr({a}, {b})'}, 7)"
        return f"case when not bool_or({unknown.format(a, b)}) then {r} end"

    rows = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': {cell(a, b)}}}" for i, a in enumerate(names) for b in names[i:])
    return f"""with wide as (select {cells} from lineitem), t as (select unnest([{rows}], recursive := true) from wide)
        select a as variable_1, b as variable_2, r as correlation from t union all select b, a, r from t where a <> b"""


def _corr(a: str, b: str, source: str) -> str:
    return f"select '{a}' as variable_1, '{b}' as variable_2, corr({a}, {b}) as r from {source}"


def _all_pairs(columns, source) -> str:
    parts = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            parts.append(f"select {i} as i, {j} as j, * from ({_corr(a, b, source)})")
    return " union all ".join(parts)


_CODED = """
coded as (
  select l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber,
         dense_rank() over (order by l_returnflag) - 1 as l_returnflag, dense_rank() over (order by l_linestatus) - 1 as l_linestatus
  from lineitem)"""
_PAIRS = f"{_CODED}, pairs as ({_all_pairs(CORRELATED, 'coded')})"


_STANDARD = ", ".join(f"round((l.{c} - a.m{i}) / a.s{i}, 6) as {c}" for i, c in enumerate(SCALED))


_MOMENTS = "a as (select " + ", ".join(f"avg({c}) as m{i}, stddev_pop({c}) as s{i}" for i, c in enumerate(SCALED)) + " from lineitem)"
_LIMITS = "a as (select l_linestatus as st, " + ", ".join(f"min({c}) as lo{i}, max({c}) as hi{i}" for i, c in enumerate(SCALED)) + " from lineitem group by 1)"
_KEYS = ", ".join(KEYS)
_BACK = f"select {_KEYS}, l_linestatus, " + ", ".join(f"round({c}, 4) as {c}" for c in SCALED) + " from lineitem"
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _dummies(column: str, values) -> str:
    return ", ".join(f"cast(coalesce({column} = '{v}', false) as int) as \"{column}_{v}\"" for v in values)


SQL = {
    "corr_target_bars": f"""
        with {_PAIRS}
        select variable_1 as variable, case when r < 0 then 'negative' else 'positive' end as sign, printf('%.3f', r) as label
        from pairs where variable_2 = '{TARGET}' and variable_1 <> '{TARGET}'""",
    "label_encode": """
        select o_orderkey, dense_rank() over (order by o_orderstatus) - 1 as o_orderstatus,
               dense_rank() over (order by o_orderpriority) - 1 as o_orderpriority from orders""",
    "encoder_map": """
        select 'o_orderstatus' as "column", v as value, row_number() over (order by v) - 1 as code from (select distinct o_orderstatus as v from orders)
        union all
        select 'o_orderpriority', v, row_number() over (order by v) - 1 from (select distinct o_orderpriority as v from orders)""",
    "label_encode_text": "select doc_id, dense_rank() over (order by text) - 1 as code from documents",
    "one_hot_sparse": """
        with d as (select doc_id, lang, case when doc_id % 11 = 0 then null else text end as text from documents),
        l as (select lang, row_number() over (order by encode(lang)) - 1 as i from (select distinct lang from d where lang is not null)),
        t as (select text, row_number() over (order by encode(text)) - 1 + (select count(*) from l) as j from (select distinct text from d where text is not null))
        select doc_id, lang, text, concat_ws(',', i, j) as positions, (select count(*) from l) + (select count(*) from t) as size
        from d left join l using (lang) left join t using (text)""",
    "one_hot_dictionary": """
        with c as (select o_custkey::varchar as value, count(*) as rows from orders group by 1), p as (select o_orderpriority as value, count(*) as rows from orders group by 1)
        select row_number() over (order by value) - 1 as index, 'customer' as "column", value, rows from c
        union all select row_number() over (order by value) - 1 + (select count(*) from c), 'o_orderpriority', value, rows from p""",
    "one_hot": f"""
        select o_orderkey, {_dummies('o_orderstatus', 'FO')}, {_dummies('o_orderpriority', _PRIORITIES)}
        from (select o_orderkey, nullif(o_orderstatus, 'P') as o_orderstatus, o_orderpriority from orders)""",
    "standard_scale": f"with {_MOMENTS} select {_KEYS}, l_linestatus, {_STANDARD} from lineitem l cross join a",
    "standard_round_trip": _BACK,
    "min_max_many_classes": f"""
        with a as (select l_orderkey as k, min(l_quantity) as lo, max(l_quantity) as hi from lineitem group by 1)
        select {_KEYS}, round((l_quantity - lo) * 2 / case when lo = hi then 1e-8 else hi - lo end - 1, 6) as l_quantity, round(l_quantity, 4) as back
        from lineitem join a on l_orderkey = k""",
    "min_max_scale": f"with {_LIMITS} select {_KEYS}, l_linestatus, "
    + ", ".join(f"round((l.{c} - lo{i}) * 2 / (hi{i} - lo{i}) - 1, 6) as {c}" for i, c in enumerate(SCALED))
    + " from lineitem l join a on l_linestatus = st",
    "min_max_round_trip": _BACK,
    "feature_preparation": f"""
        with a as (select avg(o_custkey) as m, stddev_pop(o_custkey) as s from orders)
        select round((o_custkey - m) / s, 6) as o_custkey, {_dummies('o_orderpriority', _PRIORITIES)}, o_orderstatus
        from orders cross join a""",
    "corr_matrix": f"with {_PAIRS} select variable_1, variable_2, round(r, 8) as correlation from pairs",
    "corr_triangle": f"with {_PAIRS} select variable_1, variable_2, round(r, 8) as correlation from pairs where i > j",
    "corr_pairwise_nulls": f"""
        with {MESSY_NUMBERS}, n as (
          select case when isinf(price) then null else price end as price, quantity, l_linenumber, 3 as three from messy),
        pairs as ({_all_pairs(['price', 'quantity', 'l_linenumber', 'three'], 'n')})
        select variable_1, variable_2, case when 'three' in (variable_1, variable_2) then null else round(r, 8) end as correlation from pairs""",
    "corr_wide": _triangle([n for n, *_ in _wide_cells()], ", ".join(f"case when {gap} then null else {v} end as {n}" for n, v, gap in _wide_cells())),
    "corr_infinite": _triangle(
        [n for n, *_ in _endless()],
        ", ".join(f"case when {gap} {f'or {_ENDLESS}' if sign is not None else ''} then null else {v} end as {n}, {'false' if sign is None else f'not ({gap}) and {_ENDLESS}'} as odd_{n}, not ({gap}) as there_{n}" for n, v, gap, sign in _endless()),
        "(odd_{0} and there_{1}) or (odd_{1} and there_{0})",
    ),
    "corr_target": f"""
        with {_PAIRS}
        select variable_1 as variable, round(r, 8) as correlation, case when r < 0 then 'negative' else 'positive' end as sign
        from pairs where variable_2 = '{TARGET}' and variable_1 <> '{TARGET}'""",
    "corr_strong": f"""
        with {_PAIRS}
        select variable_1 || '_vs_' || variable_2 as pair, round(r, 3) as correlation,
               case when abs(r) > 0.7 then 'strong' else 'moderate' end as strength
        from pairs where i < j and abs(r) > 0.001""",
    "corr_highest": f"""
        with {_PAIRS}
        select variable_1 || ' - ' || variable_2 as variables, round(r, 3) as correlation
        from pairs where i < j order by abs(r) desc, i, j limit 5""",
    "corr_lowest": f"""
        with {_PAIRS}
        select variable_1 || ' - ' || variable_2 as variables, round(r, 3) as correlation
        from pairs where i < j order by abs(r), i desc, j desc limit 5""",
    "corr_extremes": f"""
        with {_PAIRS}, t as (select * from pairs where variable_2 = '{TARGET}' and variable_1 <> '{TARGET}')
        select 'most_positive' as kind, * from (select variable_1 as variable, round(r, 3) as correlation from t order by r desc, i limit 1)
        union all select 'most_negative', * from (select variable_1, round(r, 3) from t order by r, i limit 1)
        union all select 'strongest_absolute', * from (select variable_1, round(abs(r), 3) from t order by abs(r) desc, i limit 1)""",
}
