from __future__ import annotations

from pyspark.sql import functions as F

from registry.inputs import LABELLED, labelled_documents, table
from tabloom.operators import sampling as s
from tabloom.operators.synthesis import class_quotas, quota_table
from tabloom.operators.profiling import class_counts


def _sides(split, *columns):
    return split.train.select(*columns, F.lit("train").alias("side")).unionAll(
        split.test.select(*columns, F.lit("test").alias("side"))
    )


def split_documents(spark, sf):
    split = s.stratified_split(labelled_documents(spark, sf), "quality", 0.2, 42, ["doc_id"])
    return _sides(split, "doc_id", "quality")


def split_orders(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return _sides(s.stratified_split(df, "o_orderstatus", 0.25, 7, ["o_orderkey"]), "o_orderkey", "o_orderstatus")


def split_composite(spark, sf):
    """Lines by their two-column key."""
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    keys = ["l_orderkey", "l_linenumber"]
    return _sides(s.stratified_split(df, "l_returnflag", 0.2, 42, keys), *keys, "l_returnflag")


LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
#: Orders as classes; those of one line share a class of their own, as a class of one row can't be split.
ORDER_CLASSES = "case when count(*) over (partition by l_orderkey) > 1 then l_orderkey else -1 end"


def split_many(spark, sf):
    """About as many classes as there are orders: beyond sf0.001 they stay tables."""
    df = table(spark, sf, "lineitem").selectExpr(*LINE_KEYS, f"{ORDER_CLASSES} as k")
    return _sides(s.stratified_split(df, "k", 0.5, 42, LINE_KEYS), *LINE_KEYS)


def undersample_many(spark, sf):
    """One line of each order."""
    df = table(spark, sf, "lineitem").select(*LINE_KEYS)
    return s.undersample(df, "l_orderkey", keys=LINE_KEYS).table


def bootstrap_many(spark, sf):
    """As many draws as there are lines, over the orders they belong to."""
    df = table(spark, sf, "lineitem")
    return s.bootstrap_labels(df, "l_orderkey", df.count())


def split_copies(spark, sf):
    """Rows without any key: equal rows are interchangeable, class sizes are still exact."""
    df = table(spark, sf, "lineitem").select("l_linenumber", "l_returnflag", "l_linestatus")
    split = s.stratified_split(df, "l_linestatus")
    return _sides(split, "l_linestatus").groupBy("l_linestatus", "side").agg(F.count("*").alias("rows"))


def undersample(spark, sf):
    return s.undersample(labelled_documents(spark, sf), "quality", keys=["doc_id"]).table.select("doc_id", "lang", "quality")


def balance_report(spark, sf):
    return s.undersample(labelled_documents(spark, sf), "quality", keys=["doc_id"]).report_table()


def balance_validation(spark, sf):
    df = labelled_documents(spark, sf)
    after = s.undersample(df, "quality", keys=["doc_id"]).table
    ratios = ["original_imbalance_ratio", "balanced_imbalance_ratio", "improvement_factor"]
    return s.balance_validation(df, after, "quality").select(*[F.round(c, 9).alias(c) for c in ratios], "is_balanced")


def bootstrap(spark, sf):
    """As many labels as there are documents."""
    n = table(spark, sf, "documents").count()
    return s.bootstrap_labels(table(spark, sf, "labels"), "quality", n)


def quotas(spark, sf):
    """As many synthetic rows as there are orders, over the order priorities."""
    df = table(spark, sf, "orders")
    counts = class_counts(df, "o_orderpriority")
    return quota_table(spark, class_quotas(list(counts), sum(counts.values()) + 3), "string")


QUERIES = {
    "split_stratified": split_documents,
    "split_stratified_orders": split_orders,
    "split_composite_key": split_composite,
    "split_without_key": split_copies,
    "split_many_classes": split_many,
    "undersample_many_classes": undersample_many,
    "bootstrap_many_classes": bootstrap_many,
    "undersample": undersample,
    "balance_report": balance_report,
    "balance_validation": balance_validation,
    "bootstrap_labels": bootstrap,
    "class_quotas": quotas,
}


def _quota_sql(source: str, target: str, size: str) -> str:
    """Test rows per class: what the training side leaves after largest-fraction rounding."""
    return f"""
        c as (select {target} as k, count(*) as n from {source} group by 1),
        t as (select sum(n) as total, sum(n) - ceil({size} * sum(n)) as train from c),
        f as (select k, n, floor(n * train / total) as base, n * train / total - floor(n * train / total) as frac, train from c cross join t),
        q as (select k, n, n - base - case when row_number() over (order by frac desc, k) <= train - sum(base) over () then 1 else 0 end as test from f)"""


def _split_sql(source: str, key: str, target: str, size: str, seed: int) -> str:
    return f"""{_quota_sql(source, target, size)}
        select {key}, {target}, case when row_number() over (partition by {target} order by md5('{seed}|' || {key})) <= test
                                     then 'test' else 'train' end as side
        from {source} join q on {target} = k"""


_CHOSEN = f"""{LABELLED}, low as (select min(n) as n from (select count(*) as n from labelled group by quality)),
  ranked as (select *, row_number() over (partition by quality order by md5('42|' || doc_id)) as place from labelled),
  chosen as (select doc_id, lang, quality from ranked cross join low where place <= n)"""

_LINE_HASH = "md5('42|' || " + " || '|' || ".join(f"length({k}::varchar) || ':' || {k}" for k in LINE_KEYS) + ")"

SQL = {
    "split_many_classes": f"""
        with lines as (select *, {ORDER_CLASSES} as class from lineitem), {_quota_sql('lines', 'class', '0.5')}
        select {', '.join(LINE_KEYS)}, case when row_number() over (partition by class order by {_LINE_HASH}) <= test then 'test' else 'train' end as side
        from lines join q on class = k""",
    "undersample_many_classes": f"""
        with low as (select min(n) as n from (select count(*) as n from lineitem group by l_orderkey)),
        ranked as (select {', '.join(LINE_KEYS)}, row_number() over (partition by l_orderkey order by {_LINE_HASH}) as place from lineitem)
        select {', '.join(LINE_KEYS)} from ranked cross join low where place <= n""",
    "bootstrap_many_classes": """
        with c as (select l_orderkey, count(*) as n from lineitem group by 1),
        e as (select l_orderkey, sum(n) over (order by l_orderkey) - n as low, sum(n) over () as total from c),
        ids as (select unnest(range((select count(*) from lineitem))) as id),
        u as (select id, floor(cast('0x' || substr(md5('42|' || id), 1, 13) as bigint) / 4503599627370496.0 * (select max(total) from e)) as place from ids)
        select id, l_orderkey from u asof join e on place >= low""",
    "split_stratified": f"with {LABELLED}, {_split_sql('labelled', 'doc_id', 'quality', '0.2', 42)}",
    "split_stratified_orders": f"with {_split_sql('orders', 'o_orderkey', 'o_orderstatus', '0.25', 7)}",
    "split_composite_key": f"""
        with {_quota_sql('lineitem', 'l_returnflag', '0.2')}
        select l_orderkey, l_linenumber, l_returnflag, case when row_number() over (partition by l_returnflag order by md5('42|' ||
          length(l_orderkey::varchar) || ':' || l_orderkey || '|' || length(l_linenumber::varchar) || ':' || l_linenumber)) <= test then 'test' else 'train' end as side
        from lineitem join q on l_returnflag = k""",
    "split_without_key": f"""
        with {_quota_sql('lineitem', 'l_linestatus', '0.2')}
        select k as l_linestatus, 'test' as side, cast(test as bigint) as rows from q
        union all select k, 'train', cast(n - test as bigint) from q""",
    "undersample": f"with {_CHOSEN} select * from chosen",
    "balance_report": f"""
        with {_CHOSEN}
        select a.quality as class, a.n as before, b.n as after, a.n - b.n as removed
        from (select quality, count(*) as n from labelled group by 1) a
        join (select quality, count(*) as n from chosen group by 1) b using (quality)""",
    "balance_validation": f"""
        with {_CHOSEN},
        a as (select max(n) / min(n) as r from (select count(*) as n from labelled group by quality)),
        b as (select max(n) / min(n) as r from (select count(*) as n from chosen group by quality))
        select round(a.r, 9) as original_imbalance_ratio, round(b.r, 9) as balanced_imbalance_ratio,
               round(a.r / b.r, 9) as improvement_factor, b.r <= 1.1 as is_balanced
        from a cross join b""",
    "bootstrap_labels": """
        with c as (select quality, count(*) as n from labels group by 1),
        e as (select quality, sum(n) over (order by quality) - n as low, sum(n) over (order by quality) as high, sum(n) over () as total from c),
        ids as (select unnest(range((select count(*) from documents))) as id),
        u as (select id, cast('0x' || substr(md5('42|' || id), 1, 13) as bigint) / 4503599627370496.0 as x from ids)
        select id, quality from u join e on floor(x * total) >= low and floor(x * total) < high""",
    "class_quotas": """
        with c as (select o_orderpriority as class, row_number() over (order by o_orderpriority) as i, count(*) over () as k
                   from (select distinct o_orderpriority from orders)),
        n as (select count(*) + 3 as n from orders)
        select class, cast(greatest(1, n // k) + case when i = 1 then n - k * (n // k) else 0 end as bigint) as rows
        from c cross join n""",
}
