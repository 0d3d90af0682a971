from __future__ import annotations

from pyspark.sql import functions as F

from registry.inputs import (
    MESSY_LINEITEM,
    MESSY_NUMBERS,
    MESSY_ORDERS,
    messy_lineitem,
    messy_numbers,
    messy_orders,
    table,
)
from tabloom import clean, read_table, write_table
from tabloom.operators import cleaning as c
from tabloom.operators.medians import class_medians, medians
from tabloom.scratch import new_path


def _round_trip(fmt, **options):
    """Write orders in a text format and read them back with types found by content."""

    def query(spark, sf):
        source = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
        path = write_table(source, new_path(spark, fmt), fmt)
        return read_table(spark, path, fmt, **options).select(
            F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
            F.round("o_totalprice", 2).alias("o_totalprice"),
            "o_orderstatus",
            "o_orderpriority",
        )

    return query


def csv_line_breaks(spark, sf):
    """Whole document texts, line breaks and quotes included, through CSV files that are read in splits."""
    source = table(spark, sf, "documents").select("doc_id", "lang", "text")
    path = write_table(source, new_path(spark, "csv"), "csv")
    return read_table(spark, path, "csv", multiline=True).select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "text")


def trim_markers(spark, sf):
    df = c.markers_to_null(c.strip_strings(messy_orders(spark, sf)))
    return df.select(F.col("` Order Key`").alias("key"), F.col("Status").alias("status"), F.col("PRIORITY").alias("priority"))


def names_and_doubles(spark, sf):
    df = c.numeric_to_double(c.resolve_target(c.normalize_names(messy_orders(spark, sf)), "CUST"))
    return df.select("order_key", "total_price_", "CUST")


def impute_median(spark, sf):
    df = c.numeric_to_double(c.normalize_names(messy_orders(spark, sf))).select("order_key", "total_price_", "cust")
    return c.impute(df).select("order_key", F.round("total_price_", 4).alias("total_price_"), "cust")


def impute_mode(spark, sf):
    df = c.normalize_names(c.markers_to_null(c.strip_strings(messy_orders(spark, sf)))).select("order_key", "status", "priority")
    return c.impute(df)


def _keyless(spark, sf):
    return table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def clean_full(spark, sf):
    df = clean(messy_lineitem(spark, sf), "status").table
    return df.select("qty_units_", F.round("tax", 6).alias("tax"), F.round("discount", 6).alias("discount"), "flag", "status")


def cleaning_counts(spark, sf):
    """Rows before and after and the nulls of every column before."""
    cleaned = clean(messy_lineitem(spark, sf), "status")
    after = c.cleaning_report(cleaned)["final_info"]["final_shape"][0]
    data = [(name, n, cleaned.rows_before, after) for name, n in cleaned.nulls_before.items()]
    return spark.createDataFrame(data, "column string, nulls_before bigint, rows_before bigint, rows_after bigint")


def preprocess_by_class(spark, sf):
    df = c.preprocess_numeric(messy_numbers(spark, sf), "l_linestatus", ["price", "quantity"])
    return df.withColumns({"price": F.round("price", 4), "quantity": F.round("quantity", 4)})


def preprocess_many(spark, sf):
    """The same with each order as a class: beyond sf0.001 the medians stay a table."""
    df = messy_numbers(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "price", "quantity")
    return c.preprocess_numeric(df, "l_orderkey", ["price", "quantity"]).withColumns({n: F.round(n, 4) for n in ("price", "quantity")})


def median_many(spark, sf):
    """Medians of lines by order, and of a few large classes by search, in one table."""
    df = table(spark, sf, "lineitem").selectExpr("case when l_linenumber < 3 then l_linenumber else l_orderkey + 10 end as k", "l_extendedprice")
    found = class_medians(df, ["l_extendedprice"], "k", direct_cells=0)
    return found.select(F.col("group").alias("k"), F.round("m0", 4).alias("med"))


def median_search(spark, sf):
    """Exact medians by bracketing, the way tables too large for one hash map take."""
    found = medians(
        table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity", "l_tax"], "l_linestatus", direct_cells=0, final_values=10_000
    )
    data = [(g, c_, round(v, 4)) for g, m in found.items() for c_, v in m.items()]
    return spark.createDataFrame(data, "l_linestatus string, column string, med double")


QUERIES = {
    "csv_round_trip": _round_trip("csv"),
    "csv_line_breaks": csv_line_breaks,
    "json_round_trip": _round_trip("json", orient="lines"),
    "clean_trim_markers": trim_markers,
    "clean_names_doubles": names_and_doubles,
    "impute_median": impute_median,
    "impute_mode": impute_mode,
    "drop_duplicates": lambda spark, sf: c.drop_duplicates(_keyless(spark, sf)),
    "duplicate_count": lambda spark, sf: c.duplicate_count(_keyless(spark, sf)),
    "clean_full": clean_full,
    "cleaning_report": cleaning_counts,
    "preprocess_by_class": preprocess_by_class,
    "preprocess_many_classes": preprocess_many,
    "median_many_classes": median_many,
    "median_search": median_search,
}


_ORDERS = "select o_orderkey, round(o_totalprice, 2) as o_totalprice, o_orderstatus, o_orderpriority from orders"
_MODE = "(select {c} from messy where {c} is not null group by {c} order by count(*) desc, {c} limit 1)"

SQL = {
    "csv_round_trip": _ORDERS,
    "csv_line_breaks": "select doc_id, lang, text from documents",
    "json_round_trip": _ORDERS,
    "clean_trim_markers": """
        select o_orderkey as key,
               case when o_orderstatus = 'P' then null else o_orderstatus end as status,
               case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderpriority end as priority
        from orders""",
    "clean_names_doubles": f"with {MESSY_ORDERS} select order_key, total_price_, cust as \"CUST\" from messy",
    "impute_median": f"""
        with {MESSY_ORDERS}, med as (select median(total_price_) as t, median(cust) as c from messy)
        select order_key, round(coalesce(total_price_, t), 4) as total_price_, coalesce(cust, c) as cust
        from messy cross join med""",
    "impute_mode": f"""
        with {MESSY_ORDERS}
        select cast(order_key as bigint) as order_key, coalesce(status, {_MODE.format(c='status')}) as status,
               coalesce(priority, {_MODE.format(c='priority')}) as priority
        from messy""",
    "drop_duplicates": "select distinct l_quantity, l_discount, l_tax, l_returnflag, l_linestatus from lineitem",
    "duplicate_count": """
        select cast(sum(n - 1) as bigint) as duplicates from (
          select count(*) as n from lineitem group by l_quantity, l_discount, l_tax, l_returnflag, l_linestatus)""",
    "clean_full": f"""
        with {MESSY_LINEITEM}
        select distinct qty_units_, round(tax, 6) as tax, round(discount, 6) as discount, flag, status from filled""",
    "cleaning_report": f"""
        with {MESSY_LINEITEM},
        sizes as (select (select count(*) from messy) as rows_before, (select count(*) from (select distinct * from filled)) as rows_after)
        select "column", nulls_before, rows_before, rows_after from (
          select 'qty_units_' as "column", count(*) - count(qty_units_) as nulls_before from messy
          union all select 'tax', count(*) - count(tax) from messy
          union all select 'discount', count(*) - count(discount) from messy
          union all select 'flag', count(*) - count(flag) from messy
          union all select 'status', count(*) - count(status) from messy) cross join sizes""",
    "preprocess_by_class": f"""
        with {MESSY_NUMBERS},
        m1 as (select l_linestatus as s, median(price) as p, median(quantity) as q from messy group by 1),
        f1 as (
          select messy.* replace (coalesce(price, p) as price, coalesce(quantity, q) as quantity)
          from messy join m1 on l_linestatus = s),
        f2 as (select * replace (case when isinf(price) then null else price end as price) from f1),
        m2 as (select l_linestatus as s, median(price) as p from f2 group by 1)
        select f2.* replace (round(coalesce(price, p), 4) as price, round(quantity, 4) as quantity)
        from f2 join m2 on l_linestatus = s""",
    "preprocess_many_classes": f"""
        with {MESSY_NUMBERS},
        m1 as (select l_orderkey as s, median(price) as p, median(quantity) as q from messy group by 1),
        f1 as (select messy.* replace (coalesce(price, p) as price, coalesce(quantity, q) as quantity) from messy join m1 on l_orderkey = s),
        f2 as (select * replace (case when isinf(price) then null else price end as price) from f1),
        m2 as (select l_orderkey as s, median(price) as p from f2 group by 1)
        select l_orderkey, l_linenumber, l_partkey, round(coalesce(price, p), 4) as price, round(quantity, 4) as quantity
        from f2 join m2 on l_orderkey = s""",
    "median_many_classes": """
        select case when l_linenumber < 3 then l_linenumber else l_orderkey + 10 end as k, round(median(l_extendedprice), 4) as med
        from lineitem group by 1""",
    "median_search": """
        select l_linestatus, 'l_extendedprice' as "column", round(median(l_extendedprice), 4) as med from lineitem group by 1
        union all select l_linestatus, 'l_quantity', round(median(l_quantity), 4) from lineitem group by 1
        union all select l_linestatus, 'l_tax', round(median(l_tax), 4) from lineitem group by 1""",
}
