"""Input tables of the registered queries, always whole.

The given tables hold no missing values, markers or copies, so those are made
from the values themselves, by the same expressions on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NBSP = "\u00a0"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- orders with missing values, markers and odd names ----------------------


def messy_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as ` Order Key`",
        "case when o_orderstatus = 'P' then null else o_totalprice end as `Total (Price)`",
        "case when o_orderpriority = '5-LOW' then null else o_custkey end as Cust",
        f"case o_orderstatus when 'P' then ' ? ' when 'O' then concat('\\t', o_orderstatus, ' ') else concat(o_orderstatus, '{NBSP}') end as Status",
        "case when o_orderpriority = '4-NOT SPECIFIED' then 'NA' else concat('  ', o_orderpriority) end as PRIORITY",
    )


MESSY_ORDERS = """
messy as (
  select cast(o_orderkey as double) as order_key,
         case when o_orderstatus = 'P' then null else o_totalprice end as total_price_,
         case when o_orderpriority = '5-LOW' then null else cast(o_custkey as double) end as cust,
         case when o_orderstatus = 'P' then null else o_orderstatus end as status,
         case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderpriority end as priority
  from orders
)"""


# --- lineitem without its keys: copies arise by themselves ------------------


def messy_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        "l_quantity as `Qty (units)`",
        "case when l_returnflag = 'N' then null else l_tax end as ` Tax`",
        "case when l_quantity > 40 then null else l_discount end as Discount",
        "case when l_returnflag = 'A' then ' ? ' else concat(' ', l_returnflag, '\\t') end as Flag",
        f"concat(l_linestatus, '{NBSP}') as STATUS",
    )


MESSY_LINEITEM = """
messy as (
  select l_quantity as qty_units_,
         case when l_returnflag = 'N' then null else l_tax end as tax,
         case when l_quantity > 40 then null else l_discount end as discount,
         case when l_returnflag = 'A' then null else l_returnflag end as flag,
         l_linestatus as status
  from lineitem
),
flag_mode as (select flag as v from messy where flag is not null group by flag order by count(*) desc, flag limit 1),
fills as (select median(tax) as tax, median(discount) as discount, (select v from flag_mode) as flag from messy),
filled as (
  select qty_units_, coalesce(m.tax, f.tax) as tax, coalesce(m.discount, f.discount) as discount,
         coalesce(m.flag, f.flag) as flag, status
  from messy m cross join fills f
)"""


def messy_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Nulls and infinities in lineitem, per line status."""
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus",
        "case when l_quantity > 45 then double('Infinity') when l_discount > 0.08 then null else l_extendedprice end as price",
        "case when l_returnflag = 'N' and l_quantity < 25 then null else l_quantity end as quantity",
    )


MESSY_NUMBERS = """
messy as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linestatus,
         case when l_quantity > 45 then cast('Infinity' as double) when l_discount > 0.08 then null else l_extendedprice end as price,
         case when l_returnflag = 'N' and l_quantity < 25 then null else l_quantity end as quantity
  from lineitem
)"""


# --- classes ----------------------------------------------------------------


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars").join(
        table(spark, sf, "labels"), "doc_id"
    )


LABELLED = "labelled as (select d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic from documents d join labels l using (doc_id))"


# --- a "real" and a "synthetic" table ----------------------------------------

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
CATEGORICAL = ["l_returnflag", "l_linestatus"]


def real_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").where("l_linestatus = 'F'")


def drifted_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The other lines with shifted numbers and flags."""
    return (
        table(spark, sf, "lineitem")
        .where("l_linestatus = 'O'")
        .withColumns(
            {
                "l_quantity": F.expr("l_quantity * 1.5"),
                "l_tax": F.expr("l_tax * l_tax"),
                "l_returnflag": F.expr("case when l_returnflag = 'A' and l_discount > 0.02 then 'R' else l_returnflag end"),
            }
        )
    )


REAL = """
re as (select * from lineitem where l_linestatus = 'F'),
sy as (
  select l_quantity * 1.5 as l_quantity, l_extendedprice, l_discount, l_tax * l_tax as l_tax, l_linenumber,
         case when l_returnflag = 'A' and l_discount > 0.02 then 'R' else l_returnflag end as l_returnflag, l_linestatus
  from lineitem where l_linestatus = 'O'
)"""
