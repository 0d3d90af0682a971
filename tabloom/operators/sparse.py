"""One-hot features of any width: a column of indices, and their meaning as a table.

A table of 0/1 columns has an end; categories don't. Here every category of every column is a position in one long vector, each row keeps the positions
that hold a 1, and a dictionary table says which (column, value) a position is. Positions are in the order that :func:`tabloom.operators.encoding.one_hot` gives its columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.defaults import BROADCAST_BYTES, BROADCAST_VALUES
from tabloom.errors import ValidationError
from tabloom.functions.columns import col, string_columns
from tabloom.operators.encoding import HOT_SHARE
from tabloom.operators.ranks import totals_before
from tabloom.scratch import materialize


@dataclass
class SparseOneHot:
    columns: list[str]
    size: int
    """length of the vector"""
    rows: int
    tables: dict[str, DataFrame]
    """column -> (digest, value, rows, index), stored"""
    sent: dict[str, bool]
    """whether a column's table was counted and is small enough to be broadcast"""

    def dictionary(self) -> DataFrame:
        """(index, column, value, rows) of every position."""
        parts = [t.select("index", F.lit(c).alias("column"), "value", "rows") for c, t in self.tables.items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def transform(self, df: DataFrame, name: str = "one_hot") -> DataFrame:
        """The text columns replaced by ``name``, the ascending positions (array of bigint) of the row's values; a missing value has none.

        A value that the fit hasn't seen has none either.
        """
        kept = [c for c in df.columns if c not in self.columns]
        if name in kept:
            raise ValidationError(f"there is a column {name} already")
        for c in self.columns:
            df = self._indexed(df, c)
        found = F.filter(F.array(*[col(c) for c in self.columns]), lambda x: x.isNotNull())
        return df.select(*[col(c) for c in kept], found.alias(name))

    def _indexed(self, df: DataFrame, column: str) -> DataFrame:
        """The column as its position. Joined by digest, so that long texts are neither broadcast nor shuffled."""
        names = df.columns
        codes = self.tables[column].select(F.col("digest").alias("_digest"), F.col("index").alias("_index"), "rows")
        marked = df.withColumn(column, F.md5(col(column))).withColumnRenamed(column, "_digest")
        if self.sent[column]:
            out = marked.join(F.broadcast(codes.drop("rows")), "_digest", "left")
        else:
            # fewer than HOT_SHARE values hold more than 1/HOT_SHARE of the rows; they and missing values stay out of the shuffle
            hot = F.broadcast(codes.where(F.col("rows") * HOT_SHARE > self.rows).drop("rows"))
            aside = marked.join(hot, "_digest", "left").where("_index is not null or _digest is null")
            others = marked.where("_digest is not null").join(hot.select("_digest"), "_digest", "left_anti").join(codes.drop("rows"), "_digest", "left")
            out = aside.unionByName(others)
        return out.drop("_digest").withColumnRenamed("_index", column).select(*[col(n) for n in names])

    def inverse(self, df: DataFrame, name: str = "one_hot") -> DataFrame:
        """The text columns back in the place of ``name``; what comes from no position is null."""
        first = 0
        for c in self.columns:
            size = self._sizes[c]
            low, high = first, first + size
            own = F.get(F.filter(col(name), _between(low, high)), F.lit(0))
            values = self.tables[c].select(F.col("index").alias("_index"), F.col("value").alias("_value"))
            marked = df.withColumn("_index", own)
            if self.sent[c]:
                met = marked.join(F.broadcast(values), "_index", "left")
            else:
                met = marked.join(values, "_index", "left")
            df = met.withColumnRenamed("_value", c).drop("_index")
            first = high
        return df.drop(name)

    @property
    def _sizes(self) -> dict[str, int]:
        if not hasattr(self, "_counted"):
            self._counted = {c: t.count() for c, t in self.tables.items()}
        return self._counted


def _between(low: int, high: int):
    return lambda x: (x >= low) & (x < high)


def fit_sparse_one_hot(df: DataFrame, columns: Sequence[str] | None = None) -> SparseOneHot:
    """Positions of all values of the text columns. Values stay on the cluster, only their numbers and sizes are told to the driver."""
    names = list(columns if columns is not None else string_columns(df))
    if not names:
        raise ValidationError("there is no text column")
    rows = df.count()
    tables, sent, first = {}, {}, 0
    for c in names:
        there = df.where(col(c).isNotNull()).groupBy(col(c).cast("string").alias("value"))
        distinct = there.agg(F.count("*").alias("rows"), F.lit(1).cast("bigint").alias("one"))
        ranked, totals = totals_before(distinct, "value", ["one"])
        tables[c] = materialize(ranked.select(F.md5("value").alias("digest"), "value", "rows", (F.col("one_before") + first).alias("index")), "positions")
        longest = tables[c].agg(F.max(F.octet_length("value"))).first()[0] or 0
        sent[c] = totals["one"] <= BROADCAST_VALUES and totals["one"] * max(40, longest) <= BROADCAST_BYTES
        first += totals["one"]
    return SparseOneHot(names, first, rows, tables, sent)
