"""Label codes and one-hot columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.defaults import BROADCAST_BYTES, BROADCAST_VALUES, MAX_ONE_HOT
from tabloom.errors import ValidationError
from tabloom.functions.columns import approx_distinct, col, distinct_hash, long_values, string_columns, text_or_nan
from tabloom.functions.local import local_table
from tabloom.operators.ranks import totals_before
from tabloom.scratch import materialize

# values holding more than 1/HOT_SHARE of the rows; there are fewer than HOT_SHARE of them
HOT_SHARE = 1000


@dataclass
class LabelCodes:
    """Codes 0..k-1 of the sorted distinct values of text columns; missing counts as ``nan``."""

    small: dict[str, list[str]]
    """sorted values of columns whose codes may be broadcast"""
    large: dict[str, DataFrame]
    """(digest, value, rows, code) of the others, never collected"""
    rows: int

    def mapping(self, spark) -> DataFrame:
        """(column, value, code), long form."""
        data = [(c, v, i) for c, values in self.small.items() for i, v in enumerate(values)]
        result = local_table(spark, data, "column string, value string, code bigint")
        for c, table in self.large.items():
            result = result.unionAll(table.select(F.lit(c).alias("column"), "value", "code"))
        return result

    def encode(self, df: DataFrame) -> DataFrame:
        """Replace the text columns by their codes (bigint)."""
        names = df.columns
        for i, (c, values) in enumerate(self.small.items()):
            table = local_table(df.sparkSession, list(zip(values, range(len(values)))), f"_v{i} string, _c{i} bigint")
            # checked: at most BROADCAST_VALUES rows and BROADCAST_BYTES bytes
            df = df.join(F.broadcast(table), text_or_nan(col(c)) == F.col(f"_v{i}"), "left")
            df = df.withColumn(c, F.col(f"_c{i}")).select(*[col(n) for n in names])
        for c, table in self.large.items():
            df = self._encode_large(df, c, table).select(*[col(n) for n in names])
        return df

    def _encode_large(self, df: DataFrame, column: str, table: DataFrame) -> DataFrame:
        # joined by digest, so that long texts are neither broadcast nor shuffled;
        # fewer than HOT_SHARE values can hold more than 1/HOT_SHARE of the rows:
        # their codes are broadcast and their rows take no part in the shuffle
        codes = table.select(F.col("digest").alias("_digest"), F.col("code").alias("_code"), "rows")
        hot = F.broadcast(codes.where(F.col("rows") * HOT_SHARE > self.rows).drop("rows"))
        marked = df.withColumn(column, F.md5(text_or_nan(col(column)))).withColumnRenamed(column, "_digest")
        of_hot = marked.join(hot, "_digest")
        others = marked.join(hot.select("_digest"), "_digest", "left_anti").join(codes.drop("rows"), "_digest")
        return of_hot.unionByName(others).withColumnRenamed("_code", column)


def label_codes(df: DataFrame, columns: Sequence[str] | None = None) -> LabelCodes:
    """Find the codes of text columns; a sketch decides which are small enough to broadcast."""
    names = list(columns or string_columns(df))
    if not names:
        return LabelCodes({}, {}, 0)
    cells, aggs = [], []
    for i, c in enumerate(names):
        cells += [distinct_hash(col(c)).alias(f"h{i}"), F.octet_length(col(c)).alias(f"b{i}")]
        aggs += [approx_distinct(F.col(f"h{i}")).alias(f"d{i}"), F.coalesce(F.max(f"b{i}"), F.lit(0)).alias(f"w{i}")]
    seen = df.select(*cells).agg(F.count("*").alias("rows"), *aggs).first()
    distinct = {c: seen[f"d{i}"] * 1.2 + 2 for i, c in enumerate(names)}
    size = {c: distinct[c] * max(3, seen[f"w{i}"]) for i, c in enumerate(names)}
    fits, spent = set(), 0
    for c in sorted(names, key=size.get):  # all columns together stay within the bytes
        spent += size[c]
        if distinct[c] <= BROADCAST_VALUES and spent <= BROADCAST_BYTES:
            fits.add(c)
    small, large = [c for c in names if c in fits], [c for c in names if c not in fits]
    values: dict[str, list[str]] = {c: [] for c in small}
    if small:
        limit = BROADCAST_VALUES * len(small)
        found = long_values(df, small, text=True).distinct().limit(limit + 1).collect()
        if len(found) > limit:
            raise ValidationError("more distinct values than estimated")
        for r in found:
            values[r["column"]].append(r["value"])
    ordered = {c: sorted(v) for c, v in values.items()}
    tables = {}
    for c in large:
        distinct = df.groupBy(text_or_nan(col(c)).alias("value")).agg(F.count("*").alias("rows"), F.lit(1).cast("bigint").alias("one"))
        ranked, _ = totals_before(distinct, "value", ["one"])
        # read twice by every encoding, so the ordered pass is stored
        coded = ranked.select(F.md5("value").alias("digest"), "value", "rows", F.col("one_before").alias("code"))
        tables[c] = materialize(coded, "codes")
    return LabelCodes(ordered, tables, seen["rows"])


def label_encode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return label_codes(df, columns).encode(df)


# --- one-hot ---------------------------------------------------------------


def one_hot_values(
    df: DataFrame, columns: Sequence[str], limit: int = MAX_ONE_HOT, estimates: dict[str, int] | None = None
) -> dict[str, list[str]]:
    """Sorted non-null values per column; more than ``limit`` in one column is an error.

    Sketches keep long lists from being collected; ``estimates`` passes in ones already made.
    """
    if not columns:
        return {}
    if estimates is None:
        hashes = df.select(*[distinct_hash(col(c)).alias(f"h{i}") for i, c in enumerate(columns)])
        row = hashes.agg(*[approx_distinct(F.col(f"h{i}")).alias(f"d{i}") for i in range(len(columns))]).first()
        estimates = {c: row[f"d{i}"] for i, c in enumerate(columns)}
    for c in columns:
        if estimates[c] > 1.2 * limit + 2:
            raise ValidationError(f"{c} has about {estimates[c]} values, more than {limit} one-hot columns")
    cells = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns]))
    )
    found = cells.where("value is not null").distinct().collect()
    values = {c: sorted(r["value"] for r in found if r["column"] == c) for c in columns}
    for c, v in values.items():
        if len(v) > limit:
            raise ValidationError(f"{c} has {len(v)} values, more than {limit} one-hot columns")
    return values


def one_hot(df: DataFrame, columns: Sequence[str] | None = None, values: dict[str, list[str]] | None = None) -> DataFrame:
    """0/1 columns ``col_value`` after the untouched columns; null gives zeros everywhere.

    Each new column carries its source and value as metadata, so that a
    comparison does not have to guess them from the name.
    """
    columns = list(columns if columns is not None else string_columns(df))
    values = values if values is not None else one_hot_values(df, columns)
    kept = [c for c in df.columns if c not in columns]
    new = [f"{c}_{v}" for c in columns for v in values[c]]
    clashes = {n for n in new if n in kept or new.count(n) > 1}
    if clashes:
        raise ValidationError(f"one-hot names collide: {sorted(clashes)}")
    dummies = [
        F.coalesce(col(c).cast("string") == F.lit(v), F.lit(False)).cast("int").alias(f"{c}_{v}", metadata=dummy_metadata(c, v))
        for c in columns
        for v in values[c]
    ]
    return df.select(*[col(c) for c in kept], *dummies)


def dummy_metadata(column: str, value: str) -> dict:
    return {"dummy_of": column, "dummy_value": value}
