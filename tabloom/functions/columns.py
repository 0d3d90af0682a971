"""Small column expressions and schema helpers."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the characters Python's str.strip() removes (fixed list)
WHITESPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
            *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ],
    )
)

NUMBER_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def col(name: str) -> Column:
    """A column by its exact name, also with dots, spaces or backticks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip(c: Column) -> Column:
    """Trim all Unicode white space on both ends (plain ``trim`` only trims spaces)."""
    return F.btrim(c, F.lit(WHITESPACE))


def looks_numeric(c: Column) -> Column:
    return strip(c).rlike(NUMBER_PATTERN)


def to_double(c: Column) -> Column:
    """Double with NaN as null, so that aggregates skip it."""
    return F.nullif(c.cast("double"), F.lit(float("nan")))


def present(df: DataFrame, name: str) -> Column:
    """A column as it is, but NaN as null: both mean a missing value."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col(name)), col(name))
    return col(name)


def is_infinite(c: Column) -> Column:
    return F.abs(c) == F.lit(float("inf"))


def normalized_name(name: str) -> str:
    return re.sub(r"\W+", "_", str(name).strip().lower())


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def text_or_nan(c: Column) -> Column:
    """Text form of a value; missing becomes the category ``nan``."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


def row_hash(seed: int, keys: Sequence[str]) -> Column:
    """Repeatable pseudo-random order of rows: md5 of seed and key values.

    It depends on nothing but the values, so retries, repartitioning and file
    layout cannot change which rows are picked. Several keys carry their lengths, so no two
    different keys read alike; a null is left out, so it differs from any text.
    """
    texts = [col(k).cast("string") for k in keys]
    parts = texts if len(texts) == 1 else [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def whole_row_hash(seed: int, columns: Sequence[str]) -> Column:
    """As :func:`row_hash` over all columns, from 128 bits of their content."""
    # the hash function skips nulls, so their places are part of the content
    cells = [x for c in columns for x in (col(c).isNull(), col(c))]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.xxhash64(*cells), F.xxhash64(F.lit("second"), *cells)))


def hash_total(df: DataFrame, h: Column) -> tuple[int, int | None]:
    """Rows, and the exact sum of their 64-bit hashes: thirds of them add up as longs, for a trillion rows."""
    mask = 2**22 - 1
    thirds = [F.shiftright("h", 44), F.shiftright("h", 22).bitwiseAND(mask), F.col("h").bitwiseAND(mask)]
    n, *sums = df.select(h.alias("h")).agg(F.count("*"), *[F.sum(x.cast("bigint")) for x in thirds]).first()
    return n, None if sums[0] is None else (sums[0] << 44) + (sums[1] << 22) + sums[2]


def hash_uniform(seed: int, c: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of md5(seed|value)."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), c.cast("string"))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**13))


# relative standard error of approx_distinct
DISTINCT_ERROR = 0.0082


def distinct_hash(c: Column) -> Column:
    """What :func:`approx_distinct` counts. A sketch interprets its argument row by row, so this belongs into a projection before it, which is compiled."""
    return F.when(c.isNotNull(), F.xxhash64(c))


def approx_distinct(hashes: Column) -> Column:
    """Estimated number of distinct non-null values of any type, from their :func:`distinct_hash`; almost exact for small numbers."""
    return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(hashes, 14)), F.lit(0))


def rows_from_one(df: DataFrame, structs: Iterable[Column]) -> DataFrame:
    """Turn a one-row aggregate into one row per struct (long form)."""
    return df.select(F.inline(F.array(*structs)))


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[Column] = (), text: bool = False) -> DataFrame:
    """One row (column, value) per cell of ``columns``."""
    cells = [
        F.struct(F.lit(c).alias("column"), (text_or_nan(col(c)) if text else col(c).cast("double")).alias("value"))
        for c in columns
    ]
    if len(cells) == 1:  # nothing to take apart
        return df.select(*keep, *[cells[0].getField(f).alias(f) for f in ("column", "value")])
    return df.select(*keep, F.inline(F.array(*cells)))
