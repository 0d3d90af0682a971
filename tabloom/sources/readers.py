"""CSV, JSON and Parquet readers with the type rules of the cleaner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.defaults import CSV_NA_VALUES
from tabloom.errors import ValidationError
from tabloom.functions.columns import col, looks_numeric, string_columns, strip
from tabloom.sources.columnar import read_column_json
from tabloom.sources.quoted import QUOTES, read_quoted_csv

FORMATS = {".csv": "csv", ".json": "json", ".jsonl": "json", ".parquet": "parquet"}


def infer_text_types(df: DataFrame, na_values: Sequence[str] = ()) -> DataFrame:
    """Type text columns by content, in one aggregate over the table.

    ``na_values`` become null first. A column is numeric iff every remaining
    value is a number (a column without values is numeric), boolean iff it has
    no nulls and holds only true/false; everything else stays text.
    """
    names = string_columns(df)
    if not names:
        return df
    df = df.withColumns(
        {c: F.when(~col(c).isin(list(na_values)), col(c)) if na_values else col(c) for c in names}
    )
    checks = []
    for i, c in enumerate(names):
        v = col(c)
        checks += [
            F.coalesce(F.bool_and(looks_numeric(v)), F.lit(True)).alias(f"num{i}"),
            F.coalesce(F.bool_and(F.coalesce(F.lower(v).isin("true", "false"), F.lit(False))), F.lit(False)).alias(f"bool{i}"),
        ]
    kinds = df.agg(*checks).first()
    casts = {}
    for i, c in enumerate(names):
        if kinds[f"num{i}"]:
            casts[c] = strip(col(c)).cast("double")
        elif kinds[f"bool{i}"]:
            casts[c] = F.lower(col(c)).cast("boolean")
    return df.withColumns(casts) if casts else df


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: T.StructType | str | None = None,
    multiline: bool | None = None,
    na_values: Sequence[str] = tuple(CSV_NA_VALUES),
) -> DataFrame:
    """CSV with header and doubled quotes.

    Without ``schema`` all columns are read as text and typed by content, which
    costs one extra pass. Files with line breaks inside quotes are split like any other, see
    :mod:`tabloom.sources.quoted`; without a word on them (``multiline``) one more pass looks for a line in which quotes don't pair up.
    """
    if multiline is None:
        multiline = _open_quotes(spark, path)
    if multiline:
        df = read_quoted_csv(spark, path, schema)
    else:
        reader = spark.read.options(header=True, **QUOTES)
        df = (reader.schema(schema) if schema is not None else reader).csv(path)
    return df if schema is not None else infer_text_types(df, na_values)


def _open_quotes(spark: SparkSession, path: str | list[str]) -> bool:
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    odd = F.contains("value", F.lit('"')) & (quotes % 2 == 1)  # most lines of most files have none
    return bool(spark.read.text(path).where(odd).limit(1).take(1))


def read_json(
    spark: SparkSession,
    path: str | list[str],
    *,
    orient: str = "lines",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """JSON tables.

    ``lines``: one object per line (splittable, use this at scale);
    ``records``: files holding an array of objects;
    ``columns``: files holding ``{column: {row label: value}}``, split like any text, see :mod:`tabloom.sources.columnar`.
    """
    if orient == "columns":
        return infer_text_types(read_column_json(spark, path))
    if orient not in ("lines", "records"):
        raise ValidationError(f"unknown JSON layout: {orient}")
    reader = spark.read.options(multiLine=orient == "records")
    if schema is not None:
        return reader.schema(schema).json(path)
    df = reader.json(path)
    return infer_text_types(df.select(*[col(c) for c in _file_order(spark, path, orient, df.columns)]))


def _file_order(spark: SparkSession, path: str | list[str], orient: str, columns: list[str]) -> list[str]:
    """Columns as the first record has them, then those that only others have."""
    whole = spark.read.text(path, wholetext=orient == "records")
    record = F.get_json_object("value", "$[0]") if orient == "records" else F.col("value")
    first = whole.select(F.json_object_keys(record).alias("names")).where("names is not null").first()
    names = [c for c in dict.fromkeys(first.names if first else []) if c in columns]
    return names + [c for c in columns if c not in names]


def file_format(path: str) -> str:
    """Format by file suffix, in any case."""
    name = path.lower().rstrip("/")
    for suffix, fmt in FORMATS.items():
        if name.endswith(suffix):
            return fmt
    raise ValidationError(f"unsupported file format: {path}")


def read_table(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Read by format or by file suffix; a ``.json`` file holds an array unless ``orient`` says otherwise."""
    fmt = fmt or file_format(path)
    if fmt == "csv":
        return read_csv(spark, path, **options)
    if fmt == "json":
        one_array = path.lower().rstrip("/").endswith(".json")
        return read_json(spark, path, **{"orient": "records" if one_array else "lines", **options})
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValidationError(f"unsupported file format: {fmt}")
