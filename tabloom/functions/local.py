"""Small tables between driver and cluster."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabloom.errors import ValidationError

# rows of a result that is meant to be small
MAX_SMALL_ROWS = 1_000_000
# bytes of a method that the JVM still compiles; longer ones are interpreted
METHOD_BYTES = 8000


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A small table held in the plan itself, so that filters on it need no job."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if any(isinstance(f.dataType, T.TimestampType) for f in schema.fields):
        return spark.createDataFrame(list(rows), schema)  # time zone rules
    arrow = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=to_arrow_schema(schema))
    return spark.createDataFrame(arrow, schema)


def keep_small(df: DataFrame, limit: int = MAX_SMALL_ROWS) -> DataFrame:
    """Compute a small result once; more than ``limit`` rows are an error, never cut off."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValidationError(f"more than {limit} rows in a result meant to be small")
    return local_table(df.sparkSession, [tuple(r) for r in rows], df.schema)


@contextmanager
def capped(spark: SparkSession, name: str, most: int) -> Iterator[None]:
    """Runs what is inside with a session's setting, a number, at ``most`` or what it is below."""
    before = spark.conf.get(name)
    if int(before) > 0:  # no limit otherwise
        most = min(int(before), most)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def compiled_methods(spark: SparkSession):
    """Runs what is inside with ``spark.sql.codegen.hugeMethodLimit`` at the JVM's own limit.

    Spark fuses a stage into one method. That of very many expressions is never compiled and so many times slower than the expressions one by one.
    """
    return capped(spark, "spark.sql.codegen.hugeMethodLimit", METHOD_BYTES)
