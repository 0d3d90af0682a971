"""Running totals over ordered distinct values without a single-task sort."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.columns import col
from tabloom.functions.local import local_table
from tabloom.scratch import materialize

# values of one range, about; a range is sorted in one task and streamed through it
RANGE_VALUES = 1_000_000
# and at most so many bytes of texts, about
RANGE_BYTES = 64 * 1024 * 1024


def totals_before(distinct: DataFrame, value: str, weights: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """Adds ``<weight>_before``: the sum of the weight (whole numbers) over all smaller values. Also the grand totals.

    ``distinct`` holds each value once, so no value can make a range uneven. It is written once, as its rows and the bytes of its texts tell the number of ranges; then
    the values are range-partitioned, and running totals are made while each sorted range is written. Ranges are
    shifted by the totals of the ranges before them (one row per range) when they are read, without another shuffle.
    """
    values = materialize(distinct, "values")
    size = values.agg(F.count("*").alias("rows"), _text_bytes(values).alias("bytes")).first()
    ranges = max(1, math.ceil(size["rows"] / RANGE_VALUES), math.ceil((size["bytes"] or 0) / RANGE_BYTES))
    kept = values.select(*[col(c) for c in values.columns], F.lit(0).alias("_slot"), *[col(w).cast("bigint").alias(f"{w}_before") for w in weights])
    ordered = kept.repartitionByRange(ranges, col(value)).withColumn("_slot", F.spark_partition_id()).sortWithinPartitions(col(value))
    schema = T.StructType([*kept.schema.fields[: -len(weights)], *[T.StructField(f"{w}_before", T.LongType()) for w in weights]])
    slots = materialize(ordered.mapInArrow(_running(len(weights)), schema), "ranges")
    sums = slots.groupBy("_slot").agg(*[F.max(col(f"{w}_before") + col(w)).alias(w) for w in weights]).orderBy("_slot").collect()
    running = dict.fromkeys(weights, 0)
    offsets = []
    for r in sums:
        offsets.append((r["_slot"], *[running[w] for w in weights]))
        for w in weights:
            running[w] += r[w]
    table = local_table(distinct.sparkSession, offsets, "_slot int, " + ", ".join(f"`_{w}` bigint" for w in weights))
    # one row per range of RANGE_VALUES values or RANGE_BYTES bytes
    ranked = slots.join(F.broadcast(table), "_slot").select(
        *[col(c) for c in distinct.columns], *[(col(f"{w}_before") + col(f"_{w}")).alias(f"{w}_before") for w in weights]
    )
    return ranked, running


def _text_bytes(df: DataFrame) -> Column:
    """Bytes of all values that have no fixed width."""
    total = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(col(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            total = total + F.coalesce(F.octet_length(col(f.name).cast("string")), F.lit(0))
    return F.sum(total)


def _running(weights: int):
    """The last columns, that hold weights, as their sums over the rows before in the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = np.zeros(weights, np.int64)
        for batch in batches:
            columns = batch.columns
            for i in range(weights):
                at = batch.num_columns - weights + i
                weight = columns[at].to_numpy(zero_copy_only=False)
                sums = before[i] + np.cumsum(weight, dtype=np.int64)
                columns[at] = pa.array(sums - weight, pa.int64())
                if len(sums):
                    before[i] = sums[-1]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return run
