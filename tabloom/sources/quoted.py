"""CSV files with line breaks inside quotes, read by many tasks.

A line of such a file may begin inside a quoted value or outside of one, and which of the two only what stands before it tells. Yet each line maps the one state it may begin in to
the state it ends in, and these maps compose. So files are read as lines, split like any text; every split works out what it does to either state; composing the splits of
a file in order gives each its true beginning; and then each line knows whether a record begins with it and ends with it. Most records are one line and are never
moved. The lines of longer ones meet by the number of their record.

Lines are stored once between these steps, as the numbers given to them must not change. A value that is still open at a file's end is an error.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.errors import ValidationError
from tabloom.scratch import materialize

# tasks get this module's functions by value, so workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTES = {"quote": '"', "escape": '"'}

#: Whole values up to a separator, then a quote that opens a value and isn't closed; possessive, so linear in the line.
_OPENS = re.compile(r'(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]++|"")*+\Z')
_INSIDE = re.compile(r'(?:[^"]++|"")*+')

LINES = "file long, block long, at long, value string, out_of boolean, out_of_in boolean, into_out boolean, into_in boolean"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted value is open at the line's end."""
    if '"' not in line:
        return inside
    if inside:
        stop = _INSIDE.match(line).end()
        if stop == len(line):
            return True
        comma = line.find(",", stop + 1)
        if comma < 0:
            return False
        line = line[comma + 1 :]
    return _OPENS.match(line) is not None


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each line, the state before and behind it if its split begins outside (first two) or inside a value."""
    now, state = None, [False, True]
    for batch in batches:
        file, block, at, value = batch.columns
        places = list(zip(file.to_pylist(), block.to_pylist(), strict=True))
        quoted = pc.match_substring(pc.fill_null(value, ""), '"').to_numpy(zero_copy_only=False)
        before, behind = np.empty((2, len(places)), bool), np.empty((2, len(places)), bool)
        known = 0
        turns = np.flatnonzero(quoted | np.array([a != b for a, b in zip(places, [now, *places], strict=False)], bool)).tolist()
        for i in turns:
            for s in (0, 1):
                before[s, known:i] = behind[s, known:i] = state[s]
            if places[i] != now:
                now, state = places[i], [False, True]
            for s in (0, 1):
                before[s, i] = state[s]
                if quoted[i]:
                    state[s] = ends_inside(value[i].as_py(), state[s])
                behind[s, i] = state[s]
            known = i + 1
        for s in (0, 1):
            before[s, known:] = behind[s, known:] = state[s]
        yield pa.RecordBatch.from_arrays(
            [file, block, at, value, *(pa.array(x) for x in (before[0], behind[0], before[1], behind[1]))],
            ["file", "block", "at", "value", "out_of", "out_of_in", "into_out", "into_in"],
        )


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, value): every record of every file but the first of each, as text; line breaks inside of values are kept."""
    text = spark.read.option("lineSep", "\n").text(path)
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = text.select(*place, F.monotonically_increasing_id().alias("at"), "value")
    lines = materialize(lines.mapInArrow(_states, LINES), "csv-lines")
    begins, ends = [~F.col("out_of"), ~F.col("into_out")], [~F.col("out_of_in"), ~F.col("into_in")]
    # a row for each split: what it does to either state, and how many records end in it
    splits = lines.groupBy("file", "block").agg(
        F.max_by("out_of_in", "at").alias("from_out"), F.max_by("into_in", "at").alias("from_in"),
        *[F.count(F.when(e, 1)).alias(f"ends{s}") for s, e in enumerate(ends)],
    )
    splits = _placed(splits)
    open_ = splits.groupBy("file").agg(F.max_by("leaves_inside", "block").alias("open")).where("open").limit(1).take(1)
    if open_:
        raise ValidationError("a quoted value is not closed at the end of a CSV file")
    # one row for each split, so for some 100 MB of text: small next to what it describes
    told = lines.join(F.broadcast(splits.select("file", "block", "inside", "earlier")), ["file", "block"])
    inside = F.col("inside")
    told = told.select(
        "file", "block", "at", "value", "earlier",
        F.when(inside, begins[1]).otherwise(begins[0]).alias("begins"), F.when(inside, ends[1]).otherwise(ends[0]).alias("ends"),
    )
    first = told.where("earlier = 0").groupBy("file").agg(F.min(F.when(F.col("ends"), F.struct("block", "at"))).alias("header"))
    told = told.join(F.broadcast(first), "file", "left")  # one row for each file
    told = told.where(F.struct("block", "at") > F.col("header"))
    alone = told.where("begins and ends").select("file", "value")
    parts = told.where("not (begins and ends)").select("file", "block", "at", "value", "begins")
    # a longer record has the number of lines like its first one that come before it
    marks = parts.where("begins").select("file", "block", "at")
    long = _grouped(parts, marks)
    whole = F.regexp_replace(F.col("value"), "\r$", "")
    return alone.unionByName(long).select("file", whole.alias("value")).where("value <> ''")


def _placed(splits: DataFrame) -> DataFrame:
    """Each split with the state it begins in, the state it leaves and the records that end before it; a file has 8 splits for each GB."""
    return splits.groupBy("file").applyInArrow(_in_order, "file long, block long, inside boolean, leaves_inside boolean, earlier long")


def _in_order(splits: pa.Table) -> pa.Table:
    inside, earlier, out = False, 0, []
    for s in splits.sort_by("block").to_pylist():
        leaves = s["from_in"] if inside else s["from_out"]
        out.append((s["file"], s["block"], inside, leaves, earlier))
        earlier += s["ends1"] if inside else s["ends0"]
        inside = leaves
    names = ["file", "block", "inside", "leaves_inside", "earlier"]
    return pa.Table.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)


def _grouped(parts: DataFrame, marks: DataFrame) -> DataFrame:
    """Records of several lines: each line goes to the last beginning up to it, found inside its split or else in the splits before."""
    order = Window.partitionBy("file", "block").orderBy("at")
    here = parts.withColumn("own", F.last(F.when(F.col("begins"), F.struct("block", "at")), ignorenulls=True).over(order))
    last = marks.groupBy("file", "block").agg(F.max("at").alias("at"))
    blocks = parts.select("file", "block").distinct().join(last, ["file", "block"], "left")
    carried = F.last(F.when(F.col("at").isNotNull(), F.struct("block", "at")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = blocks.select("file", "block", carried.alias("carried"))
    named = here.join(blocks, ["file", "block"]).withColumn("record", F.coalesce("own", "carried"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]), "\n")
    return named.groupBy("file", "record").agg(joined.alias("value")).select("file", "value")


def read_quoted_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """All columns as text under the names of the first record, or as ``schema`` says."""
    reader = spark.read.options(header=True, multiLine=True, **QUOTES)
    fields = (reader.schema(schema) if schema is not None else reader).csv(path).schema  # reads no more than a first record
    named = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields.fields)
    row = F.from_csv("value", F.lit(named), {**QUOTES, "multiLine": "true"})
    return read_records(spark, path).select(row.alias("row")).select("row.*")
