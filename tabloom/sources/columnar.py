"""Column-oriented JSON, ``{column: {row label: value}}``, read by many tasks however large the file.

Such a file may be a single line, so it is cut at its commas, which text splits can do. A piece between two commas turns the state it begins in (inside a string or outside, and how many
braces are open) into the one it ends in. Every split adds this up for both states, the splits of a file are put in order, and then
each piece knows whether its comma parts two cells (outside of strings, one or two braces open). Most cells are one piece and are not moved; pieces of longer ones,
with commas in strings or nested values, meet first. A cell belongs to the last column that begins up to it; columns of a row meet by its label.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom.errors import ValidationError
from tabloom.functions.columns import col
from tabloom.scratch import materialize

# tasks get this module's functions by value, so workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECES = "file long, block long, at long, value string, odd boolean, odd_behind boolean, open0 int, open0_behind int, open1 int, open1_behind int"
STRING = r'"(?:[^"\\]|\\.)*"'


def _braces(outside: pa.Array) -> np.ndarray:
    count = lambda c: pc.count_substring(outside, c).to_numpy(zero_copy_only=False).astype(np.int64)
    return count("{") + count("[") - count("}") - count("]")


def _effects(value: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each piece has an odd number of quotes, and the braces it opens if it begins outside of a string, and inside of one."""
    bare = pc.replace_substring_regex(value, r"(?s)\\.", "")
    odd = pc.count_substring(bare, '"').to_numpy(zero_copy_only=False) % 2 == 1
    strings = r'"[^"]*(?:"|$)'
    out = _braces(pc.replace_substring_regex(bare, strings, ""))
    inside = pc.replace_substring_regex(bare, r'^[^"]*(?:"|$)', "")
    return odd, out, _braces(pc.replace_substring_regex(inside, strings, ""))


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each piece: quotes before and behind it in its split (odd or not), and open braces if the split begins outside (0) or inside (1) a string."""
    now, quotes, open_ = None, 0, [0, 0]
    for batch in batches:
        file, block, at, value = batch.columns
        places = np.stack([file.to_numpy(), block.to_numpy()], axis=1)
        odd, *braces = _effects(value)
        n = len(places)
        edges = [0, *(np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1).tolist(), n] if n else [0]
        parity, opened = np.empty((2, n), bool), np.empty((2, 2, n), np.int32)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if tuple(places[a]) != now:
                now, quotes, open_ = tuple(places[a]), 0, [0, 0]
            sums = quotes + np.cumsum(odd[a:b])
            parity[1, a:b] = sums % 2
            parity[0, a:b] = (sums - odd[a:b]) % 2
            quotes = int(sums[-1])
            for s in (0, 1):
                step = np.where(parity[0, a:b] ^ bool(s), braces[1][a:b], braces[0][a:b])
                sums = open_[s] + np.cumsum(step)
                opened[s, 0, a:b], opened[s, 1, a:b] = sums - step, sums
                open_[s] = int(sums[-1])
        yield pa.RecordBatch.from_arrays(
            [file, block, at, value, *(pa.array(x) for x in (*parity, *opened[0], *opened[1]))],
            ["file", "block", "at", "value", "odd", "odd_behind", "open0", "open0_behind", "open1", "open1_behind"],
        )


def _in_order(splits: pa.Table) -> pa.Table:
    inside, depth, out = False, 0, []
    for s in splits.sort_by("block").to_pylist():
        before = (inside, depth)
        depth += s["open1"] if inside else s["open0"]
        inside ^= s["odd"]
        out.append((s["file"], s["block"], *before, inside, depth))
    names = ["file", "block", "inside", "depth", "inside_behind", "depth_behind"]
    return pa.Table.from_arrays([pa.array(c, pa.int32() if n.startswith("depth") else None) for n, c in zip(names, zip(*out, strict=True), strict=True)], names)


def read_cells(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, place, name, label, value): every cell of every file; ``place`` is that of its column in the file, from 1."""
    text = spark.read.option("lineSep", ",").text(path)
    split = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    pieces = text.select(*split, F.monotonically_increasing_id().alias("at"), "value").mapInArrow(_states, PIECES)
    pieces = materialize(pieces, "json-pieces")  # numbers of pieces must not change from here on
    last = ("odd_behind", "odd"), ("open0_behind", "open0"), ("open1_behind", "open1")
    ends = pieces.groupBy("file", "block").agg(*[F.max_by(a, "at").alias(b) for a, b in last])
    # one row for each split, so for some 100 MB of text: small next to what it describes
    splits = ends.groupBy("file").applyInArrow(_in_order, "file long, block long, inside boolean, depth int, inside_behind boolean, depth_behind int")
    splits = materialize(splits, "json-splits")
    cut = splits.groupBy("file").agg(F.max_by(F.struct("inside_behind", "depth_behind"), "block").alias("end")).where("end.inside_behind or end.depth_behind <> 0")
    if cut.limit(1).take(1):
        raise ValidationError("a column-oriented JSON file doesn't end where its first brace closes")
    told = pieces.join(F.broadcast(splits.select("file", "block", "inside", "depth")), ["file", "block"])
    told = told.selectExpr(
        "file", "block", "at", "value", "odd <> inside as inside", "odd_behind <> inside as inside_behind",
        "depth + if(inside, open1, open0) as depth", "depth + if(inside, open1_behind, open0_behind) as depth_behind",
    )
    told = told.selectExpr("*", "not inside and depth < 3 as begins", "not inside_behind and depth_behind < 3 as ends")
    alone = told.where("begins and ends").select("file", "block", "at", "depth", "depth_behind", "value")
    cells = alone.unionByName(_grouped(told.where("not (begins and ends)")))
    # a column begins where one brace is open, or none before the first piece of a file
    head = rf'(?s)^\s*\{{?\s*({STRING})\s*:\s*\{{(.*)$'
    named = F.when(F.col("depth") < 2, F.regexp_extract("value", head, 1)).otherwise("")
    cells = cells.withColumn("json_name", named).withColumn("text", F.when(F.col("depth") < 2, F.regexp_extract("value", head, 2)).otherwise(F.col("value")))
    starts = cells.where("depth < 2 and json_name <> ''").select(
        "file", "block", "at", F.get_json_object(F.concat(F.lit('{"k":'), "json_name", F.lit("}")), "$.k").alias("name")
    )
    # one row for each column of a file; a split knows those that begin in it and the one that it begins in
    starts = starts.withColumn("place", F.row_number().over(Window.partitionBy("file").orderBy("block", "at")))
    starts = materialize(starts.select("file", "block", F.struct("at", "place", "name").alias("start")), "json-columns")
    here = starts.groupBy("file", "block").agg(F.sort_array(F.collect_list("start")).alias("starts"))
    known = splits.select("file", "block").join(here, ["file", "block"], "left")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.when(F.col("starts").isNotNull(), F.element_at("starts", -1)), ignorenulls=True).over(before)
    begun = F.when(carried.isNotNull(), F.array(F.struct(F.lit(-1).cast("long").alias("at"), carried["place"].alias("place"), carried["name"].alias("name"))))
    none = F.lit([]).cast("array<struct<at:bigint,place:int,name:string>>")
    known = known.select("file", "block", F.concat(F.coalesce(begun, none), F.coalesce("starts", none)).alias("starts"))
    cells = cells.join(F.broadcast(known), ["file", "block"])
    own = F.element_at(F.filter("starts", lambda s: s["at"] <= F.col("at")), -1)
    # braces that close the column or the file stand behind the last cell of it
    closed = F.when(F.col("depth_behind") == 2, F.concat("text", F.lit("}"))).when(F.col("depth_behind") == 0, F.regexp_replace("text", r"\}\s*$", "")).otherwise(F.col("text"))
    cell = F.from_json(F.concat(F.lit("{"), closed), "map<string,string>")
    cells = cells.where("depth = 2 or json_name <> ''").select("file", own.alias("own"), cell.alias("cell"))
    return cells.select("file", "own.place", "own.name", F.explode("cell").alias("label", "value"))


def _grouped(parts: DataFrame) -> DataFrame:
    """Cells of several pieces: each piece goes to the last beginning up to it, in its split or else in the splits before."""
    order = Window.partitionBy("file", "block").orderBy("at")
    first = F.when(F.col("begins"), F.struct("block", "at"))
    here = parts.withColumn("own", F.last(first, ignorenulls=True).over(order))
    blocks = parts.groupBy("file", "block").agg(F.max(first).alias("latest"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.last("latest", ignorenulls=True).over(before).alias("carried"))
    named = here.join(blocks, ["file", "block"]).withColumn("cell", F.coalesce("own", "carried"))
    told = F.sort_array(F.collect_list(F.struct("block", "at", "value")))
    whole = named.groupBy("file", "cell").agg(
        F.max(F.when(F.col("begins"), F.col("depth"))).alias("depth"), F.max_by("depth_behind", F.struct("block", "at")).alias("depth_behind"),
        F.array_join(F.transform(told, lambda x: x["value"]), ",").alias("value"),
    )
    return whole.select("file", "cell.block", "cell.at", "depth", "depth_behind", "value")


def read_column_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text, in the order in which they come first."""
    cells = materialize(read_cells(spark, path), "json-cells")
    names = [r["name"] for r in cells.groupBy("name").agg(F.min("place").alias("p")).orderBy("p", "name").collect()]
    if not names:
        raise ValidationError(f"no cells at {path}")
    wide = cells.groupBy("file", "label").agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])
    return wide.select(*[col(n) for n in names])
