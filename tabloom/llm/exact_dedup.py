"""Exact duplicates by content sort.

Rows are range-partitioned by sampled splitters over (leading characters, digest, id),
sorted externally inside each partition, and every text is compared in full with its
neighbour. Splitters are short whatever the length of the texts. Since the id is part of the key,
a text with any number of copies spreads over as many partitions as its rows need; a run of
equal texts that crosses partitions is joined up afterwards from the edge rows, of which
there are at most two per partition.

Defined cases: a null text is the empty text; an empty table gives an empty result; a null id sorts
after all others, so it stays only where no other id has the text; of rows that repeat both text and id
exactly one is kept; only the id and text columns are read, so other columns and their names don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.scratch import materialize

#: Characters of the text that lead the sort key; the digest orders texts that agree on them.
HEAD = 24


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 of the normalised text.

    ``keep`` says whether the smallest or the largest id of equal texts stays.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep must be 'min' or 'max'")
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = normalise(text) if normalise else text
    order = F.col("id").asc_nulls_last() if keep == "min" else F.col("id").desc_nulls_last()
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id", "text", F.substring("text", 1, HEAD).alias("head"), F.sha2(F.encode("text", "utf-8"), 256).alias("digest")
    )
    id_type = keyed.schema["id"].dataType
    found = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("digest", T.StringType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("run", T.LongType()),
            T.StructField("run_rows", T.LongType()),
            T.StructField("keep_id", id_type),
            T.StructField("leads", T.BooleanType()),
            T.StructField("last", T.BooleanType()),
            T.StructField("edge", T.StringType()),
        ]
    )
    ordered = keyed.repartitionByRange("head", "digest", order).sortWithinPartitions("head", "digest", "text", order)
    runs = materialize(ordered.select("id", "text", "digest").mapInArrow(_runs, found), "content-sort")
    joined = _joined_runs(runs, id_type)
    out = runs.join(F.broadcast(joined), ["part", "run"], "left")
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("all_rows").isNull(), F.col("keep_id")).otherwise(F.col("all_keep")).alias("keep_id"),
        F.coalesce("all_rows", "run_rows").alias("group_size"),
        (F.col("leads") & F.coalesce("starts", F.lit(True))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in one sorted partition; only ids and digests of the open run are held."""
    part = TaskContext.get().partitionId()
    run, last_text, held = -1, None, []  # held: (ids, digests) pieces of the open run

    def close(pieces, number, text, is_last):
        ids = pa.concat_arrays([p[0] for p in pieces])
        digests = pa.concat_arrays([p[1] for p in pieces])
        n = len(ids)
        edge = [text if number == 0 or is_last else None] + [None] * (n - 1)
        return [
            ids, digests, pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, number, np.int64)),
            pa.array(np.full(n, n, np.int64)), pa.concat_arrays([ids[:1]] * n) if n < 2 else ids.take(pa.array(np.zeros(n, np.int64))),
            pa.array(np.arange(n) == 0), pa.array(np.full(n, is_last)), pa.array(edge, pa.string()),
        ]

    names = ["id", "digest", "part", "run", "run_rows", "keep_id", "leads", "last", "edge"]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids, texts, digests = batch.column(0), batch.column(1), batch.column(2)
        new = np.ones(n, bool)
        new[1:] = ~np.asarray(pc.equal(texts[1:], texts[:-1]).to_numpy(zero_copy_only=False), bool)
        new[0] = run < 0 or texts[0].as_py() != last_text
        starts = np.flatnonzero(new)
        # what continues the open run
        until = int(starts[0]) if len(starts) else n
        if until:
            held.append((ids[:until], digests[:until]))
        if len(starts):
            if held:
                yield pa.RecordBatch.from_arrays(close(held, run, last_text, False), names)
            # closed runs inside the batch, at once
            inner = starts[:-1]
            if len(inner):
                lo, hi = int(starts[0]), int(starts[-1])
                sizes = np.diff(starts)
                first = np.repeat(inner, sizes)
                numbers = run + 1 + np.repeat(np.arange(len(inner)), sizes)
                edge = texts.take(pa.array(np.arange(lo, hi)))
                want = (numbers == 0) & (np.arange(lo, hi) == first)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[lo:hi], digests[lo:hi], pa.array(np.full(hi - lo, part, np.int32)), pa.array(numbers),
                        pa.array(np.repeat(sizes, sizes)), ids.take(pa.array(first)), pa.array(np.arange(lo, hi) == first),
                        pa.array(np.zeros(hi - lo, bool)), pc.if_else(pa.array(want), edge, pa.scalar(None, pa.string())),
                    ],
                    names,
                )
            run += len(starts)
            held = [(ids[int(starts[-1]) :], digests[int(starts[-1]) :])]
        last_text = texts[n - 1].as_py()
    if held:
        yield pa.RecordBatch.from_arrays(close(held, run, last_text, True), names)


def _joined_runs(runs: DataFrame, id_type: T.DataType) -> DataFrame:
    """(part, run) of runs that go on in another partition, with what holds for the whole.

    The edge texts are compared by Spark; the driver sees one row of numbers per partition.
    """
    edges = runs.where(F.col("leads") & ((F.col("run") == 0) | F.col("last")))
    parts = edges.groupBy("part").agg(F.max("run").alias("last_run"))
    numbers = {r.part: r.last_run for r in parts.collect()}
    after = dict(zip(sorted(numbers), sorted(numbers)[1:], strict=False))
    spark = runs.sparkSession
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()), T.StructField("run", T.LongType()), T.StructField("all_keep", id_type),
            T.StructField("all_rows", T.LongType()), T.StructField("starts", T.BooleanType()),
        ]
    )
    if not after:
        return spark.createDataFrame([], schema)
    nexts = spark.createDataFrame(list(after.items()), "part int, following int")
    tails = edges.where("last").select("part", F.col("edge").alias("tail"))
    heads = edges.where("run = 0").select(F.col("part").alias("following"), F.col("edge").alias("head"))
    same = {
        r.part
        for r in tails.join(nexts, "part").join(heads, "following").where(F.col("tail") == F.col("head")).select("part").collect()
    }
    # numbers of the edge runs only
    ends = {(r.part, r.run): (r.keep_id, r.run_rows) for r in edges.select("part", "run", "keep_id", "run_rows").collect()} if same else {}
    out, chain = [], []
    for p in sorted(numbers):
        if not chain or chain[-1][0] not in same:
            chain = []
        if chain:
            chain.append((p, 0))
        if chain and (numbers[p] > 0 or p not in same):
            out += _resolve(chain, ends)
            chain = []
        if p in same and not chain:
            chain = [(p, numbers[p])]
    return spark.createDataFrame(out, schema)


def _resolve(chain, ends):
    keep, rows = ends[chain[0]][0], sum(ends[c][1] for c in chain)
    return [(p, run, keep, rows, k == 0) for k, (p, run) in enumerate(chain)]
