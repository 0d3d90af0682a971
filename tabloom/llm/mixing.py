"""Interleaving of sources at target weights by Pfair scheduling.

Rows of a source are put into a fixed pseudo-random order and cut into blocks. With weight w, block j (from 1) of a
source is released at floor((j - 1) / w) and due by ceil(j / w); earliest deadline first gives every slot to a released
block, and after t slots a source has had less than one block more or fewer than w * t. Weights are taken as they are, as whole numbers in
their proportion, so nothing is rounded and the bound doesn't wear off with t. One task writes the schedule as a stream, a row for each block of
``block_rows`` rows, and holds one entry per source; each bucket of rows then finds its blocks there.

Every row is kept. The bound holds until the first source runs out; from then on its slots are empty and the others go on at
their weights among each other.

Rows are numbered inside (source, bucket of the order hash) and buckets add up to offsets, so one source with most rows is
spread over its buckets and no task sees a whole source.

Defined cases: a null source is a source of its own; rows of sources without a positive weight stay, with null
schedule columns; null ids and repeated rows are ordered by a hash of the whole row; an empty table gives an empty result;
input columns pass through inside the struct ``row``.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one source that one task numbers, about.
BUCKET_ROWS = 2_000


def schedule(shares: dict, blocks: dict) -> Iterator[tuple]:
    """(source, block from 1, release, deadline, slot) of ``blocks`` of each source, by slot; ``shares`` are whole numbers of any size.

    A source that has run out leaves its slots empty where no other block is released.
    """
    parts = sum(shares.values())
    waiting = sorted((0, str(s), s, 1) for s in shares if blocks.get(s))
    ready, t = [], 0
    while waiting or ready:
        if not ready:
            t = max(t, waiting[0][0])
        while waiting and waiting[0][0] <= t:
            release, name, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (_due(j, shares[s], parts), -shares[s], name, s, j, release))
        due, _, name, s, j, release = heapq.heappop(ready)
        if due <= t:
            raise AssertionError("a block misses its deadline")
        yield s, j, release, due, t
        if j < blocks[s]:
            heapq.heappush(waiting, (j * parts // shares[s], name, s, j + 1))
        t += 1


def period(shares: dict, parts: int) -> list:
    """Slot owners of one period. ``shares`` are whole numbers that add up to ``parts``."""
    assert sum(shares.values()) == parts
    return [s for s, *_ in schedule(shares, shares)]


def _due(j: int, share: int, parts: int) -> int:
    return -(-j * parts // share)


def whole_shares(weights: dict, parts: int) -> dict:
    """Weights as whole numbers of slots by largest remainder; each positive weight gets one at least."""
    weights = {s: Fraction(w) for s, w in weights.items() if w > 0 and math.isfinite(w)}
    if not weights:
        return {}
    spare, total = parts - len(weights), sum(weights.values())
    exact = {s: w / total * parts for s, w in weights.items()}
    out = {s: max(1, math.floor(x)) for s, x in exact.items()}
    by_rest = sorted(out, key=lambda s: (out[s] - exact[s], str(s)))
    left = parts - sum(out.values())
    for k in range(max(0, left)):
        out[by_rest[k % len(by_rest)]] += 1
    while left < 0:  # the ones that were raised to 1 take from the largest
        s = max(out, key=lambda s: (out[s], str(s)))
        out[s] -= 1
        left += 1
    assert spare >= 0 and sum(out.values()) == parts
    return out


def exact_shares(weights: dict, blocks: dict) -> dict:
    """Weights as whole numbers in the same proportion, without rounding, raised only where a slot number wouldn't fit 64 bits."""
    weights = {s: Fraction(w) for s, w in weights.items() if w > 0 and math.isfinite(w)}
    unit = math.lcm(*(w.denominator for w in weights.values()))
    shares = {s: int(w * unit) for s, w in weights.items()}
    total = sum(shares.values())
    return {s: max(n, -(-total * blocks.get(s, 0) // (1 << 61))) for s, n in shares.items()}


def _rows_of_schedule(shares: dict, blocks: dict):
    def run(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = schedule(shares, blocks)
        while part := list(itertools.islice(slots, 1 << 14)):
            key, block, release, deadline, slot = zip(*part, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array([j - 1 for j in block], pa.int64()), *(pa.array(x, pa.int64()) for x in (release, deadline, slot))],
                ["key", "block0", "release", "deadline", "slot"],
            )

    return run


def tempered_weights(docs: DataFrame, source_col: str = "source", power: float = 0.5) -> dict:
    """Target weights proportional to rows^power; one number per source."""
    return {r.s: float(r.n) ** power for r in docs.groupBy(F.col(source_col).alias("s")).agg(F.count("*").alias("n")).collect()}


def mix(
    docs: DataFrame,
    weights: dict,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_rows: int = 16,
    parts: int | None = None,
    seed: int = 7,
) -> DataFrame:
    """(row, mixed): ``mixed`` has block, release, deadline, slot and place (in the block), all from 0 but for block.

    Sorting by (slot, place) gives the mixture. With ``parts`` the weights are rounded to whole shares of that many slots first.
    """
    spark = docs.sparkSession
    if parts:
        weights = whole_shares(weights, max(parts, 4 * len(weights)))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.when(F.col(source_col).isNull(), "null").otherwise(F.concat(F.lit("="), F.col(source_col).cast("string"))).alias("key"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("h"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("tie"),
    )
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET_ROWS))
    placed = keyed.withColumn("bucket", F.pmod(F.shiftright("h", 20), F.lit(buckets)))
    before = (
        placed.groupBy("key", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn("offset", F.sum("n").over(Window.partitionBy("key").orderBy("bucket")) - F.col("n"))
    )
    text = lambda s: "null" if s is None else f"={s}"
    named = {text(s): w for s, w in weights.items() if w > 0 and math.isfinite(w)}
    known = spark.createDataFrame([(k,) for k in named], "key string")
    blocks = {r.key: -(-r.n // block_rows) for r in sizes.join(F.broadcast(known), "key").collect()}  # one number per weight
    table = spark.range(0, 1, 1, 1).mapInArrow(_rows_of_schedule(exact_shares(named, blocks), blocks), "key string, block0 long, release long, deadline long, slot long")
    # a bucket gets the slots of its blocks, so rows are not moved again
    reach = F.explode(F.sequence(F.expr(f"offset div {block_rows}"), F.expr(f"(offset + n - 1) div {block_rows}")))
    # the schedule grows with the rows, so it is shuffled whatever its size looks like before it runs
    turns = before.select("key", "bucket", "offset", reach.alias("block0")).hint("shuffle_merge").join(table.hint("shuffle_merge"), ["key", "block0"])
    turns = turns.groupBy("key", "bucket").agg(F.min("block0").alias("first"), F.sort_array(F.collect_list(F.struct("block0", "release", "deadline", "slot"))).alias("turns"))
    number = F.row_number().over(Window.partitionBy("key", "bucket").orderBy("h", "tie"))
    numbered = placed.withColumn("number", number).join(before.join(turns, ["key", "bucket"], "left").drop("n"), ["key", "bucket"])
    numbered = numbered.withColumn("number", F.col("number") - 1 + F.col("offset"))
    timed = numbered.withColumn("turn", F.get("turns", (F.expr(f"number div {block_rows}") - F.col("first")).cast("int")))
    mixed = F.struct(
        (F.col("turn.block0") + 1).alias("block"),
        F.col("turn.release").alias("release"),
        F.col("turn.deadline").alias("deadline"),
        F.col("turn.slot").alias("slot"),
        F.when(F.col("turn").isNotNull(), F.col("number") % block_rows).alias("place"),
    )
    return timed.select("row", mixed.alias("mixed"))
