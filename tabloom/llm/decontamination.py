"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

Texts become sequences of word hashes. A mask such as ``11010011`` slides over them and hashes the words under its ones, so
a substitution under a zero doesn't matter. Equal hashes of documents and benchmark items meet in an equi-join, and around each
hit the aligned words are counted: an item leaks where ``overlap`` consecutive words of it (all its words, if it has fewer) stand in the
document in place with at least the given share equal. Masks are checked to hit every allowed placement of
substitutions, so the join loses no leak.

The benchmark's seeds are broadcast if their counted number allows; beyond that both sides are shuffled by seed
and only hits go back to their documents.

Defined cases: null or wordless texts have no words and neither leak nor are leaked; items of one to four words must occur as
they are; empty tables give an empty result; a null id is an id of its own; repeated rows and items all count, with one
result row per (id, item); other columns are not read. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Masks for windows of 13 words and more, of 5 to 12, and the default window.
LONG_MASKS = ("11010011",)
SHORT_MASKS = ("1111", "11011", "10111", "11101")
OVERLAP = 13
SHARE = 0.8
#: Seeds and words of the benchmark up to which it is broadcast (about 100 MB).
BROADCAST_SEEDS = 1_000_000


def words(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return F.transform(found, lambda w: F.xxhash64(w))


def masks_for(window: int, overlap: int, long_masks=LONG_MASKS) -> tuple[str, ...]:
    if window < 5:
        return ("1" * window,)
    return tuple(long_masks) if window == overlap and window >= 13 else SHORT_MASKS


def lossless(masks: tuple[str, ...], window: int, share: float) -> bool:
    """Whether some mask hits whatever the allowed substitutions in a window."""
    misses = window - math.ceil(round(share * window, 9))
    places = [frozenset(s + k for k, c in enumerate(m) if c == "1") for m in masks for s in range(window - len(m) + 1)]
    return all(any(not p & set(bad) for p in places) for bad in itertools.combinations(range(window), misses))


def _seed(mask: str, h: Column, at: Column) -> Column:
    parts = [F.get(h, at + k) for k, c in enumerate(mask) if c == "1"]
    return F.when(at + len(mask) <= F.size(h), F.xxhash64(F.lit(mask), *parts))


def _seeds(rows: DataFrame, masks: list[str], keep: list[str], p: str) -> DataFrame:
    """A row per position and mask: ``keep`` columns, position ``p``, seed and the span of its mask."""
    placed = rows.select("*", F.posexplode("h").alias(p, "_word"))
    made = F.explode(F.array(*[F.struct(_seed(m, F.col("h"), F.col(p)).alias("seed"), F.lit(len(m)).alias("span")) for m in masks]))
    return placed.select(*keep, p, made.alias("s")).select(*keep, p, "s.seed", "s.span").where("seed is not null")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    overlap: int = OVERLAP,
    share: float = SHARE,
    long_masks: tuple[str, ...] = LONG_MASKS,
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """A row per leaking (id, item): id, item, best (largest share of a window), at (first word of the first such window in the text)."""
    items = (
        benchmark.select(F.col(item_col).alias("item"), words(F.col(item_text_col)).alias("h"))
        .where(F.size("h") > 0)
        .distinct()
        .withColumn("n", F.size("h"))
        .withColumn("window", F.least(F.lit(overlap), F.col("n")))
        .withColumn("item_key", F.xxhash64("item", "h"))
    )
    lengths = sorted(r.window for r in items.select("window").distinct().collect())  # at most ``overlap`` numbers
    for w in lengths:
        if not lossless(masks_for(w, overlap, long_masks), w, share):
            raise ValueError(f"the masks can miss a window of {w} words with a share of {share}")
    masks = {w: masks_for(w, overlap, long_masks) for w in lengths}
    parts = [_seeds(items.where(F.col("window") == w), list(masks[w]), ["item_key"], "q") for w in lengths]
    rows = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("h"))
    # the benchmark is counted before anything is broadcast
    sizes = items.agg(F.sum("n")).first()[0] or 0
    all_masks = sorted({m for w in lengths for m in masks[w]}) or ["1"]
    small = sizes * max(1, len(all_masks)) <= broadcast_seeds
    seeds = parts[0] if parts else items.selectExpr("item_key", "0 as q", "cast(null as long) as seed", "0 as span").where("false")
    for part in parts[1:]:
        seeds = seeds.unionByName(part)
    targets = items.select("item_key", "item", F.col("h").alias("g"), "n", "window")
    if small:
        hits = _seeds(rows, all_masks, ["id", "h"], "p").join(F.broadcast(seeds), ["seed", "span"]).join(F.broadcast(targets), "item_key")
    else:
        far = _seeds(rows, all_masks, ["id"], "p").join(seeds, ["seed", "span"]).select("id", "p", "q", "span", "item_key").distinct()
        back = rows.withColumnRenamed("id", "own")
        hits = far.join(back, F.col("id").eqNullSafe(F.col("own"))).drop("own").join(targets, "item_key")
    return (
        _judged(hits)
        .where(F.col("equal") >= F.ceil(F.round(F.col("window") * F.lit(share), 9)))
        .groupBy("id", "item")
        .agg(F.max(F.col("equal") / F.col("window")).alias("best"), F.min(F.greatest(F.col("p") - F.col("q"), F.lit(0))).alias("at"))
        .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best", "at")
    )


def _judged(hits: DataFrame) -> DataFrame:
    """``equal``: the most equal words in a window of the item that holds the hit's words and lies within the text."""
    shift = F.col("p") - F.col("q")
    first = F.greatest(F.lit(0), F.col("q") + F.col("span") - F.col("window"), -shift)
    last = F.least(F.col("q"), F.col("n") - F.col("window"), F.size("h") - shift - F.col("window"))
    same = lambda s: F.size(
        F.filter(F.sequence(F.lit(0), F.col("window") - 1), lambda i: F.get("g", s + i) == F.get("h", s + shift + i))
    )
    best = F.array_max(F.transform(F.sequence(first, last), same))
    return hits.withColumn("equal", F.when(first <= last, best).otherwise(0))
