"""Groups of spelling variants by pivotal grams.

Words are near if one inserted, deleted or replaced character turns one into the other. Bigrams are ordered by how many words have them, rarest first. A word's prefix is its
first three bigrams in that order: they are enough to hold two that don't overlap, and of these dynamic programming takes the two
disjoint ones that are rarest together, the word's pivots. One edit can't touch both. So of two near words, the one whose prefix ends earlier in the order has a pivot that is in the
other's prefix (or ties with its third), at the same place from the beginning or from the end; and since the edit is on one side of it, all that stands on the
other side is equal. So pivots and prefixes meet by (bigram with its place and all before it, length) and by (bigram with its place and all behind it, length), and what meets is verified.

Bigrams are told apart by 16 bits of a hash: the table of counts has 65,536 entries at the most, whatever the alphabet, and a collision makes a candidate more, never a near pair less.

A word's form is its near word of the largest count if that is at least ``times`` its own, and its root is where the forms lead; counts at least double at each step, so
chains are short and are followed by doubling.

Defined cases: null texts have no words; a null id alters no run; rows that repeat count as often as they come; words of fewer than four characters
have fewer than three bigrams and count as near to nothing; a table without words gives an empty result; columns other than id and text aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.arrays import mixed, portions, prefix_hash, span_hash
from tabloom.llm.workspace import Workspace
from tabloom.scratch import materialize

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAMS = 1 << 16
#: Rounds of doubling that follow any chain: counts are below 2^64 and double at each step.
ROUNDS = 6
#: Places in its order at which a word can hold a near word's pivot: two are before the pivot in that word, and an edit makes two bigrams at the most.
PROBES = 5
#: Lengths that share a key: a word's neighbours by length have one or two of them.
LENGTHS = 4


def counted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alter: int = 97, least_size: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n) of all runs of letters, a few of them altered by a rule on id and run, as the stated corpus wants it (``alter`` 0: none)."""
    runs = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(RUN), F.lit(0))
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(runs).alias("run")).where(F.length("run") >= least_size)
    rows = rows.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    word = F.col("run")
    if alter:
        h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "utf-8"))
        rows = rows.withColumn("h", h)
        at = (F.col("h") % F.length("run")).cast("int")
        word = F.when(F.col("h") % alter == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(word)
    counted = rows.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= least_count) & (F.length("word") >= least_size))


# --- tasks -------------------------------------------------------------------------------------------------


def bigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, place, gram) of all bigrams in order, and the words' sizes in characters."""
    texts = column.to_pylist()
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    word = np.repeat(np.arange(len(texts)), sizes)
    first = np.flatnonzero(np.append(word[1:] == word[:-1], False)) if len(word) else np.zeros(0, np.int64)
    gram = mixed(points[first].astype(np.uint64) << np.uint64(32) | points[first + 1].astype(np.uint64)) & np.uint64(GRAMS - 1) if len(first) else np.zeros(0, np.uint64)
    return word[first], first - (ends - sizes)[word[first]], gram.astype(np.int64), sizes


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(GRAMS, np.int64)
    for part in portions(batches, lambda b: b.column(0)):
        word, _, gram, _ = bigrams(part.column(0))
        total += np.bincount(np.unique(word * GRAMS + gram) % GRAMS, minlength=GRAMS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "often"])


def prefixes(word: np.ndarray, place: np.ndarray, gram: np.ndarray, rank: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry numbers of what may meet a pivot, entry numbers of the pivots, rank of each word's third gram); every word has three bigrams or more."""
    own = rank[gram]
    order = np.lexsort((place, own, word))
    sizes = np.bincount(word, minlength=words)
    turn = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    three = order[turn < 3].reshape(words, 3)
    last = own[three[:, 2]]
    tied = order[turn < PROBES]
    inside = tied[own[tied] <= last[word[tied]]]
    # by place, the least cost of two entries that don't overlap: the cheapest of those that end before, and this one
    three = np.sort(three, axis=1)  # entries are in order of place
    cost, at = own[three], place[three]
    second = cost[:, 1] < cost[:, 0]
    ended = [np.zeros(words, np.int64), second.astype(np.int64)]  # the cheapest entry up to the first, up to the second
    best, left, right = np.full(words, np.iinfo(np.int64).max), np.zeros(words, np.int64), np.zeros(words, np.int64)
    every = np.arange(words)
    for k in (1, 2):
        apart = at[:, k] - at[:, k - 1] >= 2
        before = np.where(apart, ended[k - 1], 0 if k == 2 else -1)
        total = np.where(before >= 0, cost[every, before] + cost[:, k], np.iinfo(np.int64).max)
        win = total < best
        best[win], left[win], right[win] = total[win], before[win], k
    return inside, np.concatenate([three[every, left], three[every, right]]), last


def _entries(ranks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, lambda b: b.column(0), 1 << 20):
            texts = part.column(0)
            word, place, gram, sizes = bigrams(texts)
            inside, pivots, last = prefixes(word, place, gram, ranks, len(sizes))
            points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
            h, stop = prefix_hash(points), np.cumsum(sizes)
            start = stop - sizes
            mask = _mask(points, start, stop)
            for entries, pivot in ((pivots, True), (inside, False)):
                w = word[entries]
                at = start[w] + place[entries]
                # equal up to the end of the bigram, or from its beginning
                for side, code in enumerate((span_hash(h, start[w], at + 2), span_hash(h, at, stop[w]))):
                    own, low, high = (sizes[w] + d for d in (0, -1, 1))
                    every = np.ones(len(w), bool)
                    shared = [(own, every)] if pivot else [(low, every), (high, high // LENGTHS > low // LENGTHS)]
                    for size, new in shared:
                        lengths = mixed((size[new] // LENGTHS).astype(np.uint64) + np.uint64(1))
                        key = mixed(code[new] * np.uint64(4) + np.uint64(side) + lengths)
                        columns = [np.full(len(key), pivot), key.view(np.int64), last[w[new]], mask[w[new]].view(np.int64)]
                        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), texts.take(pa.array(w[new]))], ["pivot", "key", "last", "mask", "word"])

    return run


def _mask(points: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Of 64 kinds of characters, those that a word has an odd number of; one edit changes two at the most."""
    bit = np.uint64(1) << (mixed(points.astype(np.uint64)) & np.uint64(63))
    total = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(bit)])
    return total[stop] ^ total[start]


# --- the operator --------------------------------------------------------------------------------------------


def near_pairs(words: DataFrame, keep=materialize) -> DataFrame:
    """(a, b), a < b, of all near words; ``words`` has distinct strings in its column word."""
    long = words.where(F.length("word") >= 4).select("word")
    counts = long.mapInArrow(_gram_counts, "gram long, often long").groupBy("gram").agg(F.sum("often").alias("often"))
    told = counts.toArrow()  # 65,536 rows at the most
    often = np.zeros(GRAMS, np.int64)
    often[told.column(0).to_numpy()] = told.column(1).to_numpy()
    ranks = np.empty(GRAMS, np.int64)
    ranks[np.lexsort((np.arange(GRAMS), often))] = np.arange(GRAMS)
    entries = keep(long.mapInArrow(_entries(ranks), "pivot boolean, key long, last long, mask long, word string"), "spelling-entries")
    one = entries.where("pivot").select("key", F.col("last").alias("early"), F.col("mask").alias("mask_x"), F.col("word").alias("x"))
    two = entries.where("not pivot").select("key", F.col("last").alias("late"), F.col("mask").alias("mask_y"), F.col("word").alias("y"))
    likely = (F.col("early") <= F.col("late")) & (F.bit_count(F.col("mask_x").bitwiseXOR(F.col("mask_y"))) <= 2)
    met = one.join(two, "key").where(likely & (F.levenshtein("x", "y", 1) == 1))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def spelling_groups(words: DataFrame, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each row of ``words`` (word, n)."""
    keep = Workspace(words.sparkSession, "spelling")
    words = keep(words.select("word", F.col("n").cast("long").alias("n")), "words")
    pairs = keep(near_pairs(words, keep), "pairs")
    both = pairs.union(pairs.select("b", "a")).toDF("word", "other")
    told = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("m")), "other")
    # the largest count first, of equal ones the smallest word
    best = told.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("order"), "other", "m")).alias("best"))
    found = words.join(best, "word", "left")
    good = F.col("best.m") >= times * F.col("n")
    found = keep(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), *(F.when(good, F.col(f"best.{c}")).alias(a) for c, a in (("other", "form"), ("m", "form_n")))), "forms")
    up = found.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(ROUNDS):
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = keep(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not up.where("moved").limit(1).take(1):
            break
        up = up.drop("moved")
    out = found.join(up.select("word", "root"), "word", "left")
    out = materialize(out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "spelling-result")
    keep.close()
    return out
