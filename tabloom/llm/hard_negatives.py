"""Hard negatives by rotated one-bit codes.

Components become whole numbers, ``floor(scale * x)``. The index turns every vector by a fixed orthogonal matrix and keeps the signs as its code, together with the
vector's alignment with that code (its length along the unit vector of signs) and the length of what is left over. For an anchor, cut into bit planes, popcounts
give its product with a code; times the alignment that is an estimate of the inner product, and by Cauchy-Schwarz the left-over parts can't add more than the product of their lengths. So each
row has an interval that surely holds its score. Rows whose interval can't enter a result are passed over, and whole-number products score the others, so results are exact.

Anchors are read in blocks of at most ``block`` rows. Each block is sent to all tasks, and each task goes through its part of the index once for the positives and once for the negatives, keeping the
few best of each anchor; these meet by anchor. No pair of rows is shuffled but those.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take no part; missing components of shorter vectors are 0; rows that repeat an
id count once, with their smallest (label, vector); ties of scores go to the smaller id; an anchor without positives, or a positive without negatives, has no rows; scores beyond 63 bits count
as the ends of that range; an empty table gives an empty result; columns other than id, label and vector aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.workspace import Workspace
from tabloom.scratch import materialize

SCALE, POSITIVES, NEGATIVES, LEAST = 256, 5, 5, 80
#: Anchors that are sent to the tasks at once, rows that a task holds as numbers at once, anchors that these meet at once, rows of a part of the index.
BLOCK, ROWS, ANCHORS, PART = 16_384, 2_048, 512, 25_000
PLANES = 6
INDEX = "id long, label long, vec array<double>, code array<long>, align double, rest double, size double"
_LEAST_LONG = np.iinfo(np.int64).min


def whole_vectors(rows: DataFrame, id_col: str, label_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id, label, vec): rows that take part, one for each id, with whole components."""
    vec = F.transform(F.col(vec_col), lambda x: _floor(x.cast("double") * scale))
    found = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).alias("raw"), vec.alias("vec"))
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    found = found.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("raw").isNotNull() & finite).select("id", "label", "vec")
    if found.groupBy("id").count().where("count > 1").limit(1).take(1):
        found = found.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("x")).select("id", "x.label", "x.vec")
    return found


def _floor(x: Column) -> Column:
    """As a double, so that no size is cut off; doubles from 2^53 are whole anyway."""
    most = F.lit(np.finfo(np.float64).max.item())
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(F.greatest(F.least(x, most), -most))


def rotation(dims: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists as rows of ``dims`` numbers, filled up with 0."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), flat.dtype)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def pack_bits(bits: np.ndarray) -> np.ndarray:
    """Last axis as 64-bit words."""
    n = bits.shape[-1]
    padded = np.zeros((*bits.shape[:-1], -(-max(n, 1) // 64) * 64), bool)
    padded[..., :n] = bits
    return np.packbits(padded, axis=-1).view(np.uint64)


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, ...]:
    """(code, align, rest, size) of each vector."""
    with np.errstate(all="ignore"):  # what overflows makes intervals that hold everything
        turned = x @ turn
        size = np.sqrt((x * x).sum(axis=1))
        align = np.abs(turned).sum(axis=1) / math.sqrt(max(1, x.shape[1]))
        return pack_bits(turned > 0), align, np.sqrt(np.maximum(0, size * size - align * align)), size


def _indexed(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dims)
        for batch in batches:
            x = matrix(batch.column(2), dims)
            code, align, rest, size = encode(x, turn)
            words = code.shape[1]
            codes = pa.ListArray.from_arrays(pa.array(np.arange(0, len(code) * words + 1, words, dtype=np.int32)), pa.array(code.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, codes, pa.array(align), pa.array(rest), pa.array(size)], ["id", "label", "vec", "code", "align", "rest", "size"])

    return run


class Anchors:
    """A block of anchors, ready to meet codes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray):
        self.ids, self.labels, self.vecs, self.dims = ids, labels, vecs, vecs.shape[1]
        np.seterr(all="ignore")
        turned = vecs @ rotation(self.dims)
        self.low = turned.min(axis=1, initial=0)
        self.step = np.maximum((turned.max(axis=1, initial=0) - self.low) / (2**PLANES - 1), 1e-300)
        level = np.nan_to_num(np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, 2**PLANES - 1))
        self.off = np.sqrt(((turned - self.low[:, None] - level * self.step[:, None]) ** 2).sum(axis=1))
        self.levels = level.sum(axis=1)
        self.planes = [pack_bits((level.astype(np.int64) >> j & 1).astype(bool)) for j in range(PLANES)]
        self.size = np.sqrt((vecs * vecs).sum(axis=1))

    def interval(self, at: np.ndarray, code: np.ndarray, align: np.ndarray, rest: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(low, high) by row and anchor: the score is between them."""
        ones = np.zeros((len(code), len(at)))
        for j, plane in enumerate(self.planes):
            for w in range(code.shape[1]):
                ones += np.bitwise_count(code[:, w, None] & plane[None, at, w]).astype(np.float64) * (1 << j)
        count = np.bitwise_count(code).sum(axis=1)[:, None]
        along = (self.low[at] * (2.0 * count - self.dims) + self.step[at] * (2 * ones - self.levels[at])) / math.sqrt(max(1, self.dims))
        # what a code's direction leaves of the anchor, at the most
        across = np.sqrt(np.maximum(0, self.size[at] ** 2 - np.maximum(0, np.abs(along) - self.off[at]) ** 2))
        middle = align[:, None] * along
        most = align[:, None] * self.off[at] + rest[:, None] * across + 1e-6 * (size[:, None] * self.size[at] + 1)
        return middle - most, middle + most


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of whole vectors, by row and anchor, as 64-bit numbers."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * max(1, x.shape[1])
    if most < 2.0**53:
        return (x @ y.T).astype(np.int64)
    if most < 2.0**62:
        return x.astype(np.int64) @ y.astype(np.int64).T
    large = [[int(v) for v in row] for row in x.tolist()]
    other = [[int(v) for v in row] for row in y.tolist()]
    low, high = -(1 << 63) + 1, (1 << 63) - 1  # the least number is the mark of none
    return np.array([[min(high, max(low, sum(a * b for a, b in zip(p, q, strict=True)))) for q in other] for p in large], np.int64).reshape(len(x), len(y))


def best_of(score: np.ndarray, ids: np.ndarray, good: np.ndarray, old_score: np.ndarray, old_ids: np.ndarray) -> None:
    """Puts the best of the good (row, anchor) scores, highest first and then smallest id, into the lists of shape (anchor, k)."""
    k = old_score.shape[1]
    shown = np.where(good, score, _LEAST_LONG)
    take = min(k, len(ids))
    if len(ids) > 4 * k:  # only rows of the k best scores of an anchor, ties with the last included
        edge = np.partition(shown, len(ids) - k, axis=0)[len(ids) - k]
        rows = np.flatnonzero((good & (shown >= edge)).any(axis=1))
        shown, ids = shown[rows], ids[rows]
        take = min(k, len(ids))
    order = np.argsort(ids, kind="stable")
    shown, ids = shown[order], ids[order]
    # the smaller of two's complements sorts highest first; equal scores stay in order of id
    first = np.argsort(~shown, axis=0, kind="stable")[:take]
    score_of = np.concatenate([old_score, np.take_along_axis(shown, first, axis=0).T], axis=1)
    id_of = np.concatenate([old_ids, ids[first].T], axis=1)
    order = np.lexsort((id_of, ~score_of), axis=1)[:, :k]
    old_score[:] = np.take_along_axis(score_of, order, axis=1)
    old_ids[:] = np.take_along_axis(id_of, order, axis=1)


def _parts(batches: Iterator[pa.RecordBatch], dims: int):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            b = batch.slice(at, ROWS)
            code = matrix(b.column(3), -(-max(1, dims) // 64)).view(np.uint64)
            yield b.column(0).to_numpy(), b.column(1).to_numpy(), matrix(b.column(2), dims), code, *(b.column(k).to_numpy() for k in (4, 5, 6))


def _positives(block: tuple, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = Anchors(*block)
        score, found = np.full((len(a.ids), k), _LEAST_LONG), np.zeros((len(a.ids), k), np.int64)
        for ids, labels, vecs, *rest in _parts(batches, a.dims):
            for label in np.intersect1d(np.unique(labels), a.labels):
                rows, every = np.flatnonzero(labels == label), np.flatnonzero(a.labels == label)
                for at in np.array_split(every, -(-len(every) // ANCHORS)):
                    _, high = a.interval(at, *(r[rows] for r in rest))
                    likely = ~(high < score[at, -1].astype(np.float64)) & (ids[rows][:, None] != a.ids[at])
                    some = np.flatnonzero(likely.any(axis=1))
                    if len(some):
                        top, top_ids = score[at], found[at]
                        best_of(products(vecs[rows[some]], a.vecs[at]), ids[rows[some]], likely[some], top, top_ids)
                        score[at], found[at] = top, top_ids
        i, j = np.nonzero(score > _LEAST_LONG)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a.ids[i], found[i, j], score[i, j])], ["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(block: tuple, scores: np.ndarray, k: int, least: int):
    """``scores``: those of each anchor's positives, by anchor and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = Anchors(*block)
        places = scores.shape[1]
        low = np.array([[_LEAST_LONG if p == _LEAST_LONG else -(-least * p // 100) for p in row] for row in scores.tolist()], np.int64).reshape(scores.shape)
        none = (scores == _LEAST_LONG) | (low > scores)
        score, found = np.full((places, len(a.ids), k), _LEAST_LONG), np.zeros((places, len(a.ids), k), np.int64)
        open_ = np.flatnonzero(~none.all(axis=1))
        upper = np.where(none, _LEAST_LONG, scores).max(axis=1, initial=_LEAST_LONG)
        for ids, labels, vecs, *rest in _parts(batches, a.dims) if len(open_) else ():
            for at in np.array_split(open_, -(-len(open_) // ANCHORS)):
                # a place needs its lower limit, or its last negative so far if that is higher
                need = np.where(none[at], np.iinfo(np.int64).max, np.maximum(low[at], score[:, at, -1].T)).min(axis=1)
                least_high, most = a.interval(at, *rest)
                likely = ~(most < need.astype(np.float64)) & ~(least_high > upper[at].astype(np.float64)) & (labels[:, None] != a.labels[at])
                some = np.flatnonzero(likely.any(axis=1))
                if not len(some):
                    continue
                scored, sure = products(vecs[some], a.vecs[at]), likely[some]
                for s in range(places):
                    good = sure & (scored <= scores[at, s]) & (scored >= np.where(none[at, s], np.iinfo(np.int64).max, low[at, s])) & ~none[at, s]
                    rows = np.flatnonzero(good.any(axis=1))
                    if len(rows):
                        top, top_ids = score[s, at], found[s, at]
                        best_of(scored[rows], ids[some[rows]], good[rows], top, top_ids)
                        score[s, at], found[s, at] = top, top_ids
        s, i, j = np.nonzero(score > _LEAST_LONG)
        yield pa.RecordBatch.from_arrays([pa.array(a.ids[i]), pa.array(s.astype(np.int32)), pa.array(found[s, i, j]), pa.array(score[s, i, j])], ["anchor_id", "place", "negative_id", "negative_score"])

    return run


def _first(df: DataFrame, keys: list[str], score: str, other: str, k: int, rank: str) -> DataFrame:
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), other)))
    return ranked.where(F.col(rank) <= k)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vec_col: str = "embedding",
    scale: float = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    block: int = BLOCK,
    part: int = PART,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on the column ``id``. A negative has another label and a score from ``least`` hundredths of the positive's up to the positive's.
    """
    spark = rows.sparkSession
    keep = Workspace(spark, "hard-negatives")
    known = whole_vectors(rows, id_col, label_col, vec_col, scale)
    facts = known.agg(F.max(F.size("vec")).alias("dims"), F.count("*").alias("n"), F.count(F.when(anchors, 1)).alias("anchors")).first()
    dims = facts.dims or 0
    index = keep(known.repartition(max(1, -(-facts.n // part))).mapInArrow(_indexed(dims), INDEX), "index")
    blocks = max(1, -(-facts.anchors // block))
    mine = index.where(anchors).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).select("block", "id", "label", "vec")
    if blocks > 1:
        mine = keep(mine, "anchors")
    out = []
    for b in range(blocks):
        got = mine.where(F.col("block") == b).orderBy("id").toArrow()  # about ``block`` rows
        if not got.num_rows:
            continue
        held = (got.column("id").to_numpy(), got.column("label").to_numpy(), matrix(got.column("vec").combine_chunks(), dims))
        near = index.mapInArrow(_positives(held, positives), "anchor_id long, positive_id long, positive_score long")
        near = keep(_first(near, ["anchor_id"], "positive_score", "positive_id", positives, "place").withColumn("place", F.col("place") - 1), "positives")
        told = near.select("anchor_id", "place", "positive_score").toArrow()  # ``positives`` for each of the block
        scores = np.full((got.num_rows, positives), _LEAST_LONG)
        scores[np.searchsorted(held[0], told.column(0).to_numpy()), told.column(1).to_numpy()] = told.column(2).to_numpy()
        far = index.mapInArrow(_negatives(held, scores, negatives, least), "anchor_id long, place int, negative_id long, negative_score long")
        far = _first(far, ["anchor_id", "place"], "negative_score", "negative_id", negatives, "rank")
        met = far.join(near, ["anchor_id", "place"])
        out.append(keep(met.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"), "found"))
    if not out:
        keep.close()
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    result = materialize(result, "hard-negatives-result")
    keep.close()
    return result
