"""Quality classifier: regularised quadratic discriminant over document statistics.

A pass over whole texts turns each into transformed statistics. Class means and covariances come from all labelled rows
by one aggregation; each covariance is shrunk towards the pooled one and towards its own mean variance. Its Cholesky factor is
computed once and the score is the logistic function of the difference of the Mahalanobis log densities, as plain
column arithmetic.

Defined cases: null and empty texts have the statistics of an empty document and get a score; null or other labels are
left out; several labels of one document all count; without rows of label 0 nothing speaks against a document and the score is 1;
without rows of label 1 alone it is 0; a class with one row takes the pooled covariance; other columns pass through
inside the struct ``row``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.llm.arrays import mixed, portions, prefix_hash, span_hash, text_bytes

NAMES = ("words", "word_chars", "word_spread", "symbols", "upper", "digits", "shouts", "repeats", "variety", "line_chars", "points", "common")
KEEP_FROM = 0.7  # score from which a document counts as label 1
SMALL = 1e-3  # smallest share that counts
STEADY = 30.0  # what shares of short texts are divided by in addition

#: Kinds of bytes.
OTHER, LOWER, UPPER, DIGIT, SPACE, BREAK, POINT, SHOUT, LEAD, TRAIL = range(10)
KIND = np.zeros(256, np.uint8)
KIND[ord("a") : ord("z") + 1] = LOWER
KIND[ord("A") : ord("Z") + 1] = UPPER
KIND[ord("0") : ord("9") + 1] = DIGIT
KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = SPACE
KIND[0x0A] = BREAK
KIND[[ord(c) for c in ".,;:'\"()?-"]] = POINT
KIND[ord("!")] = SHOUT
KIND[0x80:0xC0] = TRAIL
KIND[0xC0:] = LEAD


def document_statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text."""
    body, offsets = text_bytes(texts)
    n = len(texts)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    kind = KIND[body]
    counts = np.bincount(doc * 10 + kind, minlength=10 * n).reshape(n, 10).astype(float)
    chars = counts.sum(axis=1) - counts[:, TRAIL]
    letters = counts[:, LOWER] + counts[:, UPPER] + counts[:, LEAD]
    # words: runs between white space, within a document
    inside = (kind != SPACE) & (kind != BREAK)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (doc[1:] != doc[:-1])
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | (doc[1:] != doc[:-1])
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    of = doc[start]
    words = np.bincount(of, minlength=n).astype(float)
    code = mixed(span_hash(prefix_hash(body), start, stop))
    same = np.zeros(len(code), bool)
    same[1:] = (code[1:] == code[:-1]) & (of[1:] == of[:-1])
    repeats = np.bincount(of[same], minlength=n).astype(float)
    shift = np.uint64(max(1, int(n).bit_length()))  # document in the high bits, hash below
    key = np.sort((of.astype(np.uint64) << (np.uint64(64) - shift)) | (code >> shift))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    owner = (key[first] >> (np.uint64(64) - shift)).astype(np.int64)
    variety = np.bincount(owner, minlength=n).astype(float)
    most = np.zeros(n)
    np.maximum.at(most, owner, np.diff(np.append(first, len(key))).astype(float))
    size = (stop - start).astype(float)
    total, squares = np.bincount(of, size, n), np.bincount(of, size * size, n)
    mean = total / np.maximum(words, 1)
    spread = np.sqrt(np.maximum(squares / np.maximum(words, 1) - mean * mean, 0))
    share = lambda part, whole: np.log(SMALL + part / (whole + STEADY))
    return np.column_stack(
        [
            np.log(words + STEADY), np.log1p(mean), np.log1p(spread), share(counts[:, OTHER], chars), share(counts[:, UPPER], letters),
            share(counts[:, DIGIT], chars), share(counts[:, SHOUT], chars), share(repeats, words),
            np.log1p(variety) / np.log1p(np.maximum(words, 1)), np.log(chars / (counts[:, BREAK] + 1) + 100), share(counts[:, POINT], chars),
            share(most, words),
        ]
    )


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, stats): each input row as a struct, and its statistics as an array."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    inside = isinstance(docs.schema[text_col].dataType, T.StringType) and docs.columns.index(text_col)  # texts travel once
    rows = docs.select(whole) if inside is not False else docs.select(whole, F.col(text_col).cast("string").alias("text"))
    out = T.StructType([rows.schema["row"], T.StructField("stats", T.ArrayType(T.DoubleType()))])
    text_of = lambda b: b.column(1) if inside is False else b.column(0).field(inside)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, text_of, 1 << 20):
            stats = document_statistics(text_of(part))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, stats.size + 1, stats.shape[1], dtype=np.int32)), pa.array(stats.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), flat], ["row", "stats"])

    return rows.mapInArrow(run, out)


@dataclass
class QualityModel:
    """Means, inverse Cholesky factors and log constants of both classes; ``only`` is the score where a class is missing."""

    means: np.ndarray | None = None
    whiten: np.ndarray | None = None
    constants: tuple[float, float] | None = None
    only: float | None = None

    def score(self, stats: Column) -> Column:
        """Probability of label 1."""
        if self.only is not None:
            return F.lit(self.only)
        logs = []
        for c in (0, 1):
            centred = [F.get(stats, F.lit(j)) - float(m) for j, m in enumerate(self.means[c])]
            total = F.lit(0.0)
            for i, line in enumerate(self.whiten[c]):
                z = sum((centred[j] * float(line[j]) for j in range(1, i + 1)), centred[0] * float(line[0]))
                total = total + z * z
            logs.append(F.lit(self.constants[c]) - total * 0.5)
        gap = F.greatest(F.least(logs[1] - logs[0], F.lit(500.0)), F.lit(-500.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-gap))


def fit_quality(stats: DataFrame, labels: DataFrame, pooled: float = 0.3, ridge: float = 0.05) -> QualityModel:
    """``stats`` (id, stats) meets ``labels`` (id, label 0 or 1). All labelled rows count; the driver gets one row of sums per class."""
    d = len(NAMES)
    marked = stats.join(labels.where("id is not null and label in (0, 1)"), "id")
    x = [F.get("stats", F.lit(i)) for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    wide = marked.select("label", *[c.alias(f"x{i}") for i, c in enumerate(x)])
    sums = wide.groupBy("label").agg(
        F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(d)], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs]
    )
    found = {int(r.label): r for r in sums.collect()}
    if 0 not in found:
        return QualityModel(only=1.0)
    if 1 not in found:
        return QualityModel(only=0.0)
    means, scatter, n = np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2)
    for c, r in found.items():
        n[c] = r.n
        means[c] = [r[f"s{i}"] / r.n for i in range(d)]
        for i, j in pairs:
            scatter[c, i, j] = scatter[c, j, i] = r[f"p{i}_{j}"] - r.n * means[c, i] * means[c, j]
    together = scatter.sum(axis=0) / max(n.sum() - 2, 1)
    whiten, constants = np.zeros((2, d, d)), []
    for c in (0, 1):
        own = scatter[c] / (n[c] - 1) if n[c] > 1 else together
        cov = (1 - pooled) * own + pooled * together
        cov = (1 - ridge) * cov + ridge * (np.trace(cov) / d + 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(cov)
        whiten[c] = np.linalg.inv(factor)
        constants.append(float(np.log(n[c] / n.sum()) - np.log(np.diag(factor)).sum()))
    return QualityModel(means, whiten, (constants[0], constants[1]))


def held_out(doc_id: Column) -> Column:
    """Documents that take no part in learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 4 == 2, F.lit(False))
