"""Language identification by a linear-chain conditional random field over words.

Each word gets scores from character n-grams of two to four characters (those at the word's edges are its affixes) and from a learned lexicon; learned
transitions say how often the language changes from one word to the next. Forward-backward gives every word its
probabilities, so passages in another language inside a text are told apart, and their mean is the document's prediction.

Learning takes a bounded sample: at most ``docs_per_language`` documents of each language (about that number, by hash) and
``spans_per_doc`` spans from all over each. Training sequences join spans of random languages, which is where transitions are learned from.
Prediction reads whole texts. Long texts are cut into lanes of ``LANE`` words whose transfer matrices are chained first, so the
result is that of one pass over the whole text and steps don't grow with its length.

Defined cases: a null text or one without a letter is ``und`` with score 0; so is every text where nothing could be learned; rows without a
language or an id don't teach; with one language every word has it; ties go to the first language in alphabetical order; invalid
UTF-8 is read with replacement characters; input columns pass through inside the struct ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.llm.arrays import mixed, portions, prefix_hash, span_hash, text_bytes

BITS = 18  # n-gram weights are kept in 2^BITS places
GRAMS = (2, 3, 4)
LANE = 64
SPAN = 32  # words of a training sequence
LONGEST = 40  # characters of a word there
UNKNOWN = "und"

_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for all else."""
    if "letters" not in _tables:
        out = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _tables["letters"] = out
    return _tables["letters"]


def letter_stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as lower-case letters with 0 for anything else and a 0 after each text; n + 1 offsets."""
    body, offsets = text_bytes(column)
    n = len(column)
    try:
        points = np.frombuffer(body.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        leads = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
        sizes = np.diff(leads[offsets])
    except UnicodeDecodeError:
        raw = body.tobytes()
        parts = [raw[a:b].decode("utf-8", "replace").encode("utf-32-le") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        points = np.frombuffer(b"".join(parts), np.uint32)
        sizes = np.array([len(p) // 4 for p in parts], np.int64)
    out = np.zeros(len(points) + n + 1, np.uint32)  # begins with a 0 as well
    out[np.arange(len(points)) + np.repeat(np.arange(1, n + 1), sizes)] = _letters()[points]
    return out, np.concatenate([[0], np.cumsum(sizes + 1)])


@dataclass
class Words:
    """Words of a stream: where they stand, their texts' offsets among them, and their hashes."""

    start: np.ndarray
    stop: np.ndarray
    offsets: np.ndarray
    code: np.ndarray


def words_of(stream: np.ndarray, offsets: np.ndarray) -> Words:
    solid = stream != 0
    start = np.flatnonzero(solid[1:] & ~solid[:-1]) + 1
    stop = np.flatnonzero(~solid[1:] & solid[:-1]) + 1
    code = mixed(span_hash(prefix_hash(stream), start, stop))
    return Words(start, stop, np.searchsorted(start, offsets + 1), code)


def grams_of(stream: np.ndarray, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: place in the weight table of every n-gram of every word, and the first one of each word that has any, as (places, words)."""
    solid = stream != 0
    word = np.cumsum(np.concatenate([[False], solid[1:] & ~solid[:-1]])) - 1  # of the letter at, or last before, a position
    wide = stream.astype(np.uint64)
    code, inner = wide, np.ones(len(stream), bool)
    for n in range(2, max(GRAMS) + 1):
        code = code[:-1] * np.uint64(0x100000001B3) + wide[n - 1 :]
        inner = inner[:-1] & solid[n - 2 : len(stream) - 1] if n > 2 else np.ones(len(stream) - 1, bool)
        if n not in GRAMS:
            continue
        good = inner & (solid[:-1] | solid[1:] if n == 2 else True)
        at = np.flatnonzero(good)
        places = (mixed(code[at] + np.uint64(n << 56)) >> np.uint64(64 - BITS)).astype(np.int64)
        yield places, word[at + 1] if n > 2 else np.where(solid[at], word[at], word[at + 1])


@dataclass
class LanguageModel:
    """Weights of n-grams and lexicon words by language, and log potentials of transitions."""

    languages: list[str]
    grams: np.ndarray
    lexicon: np.ndarray
    lexicon_weights: np.ndarray
    bias: np.ndarray
    transitions: np.ndarray

    def scores(self, stream: np.ndarray, words: Words) -> np.ndarray:
        """Log potentials of all words."""
        out = np.tile(self.bias, (len(words.start), 1)).astype(np.float32)
        if not len(out):
            return out
        for places, word in grams_of(stream, words):
            if len(word):
                first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                out[word[first]] += np.add.reduceat(self.grams[places], first, axis=0)
        if len(self.lexicon):
            at = np.minimum(np.searchsorted(self.lexicon, words.code), len(self.lexicon) - 1)
            known = self.lexicon[at] == words.code
            out[known] += self.lexicon_weights[at[known]]
        return out

    def marginals(self, scores: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities of each word's languages given its whole text."""
        scores = scores.astype(np.float64)
        potential = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -200.0))
        return forward_backward(potential, np.exp(self.transitions), offsets)


def forward_backward(potential: np.ndarray, step: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marginals of chains that lie one after another; ``offsets`` tell where each begins."""
    n, k = potential.shape
    if n == 0:
        return potential
    sizes = np.diff(offsets)
    lanes = -(-sizes // LANE)
    chain = np.repeat(np.arange(len(sizes)), lanes)
    number = np.arange(len(chain)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    start = offsets[chain] + number * LANE
    length = np.minimum(LANE, offsets[chain + 1] - start)
    order = np.argsort(-length, kind="stable")
    begin, length = start[order], length[order]
    longest = int(length[0])
    active = np.searchsorted(-length, -np.arange(longest), "left")  # lanes longer than t
    # transfer matrix of each lane
    matrix = np.tile(np.eye(k), (len(order), 1, 1))
    for t in range(longest):
        a = active[t]
        moved = (matrix[:a].reshape(-1, k) @ step).reshape(a, k, k) * potential[begin[:a] + t][:, None, :]
        matrix[:a] = moved / moved.max(axis=(1, 2), keepdims=True)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    # messages between the lanes of a chain
    enter, leave = np.empty((len(order), k)), np.empty((len(order), k))
    head = np.cumsum(lanes) - lanes
    live = np.flatnonzero(lanes)
    message = np.full((len(live), k), 1.0 / k)
    for j in range(int(lanes.max())):
        stay = lanes[live] > j
        live, message = live[stay], message[stay]
        lane = back[head[live] + j]
        enter[lane] = message
        message = np.einsum("ni,nij->nj", message, matrix[lane])
        message /= message.sum(axis=1, keepdims=True)
    live = np.flatnonzero(lanes)
    message = np.full((len(live), k), 1.0)
    for j in range(int(lanes.max())):
        stay = lanes[live] > j
        live, message = live[stay], message[stay]
        lane = back[head[live] + lanes[live] - 1 - j]
        leave[lane] = message
        message = np.einsum("nij,nj->ni", matrix[lane], message)
        message /= message.sum(axis=1, keepdims=True)
    out = np.empty_like(potential)
    message = enter
    for t in range(longest):
        a = active[t]
        message[:a] = (message[:a] @ step) * potential[begin[:a] + t]
        message[:a] /= message[:a].sum(axis=1, keepdims=True)
        out[begin[:a] + t] = message[:a]
    message = leave
    for t in reversed(range(longest)):
        a = active[t]
        at = begin[:a] + t
        seen = out[at] * message[:a]
        out[at] = seen / seen.sum(axis=1, keepdims=True)
        message[:a] = (message[:a] * potential[at]) @ step.T
        message[:a] /= message[:a].sum(axis=1, keepdims=True)
    return out


# --- learning -------------------------------------------------------------------------------------------------


def teaching_spans(docs: DataFrame, docs_per_language: int = 250, spans_per_doc: int = 12, id_col="doc_id", text_col="text", lang_col="lang") -> dict[str, list[str]]:
    """Spans of up to SPAN words by language, from about ``docs_per_language`` documents of each.

    Longer runs without a space count as words of LONGEST characters each, rows that repeat id and text as one document. A language
    gets ``2 * docs_per_language * spans_per_doc`` spans at the most, and no more than these leave the executors.
    """
    usable = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    usable = usable.where("id is not null and text is not null and lang is not null")
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"))  # reads no texts
    draw = F.pmod(F.xxhash64(F.lit(17), "id", "text"), F.lit(1 << 30)) / float(1 << 30)
    drawn = usable.join(F.broadcast(counts), "lang").where(draw < docs_per_language / F.col("n"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, ids, spans = [], [], []
            for lang, i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                w = [run[at : at + LONGEST] for run in text.split() for at in range(0, len(run), LONGEST)]
                starts = sorted({int(s) for s in np.linspace(0, max(0, len(w) - SPAN), spans_per_doc)})
                for s in starts:
                    langs.append(lang), ids.append(i), spans.append(" ".join(w[s : s + SPAN]))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(ids, pa.int64()), pa.array(spans, pa.string())], ["lang", "id", "span"])

    rows = drawn.select("lang", F.xxhash64("id", "text").alias("id"), "text").mapInArrow(cut, "lang string, id long, span string").distinct()
    number = F.row_number().over(Window.partitionBy("lang").orderBy("id", "span"))
    rows = rows.withColumn("number", number).where(F.col("number") <= 2 * docs_per_language * spans_per_doc)
    out = {}
    for r in sorted(rows.collect(), key=lambda r: (r.lang, r.number)):
        out.setdefault(r.lang, []).append(r.span)
    return out


def fit_language(spans: dict[str, list[str]], sequences: int = 4000, epochs: int = 3, rate: float = 0.3, decay: float = 1e-5, seed: int = 5) -> LanguageModel | None:
    """Conditional maximum likelihood by AdaGrad on sequences of joined spans."""
    rng = np.random.default_rng(seed)
    languages = sorted(spans)
    k = len(languages)
    # all words of all spans as one stream, by language
    column = pa.array([s for lang in languages for s in spans[lang]])
    stream, offsets = letter_stream(column)
    words = words_of(stream, offsets)
    n_words = np.diff(words.offsets)
    lang_of_span = np.repeat(np.arange(k), [len(spans[x]) for x in languages])
    usable = [np.flatnonzero((lang_of_span == c) & (n_words > 0)) for c in range(k)]
    present = [c for c in range(k) if len(usable[c])]
    if not present:
        return None
    languages = [languages[c] for c in present]
    usable, k = [usable[c] for c in present], len(present)
    # features of each word: its n-gram places and, if it is in the lexicon, its lexicon place
    values, times = np.unique(words.code, return_counts=True)
    lexicon = values[times >= 3]
    places, owners = [], []
    for p, w in grams_of(stream, words):
        places.append(p), owners.append(w)
    at = np.minimum(np.searchsorted(lexicon, words.code), max(len(lexicon) - 1, 0))
    known = np.flatnonzero(lexicon[at] == words.code) if len(lexicon) else np.zeros(0, np.int64)
    places.append(at[known] + (1 << BITS)), owners.append(known)
    places, owners = np.concatenate(places), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    places = places[order]
    first = np.searchsorted(owners[order], np.arange(len(words.start) + 1))
    # sequences of word numbers and their labels
    chosen, labels = np.empty((sequences, SPAN), np.int64), np.empty((sequences, SPAN), np.int64)
    for s in range(sequences):
        breaks = sorted(rng.choice(np.arange(1, SPAN), size=rng.choice(3, p=[0.6, 0.3, 0.1]), replace=False).tolist())
        at = 0
        for upto in [*breaks, SPAN]:
            c = rng.integers(k)
            while at < upto:
                span = usable[c][rng.integers(len(usable[c]))]
                n = min(upto - at, n_words[span])
                lo = words.offsets[span] + rng.integers(n_words[span] - n + 1)
                chosen[s, at : at + n], labels[s, at : at + n] = np.arange(lo, lo + n), c
                at += n
    weights = np.zeros(((1 << BITS) + len(lexicon), k))
    bias, transitions = np.zeros(k), np.zeros((k, k))
    gains = [np.full(x.shape, 1e-2) for x in (weights, bias, transitions)]
    batch = 64
    for _ in range(epochs):
        mixed_up = rng.permutation(sequences)
        for lo in range(0, sequences, batch):
            part = mixed_up[lo : lo + batch]
            word, label = chosen[part], labels[part]
            flat = word.ravel()
            count = first[flat + 1] - first[flat]
            owner = np.repeat(np.arange(len(flat)), count)
            index = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[flat], count)
            used = places[index]
            score = np.zeros((len(flat), k))
            for c in range(k):
                score[:, c] = np.bincount(owner, weights[used, c], len(flat)) + bias[c]
            post, pairs = _expected(score.reshape(*word.shape, k), transitions)
            truth = np.eye(k)[label]
            gap = (truth - post).reshape(-1, k)
            told = np.zeros((k, k))
            np.add.at(told, (label[:, :-1].ravel(), label[:, 1:].ravel()), 1)
            rows, back = np.unique(used, return_inverse=True)
            step = np.column_stack([np.bincount(back, gap[owner, c], len(rows)) for c in range(k)]) - decay * len(flat) * weights[rows]
            for x, g, d, at in ((weights, gains[0], step, rows), (bias, gains[1], gap.sum(axis=0), slice(None)), (transitions, gains[2], told - pairs, slice(None))):
                d = d / len(part)
                g[at] += d * d
                x[at] += rate * d / np.sqrt(g[at])
    return LanguageModel(languages, weights[: 1 << BITS].astype(np.float32), lexicon, weights[1 << BITS :].astype(np.float32), bias, transitions)


def _expected(score: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of equally long chains and the expected number of each transition."""
    s, n, k = score.shape
    potential = np.exp(score - score.max(axis=2, keepdims=True))
    step = np.exp(transitions)
    ahead, behind = np.empty_like(potential), np.ones_like(potential)
    ahead[:, 0] = step.sum(axis=0) * potential[:, 0]
    ahead[:, 0] /= ahead[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, n):
        ahead[:, t] = (ahead[:, t - 1] @ step) * potential[:, t]
        ahead[:, t] /= ahead[:, t].sum(axis=1, keepdims=True)
    pairs = np.zeros((k, k))
    for t in range(n - 2, -1, -1):
        right = potential[:, t + 1] * behind[:, t + 1]
        both = ahead[:, t][:, :, None] * step * right[:, None, :]
        pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        behind[:, t] = right @ step.T
        behind[:, t] /= behind[:, t].sum(axis=1, keepdims=True)
    post = ahead * behind
    return post / post.sum(axis=2, keepdims=True), pairs


# --- prediction ------------------------------------------------------------------------------------------------

RESULT = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "passages",
            T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("first_word", T.LongType()), T.StructField("words", T.LongType())])),
        ),
    ]
)


def identify(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", passages: bool = True) -> DataFrame:
    """(row, found): language, score (mean probability of its words) and the passages of equal word labels, of every row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).cast("string").alias("text"))
    out = T.StructType([rows.schema["row"], T.StructField("found", RESULT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, lambda b: b.column(1)):
            n = part.num_rows
            names = np.array([*(model.languages if model else []), UNKNOWN], object)
            best, score, runs = np.full(n, len(names) - 1), np.zeros(n), [[] for _ in range(n)] if passages else [None] * n
            if model:
                stream, offsets = letter_stream(part.column(1))
                words = words_of(stream, offsets)
                chance = model.marginals(model.scores(stream, words), words.offsets)
                sizes = np.diff(words.offsets)
                total = np.concatenate([np.zeros((1, len(names) - 1)), np.cumsum(chance, axis=0)])[words.offsets]
                mean = np.diff(total, axis=0) / np.maximum(sizes, 1)[:, None]
                have = sizes > 0
                best[have] = mean[have].argmax(axis=1)
                score[have] = np.clip(mean[have].max(axis=1), 0, 1)
                if passages:
                    runs = _passages(chance.argmax(axis=1), words.offsets, names)
            found = pa.StructArray.from_arrays(
                [pa.array(names[best], pa.string()), pa.array(score), pa.array(runs, pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("words", pa.int64())])))],
                ["lang", "score", "passages"],
            )
            yield pa.RecordBatch.from_arrays([part.column(0), found], ["row", "found"])

    return rows.mapInArrow(run, out)


def _passages(label: np.ndarray, offsets: np.ndarray, names: np.ndarray) -> list[list[dict]]:
    edge = np.ones(len(label) + 1, bool)
    edge[1:-1] = label[1:] != label[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    out, of = [[] for _ in range(len(offsets) - 1)], np.searchsorted(offsets, cuts, "right") - 1
    for d, a, b in zip(of[:-1].tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        out[d].append({"lang": names[label[a]], "first_word": a - int(offsets[d]), "words": b - a})
    return out


def learns(doc_id: Column) -> Column:
    """Documents that may teach: crc32 of the id as text doesn't leave 2 when divided by 4."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 4 != 2, F.lit(False))
