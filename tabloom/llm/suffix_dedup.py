"""Removal of passages that a document with a smaller id has too, by a hash-compared suffix sort.

A passage counts from ``window`` bytes on: every byte covered by a ``window``-byte string that also starts in a document with a smaller
id goes. Strings are compared where they can meet: each window belongs to its smallest hashed k-gram (its anchor), which depends on the window's
bytes alone, and neighbouring windows with one anchor travel as one fragment. Fragments are dealt out by anchor. Anchors that very many different fragments have are
counted first; their windows travel one by one and are dealt out by a hash of the whole window, so no group holds all that is around a common phrase.

Where they meet, equal fragments fall together, and suffixes of the rest that may recur are sorted: a merge sort whose comparisons find the
common extension of two suffixes by binary search over prefix polynomial hashes, so a comparison takes a logarithmic number of steps.
Neighbours with a common extension of a whole window have their bytes compared, then the smallest id of each run of equal windows decides.

Before the shuffle a task drops fragments that a smaller id in the same portion has too (they are marked on the spot), so a passage that very
many documents share arrives once per portion instead of once per document. Marks are dealt out with the documents and applied to whole texts.

Defined cases: a null text is empty; texts shorter than the window have no window; a null id neither removes nor loses anything; rows with one id
don't remove from each other (with different texts they are told apart by a checksum); an empty table gives an empty result; only id and text are
read. Matches are of bytes, so what is kept may begin inside a character.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.llm.arrays import mixed, portions, powers, prefix_hash, release, span_hash, text_bytes

WINDOW = 50
#: Bytes of fragments that a task gathers before it sends them on, that one group and one sort are laid out for, of texts in one group, and of text cut at once.
FLUSH, GROUP, SORT, TEXTS, PORTION = 32 << 20, 24 << 20, 1 << 20, 4 << 20, 2 << 20
GROWTH = 3.6  # bytes of fragments per byte of text, about
#: Fragments of one anchor beyond which its windows are dealt one by one, and below which FLUSH bytes of text don't report an anchor.
HOT, SEEN = 16_384, 4
#: Bytes of text that are cut at once where windows may travel one by one, which takes many times as many bytes.
CROWDED = 1 << 18
#: Suffixes whose places are found at once.
PART = 1 << 15


def anchor_width(window: int) -> int:
    return max(1, window // 4)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    span = 1
    out = x
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return out if span == width else np.minimum(out[: len(x) - width + 1], out[width - span :][: len(x) - width + 1])


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions start[i] .. start[i] + size[i] - 1, one range after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


def gather(body: np.ndarray, start: np.ndarray, size: np.ndarray, most: int = 1 << 18) -> np.ndarray:
    """The bytes of many ranges one after the other, without an index as long as they are."""
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    lo = 0
    while lo < len(size):
        done = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + most, "right")))
        out[done : int(ends[hi - 1])] = body[spread(start[lo:hi], size[lo:hi])]
        lo = hi
    return out


def content_code(h: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mixed(span_hash(h, start, start + size) + size.astype(np.uint64))


def fragments(body: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, anchor, hash of the content) of the maximal stretches of windows with one anchor, within texts."""
    k = anchor_width(window)
    n = len(body)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = prefix_hash(body)
    grams = mixed((h[k:] - h[:-k]) * powers(n, True)[: n - k + 1])
    least = sliding_min(grams, window - k + 1)
    size = np.diff(offsets)
    tails = np.minimum(size, window - 1)  # the last window - 1 bytes of a text start no window
    whole = np.ones(n, bool)
    whole[spread(offsets[1:] - tails, tails)] = False
    whole = whole[: len(least)]
    new = whole.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~whole[:-1]
    heads = offsets[:-1][offsets[:-1] < len(least)]
    new[heads] = whole[heads]
    last = whole.copy()
    last[:-1] &= new[1:] | ~whole[1:]
    start, stop = np.flatnonzero(new), np.flatnonzero(last) + window
    return start, stop - start, least[start], content_code(h, start, stop - start)


def single_windows(body: np.ndarray, start, size, anchor, code, hot: np.ndarray, window: int):
    """Fragments with those of ``hot`` anchors (ascending) cut into their windows, which are dealt by a hash of all their bytes."""
    where = np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)
    crowded = hot[where] == anchor
    if not crowded.any():
        return start, size, anchor, code
    at = spread(start[crowded], size[crowded] - window + 1)
    length = np.full(len(at), window)
    own = content_code(prefix_hash(body), at, length)
    parts = ((start, at), (size, length), (anchor, mixed(own)), (code, own))
    return tuple(np.concatenate([x[~crowded], y]) for x, y in parts)


def same_bytes(body: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether body[a:a+size] and body[b:b+size] agree, for many pairs."""
    out = np.ones(len(a), bool)
    for lo in range(0, len(a), 20_000):
        part = slice(lo, lo + 20_000)
        differ = body[spread(a[part], size[part])] != body[spread(b[part], size[part])]
        pair = np.repeat(np.arange(len(size[part])), size[part])
        out[part] = np.bincount(pair[differ], minlength=len(size[part])) == 0
    return out


def classes_of(body: np.ndarray, start: np.ndarray, size: np.ndarray, code: np.ndarray) -> np.ndarray:
    """A number per fragment, the same for equal bytes only: equal hashes ``code`` whose bytes agree with those of the first."""
    order = np.argsort(code, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = code[order][1:] != code[order][:-1]
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.empty(len(order), np.int64)
    out[order] = first
    again = np.flatnonzero(out != np.arange(len(out)))
    wrong = again[(size[again] != size[out[again]]) | ~same_bytes(body, start[again], start[out[again]], np.minimum(size[again], size[out[again]]))]
    by_bytes: dict[bytes, int] = {}
    for i in wrong.tolist():  # a collision
        out[i] = by_bytes.setdefault(body[start[i] : start[i] + size[i]].tobytes(), i)
    return out


class SuffixOrder:
    """Suffixes of ``body`` compared up to ``depth`` bytes by prefix hashes."""

    def __init__(self, body: np.ndarray, h: np.ndarray, depth: int):
        self.body, self.h, self.depth = body, h, depth
        self.inverse = powers(len(body), True)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes i and j, at most ``depth``, by binary search."""
        known = np.zeros(len(i), np.int64)
        hi, hj, vi, vj = self.h[i], self.h[j], self.inverse[i], self.inverse[j]
        step = 1 << (self.depth.bit_length() - 1)
        while step:
            more = known + step
            more_ok = more <= self.depth
            t = np.where(more_ok, more, 0)
            equal = (self.h[i + t] - hi) * vi == (self.h[j + t] - hj) * vj
            known = np.where(more_ok & equal, more, known)
            step >>= 1
        return known

    def above(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as suffix i comes before, equals or comes after suffix j within ``depth`` bytes."""
        n = self.extension(i, j)
        last = np.minimum(n, self.depth - 1)
        order = np.sign(self.body[i + last].astype(np.int16) - self.body[j + last].astype(np.int16))
        return np.where(n >= self.depth, 0, order)

    def sort(self, at: np.ndarray) -> np.ndarray:
        """Merge sort of all segments with equal leading bytes at once."""
        lead = min(8, self.depth)
        key = np.zeros(len(at), np.uint64)
        for b in range(lead):
            key = (key << np.uint64(8)) | self.body[at + b].astype(np.uint64)
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        length = np.bincount(head, minlength=len(at))[head]
        most, run = int(length.max(initial=0)), 1
        while run < most:
            live = np.flatnonzero(length > run)
            moved = at.copy()
            for lo in range(0, len(live), PART):  # where an element goes follows from the order before, so any part can be moved alone
                self._move(at, moved, live[lo : lo + PART], head, length, run)
            at = moved
            run *= 2
        return at

    def _move(self, at: np.ndarray, moved: np.ndarray, live: np.ndarray, head: np.ndarray, length: np.ndarray, run: int) -> None:
        """Writes the elements at ``live`` to where they go when sorted runs of ``run`` elements merge in pairs."""
        inside = live - head[live]
        block = head[live] + inside // (2 * run) * (2 * run)
        end = head[live] + length[live]
        middle, stop = np.minimum(block + run, end), np.minimum(block + 2 * run, end)
        left = live < middle
        # where an element goes: its place in its own run and the number of elements of the other run before it
        lo, hi = np.where(left, middle, block), np.where(left, stop, middle)
        first = lo.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) // 2
            sign = self.above(at[mid], at[live[open_]])
            goes_before = (sign < 0) | ((sign == 0) & ~left[open_])
            lo[open_] = np.where(goes_before, mid + 1, lo[open_])
            hi[open_] = np.where(goes_before, hi[open_], mid)
        moved[np.where(left, live, block + (live - middle)) + (lo - first)] = at[live]


def repeated_windows(body: np.ndarray, start: np.ndarray, size: np.ndarray, owner: np.ndarray, h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(fragment, position) of the windows that a fragment of a smaller owner has too; fragments are distinct."""
    count = size - window + 1
    at = spread(start, count)
    code = (h[at + window] - h[at]) * powers(len(body), True)[at]
    # a suffix whose leading window hash is alone can't have an equal neighbour
    ordered = np.sort(code)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sieve = np.zeros(1 << 22, bool)
    sieve[mixed(twice) >> np.uint64(42)] = True
    maybe = np.flatnonzero(sieve[mixed(code) >> np.uint64(42)])
    place = np.minimum(np.searchsorted(twice, code[maybe]), len(twice) - 1)
    maybe = maybe[twice[place] == code[maybe]]
    fragment = np.repeat(np.arange(len(start)), count)
    of = np.full(len(body), -1, np.int64)
    at = at[maybe]
    of[at] = fragment[maybe]
    del code, ordered, twice, sieve, place, fragment, maybe  # while suffixes are sorted
    order = SuffixOrder(body, h, window)
    line = order.sort(at)
    if len(line) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = line[:-1], line[1:]
    equal = np.concatenate([order.extension(before[lo : lo + PART], after[lo : lo + PART]) for lo in range(0, len(before), PART)]) >= window
    pairs = np.flatnonzero(equal)
    good = same_bytes(body, line[pairs], line[pairs + 1], np.full(len(pairs), window))
    runs = np.concatenate([[0], np.cumsum(~equal)])
    if not good.all():  # a collision: these runs are ordered by their bytes
        for r in np.unique(runs[pairs[~good]]).tolist():
            members = np.flatnonzero(runs == r)
            texts = [body[p : p + window].tobytes() for p in line[members].tolist()]
            by = sorted(range(len(members)), key=lambda x: texts[x])
            line[members] = line[members[by]]
            for a, b in zip(by, by[1:], strict=False):
                spot = members[by.index(b)] - 1
                equal[spot] = texts[a] == texts[b]
        runs = np.concatenate([[0], np.cumsum(~equal)])
    who = owner[of[line]]
    least = np.full(runs[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, runs, who)
    hit = who > least[runs]
    return of[line[hit]], line[hit]


def merged(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Union of ranges within each (doc, tag), ordered by them."""
    if not len(doc):
        return doc, tag, start, stop
    order = np.lexsort((start, tag, doc))
    doc, tag, start, stop = doc[order], tag[order], start[order], stop[order]
    other = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
    # the furthest stop so far within the group: groups are lifted apart
    lift = np.cumsum(np.concatenate([[0], other])) * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + lift)
    new = np.ones(len(doc), bool)
    new[1:] = other | (start[1:] + lift[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], tag[first], start[first], (reach - lift)[last]


# --- tasks ------------------------------------------------------------------------------------------------------

_ZSTD = pa.Codec("zstd", compression_level=3)


def _squeezed(raw: bytes) -> bytes:
    return _ZSTD.compress(raw, asbytes=True)


def _unsqueezed(packed: bytes, size: int) -> np.ndarray:
    return np.frombuffer(_ZSTD.decompress(packed, size, asbytes=True) if size else b"", np.uint8)


PIECES = "bucket int, n int, facts binary, raw long, body binary, m_doc array<long>, m_tag array<int>, m_start array<long>, m_stop array<long>"
MARKS = "spot int, m_doc array<long>, m_tag array<int>, m_start array<long>, m_stop array<long>"


LOTS = GROUP // SORT  # a group is sorted in so many lots of its anchors


def _pack(lot, doc, tag, start, size, body) -> tuple[int, bytes, int, bytes]:
    kinds = (np.uint8, np.int64, np.int32, np.int64, np.int32)
    facts = b"".join(x.astype(kind).tobytes() for x, kind in zip((lot, doc, tag, start, size), kinds, strict=True))
    return len(doc), _squeezed(facts), len(body), _squeezed(body.tobytes())


def _unpack(n: int, facts: bytes, raw: int, body: bytes):
    facts = memoryview(_unsqueezed(facts, 25 * n))
    cut = [0, n, 9 * n, 13 * n, 21 * n, 25 * n]
    kinds = (np.uint8, np.int64, np.int32, np.int64, np.int32)
    lot, doc, tag, start, size = (np.frombuffer(facts[a:b], kind) for a, b, kind in zip(cut, cut[1:], kinds, strict=False))
    return lot, doc, tag, start, size.astype(np.int64), _unsqueezed(body, raw)


def _stretches(body: np.ndarray, offsets: np.ndarray, window: int, most: int = 4 << 20):
    """A portion as it is, or a very long text in stretches that share window - 1 bytes, with the place where each begins."""
    if len(body) <= most:
        yield 0, body, offsets
        return
    for lo in range(0, len(body), most // 2):
        piece = body[lo : lo + most // 2 + window - 1]
        inner = offsets[(offsets > lo) & (offsets < lo + len(piece))] - lo
        yield lo, piece, np.concatenate([[0], inner, [len(piece)]])


def _crowds(window: int, seen: int, flush: int):
    """(anchor, distinct fragments) of the anchors that have several in ``flush`` bytes of text."""

    def count(held):
        anchor, code = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        held.clear()
        anchor, often = np.unique(anchor[np.unique(code, return_index=True)[1]], return_counts=True)
        many = often >= seen
        return pa.RecordBatch.from_arrays([pa.array(anchor[many].view(np.int64)), pa.array(often[many])], ["anchor", "often"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for part in portions(batches, lambda b: b.column(0)):
            everything, borders = text_bytes(part.column(0))
            for _, body, offsets in _stretches(everything, borders, window):
                held.append(fragments(body, offsets, window)[2:])
                total += len(body)
                if total >= flush:
                    yield count(held)
                    held, total = [], 0
        if held:
            yield count(held)
        release()

    return run


def hot_anchors(texts: DataFrame, window: int, hot: int, seen: int) -> tuple[np.ndarray, int]:
    """Anchors with more than ``hot`` fragments, ascending, and their fragments. They are fewer than all fragments divided by ``hot``."""
    counted = texts.mapInArrow(_crowds(window, seen, FLUSH), "anchor long, often long").groupBy("anchor").agg(F.sum("often").alias("often"))
    found = counted.where(F.col("often") > hot).collect()
    return np.sort(np.array([r.anchor for r in found], np.int64).view(np.uint64)), sum(r.often for r in found)


def _cut(window: int, groups: int, spots: int, flush: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for part in portions(batches, lambda b: b.column(2), CROWDED if len(hot) else PORTION):
            everything, borders = text_bytes(part.column(2))
            ids, tags = part.column(0).to_numpy(), part.column(1).to_numpy()
            for lo, body, offsets in _stretches(everything, borders, window):
                start, size, anchor, code = fragments(body, offsets, window)
                if not len(start):
                    continue
                if len(hot):
                    start, size, anchor, code = single_windows(body, start, size, anchor, code, hot, window)
                of = np.searchsorted(borders, start + lo, "right") - 1
                held.append((ids[of], tags[of], start + lo - borders[of], size, anchor, code, gather(body, start, size)))
                total += int(size.sum())
                if total >= flush:
                    yield _send(held, groups, spots)
                    held, total = [], 0
        if held:
            yield _send(held, groups, spots)
        release()

    return run


def _send(held, groups: int, spots: int) -> pa.RecordBatch:
    """One row per bucket with its fragments, and rows with marks of fragments that a smaller id here has too."""
    doc, tag, at, size, anchor, code = (np.concatenate([h[i] for h in held]) for i in range(6))
    body = np.concatenate([h[6] for h in held])
    held.clear()
    start = np.cumsum(size) - size
    kind = classes_of(body, start, size, code)
    least = np.full(len(kind), np.iinfo(np.int64).max)
    np.minimum.at(least, kind, doc)
    done = doc > least[kind]
    bucket = ((anchor >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)
    lot = ((anchor >> np.uint64(8)) % np.uint64(LOTS)).astype(np.int64)
    left = np.flatnonzero(~done)
    left = left[np.argsort((bucket * LOTS + lot)[left], kind="stable")]
    edges = np.flatnonzero(np.concatenate([[True], bucket[left][1:] != bucket[left][:-1], [True]])) if len(left) else np.zeros(1, int)
    rows = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        i = left[a:b]
        rows.append((int(bucket[i[0]]), *_pack(lot[i], doc[i], tag[i], at[i], size[i], gather(body, start[i], size[i])), [], [], [], []))
    # marks go where their documents go, not with the passage that many share
    for spot, d, t, s, e in _by_document(doc[done], tag[done], at[done], (at + size)[done], spots):
        rows.append((spot, 0, b"", 0, b"", d, t, s, e))
    names = ["bucket", "n", "facts", "raw", "body", "m_doc", "m_tag", "m_start", "m_stop"]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names)


def _spot(doc: np.ndarray, spots: int) -> np.ndarray:
    return (mixed(doc.view(np.uint64)) % np.uint64(spots)).astype(np.int64)


def _by_document(doc, tag, start, stop, spots: int):
    """Merged marks by the group that their document belongs to."""
    if not len(doc):
        return
    doc, tag, start, stop = merged(doc, tag, start, stop)
    spot = _spot(doc, spots)
    order = np.argsort(spot, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], spot[order][1:] != spot[order][:-1], [True]]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        i = order[a:b]
        yield int(spot[i[0]]), doc[i], tag[i], start[i], stop[i]


def _listed(table: pa.Table, name: str) -> np.ndarray:
    """All numbers of a column of lists."""
    chunks = [c.flatten().to_numpy(zero_copy_only=False) for c in table.column(name).chunks]
    return np.concatenate(chunks) if chunks else np.zeros(0, np.int64)


def _meet(window: int, spots: int, most: int):
    names = ["spot", "m_doc", "m_tag", "m_start", "m_stop"]
    kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(group: pa.Table) -> pa.Table:
        found = [tuple(_listed(group, n) for n in names[1:])]
        packs = [_unpack(*(r[n] for n in ("n", "facts", "raw", "body"))) for r in group.select(["n", "facts", "raw", "body"]).to_pylist() if r["n"]]
        if packs:
            found += _resolve(packs, window, most)
        rows = list(_by_document(*(np.concatenate([f[c] for f in found]) for c in range(4)), spots))
        found.clear()
        release()
        return pa.Table.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names)

    return run


def _resolve(packs, window: int, most: int):
    """Marks within one group of fragments, one lot of its anchors at a time."""
    lot, doc, tag, at, size = (np.concatenate([p[c] for p in packs]) for c in range(5))
    body = np.concatenate([p[5] for p in packs])
    packs.clear()
    start = np.cumsum(size) - size
    lots = [np.arange(len(size))] if len(body) <= most else [np.flatnonzero(lot == x) for x in range(LOTS)]
    for i in lots:
        if len(i):
            yield from _marks(doc[i], tag[i], at[i], size[i], gather(body, start[i], size[i]), window)


def _marks(doc, tag, at, size, body, window: int):
    start = np.cumsum(size) - size
    h = prefix_hash(body)
    kind = classes_of(body, start, size, content_code(h, start, size))
    least = np.full(len(kind), np.iinfo(np.int64).max)
    np.minimum.at(least, kind, doc)
    done = doc > least[kind]
    yield doc[done], tag[done], at[done], (at + size)[done]
    # distinct fragments, each for its smallest id
    distinct, code = np.unique(kind, return_inverse=True)
    code = code.ravel()
    fragment, where = repeated_windows(body, start[distinct], size[distinct], least[distinct], h, window)
    if not len(fragment):
        return
    first = where - start[distinct][fragment]
    fragment, _, first, last = merged(fragment, np.zeros_like(fragment), first, first + window)
    # every copy that has the smallest id gets the marks of its fragment
    copies = np.flatnonzero(~done)
    copies = copies[np.argsort(code[copies], kind="stable")]
    lo, hi = np.searchsorted(code[copies], fragment, "left"), np.searchsorted(code[copies], fragment, "right")
    each = copies[spread(lo, hi - lo)]
    repeat = np.repeat(np.arange(len(fragment)), hi - lo)
    yield doc[each], tag[each], at[each] + first[repeat], at[each] + last[repeat]


TEXT_PACKS = "spot int, ids array<long>, tags array<int>, sizes array<long>, raw long, body binary"


def _deal(spots: int, flush: int):
    """Whole texts by the group that their marks go to, compressed; texts without an id get no marks and are spread."""

    def send(held):
        ids, tags = pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held])
        size, body = np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held])
        held.clear()
        start = np.cumsum(size) - size
        spot = _spot(ids.fill_null(0).to_numpy(), spots)
        nulls = ids.is_null().to_numpy(zero_copy_only=False)
        spot[nulls] = np.flatnonzero(nulls) % spots
        order = np.argsort(spot, kind="stable")
        edges = np.flatnonzero(np.concatenate([[True], spot[order][1:] != spot[order][:-1], [True]]))
        rows = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            i = order[a:b]
            part = b"".join(body[x:y].tobytes() for x, y in zip(start[i].tolist(), (start[i] + size[i]).tolist(), strict=True))
            rows.append((int(spot[i[0]]), ids.take(pa.array(i)), tags[i], size[i], len(part), _squeezed(part)))
        kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[c] if c != 1 else r[c].to_pylist() for r in rows], k) for c, k in enumerate(kinds)], ["spot", "ids", "tags", "sizes", "raw", "body"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for part in portions(batches, lambda b: b.column(2)):
            body, offsets = text_bytes(part.column(2))
            held.append((part.column(0), part.column(1).to_numpy(), np.diff(offsets), body))
            total += len(body) + part.num_rows
            if total >= flush:
                yield send(held)
                held, total = [], 0
        if held:
            yield send(held)
        release()

    return run


def _apply(with_kept: bool):
    def run(packs: pa.Table, marks: pa.Table) -> pa.Table:
        parts = [_unsqueezed(r["body"], r["raw"]) for r in packs.select(["raw", "body"]).to_pylist()]
        body = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        parts.clear()
        offsets = np.concatenate([[0], np.cumsum(_listed(packs, "sizes"))]).astype(np.int64)
        tags = _listed(packs, "tags")
        ids = pa.chunked_array([c.flatten() for c in packs.column("ids").chunks], pa.int64())
        cover = np.zeros(len(body) + 1, np.int32)
        doc, tag, start, stop = merged(*(_listed(marks, c) for c in ("m_doc", "m_tag", "m_start", "m_stop")))
        if len(doc):
            places: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(ids.to_pylist(), tags.tolist(), strict=True)):
                places.setdefault(key, []).append(i)
            new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])])
            code = np.cumsum(new) - 1
            lists = [places.get(key, []) for key in zip(doc[new].tolist(), tag[new].tolist(), strict=True)]
            sizes = np.array([len(x) for x in lists])
            flat = np.array([i for x in lists for i in x], np.int64)
            each = flat[spread((np.cumsum(sizes) - sizes)[code], sizes[code])]
            repeat = np.repeat(np.arange(len(code)), sizes[code])
            np.add.at(cover, offsets[each] + start[repeat], 1)
            np.add.at(cover, offsets[each] + stop[repeat], -1)
        gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
        taken = np.concatenate([[0], np.cumsum(gone)])
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        heads = offsets[:-1][np.diff(offsets) > 0]
        begins[heads] = gone[heads]
        spans = np.concatenate([[0], np.cumsum(begins)])
        at = offsets - taken[offsets]
        kept = body[~gone].tobytes()
        pieces = [kept[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        out = {
            "id": ids,
            "n_bytes": pa.array(np.diff(offsets)),
            "n_removed": pa.array(np.diff(taken[offsets])),
            "n_spans": pa.array(np.diff(spans[offsets])),
            "kept_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string()),
        }
        return pa.table(out | ({"kept": pa.array(pieces, pa.binary())} if with_kept else {}))

    return run


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_kept: bool = True) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and, if asked for, the kept bytes."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    spots = max(1, math.ceil(total / TEXTS))
    # one id with several texts is rare; only then texts are told apart
    twice = bool(rows.where("id is not null").groupBy("id").count().where("count > 1").limit(1).take(1))
    tag = (F.crc32(F.encode("text", "utf-8")) - (1 << 31)).cast("int") if twice else F.lit(0)
    tagged = rows.select("id", tag.alias("tag"), "text")
    hot, crowded = hot_anchors(tagged.where("id is not null").select("text"), window, HOT, SEEN)
    # a fragment has up to window - anchor_width + 1 windows, half as many on average; where they travel one by one, they fill groups too
    single = (window - anchor_width(window) + 1) / 2 * window
    groups = max(1, math.ceil((total * GROWTH + crowded * single) / GROUP))
    pieces = tagged.where("id is not null").mapInArrow(_cut(window, groups, spots, FLUSH, hot), PIECES)
    marks = pieces.groupBy("bucket").applyInArrow(_meet(window, spots, SORT), MARKS)

    dealt = tagged.mapInArrow(_deal(spots, FLUSH // 2), TEXT_PACKS)
    out = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_kept else "")
    done = dealt.groupBy("spot").cogroup(marks.groupBy("spot")).applyInArrow(_apply(with_kept), out)
    return done.withColumnRenamed("id", id_col)
