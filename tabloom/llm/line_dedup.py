"""Fuzzy line deduplication across documents.

Lines are trimmed and ASCII-lower-cased. Each distinct one gets a MinHash signature of its character shingles: one hash per shingle falls into one of
``bands * rows`` bins, the smallest of each bin counts, and empty bins borrow from others by a fixed probe sequence. Lines with an equal band
meet in a bucket, which links each member to its smallest one (first inside a task's portion, then across portions, so a bucket of any size is
pre-aggregated before the shuffle). Links are verified by exact Jaccard similarity and union-find joins them. What is left in long buckets is
linked to another pivot. Members of a bucket that are then still in different components and weren't compared are paired directly where the bucket has
up to 64 members, and otherwise where they share a shingle among the rarest of both, as any pair at the threshold does. All pairs pass the parities of near_dedup
before their lines are read, so groups of lines that are alike but not alike enough make few pairs. Of each component the line of the smallest (id, line number) stays.

One pass over the texts gives the lines and what goes to the buckets; a second one picks the lines that are in a link by a sieve of bounded size.

With 16 bands of 4 rows a pair at 0.8 meets with a chance of 0.9998. Unrelated lines of the test tables have a similarity around
0.005, so a bucket holds fewer than one of them up to some 10^8 lines; raise ``rows`` and ``bands`` beyond that (more pairs are verified otherwise, none is lost).

Defined cases: null texts are empty; blank lines always stay; a line shorter than a shingle has itself as its one shingle; a null id keeps all its
lines and takes no part; rows that repeat id and text are treated alike, rows with one id and different texts are told apart by a checksum; empty
tables give empty results; other columns pass through in ``drop_lines``. Lines in links are identified by 64-bit hashes, equal lines by 128 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.arrays import mixed, portions, powers, prefix_hash, release, span_hash, text_bytes
from tabloom.llm.components import components
from tabloom.llm.near_dedup import HEADED, PORTION, SHORT, alike_pairs, may_be_alike, open_pairs, parities
from tabloom.llm.workspace import Workspace
from tabloom.scratch import materialize

SHINGLE, BANDS, ROWS, PERCENT = 7, 16, 4, 80
PIVOTS = 1  # rounds with another pivot for long buckets
#: Bucket entries that a task gathers before it sends them on, and that one group is laid out for.
FLUSH, GROUP = 1_500_000, 1_500_000
CELLS = 1 << 22  # of a table in which the shingles of long buckets' members are counted (16 MB)
BLOCKS = 64  # in which its parts are added up
SIEVE = 1 << 27  # bits that are sent to the texts at the most (16 MB), to tell the lines in links from others

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = True


def characters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as code points in a row, ASCII letters lower-cased, and n + 1 offsets; bytes of a text that isn't valid UTF-8 count as characters."""
    body, offsets = text_bytes(column)
    body = _LOWER[body]
    try:
        points = np.frombuffer(body.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:
        return _one_by_one(body, offsets)
    if len(points) == len(body):
        return points, offsets
    trails = np.flatnonzero((body & 0xC0) == 0x80)
    return points, offsets - np.searchsorted(trails, offsets)


def _one_by_one(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        try:
            parts.append(np.frombuffer(body[a:b].tobytes().decode("utf-8").encode("utf-32-le"), np.uint32))
        except UnicodeDecodeError:
            parts.append(body[a:b].astype(np.uint32))
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(offsets.dtype)


def _blank_at(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    return _SPACE[np.minimum(points[at], 255)]


def lines_of(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, number in the text, start, stop) of every line, trimmed; a blank line has start = stop."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(points == 0x0A)
    of = np.searchsorted(offsets, breaks, "right") - 1
    count = np.bincount(of, minlength=n) + 1
    text = np.repeat(np.arange(n), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start, stop = offsets[text].copy(), offsets[text + 1].copy()
    after = number > 0
    start[after], stop[np.append(after[1:], False)] = breaks + 1, breaks
    left = np.flatnonzero(start < stop)
    while len(left):  # as often as the longest run of white space at a line's edge
        left = left[_blank_at(points, start[left])]
        start[left] += 1
        left = left[start[left] < stop[left]]
    left = np.flatnonzero(start < stop)
    while len(left):
        left = left[_blank_at(points, stop[left] - 1)]
        stop[left] -= 1
    return text, number, start, stop


def shingles_of(h: np.ndarray, start: np.ndarray, stop: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of all character shingles of lines in order; a short line is its own shingle, an empty one has none."""
    n = len(h) - 1
    size = stop - start
    full, short = np.flatnonzero(size >= width), np.flatnonzero((size > 0) & (size < width))
    line, code = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(full):
        every = (h[width:] - h[:-width]) * powers(n, True)[: n - width + 1]
        edges = np.zeros(n - width + 2, np.int8)
        np.add.at(edges, start[full], 1)
        np.add.at(edges, stop[full] - width + 1, -1)
        line, code = np.repeat(full, size[full] - width + 1), every[np.cumsum(edges[:-1], dtype=np.int8).view(bool)]
    if len(short):
        line = np.concatenate([line, short])
        code = np.concatenate([code, span_hash(h, start[short], stop[short])])
    return line, mixed(code + np.uint64(1))


@cache
def _probes(bins: int) -> np.ndarray:
    """Fixed probe sequences: row t holds the bin that each bin looks at in its t-th try."""
    t, j = np.meshgrid(np.arange(1, 8 * bins), np.arange(bins), indexing="ij")
    return (mixed((t * 1_000_003 + j).astype(np.uint64)) % np.uint64(bins)).astype(np.int64)


def signatures(line: np.ndarray, code: np.ndarray, lines: int, bins: int) -> np.ndarray:
    """One-permutation MinHash: the smallest hash in each bin; empty bins borrow."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(lines * bins, empty)
    bin_of = code & np.uint64(bins - 1) if bins & (bins - 1) == 0 else code % np.uint64(bins)
    np.minimum.at(out, line * bins + bin_of.view(np.int64), code >> np.uint64(6))
    out = out.reshape(lines, bins)
    hollow = out == empty
    row, column = np.nonzero(hollow & ~hollow.all(axis=1)[:, None])
    for probe in _probes(bins):
        if not len(row):
            return out
        source = probe[column]
        good = ~hollow[row, source]
        out[row[good], column[good]] = out[row[good], source[good]]
        row, column = row[~good], column[~good]
    out[row, column] = out.min(axis=1)[row]
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    rows = signature.shape[1] // bands
    parts = signature.reshape(len(signature), bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), 1))
    for r in range(rows):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key


def _nodes(h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return mixed(span_hash(h, start, stop) + (stop - start).astype(np.uint64))


def _second(points: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Another hash of the same characters: the polynomial at the inverse base."""
    values = (points.astype(np.uint64) + np.uint64(7)) * powers(len(points), True)[: len(points)]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    return mixed((total[stop] - total[start]) * powers(len(points))[start])


# --- tasks ---------------------------------------------------------------------------------------------------


ENTRIES = (
    "bucket int, keys array<int>, nodes array<long>, e_key array<long>, e_x array<long>, e_z array<long>,"
    " id array<long>, tag array<long>, line array<long>, node array<long>, second array<long>"
)
_LINKS, _LINES = ("e_key", "e_x", "e_z"), ("id", "tag", "line", "node", "second")
_LISTS = {"keys": np.int32} | dict.fromkeys(("nodes", *_LINKS, *_LINES), np.int64)
MET = "value long, x long, z long, id long, tag long, line long, node long, second long"


def _rows(blocks: list[tuple[np.ndarray, dict[str, np.ndarray], np.ndarray]]) -> pa.RecordBatch:
    """Rows of ``ENTRIES`` from (buckets, flat lists, cuts) of several kinds; what a kind doesn't have is empty."""
    columns = [pa.array(np.concatenate([b for b, _, _ in blocks]).astype(np.int32))]
    for name, kind in _LISTS.items():
        offsets, values, at = [np.zeros(1, np.int64)], [np.zeros(0, kind)], 0
        for bucket, flat, cuts in blocks:
            offsets.append(at + (cuts[1:] if name in flat else np.zeros(len(bucket), np.int64)))
            if name in flat:
                values.append(flat[name])
                at += int(cuts[-1])
        columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate(offsets).astype(np.int32)), pa.array(np.concatenate(values))))
    return pa.RecordBatch.from_arrays(columns, ["bucket", *_LISTS])


def _cuts(n: int, most: int) -> np.ndarray:
    return np.append(np.arange(0, n, most), n)


def stars(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Smallest node of each key, as (key, node) in any order, and links (key, node, smallest) of the others."""
    order = np.argsort(key)
    key, node = key[order], node[order]
    edge = np.ones(len(key) + 1, bool)
    edge[1:-1] = key[1:] != key[:-1]
    lone = edge[:-1] & edge[1:]  # most keys are
    heads = key[lone], node[lone]
    key, node = key[~lone], node[~lone]
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    head = node[np.flatnonzero(new)][np.cumsum(new) - 1] if len(key) else node
    other = node != head
    other[1:] &= (node[1:] != node[:-1]) | new[1:]
    return np.concatenate([heads[0], key[new]]), np.concatenate([heads[1], node[new]]), key[other], node[other], head[other]


def _dealt(width: int, bands: int, rows: int, groups: int, flush: int):
    def send(held, listed):
        key, node = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        columns = [np.concatenate([x[i] for x in listed]) for i in range(len(_LINES))]
        held.clear()
        listed.clear()
        key, node, e_key, e_x, e_z = stars(key, node)
        bucket = key % np.uint64(groups)
        order = np.argsort(bucket.astype(np.uint16) if groups <= 1 << 16 else bucket, kind="stable")
        key, node, bucket = key[order], node[order], bucket[order].astype(np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, np.int64)
        blocks = [(bucket[cuts[:-1]], {"keys": (key >> np.uint64(32)).astype(np.uint32).view(np.int32), "nodes": node}, cuts)]
        # links and lines go anywhere, so those of a full bucket don't weigh on one group
        full = _key(e_key % np.uint64(groups), (e_key >> np.uint64(32)).astype(np.uint32))
        for names, lists in ((_LINKS, [full, e_x, e_z]), (_LINES, columns)):
            n = len(lists[0])
            if n:
                cuts = _cuts(n, 20_000)
                blocks.append(((int(lists[-1].sum()) % groups + np.arange(len(cuts) - 1)) % groups, dict(zip(names, lists, strict=True)), cuts))
        return _rows(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, listed, total = [], [], 0
        for part in portions(batches, lambda b: b.column(2), PORTION):
            points, offsets = characters(part.column(2))
            text, number, start, stop = lines_of(points, offsets)
            h = prefix_hash(points)
            node = _nodes(h, start, stop)
            ids = [part.column(i).to_numpy()[text] for i in (0, 1)]
            # a blank line's number is inverted
            listed.append((*ids, np.where(start < stop, number, ~number), node.view(np.int64), _second(points, start, stop).view(np.int64)))
            first = np.sort(np.unique(node, return_index=True)[1])
            first = first[stop[first] > start[first]]
            start, stop, node = start[first], stop[first], node[first]
            line, code = shingles_of(h, start, stop, width)
            keys = band_keys(signatures(line, code, len(node), bands * rows), bands)
            held.append((keys.ravel(), np.repeat(node.view(np.int64), bands)))
            total += keys.size + len(text)
            if total >= flush:
                yield send(held, listed)
                total = 0
        if total:
            yield send(held, listed)
        release()

    return run


def _key(bucket: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return ((bucket.astype(np.uint64) << np.uint64(32)) | rest.astype(np.uint64)).view(np.int64)


def _flat(table: pa.Table, name: str, kind) -> np.ndarray:
    chunks = [c.flatten().to_numpy(zero_copy_only=False) for c in table.column(name).chunks]
    return np.concatenate(chunks).astype(kind) if chunks else np.zeros(0, kind)


def _meet(group: pa.Table) -> pa.Table:
    """Links of one group of buckets, with those that portions have found themselves; and the lines that came with them."""
    bucket = np.uint64(group.column("bucket")[0].as_py())
    rest = _flat(group, "keys", np.int32).view(np.uint32)
    _, _, e_key, e_x, e_z = stars(rest, _flat(group, "nodes", np.int64))
    e_key = _key(np.full(len(e_key), bucket), e_key)
    links = [np.concatenate([_flat(group, n, np.int64), x]) for n, x in zip(_LINKS, (e_key, e_x, e_z), strict=True)]
    lines = {n: _flat(group, n, np.int64) for n in _LINES}
    blank = lines["line"] < 0
    columns = {n: pa.array(x, mask=blank if n in ("node", "second") else None) for n, x in (lines | {"line": np.where(blank, ~lines["line"], lines["line"])}).items()}
    out = pa.concat_tables([pa.table(dict(zip(("value", "x", "z"), links, strict=True))), pa.table(columns)], promote_options="default")
    release()
    return out


def _wanted_lines(sieve):
    """(node, text) of the lines that pass the sieve, each once in a portion."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sieve.value
        bit = lambda at: (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
        mask = 64 * len(words) - 1
        for part in portions(batches, lambda b: b.column(0), PORTION):
            points, offsets = characters(part.column(0))
            _, _, start, stop = lines_of(points, offsets)
            node = _nodes(prefix_hash(points), start, stop).view(np.int64)
            good = (stop > start) & (bit(node & mask) & bit((node >> 32) & mask)).view(np.int64).astype(bool)
            at = np.flatnonzero(good)
            at = at[np.unique(node[at], return_index=True)[1]]
            texts = [points[a:b].tobytes().decode("utf-32-le").encode() for a, b in zip(start[at].tolist(), stop[at].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(texts, pa.binary())], ["node", "body"])

    return run


def _facts(width: int):
    """(node, text, number of shingles, their parity)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, lambda b: b.column(1), PORTION):
            codes, offsets = _distinct(part.column(1).to_pylist(), width)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.diff(offsets)), parities(codes, offsets)], ["node", "body", "n", "parity"])

    return run


def _distinct(bodies: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all lines in a row, ascending in each, and n + 1 offsets."""
    n = len(bodies)
    points, ends = characters(pa.array(bodies, pa.binary()))
    line, code = shingles_of(prefix_hash(points), ends[:-1], ends[1:], width)
    if (line[1:] < line[:-1]).any():  # short lines come last
        order = np.argsort(line, kind="stable")
        line, code = line[order], code[order]
    cuts = np.searchsorted(line, np.arange(n + 1)).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        code[a:b].sort()
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (line[1:] != line[:-1])
    return code[new], np.concatenate([[0], np.cumsum(np.bincount(line[new], minlength=n))])


def line_sets(bodies: list[bytes], width: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each line, ascending."""
    codes, offsets = _distinct(bodies, width)
    at = offsets.tolist()
    return [codes[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _jaccard(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, lambda b: b.column(2), 1 << 20):
            pairs = list(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True))
            distinct = list(dict.fromkeys(x for pair in pairs for x in pair))
            sets = dict(zip(distinct, line_sets(distinct, width), strict=True))
            good = []
            for a, b in pairs:
                a, b = sets[a], sets[b]
                n = len(a) + len(b)
                enough = 100 * min(len(a), len(b)) >= percent * max(len(a), len(b))
                if enough:
                    both = np.concatenate([a, b])
                    both.sort()
                    common = int(np.count_nonzero(both[1:] == both[:-1]))
                    enough = 100 * common >= percent * (n - common)
                good.append(enough)
            yield part.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return run


def _cell_counts(width: int, cells: int):
    """(block, cells, counts) of the shingles of each portion."""
    edges = np.linspace(0, cells, min(BLOCKS, cells) + 1).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, lambda b: b.column(1), PORTION):
            cell, often = np.unique(_cell(_distinct(part.column(1).to_pylist(), width)[0], cells), return_counts=True)
            offsets = pa.array(np.searchsorted(cell, edges).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int64))) for x in (cell, often)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(edges) - 1, dtype=np.int32)), *lists], ["block", "cell", "often"])

    return run


def _summed(group: pa.Table) -> pa.Table:
    cell, at = np.unique(_flat(group, "cell", np.int64), return_inverse=True)
    often = np.zeros(len(cell), np.int64)
    np.add.at(often, at, _flat(group, "often", np.int64))
    several = often > 1
    offsets = pa.array(np.array([0, several.sum()], np.int32))
    return pa.table({n: pa.ListArray.from_arrays(offsets, pa.array(x[several])) for n, x in (("cell", cell), ("often", often))})


def _cell(codes: np.ndarray, cells: int) -> np.ndarray:
    return (codes % np.uint64(cells)).astype(np.int64)


def _rarest(width: int, percent: int, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        for part in portions(batches, lambda b: b.column(1), PORTION):
            codes, offsets = _distinct(part.column(1).to_pylist(), width)
            n = np.diff(offsets)
            owner = np.repeat(np.arange(len(n)), n)
            often = counts[_cell(codes, len(counts))]
            order = np.lexsort((codes, often, owner))
            value, shared = codes[order].view(np.int64), often[order] > 1
            place = np.arange(len(value)) - np.repeat(offsets[:-1], n)
            places = n * (100 - percent) // 100 + 1
            heads = shared & (place <= places[owner]) & (n <= HEADED)[owner]
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner[heads], minlength=len(n)))]).astype(np.int32)
            head = pa.ListArray.from_arrays(pa.array(ends), pa.array(value[heads]))
            at = np.flatnonzero(shared & (place < places[owner]))
            of = pa.array(np.where(n <= HEADED, np.arange(len(n)), -1)[owner[at]], mask=(n > HEADED)[owner[at]])
            columns = [pa.array(value[at]), part.column(0).take(pa.array(owner[at])), pa.array(n[owner[at]]), pa.array(place[at]), head.take(of)]
            yield pa.RecordBatch.from_arrays(columns, ["value", "c", "n", "place", "head"])

    return run


def rare_lists(bodies: DataFrame, width: int, percent: int, keep) -> DataFrame:
    """(value, c, n, place, head) as in near_dedup.full_lists, from (node, body).

    Shingles are counted in a table of ``CELLS`` that is sent to the lines. Any order that is the same for all sets will do, so shingles that share a cell
    are just taken for less rare than they are; one that is alone in its cell occurs once and is not listed.
    """
    bodies = keep(bodies.select("node", "body"), "line-wanted")
    lists = "cell array<long>, often array<long>"
    often = bodies.mapInArrow(_cell_counts(width, CELLS), f"block int, {lists}").groupBy("block").applyInArrow(_summed, lists).toArrow()
    counts = np.ones(CELLS, np.uint32)
    counts[_flat(often, "cell", np.int64)] = np.minimum(_flat(often, "often", np.int64), (1 << 32) - 1)
    table = bodies.sparkSession.sparkContext.broadcast(counts)
    return keep(bodies.mapInArrow(_rarest(width, percent, table), "value long, c long, n long, place long, head array<long>"), "line-lists")


# --- the operator -----------------------------------------------------------------------------------------------


def _n_lines(text_col: str):
    """Number of lines of a text that isn't null."""
    return (F.octet_length(text_col) - F.octet_length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1).cast("long")


def _tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tag, text, row): the checksum is taken only where an id repeats somewhere."""
    twice = bool(docs.select(F.col(id_col).alias("id")).where("id is not null").groupBy("id").count().where("count > 1").limit(1).take(1))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    tag = F.crc32(F.encode(text, "utf-8")) if twice else F.lit(0).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("id"), tag.alias("tag"), text.alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def duplicate_lines(tagged: DataFrame, width: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT) -> DataFrame:
    """(id, tag, line, keep_id, keep_line) of every line to drop, from (id, tag, text)."""
    keep = Workspace(tagged.sparkSession, "line-dedup")
    texts = tagged.where("id is not null").select("id", "tag", "text")
    many = texts.agg(F.sum(_n_lines("text"))).first()[0] or 0
    groups = max(1, math.ceil(many * bands / GROUP))
    entries = texts.mapInArrow(_dealt(width, bands, rows, groups, FLUSH), ENTRIES)
    met = keep(entries.groupBy("bucket").applyInArrow(_meet, MET), "line-links")
    links = met.where("value is not null").select("value", "x", "z")
    lines = met.where("node is not null").select("id", "tag", "line", "node", "second")
    members = links.select("value", F.col("x").alias("c")).union(links.select("value", "z")).distinct()
    members = keep(members, "line-members")
    bodies = _bodies(members, texts, width, keep)
    facts = bodies.select(F.col("node").alias("c"), "n", "parity")

    def confirmed(pairs: DataFrame) -> DataFrame:
        one = bodies.select(F.col("node").alias("a"), F.col("body").alias("s"))
        two = bodies.select(F.col("node").alias("b"), F.col("body").alias("t"))
        met = alike_pairs(pairs, facts, percent).join(one, "a").join(two, "b").select("a", "b", "s", "t")
        return keep(met.mapInArrow(_jaccard(width, percent), "a long, b long"), "line-pairs")

    asked = keep(links.select(F.least("x", "z").alias("a"), F.greatest("x", "z").alias("b")).distinct(), "line-pairs")
    sure = confirmed(asked)
    roots = components(sure, keep=keep)
    # a bucket that holds one component stays out, and the others keep all their members
    undecided = keep(_undecided(members, roots), "line-undecided")
    few, many = undecided.where(F.col("members") <= SHORT), undecided.where(F.col("members") > SHORT)
    rest = _short_pairs(few.join(facts, "c"), percent)
    if many.limit(1).take(1):
        for salt in range(PIVOTS):
            pairs = keep(_pivot_pairs(many, salt).join(asked, ["a", "b"], "left_anti"), "line-pairs")
            asked, sure = asked.union(pairs), sure.union(confirmed(pairs))
            roots = components(sure, keep=keep)
            many = keep(_undecided(many.select("value", "c"), roots), "line-undecided")
        wanted = bodies.join(many.select(F.col("c").alias("node")).distinct(), "node", "left_semi")
        listed = rare_lists(wanted, width, percent, keep)
        rest = rest.union(open_pairs(listed, roots, facts.select("c", "parity"), percent))
    rest = rest.distinct().join(asked, ["a", "b"], "left_anti")
    roots = components(sure.union(confirmed(keep(rest, "line-pairs"))), keep=keep)
    out = materialize(_dropped(lines, roots, keep), "line-dedup-result")
    keep.close()
    return out


def _sieve(members: DataFrame) -> np.ndarray:
    """Bits of all nodes, two for each, in 64-bit words; others pass now and then, and more of them beyond some 10^7 nodes, as ``SIEVE`` bounds it."""
    bits = min(SIEVE, max(64, 1 << (4 * members.count()).bit_length()))
    at = F.explode(F.array(F.col("c").bitwiseAND(F.lit(bits - 1)), F.shiftright("c", 32).bitwiseAND(F.lit(bits - 1))))
    words = members.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _bodies(members: DataFrame, texts: DataFrame, width: int, keep) -> DataFrame:
    """Bytes and parity of each line that is in a link, and of a few others."""
    sieve = members.sparkSession.sparkContext.broadcast(_sieve(members))
    found = texts.select("text").mapInArrow(_wanted_lines(sieve), "node long, body binary").dropDuplicates(["node"])
    return keep(found.mapInArrow(_facts(width), "node long, body binary, n long, parity array<long>"), "line-texts")


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with theirs; two members alone are linked to each other and so have been compared."""
    named = members.join(roots.withColumnRenamed("node", "c"), "c", "left").select("value", "c", F.coalesce("component", "c").alias("root"))
    apart = named.groupBy("value").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("members")).where("lo != hi and members > 2")
    return named.join(apart.select("value", "members"), "value")


def _pivot_pairs(undecided: DataFrame, salt: int) -> DataFrame:
    """Members of buckets with another pivot, where they are in different components."""
    pivot = undecided.groupBy("value").agg(F.min(F.struct(F.xxhash64(F.lit(salt), "c").alias("h"), F.col("c").alias("p"), F.col("root").alias("other"))).alias("x"))
    met = undecided.join(pivot.select("value", "x.p", "x.other"), "value").where("root != other")
    return met.select(F.least("c", "p").alias("a"), F.greatest("c", "p").alias("b")).distinct()


def _undecided(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component.

    The smallest one is among them: a member that isn't the smallest of its portion was linked to that one only, and not compared with the bucket's.
    """
    return _labelled(members, roots).select("value", "c", "root", "members")


def _short_pairs(undecided: DataFrame, percent: int) -> DataFrame:
    left = undecided.select("value", "c", "root", "n", "parity")
    right = left.select("value", F.col("c").alias("d"), F.col("root").alias("other"), F.col("n").alias("m"), F.col("parity").alias("q"))
    alike = may_be_alike(F.col("parity"), F.col("q"), F.col("n"), F.col("m"), percent)
    return left.join(right, "value").where((F.col("c") < F.col("d")) & (F.col("root") != F.col("other")) & alike).select(F.col("c").alias("a"), F.col("d").alias("b"))


def _dropped(lines: DataFrame, roots: DataFrame, keep) -> DataFrame:
    """All lines but the first of each component, or of equal lines outside of any."""
    linked = roots.union(roots.select(F.col("component").alias("node"), "component").distinct())
    repeated = lines.groupBy("node").agg(F.count("*").alias("members")).where("members > 1").select("node")
    named = lines.join(repeated.join(linked, "node", "full"), "node").select(
        "id", "tag", "line", F.coalesce("component", "node").alias("group"), F.when(F.col("component").isNull(), F.col("second")).otherwise(F.lit(0)).alias("sub")
    )
    inside = keep(named, "line-groups")
    place = F.struct("id", "tag", "line")
    first = inside.groupBy("group", "sub").agg(F.min(place).alias("keep"))
    return inside.join(first, ["group", "sub"]).where(place != F.col("keep")).select("id", "tag", "line", F.col("keep.id").alias("keep_id"), F.col("keep.line").alias("keep_line"))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: id, n_lines, n_dropped, dropped_lines (numbers from 0) and kept_from (where the lines that stay are)."""
    tagged = _tagged(docs, id_col, text_col)
    each = duplicate_lines(tagged, **options).groupBy("id", "tag").agg(F.sort_array(F.collect_set(F.struct("line", "keep_id", "keep_line"))).alias("lines"))
    sized = tagged.select("id", "tag", _n_lines("text").alias("n_lines"))
    out = sized.join(each, ["id", "tag"], "left")
    lines = F.coalesce(F.col("lines"), F.array().cast("array<struct<line:bigint,keep_id:bigint,keep_line:bigint>>"))
    return out.select(
        F.col("id").alias(id_col), "n_lines", F.size(lines).cast("long").alias("n_dropped"), lines["line"].alias("dropped_lines"),
        F.transform(lines, lambda x: F.struct(x["keep_id"].alias("doc_id"), x["keep_line"].alias("line"))).alias("kept_from"),
    )


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(row, text, n_dropped): input rows with their remaining text."""
    tagged = _tagged(docs, id_col, text_col)
    each = duplicate_lines(tagged, **options).groupBy("id", "tag").agg(F.collect_set("line").alias("lines"))
    out = tagged.join(each, ["id", "tag"], "left")
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("lines", i.cast("long")))
    return out.select(
        "row", F.when(F.col("lines").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"), F.coalesce(F.size("lines"), F.lit(0)).alias("n_dropped")
    )
