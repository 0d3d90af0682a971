"""Best-two-fit packing of tokenized documents into sequences.

Documents become token ids with an end id; only those longer than a sequence are cut, into full pieces behind a first one that may be shorter. Pieces are dealt evenly over
tasks and packed there in groups of at most ``group`` pieces. A group fills one sequence at a time: the longest piece that fits goes in until none does. If room is left,
the sequence's shortest piece may give way to the two unpacked pieces that fill its place and the room best, if they fill more than it did. Only lengths matter, so a group
works on a table of counts by length. A group leaves its last sequence unfilled, and no other waste depends on how pieces are dealt.

Tokenizing. Where the vocabulary is a byte-level BPE whose ids are the ranks of its merges, texts of common characters are encoded by the rank encoder of another library,
which is several times faster, and all others by the tokenizer; ids are those of the tokenizer for either (a test compares them).

Defined cases: a null or empty text is its end id alone; texts of any length are read whole; rows that repeat are packed as often as they come; null ids are carried
along; an empty table gives an empty result; columns other than id and text aren't read.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.arrays import portions
from tabloom.scratch import materialize

SEQUENCE, END = 2048, 0
#: Pieces that a task packs together.
GROUP = 16_384
#: Fixed value: how byte-level BPE splits words.
WORD = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Other characters than printable ASCII, line breaks and Latin letters; gaps that are very long.
ODD, GAP, LONG = re.compile(r"[^\n -~\u00a1-\u024f]"), re.compile(r"[ \n]{1000}"), 1000

PIECES = "doc_id {}, piece int, start long, length long, ids binary"


class Ids:
    """Ids of whole texts."""

    def __init__(self, tokenizer_path: str, end: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer, self.end, self.quick = Tokenizer.from_file(tokenizer_path), end, None
        with open(tokenizer_path, encoding="utf-8") as f:
            ranks = byte_ranks(json.load(f))
        if ranks:
            self.quick = tiktoken.Encoding("ranks", pat_str=WORD, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        """With the end id behind each."""
        plain = [bool(self.quick) and not odd_text(t) for t in texts]
        odd = [t for t, ok in zip(texts, plain, strict=True) if not ok]
        slow = iter(self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)) if odd else iter(())
        return [(self.quick.encode_ordinary(t) if ok else next(slow).ids) + [self.end] for t, ok in zip(texts, plain, strict=True)]


def odd_text(text: str) -> bool:
    """What goes to the tokenizer itself: rare characters, marks of special tokens, very long words and gaps."""
    return bool(ODD.search(text)) or "<|" in text or len(text) >= LONG and (max(map(len, text.split()), default=0) >= LONG or bool(GAP.search(text)))


def byte_ranks(described: dict) -> dict[bytes, int] | None:
    """Token bytes to ids of a byte-level BPE whose ids follow the order of its merges and that splits words in the usual way; else None."""
    model, pre = described["model"], described.get("pre_tokenizer") or {}
    usual = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not described.get("normalizer")
    if model.get("type") != "BPE" or not usual or model.get("dropout") or model.get("ignore_merges"):
        return None
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*visible}))}
    vocab = model["vocab"]
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if any(vocab.get(m) != 256 + k for k, m in enumerate(merges)) or any(vocab.get(c, 256) > 255 for c in letters):
        return None
    return {bytes(letters[c] for c in token): vocab[token] for token in [*letters, *merges]}


_loaded: dict[tuple, Ids] = {}


def _ids_of(tokenizer_path: str, end: int) -> Ids:
    """Files are read once by a Python worker."""
    if (tokenizer_path, end) not in _loaded:
        _loaded[tokenizer_path, end] = Ids(tokenizer_path, end)
    return _loaded[tokenizer_path, end]


def cuts(size: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones behind a first one that may be shorter."""
    first = size % most or most
    return [(0, first)] + [(at, most) for at in range(first, size, most)] if size > most else [(0, size)]


def _tokenized(tokenizer_path: str, most: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _ids_of(tokenizer_path, end)
        for part in portions(batches, lambda b: b.column(1), 4 << 20):
            each = found.encode([t or "" for t in part.column(1).to_pylist()])
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in each])])
            ids = np.fromiter(itertools.chain.from_iterable(each), np.uint32, int(offsets[-1]))
            body = ids.astype("<u4").tobytes()
            row, number, start, length, piece = [], [], [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                for k, (at, size) in enumerate(cuts(b - a, most)):
                    row.append(i)
                    number.append(k)
                    start.append(at)
                    length.append(size)
                    piece.append(body[4 * (a + at) : 4 * (a + at + size)])
            columns = [part.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(piece, pa.binary())]
            for k in range(0, len(row), 4096):
                yield pa.RecordBatch.from_arrays([c.slice(k, 4096) for c in columns], ["doc_id", "piece", "start", "length", "ids"])

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", most: int = SEQUENCE, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every piece; ids are little-endian unsigned 32-bit numbers."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_tokenized(tokenizer_path, most, end), PIECES.format(rows.schema["doc_id"].dataType.simpleString()))


# --- packing -------------------------------------------------------------------------------------------------


def best_two_fit(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, sequences numbered from 0. ``lengths`` are 1 to ``most``."""
    order = np.argsort(-lengths, kind="stable")
    left = np.bincount(lengths, minlength=most + 1)
    taken = np.concatenate([[0], np.cumsum(left[::-1])])[::-1][1:].copy()  # where in ``order`` the next piece of a length is
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fits = np.maximum.accumulate(np.where(left > 0, np.arange(most + 1), 0))  # the longest unpacked length up to each
    number = 0

    def take(x: int) -> None:
        left[x] -= 1
        if not left[x]:
            stop = int(np.searchsorted(fits[x:], x, "right")) + x
            fits[x:stop] = fits[x - 1]

    def give_back(x: int) -> None:
        left[x] += 1
        if left[x] == 1:
            part = fits[x:]
            np.maximum(part, x, out=part)

    while fits[most]:
        bin_, room = [], most
        while x := int(fits[room]):
            take(x)
            bin_.append(x)
            room -= x
        if room and bin_:
            least = bin_[-1]  # pieces went in longest first
            wide = room + least
            # the two unpacked pieces that fill the place best; of these the pair with the longest piece
            one = np.flatnonzero(left[: wide // 2 + 1])
            if len(one):
                two = fits[wide - one]
                alone = (two == one) & (left[one] < 2)
                two = np.where(alone, fits[np.maximum(one - 1, 0)], two)
                total = np.where(two > 0, one + two, 0)
                best = int(total.argmax())
                if total[best] > least:
                    bin_.pop()
                    give_back(least)
                    pair = sorted((int(one[best]), int(two[best])), reverse=True)
                    for x in pair:
                        take(x)
                    bin_ += pair
                    room = wide - sum(pair)
                    while x := int(fits[room]):
                        take(x)
                        bin_.append(x)
                        room -= x
        at = 0
        for x in bin_:
            i = order[taken[x]]
            taken[x] += 1
            sequence[i], offset[i] = number, at
            at += x
        number += 1
    return sequence, offset


def _packed(most: int, group: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId()) << 36
        for table in _groups(batches, group):
            sequence, offset = best_two_fit(table.column("length").to_numpy().astype(np.int64), most)
            table = table.append_column("sequence_id", pa.array(sequence + number)).append_column("offset", pa.array(offset))
            number += int(sequence.max()) + 1
            yield from table.to_batches(max_chunksize=4096)

    return run


def _groups(batches: Iterator[pa.RecordBatch], group: int) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, group - rows)
            batch = batch.slice(part.num_rows)
            held.append(part)
            rows += part.num_rows
            if rows == group:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def pack(pieces: DataFrame, most: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """``pieces`` with sequence_id and offset. ``pieces`` needs a column length of 1 to ``most`` and should be a written table: it is counted, then dealt evenly."""
    rows = pieces.count()
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields] + ["sequence_id long", "offset long"]
    return pieces.repartition(max(1, -(-rows // group))).mapInArrow(_packed(most, group), ", ".join(names))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", most: int = SEQUENCE, end: int = END, group: int = GROUP) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, sequence_id, offset."""
    return pack(materialize(token_pieces(docs, tokenizer_path, id_col, text_col, most, end), "token-pieces"), most, group)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids, doc_ids, starts): the training sequences, ids put together in order; a sequence has ``most`` ids at the most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    out = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("p"))
    joined = F.expr("aggregate(p, cast('' as binary), (x, y) -> concat(x, y.ids))")
    return out.select("sequence_id", "length", joined.alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts"))
