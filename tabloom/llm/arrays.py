"""Whole Arrow columns of text as byte arrays, and prefix polynomial hashes over them."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: An odd multiplier (so that it has an inverse modulo 2^64) and the constants of a 64-bit finaliser.
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
UNBASE = pow(BASE, -1, 1 << 64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and n + 1 offsets; a null text is empty."""
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, raw_offsets, data = column.buffers()
    offsets = np.frombuffer(raw_offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    body = everything[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if column.null_count:  # what lies under a null doesn't count
        nulls = column.is_null().to_numpy(zero_copy_only=False)
        sizes = np.diff(offsets)
        if sizes[nulls].any():
            body = body[np.repeat(~nulls, sizes)]
            sizes[nulls] = 0
            offsets = np.concatenate([[0], np.cumsum(sizes)])
    return body, offsets


def portions(batches: Iterator[pa.RecordBatch], text_of, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``most`` bytes of text, or one row; no copy is made."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        _, offsets = text_bytes(text_of(batch))
        at = 0
        while at < n:
            upto = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
            upto = min(max(upto, at + 1), n)
            yield batch.slice(at, upto - at)
            at = upto
    release()


def release() -> None:
    """Gives back to the system what a task has freed: Python workers stay for the tasks that follow, and otherwise keep it meanwhile."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE^0 .. BASE^n modulo 2^64, or of its inverse; kept for the next call up to 64 MB."""
    name = "inverse" if inverse else "plain"
    have = _powers.get(name)
    if have is None or len(have) < n + 1:
        have = np.full(max(n + 1, 1 << 16), UNBASE if inverse else BASE, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= 8 << 20:
            _powers[name] = have
    return have[: n + 1]


def prefix_hash(body: np.ndarray) -> np.ndarray:
    """H with H[i] = sum of (value + 1) * BASE^j over j < i, modulo 2^64."""
    out = np.empty(len(body) + 1, np.uint64)
    out[0] = 0
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * powers(len(body))[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of bytes start..stop, the same wherever the bytes stand."""
    return (prefix[stop] - prefix[start]) * powers(len(prefix) - 1, inverse=True)[start]


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser, a bijection."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(MIX[0])
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX[1])
    x ^= x >> np.uint64(31)
    return x
