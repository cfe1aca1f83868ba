"""Words and word shingles of Arrow string columns as numpy arrays of 64-bit hashes.

All work is on UTF-8 bytes. A word class is a table of 256 values: 0 for bytes between words,
else a random value per byte (the same for both cases of a letter). A word's hash is a
polynomial over its bytes modulo 2**64, followed by a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at once; a bound on temporary memory, not on texts.
PIECE = 1 << 20
#: Bytes of text handed to an operator at once; a longer document comes alone.
GROUP = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_class(is_word) -> np.ndarray:
    """Values of the bytes for which ``is_word(byte)`` holds; upper-case ASCII counts as lower case."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    for b in range(0x41, 0x5B):
        values[b] = values[b + 32]
    for b in range(256):
        if not is_word(b + 32 if 0x41 <= b <= 0x5A else b):
            values[b] = 0
    return values


#: Words are runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
SPACED = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words are runs of ASCII letters and digits and of everything beyond ASCII.
ALNUM = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)

_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base]


@dataclass
class Words:
    """Words in text order: byte range in the group's buffer, document number, hash."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
    return data, offsets.astype(np.int64)


def groups(column: pa.Array, limit: int = GROUP) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive documents of about ``limit`` bytes: first row, bytes, offsets from 0."""
    data, offsets = string_buffers(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> Words:
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts, ends, hashes = [], [], []
    at = 0
    while at < n:
        stop = min(at + PIECE, n)
        while stop < n and not edge[stop] and values[data[stop]]:
            # not inside a word: go on to the next byte that ends one
            ahead = values[data[stop : stop + 4096]] == 0
            ahead |= edge[stop : stop + len(ahead)]
            stop += int(ahead.argmax()) if ahead.any() else len(ahead)
        v = values[data[at:stop]]
        inside = v != 0
        before = np.empty_like(inside)
        before[0] = False
        before[1:] = inside[:-1]
        before[edge[at:stop]] = False
        s = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1] = False
        after[:-1] = inside[1:]
        after[edge[at + 1 : stop + 1]] = False
        e = np.flatnonzero(inside & ~after) + 1
        total = np.cumsum(v * _power(_BASE, len(v))[: len(v)])
        h = total[e - 1]
        h[s > 0] -= total[s[s > 0] - 1]
        h *= _power(_INVERSE, len(v))[s]
        hashes.append(mix(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        starts.append(s + at)
        ends.append(e + at)
        at = stop
    start = np.concatenate(starts) if starts else np.empty(0, np.int64)
    end = np.concatenate(ends) if ends else np.empty(0, np.int64)
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(start, end, doc, np.concatenate(hashes) if hashes else np.empty(0, np.uint64))


def combine(hashes: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of words, from the hashes at each place."""
    total = np.full(len(hashes[0]), len(hashes), np.uint64)
    for h in hashes:
        total = total * np.uint64(_BASE) + h
    return mix(total)


def shingles(w: Words, n_docs: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words and their offsets per document.

    A document of fewer words, but not none, has one shingle: its whole sequence.
    """
    bounds = np.searchsorted(w.doc, np.arange(n_docs + 1))
    count = np.diff(bounds)
    full = len(w.hash) - width + 1
    sizes = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    out = np.empty(int(sizes.sum()), np.uint64)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    if full > 0:
        h = combine([w.hash[k : k + full] for k in range(width)])
        keep = w.doc[:full] == w.doc[width - 1 :]
        wanted = np.repeat(count >= width, sizes)
        out[wanted] = h[keep]
    for d in np.flatnonzero((count > 0) & (count < width)):
        own = w.hash[bounds[d] : bounds[d + 1]]
        out[offsets[d]] = combine([own[k : k + 1] for k in range(len(own))])[0]
    return out, offsets
