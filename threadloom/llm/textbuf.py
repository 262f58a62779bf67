"""Arrow string columns as byte buffers: slices of bounded size, words and
their 64-bit hashes, all vectorised."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once (a longer text is handled alone).
SLICE_BYTES = 8 << 20
#: Bytes whose word hashes are formed at once.
WINDOW_BYTES = 1 << 20

_U64 = np.uint64
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
WORDS = (~SEPARATOR).astype(np.uint8)
#: Letters, digits and all beyond ASCII; other signs.
WORDS_AND_SIGNS = np.where(SEPARATOR, 0, 2).astype(np.uint8)
WORDS_AND_SIGNS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply) over a uint64 array."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random uint64 values of a seed."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _U64(0x9E3779B97F4A7C15) + _U64(seed))


_BYTE = stream(11, 256)[_LOWER]
_BYTE[SEPARATOR] = 0
_BASE = int(stream(12, 1)[0]) | 1


def as_large(column: pa.Array) -> pa.Array:
    """The column as large_string, null as empty."""
    return column.cast(pa.large_string()).fill_null("")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n+1 offsets from 0) of a large_string or large_binary column without nulls."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of rows with at most ``limit`` text bytes, each with its text column."""
    text = as_large(batch.column(batch.schema.get_field_index(column)))
    _, off = buffers(text)
    at = 0
    while at < len(text):
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at), text.slice(at, end - at)
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of every text, A-Z lower-cased,
    and the n+1 offsets of each text's words.  With other ``kinds`` (of the 256
    bytes; 0 separates) a word is a run of bytes of one kind."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    kind = kinds[data]
    first = np.empty(len(data), dtype=bool)
    first[0] = True
    first[1:] = kind[:-1] != kind[1:]
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(first & (kind > 0))
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    ends = np.append(starts[1:], len(data))
    out = np.empty(len(starts), np.uint64)
    longest = int((ends - starts).max())
    power = np.multiply.accumulate(np.append(_U64(1), np.full(longest - 1, _BASE, np.uint64)))
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + WINDOW_BYTES, "right")))
        lo, hi = starts[at], ends[to - 1]
        own = starts[at:to] - lo
        place = np.arange(hi - lo) - np.repeat(own, ends[at:to] - starts[at:to])
        out[at:to] = np.add.reduceat(_BYTE[data[lo:hi]] * power[place], own)
        at = to
    return mix(out), np.searchsorted(starts, offsets)
