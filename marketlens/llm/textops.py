"""Vectorised word handling on Arrow string columns.

A batch of texts is one UTF-8 byte array plus document offsets. The word
delimiters of the contracts are ASCII, and no byte of a multi-byte UTF-8
character is ASCII, so words can be found and hashed on the bytes without
making Python strings.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

#: The word delimiters of ``[^\x20\x09-\x0D]+``.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
#: Bytes of one pass over a batch: its temporary arrays then stay in the processor's cache.
BLOCK = 1 << 18
#: Rows of a batch that goes to Python (short_batches).
BATCH_ROWS = 256
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null is the empty text."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.large_string())
    arr = arr.cast(pa.large_string()).fill_null("")
    n = len(arr)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, arr.offset * 8) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all else unchanged."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    return out


def runs(offsets: np.ndarray):
    """Runs [i, j) of documents of about BLOCK bytes each (one document at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + BLOCK, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document index) of every word, in order."""
    starts, ends, docs = [], [], []
    for i, j in runs(offsets):
        a, b = offsets[i], offsets[j]
        part = data[a:b]
        if not len(part):
            continue
        inside = ~((part == 32) | ((part >= 9) & (part <= 13)))
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cuts = (offsets[i:j] - a)[offsets[i:j] < b]      # a document's first byte starts a word, the byte before ends one
        first[cuts] = inside[cuts]
        cuts = cuts[cuts > 0]
        last[cuts - 1] = inside[cuts - 1]
        s = np.flatnonzero(first)
        starts.append(s + a)
        ends.append(np.flatnonzero(last) + 1 + a)
        docs.append(np.searchsorted(offsets[i + 1:j + 1] - a, s, side="right") + i)
    if not starts:
        z = np.zeros(0, np.int64)
        return z, z, z
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(docs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes at a time."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    base = int(starts[0])
    buf = np.zeros(int(ends[-1]) - base + 16, np.uint8)
    buf[:int(ends[-1]) - base] = data[base:int(ends[-1])]
    lanes = np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))
    at, left = starts - base, ends - starts
    out = mix64(left.astype(np.uint64) * _STEP)
    masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    out = mix64(out ^ (lanes[at] & masks[np.minimum(left, 8)]))
    live = np.flatnonzero(left > 8)                        # the words with bytes left
    at, left = at[live] + 8, left[live] - 8
    while len(live):
        out[live] = mix64((out[live] + _STEP) ^ (lanes[at] & masks[np.minimum(left, 8)]))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return out


def words(data: np.ndarray, offsets: np.ndarray):
    """(start, end, document, hash) of every word."""
    s, e, d = word_spans(data, offsets)
    h = np.empty(len(s), np.uint64)
    edges = np.searchsorted(s, np.arange(0, (s[-1] if len(s) else 0) + BLOCK, BLOCK)) if len(s) else np.zeros(1, np.int64)
    edges = np.unique(np.append(edges, len(s)))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        h[a:b] = span_hashes(data, s[a:b], e[a:b])
    return s, e, d, h


def window_hashes(h: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every run of ``size`` words inside one document."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ok = np.flatnonzero(doc[:n] == doc[size - 1:])
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        m = np.uint64(1)
        for k in range(size):
            out += h[k:k + n] * m
            m = m * np.uint64(0xD6E8FEB86659FD93)
    return ok, mix64(out[ok] + _STEP)


def give_back() -> None:
    """Returns freed memory to the system: Python processes wait for further tasks, and what they hold counts."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def short_batches(spark) -> None:
    """Texts go to Python by BATCH_ROWS rows where the session doesn't say by how many: a batch of whole texts is held on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_ROWS))


def gathered(batches, size: int):
    """Tables of about so many bytes, however the batches are cut."""
    held, used = [], 0
    for b in batches:
        held.append(b)
        used += b.nbytes
        if used >= size:
            table, held, used = pa.Table.from_batches(held).combine_chunks(), [], 0
            yield table
    if held:
        table, held = pa.Table.from_batches(held).combine_chunks(), []
        yield table


def slices(batches, rows: int = 1_000):
    """The batches in runs of at most so many rows, so that a run's Python copies stay small."""
    for b in batches:
        for i in range(0, len(b), rows):
            yield b.slice(i, rows)
    give_back()
