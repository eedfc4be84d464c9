"""Chunks of documents, and counting which of their hashes occur elsewhere.

Two operators compare billions of word windows of which most occur once. They
deal the documents into chunks of some megabytes by a hash of the id, reduce a
chunk's windows to sorted, distinct, shortened hashes, and count those across
chunks: a counting task gets one packed list for each chunk and answers with one
packed list of counts. A shortened hash costs about two bytes on the way there
and a fraction of a byte on the way back, and a window that occurs in a third of
all documents is one entry for each chunk. Equal shortened hashes of different
windows only make more candidates, never fewer; both operators compare exactly
afterwards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.ranges import text_bytes
from marketlens.llm.textops import gathered, give_back

#: Text bytes of a chunk, and about how many hashes a counting task gets.
CHUNK_BYTES, PART_HASHES = 8 << 20, 2_000_000
#: Bytes of documents that are dealt into pieces together: the more, the fewer pieces.
PACK_BYTES = 32 << 20
#: A document without an id ranks behind all others.
NO_ID = (1 << 63) - 1


class Plan:
    """How many chunks and counting parts there are, and how long a shortened hash is."""

    def __init__(self, total_bytes: int, chunk_bytes: int = CHUNK_BYTES, part_hashes: int = PART_HASHES):
        self.words = words = max(1, total_bytes // 6)        # words have about six bytes
        self.chunks = max(1, -(-total_bytes // chunk_bytes))
        self.part_bits = max(0, (words // part_hashes).bit_length())
        self.bits = min(64, words.bit_length() + 8)          # one false candidate in about 256 windows
        self.parts = 1 << self.part_bits

    def short(self, h: np.ndarray) -> np.ndarray:
        return h >> np.uint64(64 - self.bits)

    def edges(self, short: np.ndarray) -> np.ndarray:
        """Where each part begins in sorted short hashes."""
        step = np.uint64(self.bits - self.part_bits)
        return np.append(np.searchsorted(short, np.arange(self.parts, dtype=np.uint64) << step), len(short))


def plan(docs: DataFrame, text: str, chunk_bytes: int = CHUNK_BYTES, part_hashes: int = PART_HASHES) -> Plan:
    return Plan(text_bytes(docs, text), chunk_bytes, part_hashes)


def chunk_of(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int")


def pieces(docs: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """(chunk, piece): documents, some megabytes of them at a time, dealt into chunks and packed."""

    def pack(batches):
        tool = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        for b in gathered(batches, PACK_BYTES):
            chunk = b.column(0).to_numpy()
            order = np.argsort(chunk, kind="stable")
            edges = np.flatnonzero(np.diff(chunk[order], prepend=-1, append=n))
            own = b.select(["id", "text"])
            out_chunk, out = [], []
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, own.schema, options=tool) as w:
                    w.write_table(own.take(pa.array(order[i:j])).combine_chunks())
                out_chunk.append(int(chunk[order[i]]))
                out.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(out_chunk, pa.int32()), pa.array(out, pa.binary())], ["chunk", "piece"])
        give_back()

    rows = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.select(chunk_of("id", n).alias("chunk"), "id", "text").mapInArrow(pack, "chunk int, piece binary")


def unpack(column) -> tuple[np.ndarray, pa.ChunkedArray]:
    """(ids, texts) of a chunk's pieces in ascending id order."""
    tables = [pa.ipc.open_stream(p.as_buffer()).read_all() for p in column]
    t = pa.concat_tables(tables).combine_chunks() if tables else pa.table({"id": pa.array([], pa.int64()), "text": pa.array([], pa.string())})
    t = t.set_column(1, "text", t.column("text").cast(pa.large_string()))
    ids = t.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    return ids[order], t.column("text").take(pa.array(order))


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def expand(data) -> bytes:
    return zstandard.ZstdDecompressor().decompress(bytes(data))


def distinct(ranked: np.ndarray) -> np.ndarray:
    """The distinct values of a sorted array."""
    return ranked[np.concatenate([[True], ranked[1:] != ranked[:-1]])[:len(ranked)]]


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit values: differences in byte planes, squeezed."""
    if not len(values):
        return b""
    d = np.diff(values.astype(np.uint64), prepend=values[:1].astype(np.uint64))
    width = max(1, (int(d.max()).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return int(values[0]).to_bytes(8, "little") + bytes([width]) + squeeze(planes.tobytes())


def unpack_sorted(data) -> np.ndarray:
    data = bytes(data)
    if not data:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(expand(data[9:]), np.uint8).reshape(data[8], -1)
    d = np.zeros((planes.shape[1], 8), np.uint8)
    d[:, :data[8]] = planes.T
    return np.cumsum(d.view(np.uint64).ravel(), dtype=np.uint64) + np.uint64(int.from_bytes(data[:8], "little"))


#: Rows of a chunk's packed lists; counts is empty where each hash counts one.
LISTS = "part int, chunk int, hashes binary, counts binary"
#: Rows of answers to a chunk: for each of its hashes in a part how often it was counted in all chunks, 255 at most.
ANSWERS = "chunk int, part int, counts binary"


def list_rows(p: Plan, chunk: int, short: np.ndarray, counts: np.ndarray | None = None) -> list[tuple]:
    edges = p.edges(short)
    return [(k, chunk, pack_sorted(short[a:b]), squeeze(np.minimum(counts[a:b], 255).astype(np.uint8).tobytes()) if counts is not None else b"")
            for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]


def as_table(rows: list[tuple], ddl: str) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    fields = [f.split() for f in ddl.split(", ")]
    give_back()
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.table([pa.array(list(c), kinds[k]) for c, (_, k) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


def count_across(lists: DataFrame, other=None) -> DataFrame:
    """Answers for all packed lists, one task group for each part. ``other`` turns the table of a part below zero into rows."""

    def count(table):
        chunk, part = table.column("chunk").to_pylist(), table.column("part")[0].as_py()
        if part < 0:
            return as_table(other(table), ANSWERS)
        own = [unpack_sorted(x.as_py()) for x in table.column("hashes")]
        have = [np.frombuffer(expand(c.as_py()), np.uint8) if c.as_py() else None for c in table.column("counts")]
        every = np.concatenate(own)
        n = np.concatenate([h if h is not None else np.ones(len(o), np.uint8) for h, o in zip(have, own, strict=True)])
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        first = np.flatnonzero(np.diff(ranked, prepend=~ranked[:1]) != 0)
        sums = np.minimum(np.add.reduceat(n[order].astype(np.int64), first), 255).astype(np.uint8)
        out = np.empty(len(every), np.uint8)
        out[order] = np.repeat(sums, np.diff(np.append(first, len(every))))
        ends = np.cumsum([0] + [len(o) for o in own])
        return as_table([(c, part, squeeze(out[a:b].tobytes())) for c, a, b in zip(chunk, ends[:-1], ends[1:], strict=True)], ANSWERS)

    return lists.groupBy("part").applyInArrow(count, ANSWERS)


def answers(table: pa.Table, column: str = "counts", order: str = "part") -> np.ndarray:
    """A chunk's answers in the order of its sorted hashes."""
    rows = sorted(zip(table.column(order).to_pylist(), table.column(column).to_pylist(), strict=True))
    return np.frombuffer(b"".join(expand(c) for _, c in rows), np.uint8)
