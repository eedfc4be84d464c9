"""Document fingerprints by winnowing (operator 10).

Every run of ``gram`` code points has a rolling hash; of every ``window``
consecutive hashes the smallest is kept, the rightmost of equal ones, with its
position. Two texts that share a run of ``window + gram - 1`` code points share
a fingerprint of it: 23 as set here, so short texts and short common passages count.

Edge cases: an empty or null text has no fingerprints (two such texts are alike
to 1, one of them and another text to 0); a text of fewer code points than a
gram is one gram; fewer hashes than a window are one window. Equal document ids
are ordered by text, null ids come last in descending order. One document is
its own next document; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.ranges import range_bounds, range_tops, text_bytes
from marketlens.llm.textops import slices

GRAM, WINDOW = 16, 8
#: Text bytes of one range of documents; a range's texts pass through a task in order, one at a time.
RANGE_BYTES = 32 << 20
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    k = 1
    while k < n:                                             # doubling: base**(i + k) = base**i * base**k
        m = min(k, n - k)
        out[k:k + m] = out[:m] * np.uint64(pow(_BASE, k, 1 << 64))
        k += m
    return out


def gram_hashes(points: np.ndarray, gram: int) -> np.ndarray:
    """32-bit hashes of all runs of ``gram`` code points (of the whole text if it is shorter)."""
    gram = min(gram, len(points))
    with np.errstate(over="ignore"):
        p = points.astype(np.uint64) + np.uint64(1)
        p = (p ^ (p << np.uint64(21))) * np.uint64(0xBF58476D1CE4E5B9)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(p * _powers(len(p)), dtype=np.uint64)])
        inverse = pow(_BASE, -1, 1 << 64)
        n = len(points) - gram + 1
        back = np.empty(n, np.uint64)
        back[0] = 1
        k = 1
        while k < n:
            m = min(k, n - k)
            back[k:k + m] = back[:m] * np.uint64(pow(inverse, k, 1 << 64))
            k += m
        h = (sums[gram:] - sums[:n]) * back
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(32)).astype(np.uint64)


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) kept, in text order."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    h = gram_hashes(points, gram)
    n, w = len(h), min(window, len(h))
    key = (h << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))  # the least: smallest hash, then rightmost
    pad = -n % w
    rows = np.concatenate([key, np.full(pad, ~np.uint64(0))]).reshape(-1, w)
    before = np.minimum.accumulate(rows, axis=1).ravel()                    # minimum from the row's start
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()   # minimum to the row's end
    kept = np.unique(np.minimum(after[:n - w + 1], before[w - 1:n]))
    at = np.sort((np.uint64(0xFFFFFFFF) - (kept & np.uint64(0xFFFFFFFF))).astype(np.int64))
    return h[at].astype(np.uint32), at


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two hash sets."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited_text(text: str, follower: str) -> str:
    """The last third replaced by as many first code points of the next document."""
    cut = len(text) // 3
    return text[:len(text) - cut] + follower[:cut]


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, hashes, positions) of every document; a narrow step."""

    def run(batches):
        for b in batches:
            both = [winnow(t, gram, window) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([h.astype(np.int64) for h, _ in both], pa.list_(pa.int64())),
                                              pa.array([p for _, p in both], pa.list_(pa.int64()))], ["doc_id", "hashes", "positions"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, hashes array<bigint>, positions array<bigint>")


def next_document_report(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                         range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprints of each text and of its edited text (``edited_text`` with the next document in descending id order), with the
    code points at which their grams begin.

    Documents are dealt into id ranges; a range's first document also goes, as a
    guest, to the end of the range before it (the very first to the last range),
    so every range has its own next documents and no global order is needed.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    n = max(1, -(-text_bytes(rows, "text") // range_bytes))
    bounds = range_bounds(rows, "id", n)
    cuts = np.array(bounds, np.int64)
    tops = {len(cuts) - b: top for b, top in range_tops(rows.select("id"), cuts)}    # descending: a row for each range
    order = sorted(tops)
    host_of = {r: order[i - 1] for i, r in enumerate(order)}                # the range that a range's first document visits

    def deal(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            ranks = [len(cuts) - (int(np.searchsorted(cuts, i, side="left")) if i is not None else 0) for i in ids]
            guest = [k for k, (i, r) in enumerate(zip(ids, ranks, strict=True)) if tops[r] == i]
            take = pa.array([*range(len(ids)), *guest], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([*ranks, *(host_of[ranks[k]] for k in guest)], pa.int32()), pa.array([0] * len(ids) + [1] * len(guest), pa.int32()),
                 b.column(0).take(take), b.column(1).take(take)], ["bucket", "guest", "id", "text"])

    dealt = rows.mapInArrow(deal, "bucket int, guest int, id bigint, text string").repartitionById(len(bounds) + 1, "bucket") \
        .sortWithinPartitions("bucket", "guest", F.col("id").desc_nulls_last(), "text")

    columns = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(),
               "near_edited": pa.float64(), "near_next": pa.float64(), "positions": pa.list_(pa.int32()), "edited_positions": pa.list_(pa.int32())}

    def report(batches):
        held = None
        for b in slices(batches, 256):
            out: dict[str, list] = {k: [] for k in columns}
            for bucket, guest, i, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held is None and guest:
                    continue                                                # repeated rows of the first document
                t = t or ""
                own, at = winnow(t, gram, window)
                if held is not None:
                    old, before, print_, places = held
                    edited = edited_text(before, t)
                    other, there = winnow(edited, gram, window)
                    for k, v in zip(out, (old, len(before), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                          print_.astype(">u4").tobytes().hex(), other.astype(">u4").tobytes().hex(),
                                          likeness(print_, other), likeness(print_, own), places, there.astype(np.int32)), strict=True):
                        out[k].append(v)
                held = None if guest else (i, t, own, at.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(out[k], kind) for k, kind in columns.items()], list(out))

    return dealt.mapInArrow(report, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                            "near_edited double, near_next double, positions array<int>, edited_positions array<int>")
