"""Benchmark decontamination by Wu-Manber multi-pattern search (operator 3).

Every window of ``window`` consecutive benchmark words is a pattern of bytes
(the words between single blanks, blanks at both ends, so occurrences are
whole words). A block shift table tells how far the search may jump from the
block it looks at; a block with shift 0 selects the bucket of patterns whose
first ``m`` bytes end in that block, and direct comparison confirms.

Edge cases: a null text or a text without words has 0 words and no hits; a
benchmark item without words has no window; an item of fewer words than the
window is one window; repeated items and windows count once; a null item id is
the id ''. An empty benchmark gives no hits, an empty document table no rows.
Repeated document rows give one row each. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.textops import slices

#: Lower-case A-Z, blank out the other ASCII bytes that are no word characters.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))
#: Normalised benchmark bytes whose patterns make one broadcast; more items take further blocks.
BLOCK_BYTES = 8 << 20


def normalise(text: str | None) -> bytes:
    """The text's words, lower-cased, between single blanks."""
    w = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
    return b" " + b" ".join(w) + b" " if w else b""


def windows(norm: bytes, size: int) -> set[bytes]:
    """The patterns of one item."""
    w = norm.split()
    return {b" " + b" ".join(w[i:i + size]) + b" " for i in range(max(1, len(w) - size + 1))} if w else set()


def shift_tables(patterns: dict[bytes, list[str]]) -> list[tuple]:
    """One (m, block, shift, bucket) for the patterns of similar length: within a factor of two, so that one
    short pattern doesn't shorten the jumps of the long ones."""
    classes: dict[int, list[bytes]] = {}
    for p in patterns:
        classes.setdefault(min(len(p).bit_length(), 6), []).append(p)
    tables = []
    for _, own in sorted(classes.items()):
        m = min(map(len, own))
        block = max(2, min(8, m // 3))
        shift: dict[bytes, int] = {}
        bucket: dict[bytes, list[bytes]] = {}
        for p in own:
            for end in range(block, m + 1):
                b = p[end - block:end]
                shift[b] = min(shift.get(b, m), m - end)
            bucket.setdefault(p[m - block:m], []).append(p)
        tables.append((m, block, shift, bucket))
    return tables


def occurrences(tables: list[tuple], text: bytes) -> Iterator[tuple[int, bytes]]:
    """(start, pattern) of every occurrence."""
    for m, block, shift, bucket in tables:
        at, n, jump, get = m, len(text), m - block + 1, shift.get
        while at <= n:
            step = get(text[at - block:at], jump)
            if step:
                at += step
                continue
            for p in bucket[text[at - block:at]]:
                if text.startswith(p, at - m):
                    yield at - m, p
            at += 1


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _search(block):
    """Adds one block's hits to the spans and items found so far."""

    def run(batches):
        patterns, tables = block.value
        for batch in slices(batches):
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            words, spans, items = [], [], []
            for text, old, known in zip(cols["_text"].to_pylist(), cols["_spans"].to_pylist(),
                                        cols["_items"].to_pylist(), strict=True):
                norm = normalise(text)
                words.append(max(norm.count(b" ") - 1, 0))
                found, names = [tuple(old[i:i + 2]) for i in range(0, len(old), 2)], set(known)
                at = seen = 0
                for start, p in sorted(occurrences(tables, norm)):
                    seen += norm.count(b" ", at, start)
                    at = start
                    found.append((seen, seen + p.count(b" ") - 1))
                    names.update(patterns[p])
                spans.append([x for s in _merge(found) for x in s])
                items.append(sorted(names))
            yield pa.RecordBatch.from_arrays(
                [cols["_id"], cols["_text"], pa.array(words, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
                 pa.array(items, pa.list_(pa.string()))], ["_id", "_text", "_words", "_spans", "_items"])

    return run


def _blocks(benchmark: DataFrame, item_id: str, text: str, size: int, limit: int):
    """Pattern tables of at most ``limit`` bytes of benchmark text each; one table is held at a time."""
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t"))
    held: dict[bytes, list[str]] = {}
    used = 0
    for r in rows.toLocalIterator():
        for p in windows(normalise(r["t"]), size):
            ids = held.setdefault(p, [])
            if r["i"] not in ids:
                ids.append(r["i"])
            used += len(p)
            if used >= limit:
                yield held, shift_tables(held)
                held, used = {}, 0
    yield held, shift_tables(held)


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_words, spans, items): the hit word spans [start, end) and the ids of the items found; keep_text adds the text.

    The benchmark goes through the driver in blocks of ``block_bytes``; each
    block is one narrow step over the documents, so nothing is shuffled and no
    broadcast exceeds a block's table however large the benchmark is.
    """
    spark = docs.sparkSession
    state = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.lit(0).cast("bigint").alias("_words"),
                        F.array().cast("array<bigint>").alias("_spans"), F.array().cast("array<string>").alias("_items"))
    schema = state.schema
    for table in _blocks(benchmark, item_id, item_text, window, block_bytes):
        state = state.mapInArrow(_search(spark.sparkContext.broadcast(table)), schema)
    return state.select(F.col("_id").alias("doc_id"), F.col("_words").alias("n_words"), F.col("_spans").alias("spans"),
                        F.col("_items").alias("items"), *([F.col("_text").alias("text")] if keep_text else []))


def leak_report(found: DataFrame) -> DataFrame:
    """The digest columns of ``find_leaks``."""
    pairs = F.sequence(F.lit(0), F.size("spans") - 2, F.lit(2))
    hit = F.when(F.size("spans") == 0, F.lit(0)).otherwise(
        F.aggregate(F.when(F.size("spans") > 0, pairs).otherwise(F.array().cast("array<int>")), F.lit(0).cast("bigint"),
                    lambda acc, i: acc + F.get("spans", i + 1) - F.get("spans", i)))
    return found.select("doc_id", "n_words", hit.cast("bigint").alias("n_hit"),
                        F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256")
                        ).withColumn("contaminated", F.col("n_hit") > 0)


def brute_force(docs, items, window: int = 10):
    """The same digest for small Python lists, by comparing every position (for tests)."""
    pats = [(str(i) if i is not None else "", [w.split() for w in windows(normalise(t), window)]) for i, t in items]
    out = []
    for d, t in docs:
        w = normalise(t).split()
        hit, names = set(), set()
        for name, ps in pats:
            for p in ps:
                for k in range(len(w) - len(p) + 1):
                    if w[k:k + len(p)] == p:
                        hit.update(range(k, k + len(p)))
                        names.add(name)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
                    bool(hit)))
    return out
