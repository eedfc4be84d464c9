"""Substring deduplication with prefix-partitioned suffix trees (operator 5).

The text of the corpus is a sequence of words. Its suffixes, cut at ``window``
words, are dealt into groups by a prefix of variable length: a word, or two or
more where so many suffixes begin alike that they would not fit a task. Each
group's suffixes make a subtree: sorted along their paths, neighbours' common
prefixes are the depths of its internal nodes, and the nodes at depth
``window`` or deeper are the maximal repeats. A node's smallest document id
decides which occurrences are removed.

Suffixes that occur in one chunk of documents only hang as leaves above that
depth; they are found by counting shortened hashes (``chunks``) and decided in
their chunk. A suffix goes to its group once for each chunk, with the chunk's
smallest id, so a passage that a third of all documents have is a few entries.

A suffix is sent as the path to its leaf: its first words as 32-bit codes, then
one edge whose label, the rest of the window, is a 64-bit hash. Two different
windows of one prefix are taken for equal with a probability of 2**-64.

Edge cases: null and empty texts and texts of fewer words than a window keep all
words; repeats within one document or among rows of one id are kept; a null id
ranks behind all ids and is returned as null. Repeated rows give one row each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketlens.llm.chunks import (ANSWERS, CHUNK_BYTES, LISTS, NO_ID, PART_HASHES, Plan, answers, as_table, count_across, expand, list_rows,
                                   distinct, pack_sorted, pieces, plan, squeeze, unpack, unpack_sorted)
from marketlens.llm.textops import utf8, window_hashes, words

WINDOW = 13
#: Suffixes of a group (about 100 bytes of memory each), and the longest prefix by which suffixes are dealt.
GROUP_SUFFIXES, PREFIX_WORDS = 1_000_000, 4


def _windows(table: pa.Table, window: int):
    """A chunk's documents, words and windows, in ascending document order."""
    ids, texts = unpack(table.column("piece"))
    data, offsets = utf8(texts)
    s, e, d, h = words(data, offsets)
    at, w = window_hashes(h, d, window)
    return ids, texts, d, h, at, w


def _prefix_hashes(h: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length):
            out = (out + h[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def _prefix_lists(h: np.ndarray, at: np.ndarray, least: float, chunk: int, parts: int) -> list[tuple]:
    """The chunk's prefixes of up to PREFIX_WORDS words with at least that many suffixes, as lists for the parts below zero."""
    found, live = [], at
    for length in range(1, PREFIX_WORDS + 1):
        p = _prefix_hashes(h, live, length)
        cell = (p >> np.uint64(40)).astype(np.int64)         # a prefix can't be frequent where its cell isn't
        often = np.bincount(cell, minlength=1 << 24)[cell] >= least
        values, index, counts = np.unique(p[often], return_inverse=True, return_counts=True)
        big = counts >= least
        found.append((values[big], counts[big]))
        live = live[often][big[index]]                       # a frequent prefix's beginnings are frequent
        if not len(live):
            break
    values, first = np.unique(np.concatenate([v for v, _ in found]), return_index=True)
    counts = np.concatenate([c for _, c in found])[first]
    part = (values % np.uint64(parts)).astype(np.int64)
    return [(-1 - k, chunk, pack_sorted(values[part == k]), squeeze(counts[part == k].astype(np.int64).tobytes())) for k in np.unique(part).tolist()]


def _prefixes_above(limit: int):
    """Of the lists of a part below zero, one row: the prefixes with more than ``limit`` suffixes."""

    def add(table: pa.Table) -> list[tuple]:
        values = np.concatenate([unpack_sorted(x.as_py()) for x in table.column("hashes")])
        counts = np.concatenate([np.frombuffer(expand(x.as_py()), np.int64) for x in table.column("counts")])
        each, index = np.unique(values, return_inverse=True)
        return [(-1, table.column("part")[0].as_py(), pack_sorted(each[np.bincount(index, counts) > limit]))]

    return add


def _groups(h: np.ndarray, at: np.ndarray, split: np.ndarray, n: int) -> np.ndarray:
    """The group of each suffix: its shortest prefix that isn't split further."""
    out = np.empty(len(at), np.int64)
    live = np.arange(len(at))
    for length in range(1, PREFIX_WORDS + 1):
        p = _prefix_hashes(h, at[live], length)
        spot = np.searchsorted(split, p)
        more = (split[np.minimum(spot, len(split) - 1)] == p) if len(split) and length < PREFIX_WORDS else np.zeros(len(p), bool)
        out[live[~more]] = ((p[~more] >> np.uint64(20)) % np.uint64(n)).astype(np.int64)
        live = live[more]
    return out


def _suffixes(ids, d, h, at, w, short_counts: np.ndarray, p: Plan, split: np.ndarray, groups: int, lead: int):
    """A chunk's distinct windows in hash order and which of them go to a group.

    (order of the windows, first window of each distinct one, its smallest id, the distinct ones that other chunks may
    have in leaf order, their ``lead`` first words' codes, their groups)
    """
    order = np.argsort(w, kind="stable")                     # windows stand in ascending document order, and stay so
    ranked = w[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])[:len(ranked)])
    short = p.short(ranked[first])
    sent = np.flatnonzero(short_counts[np.cumsum(np.concatenate([[0], short[1:] != short[:-1]]))[:len(short)]] >= 2)
    codes = (h[at[order[first[sent]]][:, None] + np.arange(lead)] >> np.uint64(32)).astype(np.uint32)
    rank = np.lexsort([ranked[first[sent]], *codes.T[::-1]])  # the order of the tree's leaves
    sent, codes = sent[rank], codes[rank]
    return order, first, ids[d[at[order[first]]]], sent, codes, _groups(h, at[order[first[sent]]], split, groups)


def _pack_suffixes(codes: np.ndarray, tail: np.ndarray, least: np.ndarray) -> bytes:
    """One group's suffixes of a chunk: the first words column by column, the last edges, the smallest ids."""
    ids, index = np.unique(least, return_inverse=True)
    packed = [pack_sorted(ids.view(np.uint64) ^ np.uint64(1 << 63)),
              squeeze(tail.tobytes() + np.ascontiguousarray(codes.T).tobytes() + index.astype(np.uint32).tobytes())]
    return b"".join(len(p).to_bytes(8, "little") + p for p in packed) + len(least).to_bytes(8, "little")


def _unpack_suffixes(data: bytes):
    """(first words by row, last edges, smallest ids)."""
    a = int.from_bytes(data[:8], "little")
    ids = (unpack_sorted(data[8:8 + a]) ^ np.uint64(1 << 63)).view(np.int64)
    b, n = int.from_bytes(data[8 + a:16 + a], "little"), int.from_bytes(data[-8:], "little")
    raw = expand(data[16 + a:16 + a + b])
    rest = np.frombuffer(raw, np.uint32, offset=8 * n).reshape(-1, n)
    return rest[:-1], np.frombuffer(raw, np.uint64, n), ids[rest[-1]]


def subtree(codes: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A group's subtree: (leaf order, first leaf of each node at the window's depth), nodes of one leaf included.

    codes has a row for each of the first words. The leaves are sorted along their paths; a node begins where the
    common path with the leaf before ends above the window's depth.
    """
    order = np.lexsort([tail, *codes[::-1]])
    common = np.ones(max(len(order) - 1, 0), bool)
    for row in (*codes, tail):
        ranked = row[order]
        common &= ranked[1:] == ranked[:-1]
    return order, np.flatnonzero(np.concatenate([[True], ~common])[:len(order)])


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES,
                   part_hashes: int = PART_HASHES, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words not covered by a window that also starts in a document of a smaller
    id, joined by one space."""
    from marketlens.session import cut_lineage
    p = plan(docs, text, chunk_bytes, part_hashes)
    packed = pieces(docs, doc_id, text, p.chunks)

    def count_lists(key, table):
        _, _, d, h, at, w = _windows(table, window)
        own = key[0].as_py()
        return as_table(list_rows(p, own, distinct(np.sort(p.short(w))))
                        + _prefix_lists(h, at, max(2, group_suffixes / (2 * p.chunks)), own, p.parts), LISTS)

    lists = packed.groupBy("chunk").applyInArrow(count_lists, LISTS)
    held = cut_lineage(count_across(lists, _prefixes_above(group_suffixes)))
    over = [unpack_sorted(r["counts"]) for r in held.where("chunk < 0").collect()]   # at most PREFIX_WORDS for each group_suffixes windows
    split = np.unique(np.concatenate(over)) if over else np.zeros(0, np.uint64)
    groups, lead = max(1, p.words // group_suffixes), min(PREFIX_WORDS, window)
    counts = held.where("chunk >= 0")

    def send(key, left, right):
        ids, _, d, h, at, w = _windows(left, window)
        order, first, least, sent, codes, group = _suffixes(ids, d, h, at, w, answers(right), p, split, groups, lead)
        rows = []
        for g in np.unique(group).tolist():
            own = np.flatnonzero(group == g)
            rows.append((g, key[0].as_py(), _pack_suffixes(codes[own], w[order[first[sent[own]]]], least[sent[own]])))
        return as_table(rows, "grp int, chunk int, suffixes binary")

    def judge(table):
        chunk, group = table.column("chunk").to_pylist(), table.column("grp")[0].as_py()
        parts = [_unpack_suffixes(x.as_py()) for x in table.column("suffixes")]
        least = np.concatenate([x[2] for x in parts])
        order, first = subtree(np.concatenate([x[0] for x in parts], axis=1), np.concatenate([x[1] for x in parts]))
        smallest = np.repeat(np.minimum.reduceat(least[order], first), np.diff(np.append(first, len(order))))
        later = np.empty(len(order), np.uint8)
        later[order] = smallest < least[order]
        ends = np.cumsum([0] + [len(x[2]) for x in parts])
        return as_table([(c, -1 - group, squeeze(later[a:b].tobytes())) for c, a, b in zip(chunk, ends[:-1], ends[1:], strict=True)], ANSWERS)

    sent_rows = packed.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(send, "grp int, chunk int, suffixes binary")
    verdicts = sent_rows.groupBy("grp").applyInArrow(judge, ANSWERS)

    def finish(key, left, right):
        ids, texts, d, h, at, w = _windows(left, window)
        counted = np.array([x >= 0 for x in right.column("part").to_pylist()], bool)
        order, first, least, sent, _, group = _suffixes(ids, d, h, at, w, answers(right.filter(pa.array(counted))), p, split, groups, lead)
        later = np.zeros(len(first), bool)
        for part, blob in zip(right.column("part").to_pylist(), right.column("counts").to_pylist(), strict=True):
            if part < 0:
                later[sent[group == -1 - part]] = np.frombuffer(expand(blob), np.uint8).astype(bool)
        size = np.diff(np.append(first, len(order)))
        out = np.repeat(later, size) | (ids[d[at[order]]] > np.repeat(least, size))
        starts = at[order[out]]
        edge = np.bincount(starts, minlength=len(h) + window + 1)
        np.subtract.at(edge, starts + window, 1)
        gone = np.cumsum(edge)[:len(h)] > 0
        n_words = np.bincount(d, minlength=len(ids))
        n_gone = np.bincount(d[gone], minlength=len(ids))
        ends = np.cumsum(np.concatenate([[0], n_words]))
        kept = []
        for k, t in enumerate(texts):
            own = t.as_py().encode("utf-8").split()
            kept.append(b" ".join(compress(own, ~gone[ends[k]:ends[k + 1]]) if n_gone[k] else own).decode("utf-8"))
        return pa.table([pa.array(ids, mask=ids == NO_ID), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(kept, pa.string())],
                        names=["doc_id", "n_words", "n_removed", "kept"])

    return packed.groupBy("chunk").cogroup(counts.unionByName(verdicts).groupBy("chunk")).applyInArrow(
        finish, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def brute_force(docs, window: int = WINDOW):
    """[(doc_id, n_words, n_removed, kept)] for a small list of (doc_id, text), by a dictionary of windows (for tests)."""
    split = [(i, (t or "").encode().split()) for i, t in docs]
    rank = lambda i: NO_ID if i is None else i
    least: dict[tuple, int] = {}
    for i, w in split:
        for k in range(len(w) - window + 1):
            least[tuple(w[k:k + window])] = min(rank(i), least.get(tuple(w[k:k + window]), NO_ID))
    out = []
    for i, w in split:
        gone = {j for k in range(len(w) - window + 1) if least[tuple(w[k:k + window])] < rank(i) for j in range(k, k + window)}
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return out
