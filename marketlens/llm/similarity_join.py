"""N-gram Jaccard join, size-aware with heavy and light sets (operator 9).

A document's set holds the hashes of its distinct word shingles; two documents
link when percent of their sets' union is common. Documents of equal sets are one
class. Classes are joined in two ways, divided by size:

* light sets: all subsets of the sizes that a link can need are enumerated as
  hashes; sets that share one of the size their pair needs are linked;
* heavy sets: inverted lists of the rarest shingles are scanned (a link can't miss
  all of a set's n - need + 1 rarest ones, in one order that all sets share), and
  overlaps are counted exactly within the sets that meet.

The boundary is the largest size whose subsets are fewer than the list entries
that scanning would read, by the lists' measured lengths.

Before that, shingles are counted across chunks of documents (``chunks``); a set
that has too few shingles in common with others can't link and drops out, and the
counts give the order of rarity. A list is handled under its first document, so
lists with the same first document share their work. The members of a large group
are first compared with that document alone; those that link with it are one
component, and only the others are compared with all, in blocks, each pair of
blocks a task of bounded size. A task returns a forest of the links it found, not
the links, and components are computed from the forests, so a group of near
copies makes no pairs. A large group whose members don't link with its first
document still takes a task for each pair of its blocks.

Edge cases: null and empty texts have the empty set and are linked with nothing; a
text of fewer words than a shingle is one shingle. Repeated rows and rows of one
id are documents of their own; a null id ranks behind all ids, and a component
that has no other id has the id null. An empty table gives no rows; other columns
are not read. Hashes are of 64 bits, class names of 128.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.chunks import (CHUNK_BYTES, LISTS, NO_ID, PART_HASHES, answers, as_table, chunk_of, count_across, distinct,
                                   list_rows, pieces, plan, unpack)
from marketlens.llm.components import components
from marketlens.llm.textops import give_back, lower_ascii, mix64, runs, utf8, window_hashes, words

WORDS, PERCENT = 5, 80
#: Sets of a block; a task holds two blocks at most. Bytes of sets that a task should get if its groups are small.
BLOCK, TASK_BYTES = 256, 2 << 20
#: Pivots' sets up to this many bytes are broadcast; more are joined by shuffling.
PIVOT_BYTES = 32 << 20
#: Light sets have at most this many elements whatever the costs.
LIGHT = 32


def need(n: int, percent: int) -> int:
    """Common elements without which a set of n links with no set."""
    return -(-percent * n // 100)


def doc_sets(texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(ends, hashes): each text's distinct shingle hashes, ascending; text k has hashes[ends[k]:ends[k + 1]]. Taken in runs
    of about a megabyte of text, so that the arrays of words and windows are a run's and not the chunk's."""
    data, offsets = utf8(texts)
    counts, hashes = [np.zeros(1, np.int64)], [np.zeros(0, np.uint64)]
    for i, j in runs(offsets):
        n, w = _run_sets(lower_ascii(data[offsets[i]:offsets[j]]), offsets[i:j + 1] - offsets[i], size)
        counts.append(n)
        hashes.append(w)
    return np.cumsum(np.concatenate(counts)), np.concatenate(hashes)


def _run_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts, hashes): how many distinct shingle hashes each text has, and those hashes, a text's ascending."""
    _, _, d, h = words(data, offsets)
    n_words = np.bincount(d, minlength=len(offsets) - 1)
    at, w = window_hashes(h, d, size)
    owner = d[at]
    for length in range(1, size):                            # texts of fewer words
        own = n_words[d] == length
        if own.any():
            k, v = window_hashes(h[own], d[own], length)
            owner, w = np.append(owner, d[own][k]), np.append(w, v)
    order = np.argsort(owner, kind="stable")
    owner, w = owner[order], w[order]
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(offsets) - 1))])
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        w[a:b].sort()
    keep = np.ones(len(w), bool)
    keep[1:] = (w[1:] != w[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[keep], minlength=len(offsets) - 1), w[keep]


def set_names(ends: np.ndarray, hashes: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each set; None for the empty set."""
    n = np.diff(ends)
    full = np.flatnonzero(n)
    a = np.add.reduceat(mix64(hashes ^ np.uint64(0x9E3779B97F4A7C15)), ends[full]) if len(full) else np.zeros(0, np.uint64)
    b = np.bitwise_xor.reduceat(mix64(hashes + np.uint64(0xD6E8FEB86659FD93)), ends[full]) if len(full) else np.zeros(0, np.uint64)
    out: list[bytes | None] = [None] * len(n)
    for k, x, y in zip(full.tolist(), mix64(a + n[full].astype(np.uint64)), b, strict=True):
        out[k] = x.tobytes() + y.tobytes()
    return out


def _sets(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(id, n, name) of every document."""

    def run(batches):
        for b in batches:
            _, offsets = utf8(b.column(1))
            for start, end in runs(offsets):                 # a megabyte or one text at a time
                part = b.slice(start, end - start)
                ends, hashes = doc_sets(part.column(1), size)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(ends), pa.int64()), pa.array(set_names(ends, hashes), pa.binary())],
                                                 ["id", "n", "name"])
        give_back()

    rows = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id bigint, n bigint, name binary")


def _chosen(left: pa.Table, right: pa.Table, size: int):
    """[(id, name, hashes)] of a chunk's class representatives."""
    ids, texts = unpack(left.column("piece"))
    want = dict(zip(right.column("name").to_pylist(), right.column("id").to_pylist(), strict=True))
    want.pop(None, None)
    own = np.flatnonzero(np.isin(ids, np.array(list(want.values()), np.int64)))
    texts = texts.take(pa.array(own))                        # the others are given back
    ends, hashes = doc_sets(texts, size)
    del texts
    give_back()
    out = []
    for k, name in enumerate(set_names(ends, hashes)):
        if name is not None and want.get(name) == ids[own[k]]:
            out.append((want.pop(name), name, hashes[ends[k]:ends[k + 1]]))
    return out


def _light_links(light: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between small sets. Of the sets with one common subset the smallest links with all that link with any."""

    def subsets(batches):
        for b in batches:
            out: dict[str, list] = {"common": [], "subset": [], "n": [], "name": []}
            for name, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = mix64(np.frombuffer(raw, np.uint64)).tolist()
                n, every = len(own), sum(own)
                for common in range(need(n, percent), n + 1):
                    sums = [every - sum(c) for c in combinations(own, n - common)]
                    out["common"] += [common] * len(sums)
                    out["subset"] += [((s & ((1 << 64) - 1)) ^ (1 << 63)) - (1 << 63) for s in sums]
                    out["n"] += [n] * len(sums)
                    out["name"] += [name] * len(sums)
            yield pa.RecordBatch.from_arrays([pa.array(out["common"], pa.int32()), pa.array(out["subset"], pa.int64()), pa.array(out["n"], pa.int32()),
                                              pa.array(out["name"], pa.binary())], list(out))

    rows = light.select("name", "hashes").mapInArrow(subsets, "common int, subset bigint, n int, name binary")
    first = rows.groupBy("common", "subset").agg(F.min(F.struct("n", "name")).alias("first"), F.count("*").alias("k")).where("k > 1")
    return rows.join(first, ["common", "subset"]).where(
        (F.col("name") != F.col("first.name")) & (100 * F.col("common") >= percent * (F.col("n") + F.col("first.n") - F.col("common")))).select(
        F.col("first.name").alias("a"), F.col("name").alias("b"))


def link_forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """(root, member) pairs that span the links among a few sets. Overlaps are counted over the inverted lists of
    the shingles that at least two sets have, a slice of the lists at a time."""
    n = np.array([len(s) for s in sets])
    every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    token = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))
    common = np.bincount(token) > 1
    keep = common[token]
    row, col = owner[order][keep], (np.cumsum(common) - 1)[token[keep]]
    overlap = np.zeros((len(sets), len(sets)), np.float32)   # exact: counts stay far below 2**24
    step = 4096
    edges = np.searchsorted(col, np.arange(0, (int(col[-1]) if len(col) else -1) + 1 + step, step))
    for k in range(len(edges) - 1):
        a, b = edges[k], edges[k + 1]
        x = np.zeros((len(sets), step), np.float32)
        x[row[a:b], col[a:b] - k * step] = 1
        overlap += x @ x.T
    links = 100 * overlap.astype(np.int64) >= percent * (n[:, None] + n[None, :] - overlap.astype(np.int64))
    out, seen = [], np.zeros(len(sets), bool)
    for root in range(len(sets)):
        if seen[root]:
            continue
        seen[root] = True
        edge = np.array([root])
        while len(edge):
            new = links[edge].any(axis=0) & ~seen
            edge = np.flatnonzero(new)
            seen |= new
            out += [(root, int(m)) for m in edge]
    return out


def _overlapping(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets link."""
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
    return 100 * both >= percent * (len(a) + len(b) - both)


def _pivot_links(big: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(pivot, name, linked) of the members of large families: whether a member links with its pivot. The pivots' sets are
    broadcast while they are few; a family's members are spread by name."""
    schema = "pivot binary, name binary, linked boolean"
    heads = big.select("pivot").distinct().join(sets.select(F.col("name").alias("pivot"), F.col("hashes").alias("head")), "pivot")
    few = (heads.agg(F.sum(F.octet_length("head"))).first()[0] or 0) <= PIVOT_BYTES

    def compare(batches):
        for b in batches:
            pivot, name, own, head = (b.column(i).to_pylist() for i in range(4))
            linked = [_overlapping(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(own, head, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(linked, pa.bool_())], ["pivot", "name", "linked"])

    rows = big.select("pivot", "name").join(sets.select("name", "hashes"), "name")
    return rows.join(F.broadcast(heads) if few else heads, "pivot").select("pivot", "name", "hashes", "head").mapInArrow(compare, schema)


def _cells(sets: DataFrame, lists: DataFrame, percent: int, block: int, task_bytes: int) -> tuple[DataFrame, DataFrame]:
    """((bucket, family, pivot, lo, hi, name, hashes): the sets of each pair of blocks; (a, b): links already found).

    A family of several blocks is first compared with its pivot. Members that link with it are one component: they need no
    comparing among themselves, only with those that don't. So blocks of the others are paired with all blocks of the
    family, each pair a task of its own, named by family, lo and hi. Whole families of one block share the buckets.
    lists: (token, id, name)."""
    from marketlens.session import cut_lineage
    first = lists.groupBy("token").agg(F.min(F.struct("id", "name")).alias("first"), F.count("*").alias("k")).where("k > 1")
    members = lists.join(first.select("token", F.col("first.name").alias("pivot")), "token").select("pivot", "name").distinct()
    members = cut_lineage(members)
    size = members.groupBy("pivot").count().where("count > 1")
    whole = members.join(size.where(F.col("count") <= block).select("pivot"), "pivot")
    big = members.join(size.where(F.col("count") > block).select("pivot"), "pivot")
    total = whole.join(sets.select("name", "n"), "name").agg(F.sum("n")).first()[0] or 0
    tasks = max(1, -(-8 * total // task_bytes))
    shared = whole.select(F.pmod(F.xxhash64("pivot"), F.lit(tasks)).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("family"), "pivot",
                          F.lit(0).alias("lo"), F.lit(0).alias("hi"), "name")
    known = cut_lineage(_pivot_links(big, sets, percent))
    blocks = lambda c: F.ceil(F.count_if(c) / block).cast("int")
    parts = known.groupBy("pivot").agg(blocks(~F.col("linked")).alias("others"), blocks(F.col("linked")).alias("ours")).where("others > 0")
    # dealt by name before the copies are made: one large family is not copied by one task
    cut = known.join(parts, "pivot").repartition("name")
    h = F.xxhash64("name")
    own = F.when(F.col("linked"), F.col("others") + F.pmod(h, F.col("ours"))).otherwise(F.pmod(h, F.col("others"))).cast("int")
    last = F.when(F.col("linked"), F.col("others") - 1).otherwise(F.col("others") + F.col("ours") - 1)
    cut = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    pairs = cut.select(F.lit(None).cast("int").alias("bucket"), F.col("pivot").alias("family"), "pivot", F.least("own", "other").alias("lo"),
                       F.greatest("own", "other").alias("hi"), "name")
    links = known.where(F.col("linked") & (F.col("name") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("name").alias("b"))
    return shared.unionByName(pairs).join(sets.select("name", "hashes"), "name"), links


def _heavy_links(sets: DataFrame, lists: DataFrame, percent: int, block: int, task_bytes: int) -> DataFrame:
    """(a, b): forests of the links among the sets that meet in a list. lists: (token, id, name)."""

    def solve(table):
        out = []
        pivot, lo, hi = (table.column(c).to_pylist() for c in ("pivot", "lo", "hi"))
        names = table.column("name").to_pylist()
        by: dict[tuple, list[int]] = {}
        for k, key in enumerate(zip(pivot, lo, hi, strict=True)):
            by.setdefault(key, []).append(k)
        hashes = table.column("hashes")
        for rows in by.values():
            if len(rows) > 1:
                rows.sort(key=names.__getitem__)
                out += [(names[rows[a]], names[rows[b]]) for a, b in link_forest([np.frombuffer(hashes[k].as_py(), np.uint64) for k in rows], percent)]
        return as_table(out, "a binary, b binary")

    cells, links = _cells(sets, lists, percent, block, task_bytes)
    return links.unionByName(cells.groupBy("bucket", "family", "lo", "hi").applyInArrow(solve, "a binary, b binary"))


def _boundary(stats: dict[str, float], percent: int) -> int:
    """The largest size of light sets: their subsets are fewer than the list entries that scanning reads."""
    best = 0
    for n in range(1, LIGHT + 1):
        subsets = sum(comb(n, k) for k in range(need(n, percent), n + 1))
        if subsets <= (n - need(n, percent) + 1) * max(1.0, stats["entries"]):
            best = n
    return best


def similar_groups(docs: DataFrame, size: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text",
                   chunk_bytes: int = CHUNK_BYTES, part_hashes: int = PART_HASHES, block: int = BLOCK, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document: its set's size and the smallest id that links reach."""
    from marketlens.session import cut_lineage
    p = plan(docs, text, chunk_bytes, part_hashes)
    packed = pieces(docs, doc_id, text, p.chunks)
    every = cut_lineage(_sets(docs, doc_id, text, size))
    classes = cut_lineage(every.where("n > 0").groupBy("name").agg(F.min("id").alias("id"), F.first("n").alias("n")))
    wanted = classes.select(chunk_of("id", p.chunks).alias("chunk"), "id", "name")

    def count_lists(key, left, right):
        own = _chosen(left, right, size)
        short = p.short(np.concatenate([h for _, _, h in own])) if own else np.zeros(0, np.uint64)
        del own                                              # one array of a chunk's hashes at a time
        short.sort()
        first = np.flatnonzero(np.concatenate([[True], short[1:] != short[:-1]])[:len(short)]).astype(np.int32)
        counts = np.diff(np.append(first, np.int32(len(short))))
        short = short[first]
        del first
        return as_table(list_rows(p, key[0].as_py(), short, counts), LISTS)

    lists = packed.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(count_lists, LISTS)
    counts = cut_lineage(count_across(lists))

    def survivors(key, left, right):
        asked = np.array([x is not None for x in right.column("counts").to_pylist()], bool)
        own = _chosen(left, right.filter(pa.array(~asked)), size)
        if not own:
            return as_table([], "id bigint, name binary, n bigint, hashes binary, rare array<bigint>")
        known = p.short(np.concatenate([h for _, _, h in own]))
        known.sort()
        known = distinct(known)
        often = answers(right.filter(pa.array(asked)))
        rows = []
        for i, name, h in own:
            n = len(h)
            df = often[np.searchsorted(known, p.short(h))]
            if (df >= 2).sum() >= need(n, percent):          # else it has too little in common with all others
                rank = np.lexsort([h, df])[:n - need(n, percent) + 1]
                rows.append((i, name, n, h.tobytes(), h[rank[df[rank] >= 2]].view(np.int64)))
        del own, known, often
        return as_table(rows, "id bigint, name binary, n bigint, hashes binary, rare array<bigint>")

    told = counts.select("chunk", "part", "counts", F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("binary").alias("name")).unionByName(
        wanted.select("chunk", F.lit(None).cast("int").alias("part"), F.lit(None).cast("binary").alias("counts"), "id", "name"))
    sets = cut_lineage(packed.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        survivors, "id bigint, name binary, n bigint, hashes binary, rare array<bigint>"))
    tokens = sets.select("id", "name", "n", F.explode("rare").alias("token"))
    lengths = tokens.groupBy("token").count().agg(F.sum(F.col("count") * F.col("count")).alias("s"), F.sum("count").alias("n")).first()
    light = _boundary({"entries": (lengths["s"] or 0) / max(1, lengths["n"] or 0)}, percent)
    heavy = tokens.where(F.col("n") >= need(light + 1, percent)).select("token", "id", "name")
    links = _light_links(sets.where(F.col("n") <= light), percent).unionByName(_heavy_links(sets, heavy, percent, block, task_bytes))
    roots = components(links)
    named = classes.join(roots.withColumnRenamed("node", "name"), "name", "left").select(
        "name", "id", F.coalesce("root", "name").alias("root"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    of = named.join(least, "root").select("name", "component_id")
    real = lambda c: F.when(c != NO_ID, c)
    return every.join(of, "name", "left").select(real(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"),
                                                 real(F.coalesce("component_id", "id")).alias("component_id"))


def brute_force(docs, size: int = WORDS, percent: int = PERCENT):
    """[(doc_id, n_shingles, component_id)] for a small list of (doc_id, text), by comparing all pairs (for tests)."""
    table = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    sets = []
    for _, t in docs:
        w = (t or "").encode().translate(table).split()
        sets.append({tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(docs)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least: dict[int, int] = {}
    for k, (i, _) in enumerate(docs):
        least[find(k)] = min(least.get(find(k), NO_ID), NO_ID if i is None else i)
    return [(i, len(sets[k]), least[find(k)] if least[find(k)] != NO_ID else None) for k, (i, _) in enumerate(docs)]
