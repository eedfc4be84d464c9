"""Mixing sources to target weights by min-cost flow (operator 4).

Documents are aggregated by membership pattern (the set of sources they belong
to); a pattern's words are a capacity at rising cost, one step for each
repetition, so that no document is repeated before its neighbours are used. A
flow of least cost routes the patterns' words to the sources' quotas. Patterns
of one source that no other pattern shares have a closed form. Documents are
then chosen in a seeded order until a pattern's flow is reached.

Size is the number of words. A source's target is its weight's share of
``total_share`` of all words, at most ``max_repeats`` times its own words; the
excess goes to the other sources by weight until none is above.

Edge cases: a null text has size 0 and takes 0; a null source is a source of
its own, the last; documents of size 0 take 0; an empty table gives no rows.
Repeated rows have the same place in the seeded order, so they are taken alike;
other columns are not read. Reruns agree.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.session import cut_lineage

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
#: Source and pattern tables are planned on the driver (a few numbers each); beyond this many the call stops with an error.
MAX_PATTERNS = 1_000_000
#: The seeded order is found by counting in this many buckets at each of LEVELS levels.
BITS, LEVELS = 10, 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def targets(sizes: dict, weights: dict, total: float, max_repeats: float) -> dict:
    """Water filling: total by weight, none above max_repeats times its size."""
    out, left, free = {}, total, sorted(sizes, key=lambda s: max_repeats * sizes[s] / weights[s])
    weight = sum(weights[s] for s in free)
    for s in free:                                           # in the order in which they reach their limit
        cap = max_repeats * sizes[s]
        out[s] = min(cap, left * weights[s] / weight)
        left, weight = left - out[s], weight - weights[s]
    return out


def min_cost_flow(patterns: dict[tuple, float], quotas: dict, max_repeats: int) -> dict[tuple, dict]:
    """{pattern: {source: words}}: the quotas filled as far as they go, at the least sum of repetition costs.

    Successive shortest paths with potentials over source of supply, pattern, source and sink; a pattern's edge is
    max_repeats parallel edges of its size at cost 1, 2, ... (convex, so cheaper steps fill first).
    """
    nodes = ["in", *(("p", p) for p in patterns), *(("s", s) for s in quotas), "out"]
    number = {v: i for i, v in enumerate(nodes)}
    to, cap, cost, edges = [], [], [], [[] for _ in nodes]

    def add(a, b, c, w):
        for x, y, k, z in ((a, b, c, w), (b, a, 0.0, -w)):
            edges[number[x]].append(len(to))
            to.append(number[y])
            cap.append(k)
            cost.append(z)

    routes = {}
    for p, size in patterns.items():
        for k in range(max_repeats):
            add("in", ("p", p), size, k + 1)
        for s in p:
            routes[p, s] = len(to)
            add(("p", p), ("s", s), float("inf"), 0)
    for s, q in quotas.items():
        add(("s", s), "out", q, 0)
    eps = 1e-9 * max([1.0, *quotas.values()])
    potential = [0.0] * len(nodes)
    while True:
        dist, back = [float("inf")] * len(nodes), [-1] * len(nodes)
        dist[0] = 0.0
        heap = [(0.0, 0)]
        while heap:
            d, v = heapq.heappop(heap)
            if d > dist[v]:
                continue
            for e in edges[v]:
                if cap[e] > eps and (n := d + cost[e] + potential[v] - potential[to[e]]) < dist[to[e]] - 1e-12:
                    dist[to[e]], back[to[e]] = n, e
                    heapq.heappush(heap, (n, to[e]))
        end = number["out"]
        if back[end] < 0:
            break
        potential = [p + (d if d < float("inf") else 0.0) for p, d in zip(potential, dist, strict=True)]
        path, v = [], end
        while v:
            path.append(back[v])
            v = to[back[v] ^ 1]
        step = min(cap[e] for e in path)
        for e in path:
            cap[e] -= step
            cap[e ^ 1] += step
    out: dict[tuple, dict] = defaultdict(dict)
    for (p, s), e in routes.items():
        if cap[e ^ 1] > eps:
            out[p][s] = cap[e ^ 1]
    return out


def plan_flow(patterns: dict[tuple, float], quotas: dict, max_repeats: int) -> dict[tuple, dict]:
    """``min_cost_flow`` for each group of patterns that share sources; the groups' flows don't touch."""
    use = defaultdict(list)
    for p in patterns:
        for s in p:
            use[s].append(p)
    seen, out = set(), {}
    for first in patterns:
        group, todo = {}, [first]
        while todo:
            p = todo.pop()
            if p not in seen:
                seen.add(p)
                group[p] = patterns[p]
                todo += [x for s in p for x in use[s] if x not in seen]
        if group:
            out |= min_cost_flow(group, {s: quotas[s] for s in {s for p in group for s in p}}, max_repeats)
    return out


def _cut_points(docs: DataFrame, quotas: DataFrame, few: bool) -> DataFrame:
    """(_p, _from, _best): the documents of group _p with _u below _from, in seeded order, come to the quota _q; the one
    document at _best, the closest to the words then missing, is added where it helps (else null).

    The place is found level by level: sizes are summed by bucket of the seeded value (partial sums in each task), and
    only the bucket in which the quota falls is looked into further.
    """
    small = F.broadcast if few else (lambda d: d)
    bits = 63
    state = quotas.select("_p", F.col("_q").alias("_left"), F.lit(0).cast("bigint").alias("_from"))
    for _ in range(LEVELS):
        bits -= BITS
        inside = F.shiftright("_u", bits + BITS) == F.shiftright("_from", bits + BITS)
        sums = docs.join(small(state), "_p").where(inside).groupBy("_p", F.shiftright("_u", bits).alias("_b")).agg(F.sum("_size").alias("_s"))
        w = Window.partitionBy("_p").orderBy("_b")           # at most 2**BITS rows for each group
        runs = sums.join(small(state), "_p").withColumn("_c", F.sum("_s").over(w))
        ends = runs.groupBy("_p").agg(F.max(F.when(F.col("_c") <= F.col("_left"), F.col("_c"))).alias("_done"),
                                      F.min(F.when(F.col("_c") > F.col("_left"), F.col("_b"))).alias("_at"))
        state = cut_lineage(state.join(ends, "_p", "left").select(
            "_p", (F.col("_left") - F.coalesce("_done", F.lit(0))).alias("_left"),
            F.coalesce(F.shiftleft("_at", bits), F.lit((1 << 63) - 1)).alias("_from")))
    rest = docs.join(small(state), "_p").where((F.col("_u") >= F.col("_from")) & (F.col("_size") > 0))
    best = rest.groupBy("_p").agg(F.min(F.struct(F.abs(F.col("_size") - F.col("_left")).alias("d"), F.col("_u").alias("u"))).alias("_b"))
    return state.join(best, "_p", "left").select("_p", "_from", F.when(F.col("_b.d") < F.col("_left"), F.col("_b.u")).alias("_best"))


def _seeded(docs: DataFrame, doc_id: str, text: str, source: str, seed: int) -> list[Column]:
    """_size, _of (the sources, in order), _p (their name as a group) and _u (the place in the seeded order) of a document."""
    kind = docs.select(F.col(source).alias("s")).schema["s"].dataType.simpleString()
    own = F.col(source) if kind.startswith("array") else F.array(F.col(source).cast("string"))
    of = F.when(F.size(own) > 0, F.array_sort(F.array_distinct(own))).otherwise(F.array(F.lit(None).cast("string")))
    size = word_count(F.col(text))
    u = F.xxhash64(F.lit(seed), F.col(doc_id), size, of).bitwiseAND(F.lit((1 << 63) - 1))
    return [size.alias("_size"), of.alias("_of"), F.to_json(of, {"ignoreNullFields": "false"}).alias("_p"), u.alias("_u")]


def _plan(held: DataFrame, total_share: float, weights: tuple[float, ...], max_repeats: int) -> tuple[DataFrame, bool]:
    """(_p, source, source_size, target, _whole, _from, _best) for each membership pattern, and whether the table is small."""
    spark = held.sparkSession
    table = held.groupBy("_p").agg(F.first("_of").alias("of"), F.sum("_size").alias("n"))
    found = table.limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = {tuple(r["of"]): r["n"] for r in found}
    names = sorted({s for p in patterns for s in p}, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    sizes = dict.fromkeys(names, 0)
    for p, n in patterns.items():
        for s in p:
            sizes[s] += n
    quota = targets(sizes, weight, total_share * sum(patterns.values()), max_repeats)
    flow = plan_flow({p: float(n) for p, n in patterns.items()}, quota, max_repeats)
    rows = []
    for r in found:
        p, n = tuple(r["of"]), r["n"]
        words = min(sum(flow.get(p, {}).values()), float(max_repeats * n))
        whole = int(words // n) if n else 0
        first = min(p, key=lambda s: (s is None, s or ""))
        rows.append((r["_p"], first, sizes[first], float(quota[first]), whole, int(round(words - whole * n))))
    made = spark.createDataFrame(rows, "_p string, source string, source_size bigint, target double, _whole int, _q bigint")
    few = len(rows) <= 100_000
    return cut_lineage(made.join(_cut_points(held, made, few), "_p").drop("_q")), few


def _repeats() -> Column:
    extra = (F.col("_u") < F.col("_from")) | F.coalesce(F.col("_u") == F.col("_best"), F.lit(False))
    return (F.col("_whole") + F.when(extra & (F.col("_size") > 0), 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, total_share: float = 1.5, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = 2, seed: int = 7,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, size, source, source_size, target, repeats, taken), a row for each document.

    ``source`` is a string column, or an array of strings for documents of several sources; source, source_size and
    target are then those of its first source in order. The weights go round the sources in code point order, null last.
    """
    held = cut_lineage(docs.select(F.col(doc_id).alias("doc_id"), *_seeded(docs, doc_id, text, source, seed)))
    plan, few = _plan(held, total_share, weights, max_repeats)
    out = held.join(F.broadcast(plan) if few else plan, "_p")
    return out.select("doc_id", F.col("_size").alias("size"), "source", "source_size", "target", _repeats().alias("repeats"),
                      (F.col("_size") * _repeats()).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, total_share: float = 1.5, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = 2, seed: int = 7,
                    doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents' own rows, each as often as the mix takes it."""
    own = _seeded(docs, doc_id, text, source, seed)
    plan, few = _plan(cut_lineage(docs.select(*own)), total_share, weights, max_repeats)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), *own)
    out = rows.join(F.broadcast(plan) if few else plan, "_p").where(_repeats() > 0)
    return out.select(F.explode(F.array_repeat("_row", _repeats())).alias("_row")).select("_row.*")
