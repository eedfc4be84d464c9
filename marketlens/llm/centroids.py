"""Centroid clustering with Ptolemaic pivots (operator 12).

Vectors become integers (floor(1024 c)), so that distances, sums and centroids are exact and don't depend on how rows are
dealt. A few pivots are fixed before the first round, and every vector's distances to them are kept in a checkpointed
table beside the vector. By Ptolemy's inequality a pair of pivots p, s bounds the distance of a vector x to a centroid c
from below: |d(x,p) d(c,s) - d(x,s) d(c,p)| / d(p,s). A round looks at the centroids by rising bound of their best pair
and computes the distance only where the bound, lowered by more than its rounding error, isn't above the best distance
found; those are compared exactly, as integers. So the result is that of comparing all centroids. The bound is exact
for a centroid that lies on a pivot and weakens as it moves away, so the pivots are taken where centroids go: they are
the centroids of the same clustering of a bounded sample (SAMPLE vectors of the least hashes). The sample decides only
how many distances are computed.

Edge cases: vectors of another length, null vectors, and null, non-finite or huge entries (2^50 and up, which the
integers don't hold) are dropped. Repeated rows are vectors each; of equal hashes (repeated ids) the smaller vector
comes first; null ids come last among the first centroids. Fewer vectors than centroids make as many centroids as
vectors; an empty table gives no rows. A distance or sum beyond a long is null. Other columns are not read.
"""

from __future__ import annotations

import dataclasses
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.vectors import decimals, exact_squares, longs, matrix, scaled, slabs, whole
from marketlens.session import cut_lineage

# Fixed value: the integers that entries become.
FACTOR = 1_024
#: Vectors of which the pivots are found, and the most pivots; 28 pairs for 8 pivots.
SAMPLE, PIVOTS = 2_048, 8
#: Bounds are lowered by this share of their terms, some hundred times the rounding error of their few operations.
SLACK = 2.0 ** -44
ROWS = 4_096
LONG = 1 << 63


def _fits(v: int) -> int | None:
    return v if -LONG <= v < LONG else None


@dataclasses.dataclass(frozen=True)
class Pivots:
    """Fixed pivots and the pairs of them that lie apart."""

    points: np.ndarray
    pairs: tuple[np.ndarray, np.ndarray]
    apart: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray) -> Pivots:
        i, j = np.triu_indices(len(points), 1)
        apart = np.sqrt(exact_squares(points[i] - points[j]).astype(np.float64)) if len(i) else np.zeros(0)
        keep = apart > 0
        return cls(points, (i[keep], j[keep]), apart[keep])

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Distances of the rows to each pivot, right to the last places."""
        return np.stack([np.sqrt(exact_squares(x - p).astype(np.float64)) for p in self.points], axis=1) if len(self.points) else np.zeros((len(x), 0))

    def bounds(self, near: np.ndarray, centre: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances of rows to one centre, given both sides' distances to the pivots."""
        out = np.zeros(len(near))
        for p, s, apart in zip(*self.pairs, self.apart, strict=True):
            a, b = near[:, p] * centre[s], near[:, s] * centre[p]
            np.maximum(out, (np.abs(a - b) - SLACK * (a + b)) / apart, out=out)
        return out * (1.0 - SLACK)


def assign(x: np.ndarray, near: np.ndarray, centres: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centre, its squared distance, distances computed); of equally near ones the smallest number."""
    n, k = len(x), len(centres)
    top = max(int(np.abs(m).max()) if m.size else 0 for m in (x, centres))
    kind = np.int64 if 4 * top * top * max(x.shape[1], 1) < LONG - 1 else object
    best = np.full(n, LONG - 1 if kind is np.int64 else 1 << 200, kind)
    cluster, computed = np.full(n, k, np.int64), 0
    bounds = np.stack([pivots.bounds(near, c) for c in pivots.distances(centres)], axis=1)
    order = np.argsort(bounds, axis=1, kind="stable")
    for turn in range(k):
        which = order[:, turn]
        reach = np.sqrt(best.astype(np.float64)) * (1.0 + SLACK)
        left = np.flatnonzero(bounds[np.arange(n), which] <= reach)
        for c in np.unique(which[left]):
            rows = left[which[left] == c]
            d = exact_squares(x[rows] - centres[c]).astype(kind)
            computed += len(rows)
            closer = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
            best[rows[closer]], cluster[rows[closer]] = d[closer], c
    return cluster, best, computed


def moved(centres: np.ndarray, counts, sums) -> np.ndarray:
    """Each centre's exact floor of the mean of its vectors; a centre of none stays."""
    out = centres.copy()
    for c, n in counts.items():
        if n:
            out[c] = [s // n for s in sums[c]]
    return out


def _sums(x: np.ndarray, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, sums of the entries) of each cluster, as Python integers."""
    counts, sums = np.bincount(cluster, minlength=k), np.zeros((k, x.shape[1]), object)
    safe = not x.size or int(np.abs(x).max()) * len(x) < LONG
    for c in np.flatnonzero(counts):
        own = x[cluster == c]
        sums[c] = (own if safe else own.astype(object)).sum(axis=0).astype(object)
    return counts, sums


def find_pivots(sample: np.ndarray, k: int, rounds: int) -> Pivots:
    """Centroids of the sample's own clustering, at most PIVOTS: those far from each other."""
    none, centres = Pivots.of(sample[:0]), sample[:k]
    for _ in range(rounds):
        cluster, _, _ = assign(sample, np.zeros((len(sample), 0)), centres, none)
        counts, sums = _sums(sample, cluster, k)
        centres = moved(centres, dict(enumerate(counts.tolist())), sums)
    chosen, far = [0], exact_squares(centres - centres[0]).astype(np.float64)
    while len(chosen) < min(PIVOTS, len(centres)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, exact_squares(centres - centres[chosen[-1]]).astype(np.float64))
    return Pivots.of(centres[chosen])


@dataclasses.dataclass(frozen=True)
class Clustering:
    """Table (id, x, near) of the vectors, the final centroids, the pivots, and the distances computed in each round."""

    table: DataFrame
    centres: np.ndarray
    pivots: Pivots
    computed: tuple[int, ...]


def _round(table: DataFrame, centres: np.ndarray, pivots: Pivots) -> tuple[dict, dict, int]:
    """Counts and entry sums of each centre's vectors, and the distances computed."""
    k, width = centres.shape
    shared = table.sparkSession.sparkContext.broadcast((centres, pivots))

    def add(batches):
        own, near_to = shared.value
        counts, sums, computed = np.zeros(k, object), np.zeros((k, width), object), 0
        for b in slabs(batches, ROWS):
            x, near = matrix(b.column(0), width), np.asarray(b.column(1).flatten()).reshape(len(b), -1)
            cluster, _, done = assign(x, near, own, near_to)
            n, s = _sums(x, cluster, k)
            counts, sums, computed = counts + n, sums + s, computed + done
        c, i = np.repeat(np.arange(k), width + 1), np.tile(np.arange(-1, width), k)
        values = np.concatenate([counts[:, None], sums], axis=1).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([*c, -1], pa.int32()), pa.array([*i, -1], pa.int32()), decimals([*values, computed])], ["c", "i", "v"])

    got = table.select("x", "near").mapInArrow(add, "c int, i int, v decimal(38,0)").groupBy("c", "i").agg(F.sum("v").alias("v")).collect()
    found = {(r["c"], r["i"]): int(r["v"]) for r in got}
    shared.unpersist()
    return ({c: found.get((c, -1), 0) for c in range(k)}, {c: [found.get((c, i), 0) for i in range(width)] for c in range(k)},
            found.get((-1, -1), 0))


def fit_clusters(df: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, seed: str = "3", vec_id: str = "vec_id",
                 vector: str = "embedding") -> Clustering | None:
    """All rounds over every vector; None if there is no vector."""
    spark = df.sparkSession
    rows = df.where(whole(vector) & (F.size(F.col(vector)) == width)).select(F.col(vec_id).alias("id"), scaled(vector, FACTOR).alias("x"))
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = rows.orderBy(by_hash.asc_nulls_last(), "x").limit(max(k, SAMPLE)).select("x").collect()
    if not first:
        return None
    sample = np.array([r["x"] for r in first], np.int64)
    k = min(k, len(sample))
    pivots, centres = find_pivots(sample, k, rounds), sample[:k]
    shared = spark.sparkContext.broadcast(pivots)
    schema = T.StructType([T.StructField("id", df.schema[vec_id].dataType), *T.StructType.fromDDL("x array<bigint>, near array<double>")])

    def measure(batches):
        for b in slabs(batches, ROWS):
            near = shared.value.distances(matrix(b.column(1), width))
            cuts = pa.array(np.arange(len(b) + 1) * near.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(cuts, pa.array(near.ravel()))], schema.names)

    table, computed = cut_lineage(rows.mapInArrow(measure, schema)), []
    for _ in range(rounds):
        counts, sums, done = _round(table, centres, pivots)
        centres = moved(centres, counts, sums)
        computed.append(done)
    return Clustering(table, centres, pivots, tuple(computed))


def nearest(fit: Clustering) -> DataFrame:
    """(id, cluster, distance): every vector's nearest final centroid and its squared distance."""
    schema = T.StructType([fit.table.schema["id"], *T.StructType.fromDDL("cluster int, distance bigint")])
    shared, width = fit.table.sparkSession.sparkContext.broadcast((fit.centres, fit.pivots)), fit.centres.shape[1]

    def near(batches):
        for b in slabs(batches, ROWS):
            cluster, best, _ = assign(matrix(b.column(1), width), np.asarray(b.column(2).flatten()).reshape(len(b), -1), *shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster, pa.int32()), longs(best)], schema.names)

    return fit.table.mapInArrow(near, schema)


def cluster_vectors(df: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, seed: str = "3", vec_id: str = "vec_id",
                    vector: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    spark = df.sparkSession
    schema = T.StructType([df.schema[vec_id], *T.StructType.fromDDL(
        "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")])
    fit = fit_clusters(df, k, rounds, width, seed, vec_id, vector)
    if fit is None:
        return spark.createDataFrame([], schema)
    each = nearest(fit)
    sums = each.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("v"), F.count_if(F.col("distance").isNull()).alias("none"))
    found = {r["cluster"]: None if r["none"] else int(r["v"]) for r in sums.collect()}
    total = None if None in found.values() else _fits(sum(found.values()))
    names = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in fit.centres]
    facts = spark.createDataFrame([(c, None if found.get(c) is None else _fits(found[c]), total, names[c]) for c in range(len(names))],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return each.join(F.broadcast(facts), "cluster").select(F.col("id").alias(vec_id), *schema.names[1:])   # a row for each centroid
