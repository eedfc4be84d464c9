"""Operators 11 to 13 against brute force: exact integers, dense eigenvectors, all distances, and the tokenizers library."""

import hashlib
import random
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.llm import bpe, centroids, queries, whitening
from marketlens.llm.vectors import exact_gram, exact_squares

SMALL = "/root/testdata/sf0.001"


def frame(spark, rows, extra=False):
    ddl = "vec_id bigint, embedding array<float>"
    if extra:                                             # clashing names
        return spark.createDataFrame([(*r, 1, "x", [0]) for r in rows], ddl + ", n int, cluster string, x array<int>")
    return spark.createDataFrame(rows, ddl)


def vectors(n, width, seed, scale=None):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, width)) * (np.linspace(1, 0.1, width) if scale is None else scale)
    return m.astype(np.float32)


# -- whitening ------------------------------------------------------------------------------------------------------
def plain_whitening(rows, k=16):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in good]
    fit = sorted({tuple(r) for r in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    d = np.array([[n * c - s for c, s in zip(r, sums)] for r in fit], float) / n
    e, u = np.linalg.eigh(d.T @ d / n)
    keep = [j for j in np.argsort(-e) if e[j] > 1e-9 * e.max()][:k]
    out = {}
    for (i, _), r in zip(good, x, strict=True):
        own = [n * c - s for c, s in zip(r, sums)]
        w = np.array(own, float) / n @ u[:, keep] / np.sqrt(e[keep])
        out.setdefault(i, []).append((sum(c * c for c in own), w))
    return n, out, e[keep] / e.sum()


@pytest.mark.parametrize(("n", "width"), [(300, 5), (400, 24), (12, 20)])
def test_whitening_equals_dense_eigenvectors(spark, n, width):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors(n, width, n))]
    rows += [(1_000 + i, rows[0][1]) for i in range(50)] + [(3, rows[5][1])]                # copies, a repeated id
    bad = [(2_000, None), (2_001, [None] + [0.0] * (width - 1)), (2_002, [float("nan")] * width), (2_003, [float("inf")] * width),
           (2_004, [1e30] * width), (2_005, [0.5]), (2_006, [])]
    got = whitening.whiten(frame(spark, rows + bad, extra=True)).collect()
    n_fit, want, explained = plain_whitening(rows)
    k = len(explained)
    assert len(got) == k * len(rows)
    signs, by = np.zeros(k), {}
    for r in got:
        by.setdefault(r["vec_id"], []).append(r)
    for i, found in by.items():
        found.sort(key=lambda r: (r["deviation"], r["component"]))
        own = sorted(want[i], key=lambda q: q[0])
        for at, (deviation, w) in enumerate(own):
            part = found[at * k:(at + 1) * k]
            assert [r["component"] for r in part] == list(range(1, k + 1))
            assert {r["deviation"] for r in part} == {deviation} and {r["n"] for r in part} == {n_fit}
            v = np.array([r["whitened"] for r in part])
            if not signs.all():
                signs = np.where(signs == 0, np.sign(v * w), signs)
            assert np.allclose(v, signs * w, atol=1e-6)
            assert np.allclose([r["explained"] for r in part], explained, rtol=1e-9)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_without_variance_or_rows(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])], [(1, None)]):
        assert whitening.whiten(frame(spark, rows)).count() == 0
    got = whitening.whiten(frame(spark, [(1, [0.0, 1.0]), (None, [1.0, 1.0])])).collect()      # one component; a null id
    assert sorted((r["vec_id"] or 0, r["component"], r["n"], r["deviation"]) for r in got) == [(0, 1, 2, 64 * 64), (1, 1, 2, 64 * 64)]
    assert sorted(abs(r["whitened"]) for r in got) == [1.0, 1.0] and {r["explained"] for r in got} == {1.0}


def test_whitening_of_large_entries_is_exact(spark):
    rows = [(i, [float(i % 3) * 2.0 ** 20, float(i)]) for i in range(40)]
    n, want, _ = plain_whitening(rows)
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(frame(spark, rows)).collect()}
    assert got == {i: w[0][0] for i, w in want.items()}
    far = whitening.whiten(frame(spark, [(i, [float(i) * 2.0 ** 40]) for i in range(4)])).collect()
    assert {r["deviation"] for r in far} == {None} and len(far) == 4                           # beyond a long


def test_cholesky_and_rotations():
    rng = np.random.default_rng(1)
    for p in (1, 2, 7, 33):
        q = np.linalg.qr(rng.normal(size=(p, p)))[0]
        e = 10.0 ** -np.arange(p).clip(max=12).astype(float)
        a = q * e @ q.T
        a = (a + a.T) / 2
        factor, order = whitening.pivoted_cholesky(a)
        assert np.allclose(factor @ factor.T, a[np.ix_(order, order)], atol=1e-14)
        assert (np.diff(np.diag(factor)) <= 1e-12).all()
        columns = whitening.orthogonal_columns(factor)
        got = (columns ** 2).sum(axis=0)
        assert np.allclose(got, np.sort(np.linalg.eigvalsh(a))[::-1][:len(got)], rtol=1e-10, atol=1e-14)
        unit = columns / np.sqrt(got)
        assert np.abs(unit.T @ unit - np.eye(len(got))).max() < 1e-12
    low, _ = whitening.pivoted_cholesky(np.ones((5, 5)))
    assert low.shape == (5, 1)


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 40), st.integers(1, 6), st.sampled_from([1, 30, 1 << 28, 1 << 50]), st.integers(0, 9))
def test_sums_are_exact(n, width, top, seed):
    x = np.random.default_rng(seed).integers(-top, top + 1, (n, width))
    big = x.astype(object)
    assert (exact_gram(x) == big.T.dot(big)).all()
    assert (exact_squares(x) == (big * big).sum(axis=1)).all()


# -- centroids ------------------------------------------------------------------------------------------------------
def plain_clusters(rows, k=8, rounds=10, width=64):
    kept = [(i, tuple(int(np.floor(1024 * float(np.float32(c)))) for c in v)) for i, v in rows
            if v is not None and len(v) == width and all(c is not None and np.isfinite(c) for c in v)]
    name = lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest()
    centres = [x for i, x in sorted(kept, key=lambda q: ((0, name(q[0])) if q[0] is not None else (1, ""), q[1]))[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        own = {}
        for _, x in kept:
            own.setdefault(near(x)[1], []).append(x)
        centres = [tuple(sum(c) // len(own[j]) for c in zip(*own[j])) if j in own else old for j, old in enumerate(centres)]
    got = [(i, *near(x)) for i, x in kept]
    inertia = {j: sum(d for _, d, c in got if c == j) for j in range(len(centres))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i if i is not None else -1), c, d, inertia[c], sum(inertia.values()), sha[c]) for i, d, c in got)


def clusters(df, **kw):
    return sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])
                  for r in centroids.cluster_vectors(df, **kw).collect())


def test_clusters_equal_all_distances(spark):
    m = vectors(600, 64, 3, 0.05)
    m[::3] += 0.4
    m[1::7, :9] -= 0.8
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(m)]
    rows += [(700 + i, rows[0][1]) for i in range(30)] + [(5, rows[9][1]), (None, rows[2][1])]     # copies, a repeated and a null id
    bad = [(900, None), (901, [0.1] * 63), (902, [None] * 64), (903, [float("nan")] * 64), (904, [float("-inf")] * 64), (905, []), (906, [3e38] * 64)]
    df = frame(spark, rows + bad, extra=True)
    assert clusters(df) == plain_clusters(rows)
    fit = centroids.fit_clusters(df)
    assert len(fit.computed) == 10 and all(len(rows) <= n < 8 * len(rows) for n in fit.computed)    # bounds spare distances
    assert clusters(df.repartition(7)) == clusters(df.coalesce(1))


def test_few_equal_and_tied_vectors(spark):
    assert clusters(frame(spark, [])) == []
    for rows in ([(1, [0.5] * 64)], [(i, [0.25] * 64) for i in range(20)], [(i, [float(i % 2)] * 64) for i in range(11)],
                 [(1, [0.5] * 64), (1, [0.5] * 64), (1, [-0.5] * 64)]):
        assert clusters(frame(spark, rows)) == plain_clusters(rows)
    line = [(i, [float(i // 2)]) for i in range(40)]                       # many equal distances
    assert clusters(frame(spark, line), k=5, rounds=4, width=1) == plain_clusters(line, 5, 4, 1)
    large = [(i, [float((i * 37) % 11) * 2.0 ** 30, float(i)]) for i in range(30)]
    assert [r[:2] for r in clusters(frame(spark, large), k=3, rounds=5, width=2)] == [r[:2] for r in plain_clusters(large, 3, 5, 2)]


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 60), st.integers(1, 9), st.integers(1, 5), st.sampled_from([1, 3, 2_000]), st.integers(0, 99))
def test_bounds_never_pass_the_distance(n, k, width, top, seed):
    rng = np.random.default_rng(seed)
    x, centres, points = (rng.integers(-top, top + 1, (m, width)) for m in (n, k, 6))
    pivots = centroids.Pivots.of(points)
    near = pivots.distances(x)
    d = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    for c, own in enumerate(pivots.distances(centres)):
        assert (pivots.bounds(near, own) <= np.sqrt(d[:, c]) * (1 + 1e-13)).all()
    cluster, best, computed = centroids.assign(x, near, centres, pivots)
    assert (cluster == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all() and computed <= n * k


# -- byte-pair encoding ---------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tool = Tokenizer.from_file(path)
    tool.no_truncation()
    tool.no_padding()
    return path, tool


def check_text(own, tool, text):
    ids = tool.encode(text, add_special_tokens=False).ids
    packed = own.encode(text)
    assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == ids, text
    assert own.decode(packed).decode() == tool.decode(ids, skip_special_tokens=False), text


PIECES = ["a", "B", "é", "é", "́", " ", "\n", "\t", " ", " ", "\x1c", "\x85", "​", "'s", "'T", "'re", "1", "२", "½", "ß", "Σ", "ς",
          "İ", "ﬁ", "漢", "가", "가", "😀", "<|endoftext|>", "<|startoftext|>", "<|", "!", "...", "\x00", "the", "ing", "K", "×", "“", "’"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30).map("".join) | st.text(max_size=40))
def test_bpe_equals_the_library(library, text):
    path, tool = library
    check_text(bpe.coder(open(path, encoding="utf-8").read()), tool, text)


def test_bpe_of_other_files_and_small_tables(library, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer
    path, tool = library
    rng = random.Random(4)
    texts = ["".join(rng.choice(PIECES) for _ in range(40)) for _ in range(200)]
    monkeypatch.setattr(bpe, "KEPT_BYTES", 2_000)                           # the table starts anew all the time
    own = bpe.Coder(open(path, encoding="utf-8").read())
    for t in texts:
        check_text(own, tool, t)
    with pytest.raises(ValueError, match="no plain BPE"):                   # has a decoder of its own
        bpe.Coder(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    import json
    spec = json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))
    spec["decoder"] = spec["post_processor"] = None
    other = json.dumps(spec)
    whole, lib = bpe.Coder(other), Tokenizer.from_str(other)
    assert not whole.by_word
    for t in texts[:50]:
        check_text(whole, lib, t)


def test_merges_are_leftmost_lowest():
    """Against a plain loop, over random tables on a small alphabet."""
    rng = random.Random(2)
    for _ in range(300):
        pairs, made = {}, []
        for rank in range(rng.randint(0, 12)):
            key = rng.randint(0, 5) << bpe.PAIR | rng.randint(0, 5)
            pairs.setdefault(key, rank)
            made.append(rng.randint(0, 5))
        ids = [rng.randint(0, 5) for _ in range(rng.randint(1, 40))]
        want = ids[:]
        while len(want) > 1:
            rank, i = min((pairs.get(want[i] << bpe.PAIR | want[i + 1], 1 << 40), i) for i in range(len(want) - 1))
            if rank == 1 << 40:
                break
            want[i:i + 2] = [made[rank]]
        assert bpe.merge(ids[:], pairs, made) == want


def test_long_words(library):
    path, tool = library
    own, rng = bpe.Coder(open(path, encoding="utf-8").read()), random.Random(3)
    for text in ("ab" * 60_000, "".join(rng.choice("etaoinshr") for _ in range(100_000)), "漢字" * 20_000, "!?" * 50_000):
        check_text(own, tool, text)


def test_bpe_frames(spark, library):
    path, tool = library
    rows = [(1, "The House's café"), (1, "The House's café"), (2, ""), (3, None), (None, "x <|endoftext|> y"), (4, "word " * 30_000)]
    df = spark.createDataFrame([(*r, 0, "q") for r in rows], "doc_id bigint, text string, ids int, decoded string")
    got = sorted(bpe.round_trip_report(df, path).collect(), key=str)
    want = []
    for i, t in rows:
        ids = tool.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256(tool.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    back = bpe.decode(bpe.encode(df, path), path)
    assert {r["decoded"] for r in back.where("doc_id = 2 OR doc_id = 3").collect()} == {""}
    assert bpe.round_trip_report(df.limit(0), path).count() == 0
    assert bpe.Coder(open(path, encoding="utf-8").read()).decode(struct.pack("<2I", 4_000_000_000, 320)).decode() == tool.decode([320])


def test_queries_on_given_tables(spark, library):
    path, tool = library
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.op13_bpe(spark, SMALL).collect():
        ids = tool.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tool.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    vecs = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert clusters(spark.read.parquet(f"{SMALL}/embeddings.parquet")) == plain_clusters(vecs)
    n, want, explained = plain_whitening(vecs)
    got = queries.op11_whitening(spark, SMALL).collect()
    assert len(got) == 16 * len(vecs) and {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-9
    for r in got:
        deviation, w = want[r["vec_id"]][0]
        assert r["deviation"] == deviation and abs(abs(r["whitened"]) - abs(w[r["component"] - 1])) < 1e-7
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9


# -- words of the token store ---------------------------------------------------------------------------------------
@pytest.mark.parametrize("entries", [3, 400_000])
def test_word_table_equals_the_library(library, monkeypatch, entries):
    """Words of all lengths and scripts, marks, control characters and special tokens; a table that starts anew all the time."""
    import pyarrow as pa

    from marketlens.llm import token_store, word_table
    path, tool = library
    monkeypatch.setattr(word_table, "ENTRIES", entries)
    monkeypatch.setattr(word_table, "LONG_ENTRIES", entries)
    words = token_store._Words(open(path, encoding="utf-8").read(), "<u2")
    monkeypatch.setattr(token_store, "_kept_words", lambda *a: words)
    encode = token_store._encoder(type("B", (), {"value": ""}), "<u2", 2)
    rng = random.Random(entries)
    pieces = PIECES + ["İ!", "İ.", "ÿ?", "Ā:", "ǅ;", "ȿ!", "ab", "über", "ça", "ſ", "ȧ", "é!", "é.", "×!", "÷.", "½.", "\x00", "a\x00", "x" * 17, "y" * 40, "naïve,", "漢.", "ə!", "ʼ.", " ", " ", "\n"]
    for _ in range(30):
        texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(60)] + [None, "", "  ", "word"]
        got = encode(pa.array(texts, pa.string()))
        for t, p in zip(texts, got, strict=True):
            assert np.frombuffer(p, "<u2").tolist() == tool.encode(t or "", add_special_tokens=False).ids + [2], t
