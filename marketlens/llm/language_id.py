"""Language identification with hyperdimensional profiles (operator 8).

Every letter has a random vector of +1 and -1, the same on every machine. A
trigram's vector binds its letters' vectors by multiplication, the first
rotated by two places and the second by one, so order counts. A text's profile
bundles (adds) its trigrams' vectors, a language's prototype those of its
training texts; the prototype of the highest cosine names the language.

Letters are lower-cased; every run of other characters is one blank, and a
blank stands at both ends. Edge cases: a null text or one without letters is
'und' with score 0, and 'und' is also the answer where no language was learned
(no training rows). Rows without a language or a text are not trained on.
Ties go to the smaller language name. Repeated rows are judged alike, empty
tables give no rows, other columns are not read. Nothing is cut from long texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.textops import give_back, slices

DIMENSIONS = 512
SEED = 20_011
#: Code points handled together, texts and trigrams (at DIMENSIONS) per matrix product.
BLOCK, ROWS, CODES = 1 << 18, 64, 1 << 11


class _IsLetter:
    """Whether code points are letters; asked once for each that comes."""

    def __init__(self):
        self.known = np.full(0x110000, -1, np.int8)

    def __getitem__(self, points: np.ndarray) -> np.ndarray:
        found = self.known[points]
        new = np.unique(points[found < 0])
        if len(new):
            self.known[new] = [chr(c).isalpha() for c in new.tolist()]
            found = self.known[points]
        return found > 0


class _Letters:
    """The letters' random vectors, drawn once in a task and as letters come; one byte for each place."""

    def __init__(self, size: int, seed: int):
        self.size, self.seed = size, seed
        self.rows: dict[int, np.ndarray] = {}

    def vectors(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As they are for a trigram's third letter, rotated by one for its second, by two for its first. Row 0 is the
        blank's vector; the others follow ``points``."""
        for c in (0, *points.tolist()):
            if c not in self.rows:
                self.rows[c] = (np.random.default_rng([self.seed, c]).integers(0, 2, self.size) * 2 - 1).astype(np.int8)
        v = np.stack([self.rows[c] for c in (0, *points.tolist())])
        return v, np.roll(v, 1, 1), np.roll(v, 2, 1)


def _trigrams(texts: list[str], letters: _IsLetter):
    """(code points used, document of each trigram, trigram code); a code is made of three letter indexes."""
    parts = [t.lower() for t in texts]
    cp = np.frombuffer(("\0" + "\0".join(parts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(parts) + 1), np.array([1] + [len(p) + 1 for p in parts]))
    edge = np.zeros(len(cp), bool)                          # separators of documents
    edge[np.cumsum([0] + [len(p) + 1 for p in parts])] = True
    sym = np.where(letters[cp], cp, 0)
    keep = np.ones(len(cp), bool)                           # one blank for a run; a separator stays in its place
    keep[1:] = (sym[1:] != 0) | (sym[:-1] != 0) | edge[1:]
    sym, doc, edge = sym[keep], doc[keep], edge[keep]
    keep = np.ones(len(sym), bool)
    keep[:-1] = (sym[:-1] != 0) | ~edge[1:] | edge[:-1]      # a text's last blank is its separator
    sym, doc, edge = sym[keep], doc[keep], edge[keep]
    used = np.unique(sym)
    used = used[used > 0]
    code = np.searchsorted(used, sym) + 1
    code[sym == 0] = 0
    m = len(used) + 1
    tri = (code[:-2].astype(np.int64) * m + code[1:-1]) * m + code[2:]
    ok = ~edge[1:-1]
    return used, doc[1:-1][ok] - 1, tri[ok], m


def _vectors(codes: np.ndarray, m: int, letters: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The bound vectors of trigram codes."""
    third, second, first = letters
    out = first[codes // (m * m)]
    out *= second[codes // m % m]
    out *= third[codes % m]
    return out.astype(np.float32)


def _blocks(batch):
    """(first column, texts) of rows with about BLOCK characters together."""
    texts = batch.column(1).to_pylist()
    start = used = 0
    for k, t in enumerate(texts):
        used += len(t or "") + 1
        if used >= BLOCK:
            yield batch.column(0).slice(start, k + 1 - start), texts[start:k + 1]
            start, used = k + 1, 0
    if start < len(texts):
        yield batch.column(0).slice(start), texts[start:]


def learn_prototypes(train: DataFrame, text: str = "text", lang: str = "lang", size: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """(lang, place, value): the bundled profiles. Each task bundles its own rows; the sums are then added by place."""

    step = max(1, CODES * DIMENSIONS // size)

    def bundle(batches):
        letters, known, sums = _IsLetter(), _Letters(size, seed), {}
        for batch in slices(batches, 128):
            for langs, rows in _blocks(batch):
                by: dict[str, list[str]] = {}
                for name, t in zip(langs.to_pylist(), rows, strict=True):
                    by.setdefault(name, []).append(t)
                for name, texts in by.items():
                    used, _, tri, m = _trigrams(texts, letters)
                    codes, counts = _counted(tri, m)
                    drawn = known.vectors(used)
                    own = sums.setdefault(name, np.zeros(size))
                    for i in range(0, len(codes), step):
                        own += counts[i:i + step].astype(np.float64) @ _vectors(codes[i:i + step], m, drawn)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([np.rint(v).astype(np.int64) for v in sums.values()],
                                                                             pa.list_(pa.int64()))], ["lang", "v"])

    rows = train.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("_lang"), F.col(text).alias("_text"))
    part = rows.mapInArrow(bundle, "lang string, v array<bigint>")
    return part.select("lang", F.posexplode("v").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))


def _counted(tri: np.ndarray, m: int):
    if m ** 3 <= 1 << 22:
        n = np.bincount(tri, minlength=1)
        codes = np.flatnonzero(n)
        return codes, n[codes]
    return np.unique(tri, return_counts=True)


def _ranked(values: np.ndarray, top: int):
    """(distinct values in order, each value's place among them); values are below ``top``."""
    if top > 1 << 24:
        return np.unique(values, return_inverse=True)
    there = np.zeros(top, bool)
    there[values] = True
    distinct = np.flatnonzero(there)
    place = np.zeros(top, np.int32)
    place[distinct] = np.arange(len(distinct), dtype=np.int32)
    return distinct, place[values]


def collect_prototypes(table: DataFrame) -> dict[str, list[float]]:
    """The prototypes on the driver: languages times dimensions numbers."""
    found: dict[str, dict[int, int]] = {}
    for r in table.collect():
        found.setdefault(r["lang"], {})[r["place"]] = r["value"]
    return {k: [float(v[i]) for i in range(len(v))] for k, v in sorted(found.items()) if any(v.values())}


def identify(docs: DataFrame, prototypes: dict[str, list[float]], doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
             keep_text: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score): the language of the highest cosine, and that cosine (0 if negative). A narrow step;
    doc_id may be a column of any type, such as a struct of the row's other columns; keep_text adds the text."""
    names = sorted(prototypes)
    size = len(next(iter(prototypes.values()), []))
    step = max(1, CODES * DIMENSIONS // max(1, size))

    def judge(batches):
        letters, table = _IsLetter(), _Letters(size, seed)
        known = np.array([prototypes[n] for n in names], np.float64)
        known = (known / np.linalg.norm(known, axis=1, keepdims=True)).T if names else known
        for batch in slices(batches, 128):
            for ids, rows in _blocks(batch):
                pred, score = ["und"] * len(rows), np.zeros(len(rows))
                used, doc, tri, m = _trigrams([t or "" for t in rows], letters)
                if names and len(used):
                    codes, index = _ranked(tri, m ** 3)
                    drawn = table.vectors(used)
                    edges = np.searchsorted(doc, np.arange(0, len(rows) + ROWS, ROWS))
                    for k in range(len(edges) - 1):
                        own = index[edges[k]:edges[k + 1]]
                        if not len(own):
                            continue
                        active, at = _ranked(own, len(codes))
                        n = min(ROWS, len(rows) - k * ROWS)
                        bundles = np.zeros((n, size))
                        where = (doc[edges[k]:edges[k + 1]] - k * ROWS) * len(active) + at
                        counts = np.bincount(where, minlength=n * len(active)).reshape(n, len(active)).astype(np.float32)
                        for i in range(0, len(active), step):
                            bundles += counts[:, i:i + step] @ _vectors(codes[active[i:i + step]], m, drawn)
                        norm = np.linalg.norm(bundles, axis=1)
                        cos = bundles @ known / np.where(norm > 0, norm, 1)[:, None]
                        best = cos.argmax(axis=1)
                        has = np.zeros(n, bool)
                        has[np.unique(doc[edges[k]:edges[k + 1]] - k * ROWS)] = True
                        for i in np.flatnonzero(has):
                            pred[k * ROWS + i], score[k * ROWS + i] = names[best[i]], min(max(cos[i, best[i]], 0.0), 1.0)
                give_back()
                own = [pa.array(rows, pa.string())] if keep_text else []
                yield pa.RecordBatch.from_arrays([ids, pa.array(pred), pa.array(score), *own], ["doc_id", "lang_pred", "score", "text"][:3 + len(own)])

    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {kind}, lang_pred string, score double" + ", text string" * keep_text)
