"""BPE encoding with a segment tree over adjacent pairs, and decoding (operator 13).

A word's symbols are the leaves of a segment tree; a leaf holds the rank of the pair that its symbol makes with the next
one, and its place, as one number. The root is the least of them: the lowest rank, and the leftmost of equal ranks. A
merge changes three leaves (the merged symbol's, the gone one's, and that of the symbol before), each renewed up to the
root in logarithmic time, until the root holds no mergeable pair. A word of n symbols takes n log n steps, so text
without a blank is no worse than other text.

Normalising and splitting are the tokenizers library's own steps from the tokenizer's file; merging, ids and decoding
are done here. Where the file's split never joins what a blank parts (checked against the fixed values below), a text is
taken word by word, and a word's ids are kept while a process lives, in a table bounded in bytes; western text is lower-cased
and split by one expression of equal effect. Special tokens in the raw text keep their own ids, as in the library.

Edge cases: a null or empty text has no ids and decodes to the empty string. Ids outside the vocabulary decode to
nothing. Texts are encoded whole, however long. Null and repeated document ids are rows like others, an empty table gives
no rows, other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.textops import give_back, short_batches, slices

# A split step whose matches hold no blank and look at nothing round them, and the steps before it.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
#: Western text, on which those steps are lower-casing and one split: ASCII, accented letters of one code point, common marks.
WESTERN = re.compile("[\\x00-\\x7F\u00A1\u00A7\u00AB\u00BB\u00BF\u00C0-\u00FF\u0152\u0153\u2013\u2014\u2018-\u201E\u2026\u20AC]*")
_LETTER = "a-z\u00DF-\u00F6\u00F8-\u00FF\u0153"
WESTERN_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^ \\t-\\r0-9{_LETTER}]+")
#: Bytes of kept words and ids in a Python process, counted with what an entry costs; longer words aren't kept.
KEPT_BYTES, ENTRY_BYTES, LONGEST_KEPT = 48 << 20, 200, 256
#: A leaf is rank << PLACE | place, a pair's key a << PAIR | b.
PLACE, PAIR = 32, 24
PLACES, NO_PAIR = (1 << PLACE) - 1, (1 << 62) - 1


def merge(ids: list[int], pairs: dict[int, int], made: list[int]) -> list[int]:
    """The ids left when no pair can be merged: pairs has the rank of (a << PAIR | b), made the id that a rank makes."""
    n, get = len(ids), pairs.get
    size = 1 << max(n - 2, 0).bit_length()
    tree = [NO_PAIR] * (2 * size)                         # leaves from size on; the root is 1
    for i in range(n - 1):
        rank = get(ids[i] << PAIR | ids[i + 1])
        if rank is not None:
            tree[size + i] = rank << PLACE | i
    for at in range(size - 1, 0, -1):
        x, y = tree[2 * at], tree[2 * at + 1]
        tree[at] = x if x < y else y
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (top := tree[1]) != NO_PAIR:
        i = top & PLACES
        gone = after[i]
        ids[i], ids[gone] = made[top >> PLACE], -1
        after[i] = k = after[gone]
        changed = []
        if k < n:
            before[k] = i
            rank = get(ids[i] << PAIR | ids[k])
            changed += [(gone, NO_PAIR), (i, NO_PAIR if rank is None else rank << PLACE | i)]
        else:
            changed.append((i, NO_PAIR))
        if (k := before[i]) >= 0:
            rank = get(ids[k] << PAIR | ids[i])
            changed.append((k, NO_PAIR if rank is None else rank << PLACE | k))
        for at, key in changed:                           # each new leaf, and what is above it as far as that changes
            at += size
            while tree[at] != key:
                tree[at] = key
                at >>= 1
                if not at:
                    break
                x, y = tree[2 * at], tree[2 * at + 1]
                key = x if x < y else y
    return [x for x in ids if x >= 0]


class Coder:
    """Encodes and decodes by a tokenizer's file."""

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        spec = json.loads(source)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        if model.get("type", "BPE") != "BPE" or odd or spec.get("decoder") is not None or spec.get("post_processor") is not None:
            raise ValueError(f"this tokenizer is no plain BPE: {odd or 'type, decoder or post_processor'}")
        tool = Tokenizer.from_str(source)
        self.vocabulary, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.made = [self.vocabulary[a + b] for a, b in merges]
        self.pairs = {self.vocabulary[a] << PAIR | self.vocabulary[b]: rank for rank, (a, b) in reversed(list(enumerate(merges)))}
        added = {t["content"]: t for t in spec.get("added_tokens", [])}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added.values()):
            raise ValueError("added tokens of this kind are not known here")
        self.special = {c: t["id"] for c, t in added.items()}
        self.find_special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        top = max([*self.vocabulary.values(), *self.special.values()], default=-1)
        tokens = [b""] * (top + 1)
        self.known = np.zeros(top + 1, bool)
        for token, i in {**self.vocabulary, **self.special}.items():
            tokens[i], self.known[i] = token.encode("utf-8"), True
        self.tokens = tokens
        self.normalise = tool.normalizer.normalize_str if tool.normalizer else str
        self.split = tool.pre_tokenizer.pre_tokenize_str if tool.pre_tokenizer else (lambda t: [(t, None)] if t else [])
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = bool(steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
                            and steps[0].get("pattern", {}).get("Regex") == WORD_SPLIT)
        self.western = bool(self.by_word and (spec.get("normalizer") or {}).get("normalizers") == WORD_STEPS and len(steps) == 2
                            and steps[1].get("type") == "ByteLevel" and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex"))
        self.byte_ids = self._byte_ids() if self.western else None
        self.kept_ids: dict = {}
        self.kept = 0

    def _byte_ids(self) -> tuple[list[int], list[int]]:
        """Ids of the 256 bytes inside a word and at its end, by the byte-level alphabet: printable bytes stand for themselves, the
        others for the code points from 256 on."""
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = iter(range(256, 512))
        alphabet = [chr(b if b in own else next(others)) for b in range(256)]
        return [self.vocabulary[c] for c in alphabet], [self.vocabulary[c + self.suffix] for c in alphabet]

    def _keep(self, key, ids: bytes) -> None:
        if len(key) > LONGEST_KEPT:
            return
        self.kept += len(key) + len(ids) + ENTRY_BYTES
        if self.kept > KEPT_BYTES:
            self.kept_ids.clear()
            self.kept = len(key) + len(ids) + ENTRY_BYTES
        self.kept_ids[key] = ids

    def _merged(self, ids: list[int]) -> bytes:
        return np.array(merge(ids, self.pairs, self.made) if len(ids) > 1 else ids, "<u4").tobytes()

    def _western(self, pieces: list[str]) -> bytes:
        """Packed ids of split western text, some of which isn't kept yet."""
        inside, last = self.byte_ids
        parts = []
        for p in pieces:
            ids = self.kept_ids.get(p)
            if ids is None:
                raw = p.encode("utf-8")
                ids = self._merged([*[inside[b] for b in raw[:-1]], last[raw[-1]]])
                self._keep(p, ids)
            parts.append(ids)
        return b"".join(parts)

    def _plain(self, text: str) -> bytes:
        """Packed ids of text without special tokens, by the library's normalising and splitting."""
        parts = []
        for p, _ in self.split(self.normalise(text)) if text else ():
            symbols = [*p[:-1], p[-1] + self.suffix]
            try:
                parts.append(self._merged([self.vocabulary[s] for s in symbols]))
            except KeyError as e:
                raise ValueError(f"the vocabulary has no symbol {e}") from None
        return b"".join(parts)

    def _whole(self, text: str) -> bytes:
        """Packed ids of a text: special tokens first, then the rest between them."""
        if self.find_special is None:
            return self._plain(text)
        return b"".join(np.array([self.special[t]], "<u4").tobytes() if t in self.special else self._plain(t) for t in self.find_special.split(text))

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        if not text:
            return b""
        kept = self.kept_ids
        if self.western and WESTERN.fullmatch(text) and not (self.find_special and self.find_special.search(text)):
            pieces = WESTERN_SPLIT.findall(text.lower())
            try:
                return b"".join([kept[p] for p in pieces])
            except KeyError:
                return self._western(pieces)
        if not self.by_word:
            return self._whole(text)
        parts = []
        for w in text.encode("utf-8").split():            # at ASCII blanks only; words are bytes, western pieces strings
            ids = kept.get(w)
            if ids is None:
                ids = self._whole(w.decode("utf-8"))
                self._keep(w, ids)
            parts.append(ids)
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        """The text of ids in UTF-8, special tokens too: tokens with a space between, as the library does where a file names no decoder."""
        own = np.frombuffer(ids, "<u4")
        if len(own) and int(own.max()) >= len(self.tokens):
            own = own[own < len(self.tokens)]
        own = own[self.known[own]]
        return b" ".join(map(self.tokens.__getitem__, own.tolist()))


def coder(source: str) -> Coder:
    """The process's coder for this file; it outlives a task, so that words needn't be merged anew."""
    home = sys.modules.setdefault("_kept_coders", types.ModuleType("_kept_coders"))
    key = hashlib.sha256(source.encode("utf-8")).hexdigest()
    if getattr(home, "key", None) != key:
        home.key, home.coder = key, Coder(source)
    return home.coder


@functools.cache
def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _shared(spark: SparkSession, tokenizer_file: str):
    return spark.sparkContext.broadcast(_read(tokenizer_file))


def _run(rows: DataFrame, tokenizer_file: str, step, columns: str) -> DataFrame:
    """Applies step(coder, values) -> columns after the id, a thousand rows at a time."""
    short_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(_read(tokenizer_file))
    schema = T.StructType([rows.schema[0], *T.StructType.fromDDL(columns)])

    def run(batches):
        own = coder(shared.value)
        for b in slices(batches, 200):
            yield pa.RecordBatch.from_arrays([b.column(0), *step(own, b.column(1))], schema.names)
        give_back()

    return rows.mapInArrow(run, schema)


def _ids(own: Coder, texts: pa.Array) -> list[pa.Array]:
    return [pa.array([own.encode(t.as_py()) for t in texts], pa.binary())]


def _texts(own: Coder, ids: pa.Array) -> list[pa.Array]:
    return [pa.array([own.decode(x.as_py() or b"") for x in ids], pa.binary()).cast(pa.string())]


def encode(docs: DataFrame, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): every text's ids as little-endian 32-bit integers."""
    return _run(docs.select(doc_id, text), tokenizer_file, _ids, "ids binary")


def decode(coded: DataFrame, tokenizer_file: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, decoded): the text of every row's ids; null ids are none."""
    return _run(coded.select(doc_id, ids), tokenizer_file, _texts, "decoded string")


def round_trip(docs: DataFrame, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): ids and what they decode to, in one pass."""

    def both(own: Coder, texts: pa.Array) -> list[pa.Array]:
        ids = _ids(own, texts)
        return ids + _texts(own, ids[0])

    return _run(docs.select(doc_id, text), tokenizer_file, both, "ids binary, decoded string")


def round_trip_report(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of every document's ids and of what they decode to."""
    return round_trip(docs, tokenizer_file).select(
        "doc_id", F.call_function("div", F.octet_length("ids"), F.lit(4)).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
