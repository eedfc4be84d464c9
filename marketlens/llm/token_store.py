"""Token-id files with a shared compression dictionary (operator 7).

A document's ids are one little-endian array (16 bits where the vocabulary and
the end id allow it, else 32), compressed by itself with zstandard and a
dictionary that all documents share. A store is a folder with two Parquet
tables: ``dictionary`` (one row: the dictionary, its SHA-256, the id width) and
``shards``: runs of documents in ascending id order, each shard with its
documents' ids, token offsets and byte offsets, and one payload of the
compressed arrays. A single document is read from its shard by its offset.

Edge cases: a null or empty text has the end id alone; null document ids come
first; repeated rows are stored each. An empty table makes an empty store.
Other columns are not read. Texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import os
import sys
import types
import unicodedata
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.ranges import range_bounds, text_bytes
from marketlens.llm.textops import give_back, runs, short_batches, slices, utf8
from marketlens.llm.word_table import WordTable

#: The dictionary is trained on this many documents (those of the least hashes), this much of each from a hashed place, at most.
SAMPLE_DOCUMENTS, SAMPLE_CHARS, DICTIONARY_BYTES = 1_000, 16_384, 64 << 10
RANGE_BYTES, SHARD_BYTES, SHARD_DOCUMENTS = 64 << 20, 256 << 10, 8_192
#: Parquet row groups of the shards: a task holds one while it writes or reads.
GROUP_BYTES = 16 << 20
LEVEL = 3


#: Words encoded by one call of the tokenizer.
TOGETHER = 256
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def splits_at_blanks(tool) -> bool:
    """Whether a text's ids are those of its lower-cased words in order, and a word's those of its body and of the
    marks at its end: the tokenizer lower-cases, drops blanks, and keeps letters and marks apart."""
    ids = lambda t: tool.encode(t, add_special_tokens=False).ids
    body, marks = ids("ab"), [m.decode() for m in (_MARKS[i:i + 1] for i in range(len(_MARKS)))]
    return "Lowercase" in repr(tool.normalizer) and all(ids(f"AB{m}") == body + ids(m) for m in marks) and all(
        ids(f"ab{m}{k}\t{m} 1ab") == body + ids(m + k) + ids(m) + ids("1ab") for m in marks for k in marks)


def _body(word: bytes) -> bytes:
    """A word without the marks at its end, if what precedes them is a letter or digit."""
    body = word.rstrip(_MARKS)
    if not body or body[-1] < 128:
        return body if body[-1:].isalnum() or not body else word
    return body if unicodedata.normalize("NFC", body.decode("utf-8")[-1]).lower().isalpha() else word


class _Words:
    """Packed ids of words: words that differ in the marks at their end share their body's ids, and bodies of letters are
    encoded many at a time and told apart by the ids that end a word."""

    def __init__(self, source: str, width: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tool, self.width = Tokenizer.from_str(source), width
        self.apart = splits_at_blanks(self.tool)
        suffix = getattr(self.tool.model, "end_of_word_suffix", None)
        vocabulary = self.tool.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.special = [t.content.encode("utf-8").lower() for t in self.tool.get_added_tokens_decoder().values()]
        self.table = WordTable(self.encode, width)

    def pack(self, ids) -> bytes:
        return np.array(ids, self.width).tobytes()

    def whole(self, text: str) -> bytes:
        return self.pack(self.tool.encode(text, add_special_tokens=False).ids)

    def _encoded(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of bodies and marks; none of them holds a blank."""
        texts = b" ".join(parts).decode("utf-8").split(" ") if parts else []
        alone = [not t.isalpha() for t in texts]
        single = [x for x in zip(parts, texts, alone, strict=True) if x[2]]
        letters = [x for x in zip(parts, texts, alone, strict=True) if not x[2]]
        out, size = {}, np.dtype(self.width).itemsize
        for i in range(0, len(letters), TOGETHER):
            own = letters[i:i + TOGETHER]
            ids = np.array(self.tool.encode_batch_fast([" ".join([x[1] for x in own])], add_special_tokens=False)[0].ids, np.int64)
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) != len(own) or (len(last) and last[-1] != len(ids)):
                single += own                                # a body of several of the tokenizer's words
                continue
            raw, to = self.pack(ids), (last * size).tolist()
            out.update(zip([x[0] for x in own], [raw[a:b] for a, b in zip([0, *to[:-1]], to, strict=True)], strict=True))
        for x, e in zip(single, self.tool.encode_batch_fast([x[1] for x in single], add_special_tokens=False), strict=True):
            out[x[0]] = self.pack(e.ids)
        return out

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of distinct words without blanks."""
        bodies = [_body(w) for w in words]
        need = dict.fromkeys(x for w, b in zip(words, bodies, strict=True) for x in (b, w[len(b):]) if x)
        known = self._encoded(list(need))
        known[b""] = b""
        return [known[b] + known[w[len(b):]] for w, b in zip(words, bodies, strict=True)]


def _kept_words(source: str, width: str) -> _Words:
    """The process's words of this tokenizer; they outlive a task, so that the next needn't learn them anew."""
    home = sys.modules.setdefault("_kept_token_words", types.ModuleType("_kept_token_words"))
    key = (hashlib.sha256(source.encode("utf-8")).hexdigest(), width)
    if getattr(home, "key", None) != key:
        home.key, home.words = key, _Words(source, width)
    return home.words


def _encoder(tokenizer, width: str, end_id: int):
    """A function from a column of texts to their packed ids. Texts that may spell a special token are encoded whole."""
    words = _kept_words(tokenizer.value, width)
    end = np.array([end_id], width).tobytes()
    size = np.dtype(width).itemsize

    def encode(column: pa.Array) -> list[bytes]:
        out: list[bytes] = []
        data, offsets = utf8(column)
        for i, j in runs(offsets):
            own, cuts = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            if not words.apart:
                out += [words.whole(t.as_py() or "") + end for t in column[i:j]]
                continue
            ids, ends = words.table.encode_run(own, cuts, end_id)
            raw, at = ids.tobytes(), (ends * size).tolist()
            out += [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            seen = own.tobytes().lower()
            if any(x in seen for x in words.special):
                for k in range(i, j):
                    text = column[k].as_py() or ""
                    if any(x in text.encode("utf-8").lower() for x in words.special):
                        out[k] = words.whole(text) + end
        return out

    return encode


def _train(samples: list[bytes]) -> bytes:
    """A dictionary of the samples; none if they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b""


def write_store(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> str:
    """Tokenizes, compresses and writes all documents; the path of the store."""
    spark = docs.sparkSession
    short_batches(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        source = f.read()
    from tokenizers import Tokenizer
    width = "<u2" if max(Tokenizer.from_str(source).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    tokenizer = spark.sparkContext.broadcast(source)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))

    def plain(batches):
        encode = _encoder(tokenizer, width, end_id)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(encode(b.column(0)), pa.binary())], ["ids"])
        give_back()

    # ids alone are ranked; then the few texts of the least hashes are read, of repeated ids as many as are wanted
    rank = F.xxhash64(F.col("id"))
    least = rows.select(rank.alias("r")).orderBy("r").limit(SAMPLE_DOCUMENTS).agg(F.max("r")).first()[0]
    place = F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1).cast("int") + 1
    sample = rows.where((rank <= F.lit(least)) & (F.length("text") > 0)).limit(SAMPLE_DOCUMENTS).select(
        F.substr("text", place, F.lit(SAMPLE_CHARS)).alias("part"))
    samples = sorted(bytes(r["ids"]) for r in sample.mapInArrow(plain, "ids binary").collect())
    trained = _train(samples)
    digest = hashlib.sha256(trained).hexdigest()
    shared = spark.sparkContext.broadcast(trained)
    spark.range(1).select(F.lit(bytearray(trained)).alias("dictionary"), F.lit(digest).alias("sha256"), F.lit(width).alias("width"),
                          F.lit(end_id).alias("end_id")).coalesce(1).write.parquet(f"{path}/dictionary")
    n = max(1, -(-text_bytes(rows, "text") // RANGE_BYTES))
    cuts = np.array(range_bounds(rows, "id", n), np.int64)

    def compress(batches):
        encode = _encoder(tokenizer, width, end_id)
        tool = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(shared.value) if shared.value else None,
                                        write_checksum=False)
        size = np.dtype(width).itemsize
        for b in slices(batches):
            ids, packed = b.column(0), encode(b.column(1))
            key = np.array([x if x is not None else -1 << 63 for x in ids.to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(cuts, key, side="left"), pa.int32()), ids, pa.array([len(p) // size for p in packed], pa.int64()),
                 pa.array([tool.compress(p) for p in packed], pa.binary())], ["bucket", "id", "n", "payload"])
        give_back()

    coded = rows.mapInArrow(compress, "bucket int, id bigint, n bigint, payload binary").repartitionById(len(cuts) + 1, "bucket") \
        .sortWithinPartitions("bucket", F.col("id").asc_nulls_first(), "n", "payload")
    schema = T.StructType.fromDDL("bucket int, shard int, before bigint, n_tokens bigint, first_id bigint, last_id bigint, sha256 string, "
                                  "ids array<bigint>, firsts array<bigint>, offsets array<bigint>, payload binary")

    def shards(batches):
        bucket, shard, before, held, used = None, 0, 0, [], 0

        def flush():
            nonlocal shard, before, held, used
            ids, counts, parts = zip(*held, strict=True)
            known = [i for i in ids if i is not None]
            firsts, offsets = (np.concatenate([[0], np.cumsum(x)]) for x in (counts, [len(p) for p in parts]))
            row = dict(zip(schema.names, ([bucket], [shard], [before], [sum(counts)], [known[0] if known else None], [known[-1] if known else None],
                                          [digest], [list(ids)], [firsts.tolist()], [offsets.tolist()], [b"".join(parts)]), strict=True))
            shard, before, held, used = shard + 1, before + sum(counts), [], 0
            return pa.RecordBatch.from_pydict(row, schema=pa.schema(
                [("bucket", pa.int32()), ("shard", pa.int32()), *((k, pa.int64()) for k in ("before", "n_tokens", "first_id", "last_id")),
                 ("sha256", pa.string()), *((k, pa.list_(pa.int64())) for k in ("ids", "firsts", "offsets")), ("payload", pa.binary())]))

        for b in batches:
            for own, i, k, p in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if own != bucket:
                    if held:
                        yield flush()
                    bucket, shard, before = own, 0, 0
                held.append((i, k, p))
                used += len(p)
                if used >= SHARD_BYTES or len(held) >= SHARD_DOCUMENTS:
                    yield flush()
        if held:
            yield flush()

    coded.mapInArrow(shards, schema).write.option("compression", "none").option("parquet.block.size", GROUP_BYTES).parquet(f"{path}/shards")
    return path


def _decoded(shards: DataFrame, path: str, wanted: frozenset | None = None) -> DataFrame:
    """(doc_id, start, ids) of the documents of shards. Documents are taken from their shards before Python sees them, so that
    a batch holds documents and not shards."""
    spark = shards.sparkSession
    head = spark.read.parquet(f"{path}/dictionary").first()
    trained, width, digest = bytes(head["dictionary"]), head["width"], head["sha256"]
    shared = spark.sparkContext.broadcast(trained)
    payload = F.when(F.col("sha256") == digest, F.col("payload")).otherwise(
        F.raise_error(F.lit("the shard was written with another dictionary")).cast("binary"))
    each = F.transform(F.sequence(F.lit(0), F.size("ids") - 1), lambda i: F.struct(
        F.col("ids")[i].alias("doc_id"), (F.col("start") + F.col("firsts")[i]).alias("start"),
        F.substring(F.col("payload"), (F.col("offsets")[i] + 1).cast("int"), (F.col("offsets")[i + 1] - F.col("offsets")[i]).cast("int"))
        .alias("payload")))
    rows = shards.withColumn("payload", payload).select(F.explode(each).alias("d")).select("d.*")
    if wanted is not None:
        rows = rows.where(F.col("doc_id").isin(*wanted))

    def decode(batches):
        tool = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(shared.value) if shared.value else None)
        for b in slices(batches, 512):
            ids = [np.frombuffer(tool.decompress(p), width).astype("<u4").tobytes() for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())], ["doc_id", "start", "ids"])

    return rows.mapInArrow(decode, _ROWS)


_ROWS = "doc_id bigint, start bigint, ids binary"


def _with_starts(shards: DataFrame, path: str) -> DataFrame:
    """Shards with the number of ids before them: a range's shards know those before them in the range, and the ranges' sums, a
    row for each RANGE_BYTES of text, are broadcast."""
    spark = shards.sparkSession
    sums = spark.read.parquet(f"{path}/shards").groupBy("bucket").agg(F.sum("n_tokens").alias("n")).collect()
    totals = sorted((r["bucket"], r["n"]) for r in sums)
    ends = np.cumsum([0] + [n for _, n in totals]).tolist()
    bases = spark.createDataFrame([(b, e) for (b, _), e in zip(totals, ends, strict=False)], "bucket int, base bigint")
    return shards.join(F.broadcast(bases), "bucket").withColumn("start", F.col("base") + F.col("before")).drop("base")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): every document's ids as little-endian 32-bit integers, and the number of ids before them."""
    return _decoded(_with_starts(spark.read.parquet(f"{path}/shards"), path), path)


def read_documents(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """The same for a few documents: only shards whose id span holds one are read, and only those documents are decompressed."""
    wanted = frozenset(doc_ids)
    hit = F.lit(False)
    for i in wanted:
        hit = hit | ((F.col("first_id") <= i) & (F.col("last_id") >= i))
    shards = _with_starts(spark.read.parquet(f"{path}/shards").where(hit), path)
    return _decoded(shards, path, wanted)


def new_store_path(spark: SparkSession) -> str:
    """A fresh folder beside the cluster's checkpoints, which all executors share."""
    from marketlens.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/token-store-{uuid.uuid4().hex}"
