"""The corpus pipeline: language ID, near duplicates, benchmark leaks, source mix, token files.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next
one's docs; all but the last return the columns of the documents. Stages keep a row's other columns as they are, whatever
their names.

Nulls and odd rows: a null or empty text, or one without letters, goes in the first stage; a null id or source stays
(a null source is one of its own in the mix). Of rows that repeat an id and a text one goes on. An empty table passes
through all stages and makes an empty store; with no labelled language nothing is learned and no document stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import decontaminate, language_id, mixing, queries, similarity_join, token_store
from marketlens.llm.textops import short_batches
from marketlens.session import checkpoint_dir, cut_lineage

#: Ids up to this many are broadcast (8 bytes each) when rows are dropped by id; more are joined by shuffling.
BROADCAST_IDS = 4_000_000
#: Dimensions of the language profiles here: letters that no language has score 0.02 in standard deviation (1 / sqrt).
DIMENSIONS = 2_048
#: (code points, cosine): a text of at least so many must score above that. A shorter clean text shares less with its
#: language; under 20 it can score like noise, and stays in doubt.
LEAST_COSINE = ((300, 0.15), (20, 0.08), (0, 0.0))


def _with_row(docs: DataFrame) -> DataFrame:
    """(row, text): the other columns as one, and the text."""
    return docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "text")


def _rows(kept: DataFrame, docs: DataFrame) -> DataFrame:
    return kept.select("doc_id.*", "text").select(*docs.columns)


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which no language is found: no text, no letter, or no more likeness to any language than
    LEAST_COSINE. The languages are learned from the documents that have one."""
    short_batches(spark)
    known = language_id.collect_prototypes(language_id.learn_prototypes(docs, size=DIMENSIONS))
    judged = language_id.identify(_with_row(docs), known, doc_id="row", keep_text=True)
    least = F.coalesce(*[F.when(F.length("text") >= n, cosine) for n, cosine in LEAST_COSINE])
    return _rows(judged.where((F.col("lang_pred") != "und") & (F.col("score") > least)), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by four fifths of their 5-word shingles the one of the smallest id stays (null ids
    rank last, equal ids by a hash); of rows that repeat an id and a text one stays. Rows are told apart by a 64-bit hash of
    id and text, so that rows of one id, or without an id, are judged each by its own text."""
    short_batches(spark)
    key = "__row_key"
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text", F.col("doc_id").isNull()))
    groups = cut_lineage(similarity_join.similar_groups(keyed, doc_id=key)).select(F.col("doc_id").alias(key), F.col("component_id").alias("_group"))
    small = lambda d: F.broadcast(d) if d.count() <= BROADCAST_IDS else d
    shared = cut_lineage(groups.where(F.col(key) != F.col("_group")).select("_group").distinct())
    members = cut_lineage(groups.join(small(shared), "_group").distinct())
    named = members.join(keyed.select(key, "doc_id").distinct(), key)
    stays = named.groupBy("_group").agg(F.min_by(key, F.struct(F.col("doc_id").isNull(), "doc_id", key)).alias("_stays"))
    drop = cut_lineage(members.join(stays, "_group").where(F.col(key) != F.col("_stays")).select(key))
    twice = cut_lineage(groups.groupBy(key).count().where("count > 1").select(key))
    kept, again = keyed.join(small(drop), key, "left_anti"), small(twice)
    once = kept.join(again, key, "left_anti")
    repeated = kept.join(again, key, "left_semi").dropDuplicates([key])
    return once.unionByName(repeated).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents with a window of a benchmark item."""
    short_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_leaks(_with_row(docs), benchmark, doc_id="row", keep_text=True)
    return _rows(found.where(F.size("items") == 0), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.mixed_documents(docs)


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store's documents, read back from its files."""
    import public_tokenizers
    path = token_store.write_store(docs, token_store.new_store_path(spark), public_tokenizers.path("word_bpe_49k.json"), queries.END_ID)
    return queries.store_digest(token_store.read_store(spark, path))


STAGES = [("language_id", identify_languages), ("near_duplicates", drop_near_duplicates), ("benchmark_leaks", drop_leaks),
          ("source_mix", mix_sources), ("token_store", store_tokens)]

#: The first stage's model has no SQL form; the pipeline is tested stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the stages' tables are written beside the cluster's checkpoints."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
