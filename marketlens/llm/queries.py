"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import (bpe, centroids, decontaminate, html_main, language_id, mixing, pseudonyms, similarity_join, substring_dedup,
                            token_store, url_rules, whitening, winnowing)

from marketlens.session import checkpoint_dir

# The rules (host, path, action) that op6 judges by.
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
             ("com", "/de/", "block"))
#: The id that ends a document in the token store.
END_ID = 2
#: Session setting that names the table with the key of the pseudonyms; unset, one is made once beside the checkpoints.
PSEUDONYM_KEY = "spark.marketlens.pseudonym.keytable"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = html_main.extract_main_text(_table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal numbers, dates and addresses replaced."""
    path = spark.conf.get(PSEUDONYM_KEY, None)
    key = spark.read.schema("key string").parquet(path) if path else pseudonyms.make_key(spark, f"{checkpoint_dir(spark).rstrip('/')}/pseudonym-key")
    return pseudonyms.pseudonymise(_table(spark, sf_dir, "documents"), key)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside benchmark windows."""
    return decontaminate.leak_report(decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document."""
    out = mixing.mix(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the windows of documents before it."""
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict."""
    rules = [url_rules.list_rule(*r) for r in URL_RULES] + [url_rules.word_rule(w) for w in url_rules.UNWANTED_HOST_WORDS]
    return url_rules.filter_urls(_table(spark, sf_dir, "pages"), url_rules.rule_table(spark, rules))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token store of all documents and reads it back."""
    import public_tokenizers
    path = token_store.write_store(_table(spark, sf_dir, "documents"), token_store.new_store_path(spark),
                                   public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return store_digest(token_store.read_store(spark, path))


def store_digest(read: DataFrame) -> DataFrame:
    return read.select("doc_id", "start", F.call_function("div", F.octet_length("ids"), F.lit(4)).cast("bigint").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that aren't held out; a row without an id is not held out."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    known = language_id.collect_prototypes(language_id.learn_prototypes(docs.where(~held_out)))
    return language_id.identify(docs, known).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component under links of 85 percent of 4-word shingles."""
    return similarity_join.similar_groups(_table(spark, sf_dir, "documents"), 4, 85)


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return winnowing.next_document_report(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding on the first 16 components."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every embedding after ten rounds from eight first centroids."""
    return centroids.cluster_vectors(_table(spark, sf_dir, "embeddings"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of their decoded text."""
    import public_tokenizers
    return bpe.round_trip_report(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {f.__name__: f for f in (op1_main_text, op2_pseudonyms, op3_decontaminate, op4_mix, op5_substring_dedup, op6_url_filter, op7_token_store,
                                   op8_language_id, op9_similarity_join, op10_winnowing, op11_whitening, op12_centroids, op13_bpe)}
