"""One query for each operator, over its whole table, with SQL where SQL can say it.

The operators' own results are richer (ids, texts, spans, files); the queries derive digests from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.llm import (chosen_path, compression_bands, impact_ranges, license_scan, mixing, multiset_hash, ngram_trie, sentencepiece_bpe, sphere_filters, suffix_dedup,
                            surrogates, tiled_phrases, toxicity)
from crawlspark.llm.oracles import ORACLES
from crawlspark.llm.shared import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def hex_digest(text) -> F.Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    encoded = sentencepiece_bpe.encode(documents, tokenizer_path(), decoded="decoded")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          hex_digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
                          hex_digest(F.col("decoded")).alias("decoded_sha256"))


def fold(modulus: int) -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, table(spark, folder, "labels"), fold(5) != 0)
    return toxicity.score(documents, model).select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_sphere_filters(spark: SparkSession, folder: str) -> DataFrame:
    return sphere_filters.links(table(spark, folder, "embeddings"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_ngram_trie(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_trie.score(table(spark, folder, "documents"), fold(10) == 0)


def op6_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.replace(table(spark, folder, "documents").select("doc_id", "text"), count="n_entities")


def op7_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, folder, "documents"), size=4)


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove(table(spark, folder, "documents"), report=True)


def op9_multiset_hash(spark: SparkSession, folder: str) -> DataFrame:
    return multiset_hash.edit_report(table(spark, folder, "documents"))


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))


def op11_impact_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return impact_ranges.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_tiled_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return tiled_phrases.top_phrases(table(spark, folder, "documents"))


def op13_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    return compression_bands.measure(table(spark, folder, "documents")).select("doc_id", *compression_bands.COUNTS, "base_failed", "kept", "ratio", "bad_share", "reason")


QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_toxicity, op3_sphere_filters, op4_mixing, op5_ngram_trie, op6_surrogates, op7_chosen_path, op8_suffix_dedup, op9_multiset_hash,
                                   op10_license_scan, op11_impact_ranges, op12_tiled_phrases, op13_compression_bands)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
