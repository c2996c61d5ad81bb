"""A corpus pipeline: each stage gets what the one before kept, as written rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.llm import chosen_path, mixing, sentencepiece_bpe, surrogates, toxicity
from crawlspark.llm.catalog import tokenizer_path
from crawlspark.llm.shared import staged, table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject; a document needs a score of 0.5 to go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, name="_score").filter(F.col("_score") < 0.5).drop("_score")


def dedupe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of near duplicates: five words, similarity 0.8."""
    return chosen_path.deduplicated(docs)


def anonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data and secrets replaced; surrogates keep most lengths, ``n_chars`` is counted anew."""
    return surrogates.replace(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row for each pass that takes words of a document, with those words."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, end id included."""
    encoded = sentencepiece_bpe.encode(docs, tokenizer_path(), ids="ids", decoded="decoded")
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("toxicity", clean), ("near_duplicates", dedupe), ("surrogates", anonymize), ("mixing", mix), ("sentencepiece", tokenize)]
# Trained models and keyed replacements have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
