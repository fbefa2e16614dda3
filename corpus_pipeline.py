"""A corpus pipeline: toxic documents go, boilerplate lines go, one of each group of near-duplicates stays,
contaminated documents go, and the rest is packed into token sequences.

Every stage takes ``(spark, docs, sf_dir)`` and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import boilerplate, decontaminate, packing, simhash, toxicity
from stratalake.llm.common import ship, stage
from stratalake.llm.labelled import fold

#: Rows of one stage's result need trained weights, so no SQL gives the rows of the whole.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, fitted on the labelled rows of the corpus, scores below one half."""
    ship(spark)
    network = toxicity.fit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return toxicity.drop_toxic(docs, network)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sources share; ``n_chars`` follows the text."""
    ship(spark)
    cleaned = boilerplate.remove_boilerplate(docs)
    changed = F.when(F.col("__n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", changed).drop("__n_lines", "__n_removed")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (3-word shingles) link at 3 or fewer bits."""
    ship(spark)
    return simhash.keep_one(docs, shingle_words=3, max_bits=3)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window of ten words."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in token sequences."""
    ship(spark)
    tokenizer, ranks = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return packing.pack(docs, tokenizer, ranks)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_copies),
    ("benchmark_decontamination", drop_leaks),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs, _ = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
