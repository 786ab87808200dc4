"""From raw documents to packed training sequences.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)``, works on
all rows that its predecessor kept, and returns a table with the columns of
``documents`` (the last one: a row per packed piece). ``run`` applies them to
``documents``, each stage's result written to the shared folder and read again. An empty
table stays empty in every stage; columns besides those that a stage works on go through it
unchanged, but for the last one, which drops them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestats.llm import linededup, mixing, neardup, packing, quality
from homestats.llm.catalog import BATCH_BYTES
from homestats.llm.common import materialize, table

#: No SQL expresses expectation-maximisation, signatures and tokenization; tests/llm compare with brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base limits (null, empty and short texts do) or are probably bad by the weighed rules."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines found in at least 10 documents; ``n_chars`` follows the text. A null text becomes an empty one."""
    columns = docs.columns
    out = linededup.drop_frequent_lines(docs, min_docs=10)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents of similarity 0.8 or more, keep the one with the smallest id; of equal rows, and of empty texts, one stays."""
    return neardup.keep_one_per_class(docs, 0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and drop documents by their source's rate: weights 3, 1, 2 in turn over 150% of all words."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack documents into sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, "pipeline")
    return docs
