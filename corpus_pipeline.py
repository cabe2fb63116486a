"""The corpus pipeline: five stages from raw documents to sampled token ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before kept; its result is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``documents``; other columns, whatever
their names, are dropped.  An empty table gives an empty one.  Null ids, languages and
sources stay as they are; a null or empty text is a document without words.  Texts are
worked on whole, however long.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from retainspark.llm import decontaminate, pieces, quality, simhash, substring
from retainspark.llm.common import materialise, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops short, repetitive and mostly boilerplate documents, those without words
    among them.  Each row is judged by itself, so repeated rows share a verdict."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.label_lines(docs, model).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component, the one of the smallest id; all documents
    without words are one component, repeated rows too."""
    return simhash.keep_one(docs, shingle=3, max_bits=2).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated 20-word windows; documents with nothing left go, those without words
    among them.  The first place of a passage stays: the smallest id, within one id by a hash of the
    texts.  Rows equal in id and text are one row and lose nothing to each other."""
    out = substring.remove_repeats(docs, window=20).filter("n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return (out.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long"))
            .select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a 10-word window of the benchmark.  Documents without words
    stay; repeated rows share a verdict."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"), n=10).select(*COLUMNS)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document that is left, fewer where a text has
    fewer; rows of equal id and text draw the same samples."""
    return pieces.sample_segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"), k=2,
                                       keep=["doc_id", "lang", "source"])


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("substring dedup", substring_dedup),
          ("decontamination", benchmark_decontamination), ("sentencepiece", sentencepiece_ids)]

#: The trained line labels, fingerprints and sampled ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
