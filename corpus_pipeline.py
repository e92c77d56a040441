"""Corpus pipeline: documents in, cleaned, deduplicated and tokenized documents out.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tariffloom.llm import bpe, decontaminate, language_id, minhash, quality
from tariffloom.llm.common import fresh, materialize, small, table

TOKENIZER = "byte_bpe_50k.json"
#: Word shingles and similarity (in percent) of near-duplicates.
SHINGLE_WORDS, PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with confidence.

    Null and empty texts, and texts without a letter, have no evidence and go.
    Addresses come from ``pages``. Texts are read whole; of equal posteriors the language first by name holds;
    repeated rows are judged each; an empty table gives none; further columns
    are kept, whatever their names.
    """
    return language_id.identify_documents(docs, table(spark, sf_dir, "pages")).where("language_kept").select(*docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier takes as good.

    Null and empty texts are judged as empty, null metadata is a value of its
    own; texts are read whole; a score on the cut is kept; repeated rows are
    judged each; without labels of both classes all rows are kept; an empty
    table gives none; further columns are kept, whatever their names.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("quality_kept").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the least doc_id; rows that repeat a doc_id go as well.

    Null and empty texts are near no other; rows without a doc_id are kept;
    texts are read whole; of rows with one doc_id the first by all columns
    stays; an empty table gives none; further columns are kept, whatever their
    names.
    """
    judged = minhash.near_duplicates(docs, words_each=SHINGLE_WORDS, percent=PERCENT)
    dropped_id, repeated_id, times, place = fresh(docs, "dropped_id", "repeated_id", "times", "place")
    dropped = materialize(judged.where("not kept").select(F.col("doc_id").alias(dropped_id)).distinct(), "dropped")
    rows = docs.join(small(dropped), F.col("doc_id") == F.col(dropped_id), "left_anti")
    ids = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias(repeated_id)).agg(F.count("*").alias(times))
    repeated = materialize(ids.where(F.col(times) > 1).select(repeated_id), "repeated")
    if repeated.isEmpty():
        return rows
    again = rows.join(repeated, F.col("doc_id") == F.col(repeated_id), "left_semi")
    again = again.withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy(*docs.columns))).where(F.col(place) == 1).drop(place)
    return rows.join(repeated, F.col("doc_id") == F.col(repeated_id), "left_anti").unionByName(again)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.

    Null and empty texts hold none; texts are searched whole; rows without a
    doc_id are judged by their text; all rows of a doc_id with a passage go; an
    empty benchmark keeps all; an empty table gives none; further columns are
    kept, whatever their names.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("leak_kept").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded text, for every row; null texts count as empty, other columns are left out."""
    return bpe.encode_decode(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language ID", identify_language),
    ("quality classifier", classify_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("BPE encoding and decoding", encode),
]
#: SQL can express neither the trained models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each over the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
