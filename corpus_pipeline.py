"""The corpus pipeline: language ID, quality, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the columns of
docs; whatever columns docs has beside doc_id and text go through as they are (n_chars follows the text).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm import language_id, near_dedup, packing, passage_dedup, quality
from rosterlake.llm.common import materialize, table
from rosterlake.storage import Scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, those whose language is in doubt (score under 0.5) and those in no language of the
    input. The model learns from the input's own lang column, a bounded sample of each language; how far known texts stray is
    taken from all labelled rows."""
    labelled = docs.select("doc_id", "text", "lang")
    model = language_id.fit(labelled)
    return language_id.keep_identified(docs, model, spread=language_id.spread_of(labelled, model))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose score for label 1 is under the threshold."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at a similarity of 0.8 over five-word shingles the smallest doc_id stays."""
    return near_dedup.drop_near_duplicates(docs, size=5, percent=80)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that repeat across documents out of all texts but the first."""
    edited = passage_dedup.remove_repeats(docs, passage_dedup.repeated_passages(docs))
    if "n_chars" not in docs.columns:
        return edited
    kind = docs.schema["n_chars"].dataType
    return edited.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Workers that have held the
    other stages keep a smaller table of pieces."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), kept=30_000)


STAGES = [
    ("language ID", identify_language),
    ("quality classifier", classify_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("best-fit packing", pack_sequences),
]

#: Model scores, MinHash and tokenizers are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with Scratch() as outputs:
        for name, stage in STAGES[:-1]:
            with Scratch() as scratch:  # what a stage has written on its way goes when its output is there
                docs = scratch.keep(materialize(stage(spark, docs, sf_dir), name.replace(" ", "-")))
        outputs.keep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
