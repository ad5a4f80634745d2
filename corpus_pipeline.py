"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, leaked benchmark items and
secrets go, and what is left is packed into training sequences.

Each stage takes the rows that its predecessor wrote. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adweave.llm import decontamination, ngram_join, packing, secret_scan, toxicity
from adweave.llm.common import saved, table, unused

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below 0.5. It is fitted to ``labels`` outside fold 0."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "_toxicity")
    return toxicity.score(docs, model, score_col=score).where(F.col(score) < 0.5).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of texts that are alike in five-word shingles (0.8 or more).

    Of rows with that id the one with the smallest hash of its text is kept. Texts without words stay.
    """
    return ngram_join.one_per_component(docs, ngram_join.similar_documents(docs, words=5, percent=80)).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within a fifth of its words."""
    own_id, key = unused(docs, "_id"), unused(docs, "_key")
    found = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"), errors=0.2)
    leaks = saved(found.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(key)).distinct(), "leaks")
    match = F.col("doc_id").cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(F.col("text").cast("string")) == F.col(key))
    return docs.join(leaks, match, "left_anti").select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with ``[SECRET]`` in place of the secrets found."""
    return secret_scan.redacted(docs, secret_scan.scan(docs, path_col="source"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences with their ids."""
    return packing.pack_windows(docs, WORD_BPE)


STAGES = [("toxicity", drop_toxic), ("near duplicates", one_of_each_group), ("decontamination", drop_leaks), ("secrets", redact_secrets), ("packing", pack)]
ORACLE_SQL = None  # the first stage is a trained model


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
