"""A training corpus from ``documents``: five stages, each written before the next one reads it.

Toxic documents go, then documents in no known language, then near copies
(the least id of each group stays), then documents with a benchmark passage;
what is left is packed into sequences. Each stage judges every document that
its predecessor kept, by the same operators as the single queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machinewatch.llm.common import crc_mod, prepare, table, written
from machinewatch.llm.decontaminate import clean
from machinewatch.llm.language import fit_bounds, fit_profiles, identified
from machinewatch.llm.packing import pack_documents, with_crc
from machinewatch.llm.simhash import one_of_each
from machinewatch.llm.toxicity import fit_lexicon, toxicity_udf


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half; the lexicon is learned as in ``op5_toxicity``."""
    labels = table(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 5) != 0)
    score = toxicity_udf(fit_lexicon(docs, labels))
    return docs.where(score(F.col("text"))["predicted"] == 0)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near the profile of a learned language; profiles and bounds are learned as in ``op3_language_id``."""
    labelled = docs.where(crc_mod(F.col("doc_id"), 4) != 2)
    profiles = fit_profiles(labelled)
    return docs.where(identified(F.col("text"), profiles, fit_bounds(labelled, profiles)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, in sequences."""
    return with_crc(pack_documents(docs))


def _prepared(stage):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(prepare(spark), docs, sf_dir)

    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


STAGES = [
    ("toxicity", _prepared(drop_toxic)),
    ("language_id", _prepared(keep_known_languages)),
    ("near_duplicates", _prepared(drop_near_copies)),
    ("decontamination", _prepared(drop_contaminated)),
    ("packing", _prepared(pack)),
]

#: SQL cannot tokenize by a vocabulary file or learn the models; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
