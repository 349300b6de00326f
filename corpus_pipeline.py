"""A corpus made ready for training: the stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.llm import decontaminate, packing, secret_scan, simhash, toxicity
from ledgermart.llm.common import read, written


def _measured(before: DataFrame, after: DataFrame) -> DataFrame:
    """The columns of ``before``, with n_chars, if there is one, that of the text as it is now; null stays null."""
    if "n_chars" not in before.columns:
        return after.select(*before.columns)
    kind = dict(before.dtypes)["n_chars"]
    now = F.when(F.col("n_chars").isNotNull(), F.coalesce(F.char_length("text"), F.col("n_chars"))).cast(kind)
    return after.withColumn("n_chars", now).select(*before.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go; the model is fitted on the labelled ones among ``docs``."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), grade="toxic")
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; from the others the words of benchmark windows are cut."""
    return _measured(docs, decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; all documents stay."""
    return _measured(docs, secret_scan.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's pieces in the training sequences."""
    return packing.pack(docs)


STAGES = [
    ("ordinal_toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", remove_benchmark),
    ("entropy_secrets", redact_secrets),
    ("complement_packing", pack),
]

#: Tokenizing, hashing words and the fitted model can't be said in SQL; tests compare each stage with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
