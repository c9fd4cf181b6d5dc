"""A training corpus from `documents`: filter, deduplicate, decontaminate, mix.

Each stage reads what its predecessor wrote. All but the last return rows of documents;
the last returns one row per document with its tokens, domain posteriors and rate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outreach.llm import decontamination, language_id, mixing, near_dedup, toxicity
from outreach.llm.common import table
from outreach.sources.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score as toxic. Null and empty texts, repeated rows, long texts
    and further columns of any name are scored and kept like others."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.without_toxic(docs, model)


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters, null texts among them, or in no language that the
    corpus names; repeated rows and further columns stay as they are."""
    return language_id.identified(docs, language_id.learn(docs, F.lit(True)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, rows without an id or with a
    shared one among them; texts without words and null texts all stay."""
    return near_dedup.deduplicated(docs, without_id=True)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item, also in edited form, with or without
    id; null and empty texts stay. Rows without an id are searched under a key of their text."""
    lacks = near_dedup.fresh_name(docs, "_no_id")
    keyed = docs.withColumns({lacks: F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", near_dedup.text_key())})
    left = decontamination.decontaminated(keyed, table(spark, sf_dir, "benchmark"))
    return left.withColumn("doc_id", F.when(~F.col(lacks), F.col("doc_id"))).drop(lacks)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates that bring the domains to their target weights, a row per document."""
    return mixing.mixing_rates(docs, table(spark, sf_dir, "labels"), keep=("doc_id", "lang", "source"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unidentified),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_copies),
    ("mixing", mix),
]

# The models, the signatures and the alignment have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
