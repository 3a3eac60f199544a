"""A corpus from raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import block_naming, packing, pii, quality_rules, simhash
from encore.llm.queries import FIXTURE_KEY
from encore.llm.tables import read, stage
from encore.llm.vocabularies import WORD_BPE, vocabulary
from encore.sources.staging import Workspace

KEY_SETTING = "spark.encore.surrogates.key"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep."""
    return quality_rules.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return block_naming.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return simhash.drop_near_copies(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced; the length column follows the text.

    The key is the session's setting ``spark.encore.surrogates.key``.  Without it the
    fixture's key is used, which is public: it protects made-up data only.
    """
    key = spark.conf.get(KEY_SETTING, None)
    replaced = pii.replace(docs, key.encode() if key else FIXTURE_KEY)
    columns = [f"`{name}`" for name in docs.columns]
    return replaced.withColumn("n_chars", F.char_length("text").cast("long")).select(*columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of fixed windows of tokens."""
    return packing.pack(docs, vocabulary(WORD_BPE))


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("surrogates", surrogates),
    ("packing", sequences),
]

# the near-duplicate, surrogate and packing stages have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    workspace = Workspace(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), name.replace(" ", "_"), workspace)
    return STAGES[-1][1](spark, docs, sf_dir)
