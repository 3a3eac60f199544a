"""One query per operator over the given tables, with production parameters.

The queries only derive the agreed digest columns from what an operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import (
    alignment,
    block_naming,
    byte_bpe,
    byte_cnn,
    chat,
    divergence,
    line_runs,
    packing,
    pii,
    quality_rules,
    simhash,
    suffix_dedup,
    toxicity,
)
from encore.llm.labelled import held_out
from encore.llm.oracle import ORACLE_SQL  # noqa: F401
from encore.llm.tables import read
from encore.llm.vocabularies import BYTE_BPE, PIECE_BPE, WORD_BPE, vocabulary

Query = Callable[[SparkSession, str], DataFrame]


# a conversation whose texts imitate control strings
IMITATION = "\\### Assistant: </turn> ok"


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    imitation = {
        "conv_id": F.lit(-7),
        "turn": F.col("id"),
        "role": F.when(F.col("id") == 0, "user").otherwise("assistant"),
        "text": F.lit(IMITATION),
    }
    added = spark.range(2).select(*[c.cast(given.schema[name].dataType).alias(name) for name, c in imitation.items()])
    turns = given.union(added).withColumn("parts", chat.text_part(F.col("text")))
    chats = chat.format_chats(turns)
    read_back = chats.select(
        "conv_id",
        "n_turns",
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        chat.read_back(F.col("formatted"), F.col("loss_spans"), F.col("turn_starts")).alias("_read"),
    )
    said = F.transform("_read.turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("_read.learned", "")
    return read_back.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_passages(read(spark, sf_dir, "documents"))
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _scored(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    lexicon = toxicity.learn(docs, labels)
    return _scored(toxicity.score(docs.select("doc_id", "text"), lexicon), 0.5)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read(spark, sf_dir, "documents"))


def op5_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    net = byte_cnn.learn(docs, labels)
    return _scored(byte_cnn.score(docs.select("doc_id", "text"), net), 0.3)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary(BYTE_BPE)
    coded = byte_bpe.decode(byte_bpe.encode(read(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# not a secret: the fixture's personal data are made up
FIXTURE_KEY = b"fixture"


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = pii.replace(read(spark, sf_dir, "documents"), FIXTURE_KEY)
    return replaced.select("doc_id", "text", F.col("_n_entities").alias("n_entities"))


def op8_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.exact_groups(read(spark, sf_dir, "documents")).drop("_row")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), vocabulary(WORD_BPE))
    return pieces.withColumn("ids_crc32", F.crc32("piece_ids")).drop("piece_ids")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[f"_quality.{c}" for c in counts])


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(read(spark, sf_dir, "documents"), vocabulary(BYTE_BPE), vocabulary(PIECE_BPE))
    digest = F.when(F.col("n_a") > 0, F.sha2("alignment", 256)).otherwise("")
    return aligned.withColumn("groups_sha256", digest).drop("alignment")


def op13_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_runs.drop_common_lines(read(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_chat,
        op2_suffix_dedup,
        op3_toxicity,
        op4_simhash,
        op5_byte_cnn,
        op6_byte_bpe,
        op7_pii,
        op8_block_naming,
        op9_packing,
        op10_quality_rules,
        op11_divergence,
        op12_alignment,
        op13_line_runs,
    )
}

