"""The registered queries of this subpackage: each operator on its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import (
    alignment,
    chat,
    chat_sql,
    chunks,
    langid,
    manifest,
    manifest_sql,
    neardup,
    packing,
    pii,
    quality,
    quality_sql,
    templates,
    token_blocks,
    toxicity,
    windows,
)
from riskloom.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as token ids in packed matrix rows."""
    return token_blocks.token_rows(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.facts(docs, quality.ordered(quality.measured(docs, quality.RULES)))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that other documents hold, too."""
    return chunks.repeats(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items they contain."""
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = chat.parse(chat.format_events(chat.turn_events(turns)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join("trained", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length(trained).cast("bigint").alias("loss_chars"),
        F.sha2(trained.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def _held_out(parts: int, which: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == which, F.lit(False))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = _held_out(4, 2)
    model = langid.fit(langid.training_rows(docs, ~held, langid.PER_LANGUAGE, langid.MAX_ROWS))
    return langid.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(table(spark, sf_dir, "documents")))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the least id of its class of near copies."""
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = _held_out(3, 1)
    rows = toxicity.training_rows(docs, table(spark, sf_dir, "labels"), "toxic", ~held, toxicity.MAX_ROWS)
    return toxicity.score(docs, toxicity.fit(rows)).select("doc_id", held.alias("held_out"), "score", "predicted")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its place in the Merkle tree of the table, and whether a tampered copy is noticed."""
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    more = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0, F.lit(1)).otherwise(F.lit(0))
    tampered = manifest.leaf([F.col(f) + more if f == "n_chars" else F.col(f) for f in fields])
    made = manifest.manifest(docs, fields, "lang", "doc_id", extra={"tampered": tampered})
    hexed = {c: manifest.shown(F.col(c)) for c in ("leaf", "subroot", "root")}
    return made.select(
        "doc_id",
        *[value.alias(c) for c, value in hexed.items()],
        F.sha2(manifest.proof_text(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        manifest.shown(manifest.fold(F.col("tampered"), F.col("proof"))).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of a document with its place in the packed sequences."""
    return windows.pieces(windows.pack_documents(table(spark, sf_dir, "documents")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens for every document."""
    found = alignment.aligned(table(spark, sf_dir, "documents"))
    told = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return alignment.with_counts(found.withColumn("groups_sha256", told).drop("groups")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_rows,
        op2_quality,
        op3_repeats,
        op4_decontamination,
        op5_packing,
        op6_chat,
        op7_language,
        op8_personal_data,
        op9_near_duplicates,
        op10_toxicity,
        op11_manifest,
        op12_windows,
        op13_alignment,
    )
}
ORACLES: dict[str, str] = {
    "op2_quality": quality_sql.SQL,
    "op6_chat": chat_sql.SQL,
    "op11_manifest": manifest_sql.SQL,
}
