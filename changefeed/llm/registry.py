"""Queries of the package by name, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.llm import (
    alignment,
    decontamination,
    hierarchical,
    jaccard_join,
    language_id,
    language_model,
    manifest,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    toxicity,
)
from changefeed.llm.oracles import ORACLES
from changefeed.llm.sampling import crc_mod

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = crc_mod("doc_id", 3) != 1
    model = toxicity.train(docs.where(learn), table(spark, sf_dir, "labels").where(learn))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        (crc_mod("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs, where=crc_mod("doc_id", 3) != 1)
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "language.lang_pred", "language.score")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality_rules.judge(docs, quality_rules.train(docs))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share")
    return found.select("doc_id", *[f"quality.{n}" for n in names])


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.extract(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [pii.count(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.digest(F.col("base")), 256).alias("base_sha256"),
        pii.digest(pii.all_spans(F.col("base"), F.col("more"))).alias("spans"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.judged(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "overlap.n_words",
        "overlap.n_hit",
        F.size("overlap.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("overlap.items", ","), 256).alias("items_sha256"),
        "overlap.contaminated",
    )


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = language_model.score(docs, learn=crc_mod("doc_id", 7) != 2)
    names = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return scored.select("doc_id", (crc_mod("doc_id", 7) == 2).alias("held_out"), *names)


def op9_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = crc_mod("doc_id", 4) != 2
    ranking = quality_classifier.train(docs.where(learn), table(spark, sf_dir, "labels").where(learn))
    scored = quality_classifier.score(docs, ranking)
    return scored.select(
        "doc_id",
        (crc_mod("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.groups(table(spark, sf_dir, "documents"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(crc_mod("doc_id", 5) == 0, manifest.leaf(text=lowered))
    proved = manifest.proofs(manifest.build(docs, tampered=tampered))
    fold = manifest.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    checked = proved.select("doc_id", "leaf", "subroot", "root", manifest.siblings(F.col("path")).alias("proof_sha256"), fold.alias("folded_root"))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = alignment.aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hierarchical.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that the line model's verdict adds to, as SQL has them too."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return op4_quality_rules(spark, sf_dir).select("doc_id", *names)


def token_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the language model's score stands beside: counts, and the score by single tokens to four digits."""
    found = op8_language_model(spark, sf_dir)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_language": op2_language,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op6_pii": op6_pii,
    "op7_decontamination": op7_decontamination,
    "op8_language_model": op8_language_model,
    "op9_quality_ranking": op9_quality_ranking,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_manifest": op11_manifest,
    "op12_alignment": op12_alignment,
    "op13_hierarchical_packing": op13_hierarchical_packing,
    "quality_counts": quality_counts,
    "token_scores": token_scores,
}
