"""The registered queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsefold.llm import (
    bpe, conversations, decontaminate, hosts, language, lempel, neighbours, secrets, simple8b, superminhash, templates, toxicity, whitening,
)
from pulsefold.llm.tables import read


def vocabulary_path() -> str:
    """The public byte-level vocabulary; the operators take any other path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op1_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.main_text(read(spark, sf_dir, "pages"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.group(read(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(read(spark, sf_dir, "documents"), vocabulary_path())


def op8_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lempel.deduplicate(read(spark, sf_dir, "documents"))


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge(read(spark, sf_dir, "documents")).drop("host_kept")


def op10_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = simple8b.write(read(spark, sf_dir, "documents"), vocabulary_path())
    return simple8b.read(spark, files)


def op11_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.group(read(spark, sf_dir, "embeddings"))


def op12_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_ternary_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.trie(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_template_text": op1_template_text,
    "op2_secrets": op2_secrets,
    "op3_decontaminate": op3_decontaminate,
    "op4_toxicity": op4_toxicity,
    "op5_superminhash": op5_superminhash,
    "op6_host_rules": op6_host_rules,
    "op7_bpe": op7_bpe,
    "op8_lempel_ziv": op8_lempel_ziv,
    "op9_language_id": op9_language_id,
    "op10_simple8b": op10_simple8b,
    "op11_flat_graph": op11_flat_graph,
    "op12_cholesky_whitening": op12_cholesky_whitening,
    "op13_ternary_trie": op13_ternary_trie,
}

ORACLE_SQL: dict[str, str] = {}
