"""The registered queries of the operators: thin wrappers with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import chat, html_extract, infill, licenses, lines, minhash, mixing, neighbours, phrases, pieces, quality, repair, suffixes
from tessera.llm._spark import table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), k=20)


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_groups(table(spark, sf_dir, "documents"))


def op5_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.dedup_digest(table(spark, sf_dir, "documents"))


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_digest(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.document_licenses(table(spark, sf_dir, "documents"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.digest(repair.damage(conversations), conversations)


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.with_adversarial(table(spark, sf_dir, "conversations")))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_fuzzy_lines": op4_fuzzy_lines,
    "op5_repeated_phrases": op5_repeated_phrases,
    "op6_sentence_pieces": op6_sentence_pieces,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_quality_rules": op9_quality_rules,
    "op10_license_scans": op10_license_scans,
    "op11_structure_repair": op11_structure_repair,
    "op12_chat_format": op12_chat_format,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLE_SQL: dict[str, str] = {
    "op2_source_mixing": mixing.ORACLE_SQL,
    "op10_license_scans": licenses.oracle_sql(),
    "op11_structure_repair": repair.ORACLE_SQL,
    "op12_chat_format": chat.ORACLE_SQL,
    "op13_fill_in_middle": infill.ORACLE_SQL,
}
