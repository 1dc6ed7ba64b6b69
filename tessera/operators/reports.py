"""Small reports over chunks, dead letters, stores and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as tx


def by_source(chunks: DataFrame, source: str = "source") -> DataFrame:
    return chunks.groupBy(F.coalesce(source, F.lit("unknown")).alias("source")).agg(F.count("*").alias("n")).orderBy("source")


def by_attachment(chunks: DataFrame, name: str = "attachment_name") -> DataFrame:
    """Chunks of each attachment, most first; those of none are <ticket_only>."""
    named = F.coalesce(tx.non_empty(F.col(name)), F.lit("<ticket_only>")).alias("attachment")
    return chunks.groupBy(named).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "attachment")


def attachment_refs(chunks: DataFrame, name: str = "attachment_name") -> DataFrame:
    return chunks.filter(F.coalesce(name, F.lit("")) != "").select(name).distinct().orderBy(name)


def dead_letter_summary(entries: DataFrame) -> DataFrame:
    """Counts by stage, by error type and in all, from one pass."""
    rows = entries.select(F.coalesce("stage", F.lit("unknown")).alias("stage"), F.coalesce("error_type", F.lit("unknown")).alias("error_type"))
    found = rows.groupingSets([["stage"], ["error_type"], []], "stage", "error_type").agg(F.count("*").alias("n"), F.grouping("stage").alias("_s"), F.grouping("error_type").alias("_e"))
    grouping = F.when(F.col("_s") == 0, "stage").when(F.col("_e") == 0, "error_type").otherwise("total")
    return found.select(grouping.alias("grouping"), F.coalesce(F.when(F.col("_s") == 0, F.col("stage")), F.when(F.col("_e") == 0, F.col("error_type")), F.lit("")).alias("name"), "n")


def batch_totals(results: DataFrame) -> DataFrame:
    """One row of totals over results (error, chunk_count, value_stream_ids, product_ids)."""
    some = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>"))) > 0
    good = F.col("error").isNull()
    return results.agg(
        F.coalesce(F.sum(F.when(good, F.col("chunk_count"))), F.lit(0)).alias("total_chunks"), F.count_if(good).alias("processed"), F.count_if(~good).alias("failed"),
        F.count_if(good & some("value_stream_ids")).alias("with_value_streams"), F.count_if(good & some("product_ids")).alias("with_products"),
    )


def embedding_coverage(chunks: DataFrame, vector: str = "embedding") -> DataFrame:
    return chunks.agg(F.count_if(F.size(F.coalesce(vector, F.array().cast("array<float>"))) > 0).alias("populated"), F.count("*").alias("total"))


def record_stats(chunks: DataFrame, mentions: DataFrame, comments: DataFrame, key: str = "ticket_key") -> DataFrame:
    """Per record: chunks, sections, words, tables, notes, mentions and comments."""
    flag = lambda c: F.coalesce(F.bool_or(F.col(c)), F.lit(False)) if c in chunks.columns else F.lit(False)
    section = F.col("source") == "section"
    by_chunk = chunks.groupBy(key).agg(
        F.count_if(~section).alias("chunk_count"), F.count_if(section).alias("section_count"), F.sum(F.when(~section, F.col("word_count")).otherwise(0)).alias("total_word_count"),
        flag("has_table").alias("has_tables"), flag("has_notes").alias("has_speaker_notes"),
    )
    by_mention = mentions.groupBy(key).agg(F.count("*").alias("entity_mention_count"), *[F.count_if(F.col("etype") == t).alias(f"entity_{n}_count") for t, n in (("products", "product"), ("capabilities", "capability"))])
    by_comment = comments.groupBy(key).agg(F.count("*").alias("comment_count"), F.count_if("is_substantive").alias("substantive_comment_count"))
    return by_chunk.join(by_mention, key, "full").join(by_comment, key, "full").fillna(0).fillna(False)


def store_summary(documents: DataFrame, key: str = "ticket_key") -> DataFrame:
    """(key, documents): one row a key, and one of a null key with the total."""
    return documents.rollup(key).agg(F.count("*").alias("documents"), F.grouping(key).alias("_all")).filter((F.col("_all") == 1) | F.col(key).isNotNull()).drop("_all")


def size_totals(attachments: DataFrame, links: DataFrame, key: str = "ticket_key") -> DataFrame:
    sizes = attachments.groupBy(key).agg(F.count("*").alias("attachments"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    return sizes.join(links.groupBy(key).agg(F.count("*").alias("links")), key, "full").fillna(0)


def text_volume(chunks: DataFrame, key: list[str]) -> DataFrame:
    """Of each document: its whole text, chunks with content, template phrases counted once for each chunk."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda c: c["text"])
    boring: Column = F.coalesce("is_boilerplate", F.lit(False)) if "is_boilerplate" in chunks.columns else F.lit(False)
    return chunks.groupBy(*key).agg(F.array_join(ordered, "\n").alias("text"), F.count_if(~boring).alias("content_chunks"), F.sum(tx.template_hits(F.col("text"))).alias("template_hits"), F.sum(tx.word_count(F.col("text"))).alias("words"))
