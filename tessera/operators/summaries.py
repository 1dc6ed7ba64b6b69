"""Quality tiers, longest chunks, summaries and derived fields; language models are injected and optional."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as tx

#: Weight of each quality tier.
TIER_WEIGHTS = {"A": 1.0, "B": 0.85, "C": 0.60, "D": 0.30}
DERIVED_TEXTS = ("ticket_summary_llm", "problem_summary_llm", "solution_summary_llm")
DERIVED_LISTS = ("capability_keywords_llm", "workflow_terms_llm", "business_entities_llm", "product_mentions_llm")


class Completer(Protocol):
    """A language model: text in, text out. Made once for each partition by a factory."""

    def __call__(self, prompt: str, max_tokens: int, temperature: float) -> str: ...


def quality_tier(has_attachment: Column, description_class: Column, chunk_count: Column) -> Column:
    """A or B with an attachment, by the description; C with a description and a chunk; D."""
    return (
        F.when(has_attachment & description_class.isin("usable", "rich"), "A")
        .when(has_attachment, "B")
        .when(description_class.isin("thin", "usable", "rich") & (chunk_count > 0), "C")
        .otherwise("D")
    )


def tier_weight(tier: Column) -> Column:
    return F.coalesce(*[F.when(tier == t, F.lit(w)) for t, w in TIER_WEIGHTS.items()], F.lit(0.0))


def longest_chunks(chunks: DataFrame, key: list[str], most: int = 1) -> DataFrame:
    """The chunks of the most words that aren't boilerplate, with their rank; ties go to the first."""
    words = F.coalesce("word_count", tx.word_count(F.col("text"))) if "word_count" in chunks.columns else tx.word_count(F.col("text"))
    rows = chunks.filter(~F.coalesce("is_boilerplate", F.lit(False))) if "is_boilerplate" in chunks.columns else chunks
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(words), "pos"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= most)


def plain_summary(records: DataFrame, chunks: DataFrame, key: str = "ticket_key") -> DataFrame:
    """summary_text: the first 800 characters of the longest chunk of thirty words, or the metadata text, or the summary."""
    # the beginnings of texts are ranked, so that whole ones aren't shuffled
    told = chunks.withColumns({"_best": F.substring("text", 1, 800), "_long": tx.word_count(F.col("text")) >= 30})
    best = longest_chunks(told, [key]).filter("_long").select(key, "_best")
    return records.join(best, key, "left").withColumn("summary_text", F.coalesce("_best", "metadata_text", "summary")).drop("_best")


def _prompts(chunks: DataFrame, key: str, most: int) -> DataFrame:
    top = longest_chunks(chunks, [key], most)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda c: c["text"])
    return top.groupBy(key).agg(F.array_join(texts, "\n---\n").alias("input"), F.max_by("text", -F.col("rank")).alias("longest"), F.count("*").alias("n"))


def model_summary(records: DataFrame, chunks: DataFrame, factory: Callable[[], Completer], instruction: str, key: str = "ticket_key") -> DataFrame:
    """summary_text by a language model for records of tier A or B with three chunks; the plain summary for the rest.

    A failed call falls back to the longest chunk; it doesn't fail the task.
    """
    counts = chunks.groupBy(key).agg(F.count("*").alias("_chunks"))
    plain = plain_summary(records, chunks, key).join(counts, key, "left")
    asked = plain.filter(F.col("quality_tier").isin("A", "B") & (F.col("_chunks") >= 3)).join(_prompts(chunks, key, 8), key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        complete = factory()
        for batch in batches:
            out = []
            for text, longest in zip(batch.column("input").to_pylist(), batch.column("longest").to_pylist(), strict=True):
                try:
                    out.append(complete(f"{instruction}\n\n{text}", 700, 0.3).strip())
                except Exception:  # a model may fail in any way; the row keeps its plain summary
                    out.append(longest[:800])
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(out, pa.string())], [key, "_model"])

    said = asked.select(key, "input", "longest").mapInArrow(run, f"{key} string, _model string")
    return plain.join(said, key, "left").withColumn("summary_text", F.coalesce("_model", "summary_text")).drop("_model", "_chunks")


def parse_derived(raw: str) -> dict:
    """The seven derived fields from a model's answer, with or without a code fence; ValueError if it isn't JSON."""
    text = raw.strip()
    if text.startswith("```"):
        text = text.split("```")[1].removeprefix("json")
    got = json.loads(text)
    return {k: str(got.get(k, "")) for k in DERIVED_TEXTS} | {k: [str(x) for x in got.get(k) or []] for k in DERIVED_LISTS}


def derived(records: DataFrame, chunks: DataFrame, factory: Callable[[], Completer] | None, instruction: str, key: str = "ticket_key") -> DataFrame:
    """The seven derived fields of each record: empty without a model, for tier D, without chunks and for failed calls."""
    texts, lists = [F.lit("").alias(c) for c in DERIVED_TEXTS], [F.array().cast("array<string>").alias(c) for c in DERIVED_LISTS]
    if factory is None:
        return records.select(key, *texts, *lists)
    asked = records.filter("quality_tier != 'D'").join(_prompts(chunks, key, 10), key)
    context = F.when(F.coalesce("metadata_text", F.lit("")) != "", F.concat(F.lit("Ticket metadata: "), "metadata_text", F.lit("\n\n---\n\n"))).otherwise("")
    asked = asked.select(key, F.substring(F.concat(context, "input"), 1, 6000).alias("input"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        complete = factory()
        for batch in batches:
            rows = []
            for text in batch.column("input").to_pylist():
                try:
                    rows.append(parse_derived(complete(f"{instruction}\n\nContent:\n{text}", 800, 0.2)))
                except Exception:  # as above
                    rows.append({k: "" for k in DERIVED_TEXTS} | {k: [] for k in DERIVED_LISTS})
            columns = [pa.array([r[c] for r in rows], pa.string()) for c in DERIVED_TEXTS] + [pa.array([r[c] for r in rows], pa.list_(pa.string())) for c in DERIVED_LISTS]
            yield pa.RecordBatch.from_arrays([batch.column(key), *columns], [key, *DERIVED_TEXTS, *DERIVED_LISTS])

    schema = ", ".join([f"{key} string", *(f"{c} string" for c in DERIVED_TEXTS), *(f"{c} array<string>" for c in DERIVED_LISTS)])
    found = asked.mapInArrow(run, schema)
    filled = [F.coalesce(F.col(c), d).alias(c) for c, d in zip([*DERIVED_TEXTS, *DERIVED_LISTS], [*[F.lit("")] * 3, *[F.array().cast("array<string>")] * 4], strict=True)]
    return records.select(key).join(found, key, "left").select(key, *filled)
