"""The stages from records to documents, as one graph of DataFrames; actions happen only where results are stored.

Rules marked "ours" fill gaps that no source defines: which labels count as gold, what retrieval text holds, how
paragraphs are routed to views.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import chunking, entities, records, reports, stores, summaries, triage, vectors
from tessera.settings import DEFAULT, Settings

SCHEMA_VERSION = "3.0"
#: Ours: words that route a paragraph to a view.
VIEWS = {"problem_view": r"problem|issue|pain|challenge|risk|gap", "solution_view": r"solution|approach|propos|implement|design", "value_view": r"value|benefit|saving|revenue|impact|outcome"}


@dataclass
class Stages:
    """Every stage's table, all keyed by ticket_key; labels are in ``supervision`` alone."""

    valid: DataFrame
    dead_letters: DataFrame
    metadata: DataFrame
    links: DataFrame
    comments: DataFrame
    attachments: DataFrame
    artifacts: DataFrame
    chunks: DataFrame
    mentions: DataFrame
    documents: DataFrame
    supervision: DataFrame


def _view(pattern: str) -> Column:
    paragraphs = F.filter(F.split("cleaned", r"\n{2,}"), lambda p: F.lower(p).rlike(pattern))
    return F.array_join(paragraphs, "\n\n")


def assemble(incoming: DataFrame, dictionary: DataFrame, attachment_chunks: DataFrame | None = None, embedder: Callable[[], vectors.Embedder] | None = None, settings: Settings = DEFAULT, ingested_at: Column | None = None, keep: Callable[[str, DataFrame], DataFrame] = lambda _, rows: rows, done: Callable[[str], None] = lambda _: None) -> Stages:
    """All stages of records (key, fields, attachments).

    ``keep`` may store a stage by its name and give the stored one back: later stages then have short plans, which are analysed
    and run once. Without it all stages are one plan, which takes longer to plan than a small batch takes to run.
    ``done`` is told the name of a stage that no later one reads: who doesn't need its table may delete it.

    ``attachment_chunks`` holds the chunks of attachments (ticket_key, attachment_id, ext, pos, chunk_id, text, ...), as
    extraction gave them; without them, triage ranks by name alone.
    """
    checked = records.validate(incoming)
    valid = keep("valid", checked.filter("validation_error IS NULL").drop("validation_error"))
    bad = checked.filter("validation_error IS NOT NULL")
    dead = records.to_dead_letters(bad, "validation", "SchemaError", F.col("validation_error"))
    meta = keep("metadata", records.metadata(valid, settings))
    classified = keep("links", records.links(valid))
    remarks = keep("comments", records.comments(valid, settings))

    files = valid.select(F.col("key").alias("ticket_key"), F.posexplode("attachments").alias("pos", "a")).select("ticket_key", "pos", "a.*")
    files = files.join(meta.select("ticket_key", "summary"), "ticket_key", "left")
    if attachment_chunks is not None:
        from tessera.operators.extract import extract_features

        features = extract_features(attachment_chunks, ["ticket_key", "attachment_id"])
        files = files.withColumn("attachment_id", triage.attachment_id(files)).join(features, ["ticket_key", "attachment_id"], "left")
    ranked = keep("triage", triage.triage(files, settings=settings))
    done("valid")
    artifacts = triage.artifact(ranked)

    described = meta.withColumn("cleaned", tx.strip_markup(F.col("description"))).withColumn("desc_words", tx.word_count(F.col("cleaned")))
    described = described.withColumn("desc_class", tx.description_class(F.col("cleaned"), F.col("desc_words"), settings)).drop("desc_words")
    described = described.join(artifacts.select("ticket_key", "att_quality", "triage_tier", "primary_attachment", "primary_attachment_id", "triage_score"), "ticket_key", "left")
    described = keep("described", described.withColumn("has_attachment", F.col("primary_attachment_id").isNotNull()))
    done("metadata")
    own = chunking.description_chunks(described.select("ticket_key", "summary", F.col("cleaned").alias("text"), "desc_class", "has_attachment", chunking.scaffold().alias("scaffold")), settings=settings)
    own = own.withColumn("attachment_id", F.lit(None).cast("string"))
    parts = own
    if attachment_chunks is not None:
        roles = ranked.select("ticket_key", "attachment_id", "doc_role")
        kept = attachment_chunks.join(roles.filter("doc_role LIKE 'primary%' OR doc_role = 'supporting_doc'"), ["ticket_key", "attachment_id"])
        first = kept.filter("doc_role LIKE 'primary%'").drop("doc_role")
        groups = chunking.sections(first, ["ticket_key", "attachment_id"], settings).withColumn("pos", F.col("section") + F.lit(1_000_000)).drop("section", "slide_range")
        more = chunking.supplementary(kept.filter("doc_role = 'supporting_doc'").drop("doc_role"), ["ticket_key", "attachment_id"], settings=settings).withColumn("pos", F.lit(2_000_000)).drop("ext")
        parts = own
        for other in (first, groups, more):
            parts = parts.unionByName(other, allowMissingColumns=True)
    chunks = keep("parts", chunking.chunk_uid(parts))

    terms = entities.dictionary(dictionary)
    key = ["ticket_key"]
    texts = chunks.select("ticket_key", F.struct(F.lit(2).alias("stage"), F.col("chunk_uid").alias("at")).alias("order"), "text", "source", "chunk_id")
    plain = described.select("ticket_key", F.explode(F.array(F.struct(F.lit("0").alias("at"), F.col("summary").alias("t")), F.struct(F.lit("1").alias("at"), F.col("metadata_text").alias("t")))).alias("x"))
    texts = texts.unionByName(plain.select("ticket_key", F.struct(F.lit(3).alias("stage"), F.col("x.at").alias("at")).alias("order"), F.col("x.t").alias("text"), F.lit("metadata").alias("source"), F.lit("metadata").alias("chunk_id")))
    found = entities.text_mentions(texts, terms, key, ["order", "source", "chunk_id"])
    components = described.select("ticket_key", F.posexplode("components").alias("pos", "component"))
    place = lambda stage: F.struct(F.lit(stage).alias("stage"), F.lpad(F.col("pos").cast("string"), 9, "0").alias("at")).alias("order")
    names = ["ticket_key", "order", "source", "chunk_id", "etype", "term", "confidence"]
    direct = entities.component_mentions(components, terms, key).withColumn("order", place(0)).select(*names)
    linked = entities.link_mentions(classified, key).withColumn("order", place(1)).select(*names)
    mentions = keep("mentions", entities.best_mentions(direct.unionByName(linked).unionByName(found.select(*names)), key, ["order", "etype", "term"]))

    stats = reports.record_stats(chunks, mentions, remarks)
    document = described.join(stats, "ticket_key", "left").fillna(0, [c for c, t in stats.dtypes if t in ("bigint", "int")])
    document = document.withColumn("quality_tier", summaries.quality_tier(F.col("has_attachment"), F.col("desc_class"), F.col("chunk_count")))
    document = summaries.plain_summary(document, chunks)
    evidence = F.when(F.col("has_attachment"), F.col("primary_attachment.ext")).when(~F.col("desc_class").isin("empty", "junk"), "description").otherwise("none")
    primary = chunks.filter("attachment_id IS NOT NULL").groupBy("ticket_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda c: c["text"]), "\n").alias("attachment_text"))
    document = document.join(primary, "ticket_key", "left")
    terms_of = mentions.groupBy("ticket_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("etype", "first_seen", "term"))), lambda m: m["term"]).alias("entity_terms"))
    document = keep("joined", document.join(terms_of, "ticket_key", "left"))
    document = document.withColumns({
        "schema_version": F.lit(SCHEMA_VERSION), "ingested_at": (F.current_timestamp() if ingested_at is None else ingested_at).cast("string"),
        "content_source": F.when(F.col("has_attachment"), "attachment").when(~F.col("desc_class").isin("empty", "junk"), "description").otherwise("metadata"),
        "source_quality_score": summaries.tier_weight(F.col("quality_tier")), "primary_evidence_type": F.coalesce(evidence, F.lit("none")),
        "has_primary_attachment": F.col("has_attachment"), "has_description": ~F.col("desc_class").isin("empty", "junk"),
        "retrieval_text": F.concat_ws("\n\n", tx.non_empty(F.col("title")), tx.non_empty(F.col("cleaned")), tx.non_empty(F.col("attachment_text")), tx.non_empty(F.col("metadata_text"))),
        "overview_view": F.concat_ws("\n\n", "summary_text", "metadata_text"), "attachment_view": F.substring(F.coalesce("attachment_text", F.lit("")), 1, 3000),
        **{name: _view(pattern) for name, pattern in VIEWS.items()},
    })
    streams = classified.filter("category = 'vs'").groupBy("ticket_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "key", "summary", "status"))), lambda x: F.struct(x["key"].alias("key"), x["summary"].alias("summary"), x["status"].alias("status"))).alias("_vs"))
    document = document.join(streams, "ticket_key", "left")
    both = F.array_distinct(F.concat("themes", F.coalesce("_vs", F.array().cast("array<struct<key:string,summary:string,status:string>>"))))
    document = document.withColumn("_both", both)
    member = lambda n: F.transform("_both", lambda x: x[n])
    labelled = document.withColumns({
        "linked_value_stream_ids": member("key"), "linked_value_stream_names": member("summary"), "linked_value_stream_statuses": member("status"), "vs_labels": member("summary"),
        "vs_label_source": F.when(F.size("themes") > 0, "themes").when(F.size("_both") > 0, "issuelinks").otherwise(""),
    })
    supervision = stores.supervision_rows(labelled)
    document = document.drop("_vs", "_both", "themes", *stores.LABELS)
    if embedder is not None:
        chunks = vectors.embed(chunks, "text", embedder, settings)
        document = vectors.embed(document, "summary_text", embedder, settings, "summary_embedding")
    else:
        chunks, document = chunks.withColumn("embedding", F.lit(None).cast("array<float>")), document.withColumn("summary_embedding", F.lit(None).cast("array<float>"))
    chunks = chunks.join(document.select("ticket_key", "quality_tier"), "ticket_key", "left")
    return Stages(valid, dead, meta, classified, remarks, ranked, artifacts, chunks, mentions, document, supervision)


#: What decides which of several rows of an id is the latest, for each table.
ORDERS = {"coarse": ["updated_at", "text"], "fine": ["text"], "metadata": ["metadata_text"], "supervision": ["vs_label_source"]}


def index_rows(stages: Stages) -> dict[str, DataFrame]:
    """The document, chunk and metadata rows, and the labels, each for its own table."""
    return {"coarse": stores.coarse_rows(stages.documents), "fine": stores.fine_rows(stages.chunks), "metadata": stores.metadata_rows(stages.documents), "supervision": stages.supervision}


def index(stages: Stages, tables: stores.Tables) -> None:
    """Upserts the rows of each table."""
    for name, rows in index_rows(stages).items():
        getattr(tables, name).upsert(rows, ORDERS[name])


def content_type(source: Column) -> Column:
    return F.when(source.isin("section", "docx_section"), "section").when(source.isin("pdf_page", "pptx_slide"), "page").when(source.startswith("supplementary_"), "supplementary").otherwise(F.coalesce(tx.non_empty(source), F.lit("unknown")))


def reference_category(source: Column) -> Column:
    return F.when(source.startswith("supplementary_"), "supplementary").when(source.isin("pdf_page", "pptx_slide", "docx_section", "section"), "primary").otherwise("ticket")


def chunk_records(chunks: DataFrame, documents: DataFrame, base_url: str = "") -> DataFrame:
    """Chunks as flat records for a search service, with their provenance."""
    rows = chunks.drop("quality_tier").join(documents.select("ticket_key", "title", "issue_type", "status", "priority", "reporter", "created", "updated_at"), "ticket_key")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("")
    number = lambda c: F.when(F.col(c).isNotNull(), F.array(c, c)) if c in rows.columns else F.lit(None).cast("array<int>")
    source = F.col("source")
    ref = F.struct(text("attachment_id").alias("attachmentId"), text("attachment_name").alias("attachmentName"), text("attachment_type").alias("attachmentType"), reference_category(source).alias("category"))
    refs = F.filter(F.array(ref), lambda r: (r["attachmentId"] != "") | (r["attachmentName"] != ""))
    pages, slides = F.when(source == "pdf_page", number("page_num")), F.when(source == "pptx_slide", number("slide_num"))
    provenance = F.struct(text("chunk_id").alias("chunkId"), text("source").alias("sourceType"), text("attachment_id").alias("attachmentId"), text("attachment_name").alias("attachmentName"), pages.alias("pageRange"), slides.alias("slideRange"), text("extraction_method").alias("extractionMethod"), F.col("extraction_confidence").alias("extractionConfidence"))
    url = F.concat(F.lit(base_url.rstrip("/") + "/browse/"), "ticket_key") if base_url else F.col("ticket_key")
    return rows.select(
        F.col("chunk_uid").alias("id"), F.col("text").alias("content"), F.col("embedding").alias("content_vector"), F.lit("tracker").alias("dataSource"), F.col("ticket_key").alias("sourceId"), url.alias("sourceURL"),
        F.coalesce(tx.non_empty(F.col("title")), "ticket_key").alias("title"), content_type(source).alias("contentType"), text("section_title").alias("headerHierarchy"), F.coalesce("word_count", tx.word_count(F.col("text"))).alias("tokenCount"),
        F.when(F.contains("ticket_key", F.lit("-")), F.substring_index("ticket_key", "-", 1)).otherwise("").alias("project"), F.col("issue_type").alias("issueType"), "status", "priority", "reporter",
        F.col("created").alias("createdDate"), F.col("updated_at").alias("updatedDate"), refs.alias("attachmentReferences"), provenance.alias("chunkProvenance"),
    )


def value_stream_records(documents: DataFrame, supervision: DataFrame) -> DataFrame:
    """Labels as flat records."""
    none = F.array().cast("array<string>")
    rows = documents.select("ticket_key", "title", "updated_at").join(supervision.withColumnRenamed("id", "ticket_key"), "ticket_key")
    listed = lambda c, n: F.coalesce(F.col(c), none).alias(n)
    return rows.select(
        F.col("ticket_key").alias("id"), F.when(F.contains("ticket_key", F.lit("-")), F.substring_index("ticket_key", "-", 1)).otherwise("").alias("project"), F.coalesce(tx.non_empty(F.col("title")), "ticket_key").alias("title"),
        listed("linked_value_stream_ids", "valueStreamIds"), listed("linked_value_stream_names", "valueStreamNames"), listed("linked_value_stream_statuses", "valueStreamStatuses"),
        listed("impacted_products.ids", "impactedProductIds"), listed("impacted_products.names", "impactedProductNames"), listed("impacted_it_products.ids", "impactedItProductIds"), listed("impacted_it_products.names", "impactedItProductNames"),
        F.coalesce("vs_label_source", F.lit("")).alias("labelSource"), F.col("updated_at").alias("updatedDate"),
    )
