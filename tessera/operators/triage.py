"""Attachment triage: cheap filter, filename score, peek, full extraction, choice of primary and supporting ones.

Rows are (ticket_key, pos, id, filename, size, created, ...); every stage adds columns. Bytes stay out of all windows:
what peeks and extractions found comes as columns, joined by (ticket_key, id), and may be missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.settings import DEFAULT, Settings

#: Extensions that are never read, and those that can be, with their bonus and base quality.
KILLED = ("png", "jpg", "jpeg", "gif", "svg", "bmp", "ico", "tiff", "webp", "mp3", "wav", "m4a", "flac", "zip", "rar", "7z", "tar", "gz", "exe", "dmg", "msi", "sh", "bat")
BONUS = {"pptx": 25, "ppt": 18, "pdf": 15, "docx": 12, "doc": 8, "xlsx": 5, "xls": 3, "csv": 0}
BASE_QUALITY = {"pptx": 0.90, "ppt": 0.85, "pdf": 0.78, "docx": 0.85, "doc": 0.72, "xlsx": 0.45, "xls": 0.35, "csv": 0.40}
DOCUMENTS = ("pptx", "ppt", "pdf", "docx", "doc")
#: Whole words of a filename and what they count; "_" is a letter to them.
NAME_POINTS = (
    (r"\b(idea|initiative|proposal|pitch|concept)\b", 45),
    (r"\b(card|deck|slides?)\b", 25),
    (r"\b(business[\s_-]?case|value[\s_-]?stream)\b", 20),
    (r"\b(final|latest|v\d+)\b", 10),
    (r"\b(roadmap|strategy|opportunity|proposal)\b", 12),
    (r"\b(template|sample|placeholder|draft\s*template)\b", -40),
    (r"\b(logo|icon|banner|screenshot|screen\s*shot)\b", -35),
    (r"\b(backup|old|archive|duplicate|copy)\b", -20),
    (r"\b(budget|finance|costing|invoice)\b", -10),
)

#: What peeks and extractions may add; missing columns count as null.
FOUND = {
    "is_reporter_upload": "boolean", "peek_idea": "boolean", "peek_template": "boolean", "slide_count": "int", "peek_words": "int",
    "extracted": "boolean", "word_count": "int", "signals": "int", "density": "double", "template_hits": "int", "content_chunks": "int",
}


def _with_found(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.lit(None).cast(t) for c, t in FOUND.items() if c not in rows.columns})


def _lookup(values: dict, key: Column, otherwise: float) -> Column:
    out = F.when(F.lit(False), F.lit(otherwise))
    for k, v in values.items():
        out = out.when(key == k, F.lit(v))
    return out.otherwise(F.lit(otherwise))


def attachment_id(rows: DataFrame) -> Column:
    names = [c for c in ("id", "attachment_id", "filename") if c in rows.columns]
    return F.coalesce(*[tx.non_empty(F.col(c).cast("string")) for c in names], F.lit(""))


def excluded_reason(settings: Settings = DEFAULT) -> Column:
    """Why an attachment isn't read, or null; a size of 0 isn't too small."""
    ext, size = F.col("ext"), F.coalesce(F.col("size"), F.lit(0))
    return (
        F.when(ext.isin(*KILLED), F.concat(F.lit("excluded extension: "), ext))
        .when(~ext.isin(*BONUS), F.concat(F.lit("non-extractable extension: "), F.coalesce(tx.non_empty(ext), F.lit("unknown"))))
        .when((size > 0) & (size < settings.min_bytes), "file too small")
        .when((ext == "pdf") & (size > settings.max_pdf_bytes), "pdf too large")
        .when(size > settings.max_bytes, "file too large")
    )


def prefilter(attachments: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """ext, stem, attachment_id and excluded_reason of each attachment."""
    rows = attachments.withColumns({"ext": tx.extension(F.col("filename")), "stem": tx.stem(F.col("filename"))})
    return rows.withColumns({"attachment_id": attachment_id(rows), "excluded_reason": excluded_reason(settings)})


def filename_score(survivors: DataFrame, summary: str = "summary") -> DataFrame:
    """score_l1 and its reasons. Recency and repeated stems are windows over the record; ties go by pos."""
    name = F.lower(F.coalesce("filename", F.lit("")))
    words = tx.simple_words(name)
    newest = F.row_number().over(Window.partitionBy("ticket_key").orderBy(F.desc(F.coalesce("created", F.lit(""))), "pos")) == 1
    repeated = F.count("*").over(Window.partitionBy("ticket_key", "stem")) > 1
    asked = F.filter(tx.simple_words(F.col(summary)), lambda w: F.length(w) >= 3) if summary in survivors.columns else F.array().cast("array<string>")
    overlap = F.array_sort(F.array_intersect(F.array_distinct(asked), words))
    shared = F.when(F.size(overlap) >= 2, F.least(F.lit(20), 5 * F.size(overlap))).otherwise(0)
    rows = _with_found(survivors).withColumns({"_newest": newest, "_repeated": repeated, "_overlap": overlap, "_shared": shared})
    bonus = _lookup(BONUS, F.col("ext"), 0).cast("int")
    said: list[tuple[Column, Column, Column]] = []
    for pattern, points in NAME_POINTS:
        said.append((name.rlike(pattern), F.lit(points), F.lit(f"{points:+d} filename:{pattern[:28]}")))
    said += [
        (bonus > 0, bonus, F.concat(F.lit("+"), bonus.cast("string"), F.lit(" ext:"), F.col("ext"))),
        (F.col("_shared") > 0, F.col("_shared"), F.concat(F.lit("+"), F.col("_shared").cast("string"), F.lit(" summary-overlap:"), F.array_join(F.slice("_overlap", 1, 4), ", "))),
        (F.col("is_reporter_upload"), F.lit(8), F.lit("+8 reporter-upload")),
        (F.col("_newest"), F.lit(5), F.lit("+5 most-recent")),
        (F.col("_repeated"), F.lit(-10), F.lit("-10 duplicate-stem")),
        (F.size(words).between(2, 6), F.lit(8), F.lit("+8 descriptive-filename")),
    ]
    score = F.lit(0)
    for when, points, _ in said:
        score = score + F.when(when, points).otherwise(0)
    reasons = F.filter(F.array(*[F.when(when, reason) for when, _, reason in said]), lambda r: r.isNotNull())
    return rows.withColumns({"score_l1": score, "reasons": reasons}).drop("_newest", "_repeated", "_overlap", "_shared")


def peek_score() -> Column:
    points = F.when(F.col("peek_idea"), 20).otherwise(0) + F.when(F.col("peek_template"), -30).otherwise(0)
    return points + F.when(F.col("slide_count") >= 5, 8).otherwise(0) + F.when(F.col("peek_words") >= 80, 8).otherwise(0)


def confirmed(settings: Settings = DEFAULT) -> Column:
    """Long enough, no template, two chunks with content, three business terms."""
    found = F.col("extracted") & (F.col("word_count") >= settings.idea_words) & (F.coalesce("template_hits", F.lit(0)) < 2) & (F.col("content_chunks") >= 2) & (F.col("signals") >= 3)
    return F.coalesce(found, F.lit(False))


def extract_score() -> Column:
    points = F.when(F.col("confirmed"), 25).otherwise(0) + F.when(F.col("signals") >= 4, 10).otherwise(0)
    return points + F.when(F.col("density") >= 0.18, 8).otherwise(0) + F.when(F.col("likely_template"), -25).otherwise(0)


def attachment_scores(rows: DataFrame, score: str = "score") -> DataFrame:
    """extraction_quality, semantic_density, idea_card_likeness and retrieval_readiness, each between 0 and 1."""
    rows = _with_found(rows)
    ext, points = F.col("ext"), F.col(score).cast("double")
    quality = _lookup(BASE_QUALITY, ext, 0.50)
    quality = F.when((ext == "pdf") & (F.col("size") >= 500_000), F.least(F.lit(0.86), quality + 0.06)).otherwise(quality)
    quality = F.when(F.col("extracted") & (F.col("word_count") >= 80), F.least(F.lit(0.95), quality + 0.05)).otherwise(quality)
    unit = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    own = unit(F.coalesce("density", F.lit(0.0)))
    guess = unit(points / 100.0)
    density = F.when(own != 0, own).when(F.col("peek_idea"), F.least(F.lit(1.0), guess + 0.15)).otherwise(guess)
    sure = F.coalesce(F.col("confirmed"), F.lit(False)) if "confirmed" in rows.columns else F.lit(False)
    likeness = F.when(sure, 0.92).when(F.col("peek_idea"), 0.70).when(points >= 40, 0.55).when(points >= 20, 0.35).otherwise(0.15)
    likeness = F.when(ext.isin("pptx", "ppt"), F.least(F.lit(1.0), likeness + 0.05)).otherwise(likeness)
    rows = rows.withColumns({"_q": quality, "_d": density, "_l": likeness})
    ready = F.round(0.30 * F.col("_q") + 0.30 * F.col("_d") + 0.40 * F.col("_l"), 4)
    out = {"extraction_quality": F.round("_q", 4), "semantic_density": F.round("_d", 4), "idea_card_likeness": F.round("_l", 4), "retrieval_readiness": ready}
    return rows.withColumns(out).drop("_q", "_d", "_l")


def ranked(rows: DataFrame, score: str, name: str) -> DataFrame:
    """The place of each attachment in its record: by score, confirmation, readiness and likeness, then pos."""
    keys = [F.desc(score), F.desc("confirmed"), F.desc("retrieval_readiness"), F.desc("idea_card_likeness"), F.asc("pos")]
    return rows.withColumn(name, F.row_number().over(Window.partitionBy("ticket_key").orderBy(*keys)))


def wants_full_extract(score: str = "score_l2", place: str = "place_l2") -> Column:
    return (F.col(place) == 1) | (F.col(score) >= 40) | F.coalesce(F.col("peek_idea"), F.lit(False)) | (F.col("ext").isin("pdf", "docx", "doc") & (F.col(score) >= 25))


def triage(attachments: DataFrame, summary: str = "summary", settings: Settings = DEFAULT) -> DataFrame:
    """All attachments with their scores, roles and places: one repartitioning by record serves all windows."""
    rows = prefilter(_with_found(attachments), settings).repartition("ticket_key")
    gone = rows.filter("excluded_reason IS NOT NULL").withColumn("doc_role", F.lit("excluded_noise"))
    live = filename_score(rows.filter("excluded_reason IS NULL"), summary)
    none = F.lit(False)
    # a peek is only looked at for the first few by filename, an extraction for those that then qualify
    live = ranked(attachment_scores(live.withColumn("confirmed", none), "score_l1"), "score_l1", "place_l1")
    peeked = F.col("place_l1") <= settings.peeks
    for c in ("peek_idea", "peek_template", "slide_count", "peek_words"):
        live = live.withColumn(c, F.when(peeked, F.col(c)))
    live = live.withColumn("score_l2", F.col("score_l1") + peek_score())
    live = ranked(attachment_scores(live, "score_l2"), "score_l2", "place_l2")
    chosen = F.row_number().over(Window.partitionBy("ticket_key", F.col("_wanted")).orderBy("place_l2"))
    live = live.withColumn("_wanted", wants_full_extract())
    live = live.withColumn("full_extract", F.col("_wanted") & (chosen <= settings.full_extracts)).drop("_wanted")
    for c in ("extracted", "word_count", "signals", "density", "template_hits", "content_chunks"):
        live = live.withColumn(c, F.when(F.col("full_extract"), F.col(c)))
    live = live.withColumns({"confirmed": confirmed(settings), "likely_template": F.coalesce(F.col("template_hits") >= 2, none)})
    live = live.withColumn("score", F.col("score_l2") + F.when(F.coalesce(F.col("extracted"), none), extract_score()).otherwise(0))
    live = ranked(attachment_scores(live, "score"), "score", "place")
    live = choose(live, settings)
    extra = [c for c in live.columns if c not in gone.columns]
    return live.unionByName(gone.withColumns({c: F.lit(None).cast(live.schema[c].dataType) for c in extra}).select(live.columns))


def supporting_worthy(settings: Settings = DEFAULT) -> Column:
    by_words = (F.coalesce("word_count", F.lit(0)) >= settings.supporting_words) & (F.col("retrieval_readiness") >= 0.35)
    return ~F.col("likely_template") & (F.col("confirmed") | by_words | ((F.col("score") >= 35) & F.col("ext").isin(*DOCUMENTS)))


def choose(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """doc_role and excluded_reason: the primary attachment, up to four supporting ones of different stems, the rejected."""
    record = Window.partitionBy("ticket_key")
    rows = rows.withColumn("_worthy", supporting_worthy(settings))
    pool = F.when(F.col("confirmed"), 0).when(F.col("_worthy"), 1).otherwise(2)
    best = [pool, F.desc("idea_card_likeness"), F.desc("retrieval_readiness"), F.desc("score"), F.asc("place")]
    rows = rows.withColumn("_primary", F.row_number().over(record.orderBy(*best)) == 1)
    rows = rows.withColumn("_primary_id", F.max(F.when(F.col("_primary"), F.col("attachment_id"))).over(record))
    # a record may hold an id twice: only rows of another id can support
    rows = rows.withColumn("_may", F.col("_worthy") & (F.col("attachment_id") != F.col("_primary_id")))
    rows = rows.withColumn("_first", F.col("_may") & (F.row_number().over(Window.partitionBy("ticket_key", "stem", "_may").orderBy("place")) == 1))
    rows = rows.withColumn("_supports", F.col("_first") & (F.row_number().over(Window.partitionBy("ticket_key", "_first").orderBy("place")) <= settings.supporting))
    rejected = (F.col("score") <= 0) | F.col("likely_template")
    role = F.when(F.col("_primary"), F.when(F.col("confirmed"), "primary_idea_card").otherwise("primary_fallback")).when(F.col("_supports"), "supporting_doc").when(rejected, "excluded_noise")
    reason = F.when(~F.col("_primary") & ~F.col("_supports") & rejected, "low score or template-like")
    return rows.withColumns({"doc_role": role, "excluded_reason": reason}).drop("_worthy", "_primary", "_primary_id", "_may", "_first", "_supports")


def artifact(triaged: DataFrame) -> DataFrame:
    """One row for each record: choice, quality, tier, reason and processing plan. The tier is A or C."""
    by_place = lambda when, value: F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("place", value.alias("x"))))), lambda s: s["x"])
    role = F.col("doc_role")
    summary = public_summary()
    first = F.max_by(F.struct(*triaged.columns), F.when(role.startswith("primary"), 1)).alias("_p")
    kept = role.startswith("primary") | (role == "supporting_doc")
    light = ~F.coalesce(kept & F.col("extracted"), F.lit(False)) & F.coalesce(role != "excluded_noise", F.lit(True)) & (F.col("score") > 10)
    got = triaged.groupBy("ticket_key").agg(
        first, by_place(role == "supporting_doc", summary).alias("supporting_attachments"), by_place(role == "excluded_noise", summary).alias("excluded_attachments"),
        by_place(kept & F.col("extracted"), F.col("attachment_id")).alias("full_extract"), by_place(light, F.col("attachment_id")).alias("light_extract"),
        by_place(role == "excluded_noise", F.col("attachment_id")).alias("skip"), by_place(kept, F.col("attachment_id")).alias("chunk_candidates"),
        by_place(F.col("place").isNotNull(), summary).alias("per_attachment_scores"), F.count("*").alias("attachment_count_total"), F.count_if(kept).alias("attachment_count_viable"),
    )
    p = lambda c: F.col(f"_p.{c}")
    supporters = F.size("supporting_attachments")
    has = p("doc_role").startswith("primary")
    good = p("confirmed") & (p("retrieval_readiness") >= 0.65) & (p("extraction_quality") >= 0.75)
    quality = F.when(~F.coalesce(has, F.lit(False)), "none").when(good, "good").when((p("retrieval_readiness") >= 0.45) | (supporters > 0), "fallback").otherwise("none")
    top = F.coalesce(tx.non_empty(F.array_join(F.slice(p("reasons"), 1, 3), ", ")), F.lit("filename/meta heuristics"))
    name = F.coalesce(p("filename"), F.lit("attachment"))
    tail = F.concat(top, F.lit(". Additional supporting docs kept for chunking: "), supporters.cast("string"), F.lit("."))
    reason = (
        F.when(~F.coalesce(has, F.lit(False)), "No viable extractable attachments found after filtering.")
        .when(p("confirmed"), F.concat(name, F.lit(" selected as primary because it was confirmed as the best idea-card-like document. Signals: "), tail))
        .otherwise(F.concat(name, F.lit(" selected as primary fallback based on ranking and extraction readiness. Signals: "), tail))
    )
    got = got.withColumn("att_quality", quality)
    return got.withColumns({
        "triage_tier": F.when((F.col("att_quality") == "good") & p("confirmed"), "A").otherwise("C"), "selection_reason": reason,
        "primary_attachment_id": F.when(has, p("attachment_id")), "triage_score": F.when(has, p("score")), "triage_reasons": F.when(has, p("reasons")),
        "primary_attachment": F.when(has, F.struct(*[p(c).alias(c) for c in PUBLIC])),
    }).drop("_p")


#: What of an attachment may be shown: no bytes, no texts.
PUBLIC = ("attachment_id", "filename", "ext", "size", "doc_role", "score", "reasons", "confirmed", "excluded_reason", "word_count", "signals", "extraction_quality", "semantic_density", "idea_card_likeness", "retrieval_readiness")


def public_summary() -> Column:
    return F.struct(*PUBLIC)
