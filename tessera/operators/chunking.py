"""Chunks: slides, pages, heading sections, descriptions, grouped sections, supplementary texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import text as tx
from tessera.settings import DEFAULT, Settings
from tessera.sources import files


def _common(source: str, weight: Column | float, confidence: float, method: str) -> list[Column]:
    weight = weight if isinstance(weight, Column) else F.lit(weight)
    return [F.lit(source).alias("source"), weight.cast("double").alias("weight_multiplier"), F.lit(confidence).alias("extraction_confidence"), F.lit(method).alias("extraction_method")]


def chunk_uid(rows: DataFrame) -> DataFrame:
    """A key that is unique in a record, which chunk_id alone isn't: record / attachment / chunk."""
    attachment = F.coalesce("attachment_id", F.lit("")) if "attachment_id" in rows.columns else F.lit("")
    return rows.withColumn("chunk_uid", F.concat_ws("/", "ticket_key", tx.non_empty(attachment), "chunk_id"))


def slides(documents: DataFrame, text: str = "text", settings: Settings = DEFAULT) -> DataFrame:
    """Slides of converted presentations, split at their markers; text without markers is one slide.

    Slides from the first number above the limit on are left out, and so are empty ones.
    """
    keep = [c for c in documents.columns if c != text]
    marker = r"<!--\s*Slide number:\s*(\d+)\s*-->"
    numbers = F.transform(F.regexp_extract_all(text, F.lit(marker), F.lit(1)), lambda x: x.cast("int"))
    parts = F.slice(F.split(text, marker), 2, 2**30)
    pairs = F.arrays_zip(numbers.alias("number"), F.transform(parts, tx.trimmed).alias("body"))
    over = F.array_position(F.transform(numbers, lambda n: n > settings.max_slides), True)
    pairs = F.when(over > 0, F.slice(pairs, F.lit(1), F.greatest(F.lit(0), (over - 1).cast("int")))).otherwise(pairs)
    pairs = F.filter(pairs, lambda p: p["body"] != "")
    whole = F.array(F.struct(F.lit(1).alias("number"), tx.trimmed(F.col(text)).alias("body")))
    kind = "array<struct<number:int,body:string>>"
    found = F.when(F.size(pairs) > 0, pairs.cast(kind)).when(tx.trimmed(F.col(text)) != "", whole.cast(kind)).otherwise(F.array().cast(kind))
    rows = documents.select(*keep, F.posexplode(found).alias("pos", "s")).select(*keep, "pos", F.col("s.number").alias("slide_num"), F.col("s.body").alias("text"))
    rows = rows.withColumn("slide_title", F.coalesce(tx.slide_title(F.col("text")), F.lit("")))
    boring = tx.is_boilerplate_slide(F.col("slide_num"), F.col("slide_title"), F.col("text"))
    rows = rows.withColumns({
        "chunk_id": F.concat(F.lit("slide-"), F.col("slide_num").cast("string")), "word_count": tx.word_count(F.col("text")), "is_boilerplate": boring,
        "has_table": F.contains("text", F.lit("|")), "has_notes": F.contains("text", F.lit("Notes:")) | F.contains(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("Speaker Notes")),
    })
    return rows.select("*", *_common("pptx_slide", F.when(F.col("is_boilerplate"), 0.0).otherwise(1.0), 0.95, "markitdown"))


def packed(documents: DataFrame, text: str = "text", separator: str = r"\n{2,}", settings: Settings = DEFAULT) -> DataFrame:
    """Paragraphs packed greedily up to a number of words; small packs are dropped without using up a number."""
    keep = [c for c in documents.columns if c != text]
    paragraphs = F.filter(F.transform(F.split(text, separator), tx.trimmed), lambda p: p != "")
    sized = F.transform(paragraphs, lambda p: F.struct(p.alias("p"), tx.word_count(p).alias("n")))
    kind = "struct<done:array<struct<text:string,n:int>>,text:string,n:int>"
    start = F.struct(F.array().cast("array<struct<text:string,n:int>>").alias("done"), F.lit(None).cast("string").alias("text"), F.lit(0).alias("n")).cast(kind)
    pack = lambda s: F.concat(s["done"], F.array(F.struct(s["text"].alias("text"), s["n"].alias("n"))))

    def step(s: Column, p: Column) -> Column:
        full = s["text"].isNotNull() & (s["n"] + p["n"] > settings.page_words)
        fresh = F.struct(pack(s).alias("done"), p["p"].alias("text"), p["n"].alias("n"))
        longer = F.struct(s["done"].alias("done"), F.concat_ws("\n\n", s["text"], p["p"]).alias("text"), (s["n"] + p["n"]).alias("n"))
        return F.when(full, fresh).otherwise(longer).cast(kind)

    ended = lambda s: F.when(s["text"].isNotNull(), pack(s)).otherwise(s["done"])
    packs = F.filter(F.aggregate(sized, start, step, ended), lambda c: c["n"] >= settings.page_min_words)
    rows = documents.select(*keep, F.posexplode(packs).alias("pos", "c"))
    rows = rows.select(*keep, "pos", (F.col("pos") + 1).alias("page_num"), F.concat(F.lit("page-"), (F.col("pos") + 1).cast("string")).alias("chunk_id"), F.col("c.text").alias("text"), F.col("c.n").alias("word_count"), F.lit(False).alias("is_boilerplate"))
    return rows.withColumn("has_table", F.contains("text", F.lit("|"))).select("*", *_common("pdf_page", 1.0, 0.90, "markitdown"))


#: Paragraphs of a block when long documents are packed; no less than a page may hold.
PACK_BLOCK = 4096


def packed_long(documents: DataFrame, key: list[str], text: str = "text", separator: str = r"\n{2,}", settings: Settings = DEFAULT) -> DataFrame:
    """As :func:`packed`, for documents of any length: paragraphs are rows, and no task needs all of a document's.

    Where a page that begins at a paragraph ends depends on the next few paragraphs only: a jump. A block of paragraphs turns
    each of the places where a page may enter it into the place where the next block is entered; these tables, of as many
    numbers as a page has words, are composed by pointer doubling over a document's blocks. Then each block knows its
    entrance and marks its pages. Documents have a unique ``key`` without nulls; their other columns are left out.
    """
    size = max(settings.page_words, 1)
    block = max(PACK_BLOCK, size)
    paragraphs = F.filter(F.transform(F.split(text, separator), tx.trimmed), lambda p: p != "")
    rows = files.stored(documents.select(*key, F.posexplode(paragraphs).alias("at", "p")).withColumn("n", tx.word_count(F.col("p"))))
    own = F.expr(f"CAST(at DIV {block} AS INT)")
    # a block sees as many paragraphs of the next one as a page may reach into it
    seen = F.when((own > 0) & (F.col("at") % block <= size), F.array(own, own - 1)).otherwise(F.array(own))
    light = rows.select(*key, "at", "n", F.explode(seen).alias("block"))
    kinds = [rows.schema[c] for c in key]

    def jumps(table: pa.Table) -> tuple[np.ndarray, np.ndarray, int, int]:
        """Places, where a page that begins at each ends, the block's first place and how many are its own."""
        table = table.sort_by("at")
        place, words = table.column("at").to_numpy(), table.column("n").to_numpy().astype(np.int64)
        first = table.column("block")[0].as_py() * block
        ends = np.cumsum(words)
        nexts = np.searchsorted(ends, ends - words + size, side="right")
        return place, np.maximum(nexts, np.arange(len(place)) + 1), first, int((place < first + block).sum())

    def exits(table: pa.Table) -> pa.Table:
        _, nexts, _, mine = jumps(table)
        out = np.zeros(max(mine, size), dtype=np.int32)
        for i in reversed(range(mine)):
            out[i] = nexts[i] - block if nexts[i] >= block else out[nexts[i]] if nexts[i] < mine else 0
        return pa.table([table.column(c)[:1] for c in [*key, "block"]] + [pa.array([out[:size]], pa.list_(pa.int32()))], names=[*key, "block", "f"])

    by = [*key, "block"]
    keyed = T.StructType([*kinds, T.StructField("block", T.IntegerType())])
    found = light.groupBy(*by).applyInArrow(exits, T.StructType([*keyed, T.StructField("f", T.ArrayType(T.IntegerType()))]))
    step = 0
    while True:
        found = files.stored(found)
        if step == 0:
            blocks = (found.agg(F.max("block")).first()[0] or 0) + 1
        if 1 << step >= blocks:
            break
        before = found.select(*key, (F.col("block") + (1 << step)).alias("block"), F.col("f").alias("g"))
        composed = F.when(F.col("g").isNull(), F.col("f")).otherwise(F.transform("g", lambda x: F.get("f", x)))
        found = found.join(before, by, "left").select(*by, composed.alias("f"))
        step += 1
    entrances = found.select(*key, (F.col("block") + 1).alias("block"), F.get("f", F.lit(0)).alias("enter"))

    def pages(table: pa.Table) -> pa.Table:
        enter = table.column("enter")[0].as_py()
        place, nexts, first, mine = jumps(table)
        starts, i = [], enter or 0
        while i < mine:
            starts.append(i)
            i = int(nexts[i])
        within = np.arange(starts[0], i) if starts else np.zeros(0, np.int64)
        start = place[np.array(starts, dtype=np.int64)[np.searchsorted(starts, within, side="right") - 1]] if starts else place[:0]
        return pa.table([table.column(c)[:1].combine_chunks().take(pa.array(np.zeros(len(within), np.int64))) for c in key] + [pa.array(place[within]), pa.array(start)], names=[*key, "at", "start"])

    dealt = light.join(entrances, by, "left").groupBy(*by).applyInArrow(pages, T.StructType([*kinds, *T._parse_datatype_string("at int, start int").fields]))
    packs = rows.join(dealt, [*key, "at"]).groupBy(*key, "start").agg(F.sum("n").cast("int").alias("word_count"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "p"))), lambda x: x["p"]), "\n\n").alias("text"))
    number = F.row_number().over(Window.partitionBy(*key).orderBy("start"))  # a row a page, at most
    kept = packs.filter(F.col("word_count") >= settings.page_min_words).withColumn("page_num", number)
    kept = kept.select(*key, (F.col("page_num") - 1).alias("pos"), "page_num", F.concat(F.lit("page-"), F.col("page_num").cast("string")).alias("chunk_id"), "text", "word_count", F.lit(False).alias("is_boilerplate"))
    return kept.withColumn("has_table", F.contains("text", F.lit("|"))).select("*", *_common("pdf_page", 1.0, 0.90, "markitdown"))


def heading_sections(documents: DataFrame, text: str = "text", settings: Settings = DEFAULT) -> DataFrame:
    """Sections between Markdown headings, numbered by heading; what is before the first one is number -1."""
    keep = [c for c in documents.columns if c != text]
    heading = r"(?m)^#{1,6}\s+(.+)$"
    # a text that starts with its first heading has no part before it
    marks = [F.col(text).rlike(heading).alias("_has"), F.coalesce(F.col(text).rlike(r"^#{1,6}\s+.+"), F.lit(False)).alias("_leads")]
    rows = documents.select(*keep, *marks, F.posexplode(F.split(text, r"(?m)(?=^#{1,6}\s+.+$)")).alias("pos", "text"))
    rows = rows.withColumn("text", tx.trimmed(F.col("text")))
    number = F.when(~F.col("_has"), 0).otherwise(F.col("pos") - F.when(F.col("_leads"), 0).otherwise(1))
    title = F.when(F.col("_has") & (number >= 0), F.trim(F.regexp_extract("text", heading, 1))).otherwise("")
    rows = rows.withColumns({"section_num": number, "section_title": title, "word_count": tx.word_count(F.col("text"))}).filter(F.col("word_count") >= settings.section_min_words)
    rows = rows.withColumns({"chunk_id": F.concat(F.lit("docx-section-"), F.col("section_num").cast("string")), "is_boilerplate": F.lit(False), "has_table": F.contains("text", F.lit("|"))})
    return rows.drop("_has", "_leads").select("*", *_common("docx_section", 1.0, 0.95, "markitdown"))


def description_chunks(records: DataFrame, separator: str = "\n\n", settings: Settings = DEFAULT) -> DataFrame:
    """Chunks of descriptions (ticket_key, summary, text, desc_class, has_attachment, scaffold), by their class.

    With an attachment: usable and rich texts count 0.7, others nothing. Without: rich texts by paragraphs of ten words
    or more, usable ones whole, thin ones with a scaffold of metadata, titles in front.
    """
    kind = "array<struct<text:string,n:int,weight:double>>"
    title, text, label, attached = F.coalesce("summary", F.lit("")), F.col("text"), F.col("desc_class"), F.col("has_attachment")
    titled = lambda t: F.when(title == "", t).otherwise(F.concat(title, F.lit("\n\n"), t))
    part = lambda t, n, w: F.struct(t.alias("text"), n.cast("int").alias("n"), F.lit(w).alias("weight"))
    one = lambda t, w: F.array(part(t, F.lit(None), w)).cast(kind)
    # paragraphs are made and counted only for texts of which they become chunks
    counted = F.transform(F.transform(F.split(text, separator), tx.trimmed), lambda p: part(p, tx.word_count(p), 1.0))
    rows = records.withColumn("_parts", F.when(~attached & (label == "rich"), F.filter(counted, lambda p: p["n"] >= 10)).cast(kind))
    # the title's words, unless it joins up with the paragraph's
    first = lambda p: part(titled(p["text"]), p["n"] + tx.word_count(title), 1.0)
    split = F.transform("_parts", lambda p, i: F.when(i == 0, first(p)).otherwise(p)).cast(kind)
    scaffold = tx.non_empty(F.coalesce("scaffold", F.lit(""))) if "scaffold" in records.columns else F.lit(None).cast("string")
    thin = F.concat_ws("\n\n", F.concat(title, F.lit("\n\n"), text), scaffold)
    found = (
        F.when(attached & label.isin("usable", "rich"), one(text, 0.7))
        .when(attached, F.array().cast(kind))
        .when((label == "rich") & (F.size("_parts") > 0), split)
        .when(label.isin("rich", "usable"), one(titled(text), 1.0))
        .when(label == "thin", one(thin, 0.8))
        .otherwise(F.array().cast(kind))
    )
    rows = rows.select("ticket_key", F.posexplode(found).alias("pos", "c"))
    words = F.coalesce("c.n", tx.word_count(F.col("c.text")))
    rows = rows.select("ticket_key", "pos", F.concat(F.lit("description-"), F.col("pos").cast("string")).alias("chunk_id"), F.col("c.text").alias("text"), words.alias("word_count"), F.lit(False).alias("is_boilerplate"), F.col("c.weight").alias("_w"))
    return rows.select("*", *_common("description", F.col("_w"), 0.90, "description")).drop("_w")


def scaffold() -> Column:
    """Components, labels and business unit of a record, as one short text."""
    listed = lambda name, c: F.when(F.size(c) > 0, F.concat(F.lit(f"{name}: "), F.array_join(c, ", ")))
    return F.concat_ws(". ", listed("Components", F.col("components")), listed("Labels", F.col("labels")), F.concat(F.lit("Business Unit: "), tx.non_empty(F.col("business_unit"))))


def sections(chunks: DataFrame, key: list[str], settings: Settings = DEFAULT) -> DataFrame:
    """Consecutive chunks (pos, text, slide_title or section_title, slide_num or page_num) grouped into sections.

    A section starts at a chunk whose title looks like a header or agenda item. Where that finds at most one section
    among eight or more chunks, every four chunks make one. Both groupings are running sums over one window's partitions.
    """
    have = lambda *names: F.coalesce(*[tx.non_empty(F.col(n)) for n in names if n in chunks.columns], F.lit(""))
    number = F.coalesce(*[F.nullif(F.col(n), F.lit(0)) for n in ("slide_num", "page_num") if n in chunks.columns], F.lit(None).cast("int"))
    boring = F.coalesce("is_boilerplate", F.lit(False)) if "is_boilerplate" in chunks.columns else F.lit(False)
    confidence = F.coalesce("extraction_confidence", F.lit(1.0)) if "extraction_confidence" in chunks.columns else F.lit(1.0)
    own_slide_title = tx.non_empty(F.col("slide_title")) if "slide_title" in chunks.columns else F.lit(None).cast("string")
    layout = F.col("layout_name") if "layout_name" in chunks.columns else None
    rows = chunks.filter(~boring).select(*key, "pos", "text", have("slide_title", "section_title").alias("title"), own_slide_title.alias("slide_title"), number.cast("int").alias("number"), confidence.alias("confidence"), *([layout] if layout is not None else []))
    by = Window.partitionBy(*key).orderBy("pos")
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(*key)
    rows = rows.withColumns({"_n": F.row_number().over(by), "_start": tx.is_section_start(F.col("title"), layout)})
    rows = rows.withColumn("_island", F.sum(F.when(F.col("_start") & (F.col("_n") > 1), 1).otherwise(0)).over(so_far))
    rows = rows.withColumns({"_islands": F.max("_island").over(every) + 1, "_total": F.count("*").over(every)})
    fallback = (F.col("_islands") <= 1) & (F.col("_total") >= settings.fallback_at)
    group = F.when(fallback, F.floor((F.col("_n") - 1) / settings.fallback_group)).otherwise(F.col("_island"))
    rows = rows.withColumns({"_fallback": fallback, "section": group.cast("int")})
    ordered = F.array_sort(F.collect_list(F.struct("pos", "text", "title", "slide_title", "number", "confidence")))
    got = rows.groupBy(*key, "section").agg(ordered.alias("c"), F.first("_fallback").alias("_fallback"))
    first, last = F.get("c", F.lit(0)), F.element_at("c", -1)
    header = F.get(F.filter(F.transform("c", lambda c: c["title"]), lambda t: t != ""), F.lit(0))
    counted = F.concat(F.lit("Section "), (F.col("section") + 1).cast("string"))
    title = F.when(F.col("_fallback"), F.coalesce(first["slide_title"], counted)).otherwise(F.coalesce(header, F.lit("Untitled Section")))
    texts = F.filter(F.transform("c", lambda c: tx.trimmed(c["text"])), lambda t: t != "")
    got = got.withColumns({"section_title": title, "start": first["number"], "stop": last["number"]})
    got = got.withColumn("text", F.array_join(F.concat(F.array(F.concat(F.lit("## Section: "), F.col("section_title"))), texts), "\n\n"))
    rows = got.select(*key, "section", F.concat(F.lit("section-"), F.coalesce(F.col("start").cast("string"), F.lit("None"))).alias("chunk_id"), "text", "section_title", F.array("start", "stop").alias("slide_range"), F.size("c").alias("child_slide_count"), tx.word_count(F.col("text")).alias("word_count"), F.lit(False).alias("is_boilerplate"), F.array_min(F.transform("c", lambda c: c["confidence"])).alias("extraction_confidence"))
    return rows.select("*", F.lit("section").alias("source"), F.lit(1.0).alias("weight_multiplier"), F.lit("section_grouping").alias("extraction_method"))


def supplementary(chunks: DataFrame, key: list[str], ext: str = "ext", settings: Settings = DEFAULT) -> DataFrame:
    """One chunk of each secondary document: its texts in order (no boilerplate), cut, if it has thirty words."""
    boring = F.coalesce("is_boilerplate", F.lit(False)) if "is_boilerplate" in chunks.columns else F.lit(False)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda c: c["text"])
    got = chunks.filter(~boring).groupBy(*key, ext).agg(F.substring(tx.trimmed(F.array_join(texts, " ")), 1, settings.supplementary_chars).alias("text"))
    got = got.withColumn("word_count", tx.word_count(F.col("text"))).filter(F.col("word_count") >= settings.supplementary_words)
    return got.select("*", F.concat_ws("-", F.lit("supp"), ext, F.col(key[-1]).cast("string")).alias("chunk_id"), F.concat(F.lit("supplementary_"), ext).alias("source"), F.lit(False).alias("is_boilerplate"), F.lit(0.7).alias("weight_multiplier"), F.lit(0.8).alias("extraction_confidence"), F.concat(F.col(ext), F.lit("_native")).alias("extraction_method"))
