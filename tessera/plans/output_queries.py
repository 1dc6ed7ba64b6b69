"""Further registered queries: output records, strict models, dictionaries from files, malformed lines, office files, each with its SQL."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import entities, extract, records, triage
from tessera.plans import assembly
from tessera.plans.queries import TRIAGED, attachments, query, table
from tessera.sources import documents, files


@query("""SELECT 'S-' || s_suppkey AS key, s_suppkey % 4 = 1 AS rejected, CASE s_suppkey % 4 WHEN 0 THEN 0 ELSE 2 END::INT AS n,
  CASE s_suppkey % 4 WHEN 0 THEN NULL ELSE s_name END AS filename, CASE s_suppkey % 4 WHEN 0 THEN NULL ELSE s_nationkey::BIGINT END AS size, true AS no_type, 0 AS themes FROM supplier""")  # fmt: skip
def strict_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as records, strictly validated: filenames of blanks are rejected, unknown members go, defaults are filled in."""
    n, kind = F.col("s_suppkey"), F.col("s_nationkey").cast("bigint")
    file = lambda name: F.struct(n.cast("string").alias("id"), name.alias("filename"), kind.alias("size"), F.lit("2024").alias("created"))
    listed = F.when(n % 4 != 0, F.array(file(F.col("s_name")), file(F.when(n % 4 == 1, F.lit("  ")).otherwise(F.lit("b.pdf")))))
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("S-"), n.cast("string")).alias("key"), F.lit("{}").alias("fields"), listed.alias("attachments"), F.lit(1).alias("other"))
    model = records.strict_model(rows)
    first = F.get("attachments", F.lit(0))
    return model.select("key", F.col("validation_error").isNotNull().alias("rejected"), F.size("attachments").alias("n"), first["filename"].alias("filename"), first["size"].alias("size"), F.coalesce(first["mimeType"].isNull(), F.lit(True)).alias("no_type"), F.size("themes").alias("themes"))


@query("""WITH n AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS line FROM customer)
SELECT 'good' AS kind, NULL::BIGINT AS line, c_custkey FROM n WHERE c_custkey % 7 > 2 UNION ALL SELECT 'bad', line, NULL FROM n WHERE c_custkey % 7 IN (1, 2)""")  # fmt: skip
def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as lines of one file, some of them broken or blank, read apart and by way of the dead letters."""
    path, n = files.scratch(spark), F.col("c_custkey")
    whole = F.to_json(F.struct("c_custkey", "c_name"))
    line = F.when(n % 7 == 0, "").when(n % 7 == 1, F.concat(F.lit("x"), whole)).when(n % 7 == 2, F.btrim(whole, F.lit("}"))).otherwise(whole)
    table(spark, sf_dir, "customer").orderBy("c_custkey").select(n, line.alias("value")).coalesce(1).sortWithinPartitions("c_custkey").select("value").write.text(f"{path}/lines")
    good, bad = files.parted_lines(spark, f"{path}/lines", "c_custkey long, c_name string")
    files.quarantine(bad, f"{path}/dead")
    dead = files.read_dead_letters(spark, f"{path}/dead").select(F.lit("bad").alias("kind"), F.col("extra")["line"].cast("long").alias("line"), F.lit(None).cast("long").alias("c_custkey"))
    return good.select(F.lit("good").alias("kind"), F.lit(None).cast("long").alias("line"), "c_custkey").unionByName(dead)


@query("""WITH e AS (SELECT 'products' AS etype, p_brand AS canonical, lower(split_part(p_name, ' ', 1)) AS alias, p_partkey AS ord FROM part UNION ALL SELECT 'systems', p_type, '', p_partkey FROM part),
t AS (SELECT etype, canonical, lower(canonical) AS term, ord, 0 AS nth FROM e UNION ALL SELECT etype, canonical, alias, ord, 1 FROM e WHERE alias <> '')
SELECT etype, term, arg_max(canonical, (ord, nth)) AS canonical FROM t GROUP BY ALL""")  # fmt: skip
def dictionary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionaries of two types as files of one array each, of five that may be there; a later alias wins."""
    path, part = files.scratch(spark), table(spark, sf_dir, "part")
    system, root = documents.opened(path)
    system.create_dir(root)
    for name, canonical, aliases in (("products", "p_brand", F.array(F.split_part("p_name", F.lit(" "), F.lit(1)))), ("systems", "p_type", F.lit(None).cast("array<string>"))):
        entry = F.struct(F.col(canonical).alias("canonical"), aliases.alias("aliases"))
        listed = part.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", entry.alias("e")))), lambda x: x["e"])).alias("value"))
        with system.open_output_stream(f"{root}/{name}.json") as out:  # a dictionary is a file that people write
            out.write(listed.first()["value"].encode())
    return entities.dictionary(files.read_dictionary(spark, path, entities.TYPES)).select("etype", "term", "canonical")


@query("""SELECT doc_id, md5(substr(text, 1, 2000)) AS text_md5, length(substr(source, 1, 2000)) AS source_chars, lang FROM documents""")
def shortened_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for looking at: long texts cut, bulky fields dropped."""
    rows = files.shorten(table(spark, sf_dir, "documents").withColumns({"comment": F.lit("x"), "worklog": F.lit("y")}))
    return rows.select(*[c for c in rows.columns if c in ("comment", "worklog")], "doc_id", F.md5("text").alias("text_md5"), F.length("source").cast("long").alias("source_chars"), "lang")


SOURCES = ("pptx_slide", "pdf_page", "section", "docx_section", "supplementary_pdf", "", "description")
CHUNKED = f"""WITH c AS (SELECT *, (turn % 7)::INT AS k, {list(SOURCES)}[(turn % 7 + 1)::INT] AS src, CASE WHEN conv_id % 3 = 0 THEN 'C' || conv_id ELSE 'PR-' || conv_id END AS tk FROM conversations)"""


@query(f"""{CHUNKED} SELECT conv_id || '/' || turn AS id, md5(text) AS content_md5, tk AS source_id, 'http://t/browse/' || tk AS url, CASE WHEN conv_id % 2 = 0 THEN 'Title ' || conv_id ELSE tk END AS title,
  CASE k WHEN 2 THEN 'section' WHEN 3 THEN 'section' WHEN 0 THEN 'page' WHEN 1 THEN 'page' WHEN 4 THEN 'supplementary' WHEN 5 THEN 'unknown' ELSE 'description' END AS content_type, CASE WHEN conv_id % 3 = 0 THEN '' ELSE 'PR' END AS project,
  CASE WHEN turn % 2 = 0 THEN 7 ELSE len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) END::INT AS tokens, CASE WHEN k < 3 THEN 1 ELSE 0 END AS refs, CASE k WHEN 0 THEN 'primary' WHEN 1 THEN 'primary' WHEN 2 THEN 'primary' END AS category,
  CASE WHEN k = 1 THEN turn::INT END AS first_page, CASE WHEN k = 0 THEN turn::INT + 1 END AS first_slide, CASE WHEN k < 3 THEN 'A' || turn ELSE '' END AS attachment, 'Open' AS status FROM c""")  # fmt: skip
def chunk_index_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as chunks of their conversations, as flat records for a search service."""
    turn, conv = F.col("turn"), F.col("conv_id").cast("string")
    key = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("C"), conv)).otherwise(F.concat(F.lit("PR-"), conv))
    rows = table(spark, sf_dir, "conversations").withColumn("k", turn % 7)
    chunks = rows.select(
        F.concat(conv, F.lit("/"), turn.cast("string")).alias("chunk_uid"), "text", F.lit(None).cast("array<float>").alias("embedding"), key.alias("ticket_key"), F.get(F.array(*map(F.lit, SOURCES)), F.col("k").cast("int")).alias("source"),
        turn.cast("string").alias("chunk_id"), F.when(turn % 2 == 0, 7).alias("word_count"), F.when(F.col("k") < 3, F.concat(F.lit("A"), turn.cast("string"))).alias("attachment_id"), turn.cast("int").alias("page_num"), (turn + 1).cast("int").alias("slide_num"),
        F.lit(1.0).alias("extraction_confidence"), F.lit("x").alias("quality_tier"),
    )
    owners = rows.select("conv_id").distinct().select(key.alias("ticket_key"), F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("Title "), conv)).otherwise("").alias("title"), F.lit("Idea").alias("issue_type"), F.lit("Open").alias("status"), *[F.lit("").alias(c) for c in ("priority", "reporter", "created", "updated_at")])
    out = assembly.chunk_records(chunks, owners, "http://t/")
    at = lambda c: F.get(F.col(f"chunkProvenance.{c}"), F.lit(0))
    return out.select(
        "id", F.md5("content").alias("content_md5"), F.col("sourceId").alias("source_id"), F.col("sourceURL").alias("url"), "title", F.col("contentType").alias("content_type"), "project", F.col("tokenCount").alias("tokens"), F.size("attachmentReferences").alias("refs"),
        F.get("attachmentReferences", F.lit(0))["category"].alias("category"), at("pageRange").alias("first_page"), at("slideRange").alias("first_slide"), F.col("chunkProvenance.attachmentId").alias("attachment"), "status",
    )


@query("""SELECT 'SU-' || s_suppkey AS id, 'SU' AS project, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE 'SU-' || s_suppkey END AS title, CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE '' END AS stream_names, CASE WHEN s_suppkey % 5 = 0 THEN s_nationkey::VARCHAR ELSE '' END AS product_ids,
  '' AS it_products, CASE WHEN s_suppkey % 3 = 0 THEN 'themes' ELSE '' END AS label_source, 'now' AS updated FROM supplier""")  # fmt: skip
def stream_index_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' labels as flat records, with lists where nothing is known."""
    n, key = F.col("s_suppkey"), F.concat(F.lit("SU-"), F.col("s_suppkey").cast("string"))
    rows = table(spark, sf_dir, "supplier")
    owners = rows.select(key.alias("ticket_key"), F.when(n % 2 == 0, F.col("s_name")).otherwise("").alias("title"), F.lit("now").alias("updated_at"))
    names, ids = F.when(n % 3 == 0, F.array("s_name")), F.when(n % 5 == 0, F.array(F.col("s_nationkey").cast("string")))
    nothing = F.lit(None).cast("array<string>")
    labels = rows.select(key.alias("id"), names.alias("linked_value_stream_ids"), names.alias("linked_value_stream_names"), names.alias("linked_value_stream_statuses"), F.struct(ids.alias("ids"), nothing.alias("names")).alias("impacted_products"), F.lit(None).cast("struct<ids:array<string>,names:array<string>>").alias("impacted_it_products"), F.when(n % 3 == 0, "themes").alias("vs_label_source"))
    out = assembly.value_stream_records(owners, labels)
    joined = lambda c: F.array_join(c, "|")
    return out.select("id", "project", "title", joined("valueStreamNames").alias("stream_names"), joined("impactedProductIds").alias("product_ids"), F.concat(joined("impactedItProductIds"), joined("impactedItProductNames")).alias("it_products"), F.col("labelSource").alias("label_source"), F.col("updatedDate").alias("updated"))


@query(f"""WITH {TRIAGED}, best AS (SELECT * FROM roles WHERE prim), counts AS (SELECT ticket_key, count(*) FILTER (doc_role = 'supporting_doc') AS n FROM roles GROUP BY ticket_key)
SELECT DISTINCT r.ticket_key, CASE WHEN b.id IS NULL THEN 'No viable extractable attachments found after filtering.' WHEN b.confirmed THEN b.filename || ' selected as primary because it was confirmed as the best idea-card-like document.'
  ELSE b.filename || ' selected as primary fallback based on ranking and extraction readiness.' END AS choice, CASE WHEN b.id IS NOT NULL THEN coalesce(c.n, 0)::VARCHAR ELSE '' END AS supporting
FROM reasons r LEFT JOIN best b ON r.ticket_key = b.ticket_key LEFT JOIN counts c ON r.ticket_key = c.ticket_key""")  # fmt: skip
def selection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a record's primary attachment was chosen, without the signals, and how many others are kept."""
    told = triage.artifact(triage.triage(attachments(spark, sf_dir))).select("ticket_key", F.col("selection_reason").alias("r"))
    return told.select("ticket_key", F.regexp_extract("r", r"^(.*?)(?: Signals: |$)", 1).alias("choice"), F.regexp_extract("r", r"kept for chunking: (\d+)\.$", 1).alias("supporting"))


@query(f"""WITH {TRIAGED} SELECT ticket_key, id AS attachment_id, filename, ext, size, doc_role, score::INT AS score, confirmed, coalesce(word_count, 0)::INT AS words, round(retrieval_readiness, 6) AS readiness FROM roles""")
def attachment_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What may be shown of each scored attachment."""
    rows = triage.artifact(triage.triage(attachments(spark, sf_dir))).select("ticket_key", F.explode("per_attachment_scores").alias("a"))
    return rows.select("ticket_key", "a.attachment_id", "a.filename", "a.ext", "a.size", "a.doc_role", "a.score", "a.confirmed", F.coalesce("a.word_count", F.lit(0)).alias("words"), F.round("a.retrieval_readiness", 6).alias("readiness"))


SLIDE = '<p:sld xmlns:p="p" xmlns:a="{ns}"><a:t>{name}</a:t>{table}{pad}</p:sld>'
PAGE = '<w:document xmlns:w="{ns}"><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>{name}</w:t></w:r></w:p>{table}{pad}</w:document>'
#: Bytes of a slide and of a page without name, table and padding.
#: Of a cut archive, fewer bytes are left than an empty one has.
CUT_BYTES = 20
SLIDE_BYTES, PAGE_BYTES = (len(x.format(ns=ns.strip("{}"), name="", table="", pad="")) for x, ns in ((SLIDE, extract.DRAWING), (PAGE, extract.WORDS)))


def office_file(key: int, size: int, name: str) -> tuple[str, bytes]:
    """A presentation, a text or a PDF, made for a part; some archives are cut off."""
    kind, out = ("pptx", "docx", "pdf")[key % 3], io.BytesIO()
    if kind == "pdf":
        return kind, b"%PDF-1.4 /Type /Pages " + b"/Type /Page\n" * size
    # what escapes and encodes a name comes off the padding, so that sizes count its characters
    escaped = escape(name)
    pad, name = " " * (size * 50 - len(escaped.encode()) + len(name)), escaped
    with zipfile.ZipFile(out, "w") as z:
        if kind == "docx":
            z.writestr("word/document.xml", PAGE.format(ns=extract.WORDS.strip("{}"), name=name, table="<w:tbl/>" if size % 2 else "", pad=pad))
        else:
            for i in range(size % 6):
                z.writestr(f"ppt/slides/slide{i + 1}.xml", SLIDE.format(ns=extract.DRAWING.strip("{}"), name=name, table="<a:tbl/>" if i == 0 and size % 2 else "", pad=pad))
            if size % 4 == 0:
                z.writestr("ppt/notesSlides/notesSlide1.xml", "<x/>")
    return kind, out.getvalue()[: CUT_BYTES if key % 7 == 0 else None]


@query(f"""WITH p AS (SELECT p_partkey, p_name, p_size, p_partkey % 3 AS k, p_partkey % 7 = 0 AND p_partkey % 3 < 2 AS failed, (p_size % 6)::INT AS n, p_size % 2 = 1 AS odd FROM part),
v AS (SELECT *, n * ({SLIDE_BYTES} + length(p_name) + p_size * 50) + CASE WHEN odd AND n > 0 THEN 8 ELSE 0 END AS slide_bytes, ({PAGE_BYTES} + length(p_name) + p_size * 50 + CASE WHEN odd THEN 8 ELSE 0 END) // 6 AS words FROM p)
SELECT p_partkey, failed, CASE WHEN k = 0 AND NOT failed THEN n END AS slide_count, CASE WHEN k = 2 THEN p_size::INT END AS page_count, CASE WHEN NOT failed AND (k = 1 OR k = 0 AND n > 0) THEN p_name END AS title,
  CASE WHEN k = 0 AND NOT failed THEN slide_bytes::BIGINT END AS text_bytes, CASE WHEN k = 1 AND NOT failed THEN words::BIGINT END AS estimated_words, CASE WHEN failed OR k = 2 THEN NULL WHEN k = 0 THEN odd AND n > 0 ELSE odd END AS has_tables,
  CASE WHEN k = 0 AND NOT failed THEN p_size % 4 = 0 END AS has_notes, CASE WHEN failed THEN NULL WHEN k = 0 THEN n >= 3 AND slide_bytes > 5000 WHEN k = 1 THEN words > 200 ELSE p_size BETWEEN 2 AND 80 END AS idea, CASE WHEN k = 0 AND NOT failed THEN n <= 2 AND slide_bytes < 3000 END AS template FROM v""")  # fmt: skip
def office_peeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Presentations, texts and PDFs made for each part, as bytes, and what a peek tells of them."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [office_file(*row) for row in zip(*(b.column(c).to_pylist() for c in ("p_partkey", "p_size", "p_name")), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("p_partkey"), pa.array([k for k, _ in made]), pa.array([d for _, d in made], pa.binary())], ["p_partkey", "ext", "file_bytes"])

    rows = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name").mapInArrow(make, "p_partkey long, ext string, file_bytes binary")
    found = extract.peeks(rows, ["p_partkey"])
    p = lambda c: F.col(f"peek.{c}")
    return found.select("p_partkey", p("error").isNotNull().alias("failed"), *[p(c).cast(kind).alias(c) for c, kind in (("slide_count", "int"), ("page_count", "int"), ("title", "string"), ("text_bytes", "long"), ("estimated_words", "long"), ("has_tables", "boolean"), ("has_notes", "boolean"))], p("is_likely_idea_card").alias("idea"), p("is_likely_template").alias("template"))
