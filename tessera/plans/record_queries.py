"""Further registered queries: fields, links and comments of records, chunks, stores and reports, each with its SQL."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import fields as fd
from tessera.functions import text as tx
from tessera.operators import chunking, entities, records, reports, stores, summaries, triage, vectors
from tessera.plans import assembly
from tessera.plans.queries import ATTACHMENTS, COMMENTS, DESCRIBED, TIERED, TRIAGED, WORDS, attachments, query, table, tiered
from tessera.sources import commits, files


def fields_from(*pairs: tuple[str, Column]) -> Column:
    """A JSON object of members given as JSON text."""
    return F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{name}": '), value) for name, value in pairs]), F.lit("}"))


def quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


def one_of(number: Column, *values: Column | None) -> Column:
    """The value at a number's remainder; null where that is null."""
    out = F.lit(None).cast("string")
    for i, v in enumerate(values):
        if v is not None:
            out = F.when(number % len(values) == i, v).otherwise(out)
    return out


@query("""SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN c_name WHEN 2 THEN c_name WHEN 3 THEN c_mktsegment WHEN 4 THEN 'K-' || c_custkey WHEN 5 THEN c_name || ', ' || c_mktsegment ELSE c_custkey::VARCHAR END AS as_text,
  CASE c_custkey % 7 WHEN 1 THEN c_name WHEN 2 THEN c_name WHEN 3 THEN c_mktsegment WHEN 5 THEN c_name || '|' || c_mktsegment ELSE '' END AS names,
  CASE c_custkey % 7 WHEN 6 THEN c_name || '|a|b|' || c_mktsegment ELSE '' END AS nested,
  CASE c_custkey % 3 WHEN 0 THEN 'EP-' || c_nationkey ELSE 'P-' || c_custkey END AS epic FROM customer""")  # fmt: skip
def field_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open fields of every kind as text and as names; epics from a field or the parent."""
    n, name, segment = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    of = lambda key, v: F.concat(F.lit(f'{{"{key}": '), quoted(v), F.lit("}"))
    pair = F.concat(F.lit("["), of("name", name), F.lit(", "), of("name", segment), F.lit(", {}]"))
    nested = F.concat(F.lit("["), quoted(name), F.lit(', ["a", ["b", [['), of("displayName", segment), F.lit("]]]]]"))
    x = one_of(n, F.lit("null"), quoted(name), of("name", name), of("value", segment), of("key", F.concat(F.lit("K-"), n.cast("string"))), pair, n.cast("string"))
    y = F.when(n % 7 == 6, nested).otherwise(F.lit("null"))
    epic = one_of(n, quoted(F.concat(F.lit("EP-"), F.col("c_nationkey").cast("string"))), F.lit('""'), F.lit("7"))
    text = fields_from(("x", x), ("y", y), ("customfield_10014", epic), ("parent", F.concat(F.lit('{"key": "P-'), n.cast("string"), F.lit('"}'))))
    rows = table(spark, sf_dir, "customer").select(n, fd.fields_of(text).alias("v"))
    member = lambda m: F.try_variant_get("v", f"$.{m}", "variant")
    return rows.select("c_custkey", fd.as_text(member("x")).alias("as_text"), F.array_join(fd.names_of(member("x")), "|").alias("names"), F.array_join(fd.names_of(member("y")), "|").alias("nested"), fd.epic_key(F.col("v")).alias("epic"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand || CASE WHEN p_partkey = 0 THEN '' ELSE '|' || p_partkey END WHEN 1 THEN 'B' ELSE '' END AS ids,
  CASE p_partkey % 3 WHEN 0 THEN p_type || '|plain' WHEN 1 THEN p_type ELSE '' END AS names,
  CASE WHEN p_size % 2 = 0 THEN 'stage ' || p_size || '|' || p_brand || '|last' ELSE p_brand || '|last' END AS stages FROM part""")  # fmt: skip
def product_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of products as ids and names; stage labels of three fields, each once."""
    n, brand, kind = F.col("p_partkey"), F.col("p_brand"), F.col("p_type")
    listed = F.concat(F.lit('[{"id": "'), brand, F.lit('", "name": "'), kind, F.lit('"}, {"key": '), n.cast("string"), F.lit('}, "plain", {}]'))
    single = F.concat(F.lit('{"id": "", "key": "B", "value": "'), kind, F.lit('"}'))
    stage = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit('{"value": "stage '), F.col("p_size").cast("string"), F.lit('"}'))).otherwise("null")
    versions = F.concat(F.lit('[{"name": "'), brand, F.lit('"}, "last"]'))
    text = fields_from(("products", one_of(n, listed, single, F.lit("null"))), ("stage", stage), ("fixVersions", versions), ("versions", F.concat(F.lit('["last", '), quoted(brand), F.lit("]"))))
    rows = table(spark, sf_dir, "part").select(n, fd.fields_of(text).alias("v"))
    rows = rows.select("p_partkey", fd.product_labels(F.try_variant_get("v", "$.products", "variant")).alias("p"), fd.stage_labels(F.col("v"), "stage").alias("s"))
    return rows.select("p_partkey", F.array_join("p.ids", "|").alias("ids"), F.array_join("p.names", "|").alias("names"), F.array_join("s", "|").alias("stages"))


LINK_NAMES = ("Value Stream", "Affects Product", "Is Blocked By", "Sub-task", "clones", "Story Link", "other")
LINKED = f"""linked AS (SELECT o_orderkey, (o_orderkey % 7)::INT AS k, {list(LINK_NAMES)}[(o_orderkey % 7 + 1)::INT] AS name FROM orders)"""


def linked_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records, each with an outward link, an inward one, and one without an issue."""
    n = F.col("o_orderkey")
    name = F.element_at(F.array(*map(F.lit, LINK_NAMES)), (n % 7 + 1).cast("int"))
    issue = lambda side, key: F.concat(F.lit(f'"{side}": {{"key": "'), key, F.lit('", "fields": {"summary": "about '), n.cast("string"), F.lit('", "status": {"name": "Open"}}}'))
    kind = lambda out, into: F.concat(F.lit('{"type": {"name": "'), name, F.lit(f'", "outward": "{out}", "inward": "{into}"}}'))
    one = F.concat(kind("implements", "x"), F.lit(", "), issue("outwardIssue", F.concat(F.lit("OUT-"), n.cast("string"))), F.lit(", "), issue("inwardIssue", F.lit("BOTH-1")), F.lit("}"))
    two = F.concat(kind("x", "implemented by"), F.lit(", "), issue("inwardIssue", F.concat(F.lit("IN"), n.cast("string"))), F.lit("}"))
    links = F.concat(F.lit("["), one, F.lit(", "), two, F.lit(", "), kind("x", "x"), F.lit("}]"))
    return table(spark, sf_dir, "orders").select(n.cast("string").alias("key"), fields_from(("issuelinks", links)).alias("fields"))


@query(f"""WITH {LINKED}, sides AS (SELECT *, 0 AS pos, 'outward' AS direction, 'OUT-' || o_orderkey AS key, 'OUT' AS project FROM linked UNION ALL SELECT *, 1, 'inward', 'IN' || o_orderkey, '' FROM linked)
SELECT o_orderkey::VARCHAR AS ticket_key, pos, name AS link_type, direction, ['vs', 'product', 'dependency', 'parent', 'related', 'implementation', 'unknown'][k + 1] AS category, key, 'about ' || o_orderkey AS summary, 'Open' AS status, project FROM sides""")  # fmt: skip
def classified_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.links(linked_records(spark, sf_dir))


@query(f"WITH {LINKED} SELECT o_orderkey::VARCHAR AS key, 'OUT-' || o_orderkey || '|IN' || o_orderkey AS themes FROM linked")
def link_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    themes = fd.themes_of(fd.links_of(fd.fields_of(F.col("fields"))))
    return linked_records(spark, sf_dir).select("key", F.array_join(F.transform(themes, lambda t: t["key"]), "|").alias("themes"))


@query(f"""WITH {LINKED} SELECT o_orderkey::VARCHAR AS ticket_key, 'products' AS etype, 'about ' || o_orderkey AS term, 0.9::DOUBLE AS confidence, n::INT AS pos FROM linked, (SELECT unnest([0, 1]) AS n) WHERE k = 1""")
def product_link_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.link_mentions(records.links(linked_records(spark, sf_dir)), ["ticket_key"]).select("ticket_key", "etype", "term", "confidence", "pos")


@query("""SELECT conv_id, md5(string_agg(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), ' ' ORDER BY turn)) AS text_md5 FROM conversations GROUP BY conv_id""")
def rich_text_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as leaves of a tree, every other one a level deeper, and as plain text again; empty leaves leave no space."""
    leaf = lambda t: F.concat(F.lit('{"type": "text", "text": '), F.to_json(F.struct(t.alias("x"))).substr(F.lit(6), F.length(F.to_json(F.struct(t.alias("x")))) - 6), F.lit("}"))
    deep = F.concat(F.lit('{"type": "paragraph", "content": [{"type": "text", "text": ""}, {"type": "list", "content": ['), leaf(tx.trimmed(F.col("text"))), F.lit("]}]}"))
    node = F.when(F.col("turn") % 2 == 0, leaf(tx.trimmed(F.col("text")))).otherwise(deep)
    nodes = F.transform(F.array_sort(F.collect_list(F.struct("turn", node.alias("n")))), lambda x: x["n"])
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(nodes.alias("nodes"))
    tree = F.concat(F.lit('{"type": "doc", "content": ['), F.array_join("nodes", ", "), F.lit("]}"))
    return rows.select("conv_id", tree.alias("tree")).select("conv_id", F.md5(fd.rich_text(F.col("tree"))).alias("text_md5"))


@query(f"""WITH {COMMENTS} SELECT conv_id, count(*) AS comment_count, md5(coalesce(array_to_string((list(left(text, 2000) ORDER BY turn) FILTER (words >= 50))[1:3], '|'), '')) AS long_md5
FROM flags WHERE turn % 5 <> 4 GROUP BY conv_id""")  # fmt: skip
def simple_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments without those of bots; of each record the first three long ones."""
    author = F.when(F.col("turn") % 5 == 4, "Jira-Bot for you").otherwise(F.col("role"))
    rows = table(spark, sf_dir, "conversations").filter(~tx.is_bot(author))
    flags = records.comment_flags(rows.select(F.col("conv_id").alias("ticket_key"), F.col("turn").alias("pos"), F.col("text").alias("body_raw")))
    return records.comment_summary(flags).select(F.col("ticket_key").alias("conv_id"), "comment_count", F.md5(F.array_join("substantive_comments", "|")).alias("long_md5"))


RECORDS = """records AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN '  ' ELSE 'A-' || o_orderkey END AS key, o_orderkey % 4 AS kind, o_orderkey % 6 AS names, o_orderkey FROM orders)"""


@query(f"""WITH {RECORDS} SELECT o_orderkey, CASE WHEN key = '  ' THEN '''key'' must be a non-empty string' WHEN kind = 1 OR kind = 2 THEN '''fields'' must be an object'
  WHEN names = 1 THEN 'attachment[1] is missing ''filename''' WHEN names = 2 THEN 'attachment[0] is missing ''filename''' ELSE 'ok' END AS plain,
  CASE WHEN key = '  ' THEN '''key'' must be a non-empty string' WHEN kind = 1 OR kind = 2 THEN '''fields'' must be an object'
  WHEN names = 1 THEN 'attachment[1] is missing ''filename''' WHEN names IN (2, 3) THEN 'attachment[0] is missing ''filename''' ELSE 'ok' END AS strict FROM records""")  # fmt: skip
def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with records that lack a key, fields or filenames, by plain and by strict rules."""
    n = F.col("o_orderkey")
    named = lambda *names: F.array(*[F.struct(F.lit(x).cast("string").alias("filename")) for x in names])
    lists = F.when(n % 6 == 1, named("a", None)).when(n % 6 == 2, named("", "b")).when(n % 6 == 3, named(" ")).when(n % 6 == 4, named("c")).otherwise(F.array().cast("array<struct<filename:string>>"))
    fields = F.when(n % 4 == 0, "{}").when(n % 4 == 1, "[1]").when(n % 4 == 2, F.lit(None).cast("string")).otherwise('{"a": 1}')
    key = F.when(n % 5 == 0, "  ").otherwise(F.concat(F.lit("A-"), n.cast("string")))
    rows = table(spark, sf_dir, "orders").select(n, key.alias("key"), fields.alias("fields"), lists.alias("attachments"))
    said = lambda strict: F.coalesce(records.validation_error(strict), F.lit("ok"))
    return rows.select("o_orderkey", said(False).alias("plain"), said(True).alias("strict"))


SLIDES = """slides AS (SELECT conv_id, turn, CASE WHEN conv_id % 5 = 0 THEN turn * 25 + 1 ELSE turn + 1 END AS n,
  CASE turn % 4 WHEN 1 THEN '## Agenda' || chr(10) || text WHEN 2 THEN '# ' || role || chr(10) || text || ' Notes: x | y' WHEN 3 THEN '' ELSE text END AS t FROM conversations)"""


@query(f"""WITH {SLIDES}, cut_ AS (SELECT *, max(n) OVER (PARTITION BY conv_id ORDER BY turn) > 60 AS over_ FROM slides),
kept AS (SELECT *, regexp_replace(t, '^\\s+|\\s+$', '', 'g') AS body FROM cut_ WHERE NOT over_),
titled AS (SELECT *, coalesce(list_filter(list_transform(string_split(body, chr(10)), lambda s: trim(regexp_replace(trim(s), '^#+', ''))), lambda s: s <> '')[1], '') AS title, {WORDS("body")} AS words FROM kept WHERE body <> '')
SELECT conv_id, n::INT AS slide_num, 'slide-' || n AS chunk_id, md5(title) AS title_md5, md5(body) AS text_md5, words::INT AS word_count, (title = 'Agenda' OR (n = 1 AND (words < 20 OR length(body) < 20))) AS is_boilerplate,
  CASE WHEN title = 'Agenda' OR (n = 1 AND (words < 20 OR length(body) < 20)) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS weight_multiplier, contains(body, '|') AS has_table, contains(body, 'Notes:') AS has_notes FROM titled""")  # fmt: skip
def slide_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as converted presentations, and as slides again: those from the first number above sixty on are left out."""
    turn, text = F.col("turn"), F.col("text")
    n = F.when(F.col("conv_id") % 5 == 0, turn * 25 + 1).otherwise(turn + 1)
    body = F.when(turn % 4 == 1, F.concat(F.lit("## Agenda\n"), text)).when(turn % 4 == 2, F.concat(F.lit("# "), "role", F.lit("\n"), text, F.lit(" Notes: x | y"))).when(turn % 4 == 3, "").otherwise(text)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("turn", F.concat(F.lit("<!-- Slide number: "), n.cast("string"), F.lit(" -->\n"), body).alias("t")))), lambda x: x["t"])
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(parts, "\n").alias("text"))
    found = chunking.slides(rows)
    return found.select("conv_id", "slide_num", "chunk_id", F.md5("slide_title").alias("title_md5"), F.md5("text").alias("text_md5"), "word_count", "is_boilerplate", "weight_multiplier", "has_table", "has_notes")


@query(f"""WITH parts AS (
  SELECT conv_id, turn AS section_num, role || ' ' || turn AS section_title, '## ' || role || ' ' || turn || chr(10) || regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t FROM conversations WHERE conv_id % 4 <> 3
  UNION ALL SELECT conv_id, -1, '', regexp_replace(text, '^\\s+|\\s+$', '', 'g') FROM conversations WHERE conv_id % 4 = 1 AND turn = 0
  UNION ALL SELECT conv_id, 0, '', regexp_replace(string_agg(text, chr(10) ORDER BY turn), '^\\s+|\\s+$', '', 'g') FROM conversations WHERE conv_id % 4 = 3 GROUP BY conv_id)
SELECT conv_id, section_num::INT AS section_num, 'docx-section-' || section_num AS chunk_id, section_title, md5(t) AS text_md5, {WORDS("t")}::INT AS word_count FROM parts WHERE {WORDS("t")} >= 10""")  # fmt: skip
def heading_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as Markdown: headings with or without a part before them, or none at all."""
    n = F.col("conv_id") % 4
    headed = F.concat(F.lit("## "), "role", F.lit(" "), F.col("turn").cast("string"), F.lit("\n"), "text")
    line = F.when(n == 3, F.col("text")).when((n == 1) & (F.col("turn") == 0), F.concat("text", F.lit("\n"), headed)).otherwise(headed)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("t")))), lambda x: x["t"])
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(lines, "\n").alias("text"))
    return chunking.heading_sections(rows).select("conv_id", "section_num", "chunk_id", "section_title", F.md5("text").alias("text_md5"), "word_count")


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN md5(trim(b)) WHEN 1 THEN md5(a) WHEN 2 THEN md5(a) ELSE CASE WHEN b = '' OR contains(a, b) THEN md5(a) WHEN contains(b, a) OR a = '' THEN md5(b) ELSE md5(a || chr(10) || chr(10) || '[OCR]' || chr(10) || b) END END AS merged_md5
FROM (SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS a, CASE doc_id % 4 WHEN 0 THEN regexp_replace(text, '^\\s+|\\s+$', '', 'g') || ' more' WHEN 1 THEN trim(left(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), 20)) WHEN 2 THEN '' ELSE lang || ' ' || source END AS b FROM documents)""")  # fmt: skip
def merged_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, text = F.col("doc_id") % 4, tx.trimmed(F.col("text"))
    ocr = F.when(n == 0, F.concat(text, F.lit(" more"))).when(n == 1, F.substring(text, 1, 20)).when(n == 2, "  ").otherwise(F.concat_ws(" ", "lang", "source"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(tx.merge_texts(F.col("text"), ocr)).alias("merged_md5"))


@query("""WITH s AS (SELECT n, ['section', 'docx_section', 'pdf_page', 'pptx_slide', 'supplementary_pdf', 'description', ''][(n % 7 + 1)::INT] AS source FROM (SELECT p_partkey AS n FROM part))
SELECT n AS p_partkey, CASE WHEN source IN ('section', 'docx_section') THEN 'section' WHEN source IN ('pdf_page', 'pptx_slide') THEN 'page' WHEN source = 'supplementary_pdf' THEN 'supplementary' WHEN source = '' THEN 'unknown' ELSE source END AS content_type,
  CASE WHEN source = 'supplementary_pdf' THEN 'supplementary' WHEN source IN ('pdf_page', 'pptx_slide', 'docx_section', 'section') THEN 'primary' ELSE 'ticket' END AS category FROM s""")  # fmt: skip
def content_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("section", "docx_section", "pdf_page", "pptx_slide", "supplementary_pdf", "description", "")
    source = F.element_at(F.array(*map(F.lit, names)), (F.col("p_partkey") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", assembly.content_type(source).alias("content_type"), assembly.reference_category(source).alias("category"))


@query("""SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_partkey % 2 = 0 THEN 'Components: ' || p_brand || ', ' || p_type END, CASE WHEN p_partkey % 3 = 0 THEN 'Labels: ' || p_type END, CASE WHEN p_partkey % 5 <> 0 THEN 'Business Unit: ' || p_name END], lambda x: x IS NOT NULL), '. ') AS scaffold FROM part""")
def metadata_scaffolds(spark: SparkSession, sf_dir: str) -> DataFrame:
    none, n = F.array().cast("array<string>"), F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(n, F.when(n % 2 == 0, F.array("p_brand", "p_type")).otherwise(none).alias("components"), F.when(n % 3 == 0, F.array("p_type")).otherwise(none).alias("labels"), F.when(n % 5 != 0, F.col("p_name")).otherwise("").alias("business_unit"))
    return rows.select("p_partkey", chunking.scaffold().alias("scaffold"))


@query("SELECT doc_id::VARCHAR AS id, lang, n_chars, CASE WHEN doc_id % 2 = 0 THEN 3 ELSE 1 END AS version FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 2 = 0")
def stored_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches into a stored table: rows of the second replace those of the first, its own latest version counts."""
    store = stores.Store(spark, files.scratch(spark))
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "doc_id", "lang", "n_chars")
    store.upsert(rows.filter("doc_id % 3 != 0").withColumn("version", F.lit(1)), ["version"])
    again = rows.filter("doc_id % 2 = 0").withColumn("version", F.explode(F.array(F.lit(2), F.lit(3))))
    store.upsert(again, ["version"])
    return store.read().select("id", "lang", "n_chars", "version")


@query("""SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 3 = 0 THEN n_regionkey + 100 ELSE n_regionkey END AS n_regionkey, n_nationkey = 6 AS asked FROM nation WHERE n_nationkey % 2 = 0 OR n_nationkey % 3 = 0""")
def stored_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written by key in two batches that overlap, read as a whole and by one key."""
    path = files.scratch(spark)
    rows = table(spark, sf_dir, "nation").withColumn("key", F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))
    files.write_documents(rows.filter("n_nationkey % 2 = 0"), path, "json", "key")
    files.write_documents(rows.filter("n_nationkey % 3 = 0").withColumn("n_regionkey", F.col("n_regionkey") + 100), path, "json", "key")
    one = files.read_documents(spark, path, rows.schema, "006").select("key", F.lit(True).alias("asked"))
    return files.read_documents(spark, path, rows.schema).join(one, "key", "left").select("n_nationkey", "n_name", "n_regionkey", F.coalesce("asked", F.lit(False)).alias("asked"))


@query("""SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 2 END AS stored_version, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 2 END AS document_version, 'applied applied' AS states,
  (SELECT count(*) FROM customer WHERE c_custkey % 3 <> 2) AS first_rows, (SELECT count(*) FROM customer WHERE c_custkey % 3 <> 0) AS second_rows FROM customer""")  # fmt: skip
def committed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches into a table and documents by key: the second one stops between the two and is applied again, the third
    one stops before it is committed and is never seen."""
    path = files.scratch(spark)
    log, store = commits.BatchLog(spark, path), stores.Store(spark, f"{path}/table")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), "c_custkey", "c_name")

    def stopped(_: DataFrame) -> None:
        raise InterruptedError

    def sinks(documents: commits.Sink) -> dict[str, commits.Sink]:
        return {"table": lambda r: store.upsert(r, ["version"]), "documents": documents}

    whole = sinks(lambda r: files.write_documents(r, f"{path}/documents", "json", "id"))
    for version, part in ((1, "c_custkey % 3 <> 2"), (2, "c_custkey % 3 <> 0"), (3, "true")):
        batch = log.begin()
        for name in whole:
            batch.stage(name, rows.filter(part).withColumn("version", F.lit(version)))
        if version < 3:
            batch.commit()
        if version == 1:
            log.apply(batch.number, whole)
        elif version == 2:
            with contextlib.suppress(InterruptedError):
                log.apply(batch.number, sinks(stopped))
        log.recover(lambda _: whole)
    told = log.rows().groupBy("batch", "state").agg(F.max("rows").alias("rows")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("batch", "state"))), lambda b: b["state"]), " ").alias("states"), F.max(F.when(F.col("batch") == 1, F.col("rows"))).alias("first_rows"), F.max(F.when(F.col("batch") == 2, F.col("rows"))).alias("second_rows"))
    documents = files.read_documents(spark, f"{path}/documents", "id string, version int").withColumnRenamed("version", "document_version")
    return store.read().withColumnRenamed("version", "stored_version").join(documents, "id", "full").drop("id").crossJoin(F.broadcast(told))


@query("""SELECT vec_id::VARCHAR AS id, label::VARCHAR AS text, CASE WHEN vec_id % 2 = 0 THEN 'pdf_page' ELSE '' END AS source, 1.0::DOUBLE AS weight_multiplier, 0.9::DOUBLE AS extraction_confidence,
  CASE WHEN vec_id % 3 <> 0 THEN vec_id % 3 WHEN vec_id % 5 <> 0 THEN vec_id % 5 END::INT AS slide_num, vec_id % 7 = 0 AS has_table, 'T-' || (vec_id % 10) AS parent_ticket, 'A' AS parent_quality_tier, len(embedding)::INT AS dim FROM embeddings WHERE vec_id % 4 <> 0""")  # fmt: skip
def fine_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with a vector as rows of the fine index, by way of its stored table."""
    n = F.col("vec_id")
    chunks = table(spark, sf_dir, "embeddings").select(
        n.cast("string").alias("chunk_uid"), F.when(n % 4 != 0, F.col("embedding")).alias("embedding"), F.col("label").cast("string").alias("text"), F.when(n % 2 == 0, "pdf_page").alias("source"), F.lit(None).cast("double").alias("weight_multiplier"), F.lit(0.9).alias("extraction_confidence"),
        (n % 3).cast("int").alias("slide_num"), (n % 5).cast("int").alias("page_num"), F.when(n % 7 == 0, True).alias("has_table"), F.concat(F.lit("T-"), (n % 10).cast("string")).alias("ticket_key"), F.lit("A").alias("quality_tier"),
    )
    store = stores.Tables.create(spark, files.scratch(spark)).fine
    store.upsert(stores.fine_rows(chunks), ["text"])
    return store.read().withColumn("dim", F.size("vector")).drop("vector")


@query(f"""WITH {DESCRIBED}, {TIERED} SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 2 = 0 THEN 'VS-' || (doc_id % 7) ELSE '' END AS streams, doc_id % 2 = 0 AS has_gold_vs, doc_id % 2 = 0 AND quality_tier <> 'D' AS trains_vs,
  doc_id % 5 = 0 AS has_gold_product, doc_id % 5 = 0 AND quality_tier <> 'D' AS trains_product, CASE quality_tier WHEN 'A' THEN 1.0 WHEN 'B' THEN 0.85 WHEN 'C' THEN 0.6 ELSE 0.3 END::DOUBLE AS score FROM tiered""")  # fmt: skip
def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of documents as rows of their own store."""
    n, none = F.col("doc_id"), F.array().cast("array<string>")
    streams = F.when(n % 2 == 0, F.array(F.concat(F.lit("VS-"), (n % 7).cast("string")))).otherwise(none)
    products = F.struct(F.when(n % 5 == 0, F.array("source")).otherwise(none).alias("names"))
    rows = tiered(spark, sf_dir).select(n.cast("string").alias("ticket_key"), "quality_tier", streams.alias("linked_value_stream_ids"), products.alias("impacted_products"), summaries.tier_weight(F.col("quality_tier")).alias("source_quality_score"))
    store = stores.Tables.create(spark, files.scratch(spark)).supervision
    store.upsert(stores.supervision_rows(rows), ["id"])
    t = lambda c: F.col(f"trainability.{c}")
    return store.read().select("id", F.array_join("linked_value_stream_ids", "|").alias("streams"), t("has_gold_vs_labels").alias("has_gold_vs"), t("is_trainable_for_vs").alias("trains_vs"), t("has_gold_product_labels").alias("has_gold_product"), t("is_trainable_for_products").alias("trains_product"), t("source_quality_score").alias("score"))


@query("""SELECT p_partkey::VARCHAR AS id, p_name AS metadata_text, p_brand AS component, p_type AS business_unit, p_name || ' in short' AS summary_text FROM part""")
def metadata_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("ticket_key"), F.col("p_name").alias("metadata_text"), F.array("p_brand").alias("components"), F.col("p_type").alias("business_unit"), F.concat("p_name", F.lit(" in short")).alias("summary_text"), F.lit(1).alias("other"))
    store = stores.Tables.create(spark, files.scratch(spark)).metadata
    store.upsert(stores.metadata_rows(rows), ["metadata_text"])
    return store.read().select("id", "metadata_text", F.array_join("components", "|").alias("component"), "business_unit", "summary_text")


@query("""WITH c AS (SELECT conv_id, turn, text, role, turn % 4 = 3 AS s FROM conversations)
SELECT conv_id AS ticket_key, count(*) FILTER (NOT s) AS chunk_count, count(*) FILTER (s) AS section_count, coalesce(sum(CASE WHEN NOT s THEN length(text) ELSE 0 END), 0)::BIGINT AS total_word_count, bool_or(turn % 6 = 5) AS has_tables, bool_or(turn = 2) AS has_speaker_notes,
  count(*) FILTER (turn % 2 = 0) AS entity_mention_count, count(*) FILTER (turn % 4 = 0) AS entity_product_count, count(*) FILTER (turn % 4 = 2) AS entity_capability_count, count(*) FILTER (role = 'user') AS comment_count, count(*) FILTER (role = 'user' AND turn > 2) AS substantive_comment_count FROM c GROUP BY conv_id""")  # fmt: skip
def record_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "ticket_key")
    n = F.col("turn")
    chunks = turns.select("ticket_key", F.when(n % 4 == 3, "section").otherwise("description").alias("source"), F.length("text").alias("word_count"), (n % 6 == 5).alias("has_table"), (n == 2).alias("has_notes"))
    mentions = turns.filter("turn % 2 = 0").select("ticket_key", F.when(n % 4 == 0, "products").otherwise("capabilities").alias("etype"))
    said = turns.filter("role = 'user'").select("ticket_key", (n > 2).alias("is_substantive"))
    return reports.record_stats(chunks, mentions, said)


@query("""SELECT conv_id, md5(string_agg(t, chr(10) ORDER BY turn)) AS text_md5, count(*) FILTER (turn % 3 <> 1) AS content_chunks, sum(CASE WHEN turn % 5 = 0 THEN 2 ELSE 0 END)::BIGINT AS template_hits
FROM (SELECT *, CASE WHEN turn % 5 = 0 THEN text || ' Click to add, click to add, LOREM IPSUM' ELSE text END AS t FROM conversations) GROUP BY conv_id""")  # fmt: skip
def text_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("turn") % 5 == 0, F.concat("text", F.lit(" Click to add, click to add, LOREM IPSUM"))).otherwise(F.col("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("pos"), text.alias("text"), F.when(F.col("turn") % 3 == 1, True).alias("is_boilerplate"))
    return reports.text_volume(rows, ["conv_id"]).select("conv_id", F.md5("text").alias("text_md5"), "content_chunks", "template_hits")


@query("SELECT DISTINCT 'file-' || (conv_id % 50) AS attachment_name FROM conversations WHERE role <> 'user'")
def attachment_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("role") != "user", F.concat(F.lit("file-"), (F.col("conv_id") % 50).cast("string"))).otherwise("")
    return reports.attachment_refs(table(spark, sf_dir, "conversations").select(name.alias("attachment_name")))


@query("SELECT source AS ticket_key, count(*) AS documents FROM documents WHERE source IS NOT NULL GROUP BY source UNION ALL SELECT NULL, count(*) FROM documents")
def stored_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.store_summary(table(spark, sf_dir, "documents").select(F.col("source").alias("ticket_key")))


@query("""WITH a AS (SELECT page_id // 5 AS k, count(*) AS n, sum(length(html)) AS b FROM pages GROUP BY k), l AS (SELECT c_custkey % 60 AS k, count(*) AS n FROM customer GROUP BY k)
SELECT coalesce(a.k, l.k) AS ticket_key, coalesce(a.n, 0) AS attachments, coalesce(a.b, 0)::BIGINT AS bytes, coalesce(l.n, 0) AS links FROM a FULL JOIN l ON a.k = l.k""")  # fmt: skip
def attachment_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "pages").select(F.floor(F.col("page_id") / 5).alias("ticket_key"), F.length("html").cast("long").alias("size"))
    return reports.size_totals(sizes, table(spark, sf_dir, "customer").select((F.col("c_custkey") % 60).alias("ticket_key")))


@query("SELECT o_custkey AS key, min(o_orderkey) AS pos FROM orders GROUP BY o_custkey")
def ordered_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.distinct_in_order(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("pos")))


PLAN = "(doc_role IN ('primary_idea_card', 'primary_fallback', 'supporting_doc'))"


@query(f"""WITH {TRIAGED}, plan AS (SELECT *, coalesce({PLAN}, false) AS kept, coalesce(extracted, false) AS e, doc_role = 'excluded_noise' AS noise FROM roles),
lists AS (SELECT ticket_key, list(id ORDER BY place) FILTER (kept AND e) AS f, list(id ORDER BY place) FILTER (NOT (kept AND e) AND coalesce(NOT noise, true) AND score > 10) AS l, list(id ORDER BY place) FILTER (kept) AS c FROM plan GROUP BY ticket_key)
SELECT r.ticket_key, coalesce(array_to_string(f, '|'), '') AS full_extract, coalesce(array_to_string(l, '|'), '') AS light_extract, coalesce(array_to_string(c, '|'), '') AS chunk_candidates
FROM (SELECT DISTINCT ticket_key FROM reasons) r LEFT JOIN lists ON r.ticket_key = lists.ticket_key""")  # fmt: skip
def processing_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is to be done with each record's attachments: extracted in full or lightly, made into chunks."""
    rows = triage.artifact(triage.triage(attachments(spark, sf_dir)))
    return rows.select("ticket_key", *[F.array_join(c, "|").alias(c) for c in ("full_extract", "light_extract", "chunk_candidates")])


@query("""WITH q AS (SELECT vec_id AS query_id, embedding AS e FROM embeddings WHERE vec_id % 100 = 3), n AS (SELECT vec_id, label, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) + 1e-9 AS norm FROM embeddings),
s AS (SELECT query_id, n.vec_id, n.label, list_sum(list_transform(list_zip(n.embedding, q.e), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)) / (n.norm * m.norm) AS score FROM n, q JOIN n m ON m.vec_id = q.query_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id DESC) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, label FROM r WHERE rank <= 3""")  # fmt: skip
def search_with_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors of a set of queries, with the records they belong to."""
    index = table(spark, sf_dir, "embeddings")
    asked = index.filter("vec_id % 100 = 3").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    found = vectors.top_k_of_all(index, asked, 3, "vec_id")
    return vectors.with_records(found, index.select("vec_id", "label"), "vec_id").select("query_id", "rank", "vec_id", "label")


@query("""WITH cells AS (SELECT n_regionkey, list(n_name || '' ORDER BY n_nationkey) AS names, list(n_nationkey ORDER BY n_nationkey) AS keys, count(*)::INT AS n FROM nation GROUP BY n_regionkey)
SELECT n_regionkey, 'Columns: name | key' || chr(10) || array_to_string(list_transform(names, lambda x, i: 'Row ' || i || ': name: ' || x || ' | key: ' || keys[i]), chr(10)) AS full_text,
  'Table with columns: name, key (e.g. ' || names[1] || '; ' || keys[1] || ')' AS summary, n AS row_count, 2 AS col_count FROM cells""")  # fmt: skip
def markdown_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.plans.queries import table_parse

    return table_parse(spark, sf_dir)


@query(f"""WITH {ATTACHMENTS}, r AS (SELECT DISTINCT ticket_key FROM reasons), c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id), {DESCRIBED}
SELECT 'DOC-' || doc_id AS ticket_key, desc_class, coalesce(c.n, 0) AS comment_count, 'DOC-' || doc_id || ': ' || source AS title,
  md5('DOC-' || doc_id || ': ' || source || '. Type: Idea. Status: Open. Components: ' || source || '. Labels: ' || lang || '. Reporter: ' || lang) AS metadata_md5, 'VS-' || (doc_id % 7) AS stream, lang AS stream_name
FROM described LEFT JOIN c ON c.conv_id = doc_id""")  # fmt: skip
def record_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records through the whole assembly: what their documents say of themselves, and their labels, which are apart."""
    from tessera.plans.queries import document_record, phrases_raw

    stages = assembly.assemble(document_record(spark, sf_dir), phrases_raw(spark, sf_dir), ingested_at=F.lit("2024-04-01T00:00:00Z"), keep=lambda _, rows: files.stored(rows))
    labels = stages.supervision.select(F.col("id").alias("ticket_key"), F.array_join(F.transform(F.col("linked_value_stream_ids"), lambda x: x), "|").alias("stream"))
    classified = stages.links.filter("category = 'vs'").select("ticket_key", F.col("key").alias("stream"), F.col("summary").alias("stream_name"))
    rows = stages.documents.select("ticket_key", "desc_class", "comment_count", "title", F.md5("metadata_text").alias("metadata_md5"))
    return rows.join(labels, "ticket_key").join(classified, ["ticket_key", "stream"])
