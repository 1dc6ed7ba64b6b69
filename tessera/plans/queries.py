"""The registered queries: each applies operators to whole tables; ``ORACLE_SQL`` says the same for a SQL engine."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import cleaning, markdown
from tessera.functions import fields as fd
from tessera.functions import text as tx
from tessera.operators import chunking, entities, extract, nearest, records, reports, stores, summaries, triage, vectors
from tessera.sources import files
from tessera.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Pieces of SQL that several oracles share.
CLEANED = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
  '\{code.*?\}.*?\{code\}|\{panel.*?\}.*?\{panel\}|\{noformat.*?\}.*?\{noformat\}|\{[a-z]+[^}]*\}', '', 'gis'),
  '^h[1-6]\.', '', 'gm'), '\|\|.*?\|\||\|.*?\|', ' ', 'g'), '[*_]{1,2}(.+?)[*_]{1,2}', '\1', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"""
WORDS = lambda c: rf"len(regexp_extract_all({c}, '\S+'))"
JUNK = r"^(please see attach|see attached|\[insert .+\]|as discussed|see confluence|details in the deck|refer to the attached|attached|(tbd|todo|n/a|none)$)"
CLASS = f"""CASE WHEN cleaned = '' THEN 'empty' WHEN words < 10 OR regexp_matches(lower(cleaned), '{JUNK}') THEN 'junk'
  WHEN words < 50 THEN 'thin' WHEN words < 150 THEN 'usable' ELSE 'rich' END"""
DESCRIBED = f"""described AS (SELECT *, {CLASS} AS desc_class FROM (SELECT *, {WORDS("cleaned")} AS words FROM
  (SELECT doc_id, source, lang, text, {CLEANED} AS cleaned FROM documents)))"""


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text").withColumn("cleaned", tx.strip_markup(F.col("text")))
    rows = rows.withColumn("words", tx.word_count(F.col("cleaned")))
    return rows.withColumn("desc_class", tx.description_class(F.col("cleaned"), F.col("words")))


@query(f"WITH {DESCRIBED} SELECT doc_id, words, desc_class, md5(cleaned) AS cleaned_md5 FROM described")
def description_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return described(spark, sf_dir).select("doc_id", "words", "desc_class", F.md5("cleaned").alias("cleaned_md5"))


TIERED = """tiered AS (SELECT *, CASE WHEN doc_id % 3 = 0 AND desc_class IN ('usable', 'rich') THEN 'A' WHEN doc_id % 3 = 0 THEN 'B'
  WHEN desc_class IN ('thin', 'usable', 'rich') THEN 'C' ELSE 'D' END AS quality_tier FROM described)"""


def tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a tier; every third one counts as having an attachment, and a description as one chunk."""
    return described(spark, sf_dir).withColumn("quality_tier", summaries.quality_tier(F.col("doc_id") % 3 == 0, F.col("desc_class"), F.lit(1)))


@query(f"""WITH {DESCRIBED}, {TIERED} SELECT quality_tier, desc_class, count(*) AS n, count(l.doc_id) AS labelled, coalesce(sum(l.quality), 0)::BIGINT AS good
  FROM tiered t LEFT JOIN labels l ON t.doc_id = l.doc_id GROUP BY ALL""")  # fmt: skip
def quality_tier_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", F.lit(1).alias("has"))
    joined = tiered(spark, sf_dir).select("doc_id", "quality_tier", "desc_class").join(labels, "doc_id", "left")
    return joined.groupBy("quality_tier", "desc_class").agg(F.count("*").alias("n"), F.count("has").alias("labelled"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"))


@query(f"""WITH {DESCRIBED}, parts AS (
  SELECT *, list_filter(list_transform(string_split(cleaned, chr(10)), lambda p: trim(p)), lambda p: {WORDS("p")} >= 10) AS ps FROM described),
lists AS (SELECT doc_id, CASE
  WHEN doc_id % 3 = 0 AND desc_class IN ('usable', 'rich') THEN [{{'t': cleaned, 'w': 0.7::DOUBLE}}]
  WHEN doc_id % 3 = 0 THEN []
  WHEN desc_class = 'rich' AND len(ps) > 0 THEN list_transform(ps, lambda p, i: {{'t': CASE WHEN i = 1 THEN source || chr(10) || chr(10) || p ELSE p END, 'w': 1.0::DOUBLE}})
  WHEN desc_class IN ('rich', 'usable') THEN [{{'t': source || chr(10) || chr(10) || cleaned, 'w': 1.0::DOUBLE}}]
  WHEN desc_class = 'thin' THEN [{{'t': source || chr(10) || chr(10) || cleaned || chr(10) || chr(10) || 'Labels: ' || lang, 'w': 0.8::DOUBLE}}]
  ELSE [] END AS c FROM parts)
SELECT doc_id, (i - 1)::INT AS pos, md5(u.t) AS text_md5, {WORDS("u.t")} AS word_count, u.w AS weight_multiplier
FROM (SELECT doc_id, unnest(c) AS u, generate_subscripts(c, 1) AS i FROM lists)""")  # fmt: skip
def description_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = described(spark, sf_dir).select(F.col("doc_id").alias("ticket_key"), F.col("source").alias("summary"), F.col("cleaned").alias("text"), "desc_class", (F.col("doc_id") % 3 == 0).alias("has_attachment"), F.concat(F.lit("Labels: "), "lang").alias("scaffold"))
    return chunking.description_chunks(rows, separator="\n").select(F.col("ticket_key").alias("doc_id"), "pos", F.md5("text").alias("text_md5"), "word_count", "weight_multiplier")


PACKED = f"""WITH ps AS (
  SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda p: trim(p)), lambda p: p <> '') AS p FROM documents),
state AS (SELECT doc_id, list_reduce(list_transform(p, lambda x: {{'done': []::STRUCT(t VARCHAR, n BIGINT)[], 't': x, 'n': {WORDS("x")}}}),
  lambda a, b: CASE WHEN a.n + b.n > 400 THEN {{'done': list_append(a.done, {{'t': a.t, 'n': a.n}}), 't': b.t, 'n': b.n}}
    ELSE {{'done': a.done, 't': a.t || chr(10) || chr(10) || b.t, 'n': a.n + b.n}} END) AS s FROM ps WHERE len(p) > 0),
packs AS (SELECT doc_id, list_filter(list_append(s.done, {{'t': s.t, 'n': s.n}}), lambda c: c.n >= 40) AS c FROM state)
SELECT doc_id, i::INT AS page_num, u.n::INT AS word_count, md5(u.t) AS text_md5 FROM (SELECT doc_id, unnest(c) AS u, generate_subscripts(c, 1) AS i FROM packs)"""  # fmt: skip


@query(PACKED)
def packed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chunking.packed(table(spark, sf_dir, "documents").select("doc_id", "text"), separator="\n")
    return rows.select("doc_id", "page_num", "word_count", F.md5("text").alias("text_md5"))


@query(PACKED)
def packed_long_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages by jumps over blocks of paragraphs."""
    rows = chunking.packed_long(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], separator="\n")
    return rows.select("doc_id", "page_num", "word_count", F.md5("text").alias("text_md5"))


AGENDA = "agenda|outline|overview|introduction|background|problem|solution|approach|implementation|timeline|next steps|conclusion|summary|appendix"
SECTIONS = lambda key, source: rf"""WITH slides AS ({source}),
flags AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY pos) AS rn,
  (regexp_matches(title, '^[A-Z][^.?!,;]{{0,49}}$') AND {WORDS("title")} <= 6) OR regexp_matches(lower(trim(title)), '^({AGENDA})') AS starts FROM slides),
islands AS (SELECT *, sum(CASE WHEN starts AND rn > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY pos ROWS UNBOUNDED PRECEDING) AS island FROM flags),
sized AS (SELECT *, max(island) OVER (PARTITION BY {key}) + 1 AS islands, count(*) OVER (PARTITION BY {key}) AS total FROM islands),
grouped AS (SELECT *, islands <= 1 AND total >= 8 AS fallback, (CASE WHEN islands <= 1 AND total >= 8 THEN (rn - 1) // 4 ELSE island END)::INT AS section FROM sized)
SELECT {key}, section, child_slide_count, section_title, md5('## Section: ' || section_title || coalesce(chr(10) || chr(10) || body, '')) AS text_md5 FROM (
SELECT {key}, section, section_title, count(*)::INT AS child_slide_count, string_agg(nullif(trim(text), ''), chr(10) || chr(10) ORDER BY pos) AS body
FROM (SELECT *, CASE WHEN fallback THEN coalesce(first_value(nullif(title, '')) OVER (PARTITION BY {key}, section ORDER BY pos), 'Section ' || (section + 1))
  ELSE coalesce(first_value(nullif(title, '') IGNORE NULLS) OVER (PARTITION BY {key}, section ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 'Untitled Section') END AS section_title FROM grouped)
GROUP BY {key}, section, section_title)"""  # noqa: E731


@query(SECTIONS("conv_id", "SELECT conv_id, turn AS pos, text, CASE WHEN turn % 3 = 0 THEN 'Overview ' || role ELSE left(text, 60) END AS title FROM conversations"))
def section_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("Overview "), "role")).otherwise(F.substring("text", 1, 60))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("pos"), "text", title.alias("slide_title"))
    return chunking.sections(rows, ["conv_id"]).select("conv_id", "section", "child_slide_count", "section_title", F.md5("text").alias("text_md5"))


@query(SECTIONS("doc_id", "SELECT doc_id, (i - 1) AS pos, l AS text, '' AS title FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)"))
def fallback_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text")).withColumn("slide_title", F.lit(""))
    return chunking.sections(rows, ["doc_id"]).select("doc_id", "section", "child_slide_count", "section_title", F.md5("text").alias("text_md5"))


COMMENTS = rf"""flags AS (SELECT *, words >= 50 AND NOT chatter AS is_substantive FROM (
  SELECT *, {WORDS("text")} AS words, {WORDS("cleaned")} < 10 OR regexp_matches(cleaned, '^(moved|transitioned|changed status|updated|assigned|resolved|closed|reopened)\b', 'i')
    OR regexp_matches(cleaned, '^(done|ok|ack|acknowledged|noted|thanks|cheers|\+1|-1|approved|lgtm)\W*$', 'i')
    OR regexp_matches(cleaned, '^\s*(see attached|see comments|see above|as per|per above|as discussed)\b', 'i') OR regexp_matches(cleaned, '^(sent|forwarded|cc:|fyi\b)', 'i') AS chatter
  FROM (SELECT conv_id, turn, role, text, {CLEANED} AS cleaned FROM conversations)))"""


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").filter(~tx.is_bot(F.col("role")))
    return records.comment_flags(rows.select(F.col("conv_id").alias("ticket_key"), F.col("turn").alias("pos"), "role", F.col("text").alias("body_raw")))


@query(f"WITH {COMMENTS} SELECT conv_id, turn, words::INT AS word_count, is_substantive, md5(cleaned) AS cleaned_md5 FROM flags")
def substantive_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).select(F.col("ticket_key").alias("conv_id"), F.col("pos").alias("turn"), "word_count", "is_substantive", F.md5("body_cleaned").alias("cleaned_md5"))


@query(f"""WITH {COMMENTS}, spans AS (SELECT conv_id, turn, list_filter(list_transform(string_split(cleaned, '.'), lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), lambda s: {WORDS("s")} >= 8)[1:2] AS s FROM flags WHERE is_substantive)
SELECT f.conv_id, count(*) AS comment_count, count(*) FILTER (f.is_substantive) AS substantive_count,
  md5(coalesce(array_to_string(flatten(list(s.s ORDER BY f.turn) FILTER (s.s IS NOT NULL))[1:10], '|'), '')) AS spans_md5
FROM flags f LEFT JOIN spans s ON f.conv_id = s.conv_id AND f.turn = s.turn GROUP BY f.conv_id""")  # fmt: skip
def key_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records.comment_summary(turns(spark, sf_dir))
    return rows.select(F.col("ticket_key").alias("conv_id"), "comment_count", "substantive_count", F.md5(F.array_join("important_spans", "|")).alias("spans_md5"))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first sentence of each benchmark item, as a dictionary."""
    first = F.get(F.split("text", r"\."), F.lit(0))
    rows = table(spark, sf_dir, "benchmark").filter(first != "").select(F.lit("products").alias("etype"), F.col("item_id").cast("string").alias("canonical"), F.array(first).alias("aliases"), F.col("item_id").alias("ord"))
    return entities.dictionary(rows).filter("length(term) > 8")


@query(r"""WITH terms AS (SELECT lower(string_split(text, '.')[1]) AS term, item_id::VARCHAR AS canonical, item_id AS ord FROM benchmark),
last AS (SELECT term, arg_max(canonical, ord) AS canonical FROM terms WHERE length(term) > 8 GROUP BY term)
SELECT doc_id, 'products' AS etype, canonical AS term, 0.8::DOUBLE AS confidence FROM documents d JOIN last l ON contains(lower(d.text), l.term)
  AND regexp_matches(lower(d.text), '(^|[^\pL\pN_])' || regexp_escape(l.term) || '($|[^\pL\pN_])') GROUP BY ALL""")  # fmt: skip
def dictionary_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("pos"), "text")
    found = entities.text_mentions(texts, phrases(spark, sf_dir), ["doc_id"], ["pos"])
    return entities.best_mentions(found, ["doc_id"], ["pos"]).select("doc_id", "etype", "term", "confidence")


@query(r"""WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\pL\pM\pN\p{Pc}]+')) AS word FROM documents), df AS (SELECT word, count(*) AS n FROM w GROUP BY word),
t AS (SELECT DISTINCT lower(string_split(text, '.')[1]) AS term FROM benchmark WHERE length(string_split(text, '.')[1]) > 8), tw AS (SELECT DISTINCT term, unnest(regexp_extract_all(term, '[\pL\pM\pN\p{Pc}]+')) AS word FROM t)
SELECT term, arg_min(word, (n, word)) AS word, min(n) AS texts FROM tw LEFT JOIN df USING (word) GROUP BY term HAVING count(n) = count(*)""")  # fmt: skip
def rarest_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word of each term by which it meets the documents: the one that the fewest hold."""
    return entities.rarest_words(table(spark, sf_dir, "documents").select("text"), phrases(spark, sf_dir)).select("term", "word", "texts")


@query("""WITH dict AS (SELECT DISTINCT lower(p_type) AS term, p_type AS canonical FROM part UNION SELECT DISTINCT lower(split_part(p_name, ' ', 2)), upper(split_part(p_name, ' ', 2)) FROM part)
SELECT p_partkey, i::INT AS pos, d.canonical AS term, 1.0::DOUBLE AS confidence FROM (SELECT p_partkey, unnest([p_type, split_part(p_name, ' ', 2)]) AS c, generate_subscripts([1, 2], 1) - 1 AS i FROM part) x JOIN dict d ON lower(x.c) = d.term""")  # fmt: skip
def component_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", F.split_part("p_name", F.lit(" "), F.lit(2)).alias("noun"))
    names = part.select(F.col("p_type").alias("canonical")).union(part.select(F.upper("noun"))).distinct()
    terms = entities.dictionary(names.select(F.lit("products").alias("etype"), "canonical", F.array().cast("array<string>").alias("aliases"), F.lit(0).alias("ord")))
    rows = part.select("p_partkey", F.posexplode(F.array("p_type", "noun")).alias("pos", "component"))
    return entities.component_mentions(rows, terms, ["p_partkey"]).select("p_partkey", "pos", "term", "confidence")


TERMS = ("the", "and", "that", "this", "with", "are", "for", "from", "was", "les", "des", "der", "die", "und", "los", "con")
SIMPLE = "regexp_extract_all(lower(text), '[a-z0-9]+')"


@query(f"""WITH w AS (SELECT doc_id, {SIMPLE} AS words FROM documents)
SELECT doc_id, len(words)::INT AS n_words, len(list_intersect(list_distinct(words), {list(TERMS)}))::INT AS signals,
  CASE WHEN len(words) = 0 THEN 0.0::DOUBLE ELSE round_even(least(1.0::DOUBLE, 0.65::DOUBLE * len(list_distinct(words)) / len(words) + 0.35::DOUBLE * least(1.0::DOUBLE, len(list_intersect(list_distinct(words), {list(TERMS)})) / 10.0::DOUBLE)), 4) END AS density FROM w""")  # fmt: skip
def signal_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", tx.simple_words(F.col("text")).alias("w"))
    return rows.select("doc_id", F.size("w").alias("n_words"), tx.business_signals(F.col("w"), TERMS).alias("signals"), tx.semantic_density(F.col("w"), TERMS).alias("density"))


#: Pages as attachments: names and sizes by number, five of them a record; the same in Spark and in SQL.
STEMS = ("idea card final", "project-template", "roadmap v2", "budget_2024", "idea card final", "business case deck", "old backup copy", "pitch", "screenshot", "value stream notes")
EXTS = ("pptx", "ppt", "pdf", "docx", "doc", "xlsx", "csv", "png", "zip", "html")


def attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("page_id")
    pick = lambda values, at: F.element_at(F.array(*map(F.lit, values)), (at % len(values) + 1).cast("int"))
    name = F.concat(pick(STEMS, n * 7 + F.floor(n / 10)), F.lit("."), pick(EXTS, n))
    return table(spark, sf_dir, "pages").select(
        F.floor(n / 5).alias("ticket_key"), (n % 5).alias("pos"), n.cast("string").alias("id"), name.alias("filename"), (F.length("html") * 20).cast("long").alias("size"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (n * 37 % 300).cast("int")), "yyyy-MM-dd").alias("created"), F.lit("pitch for the value stream roadmap").alias("summary"),
        F.when(n % 4 == 0, n % 3 == 0).alias("peek_idea"), F.when(n % 4 == 0, n % 8 == 0).alias("peek_template"), F.when(n % 4 == 0, (n % 9).cast("int")).alias("slide_count"), F.lit(None).cast("int").alias("peek_words"),
        F.when(n % 2 == 0, True).alias("extracted"), F.when(n % 2 == 0, (n % 200).cast("int")).alias("word_count"), F.when(n % 2 == 0, (n % 6).cast("int")).alias("signals"),
        F.when(n % 2 == 0, (n % 50) / 100.0).alias("density"), F.when(n % 2 == 0, (n % 3).cast("int")).alias("template_hits"), F.when(n % 2 == 0, (n % 4).cast("int")).alias("content_chunks"),
    )


def _points_sql() -> str:
    return " + ".join(f"CASE WHEN regexp_matches(fn, '{p}') THEN {n} ELSE 0 END" for p, n in triage.NAME_POINTS)


def _case(key: str, values: dict, otherwise: float) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in values.items()) + f" ELSE {otherwise}::DOUBLE END"


def _scores_sql(source: str, score: str, sure: str) -> str:
    """The four scores of rows of a relation, as further columns."""
    q = f"(CASE WHEN ext = 'pdf' AND size >= 500000 THEN least(0.86::DOUBLE, {_case('ext', triage.BASE_QUALITY, 0.5)} + 0.06::DOUBLE) ELSE {_case('ext', triage.BASE_QUALITY, 0.5)} END)"
    q = f"(CASE WHEN coalesce(extracted, false) AND coalesce(word_count, 0) >= 80 THEN least(0.95::DOUBLE, {q} + 0.05::DOUBLE) ELSE {q} END)"
    own, guess = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(density, 0.0::DOUBLE)))", f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, {score}::DOUBLE / 100.0::DOUBLE))"
    d = f"(CASE WHEN {own} <> 0 THEN {own} WHEN coalesce(peek_idea, false) THEN least(1.0::DOUBLE, {guess} + 0.15::DOUBLE) ELSE {guess} END)"
    like = f"(CASE WHEN {sure} THEN 0.92::DOUBLE WHEN coalesce(peek_idea, false) THEN 0.70::DOUBLE WHEN {score} >= 40 THEN 0.55::DOUBLE WHEN {score} >= 20 THEN 0.35::DOUBLE ELSE 0.15::DOUBLE END)"
    like = f"(CASE WHEN ext IN ('pptx', 'ppt') THEN least(1.0::DOUBLE, {like} + 0.05::DOUBLE) ELSE {like} END)"
    return f"""SELECT * EXCLUDE (q_, d_, l_), round(q_, 4) AS extraction_quality, round(d_, 4) AS semantic_density, round(l_, 4) AS idea_card_likeness,
      round(0.30::DOUBLE * q_ + 0.30::DOUBLE * d_ + 0.40::DOUBLE * l_, 4) AS retrieval_readiness FROM (SELECT *, {q} AS q_, {d} AS d_, {like} AS l_ FROM {source})"""


def _ranked_sql(source: str, score: str, place: str) -> str:
    return f"SELECT *, row_number() OVER (PARTITION BY ticket_key ORDER BY {score} DESC, confirmed DESC, retrieval_readiness DESC, idea_card_likeness DESC, pos) AS {place} FROM ({source})"


def _view(name: str) -> str:
    """Drops the score columns, which the next stage makes anew."""
    return f"(SELECT * EXCLUDE (extraction_quality, semantic_density, idea_card_likeness, retrieval_readiness) FROM {name})"


ATTACHMENTS = f"""att AS (SELECT page_id // 5 AS ticket_key, page_id % 5 AS pos, page_id::VARCHAR AS id,
  {list(STEMS)}[((page_id * 7 + page_id // 10) % 10 + 1)::INT] || '.' || {list(EXTS)}[(page_id % 10 + 1)::INT] AS filename, (length(html) * 20)::BIGINT AS size,
  strftime(DATE '2024-01-01' + (page_id * 37 % 300)::INT, '%Y-%m-%d') AS created,
  CASE WHEN page_id % 4 = 0 THEN page_id % 3 = 0 END AS peek_idea, CASE WHEN page_id % 4 = 0 THEN page_id % 8 = 0 END AS peek_template, CASE WHEN page_id % 4 = 0 THEN page_id % 9 END AS slide_count,
  CASE WHEN page_id % 2 = 0 THEN true END AS extracted, CASE WHEN page_id % 2 = 0 THEN page_id % 200 END AS word_count, CASE WHEN page_id % 2 = 0 THEN page_id % 6 END AS signals,
  CASE WHEN page_id % 2 = 0 THEN (page_id % 50)::DOUBLE / 100.0::DOUBLE END AS density, CASE WHEN page_id % 2 = 0 THEN page_id % 3 END AS template_hits, CASE WHEN page_id % 2 = 0 THEN page_id % 4 END AS content_chunks
  FROM pages),
named AS (SELECT *, lower(filename) AS fn, regexp_extract(lower(filename), '\\.([^.]*)$', 1) AS ext, trim(regexp_replace(regexp_replace(lower(filename), '\\.[^.]*$', ''), '[^a-z0-9]+', ' ', 'g')) AS stem FROM att),
reasons AS (SELECT *, CASE WHEN ext IN {triage.KILLED} THEN 'excluded extension: ' || ext WHEN ext NOT IN {tuple(triage.BONUS)} THEN 'non-extractable extension: ' || ext
  WHEN size > 0 AND size < 15000 THEN 'file too small' WHEN ext = 'pdf' AND size > 80000000 THEN 'pdf too large' WHEN size > 100000000 THEN 'file too large' END AS excluded FROM named),
live AS (SELECT * EXCLUDE excluded FROM reasons WHERE excluded IS NULL),
asked AS (SELECT *, regexp_extract_all(fn, '[a-z0-9]+') AS nw, len(list_intersect(list_distinct(regexp_extract_all(fn, '[a-z0-9]+')), ['pitch', 'for', 'the', 'value', 'stream', 'roadmap'])) AS shared FROM live),
l1 AS (SELECT * EXCLUDE (nw, shared), false AS confirmed, {_points_sql()} + ({_case('ext', triage.BONUS, 0)})::INT + CASE WHEN shared >= 2 THEN least(20, 5 * shared) ELSE 0 END
  + CASE WHEN row_number() OVER (PARTITION BY ticket_key ORDER BY created DESC, pos) = 1 THEN 5 ELSE 0 END - CASE WHEN count(*) OVER (PARTITION BY ticket_key, stem) > 1 THEN 10 ELSE 0 END
  + CASE WHEN len(nw) BETWEEN 2 AND 6 THEN 8 ELSE 0 END AS score_l1 FROM asked)"""
TRIAGED = f"""{ATTACHMENTS},
p1 AS ({_ranked_sql(_scores_sql("l1", "score_l1", "false"), "score_l1", "place_l1")}),
peeked AS (SELECT * REPLACE (CASE WHEN place_l1 <= 5 THEN peek_idea END AS peek_idea, CASE WHEN place_l1 <= 5 THEN peek_template END AS peek_template, CASE WHEN place_l1 <= 5 THEN slide_count END AS slide_count) FROM {_view("p1")}),
l2 AS (SELECT *, score_l1 + CASE WHEN coalesce(peek_idea, false) THEN 20 ELSE 0 END + CASE WHEN coalesce(peek_template, false) THEN -30 ELSE 0 END + CASE WHEN coalesce(slide_count, 0) >= 5 THEN 8 ELSE 0 END AS score_l2 FROM peeked),
p2 AS ({_ranked_sql(_scores_sql("l2", "score_l2", "false"), "score_l2", "place_l2")}),
wanted AS (SELECT *, place_l2 = 1 OR score_l2 >= 40 OR coalesce(peek_idea, false) OR (ext IN ('pdf', 'docx', 'doc') AND score_l2 >= 25) AS w FROM {_view("p2")}),
full_ AS (SELECT *, w AND row_number() OVER (PARTITION BY ticket_key, w ORDER BY place_l2) <= 5 AS f FROM wanted),
found AS (SELECT * REPLACE (CASE WHEN f THEN extracted END AS extracted, CASE WHEN f THEN word_count END AS word_count, CASE WHEN f THEN signals END AS signals, CASE WHEN f THEN density END AS density, CASE WHEN f THEN template_hits END AS template_hits, CASE WHEN f THEN content_chunks END AS content_chunks) FROM full_),
sure AS (SELECT * REPLACE (coalesce(extracted AND word_count >= 80 AND template_hits < 2 AND content_chunks >= 2 AND signals >= 3, false) AS confirmed), coalesce(template_hits >= 2, false) AS likely_template FROM found),
l3 AS (SELECT *, score_l2 + CASE WHEN coalesce(extracted, false) THEN CASE WHEN confirmed THEN 25 ELSE 0 END + CASE WHEN signals >= 4 THEN 10 ELSE 0 END + CASE WHEN density >= 0.18 THEN 8 ELSE 0 END - CASE WHEN likely_template THEN 25 ELSE 0 END ELSE 0 END AS score FROM sure),
p3 AS ({_ranked_sql(_scores_sql("l3", "score", "confirmed"), "score", "place")}),
worthy AS (SELECT *, NOT likely_template AND (confirmed OR (coalesce(word_count, 0) >= 40 AND retrieval_readiness >= 0.35) OR (score >= 35 AND ext IN ('pptx', 'ppt', 'pdf', 'docx', 'doc'))) AS ok FROM p3),
firsts AS (SELECT *, row_number() OVER (PARTITION BY ticket_key ORDER BY CASE WHEN confirmed THEN 0 WHEN ok THEN 1 ELSE 2 END, idea_card_likeness DESC, retrieval_readiness DESC, score DESC, place) = 1 AS prim FROM worthy),
may AS (SELECT *, ok AND NOT prim AS m FROM firsts),
once AS (SELECT *, m AND row_number() OVER (PARTITION BY ticket_key, stem, m ORDER BY place) = 1 AS o FROM may),
supports AS (SELECT *, o AND row_number() OVER (PARTITION BY ticket_key, o ORDER BY place) <= 4 AS s FROM once),
roles AS (SELECT *, CASE WHEN prim THEN CASE WHEN confirmed THEN 'primary_idea_card' ELSE 'primary_fallback' END WHEN s THEN 'supporting_doc' WHEN score <= 0 OR likely_template THEN 'excluded_noise' END AS doc_role FROM supports)"""


@query(f"""WITH {TRIAGED} SELECT r.ticket_key, r.id, r.ext, r.excluded AS excluded_reason_l0, t.score_l1::INT AS score_l1, t.score::INT AS score, t.place::INT AS place, t.f AS full_extract,
  CASE WHEN r.excluded IS NOT NULL THEN 'excluded_noise' ELSE t.doc_role END AS doc_role, t.confirmed FROM reasons r LEFT JOIN roles t ON r.id = t.id""")  # fmt: skip
def filename_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = triage.triage(attachments(spark, sf_dir))
    return rows.select("ticket_key", "id", "ext", F.when(F.col("score").isNull(), F.col("excluded_reason")).alias("excluded_reason_l0"), "score_l1", "score", "place", "full_extract", "doc_role", "confirmed")


@query(f"""WITH {TRIAGED}, best AS (SELECT * FROM roles WHERE prim), counts AS (SELECT ticket_key, count(*) FILTER (doc_role = 'supporting_doc') AS supporting FROM roles GROUP BY ticket_key),
everyone AS (SELECT ticket_key, count(*) AS attachment_count_total FROM reasons GROUP BY ticket_key),
graded AS (SELECT e.ticket_key, attachment_count_total, coalesce(supporting, 0) AS supporting, b.id AS primary_attachment_id, b.score::INT AS triage_score, b.retrieval_readiness, b.extraction_quality, b.confirmed,
  CASE WHEN b.id IS NULL THEN 'none' WHEN b.confirmed AND b.retrieval_readiness >= 0.65 AND b.extraction_quality >= 0.75 THEN 'good' WHEN b.retrieval_readiness >= 0.45 OR supporting > 0 THEN 'fallback' ELSE 'none' END AS att_quality
  FROM everyone e LEFT JOIN best b ON e.ticket_key = b.ticket_key LEFT JOIN counts c ON e.ticket_key = c.ticket_key)
SELECT ticket_key, attachment_count_total, supporting, primary_attachment_id, triage_score, retrieval_readiness, extraction_quality, att_quality, CASE WHEN att_quality = 'good' THEN 'A' ELSE 'C' END AS triage_tier FROM graded""")  # fmt: skip
def attachment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = triage.artifact(triage.triage(attachments(spark, sf_dir)))
    return rows.select("ticket_key", "attachment_count_total", F.size("supporting_attachments").cast("long").alias("supporting"), "primary_attachment_id", "triage_score", "primary_attachment.retrieval_readiness", "primary_attachment.extraction_quality", "att_quality", "triage_tier")


@query("""WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 7), s AS (SELECT vec_id,
  list_sum(list_transform(list_zip(v.embedding, q.e), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)) / ((sqrt(list_sum(list_transform(v.embedding, lambda x: x::DOUBLE * x::DOUBLE))) + 1e-9) * (sqrt(list_sum(list_transform(q.e, lambda x: x::DOUBLE * x::DOUBLE))) + 1e-9)) AS score
  FROM embeddings v, q) SELECT vec_id, round(score, 6) AS score FROM s ORDER BY s.score DESC, vec_id DESC LIMIT 20""")  # fmt: skip
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "embeddings")
    asked = index.filter("vec_id = 7").first()
    return vectors.top_k(index, list(asked["embedding"]), 20, "vec_id").select("vec_id", F.round("score", 6).alias("score"))


@query("""WITH v AS (SELECT vec_id, embedding AS e, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) + 1e-9 AS n FROM embeddings),
s AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_sum(list_transform(list_zip(v.e, q.e), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)) / (v.n * q.n), 12) AS score FROM v, v AS q WHERE q.vec_id % 10 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id DESC)::INT AS rank, vec_id, round(score, 6) AS score FROM s QUALIFY rank <= 5""")  # fmt: skip
def cosine_topk_of_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest of all vectors to every tenth one, itself among them, by cells and bounds."""
    index = table(spark, sf_dir, "embeddings")
    asked = index.filter("vec_id % 10 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    return nearest.search(index, asked, 5, "vec_id").withColumn("score", F.round("score", 6))


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id")
def latest_wins_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.latest(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000+0000') AS updated FROM orders
  WHERE NOT (o_orderkey % 4 <> 0 AND date_trunc('second', o_orderdate) <= CASE WHEN o_orderkey % 2 = 0 THEN date_trunc('second', o_orderdate) ELSE TIMESTAMP '1996-01-01' END)""")  # fmt: skip
def incremental_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000+0000")).alias("updated"))
    stored = orders.filter("o_orderkey % 4 != 0").select(F.col("o_orderkey").alias("key"), F.when(F.col("o_orderkey") % 2 == 0, F.regexp_replace("updated", r"\.000\+0000", "Z")).otherwise("1996-01-01").alias("updated_at"))
    return records.to_process(orders.withColumnRenamed("o_orderkey", "key"), stored).withColumnRenamed("key", "o_orderkey")


@query("""WITH e AS (SELECT 'stage-' || ((props->>'k')::INT % 5) AS stage, event_type || '-' || (user_id % 3) AS error_type FROM events WHERE event_type = 'error')
SELECT CASE WHEN grouping(stage) = 0 THEN 'stage' WHEN grouping(error_type) = 0 THEN 'error_type' ELSE 'total' END AS grouping, coalesce(stage, error_type, '') AS name, count(*) AS n FROM e GROUP BY GROUPING SETS ((stage), (error_type), ())""")  # fmt: skip
def dlq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").filter("event_type = 'error'")
    stage = F.concat(F.lit("stage-"), (F.get_json_object("props", "$.k").cast("int") % 5).cast("string"))
    return reports.dead_letter_summary(rows.select(stage.alias("stage"), F.concat_ws("-", "event_type", (F.col("user_id") % 3).cast("string")).alias("error_type")))


@query("""WITH r AS (SELECT conv_id, count(*) AS n, conv_id % 7 = 0 AS failed, conv_id % 2 = 0 AS vs, conv_id % 3 = 0 AS p FROM conversations GROUP BY conv_id)
SELECT coalesce(sum(n) FILTER (NOT failed), 0)::BIGINT AS total_chunks, count(*) FILTER (NOT failed) AS processed, count(*) FILTER (failed) AS failed, count(*) FILTER (NOT failed AND vs) AS with_value_streams, count(*) FILTER (NOT failed AND p) AS with_products FROM r""")  # fmt: skip
def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("chunk_count"))
    ids = lambda n: F.when(F.col("conv_id") % n == 0, F.array(F.lit("x")))
    return reports.batch_totals(rows.select("chunk_count", F.when(F.col("conv_id") % 7 == 0, "failed").alias("error"), ids(2).alias("value_stream_ids"), ids(3).alias("product_ids")))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.by_source(table(spark, sf_dir, "documents"))


@query("SELECT CASE WHEN role = 'user' THEN '<ticket_only>' ELSE role || '-' || (conv_id % 10) END AS attachment, count(*) AS n FROM conversations GROUP BY ALL")
def attachment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("role") == "user", "").otherwise(F.concat_ws("-", "role", (F.col("conv_id") % 10).cast("string")))
    return reports.by_attachment(table(spark, sf_dir, "conversations").select(name.alias("attachment_name")))


@query("""SELECT c_custkey % 100 AS ticket_key, count(*) FILTER (t = 'Value Stream') AS vs, count(*) FILTER (t = 'Product') AS product, count(*) FILTER (t = 'Blocks') AS dependency, count(*) FILTER (t = 'is child of') AS parent, count(*) FILTER (t = 'Duplicates') AS related, count(*) FILTER (t = 'Implements') AS implementation, count(*) FILTER (t = 'other') AS unknown
FROM (SELECT c_custkey, ['Value Stream', 'Product', 'Blocks', 'is child of', 'Duplicates', 'Implements', 'other'][(c_nationkey % 7 + 1)::INT] AS t FROM customer) GROUP BY ALL""")  # fmt: skip
def links_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, ("Value Stream", "Product", "Blocks", "is child of", "Duplicates", "Implements", "other")))
    name = F.element_at(names, (F.col("c_nationkey") % 7 + 1).cast("int"))
    rows = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 100).alias("ticket_key"), F.col("c_custkey").alias("pos"), F.col("c_name").alias("key"), fd.link_category(name).alias("category"))
    return records.links_by_category(rows, "key").select("ticket_key", *[F.size(c).cast("long").alias(c) for c in fd.CATEGORIES])


@query(f"""WITH t AS (SELECT conv_id, left(trim(string_agg(text, ' ' ORDER BY turn)), 3000) AS text FROM conversations GROUP BY conv_id)
SELECT conv_id, {WORDS("text")}::INT AS word_count, md5(text) AS text_md5, 'supp-pdf-' || conv_id AS chunk_id FROM t WHERE {WORDS("text")} >= 30""")  # fmt: skip
def supplementary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.lit("pdf").alias("ext"), F.col("turn").alias("pos"), "text")
    return chunking.supplementary(rows, ["conv_id"]).select("conv_id", "word_count", F.md5("text").alias("text_md5"), "chunk_id")


@query(f"""WITH {DESCRIBED}, {TIERED} SELECT doc_id AS id, quality_tier, source AS business_unit, md5(source || ' ' || lang) AS text_md5 FROM tiered""")
def label_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tiered(spark, sf_dir).join(table(spark, sf_dir, "labels").withColumnRenamed("quality", "vs_labels"), "doc_id", "left")
    documents = rows.select(F.col("doc_id").alias("ticket_key"), "quality_tier", F.col("source").alias("business_unit"), F.lit("").alias("retrieval_text"), F.col("source").alias("summary_text"), F.col("lang").alias("metadata_text"), F.lit(None).cast("array<float>").alias("summary_embedding"))
    return stores.coarse_rows(documents).select("id", "quality_tier", "business_unit", F.md5("text").alias("text_md5"))


@query("""SELECT d.doc_id, to_json([lang, source])::VARCHAR AS labels, to_json(list_filter([l.quality, l.toxic], lambda x: x IS NOT NULL))::VARCHAR AS marks FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def flatten_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return files.flatten(rows.select("doc_id", F.array("lang", "source").alias("labels"), F.array_compact(F.array("quality", "toxic")).alias("marks")), ["labels", "marks"])


@query("SELECT vec_id, label, '<vector dim=' || len(embedding) || '>' AS embedding, len(embedding)::INT AS merged_dim FROM embeddings")
def split_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown, apart = vectors.split_vectors(table(spark, sf_dir, "embeddings"), ["vec_id"])
    merged = vectors.merge_vectors(shown, apart, ["vec_id"]).select("vec_id", F.size("embedding").alias("merged_dim"))
    return shown.join(merged, "vec_id")


@query(f"""SELECT conv_id, turn, rank::INT AS rank, md5(left(text, 800)) AS text_md5 FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY {WORDS("text")} DESC, turn) AS rank FROM conversations) WHERE rank <= 3""")
def top_words_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("pos"), "text")
    return summaries.longest_chunks(rows, ["conv_id"], 3).select("conv_id", F.col("pos").alias("turn"), "rank", F.md5(F.substring("text", 1, 800)).alias("text_md5"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.event_rates(table(spark, sf_dir, "events")).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT count(*) FILTER (len(embedding) > 0) AS populated, count(*) AS total FROM embeddings")
def embedding_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.embedding_coverage(table(spark, sf_dir, "embeddings"))


@query("""WITH w AS (SELECT item_id, list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda w: length(w) > 3 AND w NOT IN ('that', 'this', 'with', 'from')) AS w FROM benchmark),
u AS (SELECT item_id, x, min(i) AS i FROM (SELECT item_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w) GROUP BY ALL)
SELECT item_id, coalesce(array_to_string(list(x ORDER BY i)[1:5], ' '), '') AS phrases FROM u GROUP BY item_id""")  # fmt: skip
def key_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(tx.key_phrases(F.col("text")), " ").alias("phrases"))


# Queries that SQL engines can't express: look-behind, recursion, bytes.


@query()
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", cleaning.clean_text(F.col("text")).alias("cleaned"))
    return rows.select("doc_id", F.md5("cleaned").alias("cleaned_md5"), tx.word_count(F.col("cleaned")).alias("words"), tx.looks_weak(F.col("cleaned")).alias("weak"))


@query()
def table_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations and regions written as Markdown tables, and read again."""
    nations = table(spark, sf_dir, "nation")
    line = F.concat(F.lit("| "), "n_name", F.lit(" | "), F.col("n_nationkey").cast("string"), F.lit(" |"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", line.alias("line")))), lambda r: r["line"])
    text = F.concat(F.lit("| name | key |\n|---|---|\n"), F.array_join(lines, "\n"), F.lit("\n"))
    rows = nations.groupBy("n_regionkey").agg(text.alias("text")).select("n_regionkey", F.explode(markdown.parse_tables(F.col("text"))).alias("t"))
    return rows.select("n_regionkey", "t.full_text", "t.summary", "t.row_count", "t.col_count")


@query()
def adf_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as rich-text trees, and as plain text again."""
    leaf = F.struct(F.lit("text").alias("type"), F.col("text").alias("text"))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", leaf.alias("leaf")))).alias("c"))
    paragraphs = F.transform("c", lambda x: F.struct(F.lit("paragraph").alias("type"), F.array(x["leaf"]).alias("content")))
    tree = F.to_json(F.struct(F.lit("doc").alias("type"), paragraphs.alias("content")))
    return rows.select("conv_id", tree.alias("tree")).select("conv_id", F.md5(fd.rich_text(F.col("tree"))).alias("text_md5"))


@query()
def embed_fake(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors.embed(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "text", lambda: vectors.HashingEmbedder(32))
    return rows.select("conv_id", "turn", F.size("embedding").alias("dim"), F.round(vectors.cosine(F.col("embedding"), F.col("embedding")), 6).alias("self"))


@query()
def peeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages taken for PDFs: no page objects, or broken archives, give an answer and no failure."""
    rows = attachments(spark, sf_dir).join(table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("id"), F.encode("html", "UTF-8").alias("file_bytes")), "id")
    found = extract.peeks(triage.prefilter(rows).select("id", "ext", "file_bytes"), ["id", "ext"])
    return found.select("id", "ext", F.col("peek.page_count").alias("page_count"), F.col("peek.error").isNotNull().alias("failed"))


def document_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as tracker records, with pages as their attachments and conversations as their comments."""
    attached = attachments(spark, sf_dir).groupBy(F.concat(F.lit("DOC-"), F.col("ticket_key").cast("string")).alias("key")).agg(F.collect_list(F.struct("id", "filename", F.lit("").alias("content"), F.lit("").alias("mimeType"), "size", "created")).alias("attachments"))
    said = table(spark, sf_dir, "conversations").groupBy(F.concat(F.lit("DOC-"), F.col("conv_id").cast("string")).alias("key")).agg(F.array_sort(F.collect_list(F.struct(F.col("turn").cast("string").alias("id"), F.lit("2024-01-01").alias("created"), F.struct(F.col("role").alias("displayName")).alias("author"), F.col("text").alias("body")))).alias("comments"))
    docs = table(spark, sf_dir, "documents").withColumn("key", F.concat(F.lit("DOC-"), F.col("doc_id").cast("string")))
    rows = docs.join(said, "key", "left").join(attached, "key", "left")
    named = lambda c: F.struct(c.alias("name"))
    issue = F.struct(F.struct(F.lit("Value Stream").alias("name")).alias("type"), F.struct(F.concat(F.lit("VS-"), (F.col("doc_id") % 7).cast("string")).alias("key"), F.struct(F.col("lang").alias("summary"), named(F.lit("Open")).alias("status")).alias("fields")).alias("outwardIssue"))
    fields = F.struct(
        F.col("source").alias("summary"), F.col("text").alias("description"), F.struct(F.col("lang").alias("displayName")).alias("reporter"), F.lit("2024-01-15T10:00:00.000+0000").alias("created"), F.lit("2024-03-15T10:00:00Z").alias("updated"),
        F.array("lang").alias("labels"), F.array(named(F.col("source"))).alias("components"), named(F.lit("High")).alias("priority"), named(F.lit("Open")).alias("status"), named(F.lit("Idea")).alias("issuetype"),
        F.array(issue).alias("issuelinks"), F.struct(F.coalesce("comments", F.array().cast(said.schema["comments"].dataType)).alias("comments")).alias("comment"),
    )
    return rows.select("key", F.to_json(fields).alias("fields"), F.coalesce("attachments", F.array().cast(attached.schema["attachments"].dataType)).alias("attachments"))


@query()
def assembled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole assembly, from records to documents."""
    from tessera.plans import assembly

    held = files.Stages()
    # of texts, only the cleaned ones are read after they are described; what is joined is read once
    keep = lambda name, rows: rows if name == "joined" else held.keep(name, rows.drop("description") if name == "described" else rows)
    stages = assembly.assemble(document_record(spark, sf_dir), phrases_raw(spark, sf_dir), ingested_at=F.lit("2024-04-01T00:00:00Z"), keep=keep, done=lambda name: held.done(spark, name))
    return stages.documents.select("ticket_key", "quality_tier", "desc_class", "content_source", "chunk_count", "comment_count", "entity_product_count", "primary_evidence_type", F.md5("retrieval_text").alias("retrieval_md5"), F.md5("metadata_text").alias("metadata_md5"))


def phrases_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.get(F.split("text", r"\."), F.lit(0))
    return table(spark, sf_dir, "benchmark").select(F.lit("products").alias("etype"), F.col("item_id").cast("string").alias("canonical"), F.array(first).alias("aliases"), F.col("item_id").alias("ord"))


@query()
def validated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of which some lack a key, fields or filenames, with what is wrong."""
    rows = document_record(spark, sf_dir)
    n = F.xxhash64("key") % 5
    broken = rows.select(F.when(n == 0, " ").otherwise(F.col("key")).alias("key"), F.when(n == 1, json.dumps([1])).otherwise(F.col("fields")).alias("fields"), "attachments")
    return records.validate(broken).groupBy(F.coalesce("validation_error", F.lit("ok")).alias("result")).agg(F.count("*").alias("n"))
