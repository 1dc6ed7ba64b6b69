"""Validation, metadata, links and comments of records. Each operator takes and gives DataFrames.

A record is (key STRING, fields STRING holding JSON, attachments ARRAY<STRUCT<id, filename, ...>>, themes ARRAY<STRUCT>).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import fields as fd
from tessera.functions import text as tx
from tessera.settings import DEFAULT, Settings


def validation_error(strict: bool = False) -> Column:
    """The first thing wrong with a record, or null. Strict validation also rejects filenames of white space."""
    key, name = F.trim(F.coalesce("key", F.lit(""))), lambda a: F.trim(a["filename"]) if strict else a["filename"]
    nameless = F.coalesce(F.exists("attachments", lambda a: F.coalesce(name(a), F.lit("")) == ""), F.lit(False))
    at = F.array_position(F.transform("attachments", lambda a: F.coalesce(name(a), F.lit(""))), "") - 1
    kind = F.schema_of_variant(F.try_parse_json("fields"))
    return (
        F.when(key == "", "'key' must be a non-empty string")
        .when(~F.coalesce(kind.startswith("OBJECT"), F.lit(False)), "'fields' must be an object")
        .when(nameless, F.format_string("attachment[%d] is missing 'filename'", at))
    )


def validate(records: DataFrame, strict: bool = False) -> DataFrame:
    """The records, with validation_error; split them by whether it is null."""
    return records.withColumn("validation_error", validation_error(strict))


#: What strict validation keeps of an attachment.
ATTACHMENT = "struct<id:string,filename:string,mimeType:string,size:bigint,content:string>"
THEMES = "array<map<string,string>>"


def strict_model(records: DataFrame) -> DataFrame:
    """Strictly validated records as a model of fixed columns: key, fields, attachments of five members, themes, and
    validation_error. What is missing is null, or an empty list; other columns and members are left out."""
    checked = validate(records, strict=True)
    present = set()
    if "attachments" in records.columns:
        present = set(records.schema["attachments"].dataType.elementType.names)
    member = lambda a, n, kind: (a[n] if n in present else F.lit(None)).cast(kind).alias(n)
    kinds = (("id", "string"), ("filename", "string"), ("mimeType", "string"), ("size", "bigint"), ("content", "string"))
    files = F.transform("attachments", lambda a: F.struct(*[member(a, n, kind) for n, kind in kinds]))
    themes = F.col("themes") if "themes" in records.columns else F.lit(None).cast(THEMES)
    none = F.array()
    return checked.select("key", "fields", F.coalesce(files, none.cast(f"array<{ATTACHMENT}>")).alias("attachments"), F.coalesce(themes, none.cast(themes_kind(records))).alias("themes"), "validation_error")


def themes_kind(records: DataFrame) -> str:
    return records.schema["themes"].dataType.simpleString() if "themes" in records.columns else THEMES


def to_dead_letters(bad: DataFrame, stage: str, error_type: str, message: Column, trigger: str = "unknown", at: Column | None = None, extra: Column | None = None) -> DataFrame:
    """Dead letters of failed records: what failed and where, and a light summary of the record."""
    names = F.json_object_keys("fields")
    summary = F.struct(F.col("key"), F.coalesce(names, F.array().cast("array<string>")).alias("fields_keys"), F.coalesce(F.size("attachments"), F.lit(0)).alias("attachment_count"))
    return bad.select(
        F.col("key").alias("ticket_key"), F.lit(stage).alias("stage"), F.lit(error_type).alias("error_type"), message.alias("error_message"),
        (F.current_timestamp() if at is None else at).alias("timestamp"), F.lit(trigger).alias("trigger"), summary.alias("raw_summary"),
        (F.create_map().cast("map<string,string>") if extra is None else extra).alias("extra"),
    )


def metadata(records: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row of flat metadata for each record, and metadata_text; labels of products and streams are left out of it."""
    ids = {"business_unit": "customfield_10002", "product_area": "customfield_10003"} | settings.field_map
    custom = lambda name: fd.as_text(F.try_variant_get("v", f"$.{ids[name]}", "variant")) if ids.get(name) else F.lit("")
    strings = lambda path, kind: F.coalesce(F.try_variant_get("v", path, kind), F.array().cast(kind))
    labels = F.filter(F.transform(strings("$.labels", "array<variant>"), lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))), lambda x: x.isNotNull())
    components = F.transform(F.filter(strings("$.components", "array<variant>"), lambda x: F.schema_of_variant(x).startswith("OBJECT")), lambda x: F.coalesce(F.try_variant_get(x, "$.name", "string"), F.lit("")))
    flat = records.withColumn("v", fd.fields_of(F.col("fields"))).select(
        F.col("key").alias("ticket_key"), fd.get_text(F.col("v"), "$.summary").alias("summary"),
        F.coalesce(F.try_variant_get("v", "$.reporter.displayName", "string"), fd.get_text(F.col("v"), "$.reporter.name")).alias("reporter"),
        *[fd.get_text(F.col("v"), f"$.{p}").alias(a) for a, p in (("created", "created"), ("updated_at", "updated"), ("issue_type", "issuetype.name"), ("status", "status.name"), ("resolution", "resolution.name"), ("priority", "priority.name"), ("description", "description"))],
        labels.alias("labels"), components.alias("components"),
        *[custom(n).alias(n) for n in ("business_unit", "product_area", "requesting_org", "delivery_org")],
        fd.epic_key(F.col("v"), settings.field_map.get("epic_link", "customfield_10014")).alias("epic_key"),
        fd.stage_labels(F.col("v"), settings.field_map.get("product_stage", "")).alias("product_stage_labels"),
        *[fd.product_labels(F.try_variant_get("v", f"$.{settings.field_map.get(n, n)}", "variant")).alias(n) for n in ("impacted_products", "impacted_it_products")],
        fd.themes_of(fd.links_of(F.col("v"))).alias("themes"),
    )
    part = lambda label, c: F.concat(F.lit(f"{label}: "), tx.non_empty(c))
    listed = lambda c: F.array_join(c, ", ")
    title = F.concat_ws(": ", "ticket_key", "summary")
    text = F.concat_ws(
        ". ", title, part("Type", F.col("issue_type")), part("Status", F.col("status")), F.when(F.size("components") > 0, F.concat(F.lit("Components: "), listed(F.col("components")))),
        F.when(F.size("labels") > 0, F.concat(F.lit("Labels: "), listed(F.col("labels")))), part("Business Unit", F.col("business_unit")), part("Product Area", F.col("product_area")),
        part("Requesting Org", F.col("requesting_org")), part("Delivery Org", F.col("delivery_org")), part("Reporter", F.col("reporter")),
    )
    return flat.withColumn("title", title).withColumn("metadata_text", text)


def links(records: DataFrame) -> DataFrame:
    """Classified issue links, one a row, in order; the outward issue wins, links without an issue are dropped."""
    every = records.select(F.col("key").alias("ticket_key"), F.posexplode(fd.links_of(fd.fields_of(F.col("fields")))).alias("pos", "link"))
    outward = F.col("link.outwardIssue.key").isNotNull()
    issue = F.when(outward, F.col("link.outwardIssue")).otherwise(F.col("link.inwardIssue"))
    return every.withColumn("issue", issue).filter("issue IS NOT NULL").select(
        "ticket_key", "pos", F.coalesce("link.type.name", F.lit("")).alias("link_type"), F.when(outward, "outward").otherwise("inward").alias("direction"),
        fd.link_category(F.col("link.type.name")).alias("category"), F.coalesce("issue.key", F.lit("")).alias("key"), F.coalesce("issue.fields.summary", F.lit("")).alias("summary"),
        F.coalesce("issue.fields.status.name", F.lit("")).alias("status"), fd.project_of(F.col("issue.key")).alias("project"),
    )


def links_by_category(classified: DataFrame, *values: str) -> DataFrame:
    """The links of each record in seven lists. The categories are given, so that no job has to find them."""
    item = F.struct("pos", *(values or ("key", "summary", "status", "link_type", "project")))
    lists = [F.array_sort(F.collect_list(F.when(F.col("category") == c, item))).alias(c) for c in fd.CATEGORIES]
    return classified.groupBy("ticket_key").agg(*lists)


def comments(records: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row for each comment that isn't a bot's: raw and cleaned text, word count, whether it is substantive."""
    kind = "array<struct<id:string,created:string,author:struct<displayName:string,name:string>,body:variant>>"
    every = records.select(F.col("key").alias("ticket_key"), F.posexplode(F.try_variant_get(fd.fields_of(F.col("fields")), "$.comment.comments", kind)).alias("pos", "c"))
    author = F.coalesce("c.author.displayName", "c.author.name", F.lit(""))
    is_tree = F.schema_of_variant("c.body").startswith("OBJECT")
    # the tree goes through Arrow only where there is one
    tree = fd.rich_text(F.when(is_tree, F.to_json("c.body")))
    body = F.when(is_tree, tree).otherwise(F.coalesce(F.try_variant_get("c.body", "$", "string"), F.lit("")))
    raw = every.filter(~tx.is_bot(author)).select("ticket_key", "pos", F.col("c.id").alias("comment_id"), author.alias("author"), F.col("c.created").alias("created"), tx.trimmed(body).alias("body_raw"))
    return comment_flags(raw, settings)


def comment_flags(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """body_cleaned, word_count and is_substantive of rows with body_raw."""
    cleaned = raw.withColumn("body_cleaned", tx.strip_markup(F.col("body_raw")))
    return cleaned.withColumns({"word_count": tx.word_count(F.col("body_raw")), "is_substantive": tx.is_substantive(F.col("body_raw"), F.col("body_cleaned"), settings)})


def comment_summary(flags: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Of each record: comment counts, the first five cleaned comments, up to ten key sentences, the first three long ones."""
    short = lambda c: F.substring(c, 1, settings.comment_chars)
    good = F.col("is_substantive")
    ordered = lambda when, value: F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("pos", value.alias("x"))))), lambda s: s["x"])
    return flags.groupBy("ticket_key").agg(
        F.count("*").alias("comment_count"), F.count_if(good).alias("substantive_count"),
        F.slice(ordered(good, short(F.col("body_cleaned"))), 1, 5).alias("comments_cleaned"),
        F.slice(F.flatten(ordered(good, tx.key_sentences(F.col("body_cleaned")))), 1, 10).alias("important_spans"),
        F.slice(ordered(F.col("word_count") >= settings.comment_words, short(F.col("body_raw"))), 1, 3).alias("substantive_comments"),
    )


def to_process(incoming: DataFrame, stored: DataFrame, force: bool = False) -> DataFrame:
    """Records (key, updated) that are new or newer than the stored ones (key, updated_at); all of them if forced.

    Timestamps are ISO texts with offset, Z or date only; what can't be read is null, and processed.
    """
    if force:
        return incoming
    known = stored.select(F.col("key").alias("_key"), F.try_to_timestamp("updated_at").alias("_stored"))
    seen = F.try_to_timestamp("updated") <= F.col("_stored")
    return incoming.join(known, F.col("key") == F.col("_key"), "left").filter(~F.coalesce(seen, F.lit(False))).drop("_key", "_stored")


def not_done(keys: DataFrame, *outputs: DataFrame) -> DataFrame:
    """Keys for which not every output exists already."""
    done = None
    for out in outputs:
        own = out.select("key").distinct()
        done = own if done is None else done.join(own, "key")
    return keys if done is None else keys.join(done, "key", "left_anti")


def distinct_in_order(keys: DataFrame) -> DataFrame:
    """(key, pos): each key once, at its first place."""
    return keys.groupBy("key").agg(F.min("pos").alias("pos"))


def latest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, by the given order."""
    window = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
