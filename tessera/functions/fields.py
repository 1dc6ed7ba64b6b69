"""Column functions on a record's open fields, held as a VARIANT."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import non_empty

#: Link type names by category; anything else is unknown.
LINK_CATEGORIES = {
    "vs": ("Value Stream", "value-stream", "VS Link", "Implements Value Stream"),
    "product": ("Product", "Affects Product", "Impacts System"),
    "dependency": ("Depends On", "Blocks", "Is Blocked By", "depends on", "blocks", "is blocked by"),
    "parent": ("Epic Link", "Parent", "Sub-task", "is child of", "is parent of"),
    "related": ("Relates To", "Duplicates", "Clones", "relates to", "duplicates", "clones"),
    "implementation": ("Implements", "Story Link", "is implemented by"),
}
CATEGORIES = (*LINK_CATEGORIES, "unknown")

LINK = "struct<type:struct<name:string,inward:string,outward:string>,outwardIssue:struct<key:string,fields:struct<summary:string,status:struct<name:string>>>,inwardIssue:struct<key:string,fields:struct<summary:string,status:struct<name:string>>>>"


def fields_of(json_text: Column) -> Column:
    """The fields as a VARIANT; null if they aren't valid JSON."""
    return F.try_parse_json(json_text)


def get_text(fields: Column, path: str) -> Column:
    """A scalar at a path as text; empty if missing."""
    return F.coalesce(F.try_variant_get(fields, path, "string"), F.lit(""))


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def _named(value: Column, *names: str) -> Column:
    """The first of an object's members that isn't missing, empty, zero or false."""
    members = [F.try_variant_get(value, f"$.{n}", "string") for n in names]
    return F.coalesce(*[F.when(~m.isin("", "0", "false"), m) for m in members], F.lit(""))


def _scalar_text(value: Column) -> Column:
    kind = _kind(value)
    return F.when(kind == "VOID", "").when(kind.startswith("OBJECT"), _named(value, "name", "value", "key")).otherwise(F.coalesce(F.try_variant_get(value, "$", "string"), F.lit("")))


def as_text(value: Column) -> Column:
    """Any field as text: null is empty, objects give name, value or key, lists are joined by ", " without empties."""
    items = F.transform(F.try_variant_get(value, "$", "array<variant>"), _scalar_text)
    return F.when(_kind(value).startswith("ARRAY"), F.array_join(F.filter(items, lambda x: x != ""), ", ")).otherwise(_scalar_text(value))


#: Lists in lists are followed so many levels down.
LEVELS = 6


def names_of(value: Column) -> Column:
    """The names in a field: of a text, an object, or a list of those (lists in lists too)."""

    def one(v: Column) -> Column:
        kind = _kind(v)
        name = F.when(kind == "STRING", F.try_variant_get(v, "$", "string")).when(kind.startswith("OBJECT"), _named(v, "name", "value", "displayName")).otherwise("")
        return F.filter(F.array(name), lambda n: n != "")

    flat = lambda v, of: F.coalesce(F.flatten(F.transform(F.try_variant_get(v, "$", "array<variant>"), of)), F.array().cast("array<string>"))

    def within(levels: int) -> Callable[[Column], Column]:
        deeper = within(levels - 1) if levels else one
        return lambda v: F.when(_kind(v).startswith("ARRAY"), flat(v, deeper)).otherwise(one(v)) if levels else one(v)

    return within(LEVELS)(value)


def stage_labels(fields: Column, stage_field: str = "") -> Column:
    """Names of the configured stage field, then of fix versions and versions, each once, in order of appearance."""
    paths = [f"$.{p}" for p in (stage_field, "fixVersions", "versions") if p]
    found = [names_of(F.try_variant_get(fields, p, "variant")) for p in paths]
    return F.array_distinct(F.concat(*[F.coalesce(f, F.array().cast("array<string>")) for f in found]))


def product_labels(value: Column) -> Column:
    """STRUCT<raw, ids, names> of a list of products; what isn't a list is taken as one of one."""
    kind = _kind(value)
    items = F.when(kind.startswith("ARRAY"), F.try_variant_get(value, "$", "array<variant>")).when(kind == "VOID", F.array().cast("array<variant>")).otherwise(F.array(value))
    is_object = lambda v: _kind(v).startswith("OBJECT")
    ids = F.transform(items, lambda v: F.when(is_object(v), _named(v, "id", "key")).otherwise(""))
    names = F.transform(items, lambda v: F.when(is_object(v), _named(v, "name", "value", "displayName")).otherwise(F.coalesce(F.try_variant_get(v, "$", "string"), F.lit(""))))
    filled = lambda a: F.filter(a, lambda x: x != "")
    return F.struct(F.coalesce(F.to_json(value), F.lit("[]")).alias("raw"), filled(ids).alias("ids"), filled(names).alias("names"))


def epic_key(fields: Column, epic_field: str = "customfield_10014") -> Column:
    """The configured epic field if it is a text that isn't empty, or the parent's key."""
    value = F.try_variant_get(fields, f"$.{epic_field}", "variant")
    own = F.when(_kind(value) == "STRING", F.try_variant_get(value, "$", "string"))
    return F.coalesce(non_empty(own), get_text(fields, "$.parent.key"))


def link_category(name: Column) -> Column:
    pairs = [F.lit(x) for category, names in LINK_CATEGORIES.items() for n in names for x in (n, category)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), F.lit("unknown"))


def links_of(fields: Column) -> Column:
    """ARRAY of issue links as typed structs; empty if there are none."""
    return F.coalesce(F.try_variant_get(fields, "$.issuelinks", f"array<{LINK}>"), F.array().cast(f"array<{LINK}>"))


def themes_of(links: Column) -> Column:
    """Issues that a link says are implemented, outward first; each direction by itself."""
    theme = lambda issue: F.struct(issue["key"].alias("key"), F.coalesce(issue["fields"]["summary"], F.lit("")).alias("summary"), F.coalesce(issue["fields"]["status"]["name"], F.lit("")).alias("status"))
    out = F.transform(F.filter(links, lambda x: (x["type"]["outward"] == "implements") & x["outwardIssue"].isNotNull()), lambda x: theme(x["outwardIssue"]))
    into = F.transform(F.filter(links, lambda x: (x["type"]["inward"] == "implemented by") & x["inwardIssue"].isNotNull()), lambda x: theme(x["inwardIssue"]))
    return F.concat(out, into)


def project_of(key: Column) -> Column:
    return F.when(F.contains(key, F.lit("-")), F.substring_index(key, "-", 1)).otherwise("")


def _rich_text(node: object) -> str:
    """Texts of a rich-text tree, depth first, joined by one space."""
    if isinstance(node, list):
        return " ".join(filter(None, map(_rich_text, node)))
    if not isinstance(node, dict):
        return ""
    own = node.get("text", "") if node.get("type") == "text" else ""
    return " ".join(filter(None, [own, *map(_rich_text, node.get("content") or [])]))


@F.pandas_udf(T.StringType())
def _adf(documents: pd.Series) -> pd.Series:
    def text(value: str | None) -> str:
        try:
            return _rich_text(json.loads(value or "{}"))
        except ValueError:
            return ""

    return documents.map(text, na_action=None)


def rich_text(document: Column) -> Column:
    """Plain text of a rich-text tree given as JSON; what isn't JSON is empty. Trees recurse, which no Spark type does."""
    return _adf(document)
