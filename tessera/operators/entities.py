"""Entity mentions: dictionary terms in texts, components and links; one mention for each type and term."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources import files

TYPES = ("products", "systems", "capabilities", "platforms", "business_units")
#: Up to so many dictionary rows (under 1 kB each) are broadcast.
BROADCAST_TERMS = 50_000


def dictionary(entries: DataFrame) -> DataFrame:
    """(etype, term, canonical) of entries (etype, canonical, aliases, ord): lowered, a later alias wins over an earlier one."""
    terms = F.concat(F.array("canonical"), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = entries.select("etype", "canonical", "ord", F.posexplode(terms).alias("at", "term")).withColumn("term", F.lower("term")).filter("term != ''")
    last = Window.partitionBy("etype", "term").orderBy(F.desc("ord"), F.desc("at"))
    return rows.withColumn("_r", F.row_number().over(last)).filter("_r = 1").select("etype", "term", "canonical")


#: Words, and what is between them, of a lowered text.
WORDS, TOKENS = r"(?U)\w+", r"(?U)\w+|\W+"
_NAMED = ("etype", "term", "canonical")


def _broadcast_if(rows: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(rows) if small else rows


def _words_of(terms: DataFrame) -> DataFrame:
    """The terms with their different words; a term without any is its own word: between boundaries it can only be the whole
    of what is between two words."""
    words = F.array_distinct(F.regexp_extract_all("term", F.lit(WORDS), F.lit(0)))
    return terms.select(*_NAMED, F.when(F.size(words) > 0, words).otherwise(F.array("term")).alias("_words"), (F.size(words) == 0).alias("_bare"))


def _held(texts: DataFrame, own: DataFrame, place: list[str]) -> tuple[DataFrame, bool]:
    """(place, word) of each text and each of the dictionary's words in it, and whether the dictionary may be broadcast."""
    n, bare = own.agg(F.count("*"), F.bool_or("_bare")).first()
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TOKENS if bare else WORDS), F.lit(0)))
    known = own.select(F.explode("_words").alias("word")).distinct()
    small = n <= BROADCAST_TERMS
    return texts.select(*place, F.explode(found).alias("word")).join(_broadcast_if(known, small), "word", "left_semi"), small


def _rarest(own: DataFrame, held: DataFrame) -> DataFrame:
    each = own.select(*_NAMED, F.size("_words").alias("_n"), F.explode("_words").alias("word"))
    counted = each.join(held.groupBy("word").agg(F.count("*").alias("texts")), "word")
    best = counted.groupBy(*_NAMED, "_n").agg(F.min(F.struct("texts", "word")).alias("best"), F.count("*").alias("_found"))
    return best.filter("_found = _n").select(*_NAMED, "best.word", "best.texts")


def rarest_words(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """The terms, each with its word that the fewest texts hold (``word``, ``texts``; the first by code point of equals).

    Terms of which a word stands in no text are left out, as they can't occur.
    """
    own = _words_of(terms)
    return _rarest(own, _held(texts, own, [])[0])


def candidates(texts: DataFrame, terms: DataFrame, place: list[str]) -> DataFrame:
    """(place, terms) of each text that holds the rarest word of a term: the terms that have to be looked for in it."""
    own = _words_of(terms)
    held, small = _held(texts, own, place)
    held = files.stored(held)  # texts are cut into words once, for the counts and for the pairs
    met = held.join(_broadcast_if(_rarest(own, held).select(*_NAMED, "word"), small), "word")
    # a text has as many terms here as the dictionary has for its rare words
    return met.groupBy(*place).agg(F.collect_set(F.struct(*_NAMED)).alias("terms"))


def text_mentions(texts: DataFrame, terms: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Mentions of terms between word boundaries in texts, confidence 0.8.

    Terms and texts meet by an equi-join on each term's rarest word, without the texts: how many texts hold a word is
    counted first, so that a word that stands everywhere brings no pairs unless a term has no other. Only texts with
    candidates are looked into, each once for all of its terms, literally and between boundaries.
    """
    place = [*key, *order]
    met = candidates(texts, terms, place).select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(place)], "terms")
    same = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(place)]
    found = texts.select(*place, "text").join(met, same).select(*place, F.lower("text").alias("_lower"), "terms")
    literal = lambda t: F.concat(F.lit(r"(?U)\b\Q"), F.replace(t, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E\b"))
    inside = F.filter("terms", lambda t: F.contains(F.col("_lower"), t["term"]) & F.regexp_like(F.col("_lower"), literal(t["term"])))
    return found.select(*place, F.explode(inside).alias("t")).select(*place, "t.etype", F.col("t.canonical").alias("term"), F.lit(0.8).alias("confidence"))


def component_mentions(components: DataFrame, terms: DataFrame, key: list[str]) -> DataFrame:
    """Components (key, pos, component) that are product or system terms, confidence 1."""
    terms = terms.filter(F.col("etype").isin("products", "systems"))
    terms = F.broadcast(terms) if terms.count() <= BROADCAST_TERMS else terms
    return components.join(terms, F.lower("component") == F.col("term")).select(*key, "pos", "etype", F.col("canonical").alias("term"), F.lit(1.0).alias("confidence"), F.lit("jira_component").alias("source"), F.lit("metadata").alias("chunk_id"))


def link_mentions(links: DataFrame, key: list[str]) -> DataFrame:
    """Summaries of product links, confidence 0.9."""
    good = links.filter((F.col("category") == "product") & (F.col("summary") != ""))
    return good.select(*key, "pos", F.lit("products").alias("etype"), F.col("summary").alias("term"), F.lit(0.9).alias("confidence"), F.lit("jira_link").alias("source"), F.lit("metadata").alias("chunk_id"))


def best_mentions(mentions: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Of each type and term, the mention of the highest confidence, the first of equals; ``first_seen`` is its place."""
    group = Window.partitionBy(*key, "etype", "term")
    at = F.struct(*order)
    rows = mentions.withColumns({"first_seen": F.min(at).over(group), "_r": F.row_number().over(group.orderBy(F.desc("confidence"), *order))})
    return rows.filter("_r = 1").drop("_r")
