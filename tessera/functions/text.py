"""Column functions on text: counting, classifying, scoring. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.settings import DEFAULT, Settings

#: Whole words that tell of business content.
BUSINESS_TERMS = (
    "customer", "member", "provider", "workflow", "process", "journey", "value", "stream", "benefit",
    "impact", "problem", "opportunity", "solution", "initiative", "business", "product", "feature",
    "integration", "platform", "experience", "automation", "claims", "authorization", "clinical",
    "operations", "analytics", "data",
)

#: Phrases of unfilled templates.
TEMPLATE_PHRASES = ("insert here", "[placeholder]", "lorem ipsum", "click to add", "type here", "your text", "add title", "add text")

#: How a description starts that says nothing; the second group must be the whole text.
JUNK_STARTS = ("please see attach", "see attached", r"\[insert .+\]", "as discussed", "see confluence", "details in the deck", "refer to the attached", "attached")
JUNK_WHOLE = ("tbd", "todo", "n/a", "none")

#: Comments of bots, and chatter.
BOTS = "atlassian-bot|jira-bot|automation|webhook"
CHATTER = (
    r"^(moved|transitioned|changed status|updated|assigned|resolved|closed|reopened)\b",
    r"^(done|ok|ack|acknowledged|noted|thanks|cheers|\+1|-1|approved|lgtm)\W*$",
    r"^\s*(see attached|see comments|see above|as per|per above|as discussed)\b",
    r"^(sent|forwarded|cc:|fyi\b)",
)

#: Words that make no key phrase.
STOP_WORDS = ("the", "a", "an", "in", "of", "for", "and", "or", "to", "is", "are", "that", "this", "with", "on", "at", "by", "from")

#: Titles of slides without content, and of agenda slides.
BOILERPLATE_TITLES = r"(?i)^(agenda|outline|table of contents|thank|questions|q&a|appendix|disclaimer|legal|confidential)$"
AGENDA = r"(?i)^(agenda|outline|overview|introduction|background|problem|solution|approach|implementation|timeline|next steps|conclusion|summary|appendix)"

#: White space as str.split() has it: Unicode's, and four separators.
SPACES = r"(?U)[\s\x1c-\x1f]+"
WHITE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def trimmed(text: Column) -> Column:
    """Without white space at both ends, as str.strip() has it."""
    return F.btrim(text, F.lit(WHITE))


def split_words(text: Column) -> Column:
    """Words between runs of (Unicode) white space; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words: pieces of the trimmed text."""
    inner = trimmed(text)
    return F.when(F.coalesce(inner == "", F.lit(True)), 0).otherwise(F.size(F.split(inner, SPACES)))


def simple_words(text: Column) -> Column:
    """Runs of ASCII letters and digits of the lowered text."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def business_signals(words: Column, terms: tuple[str, ...] = BUSINESS_TERMS) -> Column:
    """How many different business terms are among the words."""
    return F.size(F.array_intersect(words, F.array(*map(F.lit, terms))))


def semantic_density(words: Column, terms: tuple[str, ...] = BUSINESS_TERMS) -> Column:
    """Share of different words (65 %) and business terms (35 %, full from ten), rounded half even to 4 places."""
    total = F.size(words)
    raw = 0.65 * F.size(F.array_distinct(words)) / total + 0.35 * F.least(F.lit(1.0), business_signals(words, terms) / 10.0)
    return F.when(total == 0, 0.0).otherwise(F.bround(F.least(F.lit(1.0), raw), 4))


def template_hits(text: Column) -> Column:
    """How many template phrases the text holds, each counted once."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return reduce(lambda a, b: a + b, (F.contains(lowered, F.lit(p)).cast("int") for p in TEMPLATE_PHRASES))


def strip_markup(text: Column) -> Column:
    """Plain text of wiki markup, in a fixed order of steps; ``snake_case`` loses its underscores too.

    A step is tried only where one of its signs stands in the text: most texts have none.
    """
    steps = [
        (("{",), r"(?is)\{code.*?\}.*?\{code\}|\{panel.*?\}.*?\{panel\}|\{noformat.*?\}.*?\{noformat\}|\{[a-z]+[^}]*\}", ""),
        (tuple(f"h{i}." for i in range(1, 7)), r"(?md)^h[1-6]\.", ""),
        (("|",), r"(?d)\|\|.*?\|\||\|.*?\|", " "),
        (("*", "_"), r"(?d)[*_]{1,2}(.+?)[*_]{1,2}", "$1"),
        (("\n\n\n",), r"\n{3,}", "\n\n"),
    ]

    def step(signs: tuple[str, ...], pattern: str, by: str) -> Callable[[Column], Column]:
        has = lambda out: reduce(lambda a, b: a | b, (F.contains(out, F.lit(s)) for s in signs))
        return lambda out: F.when(has(out), F.regexp_replace(out, pattern, by)).otherwise(out)

    # each step reads the one before it several times: as an array's only item, it is made once
    out = F.array(F.coalesce(text, F.lit("")))
    for signs, pattern, by in steps:
        out = F.transform(out, step(signs, pattern, by))
    return trimmed(F.get(out, F.lit(0)))


def is_junk(cleaned: Column, words: Column, settings: Settings = DEFAULT) -> Column:
    starts = "|".join([*JUNK_STARTS, *(f"(?:{w})$" for w in JUNK_WHOLE)])
    # how a text starts is seen without lowering all of it; whole texts that are junk are short
    return (words < settings.junk_below) | cleaned.rlike(f"(?i)^(?:{starts})")


def description_class(cleaned: Column, words: Column | None = None, settings: Settings = DEFAULT) -> Column:
    """empty, junk, thin, usable or rich, by the cleaned text; ``words`` is its number of words, if that is a column already."""
    n = word_count(cleaned) if words is None else words
    return (
        F.when(F.coalesce(cleaned, F.lit("")) == "", "empty")
        .when(is_junk(cleaned, n, settings), "junk")
        .when(n < settings.thin_below, "thin")
        .when(n < settings.usable_below, "usable")
        .otherwise("rich")
    )


def is_bot(author: Column) -> Column:
    return F.lower(F.coalesce(author, F.lit(""))).rlike(BOTS)


def is_chatter(cleaned: Column) -> Column:
    """Fewer than ten words, or an operational remark; a long comment that starts with "Updated" is one too."""
    return (word_count(cleaned) < 10) | reduce(lambda a, b: a | b, (cleaned.rlike(f"(?i){p}") for p in CHATTER))


def is_substantive(raw: Column, cleaned: Column, settings: Settings = DEFAULT) -> Column:
    return (word_count(raw) >= settings.comment_words) & ~is_chatter(cleaned)


def key_sentences(cleaned: Column, most: int = 2, least_words: int = 8) -> Column:
    """The first sentences (between full stops) of at least eight words."""
    sentences = F.transform(F.split(cleaned, r"\."), trimmed)
    return F.slice(F.filter(sentences, lambda s: word_count(s) >= least_words), 1, most)


def key_phrases(text: Column, most: int = 5) -> Column:
    """The first different words of over three letters that aren't stop words."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    return F.slice(F.array_distinct(F.filter(found, lambda w: (F.length(w) > 3) & ~w.isin(*STOP_WORDS))), 1, most)


def slide_title(text: Column) -> Column:
    """The first line with content, without leading number signs; null if none."""
    lines = F.transform(F.split(text, r"\r?\n"), lambda s: trimmed(F.regexp_replace(trimmed(s), "^#+", "")))
    return F.get(F.filter(lines, lambda s: s != ""), F.lit(0))


def is_boilerplate_slide(number: Column, title: Column, text: Column) -> Column:
    """A whole-title match, or a first slide of under twenty words or characters."""
    short = (word_count(text) < 20) | (F.length(F.trim(text)) < 20)
    return F.coalesce(F.trim(title).rlike(BOILERPLATE_TITLES), F.lit(False)) | ((number == 1) & short)


def is_section_start(title: Column, layout: Column | None = None) -> Column:
    """A short capitalised title without sentence marks, a section layout, or an agenda title."""
    title = F.coalesce(title, F.lit(""))
    header = title.rlike(r"(?d)^[A-Z][^.?!,;]{0,49}$") & (word_count(title) <= 6)
    by_layout = F.lit(False) if layout is None else F.coalesce(layout == "Section Header", F.lit(False))
    return header | by_layout | F.trim(title).rlike(AGENDA)


def merge_texts(native: Column, ocr: Column) -> Column:
    """Text layer and OCR text: the one that holds the other, or both."""
    a, b = (trimmed(F.coalesce(c, F.lit(""))) for c in (native, ocr))
    return F.when(a == "", b).when(b == "", a).when(F.contains(a, b), a).when(F.contains(b, a), b).otherwise(F.concat(a, F.lit("\n\n[OCR]\n"), b))


def looks_weak(cleaned: Column, least_words: int = 25) -> Column:
    """Few words, few letters and digits, or short lines: worth another extraction."""
    n, lines = word_count(cleaned), F.greatest(F.lit(1), F.length(cleaned) - F.length(F.replace(cleaned, F.lit("\n"), F.lit(""))) + 1)
    letters = F.length(F.regexp_replace(cleaned, r"[^\p{L}\p{N}]+", "")) / F.greatest(F.lit(1), F.length(cleaned))
    return (n < least_words) | (letters < 0.45) | (n / lines < 2.0)


def extension(filename: Column) -> Column:
    """What follows the last dot, lowered; empty without a dot."""
    return F.regexp_extract(F.lower(F.coalesce(filename, F.lit(""))), r"(?s)\.([^.]*)$", 1)


def stem(filename: Column) -> Column:
    """The name before the last dot, with one space for each run of other signs."""
    bare = F.regexp_replace(F.lower(F.coalesce(filename, F.lit(""))), r"(?s)\.[^.]*$", "")
    return F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " "))


def non_empty(column: Column) -> Column:
    return F.nullif(column, F.lit(""))
