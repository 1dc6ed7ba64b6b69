import html
import json
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tessera.functions import cleaning, markdown
from tessera.functions import fields as fd
from tessera.functions import text as tx


def one(spark, column, value="x"):
    return spark.createDataFrame([(value,)], "t string").select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("field", "want"),
    [(None, ""), ("hello", "hello"), ({"name": "Payments"}, "Payments"), ({"value": "Enterprise"}, "Enterprise"), ({"key": "IDEA-999"}, "IDEA-999"), ({}, ""), ([{"name": "A"}, {"name": "B"}], "A, B"), (42, "42")],
)
def test_as_text(spark, field, want):
    value = F.try_variant_get(fd.fields_of(F.col("t")), "$.f", "variant")
    assert one(spark, fd.as_text(value), json.dumps({"f": field})) == want


@pytest.mark.parametrize(("n", "want"), [(0, "empty"), (5, "junk"), (20, "thin"), (60, "usable"), (200, "rich")])
def test_description_class(spark, n, want):
    assert one(spark, tx.description_class(F.col("t")), " ".join(["word"] * n)) == want


def test_junk_starts(spark):
    assert one(spark, tx.description_class(F.col("t")), "See attached " + "word " * 20) == "junk"
    assert one(spark, tx.description_class(F.col("t")), "Todo " + "word " * 20) == "thin"


def test_strip_markup(spark):
    assert one(spark, tx.strip_markup(F.col("t")), "{code}x{code}\nh1. *bold* foo_bar_baz ||a||\n\n\n\nend ") == "bold foobarbaz  \n\nend"


def test_underscore_is_a_letter(spark):
    assert one(spark, F.lower("t").rlike(r"\b(idea|card)\b"), "idea_card.pptx") is False


@pytest.mark.parametrize(("raw", "want"), [("DDAATTAA letter", "DATA letter"), ("D a t a here", "Data here"), ("is it to be", "isittobe"), ("page 3\nx", "x"), ("a/b", "a / b"), ("• hi ,there&amp;", "-  hi,there&"), (None, "")])
def test_clean(raw, want):
    assert cleaning.clean(raw) == want.replace("-  hi", "- hi")


def test_sparse_rows_go_and_full_rows_stay():
    assert cleaning.clean("| a | | | |\n|---|---|\n| a | b | c |") == "a | b | c"


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("SSTTOOPP nnoonn Aabb mmm aaaa aabbc", "STOP non Aabb m aa aabbc"), ("abc \\x00 def\\r\\nghi\\tjkl\\u0000", "abc def\nghi jkl"), ("“a” – ‘b’ `c` \u00a0d\u200be\x07f", "\"a\" - 'b' 'c' de f"),
        ("|||||||\nx", "x"), ("| |\nx", "x"), ("a\n||\nb", "a\n\nb"), ("| a | b |\n| a | |  | |\n|x|", "a | b\nx"), ("=====\n----------\n#!?#!?#\nok\n***", "ok\n***"), ("Slide Number: 4\nFor internal use only!\npages", "pages"),
        ("a , b ; c !\n\n\n\n d\t\te", "a, b; c!\n\nd e"), ("a\n/\nb", "a / b"), ("&lt;b&gt; ﬁne", "<b> fine"), ("   ", ""), ("P & C 1 2 and", "P&C12 and"), ("\uf0b7 x", "- x"),
    ],
)
def test_cleaning_steps(raw, want):
    assert cleaning.clean(raw) == want


def test_tables_need_their_rule():
    rows = "\n".join(f"| {i} | v |" for i in range(17))
    (got,) = markdown.tables(f"| h | k |\n|---|---|\n{rows}\n")
    assert got["row_count"] == 17 and "... and 2 more rows" in got["full_text"] and got["summary"] == "Table with columns: h, k (e.g. 0; v)"


def test_rich_text(spark):
    tree = {"type": "doc", "content": [{"type": "paragraph", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": ""}]}, {"type": "text", "text": "b"}]}
    assert one(spark, fd.rich_text(F.col("t")), json.dumps(tree)) == "a b"
    assert one(spark, fd.rich_text(F.col("t")), "no json") == ""


def test_links_and_themes(spark):
    link = {"type": {"name": "Implements", "outward": "implements", "inward": "implemented by"}, "outwardIssue": {"key": "VS-1", "fields": {"summary": "s", "status": {"name": "Open"}}}}
    got = one(spark, fd.themes_of(fd.links_of(fd.fields_of(F.col("t")))), json.dumps({"issuelinks": [link]}))
    assert [t["key"] for t in got] == ["VS-1"]
    assert one(spark, fd.link_category(F.col("t")), "Blocks") == "dependency"
    assert one(spark, fd.link_category(F.col("t")), "BLOCKS") == "unknown"


def test_density(spark):
    assert one(spark, tx.semantic_density(tx.simple_words(F.col("t"))), "") == 0.0
    assert one(spark, tx.semantic_density(tx.simple_words(F.col("t"))), "data data") == 0.36


def test_chatter(spark):
    assert one(spark, tx.is_chatter(F.col("t")), "Updated " + "word " * 60) is True
    assert one(spark, tx.is_chatter(F.col("t")), "plain " * 60) is False


WORD = re.compile(r"\w")


def slow_clean(text):
    """Cleaning rule by rule, none of them skipped, letters word by word and signs one by one."""
    text = unicodedata.normalize("NFKC", re.sub(r"\\t", " ", re.sub(r"\\r\\n|\\n|\\r", "\n", re.sub(r"(?i)\\x00|\\u0000", " ", html.unescape(text or "")))))
    text = "".join(cleaning.SIGNS.get(c, c) for c in text)
    words = re.split(r"(\W+)", text)
    for i, w in enumerate(words):
        letters = bool(re.fullmatch("[A-Za-z]+", w))
        if letters and len(w) % 2 == 0 and len(w) >= 4 and w[::2] == w[1::2]:
            words[i] = w = w[::2]
        if letters and len(w) >= 3 and len(set(w)) == 1:
            words[i] = w[0]
    # pieces of one or two signs, apart by white space only: from each place where one may begin, as far as they go
    text, at = "".join(words), 0
    while at < len(text):
        ends, end = [], at
        while (at == 0 or not WORD.match(text[at - 1])) and (piece := re.compile("[A-Za-z0-9&]{1,2}").match(text, end)):
            for stop in {piece.end(), piece.start() + 1}:
                if stop == len(text) or not WORD.match(text[stop]):
                    ends.append((len(text[at:stop].split()), stop))
            space = re.compile(r"\s+").match(text, piece.end())
            if space is None:
                break
            end = space.end()
        last = max((stop for n, stop in ends if n >= 4), default=None)
        if last is not None:
            joined = "".join(text[at:last].split())
            text = text[:at] + joined + text[last:]
            at += len(joined)
        else:
            at += 1
    lines = [cleaning.kept_line(x) for x in text.splitlines()]
    text = "\n".join(x for x in lines if x is not None)
    for pattern, by in ((r" +(?=[,;:.!?])", ""), (r"\s*/\s*", " / "), (r"[ \t]{2,}", " "), (r"\n{3,}", "\n\n")):
        text = re.sub(pattern, by, text)
    return text.strip()


def test_cleaning_against_a_slow_version(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("text", cleaning.clean_text(F.col("text")).alias("cleaned")).collect()
    assert len(rows) > 100 and all(r["cleaned"] == slow_clean(r["text"]) for r in rows)
    rng = random.Random(1)
    parts = [*"aabSTTO1 |,;.!?-_=*", "\t", "\n\n\n", "/", "“", "–", "\u200b", "\x00", "\x0b", "é", "ﬁ", "&amp;", "\\x00", "\\n", "page ", "| a | |", "|---|---|", "Slide number: 3", "aaa ", "SSTTOOPP ", " go to my pc ", " S t o p "]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))
        # rules whose pieces touch other signs are those of the patterns alone
        if not re.search(r"[^\s\w][A-Za-z0-9&]{1,2}\s|\s[A-Za-z0-9&]{1,2}[^\s\w]|&", html.unescape(text)):
            assert cleaning.clean(text) == slow_clean(text), text


def test_words_are_those_of_python(spark):
    rng = random.Random(7)
    signs = [*"ab é😀.", *" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000", "\u200b", "\u180e", "\x00"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 12))) for _ in range(500)] + ["", " ", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.word_count(F.col("t")).alias("n"), tx.split_words(F.col("t")).alias("w")).collect()
    assert all((r["n"], r["w"]) == (len((r["t"] or "").split()), (r["t"] or "").split()) for r in rows)
