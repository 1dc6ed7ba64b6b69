"""Fill-in-the-middle transformation in Spark SQL alone: units by a pattern, cuts by SHA-256, sentinels that part the output again.

A text becomes an array of units, two hashes of its id cut the array into prefix, middle and suffix, and two more choose
whether and in which order they are arranged. Everything of a row follows from that row: no shuffle, no state, no Python.

Odd input: a null text is empty, and an empty text, or one that holds a sentinel itself, stays plain; a null id hashes as an
empty one; equal rows give equal outputs; columns beside the id and the text are passed through by :func:`arrange` (those
whose names clash with its own are replaced) and left out by :func:`digest`. A unit pattern has to cover the whole text: a
text of which the pattern leaves something out stays plain.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed by the contract: the sentinels of prefix, suffix and middle, and the shares of plain and of suffix-first texts.
SENTINELS = ("<P>", "<S>", "<M>")
PLAIN_FROM, SPM_BELOW = 90, 20
#: Units by which texts can be cut.
CHARACTERS, LINES, WORDS = r"(?s).", r"[^\n]*\n|[^\n]+", r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Infill:
    """How texts are cut and arranged: the unit, sentinels like ``<name>``, per cent from which texts stay plain, per cent
    of the others that begin with the suffix, and a salt for another draw."""

    unit: str = CHARACTERS
    sentinels: tuple[str, str, str] = SENTINELS
    plain_from: int = PLAIN_FROM
    spm_below: int = SPM_BELOW
    salt: str = "1"

    def __post_init__(self) -> None:
        # no sentinel begins inside another one, or across the end of a part: splitting by them is unambiguous
        if len(set(self.sentinels)) != 3 or not all(re.fullmatch(r"<[^<>\\]+>", s) for s in self.sentinels):
            raise ValueError("sentinels are three different texts of the form <name>")


def arrange(docs: DataFrame, how: Infill = Infill(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:  # noqa: B008
    """Each row with ``form`` (plain, psm or spm), ``output``, ``n`` units, and the code points of prefix and middle (null if plain)."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("form", "output", "n", "prefix_chars", "middle_chars")]
    p, s, m = map(F.lit, how.sentinels)
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    hashed = F.sha2(F.concat(F.lit(f"{how.salt}:"), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))), 256)
    group = lambda i: F.conv(F.substring("_sha", 8 * i - 7, 8), 16, 10).cast("long")
    units = docs.select(*kept, text.alias("_text"), hashed.alias("_sha"), F.regexp_extract_all(text, F.lit(how.unit), F.lit(0)).alias("_units"))
    holds = F.contains("_text", p) | F.contains("_text", s) | F.contains("_text", m)
    whole = F.lit(True) if how.unit == CHARACTERS else F.array_join("_units", "") == F.col("_text")
    plain = (F.col("_text") == "") | holds | (group(3) % 100 >= how.plain_from) | ~whole
    n = F.size("_units")
    cuts = units.select(
        "*", n.cast("long").alias("n"),
        F.when(plain, "plain").when(group(4) % 100 < how.spm_below, "spm").otherwise("psm").alias("form"),
        F.least(group(1) % (n + 1), group(2) % (n + 1)).cast("int").alias("_from"), F.greatest(group(1) % (n + 1), group(2) % (n + 1)).cast("int").alias("_to"),
    )
    part = lambda start, size: F.array_join(F.slice("_units", start, size), "")
    parts = F.struct(part(F.lit(1), F.col("_from")).alias("prefix"), part(F.col("_from") + 1, F.col("_to") - F.col("_from")).alias("middle"), part(F.col("_to") + 1, F.size("_units") - F.col("_to")).alias("suffix"))
    names = [c for c in cuts.columns if not c.startswith("_") or c in docs.columns]
    # the parts are made once for each row: a subexpression of one projection, and of no plain row
    made = cuts.select(*[F.col(f"`{c}`") for c in names], "_text", F.when(F.col("form") != "plain", parts).alias("_parts"))
    a, b, c = (F.col(f"_parts.{x}") for x in ("prefix", "middle", "suffix"))
    output = F.when(F.col("form") == "plain", F.col("_text")).when(F.col("form") == "psm", F.concat(p, a, s, c, m, b)).otherwise(F.concat(s, c, p, a, m, b))
    return made.select(*[F.col(f"`{c}`") for c in names], output.alias("output"), F.char_length(a).cast("long").alias("prefix_chars"), F.char_length(b).cast("long").alias("middle_chars"))


def restored(output: Column | str, form: Column | str, how: Infill = Infill()) -> Column:  # noqa: B008
    """The text that an output was made of, told from the output and its form alone; null for what no text could have given."""
    output, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    p, s, m = how.sentinels
    parts = F.split(output, "<(?:" + "|".join(re.escape(x[1:-1]) for x in how.sentinels) + ")>", -1)
    # psm gives ["", prefix, suffix, middle], spm ["", suffix, prefix, middle]; an array of one binds them, so that they are made once
    psm = lambda x: F.when(F.concat(F.lit(p), x[1], F.lit(s), x[2], F.lit(m), x[3]) == output, F.concat(x[1], x[3], x[2]))
    spm = lambda x: F.when(F.concat(F.lit(s), x[1], F.lit(p), x[2], F.lit(m), x[3]) == output, F.concat(x[2], x[3], x[1]))
    bound = F.when(form.isin("psm", "spm"), F.filter(F.array(parts), lambda x: F.size(x) == 4))
    whole = F.get(F.transform(bound, lambda x: F.when(form == "psm", psm(x)).otherwise(spm(x))), F.lit(0))
    return F.when(form == "plain", output).otherwise(whole)


def digest(docs: DataFrame, how: Infill = Infill()) -> DataFrame:  # noqa: B008
    """The contract's row for each document: sizes, form, and digests of the output and of the text restored from it."""
    made = arrange(docs.select("doc_id", "text"), how)
    sha = lambda c: F.sha2(c, 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored("output", "form", how)).alias("restored_sha256"))


#: Positions are counted with length() and substr(), which count code points in DuckDB.
ORACLE_SQL = """
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), groups AS (
    SELECT doc_id, t, n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM hashed
), cuts AS (
    SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM groups
), parts AS (
    SELECT doc_id, t, n, a, b, form, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
