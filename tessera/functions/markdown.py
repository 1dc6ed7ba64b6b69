"""Pipe tables of raw Markdown, written out for retrieval."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE = re.compile(r"(?m)\|[^\n]+\|\n\|[-:| ]+\|\n(?:\|[^\n]+\|\n?)+")
RULES = re.compile(r"\|[-:| ]+\|")
SCHEMA = T.ArrayType(T.StructType([T.StructField("full_text", T.StringType()), T.StructField("summary", T.StringType()), T.StructField("row_count", T.IntegerType()), T.StructField("col_count", T.IntegerType())]))


def describe(rows: list[list[str]], context: str | None = None, most: int = 15) -> dict:
    """A table with its header row, as text: a line for each of the first rows, and a summary."""
    if not rows:
        return {"full_text": "", "summary": "", "row_count": 0, "col_count": 0}
    head, *body = [[c.strip() for c in row] for row in rows]
    named = [c for c in head if c]
    lines = [f"Table from: {context}"] if context else []
    lines.append(f"Columns: {' | '.join(named)}")
    for n, row in enumerate(body[:most], 1):
        labels = head[: len(row)] + [""] * (len(row) - len(head))
        lines.append(f"Row {n}: " + " | ".join(f"{h}: {c}" if h else c for h, c in zip(labels, row, strict=True)))
    if len(body) > most:
        lines.append(f"... and {len(body) - most} more rows")
    sample = [c for c in (body[0] if body else []) if c][:3]
    summary = f"Table with columns: {', '.join(named)}" + (f" (e.g. {'; '.join(sample)})" if sample else "")
    return {"full_text": "\n".join(lines), "summary": summary, "row_count": len(body), "col_count": len(head)}


def tables(text: str | None) -> list[dict]:
    found = []
    for block in TABLE.findall(text or ""):
        rows = [line.strip() for line in block.strip().splitlines()]
        cells = [[c.strip() for c in r.strip("|").split("|")] for r in rows if r.startswith("|") and not RULES.fullmatch(r)]
        if cells:
            found.append(describe(cells))
    return found


@F.pandas_udf(SCHEMA)
def _tables(texts: pd.Series) -> pd.Series:
    return texts.map(tables, na_action=None)


def parse_tables(text: Column) -> Column:
    """The pipe tables of a Markdown text, before any cleaning (which takes their rules away)."""
    return _tables(text)
