"""Bytes of attachments: cheap peeks, conversion and OCR by injected functions. All of it by Arrow batches, row by row safe."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import cleaning
from tessera.functions import text as tx
from tessera.operators import reports

DRAWING = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
WORDS = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
OCR_TYPES = ("pdf", "pptx", "ppt")
#: What a peek can tell.
PEEK = T.StructType([
    T.StructField("error", T.StringType()), T.StructField("slide_count", T.IntegerType()), T.StructField("page_count", T.IntegerType()), T.StructField("estimated_words", T.IntegerType()),
    T.StructField("title", T.StringType()), T.StructField("has_tables", T.BooleanType()), T.StructField("has_notes", T.BooleanType()), T.StructField("text_bytes", T.LongType()),
    T.StructField("is_likely_idea_card", T.BooleanType()), T.StructField("is_likely_template", T.BooleanType()),
])


def peek_slides(data: bytes) -> dict:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        sizes = {i.filename: i.file_size for i in z.infolist()}
        slides = [n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)]
        title = None
        if "ppt/slides/slide1.xml" in sizes:
            try:
                runs = list(ElementTree.fromstring(z.read("ppt/slides/slide1.xml")).iter(f"{DRAWING}t"))
                title = " ".join(r.text or "" for r in runs[:5]).strip() or None
            except ElementTree.ParseError:
                pass  # a broken slide has no title
        volume, n = sum(sizes[s] for s in slides), len(slides)
        tables = any(b"<a:tbl" in z.read(s) for s in slides[:3])
        notes = any(s.startswith("ppt/notesSlides/") for s in sizes)
    return {"slide_count": n, "title": title, "has_tables": tables, "has_notes": notes, "text_bytes": volume, "is_likely_idea_card": 3 <= n <= 60 and volume > 5_000, "is_likely_template": n <= 2 and volume < 3_000}


def peek_words(data: bytes) -> dict:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        if "word/document.xml" not in z.namelist():
            return {"error": "Not a valid DOCX"}
        size, raw = z.getinfo("word/document.xml").file_size, z.read("word/document.xml")
    title = None
    for paragraph in ElementTree.fromstring(raw).iter(f"{WORDS}p"):
        style = paragraph.find(f".//{WORDS}pStyle")
        if style is not None and "Heading" in (style.get(f"{WORDS}val") or ""):
            title = "".join(t.text or "" for t in paragraph.iter(f"{WORDS}t")).strip() or None
            if title:
                break
    return {"estimated_words": size // 6, "title": title, "has_tables": b"<w:tbl" in raw, "is_likely_idea_card": size // 6 > 200}


def peek_pages(data: bytes) -> dict:
    n = len(re.findall(rb"/Type\s*/Page\b", data))
    return {"page_count": n, "is_likely_idea_card": 2 <= n <= 80}


PEEKS: dict[str, Callable[[bytes], dict]] = {"pptx": peek_slides, "ppt": peek_slides, "docx": peek_words, "doc": peek_words, "pdf": peek_pages}


def peeks(files: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and a PEEK struct for each file (ext, file_bytes); sheets give nothing, broken files an error."""

    def look(ext: str | None, data: bytes | None) -> dict:
        try:
            return PEEKS[ext](data) if ext in PEEKS and data else {}
        except Exception as error:  # any byte stream may turn up
            return {"error": str(error) or type(error).__name__}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [look(e, d) for e, d in zip(batch.column("ext").to_pylist(), batch.column("file_bytes").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array([{n: f.get(n) for n in PEEK.names} for f in found], _arrow(PEEK))], [*keep, "peek"])

    schema = T.StructType([*(files.schema[k] for k in keep), T.StructField("peek", PEEK)])
    return files.select(*keep, *[c for c in ("ext", "file_bytes") if c not in keep]).mapInArrow(run, schema)


def _arrow(kind: T.StructType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def contents(files: DataFrame, keep: list[str], convert: Callable[[bytes, str], str] | None, ocr: Callable[[bytes, str], str] | None = None) -> DataFrame:
    """``keep``, text_content and error of each file (filename, ext, content, file_bytes); a bad file never fails the batch.

    Errors are no_content_url, markitdown_not_installed (no converter given) or "<Type>: <message>". Where the cleaned
    text is weak, OCR (if given) adds to that of PDFs and presentations.
    """

    def read(name: str, ext: str, url: str | None, data: bytes | None) -> tuple[str, str | None]:
        if not url and data is None:
            return "", "no_content_url"
        if convert is None:
            return "", "markitdown_not_installed"
        try:
            text = cleaning.clean(convert(data or b"", name))
            words = text.split()
            weak = len(words) < 25 or sum(c.isalnum() for c in text) < 0.45 * len(text) or len(words) < 2 * max(1, text.count("\n") + 1)
            if weak and ocr is not None and ext in OCR_TYPES:
                other = cleaning.clean(ocr(data or b"", name))
                text = max(text, other, key=len) if text in other or other in text else f"{text}\n\n[OCR]\n{other}"
            return text, None
        except Exception as error:  # converters fail in their own ways
            return "", f"{type(error).__name__}: {error}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [read(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("filename", "ext", "content", "file_bytes")), strict=True)]
            columns = [pa.array([g[i] for g in got], pa.string()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *columns], [*keep, "text_content", "error"])

    schema = T.StructType([*(files.schema[k] for k in keep), T.StructField("text_content", T.StringType()), T.StructField("error", T.StringType())])
    needed = [*keep, *[c for c in ("filename", "ext", "content", "file_bytes") if c not in keep]]
    return files.select(*needed).mapInArrow(run, schema)


def extract_features(chunks: DataFrame, key: list[str]) -> DataFrame:
    """What triage asks of a full extraction: words, business signals, density, template hits, chunks with content."""
    whole = reports.text_volume(chunks, key).withColumn("_words", tx.simple_words(F.col("text")))
    return whole.select(*key, F.lit(True).alias("extracted"), F.size("_words").alias("word_count"), tx.business_signals(F.col("_words")).alias("signals"), tx.semantic_density(F.col("_words")).alias("density"), F.col("template_hits").cast("int").alias("template_hits"), F.col("content_chunks").cast("int").alias("content_chunks"))
