"""A batch of records from its keys to stored outputs: attachments fetched and cut by kind, everything assembled, written and counted.

Outputs of a record are replaced by the next run for it: JSON by key for its chunks and its labels, tables for all of a
batch. A record that can't be fetched or isn't valid gives an error row and doesn't hold up the others; without ``force``,
records whose outputs exist already are left out. All outputs of a batch are staged, committed together and then applied; what
an earlier run left half done is mended first (:mod:`tessera.sources.commits`). Errors and totals stay, by batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import text as tx
from tessera.operators import chunking, extract, faults, records, reports, stores, triage, vectors
from tessera.operators.faults import TokenBucket
from tessera.plans import assembly
from tessera.settings import DEFAULT, Settings
from tessera.sources import commits, documents, files
from tessera.sources.tracker import TrackerClient

#: Folders of a batch's outputs.
CHUNKS, STREAMS, ERRORS, TOTALS, EVENTS = "07_chunks", "08_valuestream_map", "_errors", "_totals", "_events"
#: How the text of a file becomes chunks, by its extension.
CUTTERS = {("pptx", "ppt"): chunking.slides, ("pdf",): chunking.packed, ("docx", "doc"): chunking.heading_sections}


def attached(valid: DataFrame) -> DataFrame:
    """(ticket_key, pos, attachment_id, ext, ...) of each attachment of valid records."""
    rows = valid.select(F.col("key").alias("ticket_key"), F.posexplode("attachments").alias("pos", "a")).select("ticket_key", "pos", "a.*")
    return rows.withColumns({"attachment_id": triage.attachment_id(rows), "ext": tx.extension(F.col("filename"))})


def fetched(rows: DataFrame, factory: Callable[[], TrackerClient], calls: int | None = None, rate: float | None = None, profile: ResourceProfile | None = None) -> DataFrame:
    """The rows with file_bytes, null where the download failed, and why (fetch_error). One client a partition.

    ``calls``: at most so many downloads at once, on the whole cluster: the rows are dealt to so many tasks. ``rate``: at most
    so many a second, of which each of the ``calls`` tasks has its share. ``profile``: what a fetching task asks of its
    executor, where the cluster schedules by stage.
    """
    if rate is not None and calls is None:
        raise ValueError("a rate needs a number of calls to share it")
    dealt = rows if calls is None else rows.repartition(calls)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client, bucket = factory(), None if rate is None else TokenBucket(rate / calls)
        client.authenticate()
        try:
            for batch in batches:
                data, errors = [], []
                for url in batch.column("content").to_pylist():
                    if bucket is not None:
                        bucket.take()
                    try:
                        data.append(client.download(url))
                        errors.append(None)
                    except Exception as error:  # one bad file never fails the batch
                        data.append(None)
                        errors.append(f"{type(error).__name__}: {error}")
                more = [pa.field("file_bytes", pa.binary()), pa.field("fetch_error", pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary()), pa.array(errors, pa.string())], schema=pa.schema([*batch.schema, *more]))
        finally:
            client.close()

    schema = T.StructType([*rows.schema.fields, T.StructField("file_bytes", T.BinaryType()), T.StructField("fetch_error", T.StringType())])
    return dealt.mapInArrow(run, schema) if profile is None else dealt.mapInArrow(run, schema, profile=profile)


def cut_by_kind(texts: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Chunks of texts (ticket_key, attachment_id, ext, text): slides, packed pages or heading sections; others give none."""
    rows = texts.select("ticket_key", "attachment_id", "ext", "text")
    parts = [cutter(rows.filter(F.col("ext").isin(*exts)), settings=settings) for exts, cutter in CUTTERS.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def attachment_chunks(valid: DataFrame, factory: Callable[[], TrackerClient], convert: Callable[[bytes, str], str], ocr: Callable[[bytes, str], str] | None = None, settings: Settings = DEFAULT, calls: int | None = None, rate: float | None = None) -> DataFrame:
    """Chunks of all attachments that triage doesn't exclude by name and size: downloaded, converted, cut by kind."""
    wanted = triage.prefilter(attached(valid), settings).filter("excluded_reason IS NULL")
    texts = extract.contents(fetched(wanted, factory, calls, rate), ["ticket_key", "attachment_id", "ext"], convert, ocr)
    return cut_by_kind(texts.filter(F.col("error").isNull()).withColumnRenamed("text_content", "text"), settings)


@dataclass
class Batch:
    """What a run has written; ``totals`` is one row, ``events`` one for each stage, with what was observed as it ran."""

    number: int
    chunks: DataFrame
    streams: DataFrame
    errors: DataFrame
    totals: DataFrame
    events: DataFrame


def not_yet(spark: SparkSession, incoming: DataFrame, out: str) -> DataFrame:
    """Incoming records of which the chunks or the labels aren't stored yet."""
    return records.not_done(incoming, *[documents.keys(spark, f"{out}/{name}") for name in (CHUNKS, STREAMS)])


def sinks(out: str, number: int, tables: stores.Tables | None = None) -> dict[str, commits.Sink]:
    """Where each output of a batch goes. All of them may run again."""
    by_key = lambda name: lambda rows: files.write_documents(rows, f"{out}/{name}", "json", "ticket_id")
    by_batch = lambda name: lambda rows: rows.write.mode("overwrite").json(f"{out}/{name}/batch={number}")
    found: dict[str, commits.Sink] = {"chunks": by_key(CHUNKS), "streams": by_key(STREAMS), "errors": by_batch(ERRORS), "totals": by_batch(TOTALS), "events": by_batch(EVENTS)}
    if tables is not None:
        found |= {name: lambda rows, name=name: getattr(tables, name).upsert(rows, assembly.ORDERS[name]) for name in assembly.ORDERS}
    return found


def recover(spark: SparkSession, out: str, tables: stores.Tables | None = None) -> dict[int, str]:
    """Drops or applies what a crash has left; gives what happened to which batch."""
    return commits.BatchLog(spark, out).recover(lambda number: sinks(out, number, tables))


def run(incoming: DataFrame, dictionary: DataFrame, out: str, tables: stores.Tables | None = None, chunks: Callable[[DataFrame], DataFrame] | None = None, embedder: Callable[[], vectors.Embedder] | None = None, settings: Settings = DEFAULT, force: bool = True, base_url: str = "") -> Batch:
    """Assembles, indexes and stores the records (key, fields, attachments and, if fetching can fail, error).

    ``chunks`` makes the chunks of the attachments of valid records, as :func:`attachment_chunks` does.
    """
    spark = incoming.sparkSession
    recover(spark, out, tables)
    log = commits.BatchLog(spark, out)
    batch = log.begin()
    # records are fetched once
    todo = batch.keep("incoming", incoming if force else not_yet(spark, incoming, out))
    lost = todo.filter(F.col("error").isNotNull()).select(F.col("key").alias("ticket_id"), "error") if "error" in todo.columns else None
    sound = todo if lost is None else todo.filter(F.col("error").isNull()).drop("error")
    checked = records.validate(sound)
    wrong = checked.filter("validation_error IS NOT NULL").select(F.col("key").alias("ticket_id"), F.col("validation_error").alias("error"))
    errors = batch.stage("errors", wrong if lost is None else wrong.unionByName(lost))
    cut = None if chunks is None else batch.keep("attachment_chunks", chunks(checked.filter("validation_error IS NULL").drop("validation_error")))
    stages = assembly.assemble(sound, dictionary, cut, embedder, settings, keep=batch.keep)
    stages = replace(stages, **{name: batch.keep(name, getattr(stages, name)) for name in ("documents", "chunks", "supervision")})
    if tables is not None:
        for name, rows in assembly.index_rows(stages).items():
            batch.stage(name, rows)

    own = batch.keep("chunk_records", assembly.chunk_records(stages.chunks, stages.documents, base_url), with_vector=F.count_if(F.col("content_vector").isNotNull()))
    streams = batch.stage("streams", assembly.value_stream_records(stages.documents, stages.supervision).withColumnRenamed("id", "ticket_id"), with_value_streams=F.count_if(F.size("valueStreamIds") > 0))
    # a record's chunks are few: one document holds them
    listed = own.groupBy(F.col("sourceId").alias("ticket_id")).agg(F.count("*").alias("chunk_count"), F.collect_list(F.struct(*own.columns)).alias("chunks"))
    mapped = streams.select("ticket_id", F.col("valueStreamIds").alias("mapped_value_stream_ids"), F.col("valueStreamNames").alias("mapped_value_stream_names"))
    written = batch.stage("chunks", mapped.join(listed, "ticket_id", "left").fillna(0, ["chunk_count"]))
    ended = streams.select("ticket_id", F.lit(None).cast("string").alias("error"), F.col("valueStreamIds").alias("value_stream_ids"), F.col("impactedProductIds").alias("product_ids"))
    results = ended.join(written.select("ticket_id", "chunk_count"), "ticket_id", "left").unionByName(errors, allowMissingColumns=True)
    totals = batch.stage("totals", reports.batch_totals(results))
    events = batch.stage("events", faults.events_frame(spark, batch.events))
    batch.commit()
    log.apply(batch.number, sinks(out, batch.number, tables))
    return Batch(batch.number, written.select(F.explode("chunks").alias("c")).select("c.*"), streams.withColumnRenamed("ticket_id", "id"), errors, totals, events)
