"""Whole batches: documents by key, the commit log, and runs that stop between two sinks."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import stores
from tessera.plans import batch
from tessera.sources import commits, documents, files

RECORD = "key string, fields string, attachments array<struct<id:string,filename:string,content:string,size:bigint,created:string>>, error string"


def stored(path):
    return sorted(p for p in path.rglob("*") if p.is_file() and not p.name.startswith("."))


def test_documents_by_key(spark, tmp_path):
    path, kind = tmp_path / "d", "key string, v int"
    odd = ["a/b", "ü ?*", "k" * 300, ".", "A", "a"]
    documents.write(spark.createDataFrame([(k, 1) for k in odd], kind), str(path), "key", 16)
    documents.write(spark.createDataFrame([("a", 2), ("new", 2), ("k" * 300, 2)], kind), f"file://{path}", "key")
    want = {**dict.fromkeys(odd, 1), "a": 2, "new": 2, "k" * 300: 2}
    read = lambda key=None: {r["key"]: r["v"] for r in documents.read(spark, str(path), kind, key).collect()}
    assert read() == want and {r["key"] for r in documents.keys(spark, str(path)).collect()} == set(want)
    assert all(read(k) == {k: want[k]} for k in ("a", "a/b", "k" * 300)) and read("none") == {}
    documents.compact(spark, str(path))
    assert read() == want and read("a/b") == {"a/b": 1} and read("k" * 300) == {"k" * 300: 2}
    assert len(stored(path)) == len(want) + 1 and len(documents.commits(str(path))) == 1
    documents.write(spark.createDataFrame([], kind), str(tmp_path / "e"), "key")
    assert documents.read(spark, str(tmp_path / "e"), kind).count() == 0 and documents.read(spark, str(tmp_path / "no"), kind).count() == 0


def test_one_key_reads_one_file(spark, tmp_path):
    path, kind = tmp_path / "d", "key string, v int"
    documents.write(spark.createDataFrame([(str(i), i) for i in range(50)], kind), str(path), "key", 4)
    for p in stored(path):
        if p.name != "7.json" and p.parent.name != documents.COMMITS:
            p.chmod(0)
            p.write_bytes(b"\xff broken") if p.stat().st_mode & 0o200 else None
    (row,) = spark.read.format("documents").option("key", "7").load(str(path)).collect()
    assert json.loads(row["document"]) == {"key": "7", "v": 7}


def test_failed_tasks_leave_nothing(spark, tmp_path):
    path, kind = tmp_path / "d", "key string, v int"
    documents.write(spark.createDataFrame([("a", 1)], kind), str(path), "key")
    before = {p: p.read_bytes() for p in stored(path)}
    failing = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), F.when(F.col("id") == 1999, F.raise_error(F.lit("stop"))).otherwise(1).cast("int").alias("v"))
    for rows in (failing, spark.createDataFrame([("b", 1), (None, 2)], kind)):
        with pytest.raises(Exception, match="stop|without a key"):
            documents.write(rows, str(path), "key")
    assert {p: p.read_bytes() for p in stored(path)} == before and not [p for p in path.iterdir() if p.is_dir() and not any(p.iterdir())]
    assert [r["key"] for r in documents.read(spark, str(path), kind).collect()] == ["a"]


def test_commit_log(spark, tmp_path):
    log, seen = commits.BatchLog(spark, str(tmp_path)), []
    sinks = {n: lambda rows, n=n: seen.append((n, rows.count())) for n in ("a", "b")}
    assert log.recover(lambda _: sinks) == {} and log.rows().count() == 0
    one = log.begin()
    one.stage("a", spark.range(3))
    with pytest.raises(RuntimeError, match="recover"):
        log.begin()
    with pytest.raises(RuntimeError, match="committed"):
        log.apply(1, sinks)
    assert log.recover(lambda _: sinks) == {1: "dropped"} and seen == [] and log.numbers() == []
    two = log.begin()
    assert two.keep("work", spark.range(5)).count() == 5
    two.stage("a", spark.range(3))
    two.stage("b", spark.range(0))
    two.commit()
    with pytest.raises(ValueError, match="no sink for b"):
        log.apply(two.number, {"a": sinks["a"]})
    assert seen == [] and log.recover(lambda _: sinks) == {1: "applied"} and seen == [("a", 3), ("b", 0)]
    assert sorted(tuple(r) for r in log.rows().collect()) == [(1, "applied", "a", 3), (1, "applied", "b", 0)]
    assert not (tmp_path / commits.FOLDER / f"{1:010d}" / "_work").exists()
    three = log.begin()
    three.stage("a", spark.range(1))
    three.commit()
    log.apply(three.number, sinks)
    log.forget()
    assert log.numbers() == [2] and log.begin().number == 3


def fields(text, updated, streams=()):
    links = [{"type": {"name": "Value Stream", "outward": "implements"}, "outwardIssue": {"key": k, "fields": {"summary": f"stream {k}", "status": {"name": "Open"}}}} for k in streams]
    return json.dumps({"summary": "One", "description": text, "updated": updated, "issuelinks": links})


def test_a_batch_stops_between_two_sinks(spark, tmp_path, monkeypatch):
    """From records to all outputs: one can't be fetched, one isn't valid; one run stops half-way through its sinks, one before its commit."""
    out, tables = tmp_path / "out", stores.Tables.create(spark, str(tmp_path / "tables"))
    dictionary = spark.createDataFrame([("capability", "platform", ["plat"], 0)], "etype string, canonical string, aliases array<string>, ord int")
    deck = [("1", "idea card.pptx", "there", 20_000, "2024-01-01")]
    rows = [("A-1", fields("the platform " * 40, "2024-01-01", ["VS-1"]), deck, None), ("A-2", fields("", "2024-01-02"), [], None), ("A-3", None, [], "NotFoundError: gone"), ("A-4", "[]", [], None)]
    slides = spark.createDataFrame([("A-1", "1", "pptx", 1, "slide_1", "customer platform benefit " * 20, "pptx_slide", 60)], "ticket_key string, attachment_id string, ext string, pos int, chunk_id string, text string, source string, word_count int")
    slides = slides.withColumns({"slide_num": F.lit(1), "slide_title": F.lit("Idea")})
    incoming = spark.createDataFrame(rows, RECORD)
    upsert = stores.Store.upsert

    def stops(self, *args):
        if "metadata" in self.path:
            raise InterruptedError("stopped")
        upsert(self, *args)

    monkeypatch.setattr(stores.Store, "upsert", stops)
    with pytest.raises(InterruptedError):
        batch.run(incoming, dictionary, str(out), tables, lambda _: slides)
    log = commits.BatchLog(spark, str(out))
    assert log.state(1) == "committed" and tables.metadata.read() is None and not (out / batch.TOTALS).exists()
    monkeypatch.setattr(stores.Store, "upsert", upsert)
    assert batch.recover(spark, str(out), tables) == {1: "applied"} and batch.recover(spark, str(out), tables) == {}

    def seen():
        ids = lambda t: sorted(r["id"] for r in t.read().select("id").collect())
        shown = files.read_documents(spark, f"{out}/{batch.CHUNKS}", "ticket_id string, chunk_count long, mapped_value_stream_ids array<string>").collect()
        errors = spark.read.json(f"{out}/{batch.ERRORS}").select("ticket_id", "batch").collect()
        return ids(tables.coarse), ids(tables.metadata), ids(tables.supervision), sorted((r[0], r[1], r[2]) for r in shown), sorted(map(tuple, errors)), spark.read.json(f"{out}/{batch.TOTALS}").drop("batch").collect()

    first = seen()
    keys = ["A-1", "A-2"]
    assert first[:3] == (keys, keys, keys) and [x[0] for x in first[3]] == keys and first[3][0][2] == ["VS-1"] and first[3][0][1] >= 2
    assert first[4] == [("A-3", 1), ("A-4", 1)]
    (totals,) = first[5]
    assert (totals["processed"], totals["failed"], totals["with_value_streams"]) == (2, 2, 1)

    # a later batch that stops before its commit isn't seen, and is dropped by the next one
    changed = spark.createDataFrame([("A-2", fields("", "2024-02-02", ["VS-2"]), [], None)], RECORD)
    monkeypatch.setattr(commits.Batch, "commit", lambda self: (_ for _ in ()).throw(InterruptedError()))
    with pytest.raises(InterruptedError):
        batch.run(changed, dictionary, str(out), tables)
    monkeypatch.undo()
    assert seen() == first
    done = batch.run(changed, dictionary, str(out), tables)
    assert done.number == 2 and done.streams.first()["valueStreamIds"] == ["VS-2"] and done.errors.count() == 0 and done.totals.first()["processed"] == 1
    # what was observed as the plans ran is what the reports count afterwards
    observed = {r["stage"]: r["extra"] for r in done.events.collect()}
    assert (observed["streams"]["rows"], observed["streams"]["with_value_streams"]) == ("1", str(done.totals.first()["with_value_streams"])) and observed["errors"]["rows"] == "0"
    assert int(observed["chunk_records"]["rows"]) == done.totals.first()["total_chunks"] and observed["chunk_records"]["with_vector"] == "0"
    assert all(r["ingest_ms"] > 0 for r in done.events.collect()) and (out / batch.EVENTS / "batch=2").exists()
    after = seen()
    assert after[:3] == (keys, keys, keys) and after[3][1][2] == ["VS-2"] and after[3][0] == first[3][0] and after[4] == first[4]
    # without force, records with all of their outputs are left out
    again = batch.run(incoming.filter("key < 'A-3'"), dictionary, str(out), tables, force=False)
    assert again.chunks.count() == 0 and seen()[3] == after[3]
