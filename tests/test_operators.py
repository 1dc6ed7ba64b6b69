import json
import os
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.operators import chunking, entities, faults, records, stores, summaries, triage, vectors
from tessera.plans import assembly, queries, record_queries
from tessera.sources import files, tracker

RECORD = "key string, fields string, attachments array<struct<id:string,filename:string,size:bigint,created:string>>"


def test_validation(spark):
    rows = [("A-1", "{}", []), ("", "{}", []), ("  ", "{}", []), ("A-2", "[1]", []), ("A-3", None, []), ("A-4", "{}", [("1", "", 1, "")]), ("A-5", "{}", [("1", " ", 1, "")])]
    frame = spark.createDataFrame(rows, RECORD)
    bad = lambda strict: [r["validation_error"] is not None for r in records.validate(frame, strict).collect()]
    assert bad(False) == [False, True, True, True, True, True, False]
    assert bad(True)[-1] is True


def test_timestamps_decide(spark):
    incoming = spark.createDataFrame([("a", "2024-06-01T10:00:00Z"), ("b", "2024-12-01T00:00:00Z"), ("c", "not-a-date"), ("d", "2024-03-15")], "key string, updated string")
    stored = spark.createDataFrame([("a", "2024-06-01T10:00:00.000+0000"), ("b", "2024-01-01T00:00:00Z"), ("c", "2024-01-01"), ("d", "2024-03-15T10:00:00Z")], "key string, updated_at string")
    assert {r["key"] for r in records.to_process(incoming, stored).collect()} == {"b", "c"}
    assert records.to_process(incoming, stored, force=True).count() == 4


def test_packing_drops_without_renumbering(spark):
    text = "\n\n".join(" ".join(["w"] * n) for n in (300, 200, 50, 390, 20))
    got = chunking.packed(spark.createDataFrame([(1, text)], "id int, text string")).collect()
    assert [(r["page_num"], r["word_count"]) for r in got] == [(1, 300), (2, 250), (3, 390)]


def pages_by_hand(counts, most=400, least=40):
    """The greedy fold: [first paragraph, words] of each page that is kept."""
    pages = []
    for i, n in enumerate(counts):
        if pages and pages[-1][1] + n <= most:
            pages[-1][1] += n
        else:
            pages.append([i, n])
    return [p for p in pages if p[1] >= least]


@pytest.mark.parametrize("block", [400, 4096])
def test_packing_by_jumps(spark, monkeypatch, block):
    """Documents of one block, of many, of one word a paragraph, of paragraphs above a page, without text: as the fold gives them."""
    monkeypatch.setattr(chunking, "PACK_BLOCK", block)
    rng = random.Random(8)
    sizes = {"many": [rng.choice([1, 5, 80, 399, 400, 401, 900]) for _ in range(2500)], "small": [1] * 3000, "one": [500], "few": [3], "mixed": [rng.randint(1, 60) for _ in range(900)]}
    docs = [(k, "\n\n".join(" ".join([f"w{i}"] * n) for i, n in enumerate(v)), "x") for k, v in sizes.items()] + [("empty", "", "x"), ("null", None, "x"), ("blank", " \n\n ", "x")]
    frame = spark.createDataFrame(docs, "id string, text string, page_num string")
    names = ["pos", "page_num", "chunk_id", "text", "word_count", "has_table", "source", "weight_multiplier"]
    jumped = chunking.packed_long(frame, ["id"])
    folded = chunking.packed(frame.drop("page_num"))
    assert sorted(map(tuple, jumped.select("id", *names).collect())) == sorted(map(tuple, folded.select("id", *names).collect()))
    got = sorted((r["page_num"], r["word_count"]) for r in jumped.filter("id = 'many'").collect())
    assert [n for _, n in got] == [n for _, n in pages_by_hand(sizes["many"])]
    assert chunking.packed_long(frame.filter("false"), ["id"]).count() == 0


def test_packing_ten_million_words(spark):
    rows = spark.range(330_000).select("id", (F.col("id") * 7919 % 59 + 1).cast("int").alias("n"))
    text = spark.createDataFrame([("\n\n".join("w " * (i * 7919 % 59 + 1) for i in range(330_000)),)], "text string").withColumn("id", F.lit(1))
    got = chunking.packed_long(text, ["id"]).select("page_num", "word_count").collect()
    counts = [r["n"] for r in rows.orderBy("id").collect()]
    assert sum(counts) > 9_800_000 and [r["word_count"] for r in sorted(got)] == [n for _, n in pages_by_hand(counts)]


def test_slides(spark):
    text = "".join(f"<!-- Slide number: {n} -->\n# Title {n}\n" + "word " * 30 for n in (1, 2, 61, 3))
    got = chunking.slides(spark.createDataFrame([("k", text), ("p", "just text")], "k string, text string")).collect()
    assert [(r["k"], r["slide_num"], r["slide_title"]) for r in got] == [("k", 1, "Title 1"), ("k", 2, "Title 2"), ("p", 1, "just text")]


def test_heading_sections(spark):
    text = "intro " * 12 + "\n# One\nshort\n## Two\n" + "word " * 12
    got = chunking.heading_sections(spark.createDataFrame([("k", text)], "k string, text string")).collect()
    assert [(r["section_num"], r["section_title"]) for r in got] == [(-1, ""), (1, "Two")]


def test_fallback_sections(spark):
    rows = [(1, i, f"text {i}", "no. header, here") for i in range(9)]
    got = chunking.sections(spark.createDataFrame(rows, "id int, pos int, text string, slide_title string"), ["id"]).collect()
    assert sorted(r["child_slide_count"] for r in got) == [1, 4, 4]


def test_triage_tiers_and_caps(spark):
    rows = queries.attachments(spark, "/root/testdata/sf0.001")
    done = triage.triage(rows)
    assert done.filter("full_extract").groupBy("ticket_key").count().filter("count > 5").count() == 0
    assert done.filter("doc_role = 'supporting_doc'").groupBy("ticket_key").count().filter("count > 4").count() == 0
    assert {r[0] for r in triage.artifact(done).select("triage_tier").distinct().collect()} <= {"A", "C"}


def test_size_zero_passes(spark):
    rows = spark.createDataFrame([("t", 0, "1", "idea card.pptx", 0, ""), ("t", 1, "2", "x.pptx", 100, "")], "ticket_key string, pos int, id string, filename string, size long, created string")
    assert [r[0] for r in triage.prefilter(rows).orderBy("pos").select("excluded_reason").collect()] == [None, "file too small"]


def test_mentions_first_wins(spark):
    terms = entities.dictionary(spark.createDataFrame([("systems", "K", ["k8s", "P&C"], 0), ("systems", "L", ["K8S"], 1)], "etype string, canonical string, aliases array<string>, ord int"))
    texts = spark.createDataFrame([("d", 0, "runs K8s, not k8sx"), ("d", 1, "the P&C line k8s")], "key string, pos int, text string")
    found = entities.best_mentions(entities.text_mentions(texts, terms, ["key"], ["pos"]), ["key"], ["pos"])
    assert {(r["term"], r["first_seen"][0]) for r in found.collect()} == {("L", 0), ("K", 1)}


def test_vectors(spark):
    index = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", [1.0, 0.0]), ("d", None)], "id string, embedding array<float>")
    assert [r["id"] for r in vectors.top_k(index, [1.0, 0.0], 5).collect()] == ["c", "a", "b"]
    shown, apart = vectors.split_vectors(index, ["id"])
    assert shown.filter("id = 'a'").first()["embedding"] == "<vector dim=2>"
    assert vectors.merge_vectors(shown, apart, ["id"]).filter("id = 'c'").first()["embedding"] == [1.0, 0.0]

    def failing():
        def call(texts, model):
            raise RuntimeError

        return call

    assert set(vectors.embed(spark.createDataFrame([("x",)], "t string"), "t", failing).first()["embedding"]) == {0.0}


def test_store_upserts(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path / "s"))
    assert store.read() is None and store.get("x") is None
    store.upsert(spark.createDataFrame([("x", 1), ("x", 2), ("y", 1)], "id string, v int"), ["v"])
    store.upsert(spark.createDataFrame([("y", 5, "new")], "id string, v int, more string"), ["v"])
    again = stores.Store(spark, str(tmp_path / "s"))
    assert (again.get("x")["v"], again.get("y")["v"], again.get("z")) == (2, 5, None)
    assert sorted((r["id"], r["v"], r["more"]) for r in again.read().collect()) == [("x", 2, None), ("y", 5, "new")]
    empty = stores.Store(spark, str(tmp_path / "e"))
    empty.upsert(spark.createDataFrame([], "id string, v int"), ["v"])
    assert empty.read() is None
    memory = stores.Store(spark, None, "memory")
    for v in (1, 2):
        memory.upsert(spark.createDataFrame([("x", v), ("x", 0)], "id string, v int"), ["v"])
    assert memory.get("x")["v"] == 2 and memory.get("q") is None
    with pytest.raises(ValueError, match="backend"):
        stores.Store(spark, None, "other")


def test_a_large_store_is_seldom_written(spark, tmp_path):
    """Small batches write their own rows only, until they are a quarter of the base; a stop before a version is published is as if nothing was."""
    rng, want = random.Random(2), {}
    store, kind = stores.Store(spark, str(tmp_path / "s")), "id string, v int"

    def upsert(ids, v):
        store.upsert(spark.createDataFrame([(i, v) for i in ids], kind), ["v"])
        want.update(dict.fromkeys(ids, v))
        assert {r["id"]: r["v"] for r in store.read().collect()} == want and store.get(ids[0])["v"] == v

    files_of = lambda: {p for p in (tmp_path / "s").rglob("*.parquet") if p.stat().st_size}
    upsert([str(i) for i in range(400)], 0)
    base = files_of()
    for v in range(1, 4):
        before = files_of()
        upsert([str(rng.randrange(450)) for _ in range(20)], v)
        assert before < files_of() and len(store._version()["parts"]) == v + 1
    assert base < files_of()
    publish = store._publish
    store._publish = lambda _: (_ for _ in ()).throw(InterruptedError())
    with pytest.raises(InterruptedError):
        store.upsert(spark.createDataFrame([("1", 99)], kind), ["v"])
    store._publish = publish
    assert store.get("1")["v"] == want["1"]
    upsert([str(i) for i in range(60)], 9)
    assert len(store._version()["parts"]) == 1
    store.vacuum()
    assert {r["id"]: r["v"] for r in store.read().collect()} == want and not base & files_of()


def test_labels_stay_apart(spark):
    with pytest.raises(ValueError, match="vs_labels"):
        stores.without_labels(spark.createDataFrame([(1, 2)], "id int, vs_labels int"))


def test_retries():
    policy = faults.RetryPolicy(backoff_base=2, jitter=False, backoff_max=3)
    assert [policy.delay(i) for i in range(3)] == [1, 2, 3]
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise faults.DownloadError("f")
        return "ok"

    assert policy.call(flaky, sleep=lambda _: None) == "ok"
    assert not policy.should_retry(faults.NotFoundError("k")) and not policy.should_retry(faults.AuthError("x"))
    assert "caused by ValueError" in str(faults.FetchError("k", ValueError("v")))


class FakeClient(tracker.TrackerClient):
    def authenticate(self):
        pass

    def get(self, key, fields):
        if key == "BAD-1":
            raise faults.FetchError(key)
        return {"key": key, "fields": {"summary": key}, "attachments": []}

    def download(self, url):
        return b""

    def close(self):
        pass


def test_tracker_reader():
    reader = tracker.TrackerReader({"keys": "A-1,BAD-1,A-1", "batch": "1", "url": ""}, lambda options: FakeClient())
    rows = [row for p in reader.partitions() for row in reader.read(p)]
    assert [(r[0], r[3] is None) for r in rows] == [("A-1", True), ("BAD-1", False)]
    with pytest.raises(ValueError, match="URL"):
        tracker.RestClient("http://x", "t").download("")
    with pytest.raises(RuntimeError):
        tracker.RestClient("http://x", "t").download("http://x/a")


def test_files(spark, tmp_path):
    frame = spark.createDataFrame([("a", [1])], "ticket_key string, l array<int>")
    for _ in range(2):
        files.write_documents(frame, str(tmp_path / "l"), "jsonl")
    (tmp_path / "l" / "part-x.json").write_text('\n{"ticket_key": "b", "l": [2]}\nbroken\n')
    assert files.read_lines(spark, str(tmp_path / "l"), frame.schema).count() == 3
    with pytest.raises(ValueError, match="format"):
        files.write_documents(frame, str(tmp_path / "z"), "xml")
    # keys written earlier stay, unless they are written again
    kind = "ticket_key string, v int"
    for rows in ([("007", 1), ("B", 1)], [("B", 2), ("C", 2)]):
        files.write_documents(spark.createDataFrame(rows, kind), str(tmp_path / "j"), "json")
    assert sorted(tuple(r) for r in files.read_documents(spark, str(tmp_path / "j"), kind).collect()) == [("007", 1), ("B", 2), ("C", 2)]
    assert [tuple(r) for r in files.read_documents(spark, str(tmp_path / "j"), kind, "007").collect()] == [("007", 1)]
    assert files.read_documents(spark, str(tmp_path / "j"), kind, "7").count() == 0


def test_dead_letters(spark, tmp_path):
    path = str(tmp_path / "d")
    files.clear_dead_letters(spark, path)
    bad = spark.createDataFrame([("A-1", "{}", [])], RECORD)
    for _ in range(2):
        files.append_dead_letters(records.to_dead_letters(bad, "validation", "SchemaError", F.lit("why")), path)
    assert [r["ticket_key"] for r in files.read_dead_letters(spark, path).collect()] == ["A-1", "A-1"]
    files.clear_dead_letters(spark, path)
    assert files.read_dead_letters(spark, path).count() == 0


def test_top_k_of_each(spark):
    index = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", [1.0, 0.0]), ("d", None), ("e", [1.0, 2.0, 3.0]), ("f", [-1.0, 1.0])], "id string, embedding array<float>")
    asked = spark.createDataFrame([(1, [2.0, 0.0]), (2, [0.0, 1.0])], "query_id int, q array<double>")
    got = vectors.top_k_of_each(index, asked, 2).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["id"]) for r in got] == [(1, 1, "c"), (1, 2, "a"), (2, 1, "f"), (2, 2, "c")]
    assert vectors.with_records(vectors.top_k_of_each(index, asked, 1), index.select("id", F.lit("x").alias("title"))).filter("title = 'x'").count() == 2
    with pytest.raises(ValueError, match="queries"):
        vectors.top_k_of_each(index, asked, 2, most_queries=1)


def test_search_with_more_queries_than_a_part(spark, tmp_path, monkeypatch):
    """The query's SQL over 1,010 queries, equal and nearly equal vectors among them; parts and blocks split them."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 64)).astype(np.float32)
    vector = [(base[i % 60] * np.float32(1 if i % 3 else 1 + i % 5 / 7)).tolist() for i in range(1010)]
    vector[50] = [0.0] * 64
    rows = {"vec_id": pa.array(range(3, 101_003, 100), pa.int64()), "embedding": pa.array(vector, pa.list_(pa.float32())), "label": pa.array([i % 10 for i in range(1010)], pa.int32())}
    pq.write_table(pa.table(rows), tmp_path / "embeddings.parquet")
    for name, value in (("ROWS", 333), ("QUERIES", 64), ("CELLS", 1000)):
        monkeypatch.setattr(vectors, name, value)
    monkeypatch.setattr(vectors.top_k_of_all, "__defaults__", ("id", "embedding", 400))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    expected = db.sql(queries.ORACLE_SQL["search_with_records"]).fetchall()
    got = record_queries.search_with_records(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "label").collect()
    assert len(got) == 3 * 1010 and sorted(map(tuple, got)) == sorted(expected)


def test_disk_of_the_assembly(spark, sf, tmp_path, monkeypatch):
    """Stages that no later one reads are deleted; what is left of all takes little more than the tables that were read."""
    monkeypatch.setattr(files, "scratch", lambda _: f"{tmp_path}/{len(list(tmp_path.iterdir()))}-{random.random()}")
    got = queries.QUERIES["assembled_documents"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    read = sum(os.path.getsize(f"{sf}/{t}.parquet") for t in ("documents", "pages", "conversations", "benchmark"))
    assert held < 1.5 * read


def test_mentions_of_signs_and_repeated_texts(spark):
    terms = entities.dictionary(spark.createDataFrame([("systems", "S", ["&&", "the long platform"], 0)], "etype string, canonical string, aliases array<string>, ord int"))
    texts = spark.createDataFrame([("d", 0, "a&&b"), ("d", 0, "a&&b"), ("e", 1, "The Long PLATFORM."), (None, None, "the long platform"), ("f", 0, None)], "key string, pos int, text string")
    found = entities.text_mentions(texts, terms, ["key"], ["pos"]).collect()
    assert sorted((str(r["key"]), r["term"]) for r in found) == [("None", "S"), ("d", "S"), ("d", "S"), ("e", "S")]
    # any number of terms without a word, met by what stands between two words
    many = spark.createDataFrame([("systems", c, c) for c in [*map(chr, range(0x2500, 0x2600)), "&&", "& &", "a\\Eb"]], "etype string, term string, canonical string")
    signs = spark.createDataFrame([("x", 0, "a\u2501b c\u2502 \u2503d"), ("y", 0, "a&&b & &c"), ("z", 0, "x a\\Eb y"), ("z", 1, "a\\eb")], "key string, pos int, text string")
    found = entities.text_mentions(signs, many.withColumn("term", F.lower("term")), ["key"], ["pos"]).collect()
    assert sorted((r["key"], r["pos"], r["term"]) for r in found) == [("x", 0, "\u2501"), ("y", 0, "&&"), ("z", 0, "a\\Eb"), ("z", 1, "a\\Eb")]


def test_candidates_of_a_skewed_dictionary(spark):
    """A long word that stands in every text and in every term brings no pairs; mentions are those of a plain search."""
    n = 200
    texts = spark.createDataFrame([(str(i), 0, f"The internationalization of q{i}, q{i + 1} internationalization") for i in range(n)], "key string, pos int, text string")
    named = [("products", f"q{i} internationalization" if i % 2 else f"internationalization of q{i}", f"P{i}") for i in range(n)]
    terms = spark.createDataFrame([*named, ("products", "internationalization", "all"), ("products", "nowhere internationalization", "none")], "etype string, term string, canonical string")
    keyed = {r["term"]: (r["word"], r["texts"]) for r in entities.rarest_words(texts, terms).collect()}
    assert keyed["internationalization of q4"] == ("q4", 2) and keyed["internationalization"] == ("internationalization", n) and "nowhere internationalization" not in keyed
    met = entities.candidates(texts, terms, ["key", "pos"]).select("key", F.size("terms").alias("n")).collect()
    assert len(met) == n and max(r["n"] for r in met) == 3
    found = {(r["key"], r["term"]) for r in entities.text_mentions(texts, terms, ["key"], ["pos"]).collect()}
    rows = [(r["key"], r["text"].lower()) for r in texts.collect()]
    assert found == {(k, c) for k, t in rows for _, term, c in [*named, ("", "internationalization", "all")] if re.search(rf"\b{term}\b", t)}


def test_assembly(spark):
    fields = {"summary": "Pay", "description": "value " * 60, "components": [{"name": "Core"}], "issuelinks": [{"type": {"name": "Value Stream"}, "outwardIssue": {"key": "VS-1", "fields": {"summary": "Stream", "status": {"name": "Open"}}}}]}
    frame = spark.createDataFrame([("A-1", json.dumps(fields), []), ("", "{}", [])], RECORD)
    entries = spark.createDataFrame([("systems", "Core", [], 0)], "etype string, canonical string, aliases array<string>, ord int")
    stages = assembly.assemble(frame, entries, embedder=lambda: vectors.HashingEmbedder(8), keep=lambda _, rows: files.stored(rows))
    document = stages.documents.first()
    assert (document["ticket_key"], document["quality_tier"], document["chunk_count"]) == ("A-1", "C", 1)
    assert not set(stages.documents.columns) & set(stores.LABELS) and not set(stages.chunks.columns) & set(stores.LABELS)
    label = stages.supervision.first()
    assert label["linked_value_stream_ids"] == ["VS-1"] and label["trainability"]["is_trainable_for_vs"]
    assert stages.dead_letters.count() == 1
    assert stores.coarse_rows(stages.documents).count() == 1 and stores.fine_rows(stages.chunks).count() == 1
    assert assembly.chunk_records(stages.chunks, stages.documents).first()["contentType"] == "description"
    assert assembly.value_stream_records(stages.documents, stages.supervision).first()["valueStreamNames"] == ["Stream"]


def test_batch(spark, tmp_path):
    from tessera.plans import batch

    # a class of the test itself travels to the workers, which can't import this file
    class Files(tracker.TrackerClient):
        def authenticate(self):
            pass

        def get(self, key, fields):
            return {}

        def close(self):
            pass

        def download(self, url):
            if url == "gone":
                raise OSError(url)
            return ("<!-- Slide number: 1 -->\n# Idea\n" + "value stream customer platform " * 30 + "\n<!-- Slide number: 2 -->\n# Plan\n" + "benefit process " * 30).encode()

    kind = "key string, fields string, attachments array<struct<id:string,filename:string,content:string,size:bigint,created:string>>"
    decks = [("1", "idea card.pptx", "there", 20_000, "2024-01-01"), ("2", "notes.pdf", "gone", 20_000, "2024-01-01"), ("3", "x.png", "there", 20_000, "")]
    valid = spark.createDataFrame([("A-1", "{}", decks), ("A-2", "{}", [])], kind)
    got = batch.attachment_chunks(valid, Files, lambda data, name: data.decode()).collect()
    assert sorted((r["ticket_key"], r["attachment_id"], r["source"], r["slide_num"], r["slide_title"]) for r in got) == [("A-1", "1", "pptx_slide", 1, "Idea"), ("A-1", "1", "pptx_slide", 2, "Plan")]
    files.write_documents(valid.select(F.col("key").alias("ticket_id")).filter("key = 'A-2'"), f"{tmp_path}/{batch.CHUNKS}", "json", "ticket_id")
    assert batch.not_yet(spark, valid, str(tmp_path)).count() == 2
    files.write_documents(valid.select(F.col("key").alias("ticket_id")), f"{tmp_path}/{batch.STREAMS}", "json", "ticket_id")
    # only what has all of its outputs is left out
    assert [r["key"] for r in batch.not_yet(spark, valid, str(tmp_path)).collect()] == ["A-1"]
    assert batch.not_yet(spark, valid, f"{tmp_path}/none").count() == 2


def test_derived_fields():
    got = summaries.parse_derived('```json\n{"ticket_summary_llm": "s", "workflow_terms_llm": ["a"]}\n```')
    assert got["ticket_summary_llm"] == "s" and got["workflow_terms_llm"] == ["a"] and got["product_mentions_llm"] == []
    with pytest.raises(ValueError):
        summaries.parse_derived("no")


def test_quality_tiers(spark):
    rows = spark.createDataFrame([(True, "rich", 0), (True, "junk", 0), (False, "thin", 1), (False, "thin", 0)], "a boolean, c string, n int")
    assert [r[0] for r in rows.select(summaries.quality_tier(F.col("a"), F.col("c"), F.col("n"))).collect()] == ["A", "B", "C", "D"]
