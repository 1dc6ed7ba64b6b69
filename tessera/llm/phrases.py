"""Substring dedup by repeated-phrase automata: passages of ``window`` words that an earlier document also holds.

1. *Confirm recurring passages.* Of every run of ``window`` words, the phrase of half as many words with the least
   hash stands for it (equal runs have equal phrases). Phrases that occur in two or more different documents recur.
   Documents with the same words are settled at once: all but the first lose every word that is in a window.
2. *Compile sharded automata.* Documents that hold recurring phrases are dealt into shards of bounded bytes; for each
   shard, the phrases recurring in its documents are compiled into an Aho-Corasick automaton.
3. *Stream the documents.* Each document of a shard runs through the shard's automaton, which finds every occurrence
   of every phrase. The windows around the occurrences are compared across all documents by 96-bit hashes: a window
   goes where its words also start in a document with a smaller id.

No stage gathers a phrase's or a window's occurrences: first documents are minima, added up before any shuffle.

Edge cases: null text has no words; documents with fewer than ``window`` words lose nothing; a null doc_id is neither
earlier nor later than others and its row loses nothing; repeated rows get equal results (doc_id names one text);
an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _text as tx
from tessera.llm._spark import bloom, cut, prepare, store, through_bloom

WINDOW = 50
SHARD_BYTES = 1 << 18


def _phrase(window: int) -> int:
    return max(1, window // 2)


def _summaries(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, n_words, h1, h2, phrases): hashes of each document's word sequence and of its windows' phrases."""
    size = _phrase(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tx.slices(batch.column("text")):
                starts, ends, bounds = tx.word_spans(data, offsets)
                words = [tx.word_hashes(data, starts, ends, w) for w in range(2)]
                sequence = [tx.SpanHasher(h, w)(bounds[:-1], bounds[1:]).view(np.int64) for w, h in enumerate(words)]
                grams = tx.rolling(words[0], size)
                picked = tx.minimizers(grams, bounds, size, window)
                of, phrase = np.searchsorted(bounds, picked, side="right") - 1, grams[picked]
                order = np.lexsort((phrase, of))
                of, phrase = of[order], phrase[order]
                new = np.ones(len(of), dtype=bool)
                new[1:] = (of[1:] != of[:-1]) | (phrase[1:] != phrase[:-1])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of[new], np.arange(b - a + 1)).astype(np.int32)), pa.array(phrase[new].view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(np.diff(bounds)), *map(pa.array, sequence), lists], ["doc_id", "n_words", "h1", "h2", "phrases"])

    return docs.mapInArrow(run, "doc_id long, n_words long, h1 long, h2 long, phrases array<long>")


def _locate(window: int):
    """Windows around every occurrence of a shard's phrases in its documents."""
    size = _phrase(window)

    def shard(docs: list[tuple[int, bytes, list[int]]]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(d[1] for d in docs), dtype=np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(d[1]) for d in docs])]).astype(np.int64)
        starts, ends, bounds = tx.word_spans(data, offsets)
        words = [tx.word_hashes(data, starts, ends, w) for w in range(2)]
        at, _ = tx.windows(bounds, size)
        grams = tx.SpanHasher(words[0])(at, at + size).view(np.int64)
        wanted = np.unique(np.concatenate([np.asarray(d[2], np.int64) for d in docs]))
        # the text of each phrase, from one of the places that have its hash
        _, first = np.unique(grams, return_index=True)
        first = first[np.isin(grams[first], wanted)]
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        raw = data.tobytes()
        spell = lambda a, b: " " + " ".join(w.decode("latin-1") for w in raw[starts[a] : ends[b - 1]].split()) + " "
        for p in at[first]:
            automaton.add_word(spell(p, p + size))
        automaton.make_automaton()
        flags = np.zeros(len(starts) + 1, dtype=np.int64)
        for i in range(len(docs)):
            a, b = bounds[i], bounds[i + 1]
            if b - a < window:
                continue
            # bytes stand for characters, so that a word's length is its bytes; every word is led by one space
            lengths = ends[a:b] - starts[a:b] + 1
            ends_at = np.cumsum(lengths)
            hits = np.fromiter((e for e, _ in automaton.iter(spell(a, b))), dtype=np.int64)
            last = np.searchsorted(ends_at, hits)  # a hit ends on the space after its last word
            begin = a + last - size + 1
            np.add.at(flags, np.maximum(begin - (window - size), a), 1)
            np.add.at(flags, np.minimum(begin, b - window) + 1, -1)
        picked, of = tx.windows(bounds, window)
        keep = np.cumsum(flags)[picked] > 0
        picked, of = picked[keep], of[keep]
        hashes = [tx.SpanHasher(h, w)(picked, picked + window) for w, h in enumerate(words)]
        ids = np.array([d[0] for d in docs], dtype=np.int64)
        columns = [ids[of], (picked - bounds[of]).astype(np.int32), hashes[0].view(np.int64), (hashes[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "pos", "w1", "w2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[tuple[int, bytes, list[int]]] = []
        total = 0
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for doc_id, text, phrases in zip(batch.column("doc_id").to_pylist(), texts, batch.column("phrases").to_pylist(), strict=True):
                docs.append((doc_id, text, phrases))
                total += len(text)
                if total >= SHARD_BYTES:
                    yield shard(docs)
                    docs, total = [], 0
            tx.release()
        if docs:
            yield shard(docs)

    return run


def _remove(window: int):
    """The digest of each document without its removed words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            lists = batch.column("positions")
            places, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
            out = []
            for i, (doc_id, text, copy) in enumerate(zip(batch.column("doc_id").to_pylist(), texts, batch.column("copy").to_pylist(), strict=True)):
                words = (text.as_py() or b"").split()
                n, gone = len(words), 0
                positions = places[bounds[i] : bounds[i + 1]]
                if copy and n >= window:
                    words, gone = [], n
                elif len(positions):
                    cut_out = tx.covered(np.unique(positions.astype(np.int64)), window, n)
                    gone = int(cut_out.sum())
                    words = [w for w, c in zip(words, cut_out.tolist(), strict=True) if not c]
                kept = b" ".join(words)
                out.append((doc_id, n, gone, hashlib.sha256(kept).hexdigest(), kept.decode()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return run


def removed_windows(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """((doc_id, pos): windows to remove, (doc_id): later copies of whole documents)."""
    summary = store(_summaries(docs, window))
    known = summary.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    classes = known.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last"), F.min_by("phrases", "doc_id").alias("phrases"))
    classes = store(classes)
    firsts = classes.filter(F.col("last") > F.col("doc_id")).select("h1", "h2", F.col("doc_id").alias("first"))
    copies = known.select("doc_id", "h1", "h2").join(firsts, ["h1", "h2"]).filter(F.col("doc_id") > F.col("first")).select("doc_id")
    held = classes.select("doc_id", F.explode("phrases").alias("phrase"))
    recurring = held.groupBy("phrase").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("phrase")
    lists = cut(held.join(recurring, "phrase").groupBy("doc_id").agg(F.collect_list("phrase").alias("phrases")))
    texts = through_bloom(docs, bloom(lists, "doc_id"), "doc_id", keep=True)
    found = store(texts.join(lists, "doc_id").select("doc_id", "text", "phrases").mapInArrow(_locate(window), "doc_id long, pos int, w1 long, w2 int"))
    first = found.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter(F.col("last") > F.col("first")).drop("last")
    return found.join(first, ["w1", "w2"]).filter(F.col("doc_id") > F.col("first")).select("doc_id", "pos"), copies


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the words left, joined by one space) of every document."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    windows, copies = removed_windows(docs, window)
    marks = windows.groupBy("doc_id").agg(F.collect_set("pos").alias("positions")).withColumn("copy", F.lit(False))
    marks = cut(marks.unionByName(copies.distinct().select("doc_id", F.lit(None).cast("array<int>").alias("positions"), F.lit(True).alias("copy"))).groupBy("doc_id").agg(F.max("copy").alias("copy"), F.first("positions", ignorenulls=True).alias("positions")))
    some = bloom(marks, "doc_id")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    # documents that surely lose nothing aren't shuffled
    changed = through_bloom(docs, some, "doc_id", keep=True).join(marks, "doc_id", "left").select("doc_id", "text", "copy", "positions")
    same = docs.select("doc_id", "text", F.lit(False).alias("copy"), F.lit(None).cast("array<int>").alias("positions"))
    return changed.mapInArrow(_remove(window), schema).unionByName(through_bloom(same, some, "doc_id", keep=False, run=_remove(window), schema=schema))


def dedup_digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    return dedup(docs, window).drop("kept")
