"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts anywhere else go.

The suffixes of the corpus are sorted blockwise, one bucket at a time, and only as deep as ``length`` bytes. A
suffix belongs to the bucket of its anchor: of the strings of half the length in its first ``length`` bytes, the one
with the least hash. Equal strings have equal anchors at equal places, so that strings in different buckets differ,
and a bucket of one suffix needs no sorting: anchors that occur once in the corpus are dropped before any text moves.

In a bucket, a suffix is known by the text around its anchor. A difference cover D modulo ``PERIOD`` gives, for every
suffix, a near place that is sampled; the samples of a block are ranked once by their next ``length - PERIOD`` bytes, and
suffixes are then compared by the few bytes before their sample, its rank, and the few bytes that the rank doesn't
reach: a tie is settled in constant time, however long, and a block needs memory for its own text only. Suffixes
that sort next to each other and agree so far are repeats.

A text known in a bucket many times over (copies) is kept there once, with its count, added up before the shuffle.
Buckets of more than ``BUCKET_TEXTS`` different texts are split further, by offset and by the hash of the whole string.
Documents that are equal as a whole are settled at once.

Edge cases: null text is empty; documents shorter than ``length`` lose nothing; a null doc_id takes part as a document
of its own (one for each distinct text); repeated rows are copies, and lose everything; an empty table gives an empty
result; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _text as tx
from tessera.llm._spark import bloom, cut, prepare, store, through_bloom

LENGTH = 200
PERIOD = 32
BLOCK_TEXTS = 4096
BUCKET_TEXTS = 20_000


def difference_cover(period: int) -> np.ndarray:
    """Residues of which any two places, moved on by some amount below ``period``, can both be members."""
    chosen, missing = [0], set(range(1, period))
    while missing:
        best = max(range(period), key=lambda c: (len({(c - x) % period for x in chosen} & missing | {(x - c) % period for x in chosen} & missing), -c))
        missing -= {(best - x) % period for x in chosen} | {(x - best) % period for x in chosen}
        chosen.append(best)
    return np.array(sorted(chosen))


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, hashes, texts) of the anchors of all strings of ``length`` bytes."""
    size = length // 2
    grams = tx.rolling(tx.BYTE_VALUES[0][data], size)
    places = tx.minimizers(grams, offsets, size, length)
    return places, grams[places].view(np.int64), np.searchsorted(offsets, places, side="right") - 1


def _summaries(docs: DataFrame, length: int) -> DataFrame:
    """(id, n_bytes, h1, h2, anchors) of each document; anchors as often as they are picked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tx.slices(batch.column("text")):
                _, hashes, of = _anchors(data, offsets, length)
                whole = [tx.byte_hasher(data, w)(offsets[:-1], offsets[1:]).view(np.int64) for w in range(2)]
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(b - a + 1)).astype(np.int32)), pa.array(hashes))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.array(np.diff(offsets)), *map(pa.array, whole), lists], ["id", "n_bytes", "h1", "h2", "anchors"])

    return docs.mapInArrow(run, "id long, n_bytes long, h1 long, h2 long, anchors array<long>")


def _contexts(length: int):
    """(anchor, known, id, place, text): the text around each recurring anchor, given once for each batch of documents."""
    size = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tx.slices(batch.column("text")):
                ids = batch.column("id").slice(a, b - a).to_numpy()
                lists = batch.column("anchors").slice(a, b - a)
                places, hashes, of = _anchors(data, offsets, length)
                wanted = lists.flatten().to_numpy()
                owner = np.repeat(np.arange(b - a), np.diff(lists.offsets.to_numpy()))
                pair = lambda d, h: tx.mix(h.view(np.uint64) + d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                keep = np.isin(pair(of, hashes), pair(owner, wanted))
                places, hashes, of = places[keep], hashes[keep], of[keep]
                # as far as windows reach, and not beyond the document
                low = np.maximum(places - (length - size), offsets[of])
                high = np.minimum(places + length, offsets[of + 1])
                known = tx.mix(tx.byte_hasher(data, 1)(low, high) + (places - low).astype(np.uint64)).view(np.int64)
                _, first = np.unique(known, return_index=True)
                given = np.zeros(len(known), dtype=bool)
                given[first] = True
                raw = data.tobytes()
                # bytes before the anchor that the text lacks are padded in front, so that anchors stand at one place
                texts = [raw[x:y] if g else None for x, y, g in zip(low.tolist(), high.tolist(), given.tolist(), strict=True)]
                columns = [pa.array(hashes), pa.array(known), pa.array(ids[of]), pa.array(places - offsets[of]), pa.array((places - low).astype(np.int32)), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "known", "id", "place", "before", "text"])

    return run


def sort_block(group: np.ndarray, texts: np.ndarray, first: np.ndarray, last: np.ndarray, counts: np.ndarray, length: int, period: int = PERIOD) -> np.ndarray:
    """Which suffixes of a block are repeats: a flag for each text (row) and start.

    ``texts`` has one row of bytes for each text; suffix o of a row exists if first <= o <= last. Rows of one group
    are compared; a row counts ``counts`` times.
    """
    n, starts = len(texts), texts.shape[1] - length + 1
    flags = np.zeros((n, starts), dtype=bool)
    cover = difference_cover(period)
    places = np.arange(texts.shape[1])
    sampled = places[np.isin(places % period, cover) & (places + length - period <= texts.shape[1])]
    ranks = {}
    row = length - period
    for c in sampled:
        part = np.ascontiguousarray(texts[:, c : c + row]).view(f"V{row}").ravel()
        ranks[c] = np.unique(part, return_inverse=True)[1]
    for o in range(starts):
        at = int(sampled[np.searchsorted(sampled, o)])
        head, tail = texts[:, o:at], texts[:, at + row : o + length]
        edge = np.zeros((n, -(-(head.shape[1] + tail.shape[1]) // 8) * 8), dtype=np.uint8)
        edge[:, : head.shape[1]] = head
        edge[:, head.shape[1] : head.shape[1] + tail.shape[1]] = tail
        own = (first <= o) & (o <= last)
        keys = [ranks[at], *np.ascontiguousarray(edge).view(np.uint64).T, group, ~own]
        order = np.lexsort(keys)
        same = np.ones(n - 1, dtype=bool)
        for k in keys:
            same &= k[order[1:]] == k[order[:-1]]
        run = np.concatenate([[0], np.cumsum(~same)])
        total = np.bincount(run, counts[order])[run]
        flags[order, o] = total >= 2
        flags[:, o] &= own
    return flags


def _pack(flags: np.ndarray) -> np.ndarray:
    return np.packbits(flags, axis=1)


def _matrix(texts: list[bytes], before: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows with their anchors at one place, first start, last start)."""
    reach = length - length // 2
    out = np.zeros((len(texts), reach + length), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts])
    flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
    begin = reach - before
    rows = np.repeat(np.arange(len(texts)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin, sizes)] = flat
    return out, begin, np.minimum(begin + sizes - length, reach)


def _sort_buckets(length: int):
    """(anchor, known, repeats): the packed flags of each text of each bucket; rows come sorted by anchor."""

    def solve(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
        anchor, known, counts, before = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(4))
        texts, first, last = _matrix([r[4] for r in rows], before, length)
        starts = texts.shape[1] - length + 1
        offsets = np.arange(starts)
        own = (first[:, None] <= offsets) & (offsets <= last[:, None])
        # texts that stand alone in their bucket need no sorting
        _, group, size = np.unique(anchor, return_inverse=True, return_counts=True)
        alone = size[group] == 1
        flags = own & (counts > 1)[:, None]
        if (~alone).any():
            some = np.flatnonzero(~alone)
            flags[some] = sort_block(group[some], texts[some], first[some], last[some], counts[some], length)
        packed = _pack(flags)
        return pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(known), pa.array([r.tobytes() for r in packed], pa.binary())], ["anchor", "known", "repeats"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "known", "n", "before", "text")), strict=True):
                if len(rows) >= BLOCK_TEXTS and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows = []
                rows.append(row)
            tx.release()
        if rows:
            yield solve(rows)

    return run


def _split_bucket(length: int):
    """(anchor, known, start, string, n): each suffix of a large bucket by itself, known by the hashes of its string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts, first, last = _matrix(part.column("text").to_pylist(), part.column("before").to_numpy(), length)
                starts = texts.shape[1] - length + 1
                rows, at = np.nonzero((first[:, None] <= np.arange(starts)) & (np.arange(starts) <= last[:, None]))
                begin = rows * texts.shape[1] + at
                hashes = [tx.byte_hasher(texts.ravel(), w)(begin, begin + length).view(np.int64) for w in range(2)]
                take = lambda c, part=part, rows=rows: part.column(c).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([take("anchor"), take("known"), pa.array(at.astype(np.int32)), *map(pa.array, hashes), take("n")], ["anchor", "known", "start", "s1", "s2", "n"])

    return run


def _starts_of(length: int):
    """(id, low, high): runs of bytes to remove, from the flags of each occurrence of each text."""
    reach = length - length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = np.frombuffer(b"".join(batch.column("repeats").to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
            flags = np.unpackbits(packed, axis=1)[:, : reach + 1].astype(np.int8)
            edges = np.diff(np.pad(flags, ((0, 0), (1, 1))), axis=1)
            rows, low = np.nonzero(edges == 1)
            _, high = np.nonzero(edges == -1)
            base = batch.column("place").to_numpy()[rows] - reach
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), pa.array(base + low), pa.array(base + high - 1 + length)], ["id", "low", "high"])

    return run


def repeated_runs(docs: DataFrame, length: int = LENGTH, bucket_texts: int = BUCKET_TEXTS) -> tuple[DataFrame, DataFrame]:
    """((id, low, high): byte runs to remove, (id): documents equal to another one)."""
    summary = store(_summaries(docs, length))
    long = summary.filter(F.col("n_bytes") >= length)
    classes = store(long.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.min_by("anchors", "id").alias("anchors")))
    again = classes.filter("n > 1").select("h1", "h2")
    copies = long.select("id", "h1", "h2").join(again, ["h1", "h2"]).select("id").distinct()
    held = classes.select("id", F.explode("anchors").alias("anchor"))
    recurring = held.groupBy("anchor").count().filter("count > 1").select("anchor")
    lists = cut(held.join(recurring, "anchor").groupBy("id").agg(F.collect_set("anchor").alias("anchors")))
    texts = through_bloom(docs, bloom(lists, "id"), "id", keep=True).join(lists, "id").select("id", "text", "anchors")
    found = store(texts.mapInArrow(_contexts(length), "anchor long, known long, id long, place long, before int, text binary"))
    known = store(found.groupBy("anchor", "known").agg(F.count("*").alias("n"), F.first("before").alias("before"), F.first("text", ignorenulls=True).alias("text")))
    large = cut(known.groupBy("anchor").count().filter(F.col("count") > bucket_texts).select("anchor"))
    repeats = known.join(large, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sort_buckets(length), "anchor long, known long, repeats binary")
    if large.take(1):
        split = store(known.join(large, "anchor").mapInArrow(_split_bucket(length), "anchor long, known long, start int, s1 long, s2 long, n long"))
        twice = split.groupBy("anchor", "start", "s1", "s2").agg(F.sum("n").alias("n")).filter("n > 1").drop("n")
        starts = split.drop("n").join(twice, ["anchor", "start", "s1", "s2"]).groupBy("anchor", "known").agg(F.collect_set("start").alias("starts"))
        width = length - length // 2 + 1

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                flags = np.zeros((batch.num_rows, width), dtype=bool)
                for i, at in enumerate(batch.column("starts").to_pylist()):
                    flags[i, at] = True
                yield pa.RecordBatch.from_arrays([batch.column("anchor"), batch.column("known"), pa.array([r.tobytes() for r in _pack(flags)], pa.binary())], ["anchor", "known", "repeats"])

        repeats = repeats.unionByName(starts.mapInArrow(pack, "anchor long, known long, repeats binary"))
    runs = found.select("anchor", "known", "id", "place").join(repeats, ["anchor", "known"]).mapInArrow(_starts_of(length), "id long, low long, high long")
    return runs, copies


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for doc_id, text, copy, runs in zip(batch.column("doc_id").to_pylist(), texts, batch.column("copy").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                text = text or b""
                n, gone, spans, at, kept = len(text), 0, 0, 0, []
                if copy and n >= length:
                    runs = [{"low": 0, "high": n}]
                end = -1
                for r in sorted(runs or [], key=lambda r: (r["low"], r["high"])):
                    if r["low"] > end:
                        kept.append(text[at : r["low"]])
                        spans += 1
                        gone += r["high"] - r["low"]
                        at = end = r["high"]
                    elif r["high"] > end:
                        gone += r["high"] - end
                        at = end = r["high"]
                kept.append(text[at:])
                left = b"".join(kept)
                out.append((doc_id, n, gone, spans, hashlib.sha256(left).hexdigest(), left))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def dedup(docs: DataFrame, length: int = LENGTH, bucket_texts: int = BUCKET_TEXTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes) of every document."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("id", F.coalesce("doc_id", F.xxhash64("text")))
    runs, copies = repeated_runs(docs, length, bucket_texts)
    kind = "array<struct<low:bigint,high:bigint>>"
    marks = runs.groupBy("id").agg(F.collect_set(F.struct("low", "high")).cast(kind).alias("runs")).withColumn("copy", F.lit(False))
    marks = marks.unionByName(copies.select("id", F.lit(None).cast(kind).alias("runs"), F.lit(True).alias("copy")))
    marks = cut(marks.groupBy("id").agg(F.max("copy").alias("copy"), F.first("runs", ignorenulls=True).alias("runs")))
    some = bloom(marks, "id")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    # documents that surely lose nothing aren't shuffled
    changed = through_bloom(docs, some, "id", keep=True).join(marks, "id", "left").select("doc_id", "text", "copy", "runs")
    same = docs.select("doc_id", "text", "id", F.lit(False).alias("copy"), F.lit(None).cast(kind).alias("runs"))
    return changed.mapInArrow(_remove(length), schema).unionByName(through_bloom(same, some, "id", keep=False, run=_remove(length), schema=schema))


def dedup_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    return dedup(docs, length).drop("kept")
