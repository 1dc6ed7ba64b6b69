"""MinHash near-dedup with DartMinHash signatures, banded joining and exact verification.

A document is the set (or, ``weighted``, the multiset) of its shingles of five words. Each shingle is an element whose
weight spans a strip of the plane weight x rank; darts are thrown into cells of that strip by hashing shingle and cell,
so that the same shingle gets the same darts in every document. Darts above an element's weight miss. About
``K ln K + 2 K`` darts of the lowest ranks hit a document, whatever its length; each belongs to one of ``K`` coordinates,
and each coordinate keeps the dart of the least rank. Two signatures agree in a coordinate with the probability of the
documents' (weighted) Jaccard similarity.

``BANDS`` bands of ``ROWS`` coordinates make buckets; 25 bands of 4 miss a pair of similarity 0.8 once in 500,000.
Partners are verified by the exact Jaccard similarity of their shingle sets and linked; linked documents are one group.
Documents with equal shingle sets are collapsed before, and no bucket's pairs are listed in full (see ``linking``).

Edge cases: texts of fewer than five words are one shingle; null texts and texts without words are in no group but
their own; a null doc_id is left out of grouping and gets a null group; repeated rows are in one group; an empty table
gives an empty result; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _text as tx
from tessera.llm import linking
from tessera.llm._spark import bloom, cut, prepare, store, through_bloom

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 4
#: The lowest layer of ranks; further layers double until they are TOP_LAYER high.
BASE_LAYER, TOP_LAYER = 2.0**-6, 4.0


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): of each text, its shingles in order; a text of fewer words is one shingle."""
    starts, ends, bounds = tx.word_spans(data, offsets)
    hasher = tx.SpanHasher(tx.word_hashes(data, starts, ends, which), which)
    counts = np.diff(bounds)
    shingle_counts = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out = np.concatenate([[0], np.cumsum(shingle_counts)])
    first = np.arange(out[-1]) - np.repeat(out[:-1], shingle_counts) + np.repeat(bounds[:-1], shingle_counts)
    last = np.minimum(first + size, np.repeat(bounds[1:], shingle_counts))
    return hasher(first, last), out


def distinct(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count) of each text's distinct hashes, sorted."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(hashes)))


def _poisson(mean: float) -> np.ndarray:
    """Distribution function of the Poisson law, far enough for 53-bit uniforms."""
    terms = [np.exp(-mean)]
    while len(terms) < 8 or terms[-1] > 1e-18:
        terms.append(terms[-1] * mean / len(terms))
    return np.cumsum(terms)


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def dart_minhash(text: np.ndarray, elements: np.ndarray, weights: np.ndarray, texts: int, k: int) -> np.ndarray:
    """Signatures (texts x k) of weighted sets; texts without elements get zeros."""
    signature = np.zeros((texts, k), dtype=np.uint64)
    total = np.bincount(text, weights, texts)
    reach = np.where(total > 0, (k * np.log(k) + 2 * k) / np.maximum(total, 1e-300), 0.0)
    todo = total > 0
    while todo.any():
        best = _throw(text, elements, weights, todo, reach, k, signature)
        # a document of which a coordinate got no dart is thrown at again, twice as high
        todo = todo & (best == np.inf).any(axis=1)
        reach = reach * 2
    return signature


def _throw(text: np.ndarray, elements: np.ndarray, weights: np.ndarray, todo: np.ndarray, reach: np.ndarray, k: int, signature: np.ndarray) -> np.ndarray:
    use = todo[text]
    text, elements, weights, high = text[use], elements[use], weights[use], reach[text[use]]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    low, height, layer = 0.0, BASE_LAYER, 0
    while len(text):
        # weights in octaves: [0, 1), [1, 2), [2, 4), ...
        floor, width, octave = 0.0, 1.0, 0
        inside = np.arange(len(text))
        while len(inside):
            cell = tx.mix(elements[inside] + np.uint64((layer * 1_000_003 + octave * 7_919 + 1) * 0x9E3779B97F4A7C15 % 2**64), 3)
            # cells of more than one unit of weight are cut into units, so that few darts land in each
            darts = np.searchsorted(_poisson(height * width), _uniform(cell), side="right")
            which = np.repeat(np.arange(len(inside)), darts)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(darts) - darts, darts)
            dart = tx.mix(cell[which] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), 4)
            rank = low + height * _uniform(tx.mix(dart, 5))
            hit = (floor + width * _uniform(tx.mix(dart, 6))) < weights[inside][which]
            found.append((text[inside][which][hit], dart[hit], rank[hit]))
            floor, width, octave = floor + width, max(floor + width, 1.0), octave + 1
            inside = inside[weights[inside] > floor]
        low, layer = low + height, layer + 1
        height = min(low, TOP_LAYER)
        on = high > low
        text, elements, weights, high = text[on], elements[on], weights[on], high[on]
    of, dart, rank = (np.concatenate(x) for x in zip(*found, strict=True))
    place = of * k + (tx.mix(dart, 7) % np.uint64(k)).astype(np.int64)
    order = np.lexsort((dart, rank, place))
    first = order[np.unique(place[order], return_index=True)[1]]
    best = np.full(signature.shape, np.inf)
    best.ravel()[place[first]] = rank[first]
    signature.ravel()[place[first]] = dart[first]
    best[~todo] = 0
    return best


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, weighted: bool = False) -> DataFrame:
    """(doc_id, size, h1, h2, buckets): hashes of each document's shingle set, and its band buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        for batch in batches:
            for a, b, data, offsets in tx.slices(batch.column("text")):
                n = b - a
                text, elements, counts = distinct(*shingles(data, offsets))
                weights = counts.astype(np.float64) if weighted else np.ones(len(text))
                sizes = np.bincount(text, minlength=n)
                sums = np.zeros((2, n), dtype=np.uint64)
                for w in range(2):
                    np.add.at(sums[w], text, tx.mix(elements + counts.astype(np.uint64) * np.uint64(int(weighted)), 10 + w))
                sign = dart_minhash(text, elements, weights, n, bands * rows)
                keys = np.zeros((n, bands), dtype=np.uint64)
                for i in range(bands):
                    key = np.full(n, i + 1, dtype=np.uint64)
                    for j in range(rows):
                        key = tx.mix(key * np.uint64(0x9E3779B97F4A7C15) + sign[:, i * rows + j], 8)
                    keys[:, i] = key
                lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), bands).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, n), pa.array(sizes), *(pa.array(s.view(np.int64)) for s in sums), lists], ["doc_id", "size", "h1", "h2", "buckets"])

    return docs.mapInArrow(run, "doc_id long, size long, h1 long, h2 long, buckets array<long>")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, shingles): the distinct shingle hashes of each document."""
    for batch in batches:
        for a, b, data, offsets in tx.slices(batch.column("text")):
            text, elements, _ = distinct(*shingles(data, offsets, which=1))
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(b - a + 1)).astype(np.int32)), pa.array(elements.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), lists], ["doc_id", "shingles"])


def _overlaps(threshold: float):
    """Links of a block of outliers with a block of members: overlaps are counted through an inverted index of the members."""

    def run(outliers: pa.Table, members: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if outliers.num_rows and members.num_rows:
            held = members.column("shingles").combine_chunks()
            sizes = np.diff(held.offsets.to_numpy())
            flat = held.flatten().to_numpy()
            order = np.argsort(flat, kind="stable")
            words, starts = np.unique(flat[order], return_index=True)
            owner = np.repeat(np.arange(len(sizes)), sizes)[order]
            counts = np.diff(np.append(starts, len(flat)))
            ids, labels = members.column("id").to_numpy(), members.column("label").to_numpy()
            asked = outliers.column("shingles").combine_chunks()
            bounds, elements = asked.offsets.to_numpy() - asked.offsets[0].as_py(), asked.flatten().to_numpy()
            own, own_labels = outliers.column("id").to_numpy(), outliers.column("label").to_numpy()
            for i in range(len(own)):
                mine = elements[bounds[i] : bounds[i + 1]]
                at = np.minimum(np.searchsorted(words, mine), len(words) - 1)
                at = at[words[at] == mine]
                n = counts[at]
                places = np.repeat(starts[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
                common = np.bincount(owner[places], minlength=len(ids))
                near = np.flatnonzero((common >= threshold * (len(mine) + sizes - common)) & (labels != own_labels[i]))
                # one link to each other component is enough
                near = near[np.unique(labels[near], return_index=True)[1]]
                out.append((np.minimum(own[i], ids[near]), np.maximum(own[i], ids[near])))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["a", "b"])

    return run


#: Members and outliers of a cell: some ten megabytes of shingles of usual documents.
CELL_MEMBERS, CELL_OUTLIERS = 2048, 1024


def _finish(many: DataFrame, found: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """What leaders left open in large buckets: members outside the largest component are compared with all others.

    Buckets that share members make one field; in it, each outlier meets each member once, in cells of bounded size,
    and only links between components leave a cell.
    """
    fields = linking.components(many.select(F.col("lead_id").alias("a"), F.col("id").alias("b"))).withColumnRenamed("label", "field")
    state = fields.join(linking.components(found), "id", "left").withColumn("label", F.coalesce("label", "id"))
    state = store(state)
    parts = state.groupBy("field", "label").agg(F.count("*").alias("n"))
    plan = parts.groupBy("field").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("members")).select("field", F.col("main.label").alias("main"), "members", (F.col("members") - F.col("main.n")).alias("outliers")).filter("outliers > 0")
    plan = cut(plan.select("field", "main", F.ceil(F.col("members") / CELL_MEMBERS).cast("int").alias("blocks"), F.ceil(F.col("outliers") / CELL_OUTLIERS).cast("int").alias("parts")))
    open_ = state.join(plan, "field").join(sets.withColumnRenamed("doc_id", "id"), "id")
    part = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # aliases tell the two sides of one frame apart
    own = [F.col(c).alias(c) for c in ("field", "id", "label", "shingles")]
    left = open_.filter("label != main").select(*own, part("parts", 1).alias("part"), every("blocks").alias("block"))
    right = open_.select(*own, every("parts").alias("part"), part("blocks", 2).alias("block"))
    keys = ["field", "part", "block"]
    more = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_overlaps(threshold), "a long, b long")
    return cut(found.unionByName(more).distinct())


def groups(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, group_id (the least doc_id of its group), n_shingles: one row for each row of ``docs``."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = store(signatures(docs, bands, rows))
    whole = signed.filter(F.col("doc_id").isNotNull() & (F.col("size") > 0))
    classes = store(whole.groupBy("h1", "h2").agg(F.min("doc_id").alias("id"), F.first("size").alias("size"), F.first("buckets").alias("buckets")))
    buckets = classes.select(F.explode("buckets").alias("bucket"), "id", "size")
    members = linking.crowded(buckets, ["size"])
    near = cut(members.select(F.col("id").alias("doc_id")).distinct())
    # rows that share a doc_id share a text: one is enough
    sets = through_bloom(docs, bloom(near, "doc_id"), "doc_id", keep=True, run=_sets, schema="doc_id long, shingles array<long>")
    sets = store(sets.join(near, "doc_id", "left_semi").dropDuplicates(["doc_id"]))

    def verify(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
        two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
        common = F.size(F.array_intersect("sa", "sb"))
        return pairs.join(one, "a").join(two, "b").filter(common >= threshold * (F.size("sa") + F.size("sb") - common)).select("a", "b")

    fit = lambda x, y: F.least(x("size"), y("size")) >= threshold * F.greatest(x("size"), y("size"))
    found = linking.links(members, ["size"], fit, verify, lambda many, found: _finish(many, found, sets, threshold))
    label = linking.components(found)
    named = classes.join(label, "id", "left").select("h1", "h2", F.coalesce("label", "id").alias("group_id"))
    # documents without words, or without an id, are alone
    alone = F.when(F.col("size") == 0, F.col("doc_id"))
    return signed.select("doc_id", "size", "h1", "h2").join(named, ["h1", "h2"], "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce(alone, "group_id")).alias("group_id"), F.col("size").alias("n_shingles"))


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each group, the one with the least doc_id (of repeated rows, one), with all its columns."""
    found = cut(groups(docs, threshold))
    gone = found.filter("doc_id != group_id").select(F.col("doc_id").alias("_gone"))
    often = found.filter("doc_id = group_id AND n_shingles > 0").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_gone"))
    gone, often = cut(gone.distinct()), cut(often)
    some = bloom(gone.unionByName(often), "_gone")
    marked = docs.withColumn("_doc_", F.col("doc_id").cast("long"))
    # texts of documents that surely stay aren't shuffled
    maybe = through_bloom(marked, some, "_doc_", keep=True).join(gone, F.col("_doc_") == F.col("_gone"), "left_anti")
    single = maybe.join(often, F.col("_doc_") == F.col("_gone"), "left_anti")
    repeated = maybe.join(often, F.col("_doc_") == F.col("_gone"), "left_semi").dropDuplicates(["_doc_"])
    return through_bloom(marked, some, "_doc_", keep=False).unionByName(single).unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
