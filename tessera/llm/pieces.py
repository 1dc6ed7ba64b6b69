"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut into words where no piece can span: a run of letters (most characters outside ASCII count as letters), of
digits or of other signs, with all the spaces before it, a run of carriage returns, or one other white space character.
Typographic signs outside ASCII stand in pieces with letters and with signs, and so hold both together. Distinct words are
counted, and each of them once becomes a lattice: its substrings of at most the longest piece's length are exploded,
joined with the piece table (edges), and grouped by word again. Characters that are no piece get an edge of their UTF-8
bytes. Two folds of Spark's ``aggregate`` give the best path: forward over the places of the word, for the best score and
its last edge, then back along the edges. Words of more than ``MAX_WORD`` characters, whose edges would be searched in
whole for each place, get the same path from the same recursion over Arrow batches, in time linear in their length.

Scores are those of a unigram model; a BPE model only has ranks, from which log-probabilities follow by Zipf's law,
``-log(rank + 2)``.

Words go back into texts in one pass with the ``DICTIONARY`` most frequent words, as sorted arrays of hashes (at most
some 32 bytes a word, bounded broadcasts by ranges of hashes, of which the driver has one at a time). Only documents with rarer words are shuffled, to be joined with the
encodings of their own rare words.

Edge cases: null text has no tokens (null ids) and decodes to null; empty text has none and decodes to itself; white
space and U+2581 are kept as they are: decoding gives back the very text; repeated rows are encoded alike; a null doc_id
is encoded too; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import _text as tx
from tessera.llm._spark import drop, prepare, store

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words of up to so many characters become lattices in Spark.
MAX_WORD = 32
DICTIONARY = 1 << 22
BYTE_SCORE = -20.0
#: Distinct words gathered in a partition before they are handed on.
FLUSH = 200_000
#: Counts from which on words are equally frequent.
OFTEN = 10_000


def _kinds() -> np.ndarray:
    """0 for the space, 1 for other white space, 2 letters, 3 digits, 4 other signs, 5 signs outside ASCII, 6 the carriage return."""
    kinds = np.full(256, 4, dtype=np.uint8)
    kinds[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 2
    kinds[48:58] = 3
    kinds[[*range(0x09, 0x0E), *range(0x1C, 0x20)]] = 1
    kinds[0x20] = 0
    # the first bytes of Latin-1's signs and of general punctuation
    kinds[[0xC2, 0xE2]] = 5
    kinds[0x0D] = 6
    return kinds


KIND = _kinds()


def _joined() -> np.ndarray:
    """Whether a word goes on from a character of one kind to one of another."""
    joined = np.zeros((7, 7), dtype=bool)
    joined[0, [0, 2, 3, 4, 5, 6]] = True
    joined[[2, 3, 4, 5, 6], [2, 3, 4, 5, 6]] = True
    joined[[2, 5, 4, 5, 4, 5], [5, 2, 5, 4, 6, 6]] = True
    return joined


JOINED = _joined()


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first bytes of all words, bounds by text); a word ends where the next one of its text begins."""
    first = np.flatnonzero((data & 0xC0) != 0x80)
    kind = KIND[data[first]]
    begins = np.ones(len(first), dtype=bool)
    begins[1:] = ~JOINED[kind[:-1], kind[1:]]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = first[begins | edge[first]]
    return starts, np.searchsorted(starts, offsets)


def word_ends(starts: np.ndarray, bounds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if not len(starts):
        return starts
    ends = np.append(starts[1:], offsets[-1])
    full = bounds[1:] > bounds[:-1]
    ends[bounds[1:][full] - 1] = offsets[1:][full]
    return ends


def words(text: str) -> list[str]:
    """The words of a text; joined, they are the text."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    offsets = np.array([0, len(data)])
    starts, bounds = word_starts(data, offsets)
    return [bytes(data[a:b]).decode() for a, b in zip(starts, word_ends(starts, bounds, offsets), strict=True)]


class Model:
    """The pieces of a model file; U+2581 in a piece stands for a space."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        scores = {i: model.get_score(i) for i in plain}
        ranked = all(s == int(s) for s in scores.values())
        self.pieces = [(model.id_to_piece(i).replace("▁", " "), i, -math.log(2.0 - s) if ranked else s) for i, s in scores.items() if s > -1e6]
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(len(p) for p, _, _ in self.pieces)
        self.spelled: dict[int, bytes] = {i: p.encode() for p, i, _ in self.pieces} | {i: bytes([b]) for b, i in enumerate(self.bytes)}
        if any(model.is_unknown(i) for i in self.bytes):
            raise ValueError("the model has no byte pieces, without which not every text can be encoded")

    def table(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([T.StructField("piece", T.StringType()), T.StructField("id", T.IntegerType()), T.StructField("score", T.DoubleType())])
        return spark.createDataFrame(self.pieces, schema)

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.spelled[i] for i in ids).decode()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, hash, n) of every whole text: counted in each partition, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        total = 0

        def merged() -> pa.RecordBatch:
            hashes, counts = (np.concatenate([h[i] for h in held]) for i in range(2))
            spelled = pa.concat_arrays([h[2] for h in held])
            found, first, of = np.unique(hashes, return_index=True, return_inverse=True)
            sums = np.bincount(of, counts).astype(np.int64)
            return pa.RecordBatch.from_arrays([spelled.take(pa.array(first)), pa.array(found.view(np.int64)), pa.array(sums)], ["word", "hash", "n"])

        for batch in batches:
            for _, _, data, offsets in tx.slices(batch.column("text")):
                starts, bounds = word_starts(data, offsets)
                if not len(starts):
                    continue
                ends = word_ends(starts, bounds, offsets)
                found, first, counts = np.unique(tx.word_hashes(data, starts, ends), return_index=True, return_counts=True)
                a, b = starts[first], ends[first]
                sizes = b - a
                flat = data[np.repeat(a - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
                texts = pa.StringArray.from_buffers(len(a), pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.py_buffer(flat.tobytes()))
                held.append((found, counts, texts))
                total += len(found)
            if total > FLUSH:
                one = merged()
                if one.num_rows > FLUSH:
                    yield one
                    held, total = [], 0
                else:
                    held = [(one.column("hash").to_numpy().view(np.uint64), one.column("n").to_numpy(), one.column("word"))]
                    total = one.num_rows
        if held:
            yield merged()

    parts = docs.select("text").mapInArrow(run, "word string, hash long, n long")
    return parts.groupBy("word", "hash").agg(F.sum("n").alias("n"))


def edges(words: DataFrame, model: Model) -> DataFrame:
    """(word, hash, n, start, stop, id, score): the lattice of each word; id -1 stands for a character's bytes.

    ``words`` is dealt by word, and stays so: nothing is shuffled until the paths are found.
    """
    size = F.length("word")
    starts = words.select("word", "hash", "n", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
    spans = starts.select("word", "hash", "n", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(model.longest), size - F.col("start")))).alias("length"))
    parts = spans.select("word", "hash", "n", "start", "length", F.substr(F.col("word"), F.col("start") + 1, F.col("length")).alias("piece"))
    # a table of fixed size: the model's vocabulary
    found = parts.join(F.broadcast(model.table(words.sparkSession)), "piece", "left").filter(F.col("id").isNotNull() | (F.col("length") == 1))
    spell = F.coalesce("score", BYTE_SCORE * F.octet_length("piece"))
    return found.select("word", "hash", "n", "start", (F.col("start") + F.col("length")).alias("stop"), F.coalesce("id", F.lit(-1)).alias("id"), spell.alias("score"))


def best_paths(lattice: DataFrame, model: Model) -> DataFrame:
    """(word, hash, n, ids): the path of the highest score through each lattice; ties go to the longer last piece."""
    grouped = lattice.groupBy("word", "hash", "n").agg(F.collect_list(F.struct("stop", "start", "score", "id")).alias("edges"))

    def forward(best: Column, place: Column) -> Column:
        here = F.filter("edges", lambda e: e["stop"] == place)
        # best[p] is the best way to place p: its score, the start of its last edge, and that edge's id
        ways = F.transform(here, lambda e: F.struct((F.element_at(best, e["start"] + 1)["score"] + e["score"]).alias("score"), (-e["start"]).alias("back"), e["id"].alias("id")))
        return F.concat(best, F.array(F.array_max(ways)))

    kind = "array<struct<score:double,back:int,id:int>>"
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back"), F.lit(0).alias("id"))).cast(kind)
    ways = grouped.select("word", "hash", "n", F.aggregate(F.sequence(F.lit(1), F.length("word")), start, forward).alias("best"))
    byte_ids = F.array(*[F.lit(i) for i in model.bytes])
    code = lambda at: F.hex(F.encode(F.substr(F.col("word"), at, F.lit(1)), "UTF-8"))
    spelled = lambda h: F.transform(F.sequence(F.lit(1), (F.length(h) / 2).cast("int")), lambda i: F.element_at(byte_ids, F.conv(F.substr(h, 2 * i - 1, F.lit(2)), 16, 10).cast("int") + 1))

    def backward(state: Column, _: Column) -> Column:
        way = F.element_at(F.col("best"), state["place"] + 1)
        ids = F.when(way["id"] >= 0, F.array(way["id"])).otherwise(spelled(code(state["place"])))
        moved = F.struct((-way["back"]).alias("place"), F.concat(ids, state["ids"]).alias("ids"))
        return F.when(state["place"] == 0, state).otherwise(moved)

    end = F.struct(F.length("word").alias("place"), F.array().cast("array<int>").alias("ids"))
    path = F.aggregate(F.sequence(F.lit(1), F.length("word")), end, backward)["ids"]
    return ways.select("word", "hash", "n", path.alias("ids"))


def long_paths(words: DataFrame, model: Model) -> DataFrame:
    """(word, hash, n, ids) of long words, by the recursion and the ties of :func:`best_paths`."""
    held = words.sparkSession.sparkContext.broadcast(({p: (s, i) for p, i, s in model.pieces}, model.bytes, model.longest))

    def path(word: str) -> list[int]:
        table, codes, longest = held.value
        best, last = [0.0] * (len(word) + 1), [(0, -1)] * (len(word) + 1)
        for stop in range(1, len(word) + 1):
            top = (-math.inf, 0, 0)
            for start in range(max(0, stop - longest), stop):
                found = table.get(word[start:stop])
                if found is not None:
                    top = max(top, (best[start] + found[0], -start, found[1]))
                elif stop - start == 1:
                    top = max(top, (best[start] + BYTE_SCORE * len(word[start].encode()), -start, -1))
            best[stop], last[stop] = top[0], (-top[1], top[2])
        parts, place = [], len(word)
        while place:
            start, piece = last[place]
            parts.append([piece] if piece >= 0 else [codes[b] for b in word[start:place].encode()])
            place = start
        return [i for part in reversed(parts) for i in part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array([path(w) for w in batch.column("word").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("word", "hash", "n")), ids], ["word", "hash", "n", "ids"])

    return words.mapInArrow(run, "word string, hash long, n long, ids array<int>")


#: Words of a partition whose lattices are grouped in memory, some three kilobytes each.
PARTITION_WORDS = 10_000


def encode_words(counts: DataFrame, model: Model) -> DataFrame:
    """(word, hash, n, ids) of each distinct word, stored.

    Words are dealt in partitions of bounded size, so that edges can be grouped by hash: sorting them by word, which is
    Spark's way beyond a few keys, would cost more than all the rest.
    """
    spark, name = counts.sparkSession, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    counts = store(counts)
    dealt = counts.repartition(max(1, -(-counts.count() // PARTITION_WORDS)), "word")
    before = spark.conf.get(name)
    spark.conf.set(name, str(8 * PARTITION_WORDS))
    try:
        short = F.length("word") <= MAX_WORD
        return store(best_paths(edges(dealt.filter(short), model), model).unionByName(long_paths(dealt.filter(~short), model)))
    finally:
        spark.conf.set(name, before)


#: Words of a part of the dictionary, about, and ids that a word of it may have.
PART_WORDS, MOST_IDS = 1 << 18, 2**16 - 1


class Dictionary:
    """Words by sorted hashes, with their ids one after the other: some 17 bytes a word."""

    def __init__(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray):
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        kind = np.int32 if len(ids) < 2**31 else np.int64
        self.bounds = np.concatenate([[0], np.cumsum(sizes[order])]).astype(kind)
        firsts, n = (np.cumsum(sizes) - sizes)[order], sizes[order]
        ids = ids.astype(np.uint16, copy=False) if not len(ids) or ids.max() < 2**16 else ids
        self.ids = ids[np.repeat(firsts - self.bounds[:-1], n) + np.arange(len(ids))]

    def find(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, whether found) of sorted hashes; only those between its own least and greatest are searched."""
        at, found = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), bool)
        if len(self.hashes):
            a, b = np.searchsorted(distinct, self.hashes[0]), np.searchsorted(distinct, self.hashes[-1], side="right")
            at[a:b] = np.searchsorted(self.hashes, distinct[a:b])
            found[a:b] = self.hashes[at[a:b]] == distinct[a:b]
        return at, found

    @classmethod
    def of(cls, rows: pa.Table, hash_column: str = "hash") -> Dictionary:
        if not rows.num_rows:
            return cls(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64))
        lists = rows.column("ids").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        return cls(rows.column(hash_column).to_numpy().view(np.uint64), lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy()).astype(np.int64))


def _parts(words: DataFrame, count: int, most: int) -> list[Broadcast]:
    """Broadcast dictionaries of (hash, ids), ``count`` rows or less: ranges of hashes of about ``most`` words each.

    Tasks sort and pack the parts; the driver has one of them at a time, and hands it on.
    """
    bits = max(0, -(-count // most) - 1).bit_length()
    ranges = F.shiftrightunsigned("hash", 64 - bits).cast("int") if bits else F.lit(0)

    def pack(rows: pa.Table) -> pa.Table:
        part = Dictionary.of(rows)
        return pa.table({"part": rows.column("part").slice(0, 1), "packed": pa.array([pickle.dumps(part, pickle.HIGHEST_PROTOCOL)], pa.binary())})

    packed = store(words.select("hash", "ids", ranges.alias("part")).groupBy("part").applyInArrow(pack, "part int, packed binary"))
    held = []
    for part in range(1 << bits):
        for row in packed.filter(F.col("part") == part).select("packed").collect():
            held.append(words.sparkSession.sparkContext.broadcast(pickle.loads(row["packed"])))
            del row
    drop(packed)
    return held


def _tokens(data: np.ndarray, offsets: np.ndarray, *held: Dictionary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, their bounds by text, missing words' texts, missing words' hashes); each distinct word is looked up once."""
    starts, bounds = word_starts(data, offsets)
    hashes = tx.word_hashes(data, starts, word_ends(starts, bounds, offsets))
    distinct, of = np.unique(hashes, return_inverse=True)
    which, firsts, sizes = (np.full(len(distinct), x, np.int64) for x in (-1, 0, 0))
    for k, part in enumerate(held):
        todo = np.flatnonzero(which < 0)
        if not len(todo):
            break
        at, found = part.find(distinct[todo])
        todo, at = todo[found], at[found]
        which[todo], firsts[todo], sizes[todo] = k, part.bounds[at], part.bounds[at + 1] - part.bounds[at]
    sizes, which = sizes[of], which[of]
    ends = np.cumsum(sizes)
    ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
    for k, part in enumerate(held):
        mine = np.flatnonzero(which == k)
        n = sizes[mine]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ids[np.repeat(ends[mine] - n, n) + inside] = part.ids[np.repeat(firsts[of[mine]], n) + inside]
    lost = np.flatnonzero(which < 0)
    return ids, np.concatenate([[0], ends])[bounds], np.searchsorted(bounds, lost, side="right") - 1, hashes[lost]


def _frequent(coded: DataFrame, most: int) -> DataFrame:
    """The words above the least count that leaves at most ``most``, from a histogram of counts."""
    bins = coded.groupBy(F.least("n", F.lit(OFTEN)).alias("n")).count().collect()
    least, held = OFTEN + 1, 0
    for row in sorted(bins, key=lambda r: -r["n"]):
        held += row["count"]
        if held > most:
            break
        least = row["n"]
    return coded.filter(F.col("n") >= least)


def encode(docs: DataFrame, path: str = MODEL, dictionary: int = DICTIONARY, verify: bool = False, part_words: int = PART_WORDS) -> DataFrame:
    """All columns of ``docs`` and ``ids``, the token ids of the whole text.

    With ``verify``, also round_trip: whether the ids, decoded in the same pass, are the text.
    """
    spark = prepare(docs.sparkSession)
    model = Model(path)
    coded = encode_words(word_counts(docs), model).select("hash", "n", "ids")
    fits = F.size("ids") <= MOST_IDS
    counted = coded.agg(F.count("*").alias("n"), F.coalesce(F.min(fits), F.lit(True)).alias("fits")).first()
    whole = counted["n"] <= dictionary and counted["fits"]
    top = coded if counted["n"] <= dictionary else _frequent(coded, dictionary)
    held = _parts(top.filter(fits), min(counted["n"], dictionary), part_words)
    tx.release()
    names, place = docs.columns, docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), *([T.StructField("round_trip", T.BooleanType())] if verify else [])])
    speller = spark.sparkContext.broadcast(Speller(model.spelled)) if verify else None

    def with_ids(rows: pa.RecordBatch, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        known = rows.column(place).is_valid()
        at = pa.array(bounds.astype(np.int32))
        if rows.column(place).null_count:
            at = pa.array(bounds.astype(np.int32), mask=np.append(~known.to_numpy(zero_copy_only=False), False))
        lists = pa.ListArray.from_arrays(at, pa.array(ids.astype(np.int32)))
        more = [pa.field("ids", lists.type)]
        columns = [*rows.columns, lists]
        if speller is not None:
            text = rows.column(place)
            same = pc.fill_null(pc.equal(speller.value.texts(lists), text), False)
            columns.append(pc.or_(same, pc.and_(pc.is_null(text), pc.is_null(lists))))
            more.append(pa.field("round_trip", pa.bool_()))
        return pa.RecordBatch.from_arrays(columns, schema=pa.schema([*rows.schema, *more]))

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        for batch in batches:
            for a, b, data, offsets in tx.slices(batch.column(place)):
                ids, bounds, lost, _ = _tokens(data, offsets, *(part.value for part in held))
                rows = batch.slice(a, b - a)
                if len(lost):
                    # rows with a word beyond the dictionary come by the other way
                    keep = np.ones(b - a, dtype=bool)
                    keep[lost] = False
                    sizes = np.diff(bounds)
                    ids, rows = ids[np.repeat(keep, sizes)], rows.filter(pa.array(keep))
                    bounds = np.concatenate([[0], np.cumsum(sizes[keep])])
                if rows.num_rows:
                    yield with_ids(rows, ids, bounds)

    everything = docs.mapInArrow(common, schema)
    if whole:
        return everything

    key, rest = "_piece_row", "_piece_words"

    def uncommon(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tx.slices(batch.column(place)):
                _, _, lost, hashes = _tokens(data, offsets, *(part.value for part in held))
                if len(lost):
                    owners, at = np.unique(lost, return_index=True)
                    lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(lost)).astype(np.int32)), pa.array(hashes.view(np.int64)))
                    rows = batch.slice(a, b - a).take(pa.array(owners))
                    yield pa.RecordBatch.from_arrays([*rows.columns, lists], schema=pa.schema([*rows.schema, pa.field(rest, lists.type)]))

    numbered = docs.withColumn(key, F.monotonically_increasing_id())
    wider = T.StructType([*numbered.schema.fields, T.StructField(rest, T.ArrayType(T.LongType()))])
    # rows are numbered once, in a written table: both sides of the join read the same numbers
    apart = store(numbered.mapInArrow(uncommon, wider))
    asked = apart.select(key, F.explode(F.array_distinct(rest)).alias("hash")).join(coded.select("hash", "ids"), "hash")
    maps = asked.groupBy(key).agg(F.collect_list(F.struct("hash", "ids")).alias("_piece_map"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = [part.value for part in held]
        for batch in batches:
            lists = batch.column("_piece_map")
            flat = lists.flatten()
            own = Dictionary.of(pa.table({"hash": flat.field("hash"), "ids": flat.field("ids")}))
            for a, b, data, offsets in tx.slices(batch.column(place)):
                ids, bounds, _, _ = _tokens(data, offsets, *frequent, own)
                yield with_ids(batch.select(names).slice(a, b - a), ids, bounds)

    late = apart.drop(rest).join(maps, key).select(*[F.col(f"`{c}`") for c in names], "_piece_map").mapInArrow(joined, schema)
    return everything.unionByName(late)


class Speller:
    """Pieces' bytes in one flat array, for decoding whole batches."""

    def __init__(self, spelled: dict[int, bytes]):
        n = max(spelled) + 1
        self.sizes = np.zeros(n, np.int64)
        for i, b in spelled.items():
            self.sizes[i] = len(b)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(n)), dtype=np.uint8)

    def texts(self, lists: pa.ListArray) -> pa.Array:
        ids = lists.flatten().to_numpy()
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        data = self.flat[np.repeat(self.firsts[ids] - ends + sizes, sizes) + np.arange(sizes.sum())]
        lengths = lists.value_lengths().fill_null(0).to_numpy()
        at = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lengths)])]
        null = ~lists.is_valid().to_numpy(zero_copy_only=False)
        mask = pa.py_buffer(np.packbits(~null, bitorder="little").tobytes())
        return pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data.tobytes()), mask, int(null.sum())).cast(pa.string())


def decode(encoded: DataFrame, path: str = MODEL, column: str = "ids") -> DataFrame:
    """All columns and ``decoded``, the text that the ids spell."""
    held = encoded.sparkSession.sparkContext.broadcast(Speller(Model(path).spelled))
    place = encoded.columns.index(column)
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                rows = batch.slice(a, 512)
                yield pa.RecordBatch.from_arrays([*rows.columns, held.value.texts(rows.column(place))], schema=pa.schema([*rows.schema, pa.field("decoded", pa.string())]))

    return encoded.mapInArrow(run, schema)


def digest(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, ids, n_tokens and round_trip: whether the decoded ids are the text."""
    both = encode(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), path, verify=True)
    return both.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "round_trip")
