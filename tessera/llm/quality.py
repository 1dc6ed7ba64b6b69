"""Quality rules: word and line statistics, and a corpus-trained n-gram perplexity band for each language.

The language model is a modified Kneser-Ney model over unfolded UTF-8 bytes, of order ``ORDER``, for each language.
Spark counts the n-grams of every document, summed in each partition first; their number grows with the input. An n-gram's
hash is its base-``ALPHABET`` code, which no other n-gram shares; a model is sorted arrays of those hashes, parted by
language and order, and a worker loads the languages that it meets. An n-gram counts once less than it occurs: one that
stands in the scored text only isn't known from there. A model of more than ``MODEL_NGRAMS`` n-grams is made in parts, by
the two bytes before an n-gram's last: the n-grams of three bytes and more that a probability takes are in one part, those of
two bytes and less in every part, and discounts are counted over all of them. Texts are then read once for each part, and a
stretch adds up what the parts give its symbols: no n-gram is left out.

A text is scored in stretches of ``STRETCH`` characters, each by its own language's model or by whichever of the
``ALTERNATES`` most frequent languages' models finds it likelier, so that quoted foreign passages don't count as
noise. A document passes if it has at most one sign of ``IS_MARK`` for ``MARK_WORDS`` words and its bits per character are inside the band of its language and length (octave of
characters): the median of the distinct texts there, less or plus ``band`` robust deviations (and never nearer
than ``least`` bits).

Edge cases: null or empty text has no words and fails the base rules; null languages form a language of their
own; repeated rows get equal verdicts; other columns play no part; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import _text as tx
from tessera.llm._spark import cut, prepare, store

ORDER = 6
ALPHABET = 256
#: Codes that a worker remembers the bits of, and that a partition gathers before it sums them.
MEMO, GATHER = 1 << 20, 1 << 20
#: N-grams of a part of a language's model (12 bytes each, and less for its lower orders), and the pairs of bytes that parts
#: are made of: a part has more only if one pair has.
MODEL_NGRAMS, PAIRS = 1 << 24, ALPHABET**2
#: What the parts of a model give the stretches of a text, one part after the other.
CARRY = "_quality_carry"
MARK_WORDS = 10
BAND = 8.0
LEAST_BITS = 0.15
STRETCH = 32
ALTERNATES = 4
WINDOW = 5


IS_MARK = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])


def ngram_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes of all n-grams, bounds by text); each text is led by ORDER - 1 edges and ended by one."""
    # 0 is the text's edge; a NUL goes as a byte that UTF-8 never has
    symbols, at = np.where(data == 0, 255, data).astype(np.int64), offsets
    texts, pad = len(offsets) - 1, ORDER
    out = np.zeros(len(symbols) + texts * pad, dtype=np.int64)
    place = np.arange(len(symbols)) + np.repeat(np.arange(texts) * pad + pad - 1, np.diff(at))
    out[place] = symbols
    code = np.zeros(max(len(out) - ORDER + 1, 0), dtype=np.int64)
    for k in range(ORDER):
        code = code * ALPHABET + out[k : k + len(code)]
    # of each text, the n-grams that end in one of its symbols or in its last edge
    counts = np.diff(at) + 1
    first = at[:-1] + np.arange(texts) * pad
    picks = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)
    return code[picks], np.concatenate([[0], np.cumsum(counts)])


@dataclass
class Whole:
    """What the parts of a model share: n-grams that count 1, 2, 3 and 4 by order, and all pairs with their counts."""

    often: dict[int, list[int]]
    bigrams: np.ndarray
    bigram_counts: np.ndarray


class KneserNey:
    """Interpolated modified Kneser-Ney over n-gram codes, as sorted arrays for each order."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, whole: Whole | None = None, mine: np.ndarray | None = None):
        """Of a model's part: what is known of the ``whole`` model, and which pairs of bytes are ``mine``."""
        self.mine = mine
        rank = np.argsort(codes)
        keys, counts = codes[rank], counts[rank].astype(np.float64)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for order in range(ORDER, 0, -1):
            if whole is not None and order == 2:
                keys, counts = whole.bigrams, whole.bigram_counts.astype(np.float64)
            often = whole.often[order] if whole is not None and order > 2 else [(counts == k).sum() for k in (1, 2, 3, 4)]
            discount = self._discounts(often)
            cut_by = discount[np.minimum(counts, 3).astype(int)]
            contexts, of = np.unique(keys // ALPHABET, return_inverse=True)
            total = np.bincount(of, counts)
            # per order: n-grams, discounted probability; contexts, mass left for the next lower order
            self.levels.append((keys, (counts - cut_by) / total[of], contexts, np.bincount(of, cut_by) / total))
            if order > 1:
                # below the highest order, an n-gram counts once for each symbol that can stand before it
                keys, counts = np.unique(keys % ALPHABET ** (order - 1), return_counts=True)
                counts = counts.astype(np.float64)
        # from the lowest order up, each n-gram's share takes in what the lower orders give it
        for at in range(ORDER - 1, -1, -1):
            keys, shares, contexts, left = self.levels[at]
            lower = self._from(at + 1, keys % ALPHABET ** (ORDER - at - 1))
            self.levels[at] = (keys, shares + left[np.searchsorted(contexts, keys // ALPHABET)] * lower, contexts, left)
        self.levels = [(k, p.astype(np.float32), c, m.astype(np.float32)) for k, p, c, m in self.levels]

    @staticmethod
    def _discounts(often: list[int]) -> np.ndarray:
        """From how many n-grams count 1, 2, 3 and 4."""
        n1, n2, n3, n4 = (max(float(n), 0.5) for n in often)
        y = n1 / (n1 + 2 * n2)
        raw = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        return np.array([0.0] + [min(max(d, 0.05), 0.95 * k) for k, d in enumerate(raw) if k])

    def probability(self, codes: np.ndarray) -> np.ndarray:
        """P(last symbol | the others) of each code."""
        return self._from(0, codes)

    def _from(self, level: int, codes: np.ndarray) -> np.ndarray:
        """The probabilities by the model's levels from one on; an unseen n-gram gets what its context leaves to the next."""
        if level == ORDER:
            return np.full(len(codes), 1.0 / ALPHABET)
        keys, shares, contexts, left = self.levels[level]
        at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
        result, lost = shares[at].astype(np.float64), np.flatnonzero(keys[at] != codes)
        if len(lost):
            own = codes[lost]
            at = np.minimum(np.searchsorted(contexts, own // ALPHABET), len(contexts) - 1)
            weight = np.where(contexts[at] == own // ALPHABET, left[at], 1.0)
            result[lost] = weight * self._from(level + 1, own % ALPHABET ** (ORDER - level - 1))
        return result

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Bits of each code; none of those that other parts know."""
        if self.mine is None:
            return -np.log2(self.probability(codes)).astype(np.float32)
        out, own = np.zeros(len(codes), np.float32), self.mine[codes // ALPHABET % PAIRS]
        out[own] = -np.log2(self.probability(codes[own]))
        return out


class Models:
    """A broadcast for each language's model, loaded when a worker meets the language.

    If some have more parts than one, these are the first ones; ``later`` makes the others of each further reading, which
    has those of the languages that have so many.
    """

    def __init__(self, held: dict[int, Broadcast], common: list[int] | None = None, later: list[Callable[[], Models]] | None = None):
        self.held, self.later = held, later or []
        self.common = [s for s in sorted(held) if s < ALTERNATES] if common is None else common
        self._forget()

    def drop(self) -> None:
        """Frees what the driver and executors hold of the models; they aren't asked again."""
        for b in self.held.values():
            b.destroy()

    def _forget(self) -> None:
        self.codes, self.known = np.zeros(0, np.int64), np.zeros((0, len(self.common)), np.float32)

    def common_bits(self, distinct: np.ndarray) -> np.ndarray:
        """Of sorted codes, the bits by each of the most frequent languages; a worker looks a code up once."""
        at = np.searchsorted(self.codes, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = at < len(self.codes)
        new[inside] = self.codes[at[inside]] != distinct[inside]
        out = np.empty((len(distinct), len(self.common)), np.float32)
        out[~new] = self.known[at[~new]]
        if new.any():
            out[new] = np.stack([self.held[s].value.bits(distinct[new]) if s in self.held else np.zeros(new.sum(), np.float32) for s in self.common], axis=1)
            if len(self.codes) > MEMO:
                self._forget()
                at = np.zeros(len(distinct), np.int64)
            self.codes, self.known = np.insert(self.codes, at[new], distinct[new]), np.insert(self.known, at[new], out[new], axis=0)
        return out

    def __reduce__(self) -> tuple:
        return _models, (self.held, self.common)


def _models(held: dict[int, Broadcast], common: list[int]) -> Models:
    """A worker's own, kept between its tasks with what it remembers."""
    if not tx.KEPT or not isinstance(tx.KEPT[0], Models) or list(tx.KEPT[0].held.items()) != list(held.items()):
        tx.KEPT[:] = [Models(held, common)]
    return tx.KEPT[0]


def language_slots(docs: DataFrame) -> list[str | None]:
    """All languages, the most frequent first (ties by name)."""
    top = docs.groupBy("lang").count().orderBy(F.desc("count"), F.asc_nulls_last("lang"))
    return [r["lang"] for r in top.collect()]


def _slot_of(column: pa.Array, slots: list[str | None]) -> np.ndarray:
    index = {v: i for i, v in enumerate(slots)}
    return np.array([index[v] for v in column.to_pylist()], dtype=np.int64)


def count_ngrams(docs: DataFrame, slots: list[str | None]) -> DataFrame:
    """(slot, code, n) over every whole text: counted in each partition, then summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        sizes: dict[int, int] = {}

        def summed(s: int) -> tuple[np.ndarray, np.ndarray]:
            codes, of = np.unique(np.concatenate([c for c, _ in held[s]]), return_inverse=True)
            return codes, np.bincount(of, np.concatenate([n for _, n in held[s]])).astype(np.int64)

        def told(s: int, codes: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(codes), 1 << 18):
                part, some = codes[k : k + (1 << 18)], n[k : k + (1 << 18)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), s, np.int32)), pa.array(part), pa.array(some)], ["slot", "code", "n"])

        for batch in batches:
            slot = _slot_of(batch.column("lang"), slots)
            for a, b, data, offsets in tx.slices(batch.column("text")):
                codes, bounds = ngram_codes(data, offsets)
                of = np.repeat(slot[a:b], np.diff(bounds))
                for s in np.unique(slot[a:b]):
                    part = np.unique(codes[of == s], return_counts=True)
                    held.setdefault(s, []).append(part)
                    sizes[s] = sizes.get(s, 0) + len(part[0])
                    if sizes[s] > GATHER:
                        whole, n = summed(s)
                        if len(whole) > GATHER:
                            yield from told(s, whole, n)
                            whole, n = whole[:0], n[:0]
                        # what has been summed isn't counted again
                        held[s], sizes[s] = [(whole, n)], 0
        for s in held:
            yield from told(s, *summed(s))

    parts = docs.select("lang", "text").mapInArrow(count, "slot int, code long, n long")
    return parts.groupBy("slot", "code").agg(F.sum("n").alias("n"))


def _whole(grams: DataFrame) -> Whole:
    """Of all n-grams (code, n) of a language."""
    table, often = grams.select("code", (F.col("n") - 1).alias("c")), {}
    for order in range(ORDER, 2, -1):
        told = {r["c"]: r["count"] for r in table.filter("c < 5").groupBy("c").count().collect()}
        often[order] = [told.get(k, 0) for k in (1, 2, 3, 4)]
        # below, an n-gram counts once for each symbol that can stand before it
        table = table.groupBy(F.pmod("code", F.lit(ALPHABET ** (order - 1))).alias("code")).agg(F.count("*").alias("c"))
        table = cut(table) if order > 3 else table
    pairs = table.orderBy("code").toArrow()
    return Whole(often, pairs.column("code").to_numpy(), pairs.column("c").to_numpy())


def fit_models(docs: DataFrame, slots: list[str | None], most: int = MODEL_NGRAMS) -> Models:
    """A model of each language, of all n-grams that occur twice or more: in parts of up to ``most`` n-grams, so that what
    workers load stays bounded, however large the corpus is."""
    counts = cut(count_ngrams(docs, slots).filter("n > 1"))
    sizes = {r["slot"]: r["count"] for r in counts.groupBy("slot").count().collect()}
    pair = F.expr(f"CAST((code DIV {ALPHABET}) % {PAIRS} AS INT)")
    # of a model in parts, the first pair of each, and the end
    parts: dict[int, np.ndarray] = {}
    wholes: dict[int, Whole] = {}
    for s in sorted(s for s, n in sizes.items() if n > most):
        own = counts.filter(F.col("slot") == s)
        # at most PAIRS rows
        found = own.groupBy(pair.alias("pair")).count().orderBy("pair").toArrow()
        starts, held = [0], 0
        for p, n in zip(found.column("pair").to_pylist(), found.column("count").to_pylist(), strict=True):
            if held and held + n > most:
                starts, held = [*starts, p], 0
            held += n
        parts[s], wholes[s] = np.array([*starts, PAIRS]), _whole(own)

    def made(s: int, part: int) -> Broadcast:
        rows, mine = counts.filter(F.col("slot") == s), None
        if s in parts:
            first, end = (int(x) for x in parts[s][part : part + 2])
            mine = (np.arange(PAIRS) >= first) & (np.arange(PAIRS) < end)
            rows = rows.filter(pair.between(first, end - 1))
        rows = rows.select("code", "n").toArrow()
        codes, n = rows.column("code").to_numpy(), rows.column("n").to_numpy() - 1
        out = docs.sparkSession.sparkContext.broadcast(KneserNey(codes, n, wholes.get(s), mine))
        del rows
        tx.release()
        return out

    common = [s for s in sorted(sizes) if s < ALTERNATES]
    most_parts = max((len(at) - 1 for at in parts.values()), default=1)
    later = [lambda p=p: Models({s: made(s, p) for s, at in parts.items() if len(at) - 1 > p}, common) for p in range(1, most_parts)]
    return Models({s: made(s, 0) for s in sorted(sizes)}, common, later)


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base statistics of each text of a slice."""
    texts = len(offsets) - 1
    starts, ends, bounds = tx.word_spans(data, offsets)
    hasher = tx.byte_hasher(data)
    per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    out = {"n_words": np.diff(bounds), "word_chars": per_text(~tx.IS_SPACE[data] & ((data & 0xC0) != 0x80)), "n_symbols": per_text(IS_MARK[data])}
    # lines: split at \n and at the edges of texts
    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([offsets, breaks, breaks + 1]))
    a, b = edges[:-1], edges[1:]
    words_to = np.concatenate([[0], np.cumsum(~tx.IS_SPACE[data])])
    full = words_to[b] > words_to[a]
    a, b = a[full], b[full]
    of = np.searchsorted(offsets, a, side="right") - 1
    key = tx.mix(hasher(a, b) + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(of, minlength=texts) - np.bincount(of[first], minlength=texts)
    at, of = tx.windows(bounds, WINDOW)
    grams = tx.SpanHasher(hasher(starts, ends))(at, at + WINDOW)
    key = tx.mix(grams + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    repeated = np.zeros(len(key), dtype=bool)
    repeated[order[1:][same]] = repeated[order[:-1][same]] = True
    flags = tx.covered(at[repeated], WINDOW, len(starts))
    out["n_repeat_words"] = np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds])
    return out


FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, slot int, octave int, bits double, text_hash long"


def _stretches(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: its stretches, and the first of them; of each stretch: its first code."""
    counts = -(-np.diff(bounds) // STRETCH)
    firsts = np.cumsum(counts) - counts
    return counts, firsts, (np.arange(counts.sum()) - np.repeat(firsts, counts)) * STRETCH + np.repeat(bounds[:-1], counts)


def _sums(codes: np.ndarray, bounds: np.ndarray, slot: np.ndarray, models: Models) -> np.ndarray:
    """Bits of each stretch by each of the most frequent languages, and by its own where that is another."""
    counts, _, starts = _stretches(bounds)
    out, own = np.zeros((len(starts), len(models.common) + 1)), np.repeat(slot, counts)
    distinct, of = np.unique(codes, return_inverse=True)
    if models.common:
        common = models.common_bits(distinct)
        for k in range(len(models.common)):
            out[:, k] = np.add.reduceat(common[:, k][of], starts)
    for s in np.unique(slot):
        if s in models.held and s >= ALTERNATES:
            mine = np.repeat(slot, np.diff(bounds)) == s
            seen = np.unique(of[mine])
            bits = np.zeros(len(distinct), np.float32)
            bits[seen] = models.held[s].value.bits(distinct[seen])
            out[:, -1] = np.where(own == s, np.add.reduceat(bits[of], starts), out[:, -1])
    return out


def _bits(data: np.ndarray, offsets: np.ndarray, slot: np.ndarray, models: Models, carried: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Bits per character of each text, and the octave of its length; ``carried`` are the sums by the models' further parts."""
    codes, bounds = ngram_codes(data, offsets)
    length = np.diff(bounds)
    counts, firsts, starts = _stretches(bounds)
    sums = _sums(codes, bounds, slot, models) + carried
    # where no language has a model, all symbols are equally likely
    best = sums[:, :-1].min(axis=1, initial=np.inf)
    other = np.repeat(np.isin(slot, [s for s in models.held if s >= ALTERNATES]), counts)
    best[other] = np.minimum(best[other], sums[other, -1])
    best = np.where(np.isinf(best), np.log2(ALPHABET) * np.diff(np.append(starts, len(codes))), best)
    return np.add.reduceat(best, firsts) / length, np.log2(length).astype(np.int32)


def carried(docs: DataFrame, slots: list[str | None], models: Models) -> DataFrame:
    """The documents, with the sums by the models' further parts, if they have such: read and written once for each part."""
    names = docs.columns
    for later in models.later:
        part, has = later(), CARRY in docs.columns

        def run(batches: Iterator[pa.RecordBatch], part: Models = part, has: bool = has) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    slot, before = _slot_of(batch.column("lang"), slots), batch.column(CARRY) if has else None
                    values, sizes = [], []
                    for a, b, data, offsets in tx.slices(batch.column("text")):
                        codes, bounds = ngram_codes(data, offsets)
                        sums = _sums(codes, bounds, slot[a:b], part)
                        values.append((sums + _carry(before, a, b, sums.shape[1])).ravel())
                        sizes.append(_stretches(bounds)[0] * sums.shape[1])
                    at = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(values)))
                    yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), lists], [*names, CARRY])

        docs = store(docs.mapInArrow(run, T.StructType([*(docs.schema[n] for n in names), T.StructField(CARRY, T.ArrayType(T.DoubleType()))])))
        part.drop()
    return docs


def _carry(lists: pa.Array | None, a: int, b: int, width: int) -> np.ndarray | float:
    return 0.0 if lists is None else lists.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _features(batch: pa.RecordBatch, slots: list, models: Models) -> dict[str, np.ndarray]:
    slot = _slot_of(batch.column("lang"), slots)
    before = batch.column(CARRY) if CARRY in batch.schema.names else None
    parts: list[dict[str, np.ndarray]] = []
    for a, b, data, offsets in tx.slices(batch.column("text")):
        got = base_counts(data, offsets)
        got["bits"], got["octave"] = _bits(data, offsets, slot[a:b], models, _carry(before, a, b, len(models.common) + 1))
        got["text_hash"] = tx.byte_hasher(data)(offsets[:-1], offsets[1:]).view(np.int64)
        parts.append(got)
    got = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    got["base_failed"] = (got["n_words"] < 10) | (100 * got["n_repeat_words"] > 20 * got["n_words"])
    got["slot"] = slot.astype(np.int32)
    return got


def score(docs: DataFrame, slots: list, models: Models) -> DataFrame:
    """doc_id with the base statistics, the language slot, bits per character and a hash of the text."""
    names = [f.split()[0] for f in FEATURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                got = _features(batch, slots, models)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(got[n]) for n in names]], ["doc_id", *names])

    docs = carried(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text"), slots, models)
    return docs.mapInArrow(run, f"doc_id long, {FEATURES}")


def perplexity_bands(scores: DataFrame, band: float = BAND, least: float = LEAST_BITS) -> DataFrame:
    """(slot, octave, lowest_bits, highest_bits): at most 64 rows a language.

    From a histogram (steps of 0.005) over the distinct texts that pass the base rules. Bands with few texts lean on
    the language as a whole: its texts count as if 50 of them were in every octave.
    """
    once = scores.filter(~F.col("base_failed")).groupBy("slot", "octave", "text_hash").agg(F.min("bits").alias("bits"))
    bins = once.groupBy("slot", "octave", F.round(F.least(F.col("bits"), F.lit(40.0)) * 200).cast("int").alias("bin")).agg(F.count("*").cast("double").alias("n"))
    whole = bins.groupBy("slot", "bin").agg(F.sum("n").alias("n")).withColumn("n", 50.0 * F.col("n") / F.sum("n").over(Window.partitionBy("slot")))
    octaves = bins.select("slot", "octave").distinct()
    bins = bins.unionByName(whole.join(octaves, "slot").select("slot", "octave", "bin", "n"))
    own = Window.partitionBy("slot", "octave")
    share = bins.groupBy("slot", "octave", "bin").agg(F.sum("n").alias("n")).withColumn("share", F.sum("n").over(own.orderBy("bin")) / F.sum("n").over(own))
    at = lambda p: F.min(F.when(F.col("share") >= p, F.col("bin") / 200))
    quartiles = share.groupBy("slot", "octave").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))
    # a quartile is 0.6745 deviations from the median
    reach = lambda x: F.greatest(F.lit(least), band * x / 0.6745)
    return quartiles.select("slot", "octave", (F.col("q2") - reach(F.col("q2") - F.col("q1"))).alias("lowest_bits"), (F.col("q2") + reach(F.col("q3") - F.col("q2"))).alias("highest_bits"))


def verdicts(docs: DataFrame, band: float = BAND, least: float = LEAST_BITS) -> DataFrame:
    """One row for each document: base statistics, base_failed, kept, bits_per_char and its band."""
    prepare(docs.sparkSession)
    slots = language_slots(docs)
    models = fit_models(docs, slots)
    scores = cut(score(docs, slots, models))
    models.drop()
    bands = F.broadcast(perplexity_bands(scores, band, least))
    inside = (F.col("n_symbols") * MARK_WORDS <= F.col("n_words")) & F.coalesce(F.col("bits").between(F.col("lowest_bits"), F.col("highest_bits")), F.lit(True))
    return scores.join(bands, ["slot", "octave"], "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & inside).alias("kept"),
        F.col("bits").alias("bits_per_char"), "lowest_bits", "highest_bits",
    )


def keep_quality(docs: DataFrame, band: float = BAND, least: float = LEAST_BITS) -> DataFrame:
    """The documents that pass, with all their columns. Texts are scored once, and written with their scores; ``_quality_*``
    are reserved names."""
    prepare(docs.sparkSession)
    slots = language_slots(docs)
    models = fit_models(docs, slots)
    own = {"base_failed": T.BooleanType(), "n_words": T.LongType(), "n_symbols": T.LongType(), "slot": T.IntegerType(), "octave": T.IntegerType(), "bits": T.DoubleType(), "text_hash": T.LongType()}
    names, width = [f"_quality_{n}" for n in own], len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                got = _features(batch, slots, models)
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(width)), *[pa.array(got[n]) for n in own]], [*batch.schema.names[:width], *names])

    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(names, own.values(), strict=True)]])
    scored = store(carried(docs, slots, models).mapInArrow(run, schema))
    models.drop()
    scores = scored.select(*[F.col(f"_quality_{n}").alias(n) for n in own])
    bands = F.broadcast(perplexity_bands(scores, band, least).withColumnsRenamed({c: f"_quality_{c}" for c in ("slot", "octave", "lowest_bits", "highest_bits")}))
    q = lambda n: F.col(f"_quality_{n}")
    inside = F.coalesce(q("bits").between(q("lowest_bits"), q("highest_bits")), F.lit(True)) & (q("n_symbols") * MARK_WORDS <= q("n_words"))
    return scored.join(bands, ["_quality_slot", "_quality_octave"], "left").filter(~q("base_failed") & inside).select(*[F.col(f"`{c}`") for c in docs.columns])
