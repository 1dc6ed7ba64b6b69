"""Mixing sources to target weights by Efraimidis-Spirakis sampling without replacement.

Each source gets a share of all words by its weight, at most ``cap`` times its own words; the excess goes to the
others by weight. A source's documents are ordered by the key ``-ln(u) / quality``, ``u`` a hash of doc_id and
seed. The mix takes ``epochs`` whole copies of every document, then the documents that come first in that order,
until their words come nearest to what is left of the target.

Prefix sums don't bring a source together: keys are cut into buckets by value, summed in parallel, and only the one
bucket in which a source's budget ends (about ``BUCKET_ROWS`` rows) is sorted. What that yields is one cut-off for
each source; every document then decides by itself whether it is below it.

Edge cases: null text or no words: size 0, taken 0; null source: a source of its own, last in order; rows with equal
doc_id and size stand or fall together; an empty table gives an empty result; names of other columns may be any
that don't start with ``_mix_``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import _text as tx
from tessera.llm._spark import cut, md5_uniform, prepare

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 7
BUCKET_ROWS = 2_000
#: Up to so many sources, their targets (under 100 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 10_000

IS_LETTER = np.zeros(256, dtype=bool)
IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def sized(docs: DataFrame) -> DataFrame:
    """All columns, with ``_mix_size`` (words of the whole text) and ``_mix_quality`` (share of letter bytes, above 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget()
        for batch in batches:
            sizes, qualities = [np.zeros(0, np.int64)], [np.zeros(0)]
            for _, _, data, offsets in tx.slices(batch.column("text")):
                sizes.append(np.diff(tx.word_spans(data, offsets)[2]))
                letters = np.diff(np.concatenate([[0], np.cumsum(IS_LETTER[data])])[offsets])
                qualities.append((letters + 1.0) / (np.diff(offsets) + 1.0))
            columns = [*batch.columns, pa.array(np.concatenate(sizes)), pa.array(np.concatenate(qualities))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_mix_size", "_mix_quality"])

    extra = [T.StructField("_mix_size", T.LongType()), T.StructField("_mix_quality", T.DoubleType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *extra]))


def keyed(frame: DataFrame, seed: int) -> DataFrame:
    return frame.withColumn("_mix_key", -F.log(md5_uniform("doc_id", F.lit(seed))) / F.col("_mix_quality"))


def targets(stats: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size (and further columns of ``stats``) with weight and target. One row a source, so one task does."""
    n = len(weights)
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % n + 1).cast("int"))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    limit = cap * F.col("source_size")
    # in order of size against weight, sources are at their limit until one's share of what is left stays below it
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    frame = stats.withColumn("weight", weight)
    frame = frame.withColumn("_full", limit * F.sum("weight").over(after) <= left * F.col("weight"))
    room = F.sum("source_size").over(everything) - F.sum(F.when(F.col("_full"), limit).otherwise(0)).over(everything)
    others = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(everything)
    share = (room * F.col("weight")).cast("double") / F.nullif(others, F.lit(0))
    return frame.withColumn("target", F.when(F.col("_full"), limit.cast("double")).otherwise(share)).drop("_full")


def cutoffs(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, target, epochs and the last (key, doc_id, size) of the fractional epoch (null: none)."""
    stats = rows.groupBy("source").agg(F.sum("_mix_size").alias("source_size"), F.count("*").alias("_n"), F.avg("_mix_quality").alias("_q"))
    plan = targets(stats, weights, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = cut(plan.withColumn("epochs", epochs.cast("long")).withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    small = plan.select(F.col("source").alias("_source"), "_n", "_q", "_rest")
    if plan.count() <= BROADCAST_SOURCES:
        small = F.broadcast(small)
    joined = rows.join(small, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "_bucket", F.floor((1 - F.exp(-F.col("_mix_key") * F.col("_q"))) * F.ceil(F.col("_n") / BUCKET_ROWS))
    )
    sums = joined.groupBy("source", "_bucket", "_rest").agg(F.sum("_mix_size").alias("_sum"))
    running = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    # the last bucket that a budget reaches: all before it are taken whole
    reached = sums.withColumn("_before", F.sum("_sum").over(running) - F.col("_sum")).filter(F.col("_before") <= F.col("_rest"))
    last = reached.groupBy("source").agg(F.max_by(F.struct("_bucket", "_before"), "_bucket").alias("_last"))
    last = last.select(F.col("source").alias("_source2"), F.col("_last._bucket").alias("_bucket2"), F.col("_last._before").alias("_before"))
    near = joined.join(last, F.col("source").eqNullSafe(F.col("_source2")) & (F.col("_bucket") == F.col("_bucket2")))
    order = [F.col("_mix_key"), F.asc_nulls_first("doc_id"), F.col("_mix_size")]
    up_to = F.col("_before") + F.sum("_mix_size").over(Window.partitionBy("source").orderBy(*order))
    taken = near.withColumn("_to", up_to).filter(2 * F.col("_to") - F.col("_mix_size") <= 2 * F.col("_rest"))
    ends = taken.groupBy("source").agg(F.max(F.struct("_mix_key", F.coalesce("doc_id", F.lit(-(2**63))).alias("id"), "_mix_size")).alias("cut"))
    whole = last.select(F.col("_source2").alias("_source3"), F.col("_bucket2").alias("_whole_below"))
    ends = ends.withColumnRenamed("source", "_source4")
    return (
        plan.join(whole, F.col("source").eqNullSafe(F.col("_source3")), "left")
        .join(ends, F.col("source").eqNullSafe(F.col("_source4")), "left")
        .select("source", "source_size", "target", "epochs", "cut", "_whole_below", "_n", "_q")
    )


def _plan(small: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    frame = cutoffs(small, weights, cap)
    frame = cut(frame.withColumnsRenamed({c: f"_mix_{c.strip('_')}_" for c in frame.columns}))
    return F.broadcast(frame) if frame.count() <= BROADCAST_SOURCES else frame


def _small(docs: DataFrame, seed: int) -> DataFrame:
    prepare(docs.sparkSession)
    return cut(keyed(sized(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")), seed).drop("text"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """All columns of ``docs`` (with doc_id, source, text), _mix_size, _mix_source_size, _mix_target and _mix_copies.

    Texts aren't shuffled: they are read once to size them, and once more to be given their copies.
    """
    return _decide(keyed(sized(docs), seed), _plan(_small(docs, seed), weights, cap))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as it was taken."""
    names = docs.columns
    taken = mix(docs, weights, cap, seed).filter(F.col("_mix_copies") > 0)
    return taken.select(*names, F.explode(F.array_repeat(F.lit(1), F.col("_mix_copies").cast("int"))).alias("_mix_copy")).select(*names)


def mix_digest(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken: as :func:`mix`, with the texts read once."""
    small = _small(docs, seed)
    out = _decide(small, _plan(small, weights, cap))
    return out.select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"), (F.col("_mix_size") * F.col("_mix_copies")).alias("taken"),
    )


def _decide(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Whether each row is in the fractional epoch: its bucket is below the last one, or it isn't after the cut-off."""
    bucket = F.floor((1 - F.exp(-F.col("_mix_key") * F.col("_mix_q_"))) * F.ceil(F.col("_mix_n_") / BUCKET_ROWS))
    place = F.struct(F.col("_mix_key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("id"), F.col("_mix_size"))
    inside = F.coalesce(bucket < F.col("_mix_whole_below_"), F.lit(False)) | F.coalesce((bucket == F.col("_mix_whole_below_")) & (place <= F.col("_mix_cut_")), F.lit(False))
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("_mix_source_")))
    mine = [c for c in rows.columns if c not in ("_mix_key", "_mix_quality")]
    return joined.select(*mine, F.col("_mix_source_size_").alias("_mix_source_size"), F.col("_mix_target_").alias("_mix_target"), (F.col("_mix_epochs_") + inside.cast("long")).alias("_mix_copies"))


ORACLE_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (strlen(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[A-Za-z]|[^\x00-\x7F]', '', 'g')) + 1.0::DOUBLE)
      / (strlen(coalesce(text, '')) + 1.0::DOUBLE) AS quality,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|{SEED}'), 1, 13))::BIGINT + 0.5::DOUBLE) / {2.0**52:.1f}::DOUBLE AS u
  FROM documents
), stats AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source
), ratio AS (
  SELECT *, {CAP} * source_size * sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= weight * (sum(source_size) OVER () - coalesce(sum({CAP} * source_size) OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_full
  FROM stats
), target AS (
  SELECT source, source_size, CASE WHEN is_full THEN ({CAP} * source_size)::DOUBLE ELSE
    (weight * (sum(source_size) OVER () - sum(CASE WHEN is_full THEN {CAP} * source_size ELSE 0 END) OVER ()))::DOUBLE
      / nullif(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (), 0)::DOUBLE END AS target
  FROM ratio
), ordered AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
    sum(size) OVER (PARTITION BY s.source ORDER BY -ln(u) / quality, doc_id, size) AS up_to
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN 2 * up_to - size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""
