"""Session helpers of the operators: checkpoints in the shared folder, Arrow batches of bounded bytes."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def prepare(spark: SparkSession) -> SparkSession:
    """Set the checkpoint folder that the cluster names (one of its own only where driver and executors are one process),
    and bound Arrow batches by bytes for the session."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not context._jsc.sc().isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tessera-checkpoint-"))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


def cut(df: DataFrame) -> DataFrame:
    """The frame, written once to the shared checkpoint folder: it survives lost executors and isn't computed again.

    As in :func:`store`, shuffle files that led to it are let go: rounds of small jobs would pile them up.
    """
    prepare(df.sparkSession)
    done = df.checkpoint(eager=True)
    df.sparkSession.sparkContext._jvm.System.gc()
    return done


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def md5_uniform(*columns: Column | str) -> Column:
    """A number in (0, 1) from the columns' text, the same in every engine that has md5."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("")) for c in columns])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


_STORED: list[str] = []
_REGISTERED: list[Callable] = []


def store(df: DataFrame) -> DataFrame:
    """The frame as compressed Parquet in the shared checkpoint folder, for tables too wide for checkpoint().

    The folder goes when the session's Python ends. Shuffle files that led to the table aren't needed any more, but Spark
    drops them only once the driver's JVM has found them unreachable: it is asked to look.
    """
    spark = prepare(df.sparkSession)
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    path = f"{context._jsc.sc().getCheckpointDir().get()}/tables/{uuid.uuid4().hex}"
    if not _REGISTERED:
        _REGISTERED.append(atexit.register(_drop_stored, jvm, context))
    _STORED.append(path)
    df.write.option("compression", "zstd").parquet(path)
    jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def drop(*stored: DataFrame) -> None:
    """Deletes tables of :func:`store` that no frame will be read from any more."""
    for df in stored:
        path = next((p for p in _STORED if any(f"/{p.rsplit('/', 1)[1]}/" in f for f in df.inputFiles()[:1])), None)
        if path:
            jvm, context = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
            _STORED.remove(path)


def _drop_stored(jvm: object, context: object) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        for path in _STORED:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


BLOOM_BITS = 1 << 23


def bloom(ids: DataFrame, column: str, bits: int = BLOOM_BITS) -> np.ndarray:
    """A Bloom filter of ``bits`` bits, whatever the number of ids: more ids only let more others through."""
    at = F.explode(F.array(*[F.pmod(F.xxhash64(F.col(column), F.lit(i)), F.lit(bits)) for i in range(3)]))
    words = ids.select(at.alias("bit")).groupBy(F.expr("CAST(bit DIV 64 AS INT)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("bits"))
    table = np.zeros(bits // 64, dtype=np.int64)
    rows = words.toArrow()
    table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return table


def through_bloom(df: DataFrame, table: np.ndarray, column: str, keep: bool, run: Callable | None = None, schema: T.StructType | str | None = None) -> DataFrame:
    """The rows of which the filter may hold the column's value (``keep``), or of which it surely doesn't (not ``keep``).

    ``run``, a function for mapInArrow with ``schema``, gets those rows in the same pass, so that a task needs one Python
    worker only. A null is never held.
    """
    spark, names = df.sparkSession, df.columns
    held = spark.sparkContext.broadcast(table)
    places = F.when(F.col(column).isNotNull(), F.array(*[F.pmod(F.xxhash64(F.col(column), F.lit(i)), F.lit(len(table) * 64)) for i in range(3)]))

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bits = batch.column("_bloom_")
                known = bits.is_valid().to_numpy(zero_copy_only=False)
                found = np.zeros(batch.num_rows, dtype=bool)
                at = bits.flatten().to_numpy(zero_copy_only=False).reshape(-1, 3)
                found[known] = ((held.value[at // 64] >> (at % 64)) & 1 == 1).all(axis=1)
                yield batch.select(names).filter(pa.array(found == keep))

    marked = df.select(*[F.col(f"`{c}`") for c in names], places.alias("_bloom_"))
    if run is None:
        return marked.mapInArrow(filtered, df.schema)
    return marked.mapInArrow(lambda batches: run(filtered(batches)), schema)
