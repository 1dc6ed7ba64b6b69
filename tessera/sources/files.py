"""Reading and writing documents, dictionaries, attachments and dead letters through Spark's own file sources."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import documents

ENTRY = "array<struct<canonical:string,aliases:array<string>>>"
DEAD_LETTER = (
    "ticket_key string, stage string, error_type string, error_message string, timestamp string, trigger string, "
    "raw_summary struct<key:string,fields_keys:array<string>,attachment_count:int>, extra map<string,string>"
)
#: Where a line goes that isn't a document.
CORRUPT = "_corrupt_record"
FORMATS = ("json", "jsonl", "parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share: under the checkpoint folder, or the warehouse where none is named."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return f"{named or spark.conf.get('spark.sql.warehouse.dir')}/tessera-{uuid.uuid4().hex}"


def has_folders(spark: SparkSession, path: str, column: str) -> bool:
    """Whether a table that is dealt in folders by a column has any."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}=*")
    return len(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []) > 0


_STORED: list[str] = []


def stored(rows: DataFrame) -> DataFrame:
    """The rows, written once to a folder of their own that all executors share; it goes when the session's Python ends."""
    spark = rows.sparkSession
    path = scratch(spark)
    if not _STORED:
        atexit.register(_drop, spark.sparkContext._jvm, spark.sparkContext)
    _STORED.append(path)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


class Stages:
    """Stages of one plan, stored in little space: compressed well, without the shuffle files that led to them, deleted once done with.

    Spark drops shuffle files only once the driver's JVM has found them unreachable: it is asked to look.
    """

    def __init__(self) -> None:
        self.paths: dict[str, str] = {}

    def keep(self, name: str, rows: DataFrame) -> DataFrame:
        spark = rows.sparkSession
        jvm, path = spark.sparkContext._jvm, scratch(spark)
        if not _STORED:
            atexit.register(_drop, jvm, spark.sparkContext)
        _STORED.append(path)
        rows.write.option("compression", "zstd").parquet(path)
        jvm.System.gc()
        self.paths[name] = path
        return spark.read.schema(rows.schema).parquet(path)

    def done(self, spark: SparkSession, name: str) -> None:
        """Deletes a stage that no frame will be read from any more."""
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.paths[name])
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        _STORED.remove(self.paths.pop(name))


def _drop(jvm: object, context: object) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        for path in _STORED:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def read_json(spark: SparkSession, path: str, schema: str | T.StructType, key: str | None = None) -> DataFrame:
    """Landed files of one document each, but for vector files; all of a folder, or the one named after a key."""
    reader = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", f"{key or '*'}.json")
    return reader.json(path).filter(~F.endswith(F.input_file_name(), F.lit(".embeddings.json")))


def read_documents(spark: SparkSession, path: str, schema: str | T.StructType, key: str | None = None) -> DataFrame:
    """What ``write_documents(..., "json")`` has stored: all of it, or one key's document, of which only the file is read."""
    return documents.read(spark, path, schema, key)


def read_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One document a line; blank and malformed lines are left out (:func:`parted_lines` gives those too)."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def parted_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """(documents, malformed lines): one document a line; blank lines are neither.

    A malformed line comes with its file and its number in it, from 1. Files may be read in many blocks: a line's number is
    its place in its block, after the counted lines of the blocks before. Only those counts and the bad lines are gathered.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")
    )
    wanted = T.StructType([*kind.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = text.filter(F.trim("value") != "").withColumn("d", F.from_json("value", wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col(f"d.{CORRUPT}").isNotNull()
    blocks = text.groupBy("file", "block").agg(F.count("*").alias("lines"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("lines").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("file", "block", "first", before.alias("before"))
    wrong = parsed.filter(bad).select("file", "block", "at", F.col("value").alias("text")).join(blocks, ["file", "block"])
    return parsed.filter(~bad).select(*[F.col(f"d.`{f.name}`") for f in kind.fields]), wrong.select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), "text")


def quarantine(malformed: DataFrame, path: str, stage: str = "read") -> None:
    """Appends malformed lines to the dead letters, with file, line number and what they hold."""
    extra = F.create_map(F.lit("file"), F.col("file"), F.lit("line"), F.col("line").cast("string"), F.lit("text"), F.col("text"))
    summary = F.lit(None).cast("struct<key:string,fields_keys:array<string>,attachment_count:int>")
    message = F.concat(F.lit("line "), F.col("line").cast("string"), F.lit(" isn't a document"))
    append_dead_letters(malformed.select(
        F.lit("").alias("ticket_key"), F.lit(stage).alias("stage"), F.lit("MalformedLine").alias("error_type"), message.alias("error_message"), F.current_timestamp().alias("timestamp"),
        F.lit("read").alias("trigger"), summary.alias("raw_summary"), extra.alias("extra"),
    ), path)


def read_binary(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Landed attachments: filename, size and file_bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("length").alias("size"), F.col("content").alias("file_bytes"), F.col("modificationTime").cast("string").alias("created"))


def read_dictionary(spark: SparkSession, path: str, types: tuple[str, ...]) -> DataFrame:
    """(etype, canonical, aliases, ord) of <type>.json files, each one array of entries; missing types are empty."""
    text = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(path).withColumn("etype", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1))
    rows = text.filter(F.col("etype").isin(*types)).select("etype", F.posexplode(F.from_json("value", ENTRY)).alias("ord", "e"))
    return rows.select("etype", "e.canonical", "e.aliases", "ord")


def seed_dictionary(entries: DataFrame, path: str) -> None:
    """Writes a dictionary as one Parquet table; an empty one holds the schema."""
    entries.write.mode("ignore").parquet(path)


def sync_dictionary(spark: SparkSession, url: str, query: str, etype: str, properties: dict[str, str] | None = None, bounds: tuple[str, int, int, int] | None = None) -> DataFrame:
    """Entries from a database: ``query`` gives canonical and, if it can, description, of which aliases are made.

    ``bounds``: a numeric column of the query, its least and greatest value, and in how many parts to read it at once.
    """
    from tessera.functions.text import key_phrases

    asked = f"({query}) q"
    if bounds is None:
        rows = spark.read.jdbc(url, asked, properties=properties or {})
    else:
        column, low, high, parts = bounds
        rows = spark.read.jdbc(url, asked, column=column, lowerBound=low, upperBound=high, numPartitions=parts, properties=properties or {})
    aliases: Column = key_phrases(F.col("description")) if "description" in rows.columns else F.array().cast("array<string>")
    return rows.select(F.lit(etype).alias("etype"), "canonical", aliases.alias("aliases"), F.monotonically_increasing_id().alias("ord"))


def write_documents(rows: DataFrame, path: str, fmt: str, key: str = "ticket_key", mode: str = "append") -> None:
    """json: one file a key, of which those of the given keys alone are replaced; jsonl: appended lines; parquet: flat
    columns. An unknown format is an error."""
    if fmt == "json":
        documents.write(rows, path, key)
    elif fmt == "jsonl":
        rows.write.mode(mode).json(path)
    elif fmt == "parquet":
        rows.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}; one of {', '.join(FORMATS)}")


def flatten(rows: DataFrame, lists: list[str]) -> DataFrame:
    """List and struct columns as JSON text, for one flat row a document."""
    return rows.withColumns({c: F.to_json(c) for c in lists})


def shorten(rows: DataFrame, most: int = 2000, without: tuple[str, ...] = ("attachment", "comment", "worklog")) -> DataFrame:
    """Long texts cut, bulky fields dropped: for looking at."""
    kept = [f for f in rows.schema.fields if f.name not in without]
    return rows.select(*[F.substring(f.name, 1, most).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in kept])


def stage_artifact(rows: DataFrame, path: str, number: int, name: str) -> None:
    rows.write.mode("overwrite").json(f"{path}/{number:02d}_{name}")


def append_dead_letters(entries: DataFrame, path: str) -> None:
    entries.withColumn("timestamp", F.col("timestamp").cast("string")).write.mode("append").json(path)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return read_lines(spark, path, DEAD_LETTER)


def clear_dead_letters(spark: SparkSession, path: str) -> None:
    """Leaves a table without rows; one that isn't there stays away."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    at = jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(context._jsc.hadoopConfiguration()).exists(at):
        spark.createDataFrame([], DEAD_LETTER).write.mode("overwrite").json(path)


def list_keys(rows: DataFrame, key: str = "ticket_key") -> DataFrame:
    return rows.select(key).distinct().orderBy(key)


def exists(rows: DataFrame, key: str, value: str) -> bool:
    return not rows.filter(F.col(key) == value).limit(1).isEmpty()
