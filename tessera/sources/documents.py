"""Documents by key: a Python data source that writes one file a key, and makes a job's files visible by one rename.

    spark.dataSource.register(DocumentDataSource)
    frame.write.format("documents").mode("append").save(path)      # columns key and document, both text
    spark.read.format("documents").option("key", "A-1").load(path)

Layout: ``<job>/<task attempt>/<bucket>/<key>.json``, and for each job that has ended well a small file under ``_commits`` that
names, for each bucket, the folders of its tasks. Readers go by these files alone: what a failed task or job leaves is never
seen, and goes as the job is aborted. The newest job that holds a key gives its document, so that running a job again changes
nothing. One key is read by looking for its file in its own bucket, newest job first; a whole table is listed by
tasks, bucket by bucket, not by the driver. :func:`compact` puts all jobs into one.

Options: path, key (one document only), content (false: keys alone, from the names of files), splits (tasks of a scan, 64),
buckets (4096, fixed by a table's first job), compact. A null key is an error. One
writer at a time.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "key string, document string"
COMMITS, BUCKETS, SPLITS = "_commits", 4096, 64
LONG = ".long.json"
#: Documents and bytes that a reader hands on at once.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def bucket_of(key: str, buckets: int) -> str:
    return f"{int.from_bytes(hashlib.md5(key.encode()).digest()[:8], 'big') % buckets:05d}"


def file_of(key: str) -> str:
    """The file's name; that of a long key is a digest, and the file's first line tells the key."""
    name = quote(key, safe="").replace(".", "%2E")  # files that begin with a dot are hidden
    return f"{name}.json" if len(name) <= 200 else f"{hashlib.sha256(key.encode()).hexdigest()}{LONG}"


def commits(path: str) -> list[dict]:
    """Jobs that readers see, newest first."""
    system, root = opened(path)
    listed = sorted(x.path for x in system.get_file_info(pafs.FileSelector(f"{root}/{COMMITS}", allow_not_found=True)) if x.path.endswith(".json"))
    found = []
    for at in listed:
        with system.open_input_stream(at) as stream:
            found.append(json.loads(stream.read()) | {"file": at})
    gone = {job for c in found for job in c["replaces"]}
    return [c for c in reversed(found) if c["job"] not in gone]


@dataclass
class Written(WriterCommitMessage):
    folder: str
    buckets: list[str]
    documents: int


class DocumentWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path, self.job = options["path"], uuid.uuid4().hex
        before = commits(self.path)
        self.buckets = before[0]["buckets"] if before else int(options.get("buckets", BUCKETS))
        self.replaces = [c["job"] for c in before] if options.get("compact") == "true" else []

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = opened(self.path)
        context = TaskContext.get()
        folder, made, n = f"{self.job}/{context.partitionId():06d}-{context.taskAttemptId()}", set(), 0
        for batch in iterator:
            for key, document in zip(batch.column("key").to_pylist(), batch.column("document").to_pylist(), strict=True):
                if key is None:
                    raise ValueError("a document without a key")
                at = f"{root}/{folder}/{(bucket := bucket_of(key, self.buckets))}"
                if bucket not in made:
                    system.create_dir(at)
                    made.add(bucket)
                with system.open_output_stream(f"{at}/{file_of(key)}") as stream:
                    if file_of(key).endswith(LONG):
                        stream.write(json.dumps(key).encode() + b"\n")
                    stream.write((document or "").encode())
                n += 1
        return Written(folder, sorted(made), n)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = opened(self.path)
        folders: dict[str, list[str]] = {}
        for m in messages:
            for bucket in m.buckets if m else ():
                folders.setdefault(bucket, []).append(m.folder)
        before = commits(self.path)
        number = max((c["number"] for c in before), default=0) + 1
        made = {"job": self.job, "number": number, "buckets": self.buckets, "replaces": self.replaces, "documents": sum(m.documents for m in messages if m), "folders": folders}
        system.create_dir(f"{root}/{COMMITS}")
        with system.open_output_stream(f"{root}/{COMMITS}/{self.job}.tmp") as stream:
            stream.write(json.dumps(made).encode())
        system.move(f"{root}/{COMMITS}/{self.job}.tmp", f"{root}/{COMMITS}/{number:010d}-{self.job}.json")
        for old in before:  # readers don't see them any more
            if old["job"] in self.replaces:
                system.delete_file(old["file"])
                _drop(system, f"{root}/{old['job']}")

    def abort(self, messages: list[Written | None]) -> None:
        system, root = opened(self.path)
        _drop(system, f"{root}/{self.job}")


def _drop(system: pafs.FileSystem, path: str) -> None:
    if system.get_file_info(path).type == pafs.FileType.Directory:
        system.delete_dir(path)


@dataclass
class Buckets(InputPartition):
    """Buckets with their folders, newest first, and the one key to look for, if any."""

    folders: dict[str, list[str]]
    key: str | None = None


class DocumentReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.key, self.splits = options["path"], options.get("key"), int(options.get("splits", SPLITS))
        self.content = options.get("content") != "false"

    def partitions(self) -> list[InputPartition]:
        folders: dict[str, list[str]] = {}
        seen = commits(self.path)
        for commit in seen:
            for bucket, found in commit["folders"].items():
                folders.setdefault(bucket, []).extend(found)
        if self.key is not None:
            own = bucket_of(self.key, seen[0]["buckets"]) if seen else ""
            return [Buckets({own: folders.get(own, [])}, self.key)]
        dealt: list[dict[str, list[str]]] = [{} for _ in range(min(self.splits, len(folders)) or 1)]
        for i, bucket in enumerate(sorted(folders)):
            dealt[i % len(dealt)][bucket] = folders[bucket]
        return [Buckets(d) for d in dealt]

    def read(self, partition: Buckets) -> Iterator[pa.RecordBatch]:
        system, root = opened(self.path)
        rows: list[tuple[str, str | None]] = []
        size = 0
        for key, at in self._files(partition, system, root):
            text = None
            if self.content or at.endswith(LONG):
                with system.open_input_stream(at) as stream:
                    text = stream.read().decode()
            if at.endswith(LONG):
                first, _, text = text.partition("\n")
                key = json.loads(first)
            rows.append((key, text if self.content else None))
            size += len(text or "")
            if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _files(self, partition: Buckets, system: pafs.FileSystem, root: str) -> Iterator[tuple[str, str]]:
        for bucket, folders in partition.folders.items():
            if partition.key is not None:
                tried = (f"{root}/{f}/{bucket}/{file_of(partition.key)}" for f in folders)
                at = next((p for p in tried if system.get_file_info(p).type == pafs.FileType.File), None)
                if at is not None:
                    yield partition.key, at
                return
            seen: set[str] = set()  # a bucket's keys: a table's buckets bound them
            for folder in folders:
                for found in system.get_file_info(pafs.FileSelector(f"{root}/{folder}/{bucket}")):
                    if found.base_name not in seen:
                        seen.add(found.base_name)
                        yield unquote(found.base_name.removesuffix(".json")), found.path

    def _batch(self, rows: list[tuple[str, str | None]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.string()), pa.array([d for _, d in rows], pa.string())], ["key", "document"])


class DocumentDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "documents"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DocumentReader:
        return DocumentReader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(dict(self.options))


def write(rows: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Each row as the JSON document of its key; a key's older document is replaced, others stay."""
    rows.sparkSession.dataSource.register(DocumentDataSource)
    documents = rows.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("document"))
    # keys of a bucket meet in few tasks, so that a job makes few folders
    dealt = documents.repartition(F.pmod(F.xxhash64("key"), F.lit(buckets)))
    dealt.write.format("documents").option("buckets", buckets).mode("append").save(path)


def read(spark: SparkSession, path: str, schema: str | T.StructType, key: str | None = None) -> DataFrame:
    """Stored documents by a schema: all of them, or the one of a key."""
    spark.dataSource.register(DocumentDataSource)
    reader = spark.read.format("documents") if key is None else spark.read.format("documents").option("key", key)
    return reader.load(path).select(F.from_json("document", schema).alias("d")).select("d.*")


def keys(spark: SparkSession, path: str) -> DataFrame:
    """The keys of a table, without its documents."""
    spark.dataSource.register(DocumentDataSource)
    return spark.read.format("documents").option("content", "false").load(path).select("key")


def compact(spark: SparkSession, path: str) -> None:
    """All jobs of a table as one; older files go as it ends, and readers that had planned with them have to begin again."""
    spark.dataSource.register(DocumentDataSource)
    spark.read.format("documents").load(path).write.format("documents").option("compact", "true").mode("append").save(path)
