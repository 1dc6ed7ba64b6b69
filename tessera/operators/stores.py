"""Upsert tables on plain Parquet: a coarse, a fine and a metadata index, and labels kept apart from all of them.

A table is a base and some later parts. An upsert writes its own rows as a part and nothing else; reading lets the latest part that
holds an id win. Once the parts hold a quarter of the base's rows, or there are :data:`PARTS` of them, the next upsert makes all of
them the new base, so that a row is written a few times in a table's life however large it grows. A base is sorted by id: one id
is found by the statistics of its files. Which parts count, with the table's columns and rows, says the newest file of ``_versions``,
which appears by a rename; what a crash leaves isn't named there. Latest wins by the given order, so that running an
upsert again gives the same table. One writer at a time may upsert into a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import text as tx
from tessera.operators.records import latest

BACKENDS = ("parquet", "memory")
VERSIONS, PARTS, SHARE = "_versions", 8, 4
#: Rows of a file of a base.
FILE_ROWS = 1_000_000
#: Columns of labels: none of them may be in a retrieval table.
LABELS = ("vs_labels", "vs_label_source", "linked_value_stream_ids", "linked_value_stream_names", "linked_value_stream_statuses", "impacted_products", "impacted_it_products", "product_stage_labels", "trainability")


class Store:
    """Rows by id. The memory backend keeps a DataFrame, for tests."""

    def __init__(self, spark: SparkSession, path: str | None, backend: str = "parquet"):
        if backend not in BACKENDS:
            raise ValueError(f"unknown backend {backend!r}; one of {', '.join(BACKENDS)}")
        self.spark, self.path, self.backend = spark, path, backend
        self._rows: DataFrame | None = None

    def _system(self) -> tuple[Any, Callable[[str], Any]]:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return at(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), lambda name: at(f"{self.path}/{name}")

    def _version(self) -> dict[str, Any]:
        """The newest version: its number, the table's schema, and [name, rows] of its parts, the base first."""
        system, at = self._system()
        names = [f.getPath().getName() for f in system.listStatus(at(VERSIONS))] if system.exists(at(VERSIONS)) else []
        newest = max((n for n in names if n.endswith(".json")), default=None)
        if newest is None:
            return {"number": 0, "schema": None, "parts": []}
        (row,) = self.spark.read.option("wholetext", True).text(f"{self.path}/{VERSIONS}/{newest}").collect()
        return json.loads(row[0])

    def _publish(self, version: dict[str, Any]) -> None:
        system, at = self._system()
        draft, name = at(f"{VERSIONS}/draft.tmp"), at(f"{VERSIONS}/{version['number']:010d}.json")
        out = system.create(draft, True)
        out.write(json.dumps(version).encode())
        out.close()
        if not system.rename(draft, name):
            raise OSError(f"can't publish {name}")

    def _part(self, name: str, schema: T.StructType) -> DataFrame:
        # a column that came later is null in older parts
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _merged(self, version: dict[str, Any], only: Column | None = None) -> DataFrame | None:
        if not version["parts"]:
            return None
        schema = T.StructType.fromJson(json.loads(version["schema"]))
        parts = [self._part(name, schema) if only is None else self._part(name, schema).filter(only) for name, _ in version["parts"]]
        if len(parts) == 1:
            return parts[0]
        later = parts[1].withColumn("_part", F.lit(1))
        for i, part in enumerate(parts[2:], 2):
            later = later.unionByName(part.withColumn("_part", F.lit(i)))
        later = latest(later, ["id"], ["_part"]).drop("_part")
        return parts[0].join(later.select("id"), "id", "left_anti").unionByName(later)

    def read(self) -> DataFrame | None:
        return self._rows if self.backend == "memory" else self._merged(self._version())

    def get(self, key: str) -> dict | None:
        own = F.col("id") == key
        rows = (None if self._rows is None else self._rows.filter(own)) if self.backend == "memory" else self._merged(self._version(), own)
        row = None if rows is None else rows.first()
        return row.asDict(recursive=True) if row else None

    def upsert(self, batch: DataFrame, order: list[str]) -> None:
        """Rows of the batch replace those of the same id; of several in the batch, the last by ``order`` counts."""
        fresh = latest(batch, ["id"], order)
        if self.backend == "memory":
            old = self._rows
            self._rows = fresh if old is None else old.join(fresh.select("id"), "id", "left_anti").unionByName(fresh, allowMissingColumns=True)
            return
        version = self._version()
        name, rows = self._write(fresh)
        if not rows:
            return
        schema = fresh.schema
        if version["schema"] is not None:
            known = T.StructType.fromJson(json.loads(version["schema"]))
            schema = T.StructType([*known.fields, *[f for f in fresh.schema.fields if f.name not in known.names]])
        version = {"number": version["number"] + 1, "schema": schema.json(), "parts": [*version["parts"], [name, rows]]}
        base, more = version["parts"][0][1], sum(n for _, n in version["parts"][1:])
        if more * SHARE >= base or len(version["parts"]) > PARTS:
            self._publish(version)
            # the base of so many rows at most, as files of their own ranges of ids
            whole = self._merged(version).repartitionByRange(max(1, -(-(base + more) // FILE_ROWS)), "id").sortWithinPartitions("id")
            version = version | {"number": version["number"] + 1, "parts": [list(self._write(whole))]}
        self._publish(version)

    def _write(self, rows: DataFrame) -> tuple[str, int]:
        name, counted = f"part-{uuid.uuid4().hex}", Observation()
        rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.path}/{name}")
        return name, counted.get["rows"]

    def vacuum(self) -> None:
        """Drops parts and versions that the newest version doesn't name. Readers that began earlier have to begin again."""
        system, at = self._system()
        version = self._version()
        kept = {VERSIONS, *[name for name, _ in version["parts"]]}
        for folder, keep in (("", kept), (VERSIONS, {f"{version['number']:010d}.json"})):
            if system.exists(at(folder or VERSIONS)):
                for found in system.listStatus(at(folder or ".")):
                    if found.getPath().getName() not in keep:
                        system.delete(found.getPath(), True)


@dataclass
class Tables:
    coarse: Store
    fine: Store
    metadata: Store
    supervision: Store

    @classmethod
    def create(cls, spark: SparkSession, path: str | None, backend: str = "parquet") -> Tables:
        return cls(*[Store(spark, f"{path}/{name}", backend) for name in ("coarse", "fine", "metadata", "supervision")])


def without_labels(rows: DataFrame) -> DataFrame:
    """The rows, or an error if a label is among their columns."""
    leaked = sorted(set(rows.columns) & set(LABELS))
    if leaked:
        raise ValueError(f"labels in a retrieval table: {', '.join(leaked)}")
    return rows


def coarse_rows(documents: DataFrame) -> DataFrame:
    text = F.coalesce(tx.non_empty(F.col("retrieval_text")), F.concat_ws(" ", "summary_text", "metadata_text"))
    columns = ["quality_tier", "content_source", "created", "updated_at", "ingested_at", "business_unit", "chunk_count", "entity_product_count", "entity_capability_count", "has_primary_attachment", "has_description", "source_quality_score", "primary_evidence_type"]
    return without_labels(documents.select(F.col("ticket_key").alias("id"), F.col("summary_embedding").alias("vector"), text.alias("text"), *[c for c in columns if c in documents.columns]))


def fine_rows(chunks: DataFrame) -> DataFrame:
    """Chunks that have a vector, by their unique id."""
    number = F.coalesce(*[F.nullif(F.col(c), F.lit(0)) for c in ("slide_num", "page_num") if c in chunks.columns], F.lit(None).cast("int"))
    table = F.coalesce("has_table", F.lit(False)) if "has_table" in chunks.columns else F.lit(False)
    rows = chunks.filter(F.size(F.coalesce("embedding", F.array().cast("array<float>"))) > 0)
    return without_labels(rows.select(F.col("chunk_uid").alias("id"), F.col("embedding").alias("vector"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("weight_multiplier", F.lit(1.0)).alias("weight_multiplier"), F.coalesce("extraction_confidence", F.lit(1.0)).alias("extraction_confidence"), number.alias("slide_num"), table.alias("has_table"), F.col("ticket_key").alias("parent_ticket"), F.col("quality_tier").alias("parent_quality_tier")))


def metadata_rows(documents: DataFrame) -> DataFrame:
    columns = ["metadata_text", "components", "labels", "business_unit", "summary_text", "entity_terms", "issue_type", "status", "requesting_org", "delivery_org"]
    return without_labels(documents.select(F.col("ticket_key").alias("id"), *[c for c in columns if c in documents.columns]))


def supervision_rows(documents: DataFrame) -> DataFrame:
    """Labels only, with whether they can train a model: gold labels, and a tier above D (our rule)."""
    some = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>"))) > 0
    streams, products = some(F.col("linked_value_stream_ids")), some(F.col("impacted_products.names"))
    usable = F.col("quality_tier") != "D"
    trainability = F.struct(streams.alias("has_gold_vs_labels"), (streams & usable).alias("is_trainable_for_vs"), products.alias("has_gold_product_labels"), (products & usable).alias("is_trainable_for_products"), F.col("source_quality_score"))
    return documents.select(F.col("ticket_key").alias("id"), *[c for c in LABELS if c in documents.columns], trainability.alias("trainability"))
