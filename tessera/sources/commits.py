"""Batches over several sinks: every output is staged first, one rename commits all of them, and a crash is mended from the log.

A batch has a folder of its own under ``_batches``. Its outputs are written there as Parquet, counted and timed as they are written.
Renaming ``manifest.tmp`` to ``manifest.json`` commits the batch: before, it never happened; from then on each output will
reach its sink. Sinks are then brought up to date one after the other from the staged tables, by functions that may run again
(upserts, replaced documents, replaced folders), and a second rename marks the batch as applied. :meth:`BatchLog.recover`
drops what was staged without a manifest and applies again what was committed but not marked. One writer at a time.

Renaming one file has to be atomic, as it is on HDFS and local disks.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.operators.faults import Event, count_of

FOLDER, MANIFEST, APPLIED = "_batches", "manifest.json", "applied.json"
Sink = Callable[[DataFrame], None]


class Batch:
    """A batch that is being staged: ``keep`` stores a table in its folder and gives the stored one back."""

    def __init__(self, log: BatchLog, number: int):
        self.log, self.number, self.path = log, number, log.folder(number)
        self.outputs: dict[str, dict[str, Any]] = {}
        self.events: list[Event] = []

    def _write(self, name: str, rows: DataFrame, path: str, counts: dict[str, Column]) -> dict[str, Any]:
        counted, seen = count_of(rows, f"{name}-{self.number}", **counts)
        began = time.perf_counter()
        counted.write.mode("overwrite").parquet(path)
        found = seen.get
        ms = (time.perf_counter() - began) * 1000
        self.events.append(Event("stage_end", f"batch {self.number}", trigger="batch", stage=name, ingest_ms=ms, extra={k: str(v) for k, v in found.items()}))
        return found

    def keep(self, name: str, rows: DataFrame, **counts: Column) -> DataFrame:
        """Working tables: later steps read them, and they go with the batch's folder."""
        self._write(name, rows, f"{self.path}/_work/{name}", counts)
        return self.log.spark.read.schema(rows.schema).parquet(f"{self.path}/_work/{name}")

    def stage(self, name: str, rows: DataFrame, **counts: Column) -> DataFrame:
        """An output, with its rows (and other ``counts``) taken as it is written."""
        self.outputs[name] = {**self._write(name, rows, f"{self.path}/{name}", counts), "schema": rows.schema.json()}
        return self.log.table(self.number, name, rows.schema)

    def commit(self) -> None:
        self.log.rename(self.number, MANIFEST, {"batch": self.number, "outputs": self.outputs})


class BatchLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root}/{FOLDER}"
        jvm, context = spark.sparkContext._jvm, spark.sparkContext
        self._at = jvm.org.apache.hadoop.fs.Path
        self._system = self._at(self.root).getFileSystem(context._jsc.hadoopConfiguration())

    def folder(self, number: int) -> str:
        return f"{self.root}/{number:010d}"

    def table(self, number: int, name: str, schema: Any) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.folder(number)}/{name}")

    def numbers(self) -> list[int]:
        """The batches that have a folder; a table has a few until :meth:`forget`."""
        if not self._system.exists(self._at(self.root)):
            return []
        return sorted(int(f.getPath().getName()) for f in self._system.listStatus(self._at(self.root)))

    def _has(self, number: int, name: str) -> bool:
        return self._system.exists(self._at(f"{self.folder(number)}/{name}"))

    def rename(self, number: int, name: str, content: dict[str, Any]) -> None:
        """Makes a file of the batch appear whole or not at all."""
        draft = self._at(f"{self.folder(number)}/{name}.tmp")
        out = self._system.create(draft, True)
        out.write(json.dumps(content).encode())
        out.close()
        if not self._system.rename(draft, self._at(f"{self.folder(number)}/{name}")):
            raise OSError(f"can't commit {name} of batch {number}")

    def manifest(self, number: int) -> dict[str, Any] | None:
        if not self._has(number, MANIFEST):
            return None
        (row,) = self.spark.read.option("wholetext", True).text(f"{self.folder(number)}/{MANIFEST}").collect()
        return json.loads(row[0])

    def state(self, number: int) -> str:
        return "applied" if self._has(number, APPLIED) else "committed" if self._has(number, MANIFEST) else "staged"

    def begin(self) -> Batch:
        """A new batch; one that was left behind has to be recovered before."""
        numbers = self.numbers()
        if any(self.state(n) != "applied" for n in numbers):
            raise RuntimeError("an earlier batch isn't applied: recover first")
        return Batch(self, max(numbers, default=0) + 1)

    def apply(self, number: int, sinks: dict[str, Sink]) -> None:
        """Brings each output of a committed batch to its sink. An output without a sink is an error before anything is written."""
        manifest = self.manifest(number)
        if manifest is None:
            raise RuntimeError(f"batch {number} isn't committed")
        missing = sorted(set(manifest["outputs"]) - set(sinks))
        if missing:
            raise ValueError(f"no sink for {', '.join(missing)}")
        for name, output in manifest["outputs"].items():
            sinks[name](self.table(number, name, T.StructType.fromJson(json.loads(output["schema"]))))
        self.rename(number, APPLIED, {"batch": number})
        self._system.delete(self._at(f"{self.folder(number)}/_work"), True)

    def recover(self, sinks: Callable[[int], dict[str, Sink]]) -> dict[int, str]:
        """Mends what a crash left: batches dropped or applied, in their order. ``sinks`` gives those of a batch."""
        done = {}
        for number in self.numbers():
            state = self.state(number)
            if state == "staged":
                self._system.delete(self._at(self.folder(number)), True)
                done[number] = "dropped"
            elif state == "committed":
                self.apply(number, sinks(number))
                done[number] = "applied"
        return done

    def forget(self, keep: int = 1) -> None:
        """Drops the folders of applied batches but for the last ones."""
        for number in self.numbers()[: -max(keep, 1)]:  # the last one carries the numbering on
            if self.state(number) == "applied":
                self._system.delete(self._at(self.folder(number)), True)

    def rows(self) -> DataFrame:
        """(batch, state, sink, rows) of each output of each committed batch."""
        found = [(n, self.state(n), name, o["rows"]) for n in self.numbers() if (m := self.manifest(n)) for name, o in m["outputs"].items()]
        return self.spark.createDataFrame(found, "batch long, state string, sink string, rows long")
