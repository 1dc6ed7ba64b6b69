"""Counts out of running plans, bounded calls, malformed lines."""

import time

import pytest
from pyspark.sql import functions as F

from tessera.operators import faults
from tessera.plans import batch
from tessera.sources import files, tracker


def test_malformed_lines(spark, tmp_path):
    """Files read in blocks far smaller than they are: each bad line comes with its number, and goes to the dead letters."""
    (tmp_path / "in").mkdir()
    want = set()
    for f in range(3):
        lines = []
        for i in range(1, 400):
            kind = (i * 7 + f) % 11
            lines.append("" if kind == 0 else "  " if kind == 1 else f'{{"key": "é{i}", "n": {i}' if kind == 2 else "[1]" if kind == 3 else f'{{"key": "k{f}-{i}", "n": {i}}}')
            if kind in (2, 3):
                want.add((f"f{f}.jsonl", i, lines[-1]))
        (tmp_path / "in" / f"f{f}.jsonl").write_text("\n".join(lines) + "\n" * (f % 2))
    (tmp_path / "in" / "empty.jsonl").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        good, bad = files.parted_lines(spark, str(tmp_path / "in"), "key string, n int")
        assert good.rdd.getNumPartitions() > 10
        assert {(r["file"].rsplit("/", 1)[1], r["line"], r["text"]) for r in bad.collect()} == want and bad.count() == len(want)
        assert good.count() == 3 * 399 - len(want) - sum((i * 7 + f) % 11 < 2 for f in range(3) for i in range(1, 400)) and good.columns == ["key", "n"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    files.quarantine(bad, str(tmp_path / "dead"))
    dead = files.read_dead_letters(spark, str(tmp_path / "dead"))
    assert dead.count() == len(want) and {(int(r["extra"]["line"]), r["extra"]["text"]) for r in dead.collect()} == {w[1:] for w in want}
    assert dead.groupBy("error_type").count().collect()[0][0] == "MalformedLine"


def test_token_bucket():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    bucket = faults.TokenBucket(4, 2, lambda: now[0], sleep)
    for _ in range(10):
        bucket.take()
    assert now[0] == pytest.approx(8 / 4) and len(slept) == 8
    now[0] += 100
    bucket.take()
    bucket.take()
    assert len(slept) == 8
    with pytest.raises(ValueError, match="rate"):
        faults.TokenBucket(0)


def test_calls_are_bounded(spark, tmp_path):
    """A client that notes when each call begins and ends: never more at once, nor more a second, than asked for."""
    where = str(tmp_path)

    class Counting(tracker.TrackerClient):
        def authenticate(self):
            pass

        def get(self, key, fields):
            return {}

        def close(self):
            pass

        def download(self, url):
            began = time.time()
            time.sleep(0.05)
            with open(f"{where}/{url}", "w") as f:
                f.write(f"{began} {time.time()}")
            return b"x"

    def spans():
        return [tuple(map(float, (tmp_path / f"u{i}").read_text().split())) for i in range(24)]

    rows = spark.range(24).repartition(8).select(F.concat(F.lit("u"), "id").alias("content"))
    assert batch.fetched(rows, Counting, calls=2).filter("fetch_error IS NULL").count() == 24
    at_once = max(sum(a <= x < b for a, b in spans()) for x, _ in spans())
    assert at_once <= 2
    began = time.time()
    assert batch.fetched(rows, Counting, calls=2, rate=20).count() == 24
    # a call for each of the two tasks is free; the others come at 20 a second
    assert max(b for _, b in spans()) - min(a for a, _ in spans()) >= (24 / 2 - 1) / 10 - 0.1 and time.time() > began
    with pytest.raises(ValueError, match="rate"):
        batch.fetched(rows, Counting, rate=1)


def test_counts_of_running_plans(spark, tmp_path):
    rows, seen = faults.count_of(spark.range(1000), "ids", even=F.count_if(F.col("id") % 2 == 0), last=F.max("id"))
    rows.filter("id < 10").write.parquet(f"{tmp_path}/a")
    assert seen.get == {"rows": 1000, "even": 500, "last": 999}

    told: list[faults.Event] = []
    listener = faults.StreamEvents(told.append)
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/a").observe("found", F.count(F.lit(1)).alias("n"))
        query = stream.writeStream.queryName("copy").format("parquet").option("path", f"{tmp_path}/b").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        assert query.awaitTermination(60)
        deadline = time.time() + 20
        while time.time() < deadline and not any(e.event_type == "stage_end" for e in told):
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    (progress,) = [e for e in told if e.event_type == "ingest" and e.extra["rows"] != "0"]
    assert progress.ticket_key == "copy" and progress.extra["found.n"] == "10" and progress.ingest_ms > 0
    assert [e.event_type for e in told][:1] == ["stage_start"] and faults.events_frame(spark, told).count() == len(told)
