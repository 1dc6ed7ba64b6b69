"""Streams that go on after a restart: the tracker by offsets, versions by state."""

import json
import random
import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tessera.operators import records
from tessera.sources import tracker
from tessera.streaming import incremental


def until_done(query):
    assert query.awaitTermination(120)
    if query.exception() is not None:
        raise query.exception()


def appended(frame, path, name):
    """What a query of one round adds to a table."""
    query = frame.writeStream.format("parquet").option("path", f"{path}/{name}").option("checkpointLocation", f"{path}/{name}.checkpoint").trigger(availableNow=True).start()
    until_done(query)


def test_only_newer_versions_pass(spark, tmp_path):
    """Late, repeated and unreadable versions in five batches, the query started anew for each, against a log kept by hand."""
    rng, seen, want, all_rows = random.Random(4), {}, [], "key string, updated timestamp, note string, files array<struct<id:string>>"
    (tmp_path / "in").mkdir()
    stream = incremental.unseen(spark.readStream.schema(all_rows).parquet(f"{tmp_path}/in"))
    for batch in range(5):
        rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(12)]), f"{batch}-{i}") for i in range(6)]
        for key in {r[0] for r in rows}:
            want += [(key, None, n) for k, at, n in rows if k == key and at is None]
            known = [(at, n) for k, at, n in rows if k == key and at is not None]
            if known and max(known)[0] > seen.get(key, -1):
                seen[key] = max(known)[0]
                want.append((key, seen[key], next(n for at, n in known if at == seen[key])))
        frame = spark.createDataFrame([(k, None if t is None else f"2024-01-{t + 1:02d}", n) for k, t, n in rows], "key string, at string, note string")
        frame = frame.select("key", F.to_timestamp("at").alias("updated"), "note", F.array(F.struct(F.col("note").alias("id"))).alias("files"))
        frame.coalesce(1).sortWithinPartitions("note").write.mode("append").parquet(f"{tmp_path}/in")
        appended(stream, tmp_path, "out")
    got = [(r["key"], None if r["updated"] is None else r["updated"].day - 1, r["note"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert all(r["files"][0]["id"] == r["note"] for r in spark.read.parquet(f"{tmp_path}/out").collect())


def test_idle_keys_are_forgotten(spark, tmp_path):
    kind = "key string, updated timestamp"
    (tmp_path / "in").mkdir()
    stream = incremental.unseen(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), timedelta(milliseconds=1), "0 seconds")
    rows = spark.createDataFrame([("a", 1)], "key string, n int").select("key", F.timestamp_seconds("n").alias("updated"))
    for key in ("a", "b", "a"):
        rows.withColumn("key", F.lit(key)).write.mode("append").parquet(f"{tmp_path}/in")
        appended(stream, tmp_path, "out")
    # "a" came again, in the same version, after its timer: it counts as new
    assert sorted(r["key"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "a", "b"]


def test_tracker_stream(spark, tmp_path):
    """Two rounds with a restart between them give what the batch plan gives at the end; nothing is fetched twice."""
    state, calls = str(tmp_path / "tracker.json"), str(tmp_path / "calls")

    # classes of the test itself travel to the workers, which can't import this file
    class Recorded(tracker.TrackerClient):
        def __init__(self, options):
            with open(options["state"]) as f:
                self.records = json.load(f)
            self.calls = options.get("calls")

        def authenticate(self):
            pass

        def close(self):
            pass

        def download(self, url):
            return b""

        def get(self, key, fields):
            if self.calls:
                with open(self.calls, "a") as f:
                    f.write(f"{key}\n")
            if key == "BAD":
                raise tracker.FetchError(key)
            return {"key": key, "fields": {"updated": self.records[key], "summary": f"{key} of {self.records[key]}"}, "attachments": []}

        def pairs(self):
            return sorted((tracker.version(v), k) for k, v in self.records.items())

        def edge(self, newest):
            pairs = self.pairs()
            return (pairs[-1] if newest else pairs[0]) if pairs else None

        def changed(self, after, upto):
            return (p for p in self.pairs() if after < p <= upto)

    class Source(tracker.TrackerDataSource):
        client = Recorded

        @classmethod
        def name(cls):
            return "recorded"

    spark.dataSource.register(Source)
    now = {f"K-{i}": f"2024-01-{1 + i % 9:02d}T{i % 24:02d}:00:00.000+0100" for i in range(40)} | {"BAD": "2024-01-02T00:00:00Z", "SAME-1": "2024-01-09T00:00:00Z", "SAME-2": "2024-01-09T00:00:00Z"}

    def save():
        (tmp_path / "tracker.json").write_text(json.dumps(now))

    def round_of():
        stream = spark.readStream.format("recorded").option("state", state).option("calls", calls).load()
        appended(incremental.unseen(incremental.versions(stream)), tmp_path, "out")

    (tmp_path / "tracker.json").write_text("{}")
    round_of()
    save()
    round_of()
    assert sorted((tmp_path / "calls").read_text().split()) == sorted(now)
    # nothing new, then: a record changed, one that is new but of the last instant, one late
    round_of()
    now |= {"K-3": "2024-02-01T00:00:00Z", "SAME-3": "2024-01-09T23:00:00.000+0100", "NEW": "2024-02-02T00:00:00Z"}
    now["SAME-3"] = "2024-01-09T22:30:00+00:00"
    save()
    round_of()
    later = (tmp_path / "calls").read_text().split()[len(now) - 2 :]
    assert sorted(later) == ["K-3", "NEW", "SAME-3"]
    out = spark.read.parquet(f"{tmp_path}/out")
    have = records.latest(out.filter("error IS NULL"), ["key"], ["updated"]).select("key", "fields")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    batch = spark.read.format("recorded").option("state", state).option("keys", ",".join(now)).load().filter("error IS NULL").select("key", "fields")
    assert sorted(map(tuple, have.collect())) == sorted(map(tuple, batch.collect()))
    assert out.filter("error IS NOT NULL").count() == 1


def test_slices_cover_a_range():
    reader = tracker.TrackerStreamReader({"splits": "5", "since": "2024-01-01T00:00:00+0200"})
    first = reader.initialOffset()
    assert first == {"updated": "2023-12-31T22:00:00.000000+00:00", "key": ""}
    slices = reader.partitions(first, {"updated": "2024-01-05T00:00:00.000000+00:00", "key": "K"})
    assert len(slices) == 5 and slices[0].after == tuple(first.values()) and slices[-1].upto == ("2024-01-05T00:00:00.000000+00:00", "K")
    assert all(a.upto == b.after for a, b in zip(slices, slices[1:], strict=False))
    assert reader.partitions(first, first) == []
    instant = {"updated": first["updated"], "key": "B"}
    assert len(reader.partitions(first, instant)) == 1


def test_rest_client_lists_changes():
    import io
    from urllib.parse import parse_qs, urlparse

    issues = [{"key": f"K-{i}", "fields": {"updated": f"2024-01-01T00:00:{i:02d}.000+0000"}} for i in range(30)]
    issues.append({"key": "K-100", "fields": issues[-1]["fields"]})
    asked = []

    def open_url(request, timeout):
        q = {k: v[0] for k, v in parse_qs(urlparse(request.full_url).query).items()}
        asked.append(q["jql"])
        lo, hi = (int((re.findall(rf"updated {op} (\d+)", q["jql"]) or [default])[0]) for op, default in ((">=", 0), ("<=", 1 << 60)))
        found = [i for i in (issues[::-1] if "DESC" in q["jql"] else issues) if lo <= datetime.fromisoformat(i["fields"]["updated"]).timestamp() * 1000 <= hi]
        return io.BytesIO(json.dumps({"issues": found[int(q["startAt"]) :][: min(7, int(q["maxResults"]))]}).encode())

    client = tracker.RestClient("http://x", "t", open_url=open_url)
    at = "2024-01-01T00:00:{:02d}.000000+00:00".format
    assert client.edge(True) == (at(29), "K-29") and client.edge(False) == (at(0), "K-0")
    assert [k for _, k in client.changed((at(3), "K-3"), (at(20), "K-20"))] == [f"K-{i}" for i in range(4, 21)]
    assert len(list(client.changed(("", ""), (at(29), "K-29")))) == 31 and "updated >=" not in asked[-1]
