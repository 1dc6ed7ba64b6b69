"""A Python data source for issue trackers with a REST interface: one partition for each batch of keys.

    spark.dataSource.register(TrackerDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    spark.read.format("tracker").option("url", ...).option("keys", "A-1,A-2").load()

    spark.readStream.format("tracker").option("url", ...).load()

Options: url, token, keys (comma-separated), fields (comma-separated; asked of the server, so that nothing else travels),
batch (keys a partition, 50), timeout (seconds, 60), verify (true). Filters on the key are pushed down. A record that
can't be fetched gives a row with its error, and doesn't fail the scan.

As a stream, offsets are (updated, key) pairs. A micro-batch covers what changed after the last offset up to the newest change
that the tracker knows; it is cut into ``splits`` (16) slices of time, and each task lists and fetches its own slice, so that no
key passes through the driver. A slice that is read again gives the same records, but for those that have changed meanwhile:
they come, in their new version, with a later offset. ``since`` leaves out what is older. Versions are UTC, in ISO form.
"""

from __future__ import annotations

import json
import ssl
import urllib.error
import urllib.request
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from urllib.parse import quote, urlencode

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

from tessera.operators.faults import AuthError, DownloadError, FetchError, NotFoundError, RetryPolicy
from tessera.settings import BASE_FIELDS, requested_fields

SCHEMA = "key string, fields string, attachments array<struct<id:string,filename:string,content:string,mimeType:string,size:bigint,created:string>>, error string"


PAGE = 100


class TrackerClient(ABC):
    """What a source of records has to offer."""

    @abstractmethod
    def authenticate(self) -> None: ...

    @abstractmethod
    def get(self, key: str, fields: list[str]) -> dict: ...

    @abstractmethod
    def download(self, url: str) -> bytes: ...

    @abstractmethod
    def close(self) -> None: ...

    def edge(self, newest: bool) -> tuple[str, str] | None:
        """The (version, key) of the newest or the oldest change, if there is any. Streams need it."""
        raise NotImplementedError

    def changed(self, after: tuple[str, str], upto: tuple[str, str]) -> Iterator[tuple[str, str]]:
        """(version, key) of each record with after < (version, key) <= upto. Streams need it."""
        raise NotImplementedError


def version(updated: str) -> str:
    """A tracker's timestamp as UTC, so that versions sort as texts."""
    at = datetime.fromisoformat(updated)
    return (at if at.tzinfo else at.replace(tzinfo=UTC)).astimezone(UTC).isoformat(timespec="microseconds")


class RestClient(TrackerClient):
    """Bearer token, JSON, 60 s for a call and 120 s for a download. ``open_url`` stands in for the network in tests."""

    def __init__(self, url: str, token: str, timeout: float = 60, verify: bool = True, open_url: Callable | None = None, policy: RetryPolicy | None = None):
        self.url, self.token, self.timeout = url.rstrip("/"), token, timeout
        context = None if verify else ssl._create_unverified_context()
        self.open_url = open_url or (lambda request, timeout: urllib.request.urlopen(request, timeout=timeout, context=context))
        self.policy = policy or RetryPolicy()
        self.authenticated = False

    def _call(self, url: str, timeout: float) -> bytes:
        request = urllib.request.Request(url, headers={"Authorization": f"Bearer {self.token}", "Accept": "application/json"})
        with self.open_url(request, timeout) as answer:
            return answer.read()

    def authenticate(self) -> None:
        try:
            self.policy.call(self._call, f"{self.url}/rest/api/2/myself", self.timeout)
        except urllib.error.HTTPError as error:
            raise AuthError("the tracker rejects the token", error) from error
        self.authenticated = True

    def get(self, key: str, fields: list[str]) -> dict:
        url = f"{self.url}/rest/api/2/issue/{quote(key)}?{urlencode({'fields': ','.join(fields)})}"
        try:
            got = json.loads(self.policy.call(self._call, url, self.timeout))
        except urllib.error.HTTPError as error:
            raise (NotFoundError if error.code == 404 else FetchError)(key, error) from error
        except OSError as error:
            raise FetchError(key, error) from error
        own = got.get("fields") or {}
        return {"key": got.get("key", key), "fields": own, "attachments": own.get("attachment") or []}

    def _search(self, query: str, start: int, size: int) -> list[tuple[str, str]]:
        url = f"{self.url}/rest/api/2/search?{urlencode({'jql': query, 'fields': 'updated', 'startAt': start, 'maxResults': size})}"
        issues = json.loads(self.policy.call(self._call, url, self.timeout)).get("issues") or []
        return [(version(i["fields"]["updated"]), i["key"]) for i in issues]

    def _between(self, first: str, last: str) -> Iterator[tuple[str, str]]:
        """Pairs of a range of versions and a little more, page by page; an empty first version is no bound."""
        millis = lambda at: int(datetime.fromisoformat(at).timestamp() * 1000)
        bounds = [f"updated >= {millis(first)}"] if first else []
        query, start = " AND ".join([*bounds, f"updated <= {millis(last) + 1}"]) + " ORDER BY updated ASC, key ASC", 0
        while found := self._search(query, start, PAGE):
            yield from found
            start += len(found)

    def edge(self, newest: bool) -> tuple[str, str] | None:
        found = self._search(f"ORDER BY updated {'DESC' if newest else 'ASC'}", 0, 1)
        if not found:
            return None
        # trackers order the keys of an instant by their numbers, offsets by their texts
        same = [p for p in self._between(found[0][0], found[0][0]) if p[0] == found[0][0]] or found
        return max(same) if newest else min(same)

    def changed(self, after: tuple[str, str], upto: tuple[str, str]) -> Iterator[tuple[str, str]]:
        return (pair for pair in self._between(after[0], upto[0]) if after < pair <= upto)

    def download(self, url: str) -> bytes:
        if not url:
            raise ValueError("the attachment has no content URL")
        if not self.authenticated:
            raise RuntimeError("authenticate first")
        try:
            return self.policy.call(self._call, url, 120)
        except OSError as error:
            raise DownloadError(url, error) from error

    def close(self) -> None:
        self.authenticated = False

    def __enter__(self) -> RestClient:
        self.authenticate()
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


class TrackerReader(DataSourceReader):
    def __init__(self, options: dict[str, str], client: Callable[[dict[str, str]], TrackerClient] | None = None):
        self.options = dict(options)
        self.keys = list(dict.fromkeys(k.strip() for k in self.options.get("keys", "").split(",") if k.strip()))
        self.client = client

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            wanted = {f.value} if isinstance(f, EqualTo) and f.attribute == ("key",) else set(f.value) if isinstance(f, In) and f.attribute == ("key",) else None
            if wanted is None:
                yield f
            else:
                self.keys = [k for k in self.keys if k in wanted]

    def partitions(self) -> list[InputPartition]:
        size = int(self.options.get("batch", 50))
        return [InputPartition(self.keys[i : i + size]) for i in range(0, len(self.keys), size)] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value:
            with _client(self.options, self.client) as client:
                yield from _rows(client, partition.value, self.options)


@contextmanager
def _client(options: dict[str, str], factory: Callable[[dict[str, str]], TrackerClient] | None) -> Iterator[TrackerClient]:
    o = options
    client = factory(o) if factory else RestClient(o["url"], o.get("token", ""), float(o.get("timeout", 60)), o.get("verify", "true") != "false")
    client.authenticate()
    try:
        yield client
    finally:
        client.close()


def _rows(client: TrackerClient, keys: Iterable[str], options: dict[str, str]) -> Iterator[tuple]:
    fields = options["fields"].split(",") if options.get("fields") else requested_fields({})
    for key in keys:
        try:
            got = client.get(key, fields)
            files = [tuple(a.get(n) for n in ("id", "filename", "content", "mimeType", "size", "created")) for a in got["attachments"]]
            yield got["key"], json.dumps(got["fields"], ensure_ascii=False), files, None
        except FetchError as error:
            yield key, None, [], f"{type(error).__name__}: {error}"


@dataclass
class Slice(InputPartition):
    """Changes after one (version, key) pair up to another."""

    after: tuple[str, str]
    upto: tuple[str, str]


class TrackerStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], client: Callable[[dict[str, str]], TrackerClient] | None = None):
        self.options, self.client = dict(options), client

    def initialOffset(self) -> dict[str, str]:
        since = self.options.get("since")
        return {"updated": version(since) if since else "", "key": ""}

    def latestOffset(self) -> dict[str, str]:
        with _client(self.options, self.client) as client:
            newest = client.edge(newest=True)
        first = self.initialOffset()
        return first if newest is None else dict(zip(("updated", "key"), max(newest, (first["updated"], first["key"])), strict=True))

    def partitions(self, start: dict[str, str], end: dict[str, str]) -> list[InputPartition]:
        after, upto = (start["updated"], start["key"]), (end["updated"], end["key"])
        if after >= upto:
            return []
        low = after[0]
        if not low:
            with _client(self.options, self.client) as client:
                oldest = client.edge(newest=False)
            low = min(oldest[0], upto[0]) if oldest else upto[0]
        begin, n = datetime.fromisoformat(low), int(self.options.get("splits", 16))
        step = (datetime.fromisoformat(upto[0]) - begin) / n
        inner = [((begin + i * step).isoformat(timespec="microseconds"), "") for i in range(1, n)] if step > timedelta(0) else []
        bounds = [after, *[b for b in inner if after < b < upto], upto]
        return [Slice(a, b) for a, b in zip(bounds, bounds[1:], strict=False)]

    def read(self, partition: Slice) -> Iterator[tuple]:
        with _client(self.options, self.client) as client:
            yield from _rows(client, (key for _, key in client.changed(partition.after, partition.upto)), self.options)


class TrackerDataSource(DataSource):
    """Subclass it and override ``client`` to read another tracker."""

    client: Callable[[dict[str, str]], TrackerClient] | None = None

    @classmethod
    def name(cls) -> str:
        return "tracker"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> TrackerReader:
        return TrackerReader(self.options, type(self).client)

    def streamReader(self, schema: object) -> TrackerStreamReader:
        return TrackerStreamReader(self.options, type(self).client)


__all__ = ["BASE_FIELDS", "RestClient", "TrackerClient", "TrackerDataSource", "TrackerReader", "TrackerStreamReader"]
