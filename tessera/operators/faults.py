"""Errors, retries and telemetry: what surrounds calls to the outside, inside partition functions or on the driver."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from typing import Any, TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

R = TypeVar("R")
#: HTTP answers that may be tried again.
RETRYABLE_STATUS = (429, 500, 502, 503, 504)


class EngineError(Exception):
    """An error with a cause, which its text tells."""

    def __init__(self, message: str, cause: BaseException | None = None):
        super().__init__(message if cause is None else f"{message} (caused by {type(cause).__name__}: {cause})")
        self.cause = cause


class FetchError(EngineError):
    def __init__(self, key: str, cause: BaseException | None = None):
        super().__init__(f"failed to fetch record {key}", cause)
        self.key = key


class NotFoundError(FetchError):
    pass


class AuthError(EngineError):
    pass


class DownloadError(EngineError):
    def __init__(self, filename: str, cause: BaseException | None = None):
        super().__init__(f"failed to download {filename}", cause)
        self.filename = filename


class IndexingError(EngineError):
    def __init__(self, key: str, index: str, cause: BaseException | None = None):
        super().__init__(f"failed to index {key} in {index}", cause)
        self.key, self.index = key, index


class SchemaError(EngineError):
    pass


PERMANENT = (AuthError, NotFoundError, SchemaError)
TRANSIENT = (FetchError, DownloadError, IndexingError)


def is_permanent(error: BaseException) -> bool:
    return isinstance(error, PERMANENT)


def is_transient(error: BaseException) -> bool:
    """May be tried again. A missing record is a fetch error too, but a permanent one, and that decides."""
    return isinstance(error, TRANSIENT) and not is_permanent(error)


def is_http_transient(error: BaseException) -> bool:
    status = getattr(getattr(error, "response", None), "status_code", getattr(error, "code", None))
    return status in RETRYABLE_STATUS or isinstance(error, (TimeoutError, ConnectionError))


def error_class(error_type: Column) -> Column:
    """transient, permanent or unknown, by the name of an error."""
    names = lambda kinds: [k.__name__ for k in kinds]
    return F.when(error_type.isin(*names(PERMANENT)), "permanent").when(error_type.isin(*names(TRANSIENT)), "transient").otherwise("unknown")


@dataclass(frozen=True)
class RetryPolicy:
    max_attempts: int = 3
    backoff_base: float = 1.5
    backoff_max: float = 30.0
    jitter: bool = True
    retryable: tuple[type[BaseException], ...] | None = None
    non_retryable: tuple[type[BaseException], ...] = ()

    def delay(self, attempt: int) -> float:
        wait = min(self.backoff_base**attempt, self.backoff_max)
        return wait * random.uniform(0.5, 1.0) if self.jitter else wait

    def should_retry(self, error: BaseException) -> bool:
        if isinstance(error, self.non_retryable):
            return False
        return isinstance(error, self.retryable) if self.retryable is not None else is_transient(error) or is_http_transient(error)

    def call(self, function: Callable[..., R], *args: Any, sleep: Callable[[float], None] = time.sleep, **kwargs: Any) -> R:
        attempt = 0
        while True:
            try:
                return function(*args, **kwargs)
            except Exception as error:
                attempt += 1
                if attempt >= self.max_attempts or not self.should_retry(error):
                    raise
                sleep(self.delay(attempt - 1))

    async def call_async(self, function: Callable[..., Any], *args: Any, **kwargs: Any) -> Any:
        import asyncio

        attempt = 0
        while True:
            try:
                return await function(*args, **kwargs)
            except Exception as error:
                attempt += 1
                if attempt >= self.max_attempts or not self.should_retry(error):
                    raise
                await asyncio.sleep(self.delay(attempt - 1))


class TokenBucket:
    """At most ``rate`` calls a second in the long run, ``burst`` at once; one for each task."""

    def __init__(self, rate: float, burst: float = 1.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        if rate <= 0 or burst < 1:
            raise ValueError("a rate above 0 and a burst of at least 1")
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = burst, clock()

    def take(self) -> None:
        now = self.clock()
        self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
        self.tokens -= 1
        if self.tokens < 0:  # what is owed is paid by waiting
            self.sleep(-self.tokens / self.rate)


@dataclass
class Event:
    """A telemetry event: ingest, skip, failure, stage_start or stage_end."""

    event_type: str
    ticket_key: str
    timestamp: str = field(default_factory=lambda: datetime.now(UTC).isoformat())
    trigger: str = "unknown"
    tier: str | None = None
    chunk_count: int = 0
    section_count: int = 0
    ingest_ms: float | None = None
    attachment_ms: float | None = None
    extraction_ms: float | None = None
    embedding_ms: float | None = None
    indexing_ms: float | None = None
    stage: str | None = None
    error_type: str | None = None
    error_message: str | None = None
    extra: dict[str, str] = field(default_factory=dict)


EVENT_SCHEMA = (
    "event_type string, ticket_key string, timestamp string, trigger string, tier string, chunk_count int, section_count int, ingest_ms double, attachment_ms double, "
    "extraction_ms double, embedding_ms double, indexing_ms double, stage string, error_type string, error_message string, extra map<string,string>"
)


def events_frame(spark: SparkSession, events: list[Event]) -> DataFrame:
    return spark.createDataFrame([asdict(e) for e in events], EVENT_SCHEMA)


def count_of(rows: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """The rows, and counts that Spark fills in as they run for whatever they are meant for: no pass of their own."""
    observed = Observation(name)
    return rows.observe(observed, *[c.alias(n) for n, c in {"rows": F.count(F.lit(1)), **counts}.items()]), observed


class StreamEvents(StreamingQueryListener):
    """Tells each micro-batch of a running stream: rows, milliseconds by phase, and what it observes.

    ``spark.streams.addListener(StreamEvents(sink))``; the event's key is the name of the query.
    """

    def __init__(self, sink: Callable[[Event], None]):
        self.sink = sink

    def onQueryStarted(self, event: Any) -> None:
        self.sink(Event("stage_start", event.name or str(event.id), stage="stream"))

    def onQueryProgress(self, event: Any) -> None:
        p = event.progress
        seen = {f"{name}.{k}": str(v) for name, row in p.observedMetrics.items() for k, v in row.asDict().items()}
        spent = {f"ms.{k}": str(v) for k, v in p.durationMs.items()}
        took = p.durationMs.get("triggerExecution")
        self.sink(Event("ingest", p.name or str(p.id), stage="stream", ingest_ms=None if took is None else float(took), extra={"batch": str(p.batchId), "rows": str(p.numInputRows), **seen, **spent}))

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        self.sink(Event("failure" if event.exception else "stage_end", str(event.id), stage="stream", error_message=event.exception))


@contextmanager
def stage_timer(sink: Callable[[Event], None], ticket_key: str, stage: str) -> Iterator[dict[str, float]]:
    """Times a stage in milliseconds; a failure is told and passed on."""
    out: dict[str, float] = {}
    began = time.perf_counter()
    try:
        yield out
    except Exception as error:
        sink(Event("failure", ticket_key, stage=stage, error_type=type(error).__name__, error_message=str(error)))
        raise
    finally:
        out["ms"] = (time.perf_counter() - began) * 1000
        sink(Event("stage_end", ticket_key, stage=stage, extra={"ms": f"{out['ms']:.3f}"}))
