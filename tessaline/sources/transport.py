"""Fetching: one transport interface, retry policies, conditional requests, and a data source that lands replies as rows.

Nothing here opens a connection by itself: a transport is a function (url, headers) -> Reply, and the default one, on the
standard library, is only used where asked for. Tests and offline runs pass their own.
"""

from __future__ import annotations

import gzip
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urljoin, urlsplit

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

REPLY = "url string, status int, body binary, etag string, attempts int, error string"


@dataclass(frozen=True)
class Reply:
    status: int
    body: bytes | None = None
    headers: dict[str, str] = field(default_factory=dict)

    def text(self) -> str | None:
        return None if self.body is None else self.body.decode("utf-8", "replace")


Transport = Callable[[str, dict[str, str]], Reply]


@dataclass(frozen=True)
class Policy:
    """When and how long to wait. waits: seconds before each further try; cap and budget bound what a server asks for."""

    waits: tuple[float, ...] = ()
    retry_on: frozenset[int] = frozenset({0, 429, 500, 502, 503, 504})
    budget: float = float("inf")
    cap: float = 30.0
    redirects: int = 0
    honour_retry_after: bool = False

    def wait(self, attempt: int, reply: Reply) -> float:
        asked = reply.headers.get("retry-after", "")
        if self.honour_retry_after and asked.replace(".", "", 1).isdigit():
            return min(float(asked), self.cap)
        return min(self.waits[attempt], self.cap)


#: The policies by name.
POLICIES = {
    "once": Policy(),
    "linear": Policy(waits=(1.5, 3.0)),
    "schedule": Policy(waits=(1, 3, 8, 20), redirects=4),
    "budget": Policy(waits=(1.5, 3.0, 6.0), retry_on=frozenset({0, 408, 425, 429, 500, 502, 503, 504}), budget=20.0, honour_retry_after=True),
}


def standard_transport(url: str, headers: dict[str, str], method: str = "GET") -> Reply:
    """Standard library, gzip, no redirects followed; status 0 for failures below HTTP."""

    class Stay(urllib.request.HTTPRedirectHandler):
        def redirect_request(self, *a, **k):
            return None

    request = urllib.request.Request(url, headers={"Accept-Encoding": "gzip", **headers}, method=method)
    try:
        with urllib.request.build_opener(Stay).open(request, timeout=60) as got:
            body = got.read()
            found = {k.lower(): v for k, v in got.headers.items()}
            return Reply(got.status, gzip.decompress(body) if body and found.get("content-encoding") == "gzip" else body, found)
    except urllib.error.HTTPError as e:
        return Reply(e.code, None, {k.lower(): v for k, v in e.headers.items()})
    except OSError:
        return Reply(0)


def head_transport(url: str, headers: dict[str, str]) -> Reply:
    """Validators without contents."""
    return standard_transport(url, headers, "HEAD")


def fetch(url: str, transport: Transport, policy: Policy = POLICIES["once"], etag: str | None = None, headers: dict[str, str] | None = None, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> tuple[Reply, int]:
    """(reply, tries). A redirect to another host counts as missing (404); 304 answers a conditional request."""
    asked = dict(headers or {}) | ({"If-None-Match": etag} if etag else {})
    began, attempt, hops, now = clock(), 0, 0, url
    while True:
        reply = transport(now, asked)
        if reply.status in (301, 302, 303, 307, 308) and "location" in reply.headers and policy.redirects:
            target = urljoin(now, reply.headers["location"])
            if urlsplit(target).netloc != urlsplit(now).netloc or hops >= policy.redirects:
                return Reply(404), attempt + 1
            now, hops = target, hops + 1
            continue
        if reply.status not in policy.retry_on or attempt >= len(policy.waits):
            return reply, attempt + 1
        wait = policy.wait(attempt, reply)
        if clock() - began + wait > policy.budget:
            return reply, attempt + 1
        sleep(wait)
        attempt += 1


def changed_by_head(url: str, known_etag: str | None, head: Transport, policy: Policy = POLICIES["once"]) -> bool:
    """Whether a HEAD request's ETag differs from the known one; without an answer, yes."""
    reply, _ = fetch(url, head, policy)
    return not known_etag or reply.headers.get("etag") != known_etag


class AccessDenied(RuntimeError):
    """What a source needs to be let in isn't there, or isn't valid any more."""


def verify_access(url: str, headers: dict[str, str], send: Transport, policy: Policy = POLICIES["once"], signed_in: Callable[[Reply], bool] = lambda r: True) -> None:
    """Ask for a page that only those who are let in can see, before anything is fetched: a refusal, a redirect (to a sign-in
    page) or a page that signed_in rejects ends the run with nothing changed."""
    if not headers:
        raise AccessDenied(f"{url}: a cookie is needed")
    reply, _ = fetch(url, send, policy, headers=headers)
    if reply.status != 200 or not signed_in(reply):
        raise AccessDenied(f"{url}: not let in (status {reply.status})")


def cookie_header(value: str | None = None, path: str | None = None) -> dict[str, str]:
    """A Cookie header from a value or a file's first line that is no comment."""
    if value is None and path:
        with open(path, encoding="utf-8") as lines:
            value = next((x.strip() for x in lines if x.strip() and not x.startswith("#")), None)
    return {"Cookie": value.removeprefix("Cookie:").strip()} if value else {}


def fetch_all(manifest: DataFrame, transport: Transport, policy: str = "once", url: str = "url", etag: str | None = None, partitions: int | None = None, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """manifest's urls fetched by tasks: (url, status, body, etag, attempts, error) for each row. Failures are rows, not exceptions."""
    import pandas as pd

    rows = manifest.select(url, *([etag] if etag else []))
    rows = rows.repartition(partitions, url) if partitions else rows

    def run(frames):
        for frame in frames:
            out = []
            for k in range(len(frame)):
                try:
                    reply, tries = fetch(frame[url].iloc[k], transport, POLICIES[policy], frame[etag].iloc[k] if etag else None, sleep=sleep)
                    out.append((frame[url].iloc[k], reply.status, reply.body, reply.headers.get("etag"), tries, None))
                except Exception as e:  # noqa: BLE001  a row must say what went wrong, whatever it was
                    out.append((frame[url].iloc[k], 0, None, None, 1, f"{type(e).__name__}: {e}"[:300]))
            yield pd.DataFrame(out, columns=["url", "status", "body", "etag", "attempts", "error"])

    return rows.mapInPandas(run, REPLY)


class _Slice(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class WebSource(DataSource):
    """`spark.read.format("web")` with options urls (one a line), policy, cookie and parts. Register with spark.dataSource.register(WebSource)."""

    @classmethod
    def name(cls) -> str:
        return "web"

    def schema(self) -> str:
        return REPLY

    def reader(self, schema) -> DataSourceReader:
        return _WebReader(self.options)


class _WebReader(DataSourceReader):
    transport: Transport = staticmethod(standard_transport)

    def __init__(self, options):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.policy, self.headers, self.parts = options.get("policy", "schedule"), cookie_header(options.get("cookie")), int(options.get("parts", "8"))

    def partitions(self):
        return [_Slice(self.urls[k :: self.parts]) for k in range(min(self.parts, len(self.urls)))]

    def read(self, partition) -> Iterator[tuple]:
        for url in partition.urls:
            reply, tries = fetch(url, self.transport, POLICIES[self.policy], headers=self.headers)
            yield url, reply.status, reply.body, reply.headers.get("etag"), tries, None


def landed(spark, path: str) -> DataFrame:
    """Bytes that have landed as files: (path, modificationTime, length, content)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
