"""Fetching from bibliographic and patent services, in bounded parallel, into a table
(survey SRC-10..19, SRC-22/23). Nothing else of the engine needs a network."""

from __future__ import annotations

import gzip
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame


class ServiceError(Exception):
    """[SUP-07] A refusal that is not worth a retry."""

    def __init__(self, message: str, status: int | None = None, body: str = ""):
        super().__init__(message)
        self.status, self.body = status, body


@dataclass
class Client:
    """Polite requests: a rate, identification, retries with growing pauses."""

    base: str
    email: str | None = None
    token: str | None = None
    rate: float = 10.0
    retries: int = 3
    timeout: int = 30
    send: Callable[[urllib.request.Request, int], bytes] | None = None
    sleep: Callable[[float], None] = time.sleep
    counters: dict[str, int] = field(default_factory=lambda: {"requests": 0, "success": 0, "failed": 0, "limited": 0})
    _last: float = 0.0

    def __post_init__(self):
        if self.email is not None and not ("@" in self.email and "." in self.email.split("@", 1)[1]):
            raise ValueError("invalid e-mail address")

    def _wait(self) -> None:
        pause = self._last + 1 / self.rate - time.monotonic()
        if pause > 0:
            self.sleep(pause)
        self._last = time.monotonic()

    def _send(self, request: urllib.request.Request) -> bytes:
        if self.send:
            return self.send(request, self.timeout)
        with urllib.request.urlopen(request, timeout=self.timeout) as r:  # noqa: S310
            raw = r.read()
            return gzip.decompress(raw) if r.headers.get("Content-Encoding") == "gzip" else raw

    def fetch(self, path: str, params: dict | None = None, body: dict | None = None) -> dict | None:
        """The JSON answer; None if there is none (404, or retries used up). Status 429 waits up
        to 60 s, other temporary failures up to 30 s, further refusals raise."""
        query = dict(params or {}) | ({"mailto": self.email} if self.email else {})
        url = f"{self.base}{path}" + (f"?{urllib.parse.urlencode(query)}" if query else "")
        headers = {"Accept": "application/json", "Accept-Encoding": "gzip"}
        if self.token:
            headers |= {"Authorization": f"Bearer {self.token}", "Content-Type": "application/json"}
        data = json.dumps(body).encode() if body is not None else None
        for attempt in range(self.retries + 1):
            self._wait()
            self.counters["requests"] += 1
            try:
                answer = json.loads(self._send(urllib.request.Request(url, data, headers)))  # noqa: S310
                self.counters["success"] += 1
                return answer
            except urllib.error.HTTPError as e:
                if e.code == 404:
                    break
                if e.code == 429:
                    self.counters["limited"] += 1
                    self.sleep(min(2**attempt, 60))
                elif e.code >= 500:
                    self.sleep(min(2**attempt, 30))
                else:
                    self.counters["failed"] += 1
                    raise ServiceError(f"status {e.code}", e.code) from e
            except (urllib.error.URLError, TimeoutError):
                self.sleep(min(2**attempt, 30))
        self.counters["failed"] += 1
        return None

    def stats(self) -> dict[str, float]:
        """[SRC-23, NUM-13]"""
        return self.counters | {"success_rate": self.counters["success"] / max(self.counters["requests"], 1)}


def fetch_table(keys: DataFrame, make: Callable[[], Client], ask: Callable[[Client, str], dict | None], workers: int = 4) -> DataFrame:
    """``key, response_data`` for ``keys(key)``: at most ``workers`` partitions ask at a time, each
    with its own client, whose rate is the service's rate over the workers."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        for f in frames:
            got = [(k, ask(client, k)) for k in f["key"]]
            yield pd.DataFrame([(k, json.dumps(a)) for k, a in got if a is not None], columns=["key", "response_data"])

    return keys.select("key").distinct().coalesce(workers).mapInPandas(run, "key string, response_data string")


# [STR-27] Query strings of the patent service.
QUERY_BY = {"inventor": 'inventor.name:"{}"', "applicant": 'applicant.name:"{}"', "title": "title:({})"}


def patent_query(by: str, value: str) -> str:
    return QUERY_BY[by].format(value)
