"""A Python data source for page-wise JSON services: one input partition for each key, retries and pacing inside.

    spark.dataSource.register(PagedSource)
    spark.read.format("paged_json").option("fetch", "package.module:function").option("keys", "1,2,3").load()

``fetch(key, page) -> (objects, has_more)`` does the request; any service, or a folder of fixtures, can stand behind it.
Rows are (key, page, place, payload as JSON text); executors fetch, the driver only lists the keys.
"""

from __future__ import annotations

import email.utils
import importlib
import json
import time
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class TooManyRequests(Exception):
    def __init__(self, retry_after: str | None = None):
        super().__init__("too many requests")
        self.retry_after = retry_after


class Unauthorized(Exception):
    pass


def with_login(login, call):
    """A fetch function that logs in before the first call, and once more when a call is refused as unauthorized.

    ``login() -> token``, ``call(token, key, page) -> (objects, has_more)``. A second refusal is raised.
    """
    held = []

    def fetch(key: str, page: int):
        if not held:
            held.append(login())
        try:
            return call(held[0], key, page)
        except Unauthorized:
            held[0] = login()
            return call(held[0], key, page)

    return fetch


def by_offset(get, limit: int):
    """A fetch function for services with offset and limit: ``get(key, offset, limit) -> (objects, total)``, read until the
    total is reached or a page is empty."""

    def fetch(key: str, page: int):
        objects, total = get(key, page * limit, limit)
        return objects, bool(objects) and page * limit + len(objects) < total

    return fetch


def seconds_of(retry_after: str | None, now: float | None = None) -> float | None:
    """The wait that a Retry-After header asks for: seconds or an HTTP date; null where it says neither."""
    if not retry_after:
        return None
    try:
        return max(0.0, float(retry_after))
    except ValueError:
        pass
    try:
        return max(0.0, email.utils.parsedate_to_datetime(retry_after).timestamp() - (time.time() if now is None else now))
    except (TypeError, ValueError):
        return None


@dataclass
class Pace:
    """Seconds between requests: they grow when the service refuses one, and shrink to the floor with each success."""

    floor: float = 0.0
    cap: float = 20.0
    wait: float = 0.0

    def refused(self) -> float:
        self.wait = min(self.cap, 1.5 * max(self.wait, self.floor) + 0.5)
        return self.wait

    def answered(self) -> float:
        self.wait = max(self.floor, 0.85 * self.wait)
        return self.wait


class KeyPartition(InputPartition):
    def __init__(self, key: str):
        self.key = key


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.fetch, self.keys = options["fetch"], [k for k in options.get("keys", "").split(",") if k]
        self.attempts, self.floor = int(options.get("attempts", "10")), float(options.get("floor", "0"))

    def partitions(self):
        return [KeyPartition(k) for k in self.keys]

    def read(self, partition):
        if partition is None:
            return
        module, _, name = self.fetch.partition(":")
        fetch = getattr(importlib.import_module(module), name)
        pace, page, more = Pace(self.floor, wait=self.floor), 0, True
        while more:
            for attempt in range(self.attempts):
                try:
                    time.sleep(pace.wait)
                    objects, more = fetch(partition.key, page)
                    pace.answered()
                    break
                except TooManyRequests as e:
                    wait = seconds_of(e.retry_after)
                    time.sleep(pace.refused() if wait is None else min(wait, pace.cap))
                    if attempt + 1 == self.attempts:
                        raise
            for place, x in enumerate(objects):
                yield partition.key, page, place, json.dumps(x)
            page += 1


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "key string, page int, place int, payload string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)
