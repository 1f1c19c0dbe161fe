"""Idempotent enrichment of rows through a remote call: fetching pages, translating segments."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.operators.rows import pending
from quillmill.sources.paged import RemoteError


class Throttle:
    """Starts calls at least ``interval`` seconds apart within a task."""

    def __init__(self, interval: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.interval, self.clock, self.sleep, self.next = interval, clock, sleep, None

    def wait(self) -> None:
        now = self.clock()
        if self.next is not None and now < self.next:
            self.sleep(self.next - now)
            now = self.next
        self.next = now + self.interval


def error_class(error: RemoteError) -> str:
    """``permanent``, ``retryable`` or ``fatal``; no status means that the transport failed."""
    if error.status in (404, 406):
        return "permanent"
    return "retryable" if error.status is None or error.status == 429 or error.status >= 500 else "fatal"


def enrich(rows: DataFrame, done: DataFrame, call: Callable[[str], str], key: str = "id", argument: str = "source", workers: int = 3, retries: int = 4, base: float = 2.0, interval: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """``key, result, classification, error`` of the rows whose key is not among ``done``.

    ``call`` runs in ``workers`` tasks, each throttled so that together they start a call every
    ``interval`` seconds.  Retryable errors are tried again up to ``retries`` times with doubled
    pauses; what remains is returned as an error row for the dead-letter sink.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        throttle = Throttle(interval * workers, sleep=sleep)
        for frame in frames:
            out = []
            for k, value in zip(frame[key], frame[argument]):
                throttle.wait()
                for attempt in range(1, retries + 2):
                    try:
                        out.append((k, call(value), None, None))
                        break
                    except RemoteError as error:
                        kind = error_class(error)
                        if kind != "retryable" or attempt > retries:
                            out.append((k, None, kind, str(error)))
                            break
                        sleep(base * 2 ** (attempt - 1))
            yield pd.DataFrame(out, columns=[key, "result", "classification", "error"])

    todo = pending(rows, done, [key]).select(key, argument)
    return todo.repartition(workers).mapInPandas(run, f"{key} string, result string, classification string, error string")


def fetch_status(rows: DataFrame, existing: DataFrame, fetched: DataFrame, key: str) -> DataFrame:
    """Each wanted key as ``skipped`` (already there), ``fetched`` or ``failed``."""
    there = existing.select(key).distinct().withColumn("_there", F.lit(True))
    got = fetched.select(key, F.col("result").isNotNull().alias("_got"))
    status = F.when(F.col("_there"), "skipped").when(F.col("_got"), "fetched").otherwise("failed")
    return rows.join(there, key, "left").join(got, key, "left").select(key, status.alias("status"))
