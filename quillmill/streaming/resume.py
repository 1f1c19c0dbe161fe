"""Resumable collection: a stream of pages into tables that stay free of repeats across restarts."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillmill.operators.rows import keep_first, keep_last


def known(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows already collected, none if nothing was."""
    from quillmill.sources.files import exists

    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def collect(stream: DataFrame, out: str, checkpoint: str, key: str, order: list[str], latest: bool = False, **trigger) -> StreamingQuery:
    """Append each batch's new keys to ``out``: rows first, then the offset.

    Within a batch the first row of a key stays (or the last with ``latest``); keys that ``out`` holds
    are left out, so a batch that is delivered again adds nothing.
    """
    schema = stream.schema

    def put(batch: DataFrame, number: int) -> None:
        one = (keep_last if latest else keep_first)(batch, [key], order)
        seen = known(batch.sparkSession, out, schema).select(key).distinct()
        one.join(seen, key, "left_anti").select(*schema.names).write.mode("append").parquet(out)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


STATE = "pages bigint, cursor string, done boolean, seen bigint, accepted bigint"


def collect_pages(spark: SparkSession, fetch: Callable[[str], tuple[list[tuple], str | None]], schema, accept: Callable[[DataFrame, DataFrame], DataFrame], out: str, key: str, target: int, most: int, start: str = "*", say: Callable[[str], None] = print) -> dict:
    """Page by page until there are ``target`` accepted rows, ``most`` seen ones, or no more pages.

    ``accept(page, known keys)`` gives a page's new rows.  They are appended before the state, which is a
    row for each page, so that a run that was cut off asks for its last page again and adds nothing
    twice; an exhausted source stays so.  Each page is told as a JSON line.  A cursor is known only
    when the page before has come, so pages are fetched one after the other.
    """
    rows_at, state_at = f"{out}/accepted", f"{out}/state"
    last = known(spark, state_at, STATE).orderBy(F.desc("pages")).first()
    state = last.asDict() if last else {"pages": 0, "cursor": start, "done": False, "seen": 0, "accepted": 0}
    while not state["done"] and state["accepted"] < target and state["seen"] < most:
        rows, following = fetch(state["cursor"])
        if rows:
            page = spark.createDataFrame(rows, schema)
            accept(page, known_keys(spark, rows_at, key)).write.mode("append").parquet(rows_at)
        state = {"pages": state["pages"] + 1, "cursor": following, "done": following is None or not rows, "seen": state["seen"] + len(rows), "accepted": known_keys(spark, rows_at, key).count()}
        spark.createDataFrame([tuple(state.values())], STATE).coalesce(1).write.mode("append").parquet(state_at)
        say(json.dumps({"event": "page_completed", "page_seen": len(rows), **state}))
    return state


def known_keys(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The key column of what was collected, read with the files' own schema."""
    from quillmill.sources.files import exists

    return spark.read.parquet(path).select(key) if exists(spark, path) else spark.createDataFrame([], f"{key} string")


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by event time and type; works on a stream, where late rows are let go."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n_events"), F.sum("value").alias("sum_value")).select(F.col("w.start").alias("window_start"), "event_type", "n_events", "sum_value")
