"""Streams: resumed collection, windows, throttled and idempotent enrichment."""

import time

from pyspark.sql import functions as F

from quillmill.streaming import enrich, resume


def test_collection_resumes_without_repeats(spark, tmp_path):
    schema, into = "id string, at long", f"{tmp_path}/in"

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(into)
        resume.collect(stream, f"{tmp_path}/out", f"{tmp_path}/cp", "id", ["at"]).awaitTermination()
        return sorted((r.id, r.at) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], schema).coalesce(1).write.mode("append").json(into)
    assert run() == [("a", 1), ("b", 3)]
    spark.createDataFrame([("b", 9), ("c", 4)], schema).coalesce(1).write.mode("append").json(into)
    assert run() == [("a", 1), ("b", 3), ("c", 4)] == run()


def test_paged_source_reads_all_pages(spark):
    from quillmill.sources import paged

    def fetch(cursor):
        pages = {"*": ([("a",), ("b",)], "2"), "2": ([("c",)], None)}
        return pages[cursor]

    paged.register_transport("fake", fetch)
    reader = paged.PagedReader({"transport": "fake"})
    assert [r for p in reader.partitions() for r in reader.read(p)] == [("a",), ("b",), ("c",)]
    stream = paged.PagedStream({"transport": "fake"})
    first, at = stream.read(stream.initialOffset())
    second, end = stream.read(at)
    assert list(first) + list(second) == [("a",), ("b",), ("c",)] and list(stream.read(end)[0]) == [] and end == {"cursor": None}


def test_throttle_spaces_calls():
    now, waits = [0.0], []

    def sleep(s):
        waits.append(s)
        now[0] += s

    throttle = enrich.Throttle(0.5, clock=lambda: now[0], sleep=sleep)
    for _ in range(3):
        throttle.wait()
    assert waits == [0.5, 0.5]


def call(value):
    from quillmill.sources.paged import RemoteError

    if value == "gone":
        raise RemoteError(404)
    if value == "busy":
        raise RemoteError(503)
    return value.upper()


def test_enrichment_skips_what_is_done(spark):
    rows = spark.createDataFrame([("1", "x"), ("2", "gone"), ("3", "busy"), ("4", "y")], "id string, source string")
    done = spark.createDataFrame([("4",)], "id string")
    got = {r.id: r for r in enrich.enrich(rows, done, call, workers=2, retries=1, base=0.01, interval=0.0, sleep=time.sleep).collect()}
    assert set(got) == {"1", "2", "3"} and got["1"].result == "X"
    assert got["2"].classification == "permanent" and got["3"].classification == "retryable"
    fetched = spark.createDataFrame([(r.id, r.result) for r in got.values()], "id string, result string")
    status = {r.id: r.status for r in enrich.fetch_status(rows, done, fetched, "id").collect()}
    assert status == {"1": "fetched", "2": "failed", "3": "failed", "4": "skipped"}


def test_event_windows_as_a_stream(spark, tmp_path):
    events = spark.range(100).select(F.timestamp_seconds(F.col("id") * 600).alias("ts"), F.lit("e").alias("event_type"), F.lit(1.0).alias("value"))
    events.coalesce(1).write.parquet(f"{tmp_path}/e")
    stream = resume.windowed_counts(spark.readStream.schema(events.schema).parquet(f"{tmp_path}/e"))
    stream.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, resume.windowed_counts(events).collect()))
