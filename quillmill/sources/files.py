"""File sources and sinks: JSON Lines with or without line numbers, keyed pages, split outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern of any file system that Spark reads has files."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return bool(found)


def read_parallel(spark: SparkSession, *paths: str) -> DataFrame:
    """Parallel text; only ``en``, ``zh`` and ``sco`` are read, and each row's place in its file."""
    return spark.read.parquet(*paths).select("en", "zh", "sco", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index"))


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, missing_ok: bool = False) -> DataFrame:
    """JSON Lines, gzip or not; blank lines are skipped, a malformed one fails the read."""
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_placed(spark: SparkSession, path: str, schema: StructType | str, name: str = "position") -> DataFrame:
    """JSON Lines with each record's place among the records, from 0, files in order of path."""
    from quillmill.operators.rows import with_ordinal

    read = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    placed = read.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))
    return with_ordinal(placed, ["_file", "_block", "_line"], name).drop("_file", "_block", "_line")


def read_jsonl_numbered(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """``file, line, record, raw``: physical line numbers from 1; a malformed record is null.

    A file is one row here, so this is for files that are validated, not for bulk data.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line", "raw"))
    return whole.where(F.trim("raw") != "").select("file", (F.col("line") + 1).alias("line"), F.from_json("raw", schema).alias("record"), "raw")


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Only the messages, so that records with differing metadata do not clash."""
    return spark.read.schema("messages array<struct<role: string, content: string>>").json(path)


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``page_key, html`` of a folder of pages; the key is the file's name without its ending."""
    pages = spark.read.text(f"{folder}/*.html", wholetext=True)
    return pages.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.html$", 1).alias("page_key"), F.col("value").alias("html"))


def shard_paths(paths: list[str], count: int) -> list[str]:
    """The first ``count`` paths in order of name."""
    chosen = sorted(paths)[:count]
    if not chosen:
        raise FileNotFoundError("no input file")
    return chosen


def stream_source(spark: SparkSession, path: str) -> str:
    """What a file stream reads for a table that is a folder, or a single file: streams list folders or
    patterns only, so a single file is named by a pattern that matches nothing else."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    status = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at)
    return path if status.isDirectory() else f"{path[:-1]}[{path[-1]}]"


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", by: list[str] | None = None) -> None:
    """JSON Lines with explicit nulls, into one folder or one for each split."""
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    (writer.partitionBy(*by) if by else writer).json(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def route(df: DataFrame, error: str, good: str, bad: str) -> None:
    """Rows without error to one sink by split, the others to the dead-letter sink."""
    write_jsonl(df.where(F.col(error).isNull()).drop(error), good, "append", ["split"])
    write_jsonl(df.where(F.col(error).isNotNull()), bad, "append")
