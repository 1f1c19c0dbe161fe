"""Tables written to the cluster's shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: While a table is written, Arrow batches are bounded, as long texts stand in the JVM and in Python at
#: once; and once it is written its shuffles go, which else stay until the driver happens to collect
#: its garbage: a run of many steps would hold the shuffles of all of them.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """The settings of a write hold; the session's own come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in BATCHES}
    for k, v in BATCHES.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where none is named, a local master gets a temporary folder; a cluster, whose executors would each
    write to a disk of their own, is refused.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or (current.get() if current.isDefined() else None)
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='quillmill-')}"
    if not current.isDefined():
        context.setCheckpointDir(named)
    return named


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as zstd Parquet in the shared folder and read it back.

    The files survive the loss of executors, and readers prune columns.  :func:`discard` deletes them;
    those that a lazily read result still needs stay until the cluster clears the folder.  A side of a
    join that is an aggregate is written first where its key may be hot: only joins of two plain
    exchanges have their skewed partitions split.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/quillmill/{tag}-{uuid.uuid4().hex}"
    with bounded_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.materialized_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        at = context._jvm.org.apache.hadoop.fs.Path(df.materialized_at)
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
