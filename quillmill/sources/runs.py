"""Sources of reports: training logs, run summaries, and the files of a model folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.operators.rows import keep_last, pending

LOG = "log_history array<struct<step: bigint, loss: double, eval_loss: double, eval_mean_token_accuracy: double, mean_token_accuracy: double, learning_rate: double, epoch: double>>"
SUMMARY = "`train/loss` double, `eval/loss` double, `eval/mean_token_accuracy` double, `train/global_step` bigint, _runtime double"
# The files that a model folder must have.
REQUIRED = ["config.json", "tokenizer_config.json"]


def training_log(spark: SparkSession, root: str) -> DataFrame:
    """``run, path, at`` and the fields of each entry of every ``trainer_state.json`` below ``root``."""
    states = spark.read.schema(LOG).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "trainer_state.json").json(root)
    path = F.col("_metadata.file_path")
    below = F.element_at(F.split(path, root.rstrip("/").rpartition("/")[2] + "/"), -1)
    return states.select(F.split(below, "/")[0].alias("run"), path.alias("path"), F.posexplode("log_history").alias("at", "e")).select("run", "path", "at", "e.*")


def evaluation_points(log: DataFrame) -> DataFrame:
    """The last evaluation of each run and step, files in order of path."""
    points = log.where("eval_loss is not null").select("run", F.col("step"), "eval_loss", F.coalesce("eval_mean_token_accuracy", F.lit(0.0)).alias("eval_token_accuracy"), F.coalesce("epoch", F.lit(0.0)).alias("epoch"), "path", "at")
    return keep_last(points, ["run", "step"], ["path", "at"]).drop("path", "at")


def training_points(log: DataFrame, every: int = 50) -> DataFrame:
    """The last training entry of each run and step, of every 50th step."""
    points = log.where(F.col("loss").isNotNull() & (F.col("step") % every == 0)).select("run", "step", F.col("loss").alias("train_loss"), F.coalesce("mean_token_accuracy", F.lit(0.0)).alias("train_token_accuracy"), F.coalesce("learning_rate", F.lit(0.0)).alias("learning_rate"), "path", "at")
    return keep_last(points, ["run", "step"], ["path", "at"]).drop("path", "at")


def label_series(points: DataFrame, labels: list[tuple[str, str, str]]) -> DataFrame:
    """Points with a series, by (run, SQL test of the step, label); points without one are dropped."""
    series = F.lit(None).cast("string")
    for run, test, label in reversed(labels):
        series = F.when((F.col("run") == run) & F.expr(test), label).otherwise(series)
    return points.withColumn("series", series).where("series is not null")


def run_summaries(spark: SparkSession, root: str) -> DataFrame:
    """One row for each run's summary, named by its configuration where that names it."""
    summaries = spark.read.schema(SUMMARY).option("multiLine", True).json(f"{root}/run-*/files/wandb-summary.json")
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/files/[^/]+$", 1)
    rows = summaries.select(folder.alias("run_dir"), F.coalesce("train/global_step", F.lit(0)).alias("global_step"), F.col("train/loss").alias("train_loss"), F.col("eval/loss").alias("eval_loss"), F.col("eval/mean_token_accuracy").alias("eval_token_accuracy"), F.round(F.coalesce("_runtime", F.lit(0.0)) / 3600, 2).alias("runtime_hours"))
    configs = spark.read.text(f"{root}/run-*/files", pathGlobFilter="config.yaml", wholetext=True)
    named = configs.select(folder.alias("run_dir"), F.trim(F.regexp_extract("value", r"(?m)^(?:run_name|wandb_run_name):(.*)$", 1)).alias("named"))
    own = F.array_join(F.slice(F.split("run_dir", "-"), 3, 1000), "-")
    joined = rows.join(named, "run_dir", "left")
    return joined.select("run_dir", F.element_at(F.split("run_dir", "-"), -1).alias("run_id"), F.coalesce(F.nullif("named", F.lit("")), own).alias("name"), "global_step", "train_loss", "eval_loss", "eval_token_accuracy", "runtime_hours")


def folder_files(spark: SparkSession, folder: str) -> DataFrame:
    """``name, size`` of the files of a folder, by their metadata alone."""
    return spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"))


def model_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """One row: shards, their bytes, which required files are there, and the missing ones in order."""
    from quillmill.sources.files import exists

    listed = folder_files(spark, folder).cache()
    wanted = spark.createDataFrame([(x,) for x in REQUIRED], "name string")
    index = f"{folder}/model.safetensors.index.json"
    if exists(spark, index):
        shards = spark.read.schema("weight_map map<string, string>").option("multiLine", True).json(index).select(F.explode("weight_map").alias("_", "name")).select("name")
        wanted = wanted.union(shards).distinct()
    missing = pending(wanted, listed, ["name"]).agg(F.array_sort(F.collect_list("name")).alias("missing_files"))
    shard = F.col("name").endswith(".safetensors")
    facts = listed.agg(F.count(F.when(shard, 1)).alias("num_safetensors"), F.coalesce(F.sum(F.when(shard, F.col("size"))), F.lit(0)).alias("total_safetensors_bytes"), *[F.coalesce(F.bool_or(F.col("name") == f), F.lit(False)).alias(n) for n, f in (("has_config", REQUIRED[0]), ("has_tokenizer_config", REQUIRED[1]), ("has_index", "model.safetensors.index.json"))])
    return facts.crossJoin(missing)  # one row each
