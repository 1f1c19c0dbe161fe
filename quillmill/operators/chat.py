"""Chat-style training records: building and validating them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.text import self_talk

#: Parameters: our own wording.
SYSTEM_PROMPT = "Translate academic English into precise and fluent Chinese. Keep formulas, citations and code as they are, and add nothing."
USER_PREFIX = "Give a Chinese translation of this academic text:\n\n"
# The fields and roles of a record.
FIELDS = ["id", "domain", "split", "messages"]
ROLES = ["system", "user", "assistant"]


def messages(source: Column, target: Column, system: str = SYSTEM_PROMPT, prefix: str = USER_PREFIX) -> Column:
    def turn(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(turn("system", F.lit(system)), turn("user", F.concat(F.lit(prefix), source)), turn("assistant", target))


def build_records(examples: DataFrame, system: str = SYSTEM_PROMPT, prefix: str = USER_PREFIX) -> DataFrame:
    return examples.select("id", "domain", "split", "metadata", messages(F.col("source"), F.col("target"), system, prefix).alias("messages"))


def teacher_records(segments: DataFrame, target: Column, model: str, system: str = SYSTEM_PROMPT) -> DataFrame:
    """Records of translated segments: the model in the metadata, source and target kept beside."""
    kept = segments.withColumn("target", F.trim(target)).withColumn("metadata", F.col("metadata").withField("teacher_model", F.lit(model)))
    return kept.select("id", "domain", "split", "metadata", messages(F.col("source"), F.col("target"), system).alias("messages"), "source", "target")


def record_error(columns: list[str]) -> Column:
    """The first rule that a record breaks, or null: fields, three messages, roles, contents, self-talk."""
    missing = [c for c in FIELDS if c not in columns]
    if missing:
        return F.lit("missing fields: " + ", ".join(missing))
    absent = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in FIELDS]), lambda x: x.isNotNull())
    roles = F.transform("messages", lambda m: m["role"])
    blank = F.exists("messages", lambda m: F.coalesce(F.trim(m["content"]), F.lit("")) == "")
    return (
        F.when(F.size(absent) > 0, F.concat(F.lit("missing fields: "), F.array_join(absent, ", ")))
        .when(F.size("messages") != 3, "three messages are needed")
        .when(~roles.eqNullSafe(F.array(*map(F.lit, ROLES))), "roles must be system, user, assistant")
        .when(blank, "a message is empty")
        .when(F.exists("messages", lambda m: self_talk(m["content"])), "self-talk in a message")
    )


def validate(records: DataFrame) -> DataFrame:
    return records.withColumn("error", record_error(records.columns))


def count_by_file(validated: DataFrame, file: str = "file") -> DataFrame:
    """Records and faulty records of each file."""
    return validated.groupBy(file).agg(F.count("*").alias("n_records"), F.count("error").alias("n_errors"))
