"""Profiles and report aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def length_stats(df: DataFrame, text: Column, by: list[str]) -> DataFrame:
    """Count, shortest, longest and mean length in characters, of each group."""
    n = F.length(text)
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), F.min(n).cast("long").alias("min_chars"), F.max(n).cast("long").alias("max_chars"), F.avg(n).alias("mean_chars"))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts of each column's values in one pass, null as the word ``None``."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("value")) for c in columns])).alias("x")
    return df.select(values).groupBy("x.field", "x.value").agg(F.count("*").alias("n"))


def rank_stats(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Upper median ``sorted[n // 2]`` and ``sorted[int(0.9 n)]``, with count, mean and largest.

    Values are counted first, so that what is ordered is the distinct values of a group.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(*by).orderBy(value)
    marked = counted.select(*by, value, "_n", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(Window.partitionBy(*by)).alias("_all"))

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("_upto") > position, F.col(value)))

    return marked.groupBy(*by).agg(F.max("_all").alias("n"), (F.sum(F.col(value) * F.col("_n")) / F.max("_all")).alias("mean"), at(F.floor(F.col("_all") / 2)).alias("upper_median"), at(F.floor(F.col("_all") * 9 / 10)).alias("p90"), F.max(value).alias("largest"))


def top_k(df: DataFrame, key: Column, k: int, name: str = "value", position: str | None = None) -> DataFrame:
    """The most frequent keys; ties by key, or by the first place of each where ``position`` names it."""
    if position is None:
        return df.groupBy(key.alias(name)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name).limit(k)
    counted = df.groupBy(key.alias(name)).agg(F.count("*").alias("n"), F.min(position).alias("_first"))
    return counted.orderBy(F.desc("n"), "_first").limit(k).drop("_first")


def split_profile(examples: DataFrame, name: str, order: list[str], samples: int = 10) -> DataFrame:
    """One row about a split: size, domains, data sets, lengths of both sides, the first ids."""

    def counts(value: Column) -> DataFrame:
        found = examples.groupBy(value.cast("string").alias("k")).agg(F.count("*").alias("n"))
        return found.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias("m"))

    def lengths(text: str) -> Column:
        return F.struct(F.min(F.length(text)).alias("min"), F.max(F.length(text)).alias("max"), F.round(F.avg(F.length(text)), 2).alias("mean"))

    first = examples.orderBy(*order).limit(samples).select("id", F.struct(*order).alias("o"))
    ids = first.agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "id"))), lambda x: x["id"]).alias("sample_ids"))
    facts = examples.agg(F.count("*").alias("num_examples"), lengths("source").alias("source_chars"), lengths("target").alias("target_chars"))
    dataset = F.get_json_object("metadata", "$.source_dataset")
    # one row each
    joined = facts.crossJoin(counts(F.col("domain")).withColumnRenamed("m", "domains")).crossJoin(counts(dataset).withColumnRenamed("m", "source_datasets")).crossJoin(ids)
    return joined.select(F.lit(name).alias("name"), "num_examples", "domains", "source_datasets", "source_chars", "target_chars", "sample_ids")


def per_year(df: DataFrame, date: Column) -> DataFrame:
    """Rows for each four-character year; empty dates are left out."""
    year = F.substring(date.cast("string"), 1, 4)
    return df.where(F.coalesce(year, F.lit("")) != "").groupBy(year.alias("year")).agg(F.count("*").alias("n"))


def run_summary(df: DataFrame, status: Column, wanted: list[str]) -> DataFrame:
    """One row with a count for each status."""
    return df.agg(*[F.count(F.when(status == s, 1)).alias(f"n_{s}") for s in wanted], F.count("*").alias("n_all"))


def markdown_table(df: DataFrame, most_rows: int = 1000) -> str:
    """A small result as a Markdown table; fails beyond ``most_rows`` rows."""
    rows = df.limit(most_rows + 1).collect()
    if len(rows) > most_rows:
        raise ValueError(f"a table of more than {most_rows} rows")
    lines = [df.columns, ["---"] * len(df.columns), *[["" if v is None else str(v) for v in r] for r in rows]]
    return "\n".join("| " + " | ".join(x) + " |" for x in lines)


def latex_table(df: DataFrame, most_rows: int = 1000) -> str:
    """A small result as a LaTeX tabular, its cells escaped."""
    from quillmill.functions.text import latex_escape

    cells = df.select(*[latex_escape(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in df.columns])
    rows = cells.limit(most_rows + 1).collect()
    if len(rows) > most_rows:
        raise ValueError(f"a table of more than {most_rows} rows")
    body = [" & ".join(r) + r" \\" for r in rows]
    return "\n".join([r"\begin{tabular}{" + "l" * len(df.columns) + "}", " & ".join(c.replace("_", r"\_") for c in df.columns) + r" \\", r"\hline", *body, r"\end{tabular}"])
