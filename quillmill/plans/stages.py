"""The two corpus builds, put together from the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.hashing import split_name
from quillmill.functions.text import join_parts, normalize, valid_pair
from quillmill.operators.chat import build_records
from quillmill.operators.html import clean_html
from quillmill.operators.rows import combine, first_n, keep_first, offset_split, positional_pairs
from quillmill.operators.segments import segment_documents

#: The categories of bilingual abstracts that are used.
CATEGORIES = ["工学", "理学"]


def general_metadata(dataset: str, score: str) -> Column:
    nothing = F.lit(None).cast("string")
    return F.struct(F.lit(dataset).alias("source_dataset"), F.col(score).alias("score"), nothing.alias("paper_id"), nothing.alias("section")).alias("metadata")


def general_examples(raw: DataFrame, ordinal: str, split: str, limit: int | None = None, dataset: str = "quickmt", characters: str | None = None) -> DataFrame:
    """Valid pairs without repeats; the id counts every raw row, kept or not."""
    source, target = normalize(F.col("en")), normalize(F.col("zh"))
    valid = raw.where(valid_pair(F.col("en"), F.col("zh"), characters=characters))
    kept = keep_first(valid.select(F.col(ordinal).alias("at"), source.alias("source"), target.alias("target"), F.col("sco").alias("score")), ["source", "target"], ["at"])
    picked = first_n(kept, limit, ["at"]) if limit is not None else kept
    return picked.select(F.format_string("%s_%s_%010d", F.lit(dataset), F.lit(split), "at").alias("id"), "source", "target", F.lit("general").alias("domain"), F.lit(split).alias("split"), general_metadata(dataset, "score"), "at")


def evaluation_examples(raw: DataFrame, ordinal: str, sizes: dict[str, int], dataset: str = "quickmt", characters: str | None = None) -> DataFrame:
    """Valid pairs of a held-back file dealt by their place: validation, test; repeats stay."""
    marked = raw.withColumn("_split", offset_split(F.col(ordinal))).where(valid_pair(F.col("en"), F.col("zh"), characters=characters))
    rows = reduce(DataFrame.unionByName, [first_n(marked.where(F.col("_split") == s), n, [ordinal]) for s, n in sizes.items()])
    return rows.select(F.format_string("%s_%s_%010d", F.lit(dataset), "_split", ordinal).alias("id"), normalize(F.col("en")).alias("source"), normalize(F.col("zh")).alias("target"), F.lit("general").alias("domain"), F.col("_split").alias("split"), general_metadata(dataset, "sco"), F.col(ordinal).alias("at"))


def abstract_examples(native: DataFrame, english: DataFrame, split: str, limit: int | None = None, position: str = "position", dataset: str = "csl", characters: str | None = None) -> DataFrame:
    """Bilingual abstracts, paired by their place in the two files, of the split that the id falls into.

    Of valid abstracts with the same id the first in the file stays; ``limit`` goes by place too.
    """
    pairs = positional_pairs(native, english, position, "doc_id")
    left, right = F.col("left"), F.col("right")

    def or_else(own: Column, other: Column) -> Column:
        return F.coalesce(F.nullif(own, F.lit("")), other)

    none = F.array().cast("array<string>")
    rows = pairs.select(
        F.col(position).alias("at"),
        left["doc_id"].cast("string").alias("id"),
        join_parts(right["title"], right["abstract"]).alias("source"),
        join_parts(left["title"], left["abstract"]).alias("target"),
        left["category"].alias("category"),
        F.struct(
            F.lit(dataset).alias("source_dataset"),
            left["doc_id"].alias("paper_id"),
            F.lit("title_abstract").alias("section"),
            F.coalesce(left["keywords"], none).alias("keywords"),
            F.coalesce(right["keywords"], none).alias("keywords_en"),
            left["category"].alias("category"),
            or_else(left["category_eng"], right["category"]).alias("category_eng"),
            left["discipline"].alias("discipline"),
            or_else(left["discipline_eng"], right["discipline"]).alias("discipline_eng"),
        ).alias("metadata"),
    )
    wanted = rows.where((split_name(F.col("id")) == split) & F.coalesce(F.col("category").isin(CATEGORIES), F.lit(False)))
    valid = keep_first(wanted.where(valid_pair(F.col("source"), F.col("target"), characters=characters)), ["id"], ["at"])
    picked = first_n(valid, limit, ["at"]) if limit is not None else valid
    return picked.select("id", "source", "target", F.lit("scientific").alias("domain"), F.lit(split).alias("split"), "metadata", "at")


def split_examples(parts: list[DataFrame]) -> DataFrame:
    """The parts of one split after each other: ``part, at`` order them, metadata is JSON."""
    return combine([p.select("id", "source", "target", "domain", "split", F.to_json("metadata", {"ignoreNullFields": "false"}).alias("metadata"), "at") for p in parts])


def training_set(parts: list[DataFrame]) -> DataFrame:
    """Chat records of all parts, in the order of the parts."""
    shared = [p.select("id", "source", "target", "domain", "split", F.to_json("metadata", {"ignoreNullFields": "false"}).alias("metadata")) for p in parts]
    return build_records(combine(shared))


def paper_documents(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """Accepted papers with their cleaned pages; ``sections`` is null where a page is missing."""
    joined = candidates.join(pages, candidates["arxiv_base_id"] == pages["page_key"], "left").withColumn("document", clean_html(F.col("html")))
    title = F.coalesce(F.nullif(F.col("document.title"), F.lit("")), candidates["title"])
    return joined.select(*[candidates[c] for c in candidates.columns if c != "title"], title.alias("title"), F.col("document.sections").alias("sections"), F.col("document.removed_counts").alias("removed_counts"), F.col("html").isNull().alias("missing"))


def paper_segments(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    return segment_documents(paper_documents(candidates, pages).where("not missing"))
