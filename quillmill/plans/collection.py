"""Collecting papers: from feed entries or works to accepted candidates, pages and evaluations."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.functions.papers import normalize_arxiv_id, strip_version, version_number, work_candidate
from quillmill.functions.text import normalize, search_form
from quillmill.operators.rows import best_match, keep_first, keep_last, pending

ENTRY = "arxiv_id string, arxiv_base_id string, title string, submitted_at string, updated_at string, summary string, categories array<string>, pdf_url string, source_url string, html_url string, license string"


def feed_entries(raw: DataFrame) -> DataFrame:
    """Rows of ``sources.paged.parse_feed`` as paper entries; entries without an id are left out."""
    arxiv_id = normalize_arxiv_id(F.col("id"))
    base = strip_version(arxiv_id)
    return raw.where(F.coalesce(arxiv_id, F.lit("")) != "").select(
        arxiv_id.alias("arxiv_id"),
        base.alias("arxiv_base_id"),
        normalize(F.col("title")).alias("title"),
        F.coalesce("published", F.lit("")).alias("submitted_at"),
        F.col("updated").alias("updated_at"),
        F.coalesce("summary", F.lit("")).alias("summary"),
        "categories",
        F.coalesce(F.nullif("pdf", F.lit("")), F.concat(F.lit("https://arxiv.org/pdf/"), arxiv_id, F.lit(".pdf"))).alias("pdf_url"),
        F.concat(F.lit("https://arxiv.org/abs/"), arxiv_id).alias("source_url"),
        F.concat(F.lit("https://arxiv.org/html/"), base).alias("html_url"),
        "license",
    )


def latest_entries(entries: DataFrame, position: str) -> DataFrame:
    """The latest version of each paper; of equal versions the first."""
    ranked = entries.withColumn("_version", version_number(F.col("arxiv_id"))).withColumn("_early", -F.col(position))
    return keep_last(ranked, ["arxiv_base_id"], ["_version", "_early"]).drop("_version", "_early")


def enriched_entries(entries: DataFrame, works: DataFrame) -> DataFrame:
    """Each entry with its best match among search results ``arxiv_base_id, position, title, cited_by_count``.

    An exact title wins, then the most citations; an entry without results keeps a null work.
    """
    found = works.select("arxiv_base_id", "position", F.struct(*[c for c in works.columns if c not in ("arxiv_base_id", "position")]).alias("openalex"))
    pairs = entries.join(found, "arxiv_base_id", "left").withColumn("position", F.coalesce("position", F.lit(0)))
    exact = F.coalesce(search_form(F.col("openalex.title")) == search_form(F.col("title")), F.lit(False))
    return best_match(pairs, "arxiv_base_id", exact, F.coalesce("openalex.cited_by_count", F.lit(-1)), "position").drop("position")


def accepted_entries(enriched: DataFrame, least_citations: int = 21, usable=None) -> DataFrame:
    """Candidates among enriched entries; ``usable`` is an optional test of the page."""
    kept = enriched.where(F.col("openalex").isNotNull() & (F.coalesce("openalex.cited_by_count", F.lit(0)) >= least_citations))
    kept = kept if usable is None else kept.where(usable)
    return kept.select("arxiv_id", "arxiv_base_id", "title", "submitted_at", "categories", F.col("openalex.cited_by_count").cast("long").alias("cited_by_count"), "html_url", "pdf_url", "source_url", "license")


def accepted_works(works: DataFrame, seen: DataFrame, position: str, least_citations: int = 21) -> DataFrame:
    """Candidates among works: the first of each paper that earlier pages have not given."""
    record, accepted = work_candidate(F.struct(*works.columns), least_citations)
    candidates = works.select(record.alias("r"), accepted.alias("_ok"), F.col(position)).where("_ok").select("r.*", position)
    return keep_first(pending(candidates, seen, ["arxiv_base_id"]), ["arxiv_base_id"], [position])


def usable_pages(candidates: DataFrame, probe: Callable[[str], tuple[int, str]], workers: int = 6) -> DataFrame:
    """``candidates`` with ``usable``: the page answers 200 with an HTML type.  ``probe`` gives both."""
    names = candidates.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = [probe(u) for u in frame["html_url"]]
            yield pd.DataFrame({"arxiv_base_id": frame["arxiv_base_id"], "usable": [s == 200 and "html" in (t or "").lower() for s, t in answers]})

    asked = candidates.select("arxiv_base_id", "html_url").repartition(workers).mapInPandas(run, "arxiv_base_id string, usable boolean")
    return candidates.join(asked, "arxiv_base_id").select(*names, "usable")


def comparison_grid(segments: DataFrame, models: list[str], efforts: list[str], done: DataFrame) -> DataFrame:
    """Every train segment with every model and effort, without the triples that are done."""
    grid = segments.where("split = 'train'").select("id", F.explode(F.array(*map(F.lit, models))).alias("model"), "source").select("id", "source", "model", F.explode(F.array(*map(F.lit, efforts))).alias("effort"))
    return pending(grid, done, ["id", "model", "effort"])


def evaluation_samples(records: DataFrame) -> DataFrame:
    """``id, source, reference, prediction``; without a model the prediction is the source."""
    return records.select("id", "source", F.col("target").alias("reference"), F.col("source").alias("prediction"))
