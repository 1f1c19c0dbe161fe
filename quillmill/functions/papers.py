"""Identifiers and bibliographic records: arXiv ids, OpenAlex works, categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.text import normalize

# Prefixes in the order in which they are taken off, and the field of computer science.
ID_PREFIXES = ["https://arxiv.org/abs/", "http://arxiv.org/abs/", "https://arxiv.org/pdf/", "http://arxiv.org/pdf/", "arXiv:"]
CS_FIELD = "fields/17"
DEFAULT_CATEGORY = "openalex:computer_science"


def strip_version(arxiv_id: Column) -> Column:
    return F.regexp_replace(arxiv_id, r"v\d+$", "")


def version_number(arxiv_id: Column) -> Column:
    return F.coalesce(F.regexp_extract(arxiv_id, r"v(\d+)$", 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def normalize_arxiv_id(value: Column) -> Column:
    out = F.trim(value)
    for prefix in ID_PREFIXES:
        out = F.when(out.startswith(prefix), F.substring(out, len(prefix) + 1, 1 << 30)).otherwise(out)
    out = F.regexp_replace(out, r"\.pdf$", "")
    return F.regexp_replace(out, "/+$", "")


def arxiv_id_from_url(url: Column) -> Column:
    """The id in an abs, pdf or html address, else null."""
    found = F.regexp_extract(url, r"arxiv\.org/(?:abs|pdf|html)/([^?#/]+)", 1)
    return F.when(F.coalesce(found, F.lit("")) != "", normalize_arxiv_id(found))


def work_arxiv_id(work: Column) -> Column:
    """First of: the open-access address; each location's landing page, then its PDF; the ids."""
    pages = F.flatten(F.transform(F.coalesce(work["locations"], F.array().cast("array<struct<landing_page_url:string,pdf_url:string>>")), lambda x: F.array(x["landing_page_url"], x["pdf_url"])))
    found = F.filter(F.transform(pages, arxiv_id_from_url), lambda x: x.isNotNull())
    own = F.when(F.coalesce(work["ids"]["arxiv"], F.lit("")) != "", normalize_arxiv_id(work["ids"]["arxiv"]))
    return F.coalesce(arxiv_id_from_url(work["open_access"]["oa_url"]), F.try_element_at(found, F.lit(1)), own)


def field_id(topic: Column) -> Column:
    return F.regexp_replace(F.coalesce(topic["field"]["id"], F.lit("")), "^https://openalex.org/", "")


def is_cs_work(work: Column) -> Column:
    topics = F.coalesce(work["topics"], F.array())
    return F.coalesce(field_id(work["primary_topic"]) == CS_FIELD, F.lit(False)) | F.exists(topics, lambda t: field_id(t) == CS_FIELD)


def topic_categories(work: Column) -> Column:
    named = F.filter(F.transform(F.coalesce(work["topics"], F.array()), lambda t: normalize(t["display_name"])), lambda n: n != "")
    primary = normalize(work["primary_topic"]["display_name"])
    tagged = F.transform(named, lambda n: F.concat(F.lit("openalex:"), n))
    return F.when(F.size(tagged) > 0, tagged).when(primary != "", F.array(F.concat(F.lit("openalex:"), primary))).otherwise(F.array(F.lit(DEFAULT_CATEGORY)))


def work_candidate(work: Column, least_citations: int = 21) -> tuple[Column, Column]:
    """The record of a paper, and whether it is accepted."""
    arxiv_id = work_arxiv_id(work)
    base, cited = strip_version(arxiv_id), F.coalesce(work["cited_by_count"], F.lit(0)).cast("bigint")
    record = F.struct(
        arxiv_id.alias("arxiv_id"),
        base.alias("arxiv_base_id"),
        F.coalesce(F.nullif(work["title"], F.lit("")), work["display_name"]).alias("title"),
        F.coalesce(work["publication_date"], F.lit("")).alias("submitted_at"),
        topic_categories(work).alias("categories"),
        cited.alias("cited_by_count"),
        F.concat(F.lit("https://arxiv.org/html/"), base).alias("html_url"),
        F.concat(F.lit("https://arxiv.org/pdf/"), arxiv_id).alias("pdf_url"),
        F.concat(F.lit("https://arxiv.org/abs/"), arxiv_id).alias("source_url"),
        work["primary_location"]["license"].alias("license"),
    )
    return record, F.coalesce(arxiv_id.isNotNull() & (cited >= least_citations) & is_cs_work(work), F.lit(False))


def arxiv_query(categories: list[str]) -> str:
    return " OR ".join(f"cat:{c}" for c in categories)
