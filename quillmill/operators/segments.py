"""Packing paragraphs and sentences into segments without cutting mathematics.

Prose without ``$`` is packed by a native fold (:func:`pack_sentences`); paragraphs with mathematics
go through an Arrow UDF, since their spans are cut out recursively.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.hashing import split_name
from quillmill.functions.plain import section_name, spans, squeeze
from quillmill.functions.text import sentences

SEGMENTS = "array<struct<section: string, text: string>>"


class Shelf:
    """Pieces joined by single spaces, set down before they would outgrow ``limit``.

    An empty shelf counts a space after its first piece, a shelf that has just been set down does
    not: chunks begun on an empty shelf hold one character less.
    """

    def __init__(self, limit: int):
        self.limit, self.done, self.held, self.size = limit, [], [], 0

    def put(self, piece: str) -> None:
        full = bool(self.held) and self.size + len(piece) + 1 > self.limit
        if full:
            self.set_down()
        self.held.append(piece)
        self.size += len(piece) + (not full)

    def set_down(self) -> None:
        if self.held:
            self.done.append(" ".join(self.held))
        self.held, self.size = [], 0


def split_prose(text: str, limit: int) -> list[str]:
    shelf = Shelf(limit)
    for sentence in filter(None, (s.strip() for s in re.split(r"(?<=[.!?])\s+", text))):
        if len(sentence) <= limit:
            shelf.put(sentence)
        else:
            shelf.set_down()
            shelf.done += [sentence[k : k + limit] for k in range(0, len(sentence), limit)]
    shelf.set_down()
    return shelf.done


def split_long(text: str, limit: int) -> list[str]:
    """Chunks of at most ``limit`` characters; a span of mathematics is one chunk, however long."""
    parts = [(m, p.strip()) for m, p in spans(text) if p.strip()]
    if len(parts) < 2:
        return split_prose(text, limit)
    out: list[str] = []
    shelf = Shelf(limit)

    def empty(again: bool) -> None:
        out.extend(shelf.done)
        shelf.done = []
        if shelf.held:
            joined = " ".join(shelf.held)
            out.extend(split_long(joined, limit) if again else [joined])
            shelf.held, shelf.size = [], 0

    for is_math, part in parts:
        if is_math:
            empty(again=True)
            out.append(part)
        else:
            for chunk in split_long(part, limit):
                shelf.put(chunk)
    empty(again=False)
    return [c for c in out if c.strip()]


def fenced(text: str) -> str:
    """Prose with single spaces, block formulas between blank lines."""
    pieces = []
    for is_math, piece in spans(text):
        piece = piece.strip() if is_math else squeeze(piece)
        if piece:
            pieces.append(f"\n\n{piece}\n\n" if is_math and piece.startswith("$$") else piece)
    joined = re.sub(r"[ \t]*\n\n[ \t]*", "\n\n", " ".join(pieces))
    return re.sub(r"\n{3,}", "\n\n", joined).strip()


def pack_paragraphs(paragraphs: Iterable[str], least: int, target: int, most: int, keep_short: bool) -> list[str]:
    """Paragraphs of a section gathered up to ``target`` characters, longer ones than ``most`` split.

    Only what is left at the end, and chunks of split paragraphs, must have ``least`` characters; an
    abstract keeps a short rest.
    """
    out: list[str] = []
    held: list[str] = []

    def joined() -> str:
        return "\n\n".join(held)

    for paragraph in filter(None, map(fenced, paragraphs)):
        long = len(paragraph) > most
        if held and (long or len(joined()) + 2 + len(paragraph) > target):
            out.append(joined())
            held.clear()
        if long:
            out += [c for c in split_long(paragraph, most) if len(c) >= least]
        else:
            held.append(paragraph)
    if held and (keep_short or len(joined()) >= least):
        out.append(joined())
    return out


def segment_sections(sections: Column, least: int = 180, target: int = 1400, most: int = 1800) -> Column:
    """Segments of a document's sections, in order, with the section's canonical name."""

    @F.pandas_udf(SEGMENTS)
    def pack(column: pd.Series) -> pd.Series:
        def one(parts) -> list[dict]:
            return [{"section": section_name(s["heading"] or s["kind"] or "body"), "text": t} for s in (parts if parts is not None else []) for t in pack_paragraphs(s["paragraphs"], least, target, most, s["kind"] == "abstract")]

        return column.map(one)

    return pack(sections)


def segment_documents(documents: DataFrame, least: int = 180, target: int = 1400, most: int = 1800) -> DataFrame:
    """A row per segment of documents with ``arxiv_id, arxiv_base_id, title, html_url, cited_by_count, license, sections``."""
    cut = documents.select("*", F.posexplode(segment_sections(F.col("sections"), least, target, most)).alias("at", "segment"))
    return cut.select(
        F.format_string("%s_%s_%04d", "arxiv_id", F.col("segment.section"), F.col("at") + 1).alias("id"),
        F.col("segment.text").alias("source"),
        F.lit("cs_ai_paper").alias("domain"),
        split_name(F.col("arxiv_base_id"), 5, 5).alias("split"),
        F.struct(F.lit("arxiv").alias("source_dataset"), F.col("arxiv_id").alias("paper_id"), F.col("segment.section").alias("section"), "title", F.col("html_url").alias("source_url"), "cited_by_count", "license").alias("metadata"),
    )


def pack_sentences(text: Column, limit: int) -> Column:
    """Chunks of prose by a native fold with the rules of :class:`Shelf`."""
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("held"), F.lit(0).alias("size"))

    def step(s: Column, sentence: Column) -> Column:
        length, empty = F.length(sentence), s["held"] == ""
        slices = F.transform(F.sequence(F.lit(0), F.floor((length - 1) / limit).cast("int")), lambda k: F.substring(sentence, k * limit + 1, F.lit(limit)))
        flushed = F.when(empty, s["done"]).otherwise(F.array_append(s["done"], s["held"]))
        overflow = ~empty & (s["size"] + length + 1 > limit)
        return (
            F.when(length > limit, F.struct(F.concat(flushed, slices).alias("done"), F.lit("").alias("held"), F.lit(0).alias("size")))
            .when(overflow, F.struct(flushed.alias("done"), sentence.alias("held"), length.alias("size")))
            .otherwise(F.struct(s["done"].alias("done"), F.when(empty, sentence).otherwise(F.concat(s["held"], F.lit(" "), sentence)).alias("held"), (s["size"] + length + 1).alias("size")))
        )

    return F.aggregate(sentences(text), state, step, lambda s: F.when(s["held"] == "", s["done"]).otherwise(F.array_append(s["done"], s["held"])))
