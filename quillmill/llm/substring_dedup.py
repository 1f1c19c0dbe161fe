"""Substring dedup by content-defined chunking.

A gear rolling hash over the last 16 bytes decides chunk ends, so that an insertion moves ends only
near itself.  Ends fall after white space (or after a multi-byte character of scripts without it),
hence words stay whole.  A chunk is known by its digest and that of the chunk after it, 64 bits each;
it is a repeat when an earlier document, or an earlier place of its own, has the same chunk followed
by the same.  So neighbours are cut together only where they repeat as neighbours.  Runs of repeats
of at least ``min_run`` bytes are cut; a lone common phrase is left alone.

Documents are ordered by id, then by the hash of their text, then by row: of rows that are equal in
id and text one is the first, the others repeat it whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import NULL_ID, attach, bytes_of, discard, materialize, mix64, small_batches, tidied, with_text_key

CHUNKS = "h1 long, h2 long, did long, rh long, place long"
#: Bits of ``place`` below the offset: 12 for the length, one for "seen before in this document".
LENGTH_BITS, PLACE_BITS = 12, 13


def gear_table() -> np.ndarray:
    """A random 16-bit value for each byte; 0 for the padding byte."""
    table = (mix64(np.arange(256, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.uint16)
    table[0] = 0
    return table


def gear_hash(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``h = (h << 1) + gear[byte]`` modulo 2**16 at every byte, by doubling the window four times."""
    h = table[data]
    for step in (1, 2, 4, 8):
        h[step:] = h[step:] + (h[:-step] << np.uint16(step))
    return h


def chunk_ends(data: np.ndarray, table: np.ndarray, spread: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions after which the content allows a cut, one in ``2**spread`` word ends; all word ends
    (and, sparsely, ends of characters of three bytes or more); the hash at each of the latter."""
    h = gear_hash(data, table)
    possible = (data == 32) | ((data >= 9) & (data <= 13))
    following = np.append(data[1:], 32)
    third = np.zeros(len(data), bool)
    third[2:] = data[:-2] >= 0xE0
    wide = third & (data >= 0x80) & ((following & 0xC0) != 0x80)
    allowed = (possible & (h < (1 << (16 - spread)))) | (wide & (h < (1 << 11)))
    possible |= wide
    ends = np.flatnonzero(possible)
    return np.flatnonzero(allowed) + 1, ends + 1, h[ends]


def cut_document(start: int, end: int, allowed: list[int], data: bytes, smallest: int, largest: int, possible: np.ndarray, hashes: np.ndarray) -> list[int]:
    """Ends of the chunks of ``data[start:end]``: allowed ends, kept between the two sizes.

    Where none comes in time, as in text that repeats one word, the possible end with the smallest
    hash is taken, the first of equals; only without any is a cut put by length alone.
    """
    ends, last = [], start
    for p in [*allowed, end]:
        if p - last < smallest and p != end:
            continue
        while p - last > largest:
            lo, hi = np.searchsorted(possible, [last + smallest, last + largest], "left")
            if lo < hi:
                cut = int(possible[lo + hashes[lo:hi].argmin()])
            else:
                cut = last + largest
                while cut > last + 1 and data[cut] & 0xC0 == 0x80:
                    cut -= 1
            ends.append(cut)
            last = cut
        if p > last:
            ends.append(p)
            last = p
    return ends


def chunk_batch(texts: list[bytes], table: np.ndarray, spread: int, smallest: int, largest: int):
    """Of each chunk of a batch: document number, offset, length with the chunk after it, and the
    digests of both (n x 2 int64); the end of a text counts as an empty chunk with digest 0."""
    pad = b"\0" * 16
    joined = b"".join(x for t in texts for x in (t, pad))
    data = np.frombuffer(joined, np.uint8)
    allowed, possible, hashes = chunk_ends(data, table, spread)
    starts = np.cumsum([0, *(len(t) + 16 for t in texts)])[:-1]
    stops = starts + np.array([len(t) for t in texts])
    lo, hi = np.searchsorted(allowed, starts, "right"), np.searchsorted(allowed, stops, "left")
    allowed = allowed.tolist()
    number, offsets, lengths, digests = [], [], [], []
    digest = xxhash.xxh3_64_intdigest
    for i, (a, b) in enumerate(zip(starts.tolist(), stops.tolist())):
        if a == b:
            continue
        ends = cut_document(a, b, allowed[lo[i] : hi[i]], joined, smallest, largest, possible, hashes)
        begins = [a, *ends[:-1]]
        own = [digest(joined[x:y]) for x, y in zip(begins, ends)]
        digests += zip(own, [*own[1:], 0])
        number += [i] * len(ends)
        offsets += [x - a for x in begins]
        lengths += [y - x for x, y in zip(begins, [*ends[1:], ends[-1]])]
    return np.array(number, np.int64), np.array(offsets, np.int64), np.array(lengths, np.int64), np.array(digests, np.uint64).view(np.int64).reshape(-1, 2)


def chunks(keyed: DataFrame, spread: int, smallest: int, largest: int) -> DataFrame:
    """A row per chunk of the keyed documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = gear_table()
        for batch in small_batches(batches, limit=2_000_000):
            number, offsets, lengths, digests = chunk_batch(bytes_of(batch.column("text")), table, spread, smallest, largest)
            if not len(number):
                continue
            h1, h2 = digests[:, 0], digests[:, 1]
            order = np.lexsort((offsets, h2, h1, number))
            again = np.zeros(len(order), np.int64)
            x, y = order[1:], order[:-1]
            again[x] = (number[x] == number[y]) & (h1[x] == h1[y]) & (h2[x] == h2[y])
            place = (offsets << PLACE_BITS) | (lengths << 1) | again
            did, rh = (np.asarray(batch.column(c))[number] for c in ("did", "rh"))
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (h1, h2, did, rh, place)], ["h1", "h2", "did", "rh", "place"])

    return keyed.mapInArrow(tidied(run), CHUNKS)


def shared_ids(keyed: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Ids whose rows have several texts (``did``), and rows that are there several times (``did, rh``);
    None where every id has one row."""
    often = materialize(keyed.groupBy("did").agg(F.count("*").alias("n"), F.min("rh").alias("a"), F.max("rh").alias("b")).where("n > 1"), "chunk-ids")
    if often.isEmpty():
        discard(often)
        return None
    several = materialize(often.where("a <> b").select("did"), "chunk-several")
    keys = keyed.select("did", "rh").join(often.select("did").hint("shuffle_merge"), "did", "left_semi")
    again = materialize(keys.groupBy("did", "rh").agg(F.count("*").alias("n")).where("n > 1").select("did", "rh"), "chunk-again")
    discard(often)
    return several, again


def repeated_places(keyed: DataFrame, several: DataFrame | None, spread: int, smallest: int, largest: int) -> DataFrame:
    """``did, rh, places``: each document's chunks that repeat an earlier one.  A written table."""
    every = chunks(keyed, spread, smallest, largest)
    shared = materialize(every.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("did").alias("first_did")).where("n > 1").drop("n"), "chunk-shared")
    used = [shared]
    repeats = every.join(shared.hint("shuffle_merge"), ["h1", "h2"]).where("did > first_did or place % 2 = 1").select("did", "rh", "place")
    if several is not None and not several.isEmpty():  # documents that share the first id: the smallest hash comes first
        some = chunks(keyed.join(several.hint("shuffle_merge"), "did", "left_semi"), spread, smallest, largest)
        tied = materialize(some.where("place % 2 = 0").join(shared.hint("shuffle_merge"), ["h1", "h2"]).where("did = first_did"), "chunk-tied")
        first = materialize(tied.groupBy("h1", "h2").agg(F.min("rh").alias("first_rh")), "chunk-first")
        repeats = repeats.union(tied.join(first.hint("shuffle_merge"), ["h1", "h2"]).where("rh > first_rh").select("did", "rh", "place"))
        used += [tied, first]
    out = materialize(repeats.groupBy("did", "rh").agg(F.collect_set("place").alias("places")), "chunk-places")
    discard(*used)
    return out


def runs_of(places: np.ndarray, min_run: int) -> list[tuple[int, int]]:
    """Maximal runs of at least ``min_run`` bytes of chunks and the ones after them that overlap."""
    if not len(places):
        return []
    places = np.sort(places)
    begin = places >> PLACE_BITS
    end = begin + ((places >> 1) & ((1 << LENGTH_BITS) - 1))
    breaks = np.flatnonzero(begin[1:] >= end[:-1]) + 1
    first, last = np.append(0, breaks), np.append(breaks, len(places)) - 1
    return [(a, b) for a, b in zip(begin[first].tolist(), end[last].tolist()) if b - a >= min_run]


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return b"".join(kept)


def noted_rows(docs: DataFrame, doc_id: str, text: str, spread: int, smallest: int, largest: int) -> DataFrame:
    """``row, places, again``: each row of ``docs`` as a struct, its repeated chunks, and whether an
    equal row came before it."""
    keyed = with_text_key(docs, doc_id, text)
    several, again = shared_ids(keyed) or (None, None)
    places = repeated_places(keyed, several, spread, smallest, largest)
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("did"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("rh"))
    once = F.lit(False).alias("again")
    if again is None or again.isEmpty():
        return attach(own, places).select("row", "places", once)
    single = attach(attach(own, again, "left_anti"), places).select("row", "places", once)
    equal = materialize(attach(own, again, "left_semi").withColumn("at", F.monotonically_increasing_id()), "chunk-equal")
    first = materialize(equal.groupBy("did", "rh").agg(F.min("at").alias("first_at")), "chunk-first-row")
    return single.union(attach(attach(equal, first, "inner"), places).select("row", "places", (F.col("at") > F.col("first_at")).alias("again")))


def spans_to_cut(size: int, places: list[int] | None, again: bool, min_run: int) -> list[tuple[int, int]]:
    """Spans of a text of ``size`` bytes; a row that repeats an equal one goes whole if long enough."""
    if again:
        return [(0, size)] if size >= min_run else []
    return runs_of(np.array(places or [], np.int64), min_run)


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_run: int = 96, spread: int = 2, smallest: int = 16, largest: int = 160) -> DataFrame:
    """``doc_id, text, n_bytes, n_removed, n_spans, kept_sha256`` of each row, repeats cut out.

    ``text`` is what is left.  The first copy of a passage, in order of id, text hash, row and place,
    stays whole.  A null text counts as empty and stays null.  Rows with a null id come first, among
    themselves in order of the text hash.  An empty table gives an empty result.
    """
    noted = noted_rows(docs, doc_id, text, spread, smallest, largest)
    joined = noted.select(F.col("row")[doc_id].cast("long").alias("doc_id"), F.col("row")[text].isNull().alias("no_text"), F.coalesce(F.col("row")[text], F.lit("")).alias("text"), "places", "again")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = []
            for d, gone, t, p, again in zip(batch.column("doc_id").to_pylist(), batch.column("no_text").to_pylist(), bytes_of(batch.column("text")), batch.column("places").to_pylist(), batch.column("again").to_pylist()):
                spans = spans_to_cut(len(t), p, again, min_run)
                kept = cut_spans(t, spans)
                out.append((d, None if gone else kept.decode(), len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(tidied(run), "doc_id long, text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", min_run: int = 96, spread: int = 2, smallest: int = 16, largest: int = 160) -> DataFrame:
    """``docs``, with all its columns, its texts without repeats and ``n_chars`` counted anew.

    Every row stays; a text that is all repeats becomes empty, a null text stays null.  A written table,
    so that the Arrow batches of whole rows are bounded.
    """
    names, kinds = docs.columns, docs.schema
    joined = noted_rows(docs, doc_id, text, spread, smallest, largest).select(*[F.col("row")[c].alias(c) for c in names], F.col("places").alias("repeat_places"), F.col("again").alias("repeat_row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            places, again = (batch.column(len(names) + k).to_pylist() for k in (0, 1))
            texts = batch.column(names.index(text)).to_pylist()
            kept, changed = list(texts), [False] * len(texts)
            for i, t in enumerate(texts):
                if t is not None and (places[i] or again[i]):
                    data = t.encode()
                    kept[i] = cut_spans(data, spans_to_cut(len(data), places[i], again[i], min_run)).decode()
                    changed[i] = len(kept[i]) < len(t)
            columns = [batch.column(k) for k in range(len(names))]
            columns[names.index(text)] = pa.array(kept, columns[names.index(text)].type)
            if n_chars in names:
                at = names.index(n_chars)
                columns[at] = pa.array([len(t) if c else old for old, t, c in zip(columns[at].to_pylist(), kept, changed)], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return materialize(joined.mapInArrow(tidied(run), kinds), "without-repeats")
