"""Token counts: map-side two-tier lookup of pre-token lengths.

Tier one is a compact table of frequent pre-tokens, found in a bounded sample and broadcast: one
UTF-8 blob, end offsets, and a byte per length.  Tier two is a cache in each Python worker, filled
by encoding the pre-tokens that tier one misses.  No pre-token is ever shuffled, so one common word
is no hot key, and the plan has no exchange.

The byte-level pre-tokenizer's pattern is matched here by :mod:`regex`.  Where Unicode versions could
differ, in rare characters from U+3000 on, a text is cut before each run of white space, which always
begins a pre-token, and these segments take the place of pre-tokens; so counts equal the library's for
every text.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import BoundedCache, bytes_of, hashed_sample, held, small_batches, texts_of, tidied

#: Fixed value: the byte-level BPE pre-tokenizer's published pattern.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of text that are counted at once, whatever the length of a text.
PART = 2_000_000
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def load_tokenizer(path: str):
    """The tokenizer of a file, single-threaded."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pack_table(lengths: dict[str, int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Compact form of ``pre-token -> number of tokens``."""
    keys = sorted(lengths)
    encoded = [k.encode() for k in keys]
    return b"".join(encoded), np.cumsum([len(x) for x in encoded], dtype=np.uint32), np.array([lengths[k] for k in keys], np.uint16)


def unpack_table(table: tuple[bytes, np.ndarray, np.ndarray]) -> dict[str, int]:
    blob, ends, lengths = table
    starts = [0, *ends.tolist()]
    return {blob[a:b].decode(): n for a, b, n in zip(starts, starts[1:], lengths.tolist())}


#: Characters whose class no version of Unicode has changed: kana, common Han, Hangul syllables,
#: full-width forms, variation selectors and pictographs.
STABLE = "\u3000-\u303e\u3041-\u3096\u309d-\u309f\u30a1-\u30ff\u4e00-\u9fa5\uac00-\ud7a3\ufe00-\ufe0f\uff01-\uff5e\U0001f300-\U0001faff"
#: White space of every version of Unicode.
WHITE = "\\x09-\\x0d\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


class PreTokenCounter:
    """Counts a text's tokens from the lengths of its pre-tokens; exact for any text."""

    def __init__(self, path: str, table=None, cache_bytes: int = 32 << 20):
        import regex

        self.path, self.tokenizer = path, load_tokenizer(path)
        self.findall = regex.compile(BYTE_LEVEL_PATTERN).findall
        self.unusual = regex.compile(f"[^\x00-\u2fff{STABLE}]").search
        self.segments = regex.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.table, self.frequent = table, unpack_table(table) if table else {}
        self.cache = BoundedCache(cache_bytes)

    def pre_tokens(self, text: str) -> list[str]:
        return self.segments(text) if self.unusual(text) else self.findall(text)

    def lengths(self, keys: list[str]) -> dict[str, int]:
        """Tokens of each of these pre-tokens: from the frequent ones, the cache, or the tokenizer."""
        known = {x: n for x in keys if (n := self.frequent.get(x)) is not None}
        rest = [x for x in keys if x not in known]
        self.cache.make_room()
        missed = []
        for x, n in zip(rest, self.cache.get_all(rest)):
            if n is None:
                missed.append(x)
            else:
                known[x] = n
        for k in range(0, len(missed), 4096):
            some = missed[k : k + 4096]
            for x, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                known[x] = len(e.ids)
                if len(x) <= 64:
                    self.cache.put(x, known[x])
        return known

    def count(self, texts: list[str]) -> list[int]:
        totals = [0] * len(texts)
        parts: list[tuple[int, list[str]]] = []
        for i, text in enumerate(texts):
            pieces = [text]
            if self.specials and self.specials.search(text):
                totals[i] += len(self.specials.findall(text))
                pieces = self.specials.split(text)
            parts += [(i, self.pre_tokens(piece)) for piece in pieces if piece]
        distinct: set[str] = set()
        for _, found in parts:
            distinct.update(found)
        lengths = self.lengths(list(distinct))
        for i, found in parts:
            totals[i] += sum(map(lengths.__getitem__, found))
        return totals

    def count_long(self, text: str) -> int:
        """Count of one very long text, in parts that begin with a run of white space."""
        total, at = 0, 0
        while len(text) - at > PART:
            cut = next((m.start() for m in self.breaks(text, at + PART)), len(text))
            total += self.count([text[at:cut]])[0]
            at = cut
        return total + self.count([text[at:]])[0]

    def breaks(self, text: str, at: int):
        """Places from ``at`` on where a plain letter is followed by one space and a plain letter."""
        import re

        return re.compile(r"(?<=[a-z]) (?=[a-z])").finditer(text, at)


def worker_counter(path: str, table) -> PreTokenCounter:
    """The Python worker's counter, whose cache outlives a task; the table may differ by query."""
    counter = held("token_counts", lambda: PreTokenCounter(path, table))
    if counter.path != path:
        counter.__init__(path, table)
    if counter.table is not table:
        counter.table, counter.frequent = table, unpack_table(table)
    return counter


def frequent_table(docs: DataFrame, path: str, sample_rows: int = 400, sample_bytes: int = 16_384, entries: int = 32_768, doc_id: str = "doc_id", text: str = "text"):
    """Table of the most frequent pre-tokens in a bounded sample of documents.

    The sample is about ``sample_rows`` documents chosen by hashed id (twice as many at most), of
    which those of at most ``sample_bytes`` bytes count.  It only decides which lengths are broadcast, never a count's value; the table has
    at most ``entries`` entries whatever the corpus holds.
    """
    picked = hashed_sample(docs.select(F.col(doc_id).alias("doc_id"), F.when(F.octet_length(text) <= sample_bytes, F.col(text)).alias("text")), "doc_id", sample_rows)
    sample = [row for row in picked.select("text").collect() if row.text]
    counter = PreTokenCounter(path)
    seen = Counter(x for row in sample for piece in (counter.specials.split(row.text) if counter.specials else [row.text]) for x in counter.pre_tokens(piece) if len(x) <= 64)
    common = [x for x, _ in sorted(seen.items(), key=lambda kv: (-kv[1], kv[0]))[:entries]]
    lengths = [len(e.ids) for e in counter.tokenizer.encode_batch_fast(common, add_special_tokens=False)] if common else []
    return pack_table(dict(zip(common, lengths)))


def count_tokens(docs: DataFrame, tokenizer_path: str | None = None, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row of ``docs``.

    Null and empty texts have 0 bytes and 0 tokens.  Repeated rows and null ids give a row each.
    Special strings inside a text are single tokens, as the library's default has it; no begin or end
    token is added.  An empty table gives an empty result.
    """
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    table = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, path, doc_id=doc_id, text=text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(path, table.value)
        for batch in small_batches(batches, limit=PART):
            texts = texts_of(batch.column("text"))
            counts = np.array(counter.count(texts) if len(texts) > 1 else [counter.count_long(texts[0])], np.int64)
            sizes = pa.array([len(x) for x in bytes_of(batch.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, pa.array(counts), pa.array(counts > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(tidied(run, "token_counts"), SCHEMA)
