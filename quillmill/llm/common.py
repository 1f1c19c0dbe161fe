"""Helpers that the operators of this subpackage share: Arrow access, row keys, checkpoints."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.sources.durable import bounded_batches, checkpoint_dir, discard, materialize  # noqa: F401

#: Stands for a null document id inside joins.
NULL_ID = -(1 << 63)

#: Base columns of the corpus table, in order.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver's data set."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(doc_id: str = "doc_id", text: str = "text"):
    """Second half of a document's key beside its id: rows that share an id but not the text differ."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def texts_of(column: pa.Array) -> list[str]:
    """Strings of an Arrow column; null is the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def slices(strings: pa.Array) -> list[bytes]:
    """Bytes of each of many strings without nulls, cut from one copy of their buffer."""
    data = strings.cast(pa.large_string())
    ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1].tolist()
    blob = data.buffers()[2].to_pybytes()
    return [blob[a:b] for a, b in zip(ends, ends[1:])]


def small_batches(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one holds about ``limit`` bytes of text (or one row)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0)).astype(np.int64)
        part = (np.cumsum(sizes) - 1).clip(0) // limit
        starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def hashed_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows (twice as many at most) whose hashed key is below a threshold.

    The threshold follows from the row count, so nothing is sorted and nothing but the sample moves.
    """
    total = df.count()
    if total <= rows:
        return df.limit(rows)
    bound = int(rows / total * 2**64) - 2**63
    return df.where(F.xxhash64(F.lit("sample"), F.col(key)) < bound).limit(2 * rows)


class BoundedCache:
    """A worker's cache of byte strings or numbers by key, in two generations.

    The newer one becomes the older one when it holds ``limit`` bytes, by estimate; what is looked up
    again moves to the newer.  So memory is bounded in bytes, whatever the keys, and frequent ones stay.
    """

    #: Bytes that an entry takes beside its characters: two objects and a slot.
    ENTRY = 190

    def __init__(self, limit: int):
        self.limit, self.size = limit, 0
        self.newer: dict = {}
        self.older: dict = {}

    def __len__(self) -> int:
        return len(self.newer) + len(self.older)

    def make_room(self) -> None:
        """Between two lookups: begin a generation if this one is full."""
        if self.size > self.limit:
            self.older, self.newer, self.size = self.newer, {}, 0

    def get_all(self, keys: list) -> list:
        """Values of the keys; None where there is none."""
        found = list(map(self.newer.get, keys))
        if self.older:
            get = self.older.get
            for i in [i for i, x in enumerate(found) if x is None]:
                if (old := get(keys[i])) is not None:
                    self.put(keys[i], old)
                    found[i] = old
        return found

    def put(self, key, value) -> None:
        self.newer[key] = value
        self.size += self.ENTRY + len(key) + (len(value) if isinstance(value, bytes) else 0)


_held: dict[str, object] = {}


def held(name: str, make: Callable[[], object]):
    """What a worker keeps for the next task of the same operator, such as a tokenizer and its cache."""
    if name not in _held:
        _held[name] = make()
    return _held[name]


def let_go(keeps: str | None) -> None:
    """Drop what operators other than ``keeps`` hold in this worker."""
    for name in [x for x in _held if x != keeps]:
        del _held[name]


def give_back() -> None:
    """Return this worker's free memory to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str | None = None):
    """``run`` for ``mapInArrow`` in workers that Spark reuses: what other operators hold is let go
    before, and memory that is free goes back to the system after."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(keeps)
        try:
            yield from run(batches)
        finally:
            give_back()

    return mapped


def with_text_key(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``did, rh, text``: never-null keys of a document.  Null ids share the smallest long."""
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("did"), row_key(doc_id, text).alias("rh"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def attach(docs: DataFrame, notes: DataFrame, how: str = "left") -> DataFrame:
    """Join ``notes`` (one row per ``did, rh``) to documents, both dealt by key at every size.

    Notes grow with the corpus, so they are never broadcast; adaptive execution splits partitions
    that skewed keys make large.
    """
    return docs.join(notes.hint("shuffle_merge"), ["did", "rh"], how)


def fits_broadcast(df: DataFrame, bytes_per_row: int, limit_bytes: int = 16 << 20) -> bool:
    """Whether a table counted now stays below a broadcast limit.  Call on a materialized table."""
    return df.count() * bytes_per_row <= limit_bytes


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 over uint64 values: spreads entropy over all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
