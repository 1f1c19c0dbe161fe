"""Suffix-array dedup: remove every byte covered by a string of ``length`` bytes that starts twice.

The exact answer over all documents is reached in three steps.

1. Anchors.  Each window of ``length`` bytes is assigned to the minimizer (smallest hash, leftmost)
   among its ``gram``-byte strings.  Equal windows choose equal minimizers at equal offsets, so a
   window can only repeat within its anchor's hash.  Successive windows share an anchor: a document
   has about ``2 / (length - gram)`` anchors a byte, each with a range of window starts.  The anchors
   of shorter windows (``short`` bytes), of which the former are some, are noted along: one that also
   stands elsewhere tells of a repeat that is too short to be removed.
2. Ranges.  A range whose whole extent (first start to last end) occurs twice by a 128-bit digest
   is repeated in all its windows; the inside of every copied passage is settled so, without pairs.
3. Suffix array.  What is left are ranges at the rims of passages.  Their extents are laid out
   anchor hash by anchor hash, and a suffix array of each slab is built by bucket-pointer refinement:
   q-gram buckets, refined by sorting on the bucket pointers of later offsets, with the updated
   pointers used by the next round, until windows of ``length`` bytes are told apart.  An anchor
   hash with more extents than a slab holds is settled by counting its windows' digests instead,
   with map-side combining, so that no task ever gathers such a group.
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
from quillmill.llm.substring_dedup import cut_spans

ANCHORS = "kh long, e1 long, e2 long, did long, rh long, place long"
#: Bits of ``place`` below the first start: the number of starts.
COUNT_BITS = 12
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
#: Bytes that are hashed at once; longer documents go in overlapping sections.
SECTION = 1 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, BASE, np.uint64)]))
        down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)]))
    return up, down


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` successive values, by doubling."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if span < width:
        out = np.minimum(out[: len(out) - (width - span)], out[width - span :])
    return out


class AnchorFinder:
    """Anchors and start ranges of the windows of a buffer."""

    def __init__(self, length: int, gram: int, short: int):
        self.length, self.gram, self.short = length, gram, short
        self.up, self.down = powers(0)

    def ranked(self, data: np.ndarray) -> np.ndarray:
        """Mixed hash of the gram at each position, its last 24 bits the position itself."""
        n = len(data)
        if len(self.up) <= n:
            self.up, self.down = powers(n)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.down[:n])])
            grams = (sums[self.gram :] - sums[: -self.gram]) * self.up[: n - self.gram + 1]
        return (mix64(grams) & np.uint64(MASK ^ 0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)

    def anchors(self, ranked: np.ndarray, window: int) -> np.ndarray:
        """For each start of a window of so many bytes, the position of its anchor."""
        return (window_minima(ranked, window - self.gram + 1) & np.uint64(0xFFFFFF)).astype(np.int64)

    def sections(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes, list[tuple[int, int, int, int, bool]]]]:
        """Buffers below ``SECTION`` bytes with their parts: document, offset in it, begin, end, whether
        it is the document's last part."""
        parts, held, size = [], [], 0
        for i, t in enumerate(texts):
            if len(t) < self.short:
                continue
            step = SECTION - self.length + 1
            for at in range(0, max(1, len(t) - self.length + 1), step):
                piece = t[at : at + SECTION]
                if size + len(piece) > SECTION and parts:
                    joined = b"".join(held)
                    yield np.frombuffer(joined, np.uint8), joined, parts
                    parts, held, size = [], [], 0
                parts.append((i, at, size, size + len(piece), at + SECTION >= len(t)))
                held.append(piece)
                size += len(piece)
        if parts:
            joined = b"".join(held)
            yield np.frombuffer(joined, np.uint8), joined, parts

    def ranges(self, texts: list[bytes]):
        """Of each anchor: document, first start, number of starts, anchor hash, extent digest.

        An anchor of short windows only has its own position, no starts, and no digest.
        """
        gram_hash, digest = xxhash.xxh3_64_intdigest, xxhash.xxh3_128_digest
        number, first, count, keys, digests = [], [], [], [], []
        for data, joined, parts in self.sections(texts):
            ranked = self.ranked(data)
            long, small = self.anchors(ranked, self.length) if len(data) >= self.length else None, self.anchors(ranked, self.short)
            for i, at, begin, end, last in parts:
                places = distinct_runs(small[begin : (end - self.short if last else end - self.length) + 1])[0]
                starts, counts, where = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
                if end - begin >= self.length:
                    of, starts, counts = distinct_runs(long[begin : end - self.length + 1])
                    places = np.union1d(places, of)  # at the end of a part that is not the last
                    where = np.searchsorted(places, of)
                own_first, own_count = places - begin + at, np.zeros(len(places), np.int64)
                own_first[where], own_count[where] = starts + at, counts
                own = np.zeros((len(places), 2), np.int64)
                if len(where):
                    begins = (starts + begin).tolist()
                    own[where] = np.frombuffer(b"".join([digest(joined[a : a + n - 1 + self.length]) for a, n in zip(begins, counts.tolist())]), "<i8").reshape(-1, 2)
                keys += [gram_hash(joined[p : p + self.gram]) for p in places.tolist()]
                number.append(np.full(len(places), i))
                first.append(own_first)
                count.append(own_count)
                digests.append(own)
        if not number:
            return (np.zeros(0, np.int64),) * 4 + (np.zeros((0, 2), np.int64),)
        return np.concatenate(number), np.concatenate(first), np.concatenate(count), np.array(keys, np.uint64).view(np.int64), np.concatenate(digests)


def distinct_runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value, start and length of each run of equal neighbours."""
    change = np.flatnonzero(values[1:] != values[:-1]) + 1
    starts = np.concatenate([[0], change]) if len(values) else np.zeros(0, np.int64)
    return values[starts], starts, np.diff(np.append(starts, len(values)))


def anchor_rows(keyed: DataFrame, length: int, gram: int, short: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = AnchorFinder(length, gram, short)
        for batch in small_batches(batches, limit=2_000_000):
            number, first, count, keys, digests = finder.ranges(bytes_of(batch.column("text")))
            if not len(number):
                continue
            did, rh = (np.asarray(batch.column(c))[number] for c in ("did", "rh"))
            columns = (keys, np.ascontiguousarray(digests[:, 0]), np.ascontiguousarray(digests[:, 1]), did, rh, (first << COUNT_BITS) | count)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kh", "e1", "e2", "did", "rh", "place"])

    return keyed.where(F.octet_length("text") >= short).mapInArrow(tidied(run), ANCHORS)


def refine_buckets(data: np.ndarray, depth: int, q: int = 8) -> np.ndarray:
    """Bucket pointer of each position by its first ``depth`` bytes: equal pointers, equal strings.

    Bucket-pointer refinement.  A bucket's pointer is the index of its last entry in the suffix
    array.  Each round sorts the buckets that hold more than one position by the pointers of the
    positions ``known`` bytes later, gives their parts new pointers, and so doubles ``known``; the last
    round overlaps the one before.  Positions nearer than ``depth`` bytes to the end compare as if
    zero bytes followed.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(q, np.uint8)]).astype(np.uint64)
    grams = np.zeros(n, np.uint64)
    for k in range(q):
        grams = (grams << np.uint64(8)) | padded[k : k + n]
    array = np.argsort(grams, kind="stable")
    ordered = grams[array]
    ends = np.append(np.flatnonzero(ordered[1:] != ordered[:-1]), n - 1)
    sizes = np.diff(np.append(-1, ends))
    pointer = np.empty(n, np.int64)
    pointer[array] = np.repeat(ends, sizes)
    known = q
    active = np.repeat(sizes > 1, sizes)
    while known < depth and active.any():
        step = min(known, depth - known)
        slots = np.flatnonzero(active)
        positions = array[slots]
        later = positions + step
        key = np.where(later < n, pointer[np.minimum(later, n - 1)], -1)
        old = pointer[positions]
        order = np.lexsort((key, old))
        positions, key, old = positions[order], key[order], old[order]
        array[slots] = positions
        split = np.append((key[1:] != key[:-1]) | (old[1:] != old[:-1]), True)
        bounds = np.flatnonzero(split)
        lengths = np.diff(np.append(-1, bounds))
        pointer[positions] = np.repeat(slots[bounds], lengths)
        active[slots] = np.repeat(lengths > 1, lengths)
        known += step
    return pointer


def repeated_starts(contexts: list[bytes], weights: list[int], length: int) -> list[np.ndarray]:
    """For each context, the starts of windows whose total weight over all contexts is 2 or more."""
    data = np.frombuffer(b"".join(contexts), np.uint8)
    pointer = refine_buckets(data, length)
    begins = np.cumsum([0, *map(len, contexts)])[:-1]
    counts = [len(c) - length + 1 for c in contexts]
    at = np.concatenate([np.arange(b, b + c) for b, c in zip(begins.tolist(), counts)])
    owner = np.repeat(np.arange(len(contexts)), counts)
    total = np.bincount(pointer[at], weights=np.array(weights, np.float64)[owner])
    twice = total[pointer[at]] >= 2
    offsets = at - begins[owner]
    cuts = np.cumsum([0, *counts])
    return [offsets[a:b][twice[a:b]] for a, b in zip(cuts, cuts[1:])]


def covered(starts: np.ndarray, base: int, length: int) -> list[tuple[int, int]]:
    """Merged byte runs that windows at ``base + starts`` cover."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > length) + 1
    first, last = np.append(0, breaks), np.append(breaks, len(starts)) - 1
    return [(base + int(starts[a]), base + int(starts[b]) + length) for a, b in zip(first, last)]


def settle_slabs(length: int, slab_bytes: int):
    """Arrow function over rows sorted by anchor hash: suffix arrays of slabs of whole hashes."""

    def solve(rows: list[tuple]) -> list[tuple]:
        seen, unique = set(), []
        for r in rows:  # a document's row may stand more than once in the input
            if (r[0], r[1], r[2], r[3]) not in seen:
                seen.add((r[0], r[1], r[2], r[3]))
                unique.append(r)
        found = repeated_starts([r[5] for r in unique], [r[4] for r in unique], length)
        return [(r[1], r[2], a, b) for r, s in zip(unique, found) if r[4] == 1 for a, b in covered(s, r[3] >> COUNT_BITS, length)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def emit(rows):
            out = solve(rows)
            columns = list(zip(*out)) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["did", "rh", "begin", "stop"])

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("kh", "did", "rh", "place", "weight", "context"))):
                if size > slab_bytes and held[-1][0] != r[0]:
                    yield emit(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[5])
        if held:
            yield emit(held)

    return run


def contexts(keyed: DataFrame, needed: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """``kh, did, rh, place, weight, context``: the bytes of each needed range's extent; and the
    written table that they are read by."""
    per_document = materialize(needed.groupBy("did", "rh").agg(F.collect_list(F.struct("kh", "place", "weight")).alias("ranges")), "suffix-needed")
    joined = attach(keyed, per_document, "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = []
            for did, rh, t, ranges in zip(batch.column("did").to_pylist(), batch.column("rh").to_pylist(), bytes_of(batch.column("text")), batch.column("ranges").to_pylist()):
                for r in ranges:
                    a, count = r["place"] >> COUNT_BITS, r["place"] & ((1 << COUNT_BITS) - 1)
                    out.append((r["kh"], did, rh, r["place"], r["weight"], t[a : a + count - 1 + length]))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 5 + [pa.binary()])], ["kh", "did", "rh", "place", "weight", "context"])

    return joined.select("did", "rh", "text", "ranges").mapInArrow(tidied(run), "kh long, did long, rh long, place long, weight long, context binary"), per_document


def window_digests(length: int):
    """Arrow function: a row for each window of each context, for anchor hashes beyond a slab."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            did, rh, place, weight = (np.asarray(batch.column(c)) for c in ("did", "rh", "place", "weight"))
            texts = batch.column("context").to_pylist()
            counts = [len(c) - length + 1 for c in texts]
            keys = np.frombuffer(b"".join([digest(c[i : i + length]) for c, n in zip(texts, counts) for i in range(n)]), "<i8").reshape(-1, 2)
            owner = np.repeat(np.arange(len(texts)), counts)
            start = np.concatenate([np.arange(n) for n in counts]) + (place >> COUNT_BITS)[owner]
            columns = (np.ascontiguousarray(keys[:, 0]), np.ascontiguousarray(keys[:, 1]), did[owner], rh[owner], start, weight[owner])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["w1", "w2", "did", "rh", "begin", "weight"])

    return run


def removed_spans(keyed: DataFrame, length: int, gram: int, short: int, slab_bytes: int, slab_ranges: int) -> DataFrame:
    """``did, rh, spans, n_repeats``: byte spans (``begin``, ``stop``) to remove, not yet merged, and the
    number of anchors that also stand elsewhere.  A written table."""
    every = anchor_rows(keyed, length, gram, short)
    shared = materialize(every.groupBy("kh").agg(F.count("*").alias("n")).where("n > 1").select("kh"), "suffix-shared")
    hits = materialize(every.join(shared.hint("shuffle_merge"), "kh"), "suffix-anchors")
    discard(shared)
    starts = F.col("place").bitwiseAND((1 << COUNT_BITS) - 1)
    ranges = hits.where(starts > 0)
    classes = materialize(ranges.groupBy("kh", "e1", "e2").agg(F.count("*").alias("weight"), F.min(F.struct("did", "rh", "place")).alias("one")), "suffix-classes")
    repeated = classes.where("weight > 1").select("kh", "e1", "e2")
    inside = ranges.join(repeated.hint("shuffle_merge"), ["kh", "e1", "e2"]).select("did", "rh", F.shiftright("place", COUNT_BITS).alias("begin"), (F.shiftright("place", COUNT_BITS) + starts - 1 + length).alias("stop"))
    groups = materialize(classes.groupBy("kh").agg(F.count("*").alias("ranges"), F.min("weight").alias("least")).where("ranges > 1 and least = 1").select("kh", "ranges"), "suffix-groups")
    needed = materialize(classes.join(groups.hint("shuffle_merge"), "kh").select("kh", "one.*", "weight", "ranges"), "suffix-rims")
    rims, read = contexts(keyed, needed.where(F.col("ranges") <= slab_ranges), length)
    used = [hits, classes, groups, needed, read]
    settled = rims.repartition("kh").sortWithinPartitions("kh").mapInArrow(tidied(settle_slabs(length, slab_bytes)), "did long, rh long, begin long, stop long")
    spans = inside.union(settled)
    large = needed.where(F.col("ranges") > slab_ranges)
    if not large.isEmpty():
        extents, read = contexts(keyed, large, length)
        windows = materialize(extents.dropDuplicates(["kh", "did", "rh", "place"]).mapInArrow(tidied(window_digests(length)), "w1 long, w2 long, did long, rh long, begin long, weight long"), "suffix-windows")
        twice = materialize(windows.groupBy("w1", "w2").agg(F.sum("weight").alias("n")).where("n > 1").select("w1", "w2"), "suffix-twice")
        spans = spans.union(windows.where("weight = 1").join(twice.hint("shuffle_merge"), ["w1", "w2"]).select("did", "rh", "begin", (F.col("begin") + length).alias("stop")))
        used += [read, windows, twice]
    by_document = spans.groupBy("did", "rh").agg(F.collect_set(F.struct("begin", "stop")).alias("spans"))
    met = hits.groupBy("did", "rh").agg(F.count("*").alias("n_repeats"))
    out = materialize(met.join(by_document, ["did", "rh"], "left"), "suffix-spans")
    discard(*used)
    return out


def merge_spans(spans) -> list[tuple[int, int]]:
    """Union of spans as maximal runs."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def dedup_suffixes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, short: int | None = None, gram: int | None = None, slab_bytes: int = 2_000_000, slab_ranges: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, n_repeats`` of each row.

    ``kept`` holds the remaining bytes (a cut may fall inside a character, so it is binary).  A null
    or empty text has nothing to remove.  A repeated row is a document of its own: both rows lose
    what they share.  Rows with a null id take part like any others.  An empty table gives an empty
    result.

    ``n_repeats`` tells of repeats below ``length``, which are not removed: it counts the text's
    anchors (strings of ``gram`` bytes, half of ``short``) that also stand elsewhere.  Every string of
    ``short`` bytes (by default seven tenths of ``length``) that also starts elsewhere has one, and no
    string repeated for less than ``gram`` bytes does.  Rows that are equal count each other's.
    """
    short = short or max(1, 7 * length // 10)
    gram = gram or max(1, short // 2)
    keyed = with_text_key(docs, doc_id, text)
    notes = removed_spans(keyed, length, gram, short, slab_bytes, slab_ranges)
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("did"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("rh"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    joined = attach(own, notes).select("doc_id", "text", "spans", F.coalesce("n_repeats", F.lit(0)).cast("long").alias("n_repeats"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = []
            for d, t, s in zip(batch.column("doc_id").to_pylist(), bytes_of(batch.column("text")), batch.column("spans").to_pylist()):
                merged = merge_spans((x["begin"], x["stop"]) for x in s or ())
                kept = cut_spans(t, merged)
                out.append((d, len(t), len(t) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds)), batch.column("n_repeats")], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "n_repeats"])

    return joined.mapInArrow(tidied(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, n_repeats long")
