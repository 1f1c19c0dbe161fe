"""LM scoring: context-tree weighting over bytes, beside a unigram base score.

Training counts every (five-byte context, byte) of the training documents, and every token.  A byte
is eight binary decisions; at each decision's node, the Krichevsky-Trofimov estimates of the
contexts of 0 to 5 bytes are mixed by context-tree weighting.  Every context that occurs is kept, so
the model grows with the corpus.  As training data are fixed when scoring begins, the weights are
too: contexts of three to five bytes are mixed where all that end in the same three bytes meet, those
of up to two bytes (at most 65,536) on the driver.  Documents stay in batches of some 24 MB; the
distinct grams of a batch are joined to their log probabilities and meet the batch's texts again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import bytes_of, discard, materialize, slices, small_batches, tidied

DEPTH = 5
#: Marks the begin (as context) and the end (as symbol) of a text; no UTF-8 text holds it.
EDGE = 0xFF
#: Bytes of the contexts that are mixed on the driver; longer ones are mixed by tasks.
TOP = 2
#: Grams that are mixed at once, more only where more end in the same bytes.
CHUNK = 200_000
FREQUENT = 1 << 18
BITS = [f"q{j}" for j in range(8)]
LAID = "batch long, row long, doc_id long, held_out boolean, text binary, key long, n long"
MIXED = "key long, " + ", ".join(f"{q} float" for q in BITS) + ", node long, zeros double, ones double, inside double"


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts between edges; the position of each one's first symbol, and of its end symbol."""
    begin, end = bytes([EDGE]) * DEPTH, bytes([EDGE])
    data = np.frombuffer(b"".join(x for t in texts for x in (begin, t, end)), np.uint8)
    sizes = np.array([len(t) + DEPTH + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes)
    return data, ends - sizes + DEPTH, ends - 1


def gram_keys(data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, byte) key that ends at each position from ``DEPTH`` on, and whether that is a symbol."""
    n = len(data) - DEPTH
    keys = np.zeros(n, np.int64)
    for k in range(DEPTH + 1):
        keys = (keys << 8) | data[k : k + n]
    symbol = np.ones(len(data), bool)
    symbol[(firsts[:, None] - 1 - np.arange(DEPTH)).ravel()] = False
    return keys, symbol[DEPTH:]


def gram_counts(data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (context, byte) keys of all symbols, and how often each occurs."""
    keys, symbol = gram_keys(data, firsts)
    return np.unique(keys[symbol], return_counts=True)


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Arrow batches joined until they hold ``limit`` bytes of text, so that short texts share grams."""
    held: list[pa.RecordBatch] = []
    for batch in small_batches(batches, limit=limit):
        held.append(batch)
        if sum(b.column("text").nbytes for b in held) >= limit:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def add_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One list of distinct keys and their counts from several sorted ones."""
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")  # merges sorted runs
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts[order], starts)


def lay_out(source: DataFrame, limit: int = 24_000_000, step: int = 3_000_000) -> DataFrame:
    """Documents in batches, each with its distinct grams and how often they occur in training rows.

    Rows hold either ``batch, row, doc_id, held_out, text`` (lower-cased) or ``batch, key, n``.  The
    larger a batch, the fewer grams there are to join.
    """

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["batch", "row", "doc_id", "held_out", "text", "key", "n"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64()]

        def rows(size: int, columns: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.nulls(size, k) if c is None else pa.array(c, k) for c, k in zip(columns, kinds)], names)

        def grams(batch: int, parts: list) -> pa.RecordBatch:
            keys, counts = add_up(parts)
            return rows(len(keys), [np.full(len(keys), batch), None, None, None, None, keys, counts])

        row = batch = TaskContext.get().partitionId() << 33
        parts, size = [], 0
        for table in gathered(tables, step):
            texts, held = [t.lower() for t in bytes_of(table.column("text"))], table.column("held_out").to_pylist()
            yield rows(len(texts), [np.full(len(texts), batch), np.arange(row, row + len(texts)), table.column("doc_id").to_pylist(), held, texts, None, None])
            row += len(texts)
            for side in (False, True):
                some = [t for t, h in zip(texts, held) if h == side]
                if some:
                    data, firsts, _ = laid_out(some)
                    keys, n = gram_counts(data, firsts)
                    parts.append((keys, n * 0 if side else n))
            size += sum(map(len, texts))
            if size >= limit:
                yield grams(batch, parts)
                batch, parts, size = row, [], 0
        if parts:
            yield grams(batch, parts)

    return source.mapInArrow(tidied(run), LAID)


def split_words(texts: pa.ChunkedArray) -> pa.ChunkedArray:
    """Words of lower-cased texts; Arrow's ASCII white space is just that of the words' definition.

    White space at an end leaves an empty word.
    """
    return pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))


def count_tokens(training: DataFrame) -> DataFrame:
    """``token, c`` over the words of training texts, combined in the worker too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, 8_000_000):
            counted = pc.list_flatten(split_words(pc.fill_null(table.column("text"), ""))).value_counts()
            tokens, counts = counted.field("values"), counted.field("counts")
            real = pc.not_equal(tokens, "")
            yield pa.RecordBatch.from_arrays([tokens.filter(real).cast(pa.binary()), counts.filter(real)], ["token", "n"])

    return training.select("text").mapInArrow(tidied(run), "token binary, n long").groupBy("token").agg(F.sum("n").alias("c"))


def most_frequent(counted: DataFrame, count: str, bound: int) -> DataFrame:
    """The rows with the highest counts, as many as fit the bound by whole steps of the count.

    A histogram over logarithmic steps decides the threshold, so nothing is sorted or gathered.
    """
    step = F.floor(F.log2(F.col(count).cast("double")) * 16)
    histogram = counted.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect()
    least, total = None, 0
    for row in sorted(histogram, key=lambda r: -r.step):
        total += row.rows
        if total > bound:
            break
        least = row.step
    return counted.where(step >= least) if least is not None else counted.limit(0)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0: Stirling's series after a shift by eight."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability of so many zeros and ones."""
    out = np.empty_like(zeros)
    for k in range(0, len(zeros), 512):  # small pieces: the series needs many temporaries
        a, b = zeros[k : k + 512], ones[k : k + 512]
        out[k : k + 512] = log_gamma(a + 0.5) + log_gamma(b + 0.5) - np.log(np.pi) - log_gamma(a + b + 1)
    return out


def split_bits(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From counts by byte (n x 256), the zeros and ones of each of the 256 binary nodes (0 unused)."""
    zeros, ones = np.zeros((len(counts), 256)), np.zeros((len(counts), 256))
    for k in range(0, len(counts), 512):
        tree = np.zeros((len(counts[k : k + 512]), 512))
        tree[:, 256:] = counts[k : k + 512]
        for node in range(255, 0, -1):
            tree[:, node] = tree[:, 2 * node] + tree[:, 2 * node + 1]
        zeros[k : k + 512], ones[k : k + 512] = tree[:, 0::2], tree[:, 1::2]
    return zeros, ones


@dataclass(frozen=True)
class Automaton:
    """Log10 probability and next state of each (state, byte); ``start`` is a text's first state."""

    log_p: np.ndarray
    following: np.ndarray
    start: int


class ContextTree:
    """Context tree in memory, the tests' yardstick: for each depth the contexts (as integers, newest
    byte lowest) with counts.  Scoring mixes the same tree by parts, see :func:`mix_long`."""

    def __init__(self, contexts: list[np.ndarray], counts: list[np.ndarray]):
        self.contexts, self.counts = contexts, counts

    def automaton(self) -> Automaton:
        depths = len(self.contexts)
        index = [{c: i for i, c in enumerate(x.tolist())} for x in self.contexts]
        parent = [None] + [np.array([index[d - 1][c & ((1 << 8 * (d - 1)) - 1)] for c in self.contexts[d].tolist()], np.int64) for d in range(1, depths)]
        own_p: list = [None] * depths
        rest_p: list = [None] * depths
        weight: list = [None] * depths
        below = None
        for d in range(depths - 1, -1, -1):
            a, b = split_bits(self.counts[d])
            own = log_kt(a, b)
            own_p[d] = ((a + 0.5) / (a + b + 1)).astype(np.float32)
            if d == depths - 1:
                weighted, rest_p[d], weight[d] = own, own_p[d], np.ones_like(own_p[d])
            else:
                rest, inside = self.counts[d].copy(), np.zeros_like(own)
                if len(self.contexts[d + 1]):
                    np.subtract.at(rest, parent[d + 1], self.counts[d + 1])
                    np.add.at(inside, parent[d + 1], below)
                a, b = split_bits(np.maximum(rest, 0))
                inside += log_kt(a, b)
                rest_p[d] = ((a + 0.5) / (a + b + 1)).astype(np.float32)
                weight[d] = (1 / (1 + np.exp(np.clip(inside - own, -700, 700)))).astype(np.float32)
                weighted = np.logaddexp(own, inside) - np.log(2)
            below = weighted
        states, offsets = [], np.cumsum([0, *map(len, self.contexts)])
        for d in range(depths):
            p = weight[d] * own_p[d] + (1 - weight[d]) * rest_p[d]
            at = np.arange(len(self.contexts[d]))
            for up in range(d - 1, -1, -1):
                at = parent[up + 1][at]
                p = weight[up][at] * own_p[up][at] + (1 - weight[up][at]) * p
            states.append(self.byte_logs(p))
        return Automaton(np.concatenate(states), *self.transitions(index, offsets))

    @staticmethod
    def byte_logs(p: np.ndarray) -> np.ndarray:
        """Log10 probability of each byte from the probability of 0 at each node."""
        logs = np.empty((len(p), 256), np.float32)
        for k in range(0, len(p), 512):
            some = p[k : k + 512].astype(np.float64)
            out = np.zeros((len(some), 512))
            for node in range(1, 256):
                out[:, 2 * node] = out[:, node] + np.log10(some[:, node])
                out[:, 2 * node + 1] = out[:, node] + np.log10(1 - some[:, node])
            logs[k : k + 512] = out[:, 256:]
        return logs

    def transitions(self, index: list[dict], offsets: np.ndarray) -> tuple[np.ndarray, int]:
        """The longest kept context that ends a state's context and the byte after it."""
        following = np.zeros((int(offsets[-1]), 256), np.uint16)
        for d in range(1, len(self.contexts)):  # deeper ones overwrite
            size, symbols = 1 << 8 * d, self.contexts[d] & 0xFF
            before = self.contexts[d] >> 8
            for e in range(d - 1, len(self.contexts)):
                tail = self.contexts[e] & (size // 256 - 1)
                order = np.argsort(tail, kind="stable")
                lo, hi = np.searchsorted(tail[order], before, "left"), np.searchsorted(tail[order], before, "right")
                rows = order[np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange((hi - lo).sum())]
                which = np.repeat(np.arange(len(before)), hi - lo)
                following[offsets[e] + rows, symbols[which]] = offsets[d] + which
        state = 0
        for _ in range(len(self.contexts)):
            state = int(following[state, EDGE])
        return following, state


def posterior(zeros: np.ndarray, ones: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight of the own estimate against the longer contexts', and log of the weighted probability."""
    own = log_kt(zeros, ones)
    return 1 / (1 + np.exp(np.clip(inside - own, -700, 700))), np.logaddexp(own, inside) - np.log(2)


def mix_long(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Mix the contexts longer than ``TOP`` of distinct grams; all grams of such a context are given.

    Returns the probability of each of a gram's eight decisions (n x 8), and ``node, zeros, ones,
    inside`` of the contexts of ``TOP`` bytes, whose sums over all calls go to ``ShortContexts``.  A
    gram that training lacks has n = 0 and alters nothing: the untrained estimate is one half.
    """
    byte, chances, parts = keys & 255, np.empty((len(keys), 8)), []
    for j in range(8):
        node, bit = (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1
        lower = place = q = None
        for d in range(DEPTH, TOP - 1, -1):
            ids, at = np.unique((((keys >> 8) & ((1 << 8 * d) - 1)) << 8) | node, return_inverse=True)
            zeros, ones = np.bincount(at, n * (bit == 0), len(ids)), np.bincount(at, n * bit, len(ids))
            inside = None
            if d < DEPTH:
                parent = np.empty(len(lower), np.int64)
                parent[place] = at
                inside = np.bincount(parent, lower, len(ids))
            if d == TOP:
                parts.append((ids, zeros, ones, inside))
                break
            p = (np.where(bit == 1, ones[at], zeros[at]) + 0.5) / ((zeros + ones)[at] + 1)
            if d == DEPTH:
                lower, q = log_kt(zeros, ones), p
            else:
                weight, lower = posterior(zeros, ones, inside)
                q = weight[at] * p + (1 - weight[at]) * q
            place = at
        chances[:, j] = q
    return chances, tuple(np.concatenate(x) for x in zip(*parts))


def mix_long_contexts(grams: DataFrame) -> DataFrame:
    """``mix_long`` over the sums of ``key, n`` rows, dealt by the newest ``TOP + 1`` bytes of the context.

    Rows hold either a ``key`` and its chances or a ``node`` and its sums.
    """

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = table.column("key").to_numpy()
        chances, sums = mix_long(keys, table.column("n").to_numpy())
        names = ["key", *BITS, "node", "zeros", "ones", "inside"]
        kinds = [pa.int64(), *[pa.float32()] * 8, pa.int64(), *[pa.float64()] * 3]
        for columns, size in (([keys, *chances.astype(np.float32).T, *[None] * 4], len(keys)), ([None] * 9 + list(sums), len(sums[0]))):
            yield pa.RecordBatch.from_arrays([pa.nulls(size, k) if c is None else pa.array(np.ascontiguousarray(c), k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, limit = [], 0, CHUNK
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= limit:
                table = pa.Table.from_batches(held).combine_chunks()
                near = table.column("near").to_numpy()
                cut = int(np.searchsorted(near, near[-1]))
                if cut:
                    yield from solve(table.slice(0, cut))
                held, size = table.slice(cut).to_batches(), size - cut
                limit = max(CHUNK, 2 * size)
        if held:
            yield from solve(pa.Table.from_batches(held))

    near = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * (TOP + 1)) - 1))
    dealt = grams.select("key", "n", near.alias("near")).repartition("near")
    return dealt.groupBy("near", "key").agg(F.sum("n").alias("n")).sortWithinPartitions("near").mapInArrow(tidied(run), MIXED)


class ShortContexts:
    """The contexts of up to ``TOP`` bytes: at each node, the probability of a decision is ``own[bit]``
    plus ``rest`` times what the longer contexts give."""

    def __init__(self, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, inside: np.ndarray):
        order = np.argsort(node)
        self.node, zeros, ones, inside = node[order], zeros[order], ones[order], inside[order]
        self.own, self.rest = np.zeros((2, len(node))), np.ones(len(node))
        ids, at = self.node, np.arange(len(node))
        for d in range(TOP, -1, -1):
            weight, lower = posterior(zeros, ones, inside)
            for bit, count in enumerate((zeros, ones)):
                p = (count + 0.5) / (zeros + ones + 1)
                self.own[bit] = weight[at] * p[at] + (1 - weight[at]) * self.own[bit]
            self.rest *= 1 - weight[at]
            if d:
                ids, up = np.unique((((ids >> 8) & ((1 << 8 * (d - 1)) - 1)) << 8) | (ids & 255), return_inverse=True)
                zeros, ones, inside = (np.bincount(up, x, len(ids)) for x in (zeros, ones, lower))
                at = up[at]

    def log_p(self, keys: np.ndarray, chances: list[np.ndarray]) -> np.ndarray:
        """Log10 probability of each gram's byte after its context."""
        byte, context = keys & 255, ((keys >> 8) & ((1 << 8 * TOP) - 1)) << 8
        out = np.zeros(len(keys))
        for j, chance in enumerate(chances):
            at = np.searchsorted(self.node, context | (1 << j) | (byte >> (8 - j)))
            out += np.log10(self.own[(byte >> (7 - j)) & 1, at] + self.rest[at] * chance)
        return out


def gram_logs(grams: DataFrame) -> DataFrame:
    """``key, log_p`` of each distinct gram of ``key, n`` rows."""
    mixed = materialize(mix_long_contexts(grams), "mixed")
    sums = mixed.where(F.col("node").isNotNull()).groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "inside")]).toArrow()
    shared = grams.sparkSession.sparkContext.broadcast(ShortContexts(*(sums.column(c).to_numpy() for c in ("node", "zeros", "ones", "inside"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            logs = shared.value.log_p(keys, [batch.column(q).to_numpy() for q in BITS])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(logs, pa.float64())], ["key", "log_p"])

    return mixed.where(F.col("key").isNotNull()).select("key", *BITS).mapInArrow(tidied(run), "key long, log_p double")


def gram_scores(texts: list[bytes], keys: pa.Array, logs: np.ndarray, step: int = 6_000_000) -> np.ndarray:
    """Log10 probability of each text and its end, from those of all grams that occur."""
    part = np.cumsum([len(t) for t in texts]) // step
    out = np.empty(len(texts))
    for which in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(part)) + 1):
        data, firsts, ends = laid_out(texts[which[0] : which[-1] + 1])
        found, symbol = gram_keys(data, firsts)
        steps = np.zeros(len(data))
        at = pc.index_in(pa.array(found[symbol]), value_set=keys).to_numpy(zero_copy_only=False)
        steps[DEPTH:][symbol] = logs[at]
        sums = np.concatenate([[0.0], np.cumsum(steps)])
        out[which] = sums[ends + 1] - sums[firsts]
    return out


def word_scores(texts: pa.ChunkedArray, logs: dict[bytes, float], step: int = 4_000_000) -> list[pa.Array]:
    """Of each lower-cased text: words, words in ``logs``, the sum of their logs, and the other words
    with their numbers."""
    sizes = pc.binary_length(texts).to_numpy()
    out: list[tuple] = []
    for which in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(np.cumsum(sizes) // step)) + 1):
        lists = split_words(texts.slice(which[0], len(which))).combine_chunks()
        coded = lists.flatten().dictionary_encode()
        names = slices(coded.dictionary)
        values = np.array([logs.get(w, np.nan) for w in names] or [np.nan])
        at, n = coded.indices.to_numpy(zero_copy_only=False), len(which)
        owner = np.repeat(np.arange(n), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        real = at != (names.index(b"") if b"" in names else -1)
        at, owner = at[real], owner[real]
        found = ~np.isnan(values[at])
        pairs, counts = np.unique(owner[~found] * len(values) + at[~found], return_counts=True)
        tokens = coded.dictionary.take(pa.array(pairs % len(values))).cast(pa.binary())
        ends = np.searchsorted(pairs // len(values), np.arange(n + 1)).astype(np.int32)
        rare = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([tokens, pa.array(counts, pa.int32())], ["token", "n"]))
        out.append((np.bincount(owner, minlength=n), np.bincount(owner[found], minlength=n), np.bincount(owner[found], values[at[found]], n), rare))
    columns = list(zip(*out))
    return [*(pa.array(np.concatenate(c)) for c in columns[:3]), pa.chunked_array(columns[3])]


class FrequentWords:
    """Log10 of the smoothed count of frequent tokens; a worker builds the table once."""

    def __init__(self, words: bytes, counts: np.ndarray):
        self.words, self.counts, self.built = words, counts, None

    def logs(self) -> dict[bytes, float]:
        if self.built is None:
            self.built = dict(zip(self.words.split(b" "), np.log10(self.counts + 0.5).tolist())) if len(self.counts) else {}
        return self.built


def run_automaton(automaton: Automaton, texts: list[bytes], lane: int = 512) -> np.ndarray:
    """Log10 probability of each text and its end, many lanes of ``lane`` bytes side by side."""
    data, firsts, ends = laid_out(texts)
    lanes = -(-len(data) // lane)
    padded = np.concatenate([np.full(DEPTH, EDGE, np.uint8), data, np.full(lanes * lane - len(data), EDGE, np.uint8)])
    at = np.arange(lanes) * lane
    state = np.zeros(lanes, np.int64)
    out = np.zeros((lane, lanes), np.float32)
    log_p, following = automaton.log_p.ravel(), automaton.following.ravel()
    for step in range(-DEPTH, lane):
        slot = state * 256 + padded[at + (step + DEPTH)]
        if step >= 0:
            out[step] = log_p[slot]
        state = following[slot].astype(np.int64)
    sums = np.concatenate([[0.0], np.cumsum(out.T.ravel()[: len(data)], dtype=np.float64)])
    return sums[ends + 1] - sums[firsts]


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    ``score`` is the context tree's log10 probability of the lower-cased bytes and the end;
    ``bits_per_byte`` is its code length a byte, the end counted as one.  A null or empty text has
    one token, the end.  Rows with a null id belong to the training part.  Each row, repeated or not,
    gives one row; repeated training rows are counted each time.  Without training rows every
    probability is that of untrained estimates.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    training = source.where(~F.col("held_out"))
    spark = docs.sparkSession
    vocabulary = materialize(count_tokens(training), "vocabulary")
    laid = materialize(lay_out(source), "laid")
    grams = laid.where(F.col("key").isNotNull()).select("batch", "key", "n")
    trained = training.count()
    tokens, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, distinct = tokens + trained, distinct + (trained > 0)
    log_total = float(np.log10(total + 0.5 * (distinct + 1)))
    log_end = float(np.log10(trained + 0.5))
    frequent = most_frequent(vocabulary.where(F.octet_length("token") <= 40), "c", FREQUENT).select("token", "c").toArrow()
    counts = frequent.column("c").to_numpy()
    least = int(counts.min()) if len(counts) else None
    words = b" ".join(frequent.column("token").to_pylist())
    del frequent
    shared = spark.sparkContext.broadcast(FrequentWords(words, counts))
    kind = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, part double, score double, n_bytes long, rare array<struct<token: binary, n: int>>"

    def run(part: pa.Table, found: pa.Table) -> pa.Table:
        texts = part.column("text")
        scores = gram_scores(texts.to_pylist(), found.column("key").combine_chunks(), found.column("log_p").to_numpy())
        n_words, n_met, sums, rare = word_scores(texts, shared.value.logs())
        columns = [part.column("row"), part.column("doc_id"), part.column("held_out"), pc.add(n_words, 1), pc.add(n_met, int(trained > 0)), pc.add(sums, log_end), pa.array(scores), pc.cast(pc.binary_length(texts), pa.int64()), rare]
        return pa.Table.from_arrays(columns, ["row", "doc_id", "held_out", "n_tokens", "n_known", "part", "score", "n_bytes", "rare"])

    found = grams.select("batch", "key").join(gram_logs(grams.select("key", "n")).hint("shuffle_merge"), "key").select(F.col("batch").alias("of"), "key", "log_p")
    texts = laid.where(F.col("text").isNotNull()).select("batch", "row", "doc_id", "held_out", "text")
    scored = materialize(texts.groupBy("batch").cogroup(found.groupBy("of")).applyInArrow(run, kind), "scored")
    discard(laid)
    rare = scored.select("row", F.explode("rare").alias("x")).select("row", "x.token", "x.n")
    known = vocabulary if least is None else vocabulary.where((F.col("c") <= least) | (F.octet_length("token") > 40))
    met = rare.join(known.hint("shuffle_merge"), "token", "left")
    sums = met.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_part"), F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"))
    joined = scored.drop("rare").join(sums.hint("shuffle_merge"), "row", "left")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("rare_part", F.lit(0.0)) - F.col("n_tokens") * F.lit(log_total)).alias("base_score"),
        "score",
        (-F.col("score") * F.lit(float(np.log2(10))) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
