"""Packing documents into fixed-length training sequences.

Each document becomes token ids plus one end id.  Whole stretches of ``length`` ids fill sequences
of their own; what remains of each document is placed first-fit decreasing, with a tournament tree
over the bins' free room that finds the first bin with room in ``O(log bins)``.  Packing runs
independently in randomised groups of rows, so that no task sees more than a group; repeated rows,
a hot source or a run of copies are spread over the groups like any others.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import NULL_ID, BoundedCache, held, slices, small_batches, tidied
from quillmill.llm.token_counts import load_tokenizer

#: Fixed value: the word-end BPE pre-tokenizer's published pattern, for text that is lower-cased.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: Words whose lower-casing and pre-tokens are plain; any other word goes to the tokenizer as it is.
USUAL = "[!-~\xa1-\xac\xae-\u012f\u0131-\u024f\u0400-\u052f\u2010-\u2027\u2030-\u205e]+"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, pack_group long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Bytes of text that are encoded at once; a longer text goes in parts.
PART = 4_000_000


class TournamentTree:
    """Bins' free room in the leaves of a complete tree whose inner nodes hold the maximum below."""

    def __init__(self, bins: int, room: int):
        self.size = 1
        while self.size < max(1, bins):
            self.size *= 2
        self.tree = [room] * (2 * self.size)

    def first_fit(self, need: int) -> int:
        """Index of the first bin with room for ``need``, which is taken from it; -1 if none has."""
        tree, node = self.tree, 1
        if tree[1] < need:
            return -1
        while node < self.size:
            node *= 2
            if tree[node] < need:
                node += 1
        found = node - self.size
        tree[node] -= need
        node //= 2
        while node:
            best = tree[2 * node] if tree[2 * node] >= tree[2 * node + 1] else tree[2 * node + 1]
            if tree[node] == best:
                break
            tree[node] = best
            node //= 2
        return found


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, items taken from the largest down (ties by position)."""
    order = np.argsort(-sizes, kind="stable")
    tree = TournamentTree(len(sizes), capacity)
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    used = [0] * tree.size
    for i in order.tolist():
        need = int(sizes[i])
        b = tree.first_fit(need)
        bins[i], offsets[i] = b, used[b]
        used[b] += need
    return bins, offsets


def byte_alphabet() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it can be
    seen, else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {b: b for b in seen} | {b: 256 + k for k, b in enumerate(hidden)}


def parts_of(text: str, limit: int) -> Iterator[str]:
    """A text in parts of about ``limit`` characters, cut at ASCII white space only."""
    at = 0
    while len(text) - at > limit:
        cut = max(text.rfind(c, at, at + limit) for c in " \t\n\r\v\f")
        if cut <= at:
            cut = min((k for c in " \t\n\r\v\f" if (k := text.find(c, at + limit)) >= 0), default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


class WordEncoder:
    """Ids of texts, by way of their distinct words.

    The tokenizer normalizes, drops white space and never joins what white space parts, so a text's ids
    are those of its words in order.  A batch is lower-cased and split and its distinct words found in
    Arrow; only these are looked up, in a cache bounded in bytes, or encoded; numpy lays the ids out for
    all words.  Plain words go to the vocabulary's model one pre-token at a time, others through the
    whole tokenizer, as do texts that may hold a special token, whose case counts.
    """

    def __init__(self, path: str, cache_bytes: int = 40 << 20):
        import regex

        self.path, self.tokenizer = path, load_tokenizer(path)
        self.model = self.tokenizer.model
        self.findall = regex.compile(WORD_PATTERN).findall
        self.usual = regex.compile(USUAL).fullmatch
        self.alphabet = byte_alphabet()
        self.cache = BoundedCache(cache_bytes)
        self.packed = [struct.Struct(f"<{k}I").pack for k in range(65)]
        self.tails = {w: self.raw(w.decode()) for w in (b".", b",")}

    def raw(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, word: bytes) -> bytes:
        """Ids, as little-endian uint32 bytes, of a word that the cache lacks; ASCII is lower-case."""
        tail = self.tails.get(word[-1:], b"")
        stem = word[:-1] if tail else word
        if stem.isalpha() and len(stem) <= 64:
            cache = self.cache
            found = cache.newer.get(stem) or cache.older.get(stem)
            if found is None:
                ids = [t.id for t in self.model.tokenize(stem.decode())]
                found = self.packed[len(ids)](*ids)
                cache.put(stem, found)
            return found + tail
        text = word.decode()
        if not self.usual(text):
            found = self.raw(text)
        else:
            pieces = (x.encode().decode("latin-1").translate(self.alphabet) for x in self.findall(text.lower()))
            found = np.array([t.id for x in pieces for t in self.model.tokenize(x)], "<u4").tobytes()
        if len(word) <= 64:
            self.cache.put(word, found)
        return found

    def look_up(self, words: list[bytes]) -> list[bytes]:
        self.cache.make_room()
        found, learn = self.cache.get_all(words), self.learn
        for i in [i for i, x in enumerate(found) if x is None]:
            found[i] = learn(words[i]) if words[i] else b""
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after each other, and the offset of each text's and of the end."""
        texts = pc.fill_null(texts, "")
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        words = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(pa.array(special), "", texts)))
        coded = words.flatten().dictionary_encode()
        known = self.look_up(slices(coded.dictionary))
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        every, starts = np.frombuffer(b"".join(known), "<u4"), np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy(zero_copy_only=False)
        counts = sizes[which]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = every[np.repeat(starts[which] - ends + counts, counts) + np.arange(total)]
        offsets = np.append(0, ends)[np.cumsum(np.append(0, pc.list_value_length(words).to_numpy(zero_copy_only=False)))]
        if not special.any():
            return ids, offsets
        whole = [np.frombuffer(self.raw(texts[i].as_py()), "<u4") if s else ids[a:b] for i, (s, a, b) in enumerate(zip(special.tolist(), offsets, offsets[1:]))]
        return np.concatenate(whole), np.cumsum([0, *map(len, whole)])

    def encode_whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Like :meth:`encode`, in parts where a single text is very long."""
        if len(texts) != 1 or not texts[0].is_valid or len(texts[0].as_py()) <= PART:
            return self.encode(texts)
        ids = np.concatenate([self.encode(pa.array([part]))[0] for part in parts_of(texts[0].as_py(), PART)])
        return ids, np.array([0, len(ids)])


def cut_pieces(docs: DataFrame, path: str, length: int, end_id: int, groups: int, seed: int, doc_id: str, text: str) -> DataFrame:
    """Pieces of at most ``length`` ids, each with its checksum and its packing group.

    The group is drawn by row, not by content, so that a run of equal rows is spread over all groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held("packing", lambda: WordEncoder(path))
        if encoder.path != path:
            encoder.__init__(path)
        for batch in small_batches(batches, limit=PART):
            ids, offsets = encoder.encode_whole(batch.column("text"))
            ids = np.insert(ids, offsets[1:], end_id).astype("<u4")
            offsets = offsets + np.arange(len(offsets))
            tokens = np.diff(offsets)
            pieces = -(-tokens // length)
            owner = np.repeat(np.arange(len(tokens)), pieces)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
            size = np.minimum(length, tokens[owner] - start)
            begin, data = offsets[owner] + start, memoryview(ids).cast("B")
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + size).tolist())]
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), *map(pa.array, (start, size, np.array(sums, np.int64), tokens[owner])), batch.column("pack_group").take(at)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "pack_group"])

    group = F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id).cast("long"), F.monotonically_increasing_id()), F.lit(groups))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), group.alias("pack_group")).mapInArrow(tidied(run, "packing"), PIECES)


def lay_out_group(length: int):
    """Function for ``applyInArrow`` that lays out one group's pieces."""

    def run(pieces: pa.Table) -> pa.Table:
        keys = [pieces.column(c).fill_null(NULL_ID).to_numpy() for c in ("ids_crc32", "start", "doc_id", "doc_tokens")]
        pieces = pieces.take(pa.array(np.lexsort(keys)))
        sizes = pieces.column("length").to_numpy()
        bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        full = sizes == length
        bins[full] = np.arange(full.sum())
        bins[~full], offsets[~full] = first_fit_decreasing(sizes[~full], length)
        bins[~full] += full.sum()
        sequence = pieces.column("pack_group").to_numpy() * (1 << 32) + bins
        return pieces.drop_columns(["pack_group"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offsets))

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, length: int = 2048, end_id: int = 1, group_documents: int = 4096, seed: int = 17, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of ``docs`` with the sequence and offset that each has been given.

    A null or empty text is the end id alone.  Exact repeats of a row are packed like any others, at
    places of their own.  Ties in size go by document, then by start.  Sequences of one group are
    numbered within it: ``sequence_id = group * 2**32 + bin``.  An empty table gives an empty result.
    ``group_documents`` bounds what a task packs at once, so one group's last bin is the only one
    whose room is left for lack of pieces.  Groups are drawn by a row's place in ``docs``, so these
    should be read from files (or a written table), whose rows come in the same order when a task is
    run again; their number follows from a count, which file footers answer.
    """
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    groups = max(1, -(-docs.count() // group_documents))
    pieces = cut_pieces(docs, path, length, end_id, groups, seed, doc_id, text)
    return pieces.groupBy("pack_group").applyInArrow(lay_out_group(length), PACKED)
