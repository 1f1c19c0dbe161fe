"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Fixed masks over successive words say which positions are hashed and which may differ.  All masked
hashes of the benchmark are joined with those of the documents; each hit names an item and an
alignment, and is verified by comparing words: up to a fifth of the item, or of any ``window`` of its
words, may be substituted.  Scan, split, hash, join and verification run in one map-side pass when the
benchmark's hash table is small enough to broadcast (checked); beyond that the hashes are joined by
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import NULL_ID, attach, fits_broadcast, materialize, row_key

#: Masks over word positions; 1 is hashed, 0 ignored.
MASKS = ("11011", "1100101")
#: Masks that short items need besides, by their number of words: fewer than five must stand
#: verbatim, and one substitution among five or six always leaves three words in a row or the
#: first mask whole.
SHORT = {"1": (1,), "11": (2,), "111": (3, 5, 6), "1111": (4,)}
#: What separates words: every ASCII character that is neither digit nor letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words; null gives an empty array."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def masked_hash(words: str, at: str, mask: str) -> str:
    """SQL of the hash of ``words`` from ``at`` under a mask; the mask itself is hashed along."""
    picked = ", ".join(f"get({words}, {at} + {k})" for k, bit in enumerate(mask) if bit == "1")
    return f"case when {at} + {len(mask)} <= size({words}) then xxhash64('{mask}', {picked}) end"


def seeds(benchmark: DataFrame, masks: tuple[str, ...], item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``seed, mask, item_id, at, item_words``: every masked hash of every item."""
    items = benchmark.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("item_words"))
    spread = items.select("item_id", "item_words", F.posexplode("item_words").alias("at", "_"))
    some = [f"named_struct('mask', '{m}', 'seed', {masked_hash('item_words', 'at', m)})" for m in masks]
    some += [f"named_struct('mask', '{m}', 'seed', case when size(item_words) in {sizes if len(sizes) > 1 else f'({sizes[0]})'} then {masked_hash('item_words', 'at', m)} end)" for m, sizes in SHORT.items()]
    each = spread.select("item_id", "item_words", "at", F.explode(F.expr("array(" + ", ".join(some) + ")")).alias("s"))
    return each.select("s.seed", "s.mask", "item_id", "at", "item_words").where("seed is not null").distinct()


def positions(keyed: DataFrame, masks: list[str]) -> DataFrame:
    """A row per document position and mask; ``words`` is carried by reference inside codegen.

    The outer form spares a second split, which a filter for empty arrays would cost.
    """
    spread = keyed.select("did", "rh", "words", F.posexplode_outer("words").alias("pos", "_"))
    hashes = F.expr("array(" + ", ".join(masked_hash("words", "pos", m) for m in masks) + ")")
    return spread.select("did", "rh", "words", "pos", F.explode(hashes).alias("seed"))


def verified(hits: DataFrame, share: float, window: int) -> DataFrame:
    """Alignments where at least ``share`` of the item's words are equal, or of some ``window`` of them.

    The test on the hit number, which has no fixed value, keeps the verification out of the join: it has
    no generated code, and as a join condition it would copy every candidate row with its words.
    """
    hits = hits.withColumn("hit", F.monotonically_increasing_id())
    equal = F.expr("filter(sequence(0, size(item_words) - 1), k -> get(words, cast(start as int) + k) = item_words[k])")
    compared = hits.select("hit", "did", "rh", "item_id", "start", F.size("item_words").alias("item_size"), equal.alias("equal"))
    least = -int(-share * window // 1)
    local = F.expr(f"size(equal) >= {least} and exists(sequence(0, size(equal) - {least}), i -> equal[i + {least - 1}] - equal[i] < {window})")
    good = compared.where(((F.size("equal") >= share * F.col("item_size")) | local) & (F.col("hit") >= 0))
    return good.select("did", "rh", "item_id", F.col("start").cast("long").alias("start"), F.size("equal").cast("long").alias("n_equal"), F.col("item_size").cast("long").alias("item_size")).distinct()


def overlaps(docs: DataFrame, benchmark: DataFrame, share: float = 0.8, window: int = 25, masks: tuple[str, ...] = MASKS, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``did, rh, item_id, start, n_equal, item_size``: each alignment found, by the never-null row key."""
    table = materialize(seeds(benchmark, masks, item_id, item_text), "seeds")
    keyed = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("did"), row_key(doc_id, text).alias("rh"), words_of(F.col(text)).alias("words"))
    used = {r.mask for r in table.select("mask").distinct().collect()}
    spread = positions(keyed, [m for m in (*masks, *SHORT) if m in used] or list(masks))
    table = table.drop("mask").distinct() if len(used) > len(masks) else table.drop("mask")
    start = (F.col("pos") - F.col("at")).alias("start")
    size = table.agg(F.coalesce(F.sum(120 + 24 * F.size("item_words")), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        hits = spread.join(F.broadcast(table), "seed").select("did", "rh", "words", "item_id", "item_words", start)
        return verified(hits, share, window)
    met = spread.select("did", "rh", "pos", "seed").join(table.hint("shuffle_merge"), "seed").select("did", "rh", "item_id", "item_words", start).distinct()
    return verified(attach(keyed.select("did", "rh", "words"), met, "inner"), share, window)


def contaminations(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, item_id, start, n_equal, item_size, overlap``: each item found in a document.

    Options as of :func:`overlaps`.  ``start`` is the word, from 0, where the item begins (below 0 where
    its beginning is cut off).  A row is an alignment with at least ``share`` of the item's words, or of
    some ``window`` successive ones; items of fewer than five words match verbatim only, null and empty
    ones nothing.  An item found at several places gives a row for each; equal items each give their
    own.  Repeated rows of a document count once; a null id stays null.  An empty table on either side
    gives an empty result.
    """
    found = overlaps(docs, benchmark, **options)
    return found.select(F.when(F.col("did") != NULL_ID, F.col("did")).alias("doc_id"), "item_id", "start", "n_equal", "item_size", (F.col("n_equal") / F.col("item_size")).alias("overlap"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; id and text hash together tell rows apart."""
    found = materialize(overlaps(docs, benchmark, doc_id=doc_id, text=text, **options).select("did", "rh").distinct(), "leaks")
    side = F.broadcast(found) if fits_broadcast(found, 32) else found.hint("shuffle_merge")
    own = F.coalesce(docs[doc_id].cast("long"), F.lit(NULL_ID))
    return docs.join(side, (own == found["did"]) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == found["rh"]), "left_anti")
