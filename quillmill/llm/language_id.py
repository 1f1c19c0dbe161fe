"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its hashed character n-grams; a softmax over a linear map of
that mean gives the language.  Both layers are trained by stochastic gradient descent in numpy on a
bounded, documented sample of labelled rows (whole texts, and short windows of them, since texts may
be a few words long), beside made-up texts of no language: words of random letters of many scripts,
and sample texts with their letters shuffled.  Those form a class of their own, which is never
predicted but tells how likely a text is in none of the languages.  A temperature and the threshold of
that rejection are calibrated on rows that took no part in training.  Prediction is map-only over
whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import discard, materialize, mix64, small_batches, texts_of, tidied

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean"
UNDETERMINED = "und"


def is_held_out():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


# Ranges of letters that made-up words are drawn from.
SCRIPTS = [(0x61, 0x7A), (0x61, 0x7A), (0xDF, 0xFF), (0x3B1, 0x3C9), (0x430, 0x44F), (0x561, 0x586), (0x5D0, 0x5EA), (0x627, 0x64A), (0x905, 0x939), (0xE01, 0xE2E), (0x10D0, 0x10F0), (0x3042, 0x3093), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]


@dataclass(frozen=True)
class LanguageModel:
    """``weight`` and ``bias`` have a last column for texts of no language; ``threshold`` is the highest
    probability of that which is still accepted."""

    languages: list[str]
    embedding: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def judge(self, logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index and probability of the best language of each text, and whether it is accepted."""
        scaled = (logits + self.bias) / self.temperature
        among = softmax(scaled[:, :-1])
        best = among.argmax(axis=1)
        return best, among[np.arange(len(among)), best], softmax(scaled)[:, -1] <= self.threshold

    def table(self) -> np.ndarray:
        """Logits that each bucket adds: the mean and the linear map commute."""
        return (self.embedding @ self.weight).astype(np.float32)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each lower-cased and set between spaces, and each one's end."""
    padded = [f" {t.lower()} " for t in texts]
    ends = np.cumsum([len(t) for t in padded])
    return np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), ends


def subword_buckets(points: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Bucket of the 1-, 2- and 3-gram that starts at each code point (short ends wrap to padding)."""
    padded = np.concatenate([points, np.full(2, 32, np.uint64)])
    later = [padded[:-2], padded[1:-1], padded[2:]]
    bi = later[0] | (later[1] << np.uint64(21))
    grams = [later[0] | np.uint64(1 << 63), bi | np.uint64(1 << 62), bi | (later[2] << np.uint64(42))]
    return [(mix64(g) & np.uint64(buckets - 1)).astype(np.int32) for g in grams]


def mean_logits(texts: list[str], table: np.ndarray, buckets: int) -> np.ndarray:
    """Mean over a text's n-grams of the rows of ``table``; chunked, so that memory is bounded."""
    points, ends = code_points(texts)
    out = np.zeros((len(texts), table.shape[1]))
    starts = np.append(0, ends[:-1])
    step = 1 << 16
    for lo in range(0, len(points), step):
        hi = min(len(points), lo + step)
        chunk = points[lo : hi + 2]
        rows = sum(table[b[: hi - lo]] for b in subword_buckets(chunk, buckets))
        first, last = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi - 1, "right")
        cuts = np.maximum(starts[first : last + 1] - lo, 0)
        out[first : last + 1] += np.add.reduceat(rows, cuts, axis=0)
    return out / (3 * (ends - starts))[:, None]


def bag(text: str, buckets: int) -> np.ndarray:
    points, _ = code_points([text])
    counts = sum(np.bincount(b, minlength=buckets) for b in subword_buckets(points, buckets))
    return (counts / max(1, counts.sum())).astype(np.float32)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def made_up_texts(texts: list[str], count: int, rng: np.random.Generator) -> list[str]:
    """Texts of no language: random letters of one script, or the letters of a sample text shuffled."""
    out = []
    for k in range(count):
        if k % 2 and texts:
            words = texts[int(rng.integers(len(texts)))].split()[:60]
            letters = list("".join(words))
            rng.shuffle(letters)
            cuts = np.cumsum([0, *map(len, words)])
            out.append(" ".join("".join(letters[a:b]) for a, b in zip(cuts, cuts[1:])))
        else:
            first, last = SCRIPTS[k // 2 % len(SCRIPTS)]
            words = [rng.integers(first, last + 1, int(rng.integers(2, 11))) for _ in range(int(rng.integers(2, 40)))]
            out.append(" ".join("".join(map(chr, w.tolist())) for w in words))
    return out


def short_window(text: str, rng: np.random.Generator, most: int = 11) -> str:
    words = text.split()
    n = int(rng.integers(1, most + 1))
    at = int(rng.integers(0, max(1, len(words) - n)))
    return " ".join(words[at : at + n])


def train(texts: list[str], labels: list[str], buckets: int = 8192, dimensions: int = 16, epochs: int = 12, rate: float = 30.0, seed: int = 7, reject_share: float = 0.001, least_threshold: float = 0.9) -> LanguageModel:
    """Train on labelled texts.  A fifth of them calibrates the temperature and the threshold.

    ``reject_share`` is the share of calibration texts and short windows of them that the threshold
    may turn away; it never turns away a text that is in none of the languages with a probability of
    ``least_threshold`` or less.  Without labelled texts the model is empty.
    """
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((buckets, 1), np.float32), np.zeros((1, 2), np.float32), np.zeros(2, np.float32), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    target = np.array([languages.index(x) for x in labels])
    calibrate, learn = order[: len(order) // 5], order[len(order) // 5 :]
    if len(calibrate) == 0:
        calibrate = learn
    others = made_up_texts([texts[i] for i in learn], max(4 * len(SCRIPTS), len(learn) // 6), rng)
    learn = rng.permutation(np.concatenate([learn, np.arange(len(texts), len(texts) + len(others))]))
    every, target = [*texts, *others], np.append(target, np.full(len(others), len(languages)))
    e = rng.normal(0, 0.1, (buckets, dimensions)).astype(np.float32)
    w = rng.normal(0, 0.1, (dimensions, len(languages) + 1)).astype(np.float32)
    b = np.zeros(len(languages) + 1, np.float32)
    share = np.bincount(target[learn], minlength=len(languages) + 1) / len(learn)
    weight = (1 / np.maximum(share, 1e-6) / (1 / np.maximum(share[share > 0], 1e-6)).mean()).clip(0.1, 10).astype(np.float32)
    batch = 64
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for k in range(0, len(learn), batch):
            picked = rng.permutation(learn)[:batch] if k + batch > len(learn) else learn[k : k + batch]
            # every other epoch sees short windows
            x = np.stack([bag(short_window(every[i], rng) if epoch % 2 else every[i], buckets) for i in picked])
            hidden = x @ e
            error = softmax(hidden @ w + b)
            error[np.arange(len(picked)), target[picked]] -= 1
            error *= weight[target[picked]][:, None] / len(picked)
            grad_hidden = error @ w.T
            w -= 0.1 * step * (hidden.T @ error)
            b -= 0.01 * step * error.sum(axis=0)
            e -= step * (x.T @ grad_hidden)
        learn = rng.permutation(learn)
    table = (e @ w).astype(np.float32)
    logits = mean_logits([texts[i] for i in calibrate], table, buckets) + b
    truth = target[calibrate]
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(softmax(logits[:, :-1] / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))]) if len(languages) > 1 else 1.0
    short = mean_logits([short_window(texts[i], rng, 3) for i in calibrate], table, buckets) + b
    other = softmax(np.concatenate([logits, short]) / temperature)[:, -1]
    return LanguageModel(languages, e, w, b, temperature, max(least_threshold, float(np.quantile(other, 1 - reject_share))))


def labelled_sample(docs: DataFrame, rows: int, row_bytes: int) -> tuple[list[str], list[str]]:
    """About ``rows`` labelled training rows (twice as many at most), a window of ``row_bytes / 4``
    characters, at a hashed place, of those that are longer.

    They are chosen by hash below a threshold that follows from each language's count of such rows: in
    proportion to it, but as far as there are rows at least half of an equal share.
    """
    usable = ~is_held_out() & F.col("lang").isNotNull() & (F.length("text") > 0)
    size, most = F.length("text"), row_bytes // 4
    place = F.pmod(F.xxhash64(F.lit("window"), "doc_id", "text"), F.greatest(size - most, F.lit(0)) + 1).cast("int")
    window = F.when(size > most, F.substr(F.col("text"), place + 1, F.lit(most))).otherwise(F.col("text"))
    slim = docs.where(usable).select("doc_id", "lang", window.alias("text"))
    counts = materialize(slim.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    languages, total = counts.agg(F.count("*"), F.sum("n")).first()
    if not languages:
        discard(counts)
        return [], []
    wanted = F.greatest(F.col("n") * (rows / total), F.lit(float(rows // (2 * languages))))
    place = F.xxhash64(F.lit("sample"), "doc_id", "text").cast("double") / 2.0**64 + 0.5
    chosen = slim.join(counts.select("lang", (wanted / F.col("n")).alias("share")), "lang").where(place <= F.col("share"))
    picked = chosen.select("text", "lang").limit(2 * rows).collect()
    discard(counts)
    picked.sort(key=lambda r: (zlib.crc32(r.text.encode()), r.text))
    return [r.text for r in picked], [r.lang for r in picked]


def fit(docs: DataFrame, sample_rows: int = 2500, sample_bytes: int = 32_768) -> LanguageModel:
    """Fit on a bounded sample: ``sample_rows`` labelled rows, twice as many at most, of ``sample_bytes`` each."""
    return train(*labelled_sample(docs.select("doc_id", "text", "lang"), sample_rows, sample_bytes))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` of each row.

    ``lang_pred`` is ``und`` with score 0 for a null text or one without a letter (such rows are not
    accepted), else a learned language, of equally likely ones the first.  ``score`` is its calibrated
    probability among the languages; ``accepted`` says that a text of none of them is not likelier than
    the calibrated threshold.  Without any training row every prediction is
    ``und``.  Only the text decides; repeated rows and null ids give a row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    buckets = len(model.embedding)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        m = shared.value
        letter, table = re.compile(r"[^\W\d_]").search, m.table()
        for batch in small_batches(batches, limit=4_000_000):
            texts = texts_of(batch.column("text"))
            known = np.array([letter(t) is not None for t in texts]) & bool(m.languages)
            best, sure, accepted = m.judge(mean_logits(texts, table, buckets))
            names = [m.languages[i] if k else UNDETERMINED for i, k in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(np.where(known, sure, 0.0)), pa.array(known & accepted)], ["doc_id", "held_out", "lang_pred", "score", "accepted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out().alias("held_out"), F.col("text").alias("text")).mapInArrow(tidied(run), SCHEMA)


def filter_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose language prediction is accepted.  A written table,
    so that the Arrow batches of whole rows are bounded."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    buckets, names = len(model.embedding), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        m = shared.value
        letter, table = re.compile(r"[^\W\d_]").search, m.table()
        for batch in small_batches(batches, limit=4_000_000):
            texts = texts_of(batch.column("text"))
            known = np.array([letter(t) is not None for t in texts]) & bool(m.languages)
            yield batch.filter(pa.array(known & m.judge(mean_logits(texts, table, buckets))[2]))

    return materialize(docs.select(*names).mapInArrow(tidied(run), docs.schema), "accepted")
