"""A small corpus with every case that the operators name: copies, near copies, shared passages, nulls."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, seed long, s string, node long, did long, places string"
WORDS = [a + b for a in ("ba", "ce", "di", "fo", "gu", "ka", "le", "mi", "no", "pu", "ra", "se", "ti", "vo", "zu") for b in ("", "n", "r", "st", "la", "mo", "re", "ti", "xu", "den")]


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice(WORDS) for _ in range(n)]
    return " ".join(w.capitalize() + ("." if rng.random() < 0.1 else "") if rng.random() < 0.15 else w for w in words)


def documents(seed: int = 1, n: int = 60) -> list[tuple[int | None, str | None]]:
    """(doc_id, text) rows with gaps between ids."""
    rng = random.Random(seed)
    passage = prose(rng, 90)
    out: list[tuple[int | None, str | None]] = []
    for k in range(n):
        kind = k % 10
        text = prose(rng, rng.choice((1, 3, 4, 5, 6, 12, 60, 150, 300)))
        if kind == 3 and out:
            text = rng.choice([t for _, t in out if t] or [text])  # exact copy
        elif kind == 5 and out:
            words = (rng.choice([t for _, t in out if t]) or text).split()
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)  # near copy
        elif kind == 7:
            text = f"{prose(rng, 40)} {passage} {prose(rng, 30)}"
        out.append((10 + 7 * k, text))
    long = prose(rng, 6000)
    out += [(5, None), (6, ""), (7, "   \n\t "), (8, "é"), (9, "ab" * 900), (1000, long), (1001, long.replace(" ba ", " be ", 3)), (None, "text without an id"), (None, None)]
    out += [(1002, "Über straße 漢字 ünïcode 😀 test. " * 9), (1003, "Über straße 漢字 ünïcode 😀 test. " * 9), (1004, "#$%& !!! 123"), (1005, "x\x1cy\x85z\xa0w <|endoftext|> 'S we'LL")]
    out += [out[2], out[2]]  # repeated rows
    return out


def frame(spark, rows):
    """With extra columns whose names the operators use inside."""
    full = [(i, t, "en" if i is None or i % 2 else "fr", "s", len(t or ""), 1, "x", 2, 3, "y") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)
