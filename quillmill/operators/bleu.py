"""Corpus and sentence BLEU over clipped n-gram counts (Papineni et al., 2002; Post, 2018)."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

#: CJK characters are tokens of their own.
CJK = r"([\x{2e80}-\x{2fff}\x{3000}-\x{303f}\x{3100}-\x{312f}\x{31a0}-\x{31ef}\x{3200}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{fe30}-\x{fe4f}\x{ff00}-\x{ff0f}\x{ff1a}-\x{ff20}\x{ff3b}-\x{ff40}\x{ff5b}-\x{ff65}])"
ORDERS = 4


def tokens(text: Column) -> Column:
    """Tokens of a text: CJK characters, then words and punctuation as the 13a rules split them."""
    out = F.regexp_replace(F.trim(F.coalesce(text, F.lit(""))), CJK, " $1 ")
    out = F.regexp_replace(out, r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 ")
    out = F.regexp_replace(out, r"([^0-9])([\.,])", "$1 $2 ")
    out = F.regexp_replace(out, r"([\.,])([^0-9])", " $1 $2")
    out = F.regexp_replace(out, r"([0-9])(-)", "$1 $2 ")
    return F.filter(F.split(out, r"\s+"), lambda t: t != "")


@F.pandas_udf(ArrayType(LongType()))
def matches(prediction: pd.Series, reference: pd.Series) -> pd.Series:
    """Clipped matches of orders 1 to 4: each n-gram as often as both sides have it."""

    def counted(words, n: int) -> Counter:
        return Counter(zip(*(words[k:] for k in range(n))))

    def one(p, r) -> list[int]:
        p, r = list(p), list(r)
        return [(counted(p, n) & counted(r, n)).total() for n in range(1, ORDERS + 1)]

    return pd.Series([one(p, r) for p, r in zip(prediction, reference)], dtype=object)


def pair_counts(pairs: DataFrame, prediction: str, reference: str) -> DataFrame:
    """``pairs`` with lengths and, for each order, matches and totals."""
    split = pairs.withColumn("_p", tokens(F.col(prediction))).withColumn("_r", tokens(F.col(reference))).withColumn("_m", matches("_p", "_r"))
    columns = {"sys_len": F.size("_p").cast("bigint"), "ref_len": F.size("_r").cast("bigint")}
    for n in range(1, ORDERS + 1):
        columns[f"match_{n}"] = F.col("_m")[n - 1]
        columns[f"total_{n}"] = F.greatest(F.size("_p") - (n - 1), F.lit(0)).cast("bigint")
    return split.withColumns(columns).drop("_p", "_r", "_m")


def score(prefix: str = "") -> Column:
    """BLEU from counts: exponential smoothing of orders without match, brevity penalty."""
    logs, halvings = F.lit(0.0), F.lit(1.0)
    for n in range(1, ORDERS + 1):
        match, total = F.col(f"{prefix}match_{n}"), F.col(f"{prefix}total_{n}")
        halvings = F.when((match == 0) & (total > 0), halvings * 2).otherwise(halvings)
        logs = logs + F.log(F.when(match == 0, 100.0 / (halvings * F.greatest(total, F.lit(1)))).otherwise(100.0 * match / F.greatest(total, F.lit(1))))
    sys_len, ref_len = F.col(f"{prefix}sys_len"), F.col(f"{prefix}ref_len")
    penalty = F.when(sys_len < ref_len, F.exp(1 - ref_len / F.greatest(sys_len, F.lit(1)))).otherwise(F.lit(1.0))
    usable = (sys_len > 0) & (F.col(f"{prefix}total_{ORDERS}") > 0) & (F.col(f"{prefix}match_1") > 0)
    return F.when(usable, penalty * F.exp(logs / ORDERS)).otherwise(F.lit(0.0))


def sentence_bleu(pairs: DataFrame, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """``pairs`` with ``bleu`` and the ratio of lengths in characters."""
    ratio = F.length(prediction) / F.greatest(F.length(reference), F.lit(1))
    counted = pair_counts(pairs, prediction, reference).withColumns({"bleu": score(), "length_ratio": ratio})
    return counted.select(*pairs.columns, "bleu", "length_ratio")


def corpus_bleu(pairs: DataFrame, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """One row: BLEU of the whole corpus, from sums that combine map-side."""
    names = ["sys_len", "ref_len", *[f"{k}_{n}" for n in range(1, ORDERS + 1) for k in ("match", "total")]]
    sums = pair_counts(pairs, prediction, reference).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names], F.count("*").alias("n_pairs"))
    return sums.select(score().alias("bleu"), "n_pairs", "sys_len", "ref_len")
