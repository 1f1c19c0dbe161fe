"""Stable splits and shards: SHA-1 as a 160-bit number modulo n, by Horner's rule on 32-bit digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha1_mod(key: Column, n: int) -> Column:
    if n < 1:
        raise ValueError("the number of parts must be at least 1")
    digest, out = F.sha1(key.cast("binary")), F.lit(0).cast("bigint")
    for at in range(1, 41, 8):
        digit = F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint")
        out = F.pmod(out * F.lit(1 << 32) + digit, F.lit(n).cast("bigint"))
    return out


def split_name(key: Column, validation_pct: int = 10, test_pct: int = 10) -> Column:
    """``validation``, ``test`` or ``train`` by hash; the same key always falls on the same side."""
    part = sha1_mod(key, 100)
    return F.when(part < validation_pct, "validation").when(part < validation_pct + test_pct, "test").otherwise("train")


def shard(paper_id: Column, row_id: Column, shards: int) -> Column:
    """Shard of a row: by paper where there is one, so that a paper stays together."""
    return sha1_mod(F.coalesce(F.nullif(paper_id, F.lit("")), row_id), shards)


def in_shard(paper_id: Column, row_id: Column, shards: int, wanted: int) -> Column:
    if not 0 <= wanted < shards:
        raise ValueError("the shard must be at least 0 and below the number of shards")
    return shard(paper_id, row_id, shards) == wanted
