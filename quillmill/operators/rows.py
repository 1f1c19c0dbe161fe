"""Order-aware row operators: ordinals, first and last copies, limits, splits, anti joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.sources.durable import materialize


def with_ordinal(df: DataFrame, order: list[str], name: str = "ordinal", start: int = 0) -> DataFrame:
    """Running number of each row in the order of ``order``, without one task seeing all rows.

    Rows are range-partitioned, sorted within their partition and written once with their place; both
    what counts a partition's rows and what numbers them read that table, so they cannot differ in how
    rows were dealt.  The partitions' counts, as many numbers as there are partitions, give each one's
    offset.  Rows that are equal in ``order`` get successive numbers in any order.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_placed", F.monotonically_increasing_id())
    written = materialize(placed, "ordinal")
    part, within = F.shiftright("_placed", 33), F.col("_placed").bitwiseAND((1 << 33) - 1)
    sizes = written.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    return written.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + within + start).select(*df.columns, name)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; ties in ``order`` should be broken by its last column.

    The key's first row is found by an aggregate with map-side combining, so that a hot key costs no
    more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    if rest == order and len(order) == 1:  # a plain minimum is hashed, not sorted
        return df.groupBy(*keys).agg(F.min(order[0]).alias(order[0])).select(*df.columns)
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[packed[c] for c in order])).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, found like :func:`keep_first`; ties should be broken by the last column."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("_row"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def first_n(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows in order; a top-k per partition, then of those."""
    return df.orderBy(*order).limit(n)


def offset_split(ordinal: Column, every: int = 10) -> Column:
    """Every tenth row to validation, the next one to test, the others to train."""
    part = F.pmod(ordinal, F.lit(every))
    return F.when(part == 0, "validation").when(part == 1, "test").otherwise("train")


def pending(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among ``done``; adaptive execution broadcasts ``done`` if it is small."""
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


def combine(frames: list[DataFrame], name: str = "part") -> DataFrame:
    """All frames after each other: missing columns are null, ``part`` keeps their order."""
    tagged = [f.withColumn(name, F.lit(k)) for k, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def checked_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One-to-one join that fails on a key without partner or with several on a side.

    The check costs no second pass: keys are counted where they are joined.
    """
    a = left.groupBy(key).agg(F.count("*").alias("_l"), F.first(F.struct(*left.columns)).alias("_left"))
    b = right.groupBy(key).agg(F.count("*").alias("_r"), F.first(F.struct(*right.columns)).alias("_right"))
    joined = a.join(b, key, "full")
    fault = F.raise_error(F.concat(F.lit("ids do not match one to one: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    sound = F.when((F.coalesce("_l", F.lit(0)) == 1) & (F.coalesce("_r", F.lit(0)) == 1), F.lit(True)).otherwise(fault.cast("boolean"))
    return joined.where(sound).select(F.col("_left").alias("left"), F.col("_right").alias("right"))


def positional_pairs(left: DataFrame, right: DataFrame, position: str, key: str) -> DataFrame:
    """``position, left, right``: the rows at the same place of two tables, whose ``key`` must agree.

    Fails where one side is longer, or where the keys at a place differ.
    """
    a = left.select(F.col(position), F.struct(*left.columns).alias("left"))
    b = right.select(F.col(position), F.struct(*right.columns).alias("right"))
    paired = a.join(b, position, "full")
    same = F.col("left").isNotNull() & F.col("right").isNotNull() & F.col("left")[key].eqNullSafe(F.col("right")[key])
    fault = F.raise_error(F.concat(F.lit("ids do not match at place "), F.col(position).cast("string")))
    return paired.where(F.when(same, F.lit(True)).otherwise(fault.cast("boolean"))).select(position, "left", "right")


def best_match(pairs: DataFrame, key: str, exact: Column, rank: Column, position: str) -> DataFrame:
    """For each key the exact match with the highest rank, else the highest rank; first one at ties.

    An aggregate with map-side combining, like :func:`keep_first`.
    """
    order = F.struct((-F.coalesce(exact, F.lit(False)).cast("int")).alias("e"), rank.isNull().alias("n"), (-rank).alias("r"), F.col(position).alias("p"))
    rest = [c for c in pairs.columns if c != key]
    best = pairs.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_row"))
    return best.select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in pairs.columns])
