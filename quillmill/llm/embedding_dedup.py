"""Embedding near-dedup with randomised-rotation binary codes.

Each vector is normalized and rotated by one random orthogonal matrix; the signs of the result are
its code, and the code's inner product with the rotated vector is stored as correction factor.  Code
times rotated query over the factor estimates the cosine without bias, with a confidence bound that
shrinks with the dimension (Gao and Long, 2024).  Pairs whose upper bound misses the threshold are
dropped; only the others are recomputed in double precision.

Which pairs meet at all: only vectors of one label do, and those equal to the bit are one weighted
node, known by 128 bits and named by the number of one of its rows.  A label of up to two cells' size
is one cell, so that all its pairs meet.  A larger one gets pivots of its own, from a bounded sample:
nodes belong to the cell of the pivot at the smallest angle and also visit cells whose pivot is at
most ``margin`` degrees further.  Two linked nodes are at most ``acos(0.93)`` = 21.6 degrees apart, and
then one of them is within that angle of visiting the other's cell; with that margin no link is lost.
Angles to a pivot differ by far less than the angle between two vectors, the less the more dimensions
there are, so the default margin is 48 degrees over the root of the dimension (6 for 64): for random
pairs at the very threshold this finds 0.998 of the links with up to 4,096 pivots, in 8 to 384
dimensions, and a node visits 2 cells of 6, 4 of 33, 9 of 300, 17 of 4,096.  Cells beyond a task's
size are dealt as pairs of parts.  A task returns a count and one tie for each of its rows, never its
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import discard, materialize, tidied
from quillmill.llm.components import connected_components

PLACED = "node long, weight long, label long, dim int, home int, cell int, visits array<int>, vector binary, code binary, factor double"


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix of the dimension."""
    q, r = np.linalg.qr(np.random.default_rng(seed + dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def normalized(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow, no underflow
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign codes and correction factors of unit vectors."""
    turned = unit @ turn
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])


def estimate(codes: np.ndarray, factors: np.ndarray, queries: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosine of each coded vector with each rotated query, and each code's error bound."""
    dim = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    values = (signs @ queries.T.astype(np.float32)) / (np.sqrt(dim) * factors)[:, None].astype(np.float32)
    bounds = epsilon * np.sqrt(np.maximum(0, 1 - factors**2)) / (factors * np.sqrt(max(1, dim - 1)))
    return values, bounds


def choose_pivots(classes: DataFrame, cell_rows: int, most_pivots: int) -> dict[tuple[int, int], np.ndarray]:
    """Unit pivots of the labels (and dimensions) beyond two cells' size, about one for ``cell_rows`` nodes.

    There are ``most_pivots`` at most, dealt to the largest labels in proportion, and 16 MB of them.
    """
    counts = classes.groupBy("label", "dim").agg(F.count("*").alias("n")).where(F.col("n") >= 2 * cell_rows)
    largest = counts.orderBy(F.desc("n"), "label", "dim").limit(max(1, most_pivots // 2)).collect()
    if not largest:
        return {}
    room = min(most_pivots, (16 << 20) // (8 * max(r.dim for r in largest)))
    wanted = [r.n // cell_rows for r in largest]
    scale = min(1.0, room / sum(wanted))
    shares = [(r.label, r.dim, max(2.0, w * scale) / r.n) for r, w in zip(largest, wanted)]
    spark = classes.sparkSession
    listed = spark.createDataFrame(shares, "label long, dim int, share double")
    place = F.xxhash64(F.lit("pivot"), "node").cast("double") / 2.0**64 + 0.5
    picked = classes.join(F.broadcast(listed), ["label", "dim"]).where(place <= F.col("share")).select("label", "dim", "node", "vector").limit(4 * room + 8 * len(shares)).collect()
    pivots: dict[tuple[int, int], list] = {}
    for r in sorted(picked, key=lambda r: r.node):
        pivots.setdefault((r.label, r.dim), []).append(r.vector)
    return {k: normalized(np.array(v, np.float64)) for k, v in pivots.items()}


def default_margin(dim: int, threshold: float) -> float:
    """Degrees by which a visited pivot may be further than the nearest one."""
    return min(float(np.degrees(np.arccos(threshold))), 48 / np.sqrt(dim))


def place(classes: DataFrame, pivots: dict[tuple[int, int], np.ndarray], margin: float | None, threshold: float) -> DataFrame:
    """A row for each node and each cell it is in: its home and those it visits."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            out = []
            sizes, labels = np.asarray(batch.column("dim")), np.asarray(batch.column("label"))
            arrays = batch.column("vector").to_pylist()
            names = [batch.column(c).to_pylist() for c in ("node", "weight", "label")]
            for dim in np.unique(sizes).tolist():
                if dim not in turns:
                    turns[dim] = rotation(dim)
                wide = default_margin(dim, threshold) if margin is None else margin
                for label in np.unique(labels[sizes == dim]).tolist():
                    at = np.flatnonzero((sizes == dim) & (labels == label)).tolist()
                    unit = normalized(np.array([arrays[i] for i in at], np.float64))
                    codes, factors = encode(unit, turns[dim])
                    own = known.get((label, dim))
                    angles = np.zeros((len(at), 1)) if own is None else np.degrees(np.arccos(np.clip(unit @ own.T, -1, 1)))
                    homes = angles.argmin(axis=1)
                    near = angles <= angles.min(axis=1, keepdims=True) + wide
                    for k, i in enumerate(at):
                        visits = np.flatnonzero(near[k]).tolist()
                        fixed = (*(x[i] for x in names), dim, int(homes[k]))
                        out += [(*fixed, c, visits, unit[k].tobytes(), codes[k].tobytes(), float(factors[k])) for c in visits]
            kinds = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.float64()]
            columns = list(zip(*out)) if out else [[]] * 10
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in PLACED.split(", ")])

    return classes.select("node", "weight", "label", "dim", "vector").mapInArrow(tidied(run), PLACED)


class Ties:
    """Union-find over row numbers."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, rows: np.ndarray) -> np.ndarray:
        found = self.root[rows]
        while (up := self.root[found]).tolist() != found.tolist():
            found = up
        self.root[rows] = found
        return found

    def tie(self, row: int, others: np.ndarray) -> None:
        roots = np.unique(self.find(np.append(others, row)))
        self.root[roots] = roots[0]


def solve_cell(rows: list[tuple], first_part: int, second_part: int, threshold: float, epsilon: float, strip: int = 512) -> list[tuple]:
    """Links of one task: ``node, links, tied_to`` for each row that has a link in it.

    Rows are (node, weight, dim, home, cell, visits, vector, code, factor, part); the task compares
    the first part's residents with the second part's, and, where both are the same, with visitors.
    """
    dim = rows[0][2]
    resident = np.array([r[3] == r[4] for r in rows])
    part = np.array([r[9] for r in rows])
    unit = np.frombuffer(b"".join(r[6] for r in rows), np.float64).reshape(len(rows), dim)
    codes = np.frombuffer(b"".join(r[7] for r in rows), np.uint8).reshape(len(rows), -1)
    factors, weights = np.array([r[8] for r in rows]), np.array([r[1] for r in rows])
    left = np.flatnonzero(resident & (part == first_part))
    right = np.flatnonzero(resident & (part == second_part))
    if first_part == second_part:
        right = np.concatenate([right, np.flatnonzero(~resident)])
    queries = unit[right] @ rotation(dim)
    home = np.array([r[3] for r in rows])
    cells = int(max(home.max(), max(max(r[5]) for r in rows))) + 1
    visited = np.concatenate([np.array(r[5], np.int64) + k * cells for k, r in enumerate(rows)])
    links, ties, linked = np.zeros(len(rows), np.int64), Ties(len(rows)), np.zeros(len(rows), bool)
    for lo in range(0, len(left), strip):
        own = left[lo : lo + strip]
        values, bounds = estimate(codes[own], factors[own], queries, epsilon)
        i, j = np.nonzero(values + bounds[:, None] >= threshold)
        if len(i) * 8 > values.size:
            close = (unit[own] @ unit[right].T)[i, j] >= threshold
        else:
            close = np.concatenate([np.einsum("ij,ij->i", unit[own[i[k : k + 65536]]], unit[right[j[k : k + 65536]]]) >= threshold for k in range(0, len(i), 65536)]) if len(i) else np.zeros(0, bool)
        i, j = own[i[close]], right[j[close]]
        once = i < j if first_part == second_part else i != j
        once |= ~resident[j]
        i, j = i[once], j[once]
        if not resident[j].all():  # a pair found from both homes: the smaller cell counts it
            keep = resident[j] | (home[i] < home[j]) | ~np.isin(i * cells + home[j], visited)
            i, j = i[keep], j[keep]
        np.add.at(links, i, weights[j])
        np.add.at(links, j, weights[i])
        linked[i] = linked[j] = True
        cuts = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else []
        for a, b in zip(cuts, [*cuts[1:], len(i)]):
            ties.tie(int(i[a]), j[a:b])
    some = np.flatnonzero(linked)
    roots = ties.find(some) if len(some) else some
    return [(rows[k][0], int(links[k]), rows[r][0]) for k, r in zip(some.tolist(), roots.tolist())]


def solve_tasks(threshold: float, epsilon: float):
    """Arrow function over rows sorted by task."""
    fields = ("task", "node", "weight", "dim", "home", "cell", "visits", "vector", "code", "factor", "part")

    def emit(task: str, held: list[tuple]):
        first, second = map(int, task.split("/")[-2:])
        out = solve_cell(held, first, second, threshold, epsilon)
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], ["node", "links", "tied_to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, []
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in fields)):
                if r[0] != task:
                    if held:
                        yield emit(task, held)
                    task, held = r[0], []
                held.append(r[1:])
        if held:
            yield emit(task, held)

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, cell_rows: int = 1500, most_pivots: int = 16384, margin: float | None = None, epsilon: float = 4.5, part_rows: int = 3000, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row.

    A vector that is null, empty, zero, or has a null or non-finite component links with nothing, as
    does one with a null label, or of another dimension: 0 links, its own id as component, kept.  Equal
    vectors link with each other.  Rows with a null id take part, name no component, and are not
    kept.  Of pairs at the threshold to the last bit, either answer is right.  An empty table gives an
    empty result.  ``margin`` in degrees; ``acos(threshold)`` makes sure that no link is lost.
    """
    usable = F.expr("label is not null and vector is not null and size(vector) > 0 and forall(vector, x -> coalesce(not isnan(x) and abs(x) < double('infinity'), false)) and exists(vector, x -> x <> 0)")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vector"), F.col(label).cast("long").alias("label"))
    keyed = rows.select("vec_id", "vector", "label", F.when(usable, F.xxhash64("label", "vector")).alias("k1"), F.when(usable, F.xxhash64(F.lit("second"), "vector", "label")).alias("k2"))
    written = materialize(keyed.withColumn("row", F.monotonically_increasing_id()), "vector-rows")
    named = materialize(written.where("k1 is not null").groupBy("k1", "k2").agg(F.min("row").alias("node"), F.count("*").alias("weight"), F.min("vec_id").alias("least")), "vector-names")
    sources = written.select(F.col("row").alias("node"), "label", F.col("vector").cast("array<double>").alias("vector"), F.size("vector").alias("dim"))
    classes = materialize(sources.join(named.select("node", "weight").hint("shuffle_merge"), "node"), "vector-classes")
    placed = materialize(place(classes, choose_pivots(classes, cell_rows, most_pivots), margin, threshold), "vector-cells")
    parts = materialize(placed.where("home = cell").groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / part_rows).alias("parts")), "vector-parts")
    dealt = placed.join(parts.hint("shuffle_merge"), ["label", "dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    tasks = F.expr("""transform(sequence(0, parts - 1), k -> case when home = cell then concat_ws('/', label, dim, cell, least(part, k), greatest(part, k))
        else concat_ws('/', label, dim, cell, k, k) end)""")
    sent = dealt.withColumn("task", F.explode(tasks)).drop("label", "parts")
    found = materialize(sent.repartition("task").sortWithinPartitions("task").mapInArrow(tidied(solve_tasks(threshold, epsilon)), "node long, links long, tied_to long"), "vector-links")
    counts = materialize(found.groupBy("node").agg(F.sum("links").alias("links")), "vector-counts")
    joined = connected_components(found.where("node <> tied_to").select("node", "tied_to"))
    facts = materialize(named.join(joined.hint("shuffle_merge"), "node", "left").join(counts.hint("shuffle_merge"), "node", "left").select("k1", "k2", "least", F.coalesce("component", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "vector-facts")
    least = materialize(facts.groupBy("component").agg(F.min("least").alias("component_id")), "vector-least")
    by_class = materialize(facts.join(least.hint("shuffle_merge"), "component").select("k1", "k2", "component_id", "n_links"), "vector-by-class")
    discard(named, classes, placed, parts, found, counts, joined, facts, least)
    out = written.select("vec_id", "k1", "k2").join(by_class.hint("shuffle_merge"), ["k1", "k2"], "left")
    component = F.when(F.col("k1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
