"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors within a cosine of each other lie within a Euclidean distance eps of each other. They are sorted by the
grid cells of width eps of their leading principal coordinates, cut into blocks, and blocks are joined with those
that are not provably further away: within a pair of blocks, sequence intervals are halved again and again, and two
intervals whose boxes are further apart than eps are skipped. Intervals that are provably within eps as a whole are
linked without looking at their pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from keytables.llm import vectors as V
from keytables.llm.components import connected_components
from keytables.llm.frames import extended, tidy
from keytables.sources.scratch import write_scratch

# Coordinates that make up the order, and those by which blocks find each other.
AXES, MEETING_AXES = 8, 3
BLOCK, LEAF = 2048, 128
# The principal axes are those of about so many vectors; any axes give the same links.
SAMPLE = 4000
_SLACK = 1e-9


def principal_axes(sample: np.ndarray, axes: int = AXES) -> np.ndarray:
    """The leading principal axes of the unit vectors of ``sample``, as columns."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    centred = unit - unit.mean(axis=0)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    return vectors[:, ::-1][:, :axes]


class Block:
    """Vectors in grid order: unit vectors, coordinates on the leading axes, and how many rows each stands for."""

    def __init__(self, raw: bytes, weight: list[int], axes: np.ndarray):
        x = np.frombuffer(raw, np.float64).reshape(len(weight), -1)
        self.unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        self.coordinates = self.unit @ axes
        self.weight = np.asarray(weight, np.int64)
        self.links = np.zeros(len(weight), np.int64)


class PairJoin:
    """The links between two blocks, or within one: their numbers for each vector, and a forest of them."""

    def __init__(self, a: Block, b: Block, least: float):
        self.a, self.b, self.least = a, b, least
        self.same = a is b
        self.reach = 2 - 2 * least
        self.parent = list(range(len(a.weight) + (0 if self.same else len(b.weight))))
        self.shift = 0 if self.same else len(a.weight)

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def unite(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)

    def run(self, i0: int, i1: int, j0: int, j1: int) -> None:
        p, q = self.a.coordinates[i0:i1], self.b.coordinates[j0:j1]
        gap = np.maximum(p.min(axis=0) - q.max(axis=0), q.min(axis=0) - p.max(axis=0)).clip(0)
        if gap @ gap > self.reach + _SLACK:
            return
        if max(i1 - i0, j1 - j0) <= LEAF:
            self.leaf(i0, i1, j0, j1)
            return
        if self.same and i0 == j0:
            if self.whole(i0, i1, j0, j1):
                return
            middle = (i0 + i1) // 2
            self.run(i0, middle, i0, middle)
            self.run(i0, middle, middle, i1)
            self.run(middle, i1, middle, i1)
        elif self.whole(i0, i1, j0, j1):
            return
        elif i1 - i0 >= j1 - j0:
            middle = (i0 + i1) // 2
            self.run(i0, middle, j0, j1)
            self.run(middle, i1, j0, j1)
        else:
            middle = (j0 + j1) // 2
            self.run(i0, i1, j0, middle)
            self.run(i0, i1, middle, j1)

    def whole(self, i0: int, i1: int, j0: int, j1: int) -> bool:
        """Link the two intervals as a whole if they provably lie within reach of each other."""
        x, y = self.a.unit[i0:i1], self.b.unit[j0:j1]
        c, d = x.mean(axis=0), y.mean(axis=0)
        span = np.linalg.norm(x - c, axis=1).max() + np.linalg.norm(y - d, axis=1).max() + np.linalg.norm(c - d)
        if span * span > self.reach - _SLACK:
            return False
        self.count(i0, i1, j0, j1, np.ones((i1 - i0, j1 - j0), bool) if self.same and i0 == j0 else None)
        for i in range(i0, i1):
            self.unite(i0, i)
        for j in range(j0, j1):
            self.unite(i0, self.shift + j)
        return True

    def count(self, i0: int, i1: int, j0: int, j1: int, near: np.ndarray | None) -> None:
        a, b = self.a, self.b
        if near is None:  # all of them, on two different intervals
            a.links[i0:i1] += b.weight[j0:j1].sum()
            b.links[j0:j1] += a.weight[i0:i1].sum()
            return
        a.links[i0:i1] += near @ b.weight[j0:j1]
        if self.same and i0 == j0:
            a.links[i0:i1] -= a.weight[i0:i1] * near.diagonal()
        else:
            b.links[j0:j1] += near.T @ a.weight[i0:i1]

    def leaf(self, i0: int, i1: int, j0: int, j1: int) -> None:
        near = self.a.unit[i0:i1] @ self.b.unit[j0:j1].T >= self.least
        if self.same and i0 == j0:
            np.fill_diagonal(near, True)
        if not near.any():
            return
        self.count(i0, i1, j0, j1, near)
        label = np.full(near.shape[0], near.size)
        other = np.arange(near.shape[1])
        while True:  # the smallest linked column, spread until nothing changes
            mine = np.where(near, other, near.size).min(axis=1)
            theirs = np.minimum(other, np.where(near, mine[:, None], near.size).min(axis=0))
            if (mine == label).all() and (theirs == other).all():
                break
            label, other = mine, theirs
        for i in np.flatnonzero(label < near.size):
            self.unite(i0 + int(i), self.shift + j0 + int(label[i]))
        for j in np.flatnonzero(other != np.arange(near.shape[1])):
            self.unite(self.shift + j0 + int(j), self.shift + j0 + int(other[j]))


def link_vectors(vectors: DataFrame, least: float = 0.95, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept``: the near-duplicate group of every vector.

    Two vectors are linked if their cosine in double precision is ``least`` or more, whatever else their rows hold.
    ``n_links`` counts the others linked directly, ``component_id`` is the smallest id that links lead to. A vector
    that is null, zero, holds null or non-finite components, or has another number of components
    than most, links with nothing. Equal vectors are joined as one, told apart from others by a 64-bit hash, and counted
    as many. Rows that share an id, or have none, count as rows, so each gives a row with its own vector's links; a
    group in which no row has an id has none either. Other columns are not read. ``least`` must be over 0.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be over 0 and at most 1")
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(column).cast("array<double>").alias("x"))
    dim = V.dimension(rows, "x")
    good = V.comparable(rows, dim, "x")
    # Each distinct vector is a node named by its hash, since rows that share an id may hold different vectors.
    distinct = good.groupBy("x").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("weight"))
    points = write_scratch(distinct.withColumn("rep", F.xxhash64("x")), "grid-points")
    axes = np.eye(max(dim, 1))[:, :AXES] if dim == 0 else principal_axes(V.sample_matrix(points, SAMPLE, "rep", "x"))
    links, edges = _block_links(points.select("rep", "weight", "x"), axes, least)
    groups = connected_components(edges)
    counted = points.join(links.groupBy("rep").agg(F.sum("links").alias("links")), on="rep", how="left")
    placed = counted.join(groups.withColumnRenamed("node", "rep"), on="rep", how="left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    names = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = placed.join(names, on="component").select(
        "x", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    # Only usable vectors are looked up, so that the others, however many, do not meet in one task.
    known = good.join(named, on="x").select("vec_id", "n_links", "component_id")
    unknown = rows.where(~(V.usable(F.col("x")) & (F.size("x") == dim)))
    alone = unknown.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return known.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _block_links(points: DataFrame, axes: np.ndarray, least: float) -> tuple[DataFrame, DataFrame]:
    """``rep, links`` in parts to be added up, and ``a, b`` edges that hold the components together."""
    eps = math.sqrt(2 - 2 * least) + 1e-6
    used = min(AXES, axes.shape[1])
    names = [f"c{i}" for i in range(used)]
    id_type = dict(points.dtypes)["rep"]

    def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = V.matrix(batch["x"])
            if len(x):
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                grid = np.floor(unit @ axes / eps).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(grid[:, i]) for i in range(used))], [*batch.schema.names, *names])

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = np.arange(n, n + batch.num_rows)
            n += batch.num_rows
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, part)), pa.array(at)]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "weight", "x", "part", "at"])

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        x = V.matrix(table["x"])
        at = x / np.linalg.norm(x, axis=1, keepdims=True) @ axes
        return pa.table(
            {
                "block": pa.array([table["block"][0].as_py()], pa.int64()),
                "reps": pa.array([table["rep"].to_pylist()], pa.list_(table.schema.field("rep").type)),
                "weights": pa.array([table["weight"].to_pylist()], pa.list_(pa.int64())),
                "raw": pa.array([x.tobytes()], pa.binary()),
                "low": pa.array([at.min(axis=0).tolist()]),
                "high": pa.array([at.max(axis=0).tolist()]),
            }
        )

    schema = extended(points.schema, **{name: IntegerType() for name in names})
    ordered = (
        points.mapInArrow(tidy(cells), schema)
        .repartitionByRange(*names)
        .sortWithinPartitions(*names)
        .select("rep", "weight", "x")
        .mapInArrow(tidy(number), f"rep {id_type}, weight long, x array<double>, part long, at long")
    )
    ordered = write_scratch(ordered, "grid-order")
    # Places in the whole order come from one row per partition; blocks are of so many places.
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = ordered.join(firsts, on="part").withColumn("place", F.col("first") + F.col("at"))
    blocks = (
        placed.withColumn("block", F.floor(F.col("place") / BLOCK))
        .select("block", "place", "rep", "weight", "x")
        .groupBy("block")
        .applyInArrow(
            pack, f"block long, reps array<{id_type}>, weights array<long>, raw binary, low array<double>, high array<double>"
        )
    )
    blocks = write_scratch(blocks, "grid-blocks")

    # Blocks meet in the cells that their boxes, one of them widened by eps, have in common.
    def in_cells(name: str, widen: int) -> DataFrame:
        found = blocks.select(F.col("block").alias(name), F.col("low").alias(f"l_{name}"), F.col("high").alias(f"h_{name}"))
        for i in range(min(MEETING_AXES, used)):
            low, high = (F.floor(F.col(f"{s}_{name}")[i] / eps) for s in ("l", "h"))
            found = found.withColumn(f"m{i}", F.explode(F.sequence(low - widen, high + widen)))
        return found

    meet = [f"m{i}" for i in range(min(MEETING_AXES, used))]
    gap = F.zip_with(
        F.zip_with("l_a", "h_b", lambda x, y: x - y),
        F.zip_with("l_b", "h_a", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    distance = F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g)
    pairs = (
        in_cells("a", 0)
        .join(in_cells("b", 1), on=meet)
        .where((F.col("a") <= F.col("b")) & (distance <= eps * eps + 1e-6))
        .select("a", "b")
        .distinct()
    )

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                get = lambda name: one[name][0].as_py()
                same = get("a") == get("b")
                a = Block(get("raw_a"), get("weights_a"), axes)
                b = a if same else Block(get("raw_b"), get("weights_b"), axes)
                found = PairJoin(a, b, least)
                found.run(0, len(a.weight), 0, len(b.weight))
                reps = get("reps_a") + ([] if same else get("reps_b"))
                links = a.links if same else np.concatenate([a.links, b.links])
                roots = [reps[found.root(i)] for i in range(len(reps))]
                some = [i for i in range(len(reps)) if links[i] or roots[i] != reps[i]]
                kind = batch.schema.field("reps_a").type.value_type
                yield pa.RecordBatch.from_arrays(
                    [pa.array([reps[i] for i in some], kind), pa.array(links[some]), pa.array([roots[i] for i in some], kind)],
                    ["rep", "links", "root"],
                )

    def side(name: str) -> DataFrame:
        return blocks.select(F.col("block").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("reps", "weights", "raw")))

    found = (
        pairs.join(side("a"), on="a")
        .join(side("b"), on="b")
        .mapInArrow(tidy(join), f"rep {id_type}, links long, root {id_type}")
    )
    found = write_scratch(found, "grid-links")
    return found, found.select(F.col("rep").alias("a"), F.col("root").alias("b"))
