"""Exact top-k inner products by a dual-tree search over cover trees.

The upper levels of the data tree are a net of pivots, taken farthest first from a
bounded sample, so that any prefix of the net is a cover tree level. Every row joins
its nearest pivot's cell, and each pivot belongs to the nearest of the first ones. The
net grows with the root of the rows. A first pivot's rows are dealt to blocks of bounded
size, each with a cover tree of its own. Queries form blocks in the same way.

A pair of a query node and a data node is left out when no product between them can
reach the worst kth score that the node's queries already have. For centres p, q and
covering radii a, b a product is at most <p, q> + a |q| + b |p| + a b. First every
query block meets its own first pivot's rows, which gives it kth scores to start from;
then it gets, of the other ones, the rows of those cells that its bounds leave, and inside
a pair of blocks both trees are descended together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import by_batches, col, stored

BLOCK = 1024
QUERY_BLOCK = 512
LEAF = 64
#: Pivots of the upper level, and of the whole net at most; a net's cells have a row each in
#: what is sent to every task.
COARSE, MOST_PIVOTS = 16, 1024
#: Below any score, and still a number after its sign is turned.
NOTHING = -(1 << 63) + 1
#: Products are exact in doubles while their parts stay below this.
EXACT = float(1 << 53)


def farthest_first(points: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of a net, each point the farthest from those before, and their distances."""
    if not len(points):
        return np.zeros(0, int), np.zeros(0)
    chosen, reach = [0], [np.inf]
    gap = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < min(most, len(points)):
        far = int(gap.argmax())
        if gap[far] <= 0:
            break
        chosen.append(far)
        reach.append(float(gap[far]))
        gap = np.minimum(gap, np.linalg.norm(points - points[far], axis=1))
    return np.array(chosen), np.array(reach)


@dataclass
class Node:
    """The rows ``first`` to ``last`` of the tree's order, around a centre."""

    first: int
    last: int
    centre: np.ndarray
    norm: float
    radius: float
    children: list[Node]


class CoverTree:
    """Rows grouped into nested covers: each node's children are a net of its rows."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, fan: int = 8) -> None:
        self.order = np.arange(len(points))
        self.points = points.astype(np.float64)
        self.leaf, self.fan = leaf, fan
        self.root = self._node(0, len(points))
        self.points = self.points[self.order]

    def _node(self, first: int, last: int) -> Node:
        own = self.points[self.order[first:last]]
        middle = own.mean(0)
        gap = np.linalg.norm(own - middle, axis=1)
        centre = own[int(gap.argmin())]
        radius = float(np.linalg.norm(own - centre, axis=1).max())
        node = Node(first, last, centre, float(np.linalg.norm(centre)), radius, [])
        if last - first > self.leaf and radius > 0:
            net, _ = farthest_first(own, self.fan)
            gaps = np.stack([np.linalg.norm(own - own[p], axis=1) for p in net])
            nearest = gaps.argmin(0)
            rank = np.argsort(nearest, kind="stable")
            self.order[first:last] = self.order[first:last][rank]
            sizes = np.bincount(nearest, minlength=len(net))
            at = first
            for size in sizes[sizes > 0]:
                node.children.append(self._node(at, at + int(size)))
                at += int(size)
        return node


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows; in doubles where these are exact."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if largest < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class TopK:
    """For each query the k best scores so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        #: Products that were computed.
        self.visited = 0
        self.scores = np.full((queries, k), NOTHING)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge a matrix of scores of some queries against rows with the given ids."""
        if scores.shape[1] > self.k:
            edge = -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1]
            columns = np.flatnonzero((scores >= np.maximum(edge, self.scores[at, -1])[:, None]).any(0))
            scores, ids = scores[:, columns], ids[columns]
        scores = np.concatenate([self.scores[at], scores], 1)
        both = np.concatenate([self.ids[at], np.broadcast_to(ids, (len(at), len(ids)))], 1)
        order = np.lexsort((both, -scores))[:, : self.k]
        self.scores[at] = np.take_along_axis(scores, order, 1)
        self.ids[at] = np.take_along_axis(both, order, 1)


def dual_search(queries: np.ndarray, own: np.ndarray, floors: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> TopK:
    """The k best rows of each query among those that reach its floor, by both trees."""
    best = TopK(len(queries), k)
    # Bounds are sums of doubles; the slack keeps rounding from cutting a tie.
    qtree, dtree = CoverTree(queries), CoverTree(rows)
    norms = np.linalg.norm(queries.astype(np.float64), axis=1)
    todo = [(qtree.root, dtree.root)]
    while todo:
        q, d = todo.pop()
        members = qtree.order[q.first : q.last]
        bound = q.centre @ d.centre + q.radius * d.norm + d.radius * q.norm + q.radius * d.radius
        worst = np.maximum(floors[members], best.scores[members, -1]).min()
        if bound + 1 + abs(bound) * 1e-9 < worst:
            continue
        if not q.children:
            # Below a query leaf each query has a bound of its own, which is tighter.
            own_bounds = qtree.points[q.first : q.last] @ d.centre + norms[members] * d.radius
            reach = np.maximum(floors[members], best.scores[members, -1])
            members = members[own_bounds + 1 + np.abs(own_bounds) * 1e-9 >= reach]
            if not len(members):
                continue
        if not q.children and not d.children:
            at = dtree.order[d.first : d.last]
            scores = products(queries[members], rows[at])
            best.visited += scores.size
            itself = own[members][:, None] == ids[at][None, :]
            scores[itself] = NOTHING
            best.add(members, scores, ids[at])
        elif d.children and (not q.children or d.radius >= q.radius):
            near = sorted(d.children, key=lambda c: float(q.centre @ c.centre))
            todo.extend((q, child) for child in near)
        else:
            todo.extend((child, d) for child in q.children)
    return best


def parents_of(net: np.ndarray, coarse: int = COARSE) -> np.ndarray:
    """For each pivot the nearest of the first ones."""
    gaps = np.stack([np.linalg.norm(net - pivot, axis=1) for pivot in net[:coarse]])
    return gaps.argmin(0)


def cells_left(queries: np.ndarray, floors: np.ndarray, net: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """By query and cell whether a row of the cell can reach the query's floor.

    ``radii`` are the covering radii of the cells, below zero for cells without rows.
    """
    bounds = queries @ net.T + np.linalg.norm(queries, axis=1)[:, None] * np.maximum(radii, 0)
    return (bounds + 1 + np.abs(bounds) * 1e-9 >= floors[:, None]) & (radii >= 0)


def floored(vectors: pa.Array, factor: int) -> list[np.ndarray | None]:
    """floor(factor * x) of every component; nothing where one is NULL or not finite."""
    out: list[np.ndarray | None] = []
    for vector in vectors.to_pylist():
        if vector is None or any(x is None for x in vector):
            out.append(None)
            continue
        scaled = np.floor(np.array(vector, np.float64) * factor)
        out.append(scaled.astype(np.int64) if (np.abs(scaled) < 2.0**62).all() else None)
    return out


def _matrix(values: pd.Series, dim: int) -> np.ndarray:
    flat = np.frombuffer(b"".join(values), np.int64)
    return flat.reshape(len(values), dim)


def top_k(
    df: DataFrame,
    k: int = 5,
    every: int = 50,
    factor: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    pivots: int | None = None,
    sample: int = 4096,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best rows of each query.

    Queries are the rows whose key is divisible by ``every``; a query's candidates are
    all rows with another key and a vector of the same length. Fewer candidates than k
    give fewer rows. The score is the integer inner product of the floored vectors, and
    equal scores go to the smaller key.

    The net has ``pivots``, or the root of the number of rows and MOST_PIVOTS at most. It is
    fitted on ``sample`` rows, those with the smallest hashes; every row is indexed. Rows with a NULL key, a NULL vector or a component that is NULL or not
    finite (or beyond 62 bits) take no part. A repeated key is a row of its own as
    candidate, and one query, with its first vector, as query. An empty table gives an
    empty result; other columns are not read.
    """
    spark = df.sparkSession

    def ints(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        made = floored(batch.column(1), factor)
        at = [i for i, v in enumerate(made) if v is not None]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(at, pa.int64())),
                pa.array([len(made[i]) for i in at], pa.int32()),
                pa.array([made[i].tobytes() for i in at], pa.binary()),
            ],
            ["id", "dim", "v"],
        )

    slim = df.select(col(key).cast("long").alias("id"), col(vector).cast("array<double>").alias("v"))
    slim = slim.where("id is not null")
    rows = stored(slim.mapInArrow(by_batches(ints, 4096), "id long, dim int, v binary"), "vectors")

    if pivots is None:
        pivots = min(MOST_PIVOTS, max(COARSE, math.isqrt(rows.count())))
    nets: dict[int, np.ndarray] = {}
    parents: dict[int, np.ndarray] = {}
    drawn = rows.select("dim", "v", F.xxhash64("id", "v").alias("hash")).orderBy("hash", "v").limit(sample)
    held: dict[int, list[np.ndarray]] = {}
    for row in drawn.collect():
        held.setdefault(row["dim"], []).append(np.frombuffer(bytes(row["v"]), np.int64).astype(np.float64))
    for dim, points in held.items():
        net, _ = farthest_first(np.array(points).reshape(len(points), dim), pivots)
        nets[dim] = np.array(points).reshape(len(points), dim)[net]
        parents[dim] = parents_of(nets[dim])
    sent = spark.sparkContext.broadcast((nets, parents))

    def cells(batch: pa.RecordBatch) -> pa.RecordBatch:
        dims = batch.column("dim").to_numpy()
        raw = batch.column("v").to_pylist()
        cell, reach, coarse = np.zeros(len(dims), np.int64), np.zeros(len(dims)), np.zeros(len(dims), np.int64)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            points = np.frombuffer(b"".join(raw[i] for i in at), np.int64).reshape(len(at), dim)
            points = points.astype(np.float64)
            net = sent.value[0].get(int(dim), np.zeros((1, dim)))
            above = sent.value[1].get(int(dim), np.zeros(1, np.int64))
            squares = (points**2).sum(1)[:, None] + (net**2).sum(1) - 2 * points @ net.T
            cell[at] = squares.argmin(1)
            reach[at] = np.linalg.norm(points - net[cell[at]], axis=1)
            coarse[at] = above[cell[at]]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(cell), pa.array(coarse), pa.array(reach)],
            ["id", "dim", "v", "fine", "cell", "reach"],
        )

    shape = "id long, dim int, v binary, fine long, cell long, reach double"
    rows = stored(rows.mapInArrow(by_batches(cells, 4096), shape), "cells")
    isquery = F.col("id") % every == 0
    counted = (
        rows.groupBy("dim", "cell", "fine")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("reach").alias("radius"),
            F.sum(isquery.cast("long")).alias("queries"),
        )
        .collect()
    )
    # One entry for each cell of the net, so its size is bounded by the parameters.
    info: dict[tuple[int, int], list[int]] = {}
    radii: dict[int, np.ndarray] = {}
    for r in counted:
        held_here = info.setdefault((r["dim"], r["cell"]), [0, 0])
        held_here[0] += r["n"]
        held_here[1] += r["queries"]
        of_dim = radii.setdefault(r["dim"], np.full(max(len(nets.get(r["dim"], ())), 1), -1.0))
        of_dim[r["fine"]] = r["radius"]

    blocks = spark.createDataFrame(
        [(dim, cell, -(-n // BLOCK), max(1, -(-q // QUERY_BLOCK))) for (dim, cell), (n, q) in info.items()],
        "dim int, cell long, blocks long, qblocks long",
    )
    hashed = F.xxhash64("id", "v")
    dealt = rows.join(F.broadcast(blocks), ["dim", "cell"]).select(
        "id",
        "dim",
        "v",
        "cell",
        "fine",
        F.pmod(hashed, F.col("blocks")).alias("block"),
        F.pmod(hashed, F.col("qblocks")).alias("qblock"),
        "blocks",
    )
    data = dealt.select(
        "id",
        "v",
        F.col("dim").alias("row_dim"),
        F.col("cell").alias("row_cell"),
        F.col("fine").alias("row_fine"),
        F.col("block").alias("row_block"),
    )
    first = Window.partitionBy("id").orderBy("v")
    queries = dealt.where(isquery).withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")
    queries = stored(queries.select("id", "dim", "v", "cell", "qblock", "blocks"), "queries")

    result = "query_id long, vec_id long, score long"

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """One block of queries against one block of rows."""
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        if left.empty or right.empty:
            return empty
        dim = int(left["dim"].iloc[0])
        best = dual_search(
            _matrix(left["v"], dim),
            left["id"].to_numpy(),
            left["floor"].to_numpy(),
            _matrix(right["v"], dim),
            right["id"].to_numpy(),
            k,
        )
        some = best.scores > NOTHING
        owner = np.broadcast_to(left["id"].to_numpy()[:, None], best.ids.shape)
        return pd.DataFrame({"query_id": owner[some], "vec_id": best.ids[some], "score": best.scores[some]})

    # The grid of pairs: rows go to the query blocks that need their cell, queries to
    # the blocks of its first pivot, and a task holds one block of either.
    def pairs(wanted: DataFrame, needed: str | None = None) -> DataFrame:
        """``wanted``: queries with ``to_cell`` and ``floor``; ``needed`` has the cells below, else all are."""
        at = ["dim", "to_cell", "block", "cell", "qblock"]
        to = ["row_dim", "row_cell", "row_block", "for_cell", "for_qblock"]
        blocks_there = F.sequence(F.lit(0).cast("long"), F.col("to_blocks") - 1)
        left = wanted.withColumn("block", F.explode(blocks_there))
        names = {"dim": "row_dim", "to_cell": "row_cell", "cell": "for_cell", "qblock": "for_qblock"}
        needs = wanted.select(
            *[F.col(name).alias(new) for name, new in names.items()],
            *([F.explode(needed).alias("row_fine")] if needed else []),
        ).distinct()
        right = data.join(needs, ["row_dim", "row_cell", *(["row_fine"] if needed else [])])
        left = left.drop(needed) if needed else left
        return left.groupBy(*at).cogroup(right.groupBy(*to)).applyInPandas(search, result)

    def best_of(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    home = queries.withColumn("to_cell", F.col("cell")).withColumn("to_blocks", F.col("blocks"))
    home = best_of(stored(pairs(home.withColumn("floor", F.lit(NOTHING))), "home"))
    home = stored(home, "home")
    floors = home.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    asked = queries.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(NOTHING)))

    sizes = {place: -(-n // BLOCK) for place, (n, _) in info.items()}
    keys = ["id", "dim", "v", "cell", "qblock", "floor"]

    def targets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each query the first pivots, other than its own, with the cells that its bound leaves."""
        nets, parents = sent.value
        for batch in batches:
            table = batch.select(keys).to_pydict()
            out: list[list] = [[] for _ in range(len(keys) + 3)]
            dims = np.array(table["dim"])
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                points = np.frombuffer(b"".join(table["v"][i] for i in at), np.int64).reshape(len(at), dim)
                floors = np.array([table["floor"][i] for i in at], np.float64)
                net = nets.get(int(dim), np.zeros((1, dim)))
                above = parents.get(int(dim), np.zeros(1, np.int64))
                left = cells_left(points.astype(np.float64), floors, net, radii[int(dim)])
                for i, cells in zip(at.tolist(), left, strict=True):
                    found = np.flatnonzero(cells)
                    for cell in np.unique(above[found]).tolist():
                        if cell != table["cell"][i]:
                            made = [*(table[n][i] for n in keys), cell, sizes[int(dim), cell], found[above[found] == cell]]
                            for column, value in zip(out, made, strict=True):
                                column.append(value)
            types = [pa.int64(), pa.int32(), pa.binary(), *[pa.int64()] * 5, pa.list_(pa.int64())]
            arrays = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [*keys, "to_cell", "to_blocks", "needed"])

    shape = "id long, dim int, v binary, cell long, qblock long, floor long, to_cell long, to_blocks long, needed array<long>"
    away = stored(asked.mapInArrow(targets, shape), "targets")
    found = home.select("query_id", "vec_id", "score").union(pairs(away, "needed"))
    return best_of(stored(found, "found")).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
