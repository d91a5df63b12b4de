"""Exact top-k inner products by a Voronoi kNN join.

Vectors and queries are grouped by their nearest pivot. Two summaries steer the join. A query group has its
pivot ``p`` and radius ``r``, the largest distance of a query from it, so for every vector ``s`` and query
``q`` of the group ``p.s - r|s| <= q.s <= p.s + r|s|``. A data group has its pivot ``c``, radius and
largest norm, which bound ``p.s + r|s|`` for all its vectors at once.

The ``k + 1`` largest lower bounds over vectors of different ids, each task contributing its own largest,
give a score that every query of the group reaches (one of the ids may be the query's own). A data group
whose bound stays below it is left out whole; of the others a vector is sent where its own bound reaches
the score. Query groups that need nearly the same data are solved together, so that where the bounds prune
little, as for spread vectors in many dimensions, data is not sent once per group: the join then is a
blockwise product with blocks of equal sides, still exact and of bounded memory.

Defined results: rows with a null id, or a vector that is null or holds null or non-finite components,
take no part; shorter vectors count as filled with zeros; rows that repeat id and vector count once;
different vectors of one id are candidates of their own, and as queries share one ranked list; candidates
with the query's own id are left out; fewer candidates than ``k`` are all returned; an empty table gives
an empty result; other columns are ignored. Scores beyond 64 bits are not supported.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm import vectors
from feedloom.llm.common import unpack
from feedloom.session import staged

PER_GROUP = 16_384  # queries of a block
PER_CHUNK = 16_384  # vectors of a block
MOST_PIVOTS = 256
MORE_WORK = 1.25  # products that solving groups together may cost, against solving them alone
ROUNDING = 1e-9  # of the sizes multiplied, far above what floating point loses
PLACED = "vec_id long, vec binary, cell int, far double, norm double"
SCHEMA = "route int, sub int, chunk int, kind int, vec_id long, vec binary"


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(axis=1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(axis=1)
    return np.sqrt(np.maximum(square, 0))


def _place(pivots: np.ndarray):
    """Every vector with its group, its distance from the pivot and its norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = unpack(batch.column(1).to_pylist(), pivots.shape[1], np.int64)
            x = whole.astype(np.float64)
            d = distances(x, pivots)
            cell = d.argmin(axis=1) if len(x) else np.zeros(0, dtype=int)
            far = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            packed = pa.array([v.tobytes() for v in whole], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), packed, pa.array(cell.astype(np.int32)), pa.array(far), pa.array(norms(x))],
                names=["vec_id", "vec", "cell", "far", "norm"],
            )

    return run


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x**2).sum(axis=1))


class Groups(NamedTuple):
    """Summary of the groups of one side: distance from the pivot and norm at most, and rows."""

    radius: np.ndarray
    norm: np.ndarray
    rows: np.ndarray


def summary(placed: DataFrame, n_pivots: int) -> Groups:
    found = Groups(np.zeros(n_pivots), np.zeros(n_pivots), np.zeros(n_pivots, dtype=np.int64))
    for r in placed.groupBy("cell").agg(F.max("far").alias("r"), F.max("norm").alias("m"), F.count(F.lit(1)).alias("n")).collect():
        for values, value in zip(found, (r["r"], r["m"], r["n"])):
            values[r["cell"]] = value
    return found


def bounds(x: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest possible score of every vector with any query of every group."""
    middle = x @ pivots.T
    reach = norms(x)[:, None] * (radius + ROUNDING * (norms(pivots) + radius))
    return middle - reach, middle + reach


def group_bounds(pivots: np.ndarray, asked: Groups, held: Groups) -> np.ndarray:
    """Highest possible score of any vector of a data group (column) with any query of a group (row)."""
    size = norms(pivots)
    slack = ROUNDING * (size + asked.radius)[:, None] * (size + held.radius + held.norm)
    return pivots @ pivots.T + size[:, None] * held.radius + asked.radius[:, None] * held.norm + slack


class Route(NamedTuple):
    """Query groups solved together, the data groups they need, and into how many blocks each side is cut."""

    cells: list[int]
    need: np.ndarray
    subs: int
    chunks: int


def routes(need: np.ndarray, asked: np.ndarray, held: np.ndarray) -> list[Route]:
    """Query groups taken together while one block holds their queries and the products grow little.

    ``need`` says which data group (column) a query group (row) needs, ``asked`` and ``held`` are rows.
    """
    found: list[tuple[list[int], np.ndarray]] = []
    for c in sorted(np.flatnonzero(asked), key=lambda c: -asked[c]):
        best, most = None, 0
        for i, (cells, joint) in enumerate(found):
            queries, both = asked[cells].sum() + asked[c], joint | need[c]
            apart = asked[cells].sum() * held[joint].sum() + asked[c] * held[need[c]].sum()
            saved = held[joint & need[c]].sum()
            if queries <= PER_GROUP and queries * held[both].sum() <= MORE_WORK * apart and saved > most:
                best, most = i, saved
        if best is None:
            found.append(([int(c)], need[c].copy()))
        else:
            cells, joint = found[best]
            found[best] = (cells + [int(c)], joint | need[c])
    return [
        Route(cells, joint, int(-(-asked[cells].sum() // PER_GROUP)), max(1, int(-(-held[joint].sum() // PER_CHUNK))))
        for cells, joint in found
    ]


def _lows(pivots: np.ndarray, radius: np.ndarray, cells: list[int], k: int):
    """Per task the ``k + 1`` largest lower bounds of every query group, with the ids they are of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, mine = np.zeros((0, len(cells))), np.zeros((0, len(cells)), dtype=np.int64)
        for batch in batches:
            # One vector of an id is enough: fewer bounds only give a lower score.
            ids, first = np.unique(batch.column(0).to_numpy(), return_index=True)
            x = vectors.matrix(batch.column(1).take(pa.array(first)).to_pylist(), pivots.shape[1], np.int64).astype(np.float64)
            low = np.vstack([best, bounds(x, pivots[cells], radius[cells])[0]])
            mine = np.vstack([mine, np.broadcast_to(ids[:, None], (len(ids), len(cells)))])
            top = np.argsort(-low, axis=0)[: k + 1]
            best, mine = np.take_along_axis(low, top, axis=0), np.take_along_axis(mine, top, axis=0)
        cell = np.tile(np.array(cells, dtype=np.int32), len(best))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell), pa.array(mine.ravel()), pa.array(best.ravel())], names=["cell", "vec_id", "low"]
        )

    return run


def floors_of(data: DataFrame, pivots: np.ndarray, asked: Groups, k: int) -> np.ndarray:
    """A score that each query of a group reaches with at least ``k`` ids other than its own."""
    cells = np.flatnonzero(asked.rows).tolist()
    lows = data.select("vec_id", "vec").mapInArrow(_lows(pivots, asked.radius, cells, k), "cell int, vec_id long, low double")
    by_low = W.partitionBy("cell").orderBy(F.col("low").desc())
    once = lows.groupBy("cell", "vec_id").agg(F.max("low").alias("low"))
    last = once.withColumn("i", F.row_number().over(by_low)).where(F.col("i") <= k + 1).where(F.col("i") == k + 1)
    floors = np.full(len(pivots), -np.inf)
    for r in last.collect():
        floors[r["cell"]] = r["low"]
    return floors


def _send(pivots: np.ndarray, radius: np.ndarray, floors: np.ndarray, ways: list[Route]):
    """Every vector to every block of the queries for which it may be a result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, packed = batch.column(0), batch.column(1)
            cell, spread = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            x = vectors.matrix(packed.to_pylist(), pivots.shape[1], np.int64).astype(np.float64)
            for number, way in enumerate(ways):
                here = np.flatnonzero(way.need[cell])
                high = bounds(x[here], pivots[way.cells], radius[way.cells])[1]
                near = here[(high >= floors[way.cells]).any(axis=1)]
                rows = pa.array(near)
                for sub in range(way.subs):
                    fixed = [pa.array(np.full(len(near), v, dtype=np.int32)) for v in (number, sub)]
                    chunk, kind = spread[near] % way.chunks, np.full(len(near), vectors.DATA)
                    yield pa.RecordBatch.from_arrays(
                        [*fixed, *(pa.array(v.astype(np.int32)) for v in (chunk, kind)), ids.take(rows), packed.take(rows)],
                        names=["route", "sub", "chunk", "kind", "vec_id", "vec"],
                    )

    return run


def top_rows(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` largest whole numbers of every row, equal ones from the left."""
    n = scores.shape[1]
    place = np.arange(n - 1, -1, -1)
    if n <= k:
        return np.broadcast_to(np.arange(n), scores.shape)
    if np.abs(scores).max(initial=0) < 2**62 // n:
        return np.argpartition(scores * n + place, n - k, axis=1)[:, n - k :]
    return np.argsort(-scores, axis=1, kind="stable")[:, :k]


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products; in floating point where no sum can leave its whole numbers."""
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if largest < 2**52:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _solve(k: int, width: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        data = rows[rows["kind"] == vectors.DATA].sort_values("vec_id")
        asked = rows[rows["kind"] == vectors.QUERY]
        out = []
        if len(data) and len(asked):
            x, q = vectors.matrix(data["vec"], width, np.int64), vectors.matrix(asked["vec"], width, np.int64)
            ids, own = data["vec_id"].to_numpy(), asked["vec_id"].to_numpy()
            for at in range(0, len(q), 128):
                scores = products(q[at : at + 128], x)
                # Vectors of the query's own id come last, and then go.
                scores[own[at : at + 128, None] == ids] = scores.min() - 1
                top = top_rows(scores, k)
                flat = pd.DataFrame(
                    {
                        "query_id": np.repeat(own[at : at + 128], top.shape[1]),
                        "vec_id": ids[top].ravel(),
                        "score": np.take_along_axis(scores, top, axis=1).ravel(),
                    }
                )
                out.append(flat[flat["query_id"] != flat["vec_id"]])
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})

    return run


def top_k(
    table: DataFrame, k: int = 20, every: int = 20, scale: int = 64, vec_id: str = "vec_id", vector: str = "embedding",
    label: str = "voronoi",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every``, the ``k`` other
    rows of largest integer product, components being ``floor(scale * x)``."""
    spark = table.sparkSession
    rows = vectors.clean(table, vec_id, vector, T.LongType(), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")), label)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = vectors.width_of(rows)
    if width is None:
        return empty
    data = vectors.candidates(rows, k).withColumn("spread", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)))
    data = staged(data, f"{label}-data")
    asked = vectors.asked(rows, every)
    if asked.isEmpty():
        return empty
    blocks = blocks_of(data, asked, width, k, label)
    found = blocks.groupBy("route", "sub", "chunk").applyInPandas(_solve(k, width), "query_id long, vec_id long, score long")
    return vectors.best_of(found, k)


def blocks_of(data: DataFrame, asked: DataFrame, width: int, k: int, label: str) -> DataFrame:
    """Queries and the vectors sent to them, by block (``route, sub, chunk``)."""
    wanted = max(1, min(MOST_PIVOTS, round(math.sqrt(data.count()) / 2)))
    picked = data.orderBy("spread", "vec_id").limit(wanted).select("vec").toArrow()
    pivots = unpack(picked["vec"].to_pylist(), width)
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))
    data = staged(data.select("vec_id", "vec").mapInArrow(_place(pivots), PLACED).withColumn("spread", spread), f"{label}-placed")
    asked = staged(asked.mapInArrow(_place(pivots), PLACED), f"{label}-asked")
    on_asked, on_data = summary(asked, len(pivots)), summary(data, len(pivots))
    floors = floors_of(data, pivots, on_asked, k)
    need = (group_bounds(pivots, on_asked, on_data) >= floors[:, None]) & (on_data.rows > 0)
    ways = routes(need, on_asked.rows, on_data.rows)

    sent = data.select("vec_id", "vec", "cell", "spread").mapInArrow(_send(pivots, on_asked.radius, floors, ways), SCHEMA)
    route, subs, chunks = (
        F.create_map(*[F.lit(x) for i, w in enumerate(ways) for c in w.cells for x in (c, (i, w.subs, w.chunks)[part])])[F.col("cell")]
        for part in range(3)
    )
    asking = asked.select(
        route.alias("route"),
        F.pmod(F.xxhash64("vec_id"), subs).cast("int").alias("sub"),
        F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"),
        F.lit(vectors.QUERY).alias("kind"),
        "vec_id",
        "vec",
    )
    return sent.unionByName(asking)
