"""Near-duplicate vectors by int8 tile products with proven error bounds.

Only vectors of one label are compared. Rows of equal label and vector are one class; what follows
works on classes. A vector ``x`` of length 1 is held as ``s * c``: ``c`` whole numbers of 8 bits, ``s`` its
largest component over 127. With ``e`` the length of ``x - s * c``, the cosine of two vectors differs from
``s * s' * (c . c')`` by at most ``e * |s' * c'| + e'``, whatever the vectors are. Products of whole tiles of
``c`` are exact (as floats, as long as no sum can leave their whole numbers). A pair whose upper bound is
below the threshold is no link, one whose lower bound reaches it is one, and only the pairs between are
computed in full precision from the vectors themselves.

A label's classes are dealt by hash into tiles of about ``TILE``; each pair of tiles is one task, which
holds the two tiles and a strip of products. A label with a third of the rows is many such tasks. A task
returns no pairs: for each class the links it found (copies counted) and the smallest class it is joined
to by links of this task. These are summed and joined into components. The products are as many as there
are pairs of a label's classes, which the comparison of all rows asks for.

Defined results: a vector that is null, empty, zero or holds null or non-finite components, and one of a
null label, has no links and is its own component; a null id is never part of a component, is linked with
nothing and kept; vectors of other lengths count as filled with zeros; rows that repeat an id are vectors
of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import finite_vector, unpack
from feedloom.llm.graphs import components
from feedloom.session import staged

TILE = 16_384  # classes of a tile, about
STRIP = 512  # rows of a tile whose products are held at a time
PAIRS = 1 << 16  # pairs computed in full precision at a time
EXACT_FLOAT = 2**24 // 127**2  # components up to which a sum of products is exact in 32 bits
#: Far above what rounding in double precision can add to a bound.
SLACK = 1e-9


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales and lengths of the errors of vectors of length 1."""
    scale = np.abs(x).max(axis=1) / 127
    code = np.rint(x / scale[:, None]).astype(np.int8)
    error = np.sqrt(((x - scale[:, None] * code) ** 2).sum(axis=1)) + SLACK
    return code, scale, error


class Tile:
    def __init__(self, rows: pd.DataFrame, width: int):
        self.id, self.size = rows["id"].to_numpy(), rows["size"].to_numpy()
        self.vec = unpack(rows["vec"], width)
        # Scaled first, so that no square leaves the range of numbers.
        self.vec /= np.abs(self.vec).max(axis=1, initial=0)[:, None]
        self.norm = np.sqrt((self.vec**2).sum(axis=1))
        self.code, self.scale, self.error = quantised(self.vec / self.norm[:, None])
        self.held = self.scale * np.sqrt((self.code.astype(np.float64) ** 2).sum(axis=1))


def cosines(one: Tile, two: Tile, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of pairs in full precision."""
    parts = [
        np.einsum("ij,ij->i", one.vec[i[a : a + PAIRS]], two.vec[j[a : a + PAIRS]]) / (one.norm[i[a : a + PAIRS]] * two.norm[j[a : a + PAIRS]])
        for a in range(0, len(i), PAIRS)
    ]
    return np.concatenate([np.zeros(0), *parts])


def strip_links(one: Tile, two: Tile, low: int, high: int, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Linked pairs of the rows from ``low`` to ``high`` with all of ``two``, and how many were computed again."""
    kind = np.float32 if one.code.shape[1] <= EXACT_FLOAT else np.float64
    product = one.code[low:high].astype(kind) @ two.code.astype(kind).T
    near = one.scale[low:high, None] * two.scale * product
    reach = one.error[low:high, None] * two.held + two.error
    sure = near - reach >= threshold + SLACK
    i, j = np.nonzero((near + reach >= threshold - SLACK) & ~sure)
    good = cosines(one, two, low + i, j) >= threshold
    a, b = np.nonzero(sure)
    return low + np.concatenate([a, i[good]]), np.concatenate([b, j[good]]), len(i)


class Union:
    """Smallest reachable place for every place, as links come in."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def _compare(threshold: float, width: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # Sorted, so that the smallest place is the smallest class.
        rows = rows.sort_values("id")
        tiles = [Tile(rows[rows["tile"] == t], width) for t in dict.fromkeys(key[1:])]
        one, two = tiles[0], tiles[-1]
        same = one is two
        ids = np.concatenate([t.id for t in tiles])
        order = np.argsort(ids)
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        here, there = place[: len(one.id)], place[-len(two.id) :]
        links, union = np.zeros(len(ids), dtype=np.int64), Union(len(ids))
        for low in range(0, len(one.id), STRIP):
            i, j, _ = strip_links(one, two, low, min(low + STRIP, len(one.id)), threshold)
            if same:
                i, j = i[i != j], j[i != j]
            np.add.at(links, here[i], two.size[j])
            if not same:
                np.add.at(links, there[j], one.size[i])
            union.join(here[i], there[j])
        met = np.flatnonzero(links)
        names = ids[order]
        return pd.DataFrame({"id": names[met], "links": links[met], "root": names[union.root[met]]})

    return run


def near_duplicates(
    table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    threshold: float = 0.93, name: str = "tiles",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row; a component is named by its smallest id, and that
    vector is kept. ``threshold`` is above 0."""
    rows = table.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
        F.transform(F.col(vector), lambda x: x.cast("double")).alias("vec"), finite_vector(vector).alias("fine"),
    )
    rows = rows.withColumn(
        "fine", F.col("fine") & F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.exists("vec", lambda x: x != 0)
    )
    known = staged(rows.withColumn("hash", F.xxhash64("vec")), f"{name}-rows")
    same = ["label", "hash", "vec"]
    grouped = known.where("fine").groupBy(*same).agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("size"))
    classes = staged(grouped.withColumn("id", F.monotonically_increasing_id()), f"{name}-classes")
    width = classes.agg(F.max(F.size("vec"))).first()[0] or 0
    tiles = classes.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    dealt = classes.join(tiles, "label").withColumn("tile", F.pmod("hash", "tiles").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    sent = dealt.select("label", "id", "size", "vec", "tile", other)
    pairs = sent.groupBy("label", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"))
    found = staged(pairs.applyInPandas(_compare(threshold, width), "id long, links long, root long"), f"{name}-found")

    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), name)
    named = classes.select("id", "first", "size", *same).join(counts, "id", "left")
    named = named.join(joined.withColumnRenamed("node", "id"), "id", "left")
    named = staged(named.withColumn("component", F.coalesce("component", "id")), f"{name}-named")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    facts = named.join(least, "component").select(
        *same, (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id"
    )
    # Equal vectors of equal label; rows that take no part meet no class.
    fine = known.where("fine").join(facts, same)
    rest = known.where(~F.col("fine")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    all_ = fine.select("vec_id", "n_links", "component_id").unionByName(rest)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return all_.withColumn("kept", kept)
