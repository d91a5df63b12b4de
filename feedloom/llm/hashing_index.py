"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes.

A rotation is learned on a bounded sample of unit vectors (iterative quantization: signs and rotation
are fitted to each other in turn); the signs of a rotated vector are its code, up to 64 bits. Codes are
cut into substrings of 16 bits and each block of data indexes every substring. For a radius ``r`` over
``m`` substrings, any code within ``r`` differs from the query's by at most ``r // m`` bits in one of the
first ``r % m + 1`` substrings, or by ``r // m - 1`` in one of the others, so probing those buckets
retrieves every code within ``r``. Retrieved vectors are ranked by their exact cosine.

The radius is the distance within which the sample holds ``coverage`` of its own true neighbours. As
neighbours in the whole table are nearer than in the sample, it errs to the safe side. Where a block
holds fewer than ``k`` codes within the radius it is widened, so ``k`` results are found if they exist.

Defined results: rows with a null id, or a vector that is null, zero, or holds null or non-finite
components, take no part; shorter vectors count as filled with zeros; rows that repeat id and vector
count once; candidates with the query's own id are left out; equal scores go to the smaller id; fewer
candidates than ``k`` are all returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm import vectors
from feedloom.llm.common import unpack
from feedloom.session import staged

SAMPLE = 8192  # most vectors the rotation and radius are learned from
PER_BLOCK = 16_384  # vectors of a block
PER_GROUP = 4096  # queries of a block
PART = 16  # bits of a substring


@dataclass
class Codes:
    """A learned rotation, the number of bits, and the radius to search."""

    rotation: np.ndarray
    radius: int

    @property
    def bits(self) -> int:
        return self.rotation.shape[1]

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes of vectors as 64-bit numbers."""
        signs = (x @ self.rotation > 0).astype(np.uint64)
        return (signs << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def learn(sample: np.ndarray, k: int, coverage: float, turns: int = 30) -> Codes:
    x = unit(sample)
    bits = min(64, x.shape[1])
    # The directions of largest spread, rotated so that signs lose as little as possible.
    _, vectors_ = np.linalg.eigh(x.T @ x)
    lead = vectors_[:, ::-1][:, :bits]
    rotation = np.linalg.qr(np.random.default_rng(11).standard_normal((bits, bits)))[0]
    flat = x @ lead
    for _ in range(turns):
        left, _, right = np.linalg.svd(flat.T @ np.where(flat @ rotation > 0, 1.0, -1.0))
        rotation = left @ right
    codes = Codes(lead @ rotation, bits)
    asked = min(256, len(x))
    near = x[:asked] @ x.T
    near[np.arange(asked), np.arange(asked)] = -np.inf
    top = np.argsort(-near, axis=1)[:, : min(k, max(1, len(x) - 1))]
    code = codes.encode(x)
    apart = np.bitwise_count(code[:asked, None] ^ code[top])
    codes.radius = int(np.quantile(apart, coverage, method="higher"))
    return codes


@lru_cache(maxsize=64)
def flips(bits: int, most: int) -> np.ndarray:
    """All substrings of ``bits`` bits with at most ``most`` set: what a probe differs by."""
    every = np.arange(1 << bits, dtype=np.uint32)
    return every[np.bitwise_count(every) <= most]


class Index:
    """Every substring of a block's codes: rows sorted by it, and where each value starts."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.codes, self.bits = codes, bits
        self.parts = [(at, min(PART, bits - at)) for at in range(0, bits, PART)]
        self.order, self.start, self.held = [], [], []
        for at, size in self.parts:
            value = self._part(codes, at, size)
            order = np.argsort(value, kind="stable")
            self.order.append(order)
            self.start.append(np.searchsorted(value[order], np.arange((1 << size) + 1)))
            self.held.append(np.unique(value))

    @staticmethod
    def _part(codes, at: int, size: int):
        return ((codes >> np.uint64(at)) & np.uint64((1 << size) - 1)).astype(np.uint32)

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Rows whose code differs from ``code`` in at most ``radius`` bits, in order."""
        share, extra = divmod(radius, len(self.parts))
        seen = np.zeros(len(self.codes), dtype=bool)
        for i, (at, size) in enumerate(self.parts):
            most = min(size, share if i <= extra else share - 1)
            if most < 0:
                continue
            own = self._part(code, at, size)
            held = self.held[i]
            probes = flips(size, most) ^ own if len(flips(size, most)) < len(held) else held[np.bitwise_count(held ^ own) <= most]
            begin, end = self.start[i][probes], self.start[i][probes + 1]
            n = end - begin
            ends = np.cumsum(n)
            if len(ends) and ends[-1]:
                rows = np.arange(ends[-1]) + np.repeat(begin - (ends - n), n)
                seen[self.order[i][rows]] = True
        found = np.flatnonzero(seen)
        return found[np.bitwise_count(self.codes[found] ^ code) <= radius]


def _packed(codes: Codes, width: int, kind: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpack(batch.column(1).to_pylist(), width)
            code = codes.encode(unit(x)).view(np.int64) if len(x) else np.zeros(0, dtype=np.int64)
            rows = pa.array([v.tobytes() for v in x], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(code), rows, pa.array(np.full(len(x), kind, dtype=np.int32))],
                names=["vec_id", "code", "vec", "kind"],
            )

    return run


def _search(k: int, width: int, bits: int, radius: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        data = rows[rows["kind"] == vectors.DATA].sort_values("vec_id")
        asked = rows[rows["kind"] == vectors.QUERY]
        out = []
        if len(data) and len(asked):
            x, q = vectors.matrix(data["vec"], width, np.float64), vectors.matrix(asked["vec"], width, np.float64)
            ids, own = data["vec_id"].to_numpy(), asked["vec_id"].to_numpy()
            index = Index(data["code"].to_numpy().view(np.uint64), bits)
            size, code = np.sqrt((x * x).sum(axis=1)), asked["code"].to_numpy().view(np.uint64)
            for i in range(len(q)):
                reach = radius
                near = index.within(code[i], reach)
                near = near[ids[near] != own[i]]
                while len(near) < k and reach < bits:
                    reach = min(bits, reach + 4)
                    near = index.within(code[i], reach)
                    near = near[ids[near] != own[i]]
                # Summed row by row, so that equal vectors have equal scores wherever they stand.
                score = (x[near] * q[i]).sum(axis=1) / (size[near] * np.sqrt((q[i] * q[i]).sum()))
                first = np.lexsort((ids[near], -score))[:k]
                out.append((np.full(len(first), own[i]), ids[near][first], score[first]))
        if not out:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return pd.DataFrame({c: np.concatenate(v) for c, v in zip(("query_id", "vec_id", "score"), zip(*out, strict=True), strict=True)})

    return run


def nearest(
    table: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", vector: str = "embedding",
    coverage: float = 0.98, label: str = "hashing",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every``, the ``k`` other
    rows of largest cosine among those whose code is within the learned radius."""
    empty = table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = vectors.clean(table, vec_id, vector, T.DoubleType(), lambda x: x.cast("double"), label).where(
        F.exists("vec", lambda x: x != 0)
    )
    width = vectors.width_of(rows)
    if width is None:
        return empty
    data = staged(vectors.candidates(rows, k), f"{label}-data")
    asked = vectors.asked(rows, every)
    n_data, n_asked = data.count(), asked.count()
    if n_asked == 0:
        return empty
    drawn = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec").toArrow()
    codes = learn(unpack(drawn["vec"].to_pylist(), width), k, coverage)

    blocks, groups = -(-n_data // PER_BLOCK), -(-n_asked // PER_GROUP)
    schema = "vec_id long, code long, vec binary, kind int"
    spread = F.xxhash64("vec_id")
    of_all = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = data.mapInArrow(_packed(codes, width, vectors.DATA), schema).select(
        "*", F.pmod(spread, F.lit(blocks)).cast("int").alias("block"), of_all(groups).alias("asking")
    )
    asking = asked.mapInArrow(_packed(codes, width, vectors.QUERY), schema).select(
        "*", of_all(blocks).alias("block"), F.pmod(spread, F.lit(groups)).cast("int").alias("asking")
    )
    found = held.unionByName(asking).groupBy("block", "asking").applyInPandas(
        _search(k, width, codes.bits, codes.radius), "query_id long, vec_id long, score double"
    )
    return vectors.best_of(found, k)
