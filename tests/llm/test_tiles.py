import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import tiles

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    """Every pair, in double precision."""
    fine = [
        i is not None and lab is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        for i, v, lab in rows
    ]
    n = len(rows)
    width = max([len(v) for (_, v, _), f in zip(rows, fine, strict=True) if f], default=0)
    vec = [np.array([*map(np.float32, v), *[0] * (width - len(v))], dtype=float) if f else None for (_, v, _), f in zip(rows, fine, strict=True)]
    near = np.zeros((n, n), dtype=bool)
    for a in range(n):
        for b in range(n):
            if a != b and fine[a] and fine[b] and rows[a][2] == rows[b][2]:
                near[a, b] = vec[a] @ vec[b] / (np.linalg.norm(vec[a]) * np.linalg.norm(vec[b])) >= threshold
    part = list(range(n))
    for a in range(n):
        for b in np.flatnonzero(near[a]):
            old, new = part[b], part[a]
            part = [new if p == old else p for p in part]
    out = []
    for a, (i, _, _) in enumerate(rows):
        least = min((rows[b][0] for b in range(n) if part[b] == part[a] and rows[b][0] is not None), default=None)
        out.append((i, int(near[a].sum()), least if i is not None else None, i is None or i == least))
    return sorted(out, key=repr)


def found(spark, rows, schema=SCHEMA):
    table = spark.createDataFrame(rows, schema).withColumns({c: F.lit(1) for c in ("id", "size", "tile", "vec", "hash", "first")})
    return sorted((tuple(r) for r in tiles.near_duplicates(table).collect()), key=repr)


def clustered(n, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.standard_normal(24) if i % 3 or i < 9 else np.array(rows[rng.integers(0, i)][1]) + rng.standard_normal(24) * rng.uniform(0, 0.5)
        rows.append((1000 - i, [float(np.float32(x)) for x in v], [None, 1, 1, 1, 2][i % 5]))
    # A group of copies under one label, and the same vector under others.
    rows += [(2000 + i, rows[3][1], 1) for i in range(n // 3)] + [(5000, rows[3][1], 2), (5001, [2 * x for x in rows[3][1]], 1)]
    return rows


@pytest.mark.parametrize("size", [16_384, 17])
def test_links_and_components_are_those_of_all_pairs(spark, monkeypatch, size):
    monkeypatch.setattr(tiles, "TILE", size)
    monkeypatch.setattr(tiles, "STRIP", 5)
    rows = clustered(120)
    got = found(spark, rows)
    assert got == brute(rows) and sum(r[1] > 0 for r in got) > 60


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, nan], 1), (6, [inf, 1.0], 1),
        (7, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (8, [1.0, 0.0], 1), (8, [1.0, 0.0], 1), (8, [0.0, 1.0], 1),
        (9, [3.0, 0.1], 1), (10, [5.0], 1), (11, [1e-30, 0.0], 1), (12, [3e38, 0.0], 1),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_a_chain_is_one_component_and_only_doubtful_pairs_are_computed(spark, monkeypatch):
    # Each vector is linked with its neighbours alone.
    angle = np.arccos(0.95)
    rows = [(i, [float(np.cos(i * angle)), float(np.sin(i * angle))], 1) for i in range(12)]
    monkeypatch.setattr(tiles, "TILE", 3)
    assert found(spark, rows) == brute(rows)


def test_bounds_hold_and_spare_most_pairs():
    import pandas as pd

    rng = np.random.default_rng(5)
    x = rng.standard_normal((600, 64))
    x[300:] = x[:300] + rng.standard_normal((300, 64)) * rng.uniform(0, 0.8, (300, 1))
    tile = tiles.Tile(pd.DataFrame({"id": range(600), "size": 1, "vec": list(x)}), 64)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    exact = unit @ unit.T
    code = tile.code.astype(float)
    near = tile.scale[:, None] * tile.scale * (code @ code.T)
    assert (np.abs(near - exact) <= tile.error[:, None] * tile.held + tile.error).all()
    i, j, again = tiles.strip_links(tile, tile, 0, 600, 0.93)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(c.tolist() for c in np.nonzero(exact >= 0.93)), strict=True))
    assert again < 600


def test_longer_vectors_than_floats_can_add_exactly():
    import pandas as pd

    rng = np.random.default_rng(6)
    x = np.concatenate([np.ones((4, 3000)), rng.standard_normal((4, 3000))])
    x[1] += rng.standard_normal(3000) * 0.1
    tile = tiles.Tile(pd.DataFrame({"id": range(8), "size": 1, "vec": list(x)}), 3000)
    assert len(tiles.strip_links(tile, tile, 0, 8, 0.93)[0]) == 4 * 4 + 4
