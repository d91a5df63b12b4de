import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import hashing_index, voronoi

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture
def table(spark):
    def of(rows):
        df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
        return df.withColumns({c: F.lit(-1) for c in ("vec", "h", "g", "d", "score", "rank", "cell", "query_id")})

    return of


def vectors(n=240, width=12, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    return [(i, [float(x) for x in np.float32(centres[i % 6] + rng.normal(scale=0.4, size=width))]) for i in range(n)]


def awkward():
    rows = vectors()
    same = rows[7][1]
    rows += [(1000 + i, same) for i in range(60)]  # one vector many times
    rows += [(2000, None), (2001, [1.0, None, 0.0]), (2002, [float("nan")] * 12), (2003, [float("inf")] * 12), (None, same)]
    rows += [(3000, [0.0] * 12), (3001, [0.5, 0.25]), (3002, []), (40, rows[40][1])]
    return rows


def usable(rows, zero):
    seen = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        x = np.zeros(12)
        x[: len(v)] = np.float32(v)
        if zero or x.any():
            seen[i] = x
    return seen


def brute_products(rows, k, every, scale=64):
    held = {i: np.floor(scale * x).astype(np.int64) for i, x in usable(rows, True).items()}
    out = []
    for q in held:
        if q % every == 0:
            found = sorted((-int(held[q] @ x), i) for i, x in held.items() if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("per_group,per_chunk", [(1024, 16_384), (7, 50)])
def test_products_are_exact(table, monkeypatch, per_group, per_chunk):
    monkeypatch.setattr(voronoi, "PER_GROUP", per_group)
    monkeypatch.setattr(voronoi, "PER_CHUNK", per_chunk)
    got = sorted(map(tuple, voronoi.top_k(table(awkward()), k=9, every=4).collect()))
    assert got == brute_products(awkward(), 9, 4)


def clustered(groups=20, each=100, width=12):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(groups, width)) * 10
    return [(i, [float(x) for x in np.float32(centres[i % groups] + rng.normal(scale=0.05, size=width))]) for i in range(groups * each)]


def test_far_groups_are_not_sent(table, monkeypatch):
    seen = []
    blocks_of = voronoi.blocks_of
    monkeypatch.setattr(voronoi, "blocks_of", lambda *a: seen.append(blocks_of(*a)) or seen[-1])
    rows = clustered()
    got = sorted(map(tuple, voronoi.top_k(table(rows), k=9, every=4).collect()))
    assert got == brute_products(rows, 9, 4)
    kinds = {r["kind"]: r["n"] for r in seen[0].groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_routes = seen[0].select("route").distinct().count()
    assert n_routes >= 4
    # All pairs of groups would send every vector to every route.
    assert kinds[0] < 0.3 * n_routes * len(rows)


def test_bounds_of_groups_hold():
    rng = np.random.default_rng(2)
    pivots = rng.normal(size=(5, 6)) * 30
    x, q = rng.normal(size=(300, 6)) * 30, rng.normal(size=(100, 6)) * 30

    def side(v):
        d = voronoi.distances(v, pivots)
        cell = d.argmin(axis=1)
        size = voronoi.norms(v)
        mine = [cell == c for c in range(5)]
        far = d[np.arange(len(v)), cell]
        return cell, voronoi.Groups(*(np.array([f[m].max(initial=0) for m in mine]) for f in (far, size)), np.array([m.sum() for m in mine]))

    (cx, held), (cq, asked) = side(x), side(q)
    high = voronoi.group_bounds(pivots, asked, held)
    assert (q @ x.T <= high[cq][:, cx]).all()
    low, top = voronoi.bounds(x, pivots, asked.radius)
    assert (low.T[cq] <= q @ x.T).all() and (q @ x.T <= top.T[cq]).all()


def test_query_groups_of_like_needs_go_together():
    all_needed = voronoi.routes(np.ones((4, 4), bool), np.array([5, 5, 0, 5]), np.full(4, 100))
    assert [sorted(w.cells) for w in all_needed] == [[0, 1, 3]]
    apart = voronoi.routes(np.eye(4, dtype=bool), np.array([5, 5, 0, 5]), np.full(4, 100))
    assert sorted(w.cells[0] for w in apart) == [0, 1, 3] and all(len(w.cells) == 1 for w in apart)


def test_different_vectors_of_one_id(table):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [5.0, 5.0]), (1, [2.0, 0.0]), (1, [0.0, 3.0]), (3, [0.5, 0.5])]
    got = [tuple(r) for r in voronoi.top_k(table(rows), k=3, every=2).orderBy("rank").collect()]
    # Scores of the six pairs of vectors with ids 1 and 3, three vectors of the query each.
    assert got == [(0, 1, 1, 320 * 192), (0, 2, 1, 320 * 128), (0, 3, 3, 2 * 320 * 32)]


def test_ties_and_large_numbers():
    scores = np.array([[5, 9, 9, 1, 9]])
    assert sorted(voronoi.top_rows(scores, 2)[0].tolist()) == [1, 2]
    assert sorted(voronoi.top_rows(scores * 2**59, 2)[0].tolist()) == [1, 2]
    a = np.array([[2**30, 1]])
    assert voronoi.products(a, a)[0, 0] == 2**60 + 1


def test_fewer_candidates_than_asked_for(table):
    assert sorted(map(tuple, voronoi.top_k(table([(0, [1.0]), (3, [2.0])]), k=5, every=2).collect())) == [(0, 1, 3, 64 * 128)]
    assert voronoi.top_k(table([(0, [1.0])])).count() == 0
    assert voronoi.top_k(table([(1, [1.0]), (2, [1.0])])).count() == 0


def test_empty_tables(table):
    assert voronoi.top_k(table([])).count() == 0
    assert hashing_index.nearest(table([])).count() == 0
    assert hashing_index.nearest(table([(50, [0.0, 0.0]), (51, None)])).count() == 0


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(1)
    for bits in (12, 24, 64):
        codes = rng.integers(0, 2**bits, 3000, dtype=np.uint64)
        codes[:1500] = codes[0] ^ (np.uint64(1) << rng.integers(0, bits, 1500, dtype=np.uint64))
        index = hashing_index.Index(codes, bits)
        for radius in (0, 1, 3, bits // 3, bits):
            want = np.flatnonzero(np.bitwise_count(codes ^ codes[5]) <= radius)
            assert (index.within(codes[5], radius) == want).all()


@pytest.mark.parametrize("per_group,per_block", [(4096, 16_384), (5, 60)])
def test_neighbours(table, monkeypatch, per_group, per_block):
    monkeypatch.setattr(hashing_index, "PER_GROUP", per_group)
    monkeypatch.setattr(hashing_index, "PER_BLOCK", per_block)
    held = usable(awkward(), False)
    got = hashing_index.nearest(table(awkward()), k=5, every=10).collect()
    queries = {q for q in held if q % 10 == 0}
    assert {r["query_id"] for r in got} == queries
    hit = 0
    for q in queries:
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        cosine = {i: float(x @ held[q] / np.sqrt((x @ x) * (held[q] @ held[q]))) for i, x in held.items() if i != q}
        for r in mine:
            assert abs(cosine[r["vec_id"]] - r["score"]) < 1e-12
        assert all((-a["score"], a["vec_id"]) < (-b["score"], b["vec_id"]) for a, b in zip(mine, mine[1:]))
        best = sorted(cosine, key=lambda i: (-round(cosine[i], 12), i))[:5]
        hit += len(set(best) & {r["vec_id"] for r in mine})
    assert hit >= 0.9 * 5 * len(queries)


def test_recall_on_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = {}
    for r in hashing_index.nearest(df).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    rows = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in df.collect()}
    hit = 0
    for q in got:
        c = {i: x @ rows[q] / np.sqrt((x @ x) * (rows[q] @ rows[q])) for i, x in rows.items() if i != q}
        hit += len(got[q] & set(sorted(c, key=lambda i: (-c[i], i))[:5]))
    assert hit >= 0.9 * 5 * len(got)


def test_few_rows(table):
    got = hashing_index.nearest(table([(0, [1.0, 2.0]), (3, [2.0, 1.0]), (4, [-1.0, 0.0])]), k=5, every=50).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 3), (0, 2, 4)]
