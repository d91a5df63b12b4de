import random

import numpy as np
import pytest

from feedloom.llm import graphs, minhash


def test_posterior_limits_never_drop_a_likely_pair():
    for n, fewest in minhash.least_agreements(0.8, 1e-6):
        # At similarity 0.8 the chance of fewer agreements is about the miss probability.
        mean, deviation = 0.8 * n, (0.16 * n) ** 0.5
        assert fewest < mean - 4 * deviation + 1
        assert fewest > 0.3 * n


def test_shingles():
    assert len(minhash.shingles(None)) == len(minhash.shingles(b" \n")) == 0
    assert len(minhash.shingles(b"one")) == 1 and len(minhash.shingles(b"A b A B a b")) == 2
    assert not np.intersect1d(minhash.shingles(b"a b", 5), minhash.shingles(b"a b c", 5)).size


def corpus(n_groups=12, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(n_groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((3, 12, 60, 200)))]
        for _ in range(rng.choice((1, 4, 30, 60))):
            text = base[:]
            for _ in range(int(len(text) * rng.choice((0, 0.01, 0.03, 0.06, 0.1)))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text).title() if rng.random() < 0.3 else "\t".join(text)))
    return rows


def brute(rows, size):
    sets, parent = {}, {}
    for i, t in rows:
        w = [x.lower() for x in (t or "").split()]
        grams = [tuple(w[k : k + size]) for k in range(len(w) - size + 1)] or ([tuple(w)] if w else [])
        sets.setdefault(i, set()).update(grams)
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in sets if i is not None and sets[i]]
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i) if i is not None else None) for i in sets}


EDGES = [(9001, None), (9002, ""), (9003, " \n"), (9004, "one"), (9005, "ONE"), (9006, "two words"), (None, "one"), (9004, "one"), (None, None)]


@pytest.mark.parametrize("size,rounds", [(2, 3), (5, 3), (2, 0)])
def test_components_are_those_of_all_pairs(documents, monkeypatch, size, rounds):
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    monkeypatch.setattr(minhash, "ASKING", 700)
    monkeypatch.setattr(minhash, "ASKED", 1500)
    rows = corpus() + EDGES
    want = brute([r for r in rows if r[0] is not None], size)
    got = minhash.near_duplicates(documents(rows), shingle=size).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            n, component = want[r["doc_id"]]
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (n, component, component == r["doc_id"])


def brute_rows(rows, size):
    """Components where every row is a node of its own and rows of one id are linked."""
    by_row = brute([(k, t) for k, (_, t) in enumerate(rows)], size)
    parent = {k: c for k, (_, c) in by_row.items()}
    ids = {}
    for k, (i, _) in enumerate(rows):
        if by_row[k][0]:
            ids.setdefault(i, []).append(k)
    changed = True
    while changed:
        changed = False
        for same in ids.values():
            least = min(parent[k] for k in same)
            for gone in {parent[k] for k in same} - {least}:
                parent, changed = {k: least if c == gone else c for k, c in parent.items()}, True
    smallest = {}
    for k, (i, _) in enumerate(rows):
        smallest[parent[k]] = min(smallest.get(parent[k], i), i)
    return sorted((i, by_row[k][0], smallest[parent[k]] if by_row[k][0] else i) for k, (i, _) in enumerate(rows))


def test_an_id_with_different_texts_links_them(documents):
    one, two = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(5, one), (5, two), (1, one + " x"), (2, "y " + one), (7, two + " x"), (8, "y " + two), (3, "alone"), (3, None), (4, "")]
    rows += [(9, "p q r s t u"), (9, "v w x y z"), (9, "p q r s t u")]  # no text of this id has a near copy
    got = minhash.near_duplicates(documents(rows), shingle=2).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_rows(rows, 2)
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2, 5, 7, 8)} == {1}
    assert {r["doc_id"] for r in got if r["kept"]} == {1, 3, 4, 9}


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_ids_against_all_pairs(documents, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(120) if rng.random() < 0.3 else 1000 - i, t) for i, t in corpus(8, seed)]
    rows += [(77, t) for _, t in corpus(4, seed + 10)[:40]]  # one id for many texts
    got = minhash.near_duplicates(documents(rows), shingle=2).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_rows(rows, 2)


def test_stage_keeps_one_of_each_group(documents):
    df = documents(corpus(6) + EDGES)
    out = minhash.deduplicated(df)
    assert out.columns == df.columns
    want = {i for i, (_, c) in brute([r for r in corpus(6) + EDGES if r[0] is not None], 5).items() if i == c}
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 2


def test_empty_table(documents):
    assert minhash.near_duplicates(documents([])).count() == 0
    assert minhash.deduplicated(documents([])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (203, 201), (7, 7)]
    got = dict(map(tuple, graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(41)} == {0} and {got[100 + i] for i in range(50)} == {100}
    assert {got[i] for i in (200, 201, 203)} == {200}


def test_few_rows_are_in_doubt_beside_a_filter_of_keys(spark, documents):
    from feedloom.llm.common import split_by

    docs = documents([(i, f"text {i}") for i in range(5000)] + [(None, "none"), (7, "again"), (-3, None)])
    keys = spark.createDataFrame([(i,) for i in (7, 7, -3, 0, 4999, 10**12)], "doc_id long")
    doubtful, sure = split_by(docs.withColumn("doc_id", docs["doc_id"].cast("decimal(20,0)")), keys, ["doc_id"])
    assert doubtful.columns == sure.columns == docs.columns
    near, far = ([r["doc_id"] for r in part.collect()] for part in (doubtful, sure))
    assert len(near) + len(far) == 5003 and not set(far) & {7, -3, 0, 4999}
    assert near.count(7) == 2 and len(near) < 20
    two = spark.createDataFrame([(7, "again"), (8, None)], "doc_id long, text string")
    assert [tuple(r) for r in split_by(docs, two, ["doc_id", "text"])[0].select("doc_id", "text").collect()] == [(7, "again")]
    assert split_by(docs, keys.limit(0), ["doc_id"])[0].isEmpty()


def test_deduplication_shuffles_no_rows_that_surely_stay_and_leaves_no_tables_of_pairs(spark, documents, tmp_path):
    from pathlib import Path

    from feedloom.session import shared_dir

    docs = documents([(i, f"only {i} " * 40) for i in range(200)] + [(500 + i, "the same text " * 30) for i in range(5)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = minhash.deduplicated(docs, label="tidy")
        out.write.parquet(f"{tmp_path}/out")
        plan = out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 201
    stays = plan[plan.index("Union") :].split("LeftAnti")[0]
    assert "LeftOuter" in stays
    assert not [p for p in Path(shared_dir(spark).removeprefix("file:")).rglob("tidy-*") if p.is_dir() and ("sets" in p.name or "sketches" in p.name)]
