import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import fp_tree

TERM = re.compile(fp_tree.TERM)
ITEMS = "item_id long, text string"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute(docs, items, k=10):
    rows = [(i, Counter(words(t))) for i, t in docs]
    rows = [(i, c, sum(c.values())) for i, c in rows if c]
    n, length = len(rows), sum(r[2] for r in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, c, size in rows:
            m = 10 + (90 * size * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms if c[t]
            )
            if doc is not None and score > 0:
                scored.append((-score, doc))
        out += [(item, r + 1, doc, -s) for r, (s, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(spark, documents, docs, items, **options):
    table = spark.createDataFrame(items, ITEMS).withColumns({c: F.lit("x") for c in ("terms", "size", "chunk", "doc_id")})
    got = fp_tree.search(documents(docs), table, **options).collect()
    return sorted(tuple(r) for r in got)


def corpus(n, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "naïve", "ÀB", "x1", "Zed"]
    pick = lambda k: " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=k))
    docs = [(i, pick(rng.randint(0, 40))) for i in range(n)]
    # A third of all rows are copies, ids in no order.
    docs += [(10_000 - i, docs[5][1]) for i in range(n // 2)]
    return docs, [(i, pick(rng.randint(1, 12))) for i in range(15)]


def test_results_are_those_of_all_scores(spark, documents, monkeypatch):
    docs, items = corpus(400)
    want = brute(docs, items)
    assert found(spark, documents, docs, items) == want
    # Many blocks, small nodes and several chunks of items give the same.
    monkeypatch.setattr(fp_tree, "ENTRIES", 20)
    assert found(spark, documents, docs, items) == want


def test_blocks_and_leaves_of_any_size_agree(monkeypatch):
    docs, items = corpus(300, 2)
    vocabulary = {t.encode(): i for i, t in enumerate(sorted({t for _, x in items for t in words(x)}))}
    rows = sorted(
        (sorted((vocabulary[t.encode()], n) for t, n in Counter(words(x)).items() if t.encode() in vocabulary), i)
        for i, x in docs
    )
    rows = [r for r in rows if r[0]]
    ends = np.cumsum([0, *[len(r[0]) for r in rows]])
    flat = np.array([x for r, _ in rows for x in r], dtype=np.int64)
    ids = np.array([i for _, i in rows])
    m = 10 + ids % 7
    table = fp_tree.Rows(ends, flat[:, 0], flat[:, 1], m)
    none = np.zeros(0, dtype=np.int64)
    for leaf in (1, 4, 1000):
        monkeypatch.setattr(fp_tree, "LEAF", leaf)
        trie = fp_tree.Trie(table, len(vocabulary))
        for _, text in items:
            weights = np.zeros(len(vocabulary), dtype=np.int64)
            weights[[vocabulary[t.encode()] for t in set(words(text))]] = 100
            every = table.scores(0, len(rows), weights)
            order = np.lexsort((ids, -every))[:10]
            order = order[every[order] > 0]
            scores, best = trie.best(weights, ids, 10, none, none)
            assert scores.tolist() == every[order].tolist() and best.tolist() == ids[order].tolist()


def test_a_node_is_never_below_its_documents_and_subtrees_are_left_out(monkeypatch):
    rng = np.random.default_rng(3)
    paths = sorted(sorted(rng.choice(200, 12, replace=False).tolist()) for _ in range(600))
    ends = np.arange(0, 12 * 600 + 1, 12)
    table = fp_tree.Rows(ends, np.array(paths).ravel(), rng.integers(1, 5, 7200), rng.integers(10, 60, 600))
    monkeypatch.setattr(fp_tree, "LEAF", 8)
    trie = fp_tree.Trie(table, 200)
    weights = np.zeros(200, dtype=np.int64)
    weights[paths[123][:6]] = 5000
    every = table.scores(0, 600, weights)
    for x in range(len(trie.first)):
        assert trie.nodes.scores(x, x + 1, weights)[0] >= every[trie.first[x] : trie.last[x]].max()
    looked = []
    score = fp_tree.Rows.scores
    monkeypatch.setattr(fp_tree.Rows, "scores", lambda self, lo, hi, w: looked.append(hi - lo if self is table else 0) or score(self, lo, hi, w))
    none = np.zeros(0, dtype=np.int64)
    trie.best(weights, np.arange(600), 3, none, none)
    assert 0 < sum(looked) < 300


def test_defined_results(spark, documents):
    docs = [(1, None), (2, ""), (3, "--- !!"), (None, "rare word"), (4, "rare word"), (4, "rare word"), (5, "word " * 5), (6, "other")]
    items = [(1, "RARE"), (2, None), (3, "absent"), (None, "rare"), (4, "rare"), (4, "word"), (5, "")]
    got = found(spark, documents, docs, items)
    assert got == brute(docs, items)
    assert [r[:3] for r in got if r[0] == 1] == [(1, 1, 4), (1, 2, 4)]
    assert found(spark, documents, [], items) == [] and found(spark, documents, docs, []) == []


def test_a_very_long_text(spark, documents, monkeypatch):
    monkeypatch.setattr(fp_tree, "SLICE", 1000)
    docs = [(1, "needle " + "hay stäck, " * 40_000 + "needle"), (2, "needle hay"), (3, "x")]
    items = [(1, "needle"), (2, "stäck hay")]
    assert found(spark, documents, docs, items) == brute(docs, items)


@pytest.mark.parametrize("text", ["aB1 c", "é×x_y", "a\x7fb", "日本 語", "😀a-b"])
def test_terms_over_bytes(text):
    assert [t.decode() for part in fp_tree.terms_of(text.encode()) for t in part] == words(text)
