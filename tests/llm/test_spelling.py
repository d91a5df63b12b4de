import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from feedloom.llm import spelling


def counted(docs, drop_every=31):
    out = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop_every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs, drop_every=31):
    words = counted(docs, drop_every)
    near = {w: [x for x in words if abs(len(x) - len(w)) <= 1 and one_edit(w, x)] for w in words}
    best = {w: min(x, key=lambda v: (-words[v], v)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if words[b] >= 10 * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def found(documents, docs, **options):
    return sorted(tuple(r) for r in spelling.variants(documents(docs), **options).collect())


def corpus(seed=0, letters="abçÉ×"):
    rng = random.Random(seed)
    stems = ["".join(rng.choices(letters, k=rng.randint(6, 12))) for _ in range(25)]
    docs = []
    for i in range(120):
        text = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choices(stems, [1 / (k + 1) ** 2 for k in range(len(stems))])[0]
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]])
            text.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((i, rng.choice([" ", "-", "1", "\n"]).join(text)))
    return docs


@pytest.mark.parametrize(("seed", "tile", "task"), [(0, 8192, 100_000), (1, 3, 10), (2, 7, 40)])
def test_forms_are_those_of_all_pairs(documents, monkeypatch, seed, tile, task):
    for name, value in (("TILE", tile), ("STRIP", 2), ("TASK", task)):
        monkeypatch.setattr(spelling, name, value)
    docs = corpus(seed)
    want = brute(docs, 5)
    assert found(documents, docs, drop_every=5) == want
    assert sum(r[1] is not None for r in want) > 5 and len(want) > 60


def test_chains_of_forms_and_ties(documents):
    docs = [(i, "abcdefgh " * 400) for i in range(1)] + [(9, "abcdefgx " * 30 + "abcdefgxy " * 3 + "bbcdefgh " * 2 + "abcdefgz " * 30)]
    got = {r[0]: r for r in found(documents, docs, drop_every=10**9)}
    assert got == {r[0]: r for r in brute(docs, 10**9)}
    assert got["abcdefgxy"][1:3] == ("abcdefgx", "abcdefgh")


def test_defined_results(documents):
    docs = [(None, "Variant variant"), (1, None), (2, ""), (3, "12 34"), (4, "variamt variamt"), (4, "variamt variamt"), (5, "short")]
    assert found(documents, docs) == brute(docs)
    assert found(documents, []) == []


def test_very_long_words_and_texts(documents):
    long = "ab" * 20_000
    docs = [(1, f"{long} {long}x {long} {long}x"), (2, "filling " * 50_000 + "fillinh fillinh")]
    got = {r[0]: r for r in found(documents, docs, drop_every=10**9)}
    assert (got[long][4], got["fillinh"][1], got["filling"][3]) == (1, "filling", 50_000)


def test_verified_edits_and_distances():
    words = ["abcdefg", "abcdegf", "abcdefh", "xbcdefg", "gfedcba"]
    chars = spelling.characters(words, 7)
    longer = spelling.characters(["abcdefgh", "aabcdefg", "abcdxefh"], 8)
    pairs = {(int(a), int(b)) for i, j in spelling.near_pairs(chars, chars, 0) for a, b in zip(i, j, strict=True)}
    assert pairs == {(a, b) for a in range(5) for b in range(5) if one_edit(words[a], words[b])}
    pairs = {(int(a), int(b)) for i, j in spelling.near_pairs(chars, longer, 0) for a, b in zip(i, j, strict=True)}
    assert pairs == {(0, 0), (0, 1), (2, 2), (2, 0)} - {(2, 0)} | ({(2, 0)} if one_edit("abcdefh", "abcdefgh") else set())
    assert (spelling.letter_counts(chars, np.arange(256)).sum(axis=1) == 7).all()


def test_query_against_all_pairs(spark):
    from feedloom.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    words = counted(docs)
    got = sorted(tuple(r) for r in queries.QUERIES["op13_spelling_variants"](spark, sf).collect())
    assert {(r[0], r[3]) for r in got} == set(words.items())
    # All near words of a word by its own edits, instead of every pair.
    letters = sorted({c for w in words for c in w})
    for w, form, root, n, near, form_n in got:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        mine = (edits - {w}) & words.keys()
        best = min(mine, key=lambda v: (-words[v], v), default=None)
        taken = best if best and words[best] >= 10 * n else None
        assert (near, form, form_n) == (len(mine), taken, words.get(taken))
        assert (root == w) == (form is None)
