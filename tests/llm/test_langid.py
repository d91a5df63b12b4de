import math
from collections import Counter, defaultdict

import numpy as np

from feedloom.llm import langid
from feedloom.llm.langid import Lookup, Model, windows


def count(texts, order):
    out = {k: Counter() for k in range(order + 1)}
    for lang, text in texts:
        data = b"\n" * order + text
        for i in range(order, len(data)):
            for k in range(order + 1):
                out[k][(lang, data[i - k : i + 1])] += 1
    return out


def brute_bits(counts, order, lang, text):
    data, total = b"\n" * order + text, 0.0
    seen = {k: defaultdict(dict) for k in counts}
    for k, c in counts.items():
        for (g, w), n in c.items():
            if g == lang:
                seen[k][w[:-1]][w[-1]] = n
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            after = seen[k].get(data[i - k : i])
            if not after:
                continue
            room = sum(after.values()) + len(after)
            if data[i] in after:
                total -= math.log2(after[data[i]] / room)
                break
            total -= math.log2(len(after) / room)
        else:
            total += 8
    return total


def model_of(texts, order):
    langs, counts = sorted({g for g, _ in texts}), count(texts, order)
    arrays = {
        k: (
            np.array([langs.index(g) for g, _ in c]), np.array([int.from_bytes(w, "big") for _, w in c], dtype=np.uint64),
            np.array(list(c.values())),
        )
        for k, c in counts.items()
    }
    return Model.build(langs, order, arrays), counts


def test_code_lengths_are_those_of_the_plain_definition():
    texts = [("a", b"the cat sat on the mat"), ("b", "l'été en forêt".encode()), ("a", b"that is the hat")]
    for order in (0, 1, 3):
        m, counts = model_of(texts, order)
        probes = [b"the hat", b"\xff\x00", "forêt that".encode(), b"t"]
        got = m.lengths(probes)
        for i, p in enumerate(probes):
            for j, g in enumerate(m.langs):
                assert abs(got[i, j] - brute_bits(counts, order, g, p)) < 1e-3


def test_long_texts_go_window_by_window(monkeypatch):
    m, counts = model_of([("a", b"abcabcabd" * 20)], 3)
    probe = b"abcabdabz" * 400
    whole = m.lengths([probe])[0, 0]
    monkeypatch.setattr(langid, "WINDOW", 100)
    assert abs(m.lengths([b"x", probe, b""])[1, 0] - whole) < 1e-2
    assert abs(whole - brute_bits(counts, 3, "a", probe)) < 1e-1


def test_lookup_finds_what_is_there():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 5000, 900).astype(np.uint64))
    asked = np.arange(5000, dtype=np.uint64)
    got = Lookup(keys).find(asked)
    want = np.where(np.isin(asked, keys), np.searchsorted(keys, asked), -1)
    assert (got == want).all()
    assert (Lookup(np.array([], dtype=np.uint64)).find(asked) == -1).all()


def test_windows():
    assert windows(np.frombuffer(b"abc", dtype=np.uint8), 1).tolist() == [0x6162, 0x6263]


def rows():
    en, de = "the house and the weather of this year", "das haus und das wetter in diesem jahr"
    known = [(i, (en if i % 2 else de) + f" {i}", "en" if i % 2 else "de", "s") for i in range(80)]
    return known + [(100, None, "en"), (101, "", "de"), (102, "123 !!", "en"), (103, "the weather", None), (None, "das wetter", "de"), (103, "the weather", None)]


def test_queries_rows(documents):
    df = documents(rows())
    got = langid.identify(df, langid.learn(df)).collect()
    assert len(got) == len(rows())
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0.0 for i in (100, 101, 102))
    assert by[103]["lang_pred"] == "en" and by[None]["lang_pred"] == "de" and 0.5 <= by[103]["score"] <= 1
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 80]
    assert held and all(r["lang_pred"] == ("en" if r["doc_id"] % 2 else "de") for r in held)


def test_nothing_to_learn(documents):
    df = documents([(1, "words", None), (2, None, "en")])
    assert langid.learn(df) is None
    assert {r["lang_pred"] for r in langid.identify(df, None).collect()} == {"und"}
    assert langid.identify(documents([]), langid.learn(documents([]))).count() == 0


def test_stage_keeps_clean_rows_and_columns(documents):
    df = documents(rows())
    out = langid.kept(df)
    assert out.columns == df.columns
    assert {r["doc_id"] for r in df.select("doc_id").collect()} - {r["doc_id"] for r in out.collect()} == {100, 101, 102}


def test_languages_of_long_texts_alone_are_learned(documents, monkeypatch):
    monkeypatch.setattr(langid, "WINDOW", 1000)
    rows = [(i, "der hund und die katze gehen nach hause " * 900 + str(i), "de") for i in range(20)]
    rows += [(100 + i, f"the dog and the cat are walking home {i}", "en") for i in range(60)]
    rows += [(300, "une maison est grande et les chiens sont petits " * 12_000, "fr")]
    df = documents(rows)
    model = langid.learn(df, parts=10**9, held=1)
    assert model.langs == ["de", "en", "fr"]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(df, model).collect()}
    assert got == {r[0]: r[2] for r in rows}


def test_most_frequent_languages_are_learned(documents):
    rows = [(i, f"text {i} " * (i % 3 + 1), "abc"[i % 3]) for i in range(30)]
    assert langid.fit(documents(rows), "lang", "text", "doc_id", most_langs=2).langs == ["b", "c"]


def test_rows_that_repeat_id_and_text_count_once(documents):
    one = [(None, "ein text", "de")]
    counts = lambda rows: langid.fit(documents(rows), "lang", "text", "doc_id").costs[0].tolist()
    assert counts(one * 50) == counts(one)
