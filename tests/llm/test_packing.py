import itertools
import zlib

import numpy as np

from feedloom.llm import packing
from feedloom.llm.tokenizing import tokenizer
from feedloom.session import staged


def test_hilbert_neighbours_touch():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    key = packing.hilbert_key(cells, 3)
    assert sorted(key.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


ROWS = [
    (1, "Some words here, it's fine."), (2, None), (3, ""), (4, "LONG text " * 5000), (5, "Some words here, it's fine."), (1, "Some words here, it's fine."),
    (None, "no id"), (6, "a\x1cb <|endoftext|> Ünï\ncode\t x"), (7, " " * 50),
]


def encoded(text):
    return [*tokenizer("word_bpe_49k.json").encode(text or "", add_special_tokens=False).ids, 2]


def test_pieces_hold_every_id_once(documents):
    got = packing.pack(documents(ROWS), length=64).collect()
    line = sorted(((r["sequence_id"], r["offset"], r["length"]) for r in got))
    assert [s * 64 + o for s, o, _ in line] == [0, *itertools.accumulate(n for *_, n in line)][:-1]
    assert all(o + n <= 64 for _, o, n in line)
    want = sorted(repr((i, encoded(t))) for i, t in ROWS)
    docs, at = [], {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        ids = np.frombuffer(r["ids"], dtype="<u4")
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(ids) == r["length"]
        if r["start"] == 0:
            at[r["doc_id"]] = []
            docs.append((r["doc_id"], at[r["doc_id"]]))
        assert len(at[r["doc_id"]]) == r["start"]
        at[r["doc_id"]].extend(ids.tolist())
        assert r["doc_tokens"] >= r["start"] + r["length"]
    assert sorted(map(repr, docs)) == want


def test_runs_of_equal_rows_are_encoded_and_written_once(documents, monkeypatch):
    text = "Some words here, it's fine. " * 40
    rows = [(1, text), (1, text), (1, "other"), (1, text), (2, text), (2, None), (2, None), (2, ""), (None, text), (None, text)]
    written = {}
    monkeypatch.setattr(packing, "staged", lambda df, label: written.setdefault(label, staged(df, label)))
    got = packing.pack(documents(rows).coalesce(1), length=64).collect()
    ids = written["packing-ids"]
    assert [r["copies"] for r in ids.orderBy("first").collect()] == [2, 1, 1, 1, 2, 1, 2]
    assert all(len(r["ids"]) < 0.5 * 2 * r["n"] for r in ids.where("n > 100").collect())
    assert sorted(r["offset"] + 64 * r["sequence_id"] for r in got if r["start"] == 0)[0] == 0
    assert sum(r["length"] for r in got) == sum(len(encoded(t)) for _, t in rows)
    starts = [r["doc_id"] for r in got if r["start"] == 0]
    assert sorted(map(repr, starts)) == sorted(repr(i) for i, _ in rows)


def test_words_encoded_together_are_those_encoded_alone():
    import random

    import pyarrow as pa

    rng = random.Random(4)
    stock = ["The", "été", "ÜBER", "ß", "Straße.", "naïve,", "İx", "ſt", "e\u0301", "µ", "ª", "a_b", "_", "__", "x__", "it's", "'S", "1", "12.", "..",
             ".", ",", "a..", "<|endoftext|>", "<|ENDOFTEXT|>", "a<|startoftext|>b", "日本", "ÿ", "Ŀ", "×", "", "Ω.", "ﬁ", "\x1c", "\u00a0x", "don't,"]
    stock += ["".join(rng.choices("abcdefABCÉéñÄ", k=rng.randint(1, 14))) + rng.choice(["", "", ".", ",", "!"]) for _ in range(3000)]
    stock = list(dict.fromkeys(stock))
    pool, size = packing.distinct_encoder("word_bpe_49k.json")(pa.array(stock), np.ones(len(stock), dtype=np.int64))
    at = 0
    for piece, n in zip(stock, size.tolist(), strict=True):
        assert pool[at : at + n].tolist() == encoded(piece)[:-1], piece
        at += n
    assert at == len(pool)


def test_sequences_join_pieces(documents):
    pieces = packing.pack(documents(ROWS), length=256)
    got = {r["sequence_id"]: r for r in packing.sequences(pieces).collect()}
    assert all(r["length"] == len(r["ids"]) // 4 for r in got.values())
    assert sorted(r["length"] for r in got.values())[1:] == [256] * (len(got) - 1)


def test_similar_documents_are_near_each_other(documents):
    rows = [(i, ("red green blue " if i % 2 else "one two three ") * 20 + str(i)) for i in range(60)]
    got = packing.pack(documents(rows), length=100_000).collect()
    kinds = [r["doc_id"] % 2 for r in sorted(got, key=lambda r: r["offset"])]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) < 15


def test_empty_table(documents):
    assert packing.pack(documents([])).count() == 0


def test_encoding_holds_a_small_part_of_the_texts_at_a_time():
    import tracemalloc

    import pyarrow as pa

    texts = [" ".join(f"word{i % 900} and,more" for i in range(k, k + 2000)) for k in range(160)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts, "row": list(range(len(texts)))})
    run = packing._encode("word_bpe_49k.json", 49_408, 2)
    list(run(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    for _ in run(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25e6  # of 5.4 MB of text; 49 MB when four times as much was encoded at a time
