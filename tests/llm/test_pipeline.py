"""The pipeline against a plain version that applies the decisions of each stage one by one."""

import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from feedloom.llm import langid, packing, queries, toxicity
from feedloom.llm.tokenizing import tokenizer
from feedloom.workload.registry import TABLES
from tools.check_oracles import rows_of

SF = "/root/testdata/sf0.001"


def near_groups(rows):
    sets = {}
    for r in rows:
        w = r["text"].lower().split() if r["text"].isascii() else r["text"].translate({c: c + 32 for c in range(65, 91)}).split()
        sets[r["doc_id"]] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    name = {i: i for i in sets}
    ids = sorted(i for i in sets if sets[i])
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(name[a], name[b])
            if name[a] != low or name[b] != low:
                name[a] = name[b] = low
                changed = True
    return name


def test_stages_and_result(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [s[0] for s in corpus_pipeline.STAGES] == ["toxicity", "language_id", "near_duplicates", "mix_sources", "pack"]
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = spark.createDataFrame(stage(spark, frames[-1], SF).toPandas()) if name != "pack" else stage(spark, frames[-1], SF)
        if name != "pack":
            assert out.columns == docs.columns
        frames.append(out.cache())
    rows = [{r["doc_id"]: r for r in f.collect()} for f in frames[:4]]

    scored = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    assert set(rows[1]) == {i for i in rows[0] if not scored[i]}
    langs = {r["doc_id"]: r for r in langid.identify(frames[1], langid.learn(frames[1])).collect()}
    assert set(rows[2]) == {i for i in rows[1] if langs[i]["lang_pred"] != "und" and langs[i]["bits_per_byte"] <= 8}
    groups = near_groups(rows[2].values())
    assert set(rows[3]) == {i for i, g in groups.items() if i == g}

    mixed = frames[4].collect()
    sizes = {}
    for r in rows[3].values():
        sizes.setdefault(r["source"], []).append(len(r["text"].split()))
    total = sum(map(sum, sizes.values()))
    assert abs(sum(len(r["text"].split()) for r in mixed) - 1.5 * total) < len(sizes) * max(map(max, sizes.values()))
    copies = {}
    for r in mixed:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert max(copies.values()) <= 2 and set(copies) <= set(rows[3])

    pieces = frames[5].collect()
    t = tokenizer("word_bpe_49k.json")
    ids = {i: [*t.encode(r["text"], add_special_tokens=False).ids, 2] for i, r in rows[3].items()}
    assert sum(p["length"] for p in pieces) == sum(len(ids[i]) * n for i, n in copies.items())
    for p in pieces:
        part = np.array(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]], dtype="<u4")
        assert zlib.crc32(part.tobytes()) == p["ids_crc32"]
    assert corpus_pipeline.run(spark, SF).columns == frames[5].columns


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    answer = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, answer.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"op13_spelling_variants"}))
def test_query_gives_a_row_per_input_row(spark, name):
    kind = {"op1": ("pages", "page_id"), "op7": ("embeddings", "query_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    n = spark.read.parquet(f"{SF}/{kind[0]}.parquet").count()
    got = entry.queries()[name](spark, SF).select(kind[1]).distinct().count()
    assert got == (n if kind[0] != "embeddings" else -(-n // 50))
