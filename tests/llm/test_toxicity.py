import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import toxicity


def corpus(n=400):
    rng = np.random.default_rng(2)
    words = {g: [f"{g}{''.join(rng.choice(list('aeioulnrst'), 5))}" for _ in range(300)] for g in ("en", "de")}
    rows, labels = [], []
    for i in range(n):
        g = "en" if i % 3 else "de"
        text = list(rng.choice(words[g], rng.integers(5, 80)))
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                text[rng.integers(len(text))] = "Grobian!" if g == "en" else "schuft" + "".join(rng.choice(list("aeiou"), 4))
        rows.append((i, " ".join(text), g, "s"))
        labels.append((i, 1, int(bad)))
    return rows, labels


@pytest.fixture
def tables(spark, documents):
    def of(rows, labels):
        marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
        return documents(rows), marks

    return of


def test_held_out_accuracy_and_edge_rows(tables):
    rows, labels = corpus()
    extra = [(1000, None), (1001, ""), (1002, "grobian " * 30_000, None), (None, "grobian"), (3, rows[3][1], "en", "s"), (1003, "?? !!")]
    docs, marks = tables(rows + extra, labels + [(None, 1, 1), (1001, 0, 0), (7, 1, None), (5000, 1, 1)])
    model = toxicity.learn(docs, marks)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 40 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    by = {r["doc_id"]: r for r in got}
    assert by[1002]["predicted"] == 1 and by[None]["predicted"] == 1
    assert by[1000]["score"] == by[1001]["score"] == by[1003]["score"] < 0.5
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1
    again = toxicity.score(docs, toxicity.learn(docs.repartition(5), marks)).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {r["doc_id"]: r["score"] for r in got}


def test_stage_keeps_clean_rows_and_columns(tables):
    rows, labels = corpus()
    docs, marks = tables(rows, labels)
    out = toxicity.kept(docs, marks)
    assert out.columns == docs.columns
    left = {r["doc_id"] for r in out.select("doc_id").collect()}
    toxic = {i for i, _, t in labels if t}
    assert len(left & toxic) <= 2 and len(set(range(400)) - toxic - left) <= 2


def test_nothing_to_learn(tables):
    docs, marks = tables([(1, "a b"), (2, None)], [(1, 1, 0)])
    assert toxicity.learn(docs, marks) is None
    assert {(r["score"], r["predicted"]) for r in toxicity.score(docs, None).collect()} == {(0.0, 0)}
    empty, none = tables([], [])
    assert toxicity.score(empty, toxicity.learn(empty, none)).count() == 0


def test_batch_layout_does_not_change_scores():
    rng = np.random.default_rng(0)
    m = toxicity.Classifier(
        rng.normal(size=(toxicity.BUCKETS, toxicity.WIDTH)).astype("f4"),
        [rng.normal(size=(s, toxicity.WIDTH, toxicity.FILTERS)) for s in toxicity.SPANS],
        rng.normal(size=toxicity.FILTERS * len(toxicity.SPANS)), 0.1,
    )
    m.embedding[0] = 0
    texts = ["one two three", "", "four", "a b c d e f g", "two three"]
    words = toxicity.Words()
    numbers = words.of(texts)
    buckets = words.buckets()
    together = m.scores(numbers, m.projection(buckets), np.zeros((len(buckets), 1)))
    for i, t in enumerate(numbers):
        x = m.embedding[buckets[t]].sum(axis=1)
        x = np.vstack([x, np.zeros((2, toxicity.WIDTH))])
        pooled = [
            np.maximum(0, sum(x[k : k + len(t)] @ f[k] for k in range(len(f))).max(axis=0)) if len(t) else np.zeros(toxicity.FILTERS)
            for f in m.filters
        ]
        logit = np.concatenate(pooled) @ m.out + m.bias
        assert abs(together[i] - 1 / (1 + np.exp(-logit))) < 1e-4


def test_threshold_lies_in_the_widest_gap():
    assert toxicity.best_threshold(np.array([0.0, 1, 5, 6]), np.array([0, 0, 1, 1])) == 3.0
    assert toxicity.best_threshold(np.array([0.0, 1, 2]), np.array([1, 1, 1])) < 0


def test_thresholds_are_found_on_all_labelled_rows(tables, monkeypatch):
    rows, labels = corpus(3000)
    rows = [r for r in rows if r[2] == "en" or r[0] % 8 == 0]  # 25 toxic texts in the rarer language
    rows[1] = (rows[1][0], rows[1][1] + " word" * 10_000, *rows[1][2:])  # too long for the sample
    docs, marks = tables(rows, [x for x in labels if x[0] in {r[0] for r in rows}])
    seen, count = [], toxicity.counted_outputs
    monkeypatch.setattr(toxicity, "counted_outputs", lambda *a: seen.append((a[0], count(*a))) or seen[-1][1])
    model = toxicity.learn(docs, marks, most_each=100)
    calibrated, counts = seen[0][0], seen[0][1]
    left = {r["doc_id"] for r in toxicity.score(docs, None).where("not held_out").collect()}
    assert len(left) * 0.8 < counts[:, 2:].sum() == calibrated.count() < len(left) and rows[1][0] in left
    assert calibrated.where(F.col("doc_id") == rows[1][0]).count() == 1
    de = counts[counts[:, 0] == model.langs.index("de")]
    assert 8 <= de[:, 2].sum() < 25
    over = (de[:, 1] + 0.5) / toxicity.STEPS >= model.thresholds[model.langs.index("de")]
    assert de[over, 2].sum() >= 0.9 * de[:, 2].sum() and de[over, 3].sum() <= 0.1 * de[:, 3].sum()


def test_map_of_ids_has_the_bits_of_the_ids_alone(spark):
    ids = spark.range(0, 5000, 3).withColumnRenamed("id", "doc_id")
    bits = toxicity.id_bits(ids)
    place = [r[0] for r in ids.select(F.pmod(F.xxhash64("doc_id"), F.lit(toxicity.BITS))).collect()]
    assert set(np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist()) == set(place)


def test_long_texts_alone_are_learned(spark, documents):
    toxic, fine = "you are a vile worm and i loathe you ", "we went to the lake and had a swim "
    rows = [(i, (toxic if i % 2 else fine) + "filling words of a very long text " * 1200) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.learn(documents(rows), labels)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(documents(rows), model).collect()}
    assert got == {i: i % 2 for i in range(60)}
    # A budget below a single text still learns from one of each.
    assert toxicity.learn(documents(rows), labels, most_bytes=10) is not None


def test_gradients_are_those_of_differences():
    """One step of training against numerical derivatives of its loss."""
    rng = np.random.default_rng(1)
    texts = [rng.integers(1, 30, rng.integers(1, 9)).astype(np.int32) for _ in range(6)]
    y = np.array([0, 1, 0, 1, 1, 0])
    buckets = rng.integers(1, 200, (30, toxicity.SLOTS)).astype(np.int32)

    def fresh():
        model = toxicity.initial(texts, buckets, y)
        r = np.random.default_rng(2)
        model.embedding = r.normal(0, 1, model.embedding.shape)
        model.filters = [r.normal(0, 1, f.shape) for f in model.filters]
        model.out = r.normal(0, 1, model.out.shape)
        model.bias = 0.3
        return model

    def loss(model):
        line, begins, ends = toxicity.laid_out(texts)
        x = model.embedding[buckets[line]].sum(axis=1)
        total = 0.0
        for d, (s, e) in enumerate(zip(begins, ends, strict=True)):
            hidden = []
            for f in model.filters:
                z = [sum(x[min(p + k, len(line) - 1)] @ f[k] for k in range(len(f))) for p in range(s, min(e, len(line) - len(f) + 1))]
                hidden.append(np.maximum(np.max(z, axis=0), 0))
            logit = np.concatenate(hidden) @ model.out + model.bias
            total += np.log1p(np.exp(-logit if y[d] else logit)) / len(texts)
        return total

    rate, moved = 1e-3, fresh()
    toxicity.train(moved, texts, buckets, y, epochs=1, batch=len(texts), rate=rate)
    start, eps = fresh(), 1e-6
    for name, index in [("out", (3,)), ("out", (17,)), ("filters", (0, 0, 2, 1)), ("filters", (1, 1, 4, 5)), ("filters", (2, 2, 0, 7))]:
        at = (lambda m: m.filters[index[0]]) if name == "filters" else (lambda m: m.out)
        place = index[1:] if name == "filters" else index
        up, down = fresh(), fresh()
        at(up)[place] += eps
        at(down)[place] -= eps
        slope = (loss(up) - loss(down)) / (2 * eps)
        step = at(start)[place] - at(moved)[place]
        assert step == pytest.approx(rate * slope / np.sqrt(1e-2 + slope**2), abs=1e-8)
