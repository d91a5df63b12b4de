"""Convolutional text classifier: hashed word embeddings, several filter widths, max pooling.

A word is the sum of the embeddings of its hashed spelling and of its hashed beginnings of four, five
and six letters, so endings never seen before still find their stem. Filters of one, two and three
words slide over the whole text; each contributes its largest response, cut off below zero, to one
output. Everything is trained in numpy by gradient descent. The first embedding dimension starts from
the class log-odds of the hashed feature, which saves the search for the few words that matter.

Thresholds are calibrated by language on all labelled rows that neither the gradient used nor are held
out: Spark counts their outputs in steps of 1/64 by language and label. The language of a
text is read from its own words (a hashed word model learned along with the classifier), never from a
column, so a score depends on the text alone: it is the logistic function of the output minus the
threshold of the text's language, hence 0.5 at the threshold.

The gradient and the words of languages take a bounded sample: about ``most_each`` toxic rows and twice
as many others at most, of about ``most_bytes`` bytes of either kind, whole texts chosen by a hash of the id and
at least one of each. Calibrating and scoring read every word of every text.

Defined results: null and empty texts get the score of a text without words; without labelled rows of
both kinds every score is 0; a null id counts as the empty text when rows are held out; repeated rows
are scored alike; several labels of one id count as toxic if one is; other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import give_back, small_batches, tidy, whole_row
from feedloom.llm.langid import remainder
from feedloom.llm.tokenizing import slices

BUCKETS, WIDTH, FILTERS = 1 << 18, 8, 8
SPANS = (1, 2, 3)  # words a filter covers
STEMS = (4, 5, 6)  # letters of the beginnings
SLOTS = 1 + len(STEMS)
REMEMBERED = 100_000  # words remembered per Python worker
RUN = 1 << 17  # words scored at a time
BITS = 1 << 25  # of the map of labelled ids
STEPS, FARTHEST = 64, 64  # counted steps of an output from one number to the next; outputs beyond count as this


def features(word: str) -> list[int]:
    """Buckets of a word: its spelling and beginnings in lower case, without marks at either end.

    Bucket 0 stays empty and fills the places of beginnings a word is too short for.
    """
    low = word.lower()
    a, b = 0, len(low)
    while a < b and not low[a].isalnum():
        a += 1
    while b > a and not low[b - 1].isalnum():
        b -= 1
    core = low[a:b]
    if not core:
        return [0] * SLOTS
    parts = [core, *[f"{n}:{core[:n]}" if len(core) >= n else "" for n in STEMS]]
    return [1 + xxhash.xxh32_intdigest(p.encode()) % (BUCKETS - 1) if p else 0 for p in parts]


class Words:
    """Numbers for words, and for each number its buckets. Number 0 is the empty place between texts."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.flat = array("i", [0] * SLOTS)

    def buckets(self, start: int = 0) -> np.ndarray:
        """Buckets of the words from number ``start`` on, a row each."""
        return np.array(self.flat[start * SLOTS :], dtype=np.int32).reshape(-1, SLOTS)

    def of(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            words = text.split()
            for w in set(words):
                if w not in self.number:
                    self.number[w] = len(self.flat) // SLOTS
                    self.flat.extend(features(w))
            out.append(np.fromiter(map(self.number.__getitem__, words), dtype=np.int32, count=len(words)))
        return out


def laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all texts one after the other with empty places between; begins and ends."""
    gap = np.zeros(max(SPANS) - 1, dtype=np.int32)
    line = np.concatenate([x for t in texts for x in (t, gap)] or [gap])
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + len(gap))[:-1]]).astype(np.int64) if len(sizes) else sizes
    return line, begins, begins + sizes


@dataclass
class Classifier:
    embedding: np.ndarray
    filters: list[np.ndarray]  # per span: words x WIDTH x FILTERS
    out: np.ndarray
    bias: float
    langs: list[str] = field(default_factory=list)
    word_bits: np.ndarray | None = None  # per bucket and language, the log-probability of a word
    thresholds: np.ndarray | None = None

    def responses(self, projected: np.ndarray, line: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pooled filter responses per text; a text without words has none."""
        pooled = np.zeros((len(begins), FILTERS * len(SPANS)))
        some = np.flatnonzero(ends > begins)
        if not len(some):
            return pooled
        edges = np.stack([begins[some], ends[some]], axis=1).ravel()
        at = 0
        for i, span in enumerate(SPANS):
            n = len(line) - span + 1
            z = np.zeros((n, FILTERS), dtype=np.float32)
            for k in range(span):
                z += projected[line[k : n + k], at : at + FILTERS]
                at += FILTERS
            z = np.vstack([z, np.zeros((len(line) - n + 1, FILTERS), dtype=np.float32)])
            pooled[some, i * FILTERS : (i + 1) * FILTERS] = np.maximum.reduceat(z, edges, axis=0)[::2]
        return np.maximum(pooled, 0)

    def projection(self, buckets: np.ndarray) -> np.ndarray:
        """What every word adds to every filter at each of its places."""
        x = self.embedding[buckets].sum(axis=1)
        return np.concatenate([x @ f[k] for f in self.filters for k in range(len(f))], axis=1).astype(np.float32)

    def language_bits(self, buckets: np.ndarray) -> np.ndarray:
        return self.word_bits[buckets[:, 0]] * (buckets[:, :1] > 0)

    def raw(self, texts: list[np.ndarray], projected: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Output and language of every text, before any threshold."""
        line, begins, ends = laid_out(texts)
        logit = self.responses(projected, line, begins, ends) @ self.out + self.bias
        sums = np.zeros((len(texts), max(1, len(self.langs))))
        some = np.flatnonzero(ends > begins)
        if self.langs and len(some):
            edges = np.stack([begins[some], ends[some]], axis=1).ravel()
            sums[some] = np.add.reduceat(bits[line], edges, axis=0, dtype=np.float64)[::2]
        return logit, sums.argmax(axis=1)

    def scores(self, texts: list[np.ndarray], projected: np.ndarray, bits: np.ndarray) -> np.ndarray:
        logit, guess = self.raw(texts, projected, bits)
        if self.langs:
            logit = logit - self.thresholds[guess]
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


class Remembered:
    """Words of a Python worker with what they add to filters and languages; forgotten when they are many."""

    def __init__(self, model: Classifier):
        self.model, self.words = model, Words()
        self.projected = self.bits = None

    def of(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        if len(self.words.number) > REMEMBERED:
            self.words, self.projected, self.bits = Words(), None, None
        numbers = self.words.of(texts)
        new = self.words.buckets(0 if self.projected is None else len(self.projected))
        more, more_bits = self.model.projection(new), self.model.language_bits(new)
        self.projected = more if self.projected is None else np.concatenate([self.projected, more])
        self.bits = more_bits if self.bits is None else np.concatenate([self.bits, more_bits])
        return numbers, self.projected, self.bits


def initial(texts: list[np.ndarray], buckets: np.ndarray, y: np.ndarray) -> Classifier:
    """Embeddings whose first dimension is the shrunk log-odds of the bucket; the rest is small noise."""
    rng = np.random.default_rng(5)
    seen = np.zeros((2, BUCKETS))
    for t, label in zip(texts, y, strict=True):
        seen[label, np.unique(buckets[np.unique(t)])] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()])
    odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    often = seen.sum(axis=0)
    e = rng.normal(0, 0.02, (BUCKETS, WIDTH))
    e[:, 0] = np.where(often > 0, odds * often / (often + 3) / 8, 0)
    e[0] = 0
    filters = [rng.normal(0, 0.1, (s, WIDTH, FILTERS)) for s in SPANS]
    filters[0][0, :, 0] = np.eye(WIDTH)[0]
    out = rng.normal(0, 0.1, FILTERS * len(SPANS))
    out[0] = 3.0
    return Classifier(e, filters, out, -3.0)


def train(model: Classifier, texts: list[np.ndarray], buckets: np.ndarray, y: np.ndarray, epochs: int = 4, batch: int = 32,
          rate: float = 0.02) -> None:
    """Gradient descent with rates that shrink by each parameter's past gradients. Through max pooling
    only the words of the largest responses get a gradient, so an update touches few embeddings."""
    rng = np.random.default_rng(3)
    past_e = np.full(BUCKETS, 1e-2)
    params = [*model.filters, model.out]
    past = [np.full(p.shape, 1e-2) for p in params]
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            rows = [i for i in order[at : at + batch] if len(texts[i])]
            if not rows:
                continue
            line, begins, ends = laid_out([texts[i] for i in rows])
            best, pooled = largest(model, line, begins, ends, buckets)
            hidden = np.maximum(pooled, 0).reshape(len(rows), -1)
            p = 1 / (1 + np.exp(-np.clip(hidden @ model.out + model.bias, -30, 30)))
            slope = (p - y[rows]) / len(rows)
            back = (slope[:, None] * model.out).reshape(pooled.shape) * (pooled > 0)
            grads = [np.zeros_like(f) for f in model.filters]
            touched, amounts = [], []
            for i, f in enumerate(model.filters):
                for k in range(len(f)):
                    where = np.minimum(best[:, i] + k, len(line) - 1)
                    near = buckets[line[where]]
                    grads[i][k] = np.einsum("df,dfw->wf", back[:, i], model.embedding[near].sum(axis=2))
                    gx = back[:, i, :, None] * f[k].T
                    touched.append(near.reshape(-1, SLOTS))
                    amounts.append(gx.reshape(-1, WIDTH))
            for q, g, h in zip(params, [*grads, hidden.T @ slope], past, strict=True):
                h += g**2
                q -= rate * g / np.sqrt(h)
            model.bias -= rate * float(slope.sum())
            ids, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            g = np.zeros((len(ids), WIDTH))
            each = np.repeat(np.concatenate(amounts), SLOTS, axis=0)
            np.add.at(g, inverse.ravel(), each)
            g[ids == 0] = 0
            past_e[ids] += (g**2).sum(axis=1)
            model.embedding[ids] -= rate * g / np.sqrt(past_e[ids])[:, None]


def largest(model: Classifier, line: np.ndarray, begins: np.ndarray, ends: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and size of the largest response of every filter in every text, some words at a time."""
    best = np.zeros((len(begins), len(SPANS), FILTERS), dtype=np.int64)
    pooled = np.full((len(begins), len(SPANS), FILTERS), -np.inf)
    for at in range(0, len(line), RUN):
        x = model.embedding[buckets[line[at : at + RUN + max(SPANS) - 1]]].sum(axis=1)
        for i, f in enumerate(model.filters):
            n = min(RUN, len(x) - len(f) + 1)
            if n <= 0:
                continue
            z = sum(x[k : n + k] @ f[k] for k in range(len(f)))
            for d in np.flatnonzero((begins < at + n) & (ends > at)):
                s, e = max(begins[d] - at, 0), min(ends[d] - at, n)
                top = z[s:e].argmax(axis=0)
                value = z[s + top, np.arange(FILTERS)]
                more = value > pooled[d, i]
                best[d, i, more], pooled[d, i, more] = (at + s + top)[more], value[more]
    return best, pooled


def best_threshold(logit: np.ndarray, y: np.ndarray) -> float:
    """The output that separates the labels best by F1, in the middle of the widest such gap."""
    v, where = np.unique(logit, return_inverse=True)
    return best_cut(v, np.bincount(where, y == 1, len(v)), np.bincount(where, y != 1, len(v)))


def best_cut(v: np.ndarray, toxic: np.ndarray, others: np.ndarray) -> float:
    """The same from the numbers of toxic and other rows at each of the rising outputs ``v``."""
    positive, everyone = toxic.sum(), (toxic + others).sum()
    caught = positive - np.concatenate([[0], np.cumsum(toxic)])  # positives above each cut
    taken = everyone - np.concatenate([[0], np.cumsum(toxic + others)])
    f1 = 2 * caught / np.maximum(1, taken + positive)
    padded = np.concatenate([[v[0] - 2], v, [v[-1] + 2]])
    gaps = padded[1:] - padded[:-1]
    cut = max(np.flatnonzero(f1 >= f1.max() - 1e-12), key=lambda i: gaps[i])
    return float((padded[cut] + padded[cut + 1]) / 2)


def outputs(model: Classifier, texts: list[np.ndarray], buckets: np.ndarray) -> np.ndarray:
    """Raw output of every text, a run of texts at a time so that little is held at once."""
    logit = np.zeros(len(texts))
    rows: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        rows.append(i)
        size += len(t)
        if size < RUN and i + 1 < len(texts):
            continue
        words, inverse = np.unique(np.concatenate([[0], *[texts[j] for j in rows]]), return_inverse=True)
        local = np.split(inverse[1:], np.cumsum([len(texts[j]) for j in rows])[:-1])
        near = buckets[words]
        logit[rows] = model.raw(local, model.projection(near), model.language_bits(near))[0]
        rows, size = [], 0
    return logit


def learn_languages(model: Classifier, texts: list[np.ndarray], buckets: np.ndarray, langs: np.ndarray) -> None:
    """Language model of words; thresholds are 0 until they are calibrated."""
    known = sorted({g for g in langs if g is not None})
    counts = np.full((BUCKETS, max(1, len(known))), 0.1)
    for t, g in zip(texts, langs, strict=True):
        if g is not None:
            np.add.at(counts[:, known.index(g)], buckets[t, 0], 1)
    model.langs = known or [""]
    model.word_bits = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    model.thresholds = np.zeros(len(model.langs))


def id_bits(marked: DataFrame) -> np.ndarray:
    """Map of ``BITS`` bits with the bits of the ids set by their hash: a document whose bit is not set has
    no label. Of fixed size; where it gets full, more documents are scored in vain."""
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(BITS)) + 1
    found = marked.groupBy(F.bitmap_bucket_number(place).alias("n")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    out = np.zeros((BITS >> 15, 1 << 12), dtype=np.uint8)
    for r in found.toLocalIterator():
        out[r["n"] - 1] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out.ravel()


def counted_outputs(docs: DataFrame, marked: DataFrame, model: Classifier) -> np.ndarray:
    """How many rows of ``docs`` with a label in ``marked`` have which language, label and output, as
    rows of language, step, toxic rows and other rows. Texts are not moved: those that may have a label
    are scored where they are, and only ids, languages and steps meet the labels. The table is bounded by
    the steps."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model, id_bits(marked)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, bits = shared.value
        known = Remembered(m)

        def likely(batch: pa.RecordBatch) -> pa.RecordBatch:
            place = batch.column(2).to_numpy()
            return batch.filter(pa.array((bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)))

        for batch in (part for whole in batches for part in slices(likely(whole), 1, RUN * 4)):
            logit, guess = m.raw(*known.of(batch.column(1).to_pylist()))
            step = np.floor(np.clip(logit, -FARTHEST, FARTHEST) * STEPS).astype(np.int32)
            arrays = [batch.column(0), pa.array(guess.astype(np.int32)), pa.array(step)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "guess", "step"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    placed = own.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(BITS)).cast("long"))
    found = placed.mapInArrow(tidy(run), "doc_id long, guess int, step int")
    met = found.join(marked, "doc_id").groupBy("guess", "step")
    counts = met.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") != 1).alias("others"))
    out = np.array([list(r) for r in counts.orderBy("guess", "step").collect()], dtype=np.int64).reshape(-1, 4)
    shared.destroy()
    return out


def calibrate(model: Classifier, counts: np.ndarray, overall: float, fewest: int = 8) -> None:
    """A threshold per language from ``counted_outputs``.

    A language with fewer than ``fewest`` rows of either label takes the threshold of all, and where all
    have only one label, that is ``overall``.
    """

    def cut(rows: np.ndarray) -> float:
        steps, where = np.unique(rows[:, 1], return_inverse=True)
        sums = [np.bincount(where, rows[:, k], len(steps)) for k in (2, 3)]
        return best_cut((steps + 0.5) / STEPS, *sums)

    overall = cut(counts) if counts[:, 2:].sum(axis=0).min() else overall
    for i in range(len(model.langs)):
        rows = counts[counts[:, 0] == i]
        model.thresholds[i] = cut(rows) if rows[:, 2:].sum(axis=0).min() >= fewest else overall


def learn(
    docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, most_each: int = 2000, most_bytes: int = 16 << 20,
) -> Classifier | None:
    """Classifier from the labelled rows that are not held out."""
    small_batches(docs.sparkSession)
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    marked = marked.where(remainder(F.col("doc_id"), parts) != held)
    one = marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text", "lang")
    draw = F.pmod(F.xxhash64(F.lit("toxicity sample"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Texts stay where they are; their ids and lengths meet the labels.
    sized = texts.select("doc_id", F.octet_length("text").alias("size")).join(one, "doc_id").withColumn("draw", draw)
    facts = {
        r["toxic"]: r for r in sized.groupBy((F.col("toxic") == 1).cast("int").alias("toxic")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), F.min("draw").alias("least")
        ).collect()
    }
    if len(facts) < 2:
        return None
    share = [
        max(facts[k]["least"], min(1.0, most_each * (2 - k) / facts[k]["n"], most_bytes / max(1, facts[k]["size"]))) for k in (0, 1)
    ]
    # About three times most_each rows of two numbers: small by the parameter, whatever the input.
    chosen = F.broadcast(one.where(draw <= F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])))
    sample = texts.join(chosen, "doc_id").toArrow().sort_by("doc_id")  # the same rows give the same model
    y = np.array(sample["toxic"].to_pylist(), dtype=np.int64)
    if len(set(y.tolist())) < 2:
        return None
    words = Words()
    numbers = [x for at in range(0, len(y), 256) for x in words.of(sample["text"].slice(at, 256).to_pylist())]
    langs = np.array(sample["lang"].to_pylist(), dtype=object)
    ids = sample["doc_id"].to_pylist()
    apart = np.array([xxhash.xxh32_intdigest(str(i)) % 4 == 0 for i in ids])
    buckets = words.buckets()
    del sample, words
    give_back()
    if not (0 < y[~apart].sum() < (~apart).sum()):
        apart[:] = False
    inside = np.flatnonzero(~apart)
    model = initial([numbers[i] for i in inside], buckets, y[inside])
    train(model, [numbers[i] for i in inside], buckets, y[inside])
    model.embedding = model.embedding.astype(np.float32)
    learn_languages(model, numbers, buckets, langs)
    used = docs.sparkSession.createDataFrame([(i,) for i in sorted({ids[j] for j in inside})], "doc_id long")
    rest = texts.where(remainder(F.col("doc_id"), parts) != held).join(F.broadcast(used), "doc_id", "left_anti")
    overall = best_threshold(outputs(model, numbers, buckets), y)
    del numbers, buckets
    give_back()
    calibrate(model, counted_outputs(rest, one, model), overall)
    return model


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, model: Classifier | None, parts: int = 5, held: int = 0, doc_id: str = "doc_id", text: str = "text",
          keep: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; with ``keep`` also the row as the struct ``row``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Classifier | None = shared.value
        known = Remembered(m) if m else None
        for batch in (part for whole in batches for part in slices(whole, 2, RUN * 4)):
            found = np.zeros(batch.num_rows)
            if m:
                found[:] = m.scores(*known.of(batch.column(2).to_pylist()))
            arrays = [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
            names = ["doc_id", "held_out", "score", "predicted"]
            if keep:
                arrays, names = [*arrays, batch.column(3)], [*names, "row"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    narrow = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (remainder(F.col(doc_id), parts) == held).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        *[whole_row(docs)] * keep,
    )
    schema = T.StructType.fromDDL(SCHEMA)
    if keep:
        schema.add("row", narrow.schema["row"].dataType)
    return narrow.mapInArrow(tidy(run), schema)


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not predicted toxic."""
    return score(docs, learn(docs, labels), keep=True).where("predicted = 0").select("row.*")
