"""Ranked lexical search over a document FP-tree, with branch and bound per item.

A document is reduced to the terms that items ask for, each with the times it occurs (``tf``) and with the
document's length measure ``m``. Terms are numbered by falling document frequency, and a document's
numbers in rising order are its path: documents that begin with the same frequent terms share the
beginning of their paths. Paths are range-sorted, so that a task holds neighbours, and cut into blocks
of bounded size. A block becomes a trie whose single-child chains are one node and whose lowest nodes hold
a few documents. Every node knows the largest ``tf`` of each term below it and the smallest ``m``.

A document's score rises with ``tf`` and falls with ``m``, so the score of a node's maxima is never below
that of a document under it. For each item the trie is walked depth first, the most promising child
first; a subtree whose bound is below the item's ``k``-th best score so far is left out. Scores found in
earlier blocks of a task stay in force. Each task gives its ``k`` best documents per item, and these are
ranked. All scores are whole numbers and exact.

Items are dealt into chunks of at most ``ENTRIES`` terms (or one larger item), and documents are reduced
once per chunk; so what a task is given with its code, and what the driver holds, does not grow.

Defined results: a null or empty text has no terms; a null document id counts in the statistics but is
never returned; rows that repeat a document id are documents of their own; items of a null id take no
part; rows that repeat an item id are one item of all their terms; an item without terms, or whose terms
no document holds, has no rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import block_starts, ordered_blocks, small_batches, within_block
from feedloom.session import staged

ENTRIES = 200_000  # terms of the items searched for at a time
BLOCK = 1_000_000  # path entries of a trie
LEAF = 32  # documents of a lowest node
HEAD = 8  # terms of a path that decide its range
SLICE = 1 << 20  # bytes of a text cut into terms at a time

#: Fixed values of the score.
UNIT, TF_PART, M_PART, M_LEAST, M_SHARE = 1_000_000_000, 1000, 8, 10, 90
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same over UTF-8: every byte of a character beyond ASCII is above 0x7F.
TERM_BYTES, GAP_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xFF]+"), re.compile(rb"[^0-9A-Za-z\x80-\xFF]")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, a slice of it at a time."""
    low, at = text.lower(), 0
    while at < len(low):
        gap = GAP_BYTES.search(low, min(at + SLICE, len(low)))
        end = gap.start() if gap else len(low)
        yield TERM_BYTES.findall(low, at, end)
        at = end + 1


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32), pa.int32()))


def _restrict(vocabulary: dict[bytes, int]):
    """Number of terms of every document, and those of the vocabulary with how often they occur."""
    find = vocabulary.get

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, terms, times = [], [], []
            for text in batch.column(1).to_pylist():
                n, parts = 0, [np.zeros(0, dtype=np.int64)]
                for words in terms_of(text or b""):
                    n += len(words)
                    parts.append(np.array([c for c in map(find, words) if c is not None], dtype=np.int64))
                term, tf = np.unique(np.concatenate(parts), return_counts=True)
                total.append(n)
                terms.append(term)
                times.append(tf)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), _lists(terms), _lists(times)], names=["doc_id", "n", "terms", "tf"]
            )

    return run


def _paths(number: np.ndarray, docs: int, length: int):
    """Terms by their number, frequent ones first, and the length measure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            m = 100 - M_SHARE + (M_SHARE * n * docs) // length
            path, times = [], []
            for term, tf in zip(batch.column(2), batch.column(3), strict=True):
                mine = number[term.values.to_numpy()]
                order = np.argsort(mine)
                order = order[mine[order] >= 0]
                path.append(mine[order])
                times.append(tf.values.to_numpy()[order])
            arrays = [batch.column(0), pa.array(m, pa.int64()), _lists(path), _lists(times)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "m", "path", "tf"])

    return run


class Rows:
    """Sparse rows (documents, or nodes with their maxima) that can be scored for an item."""

    def __init__(self, ends: np.ndarray, terms: np.ndarray, tf: np.ndarray, m: np.ndarray):
        self.ends, self.terms, self.tf, self.m = ends, terms, tf, m

    def scores(self, low: int, high: int, weights: np.ndarray) -> np.ndarray:
        """Scores of the rows from ``low`` to ``high``; ``weights`` has a place for every term."""
        first, last = self.ends[low], self.ends[high]
        weight = weights[self.terms[first:last]]
        hit = np.flatnonzero(weight)
        out = np.zeros(high - low, dtype=np.int64)
        if len(hit):
            row = np.searchsorted(self.ends[low : high + 1], hit + first, side="right") - 1
            tf = self.tf[first + hit]
            np.add.at(out, row, weight[hit] * ((UNIT * tf) // (TF_PART * tf + M_PART * self.m[low + row])))
        return out


class Trie:
    """Documents sorted by path as a trie. Nodes are numbered level by level, children in a row."""

    def __init__(self, docs: Rows, terms: int):
        self.docs = docs
        n = len(docs.m)
        common = self._common(docs)
        # Every node's range of documents and range of children; levels are ranges of nodes.
        self.first, self.last, self.down, self.up = [0], [n], [], []
        parent, levels = [-1], [0, 1]
        while levels[-1] > levels[-2]:
            for x in range(levels[-2], levels[-1]):
                lo, hi = self.first[x], self.last[x]
                parts = self._split(common, lo, hi) if hi - lo > LEAF else []
                self.down.append(len(self.first))
                self.up.append(len(self.first) + len(parts))
                self.first.extend(a for a, _ in parts)
                self.last.extend(b for _, b in parts)
                parent.extend([x] * len(parts))
            levels.append(len(self.first))
        self.nodes = self._maxima(docs, np.array(parent), levels[:-1], terms)

    @staticmethod
    def _common(docs: Rows) -> np.ndarray:
        """Length of the beginning that a path shares with the one before it."""
        out = np.zeros(len(docs.m), dtype=np.int64)
        ends, terms = docs.ends, docs.terms
        for i in range(1, len(out)):
            one, two = terms[ends[i - 1] : ends[i]], terms[ends[i] : ends[i + 1]]
            width = min(len(one), len(two))
            differs = one[:width] != two[:width]
            place = int(differs.argmax()) if width else 0
            out[i] = place if width and differs[place] else width
        return out

    @staticmethod
    def _split(common: np.ndarray, lo: int, hi: int) -> list[tuple[int, int]]:
        """Where the paths of a node part; neighbours of few documents stay together."""
        inner = common[lo + 1 : hi]
        cuts = [*(lo + 1 + np.flatnonzero(inner == inner.min())).tolist(), hi]
        out, begin, end = [], lo, lo
        for cut in cuts:
            if end > begin and cut - begin > LEAF:
                out.append((begin, end))
                begin = end
            end = cut
        return [*out, (begin, end)]

    def _maxima(self, docs: Rows, parent: np.ndarray, levels: list[int], terms: int) -> Rows:
        first, last = np.array(self.first), np.array(self.last)
        leaf = np.array(self.down) == np.array(self.up)
        m = np.full(len(first), np.iinfo(np.int64).max)
        below = (np.zeros(0, dtype=np.int64),) * 3
        found = []
        for lo, hi in reversed(list(zip(levels, levels[1:], strict=False))):
            parts = [below]
            for x in lo + np.flatnonzero(leaf[lo:hi]):
                a, b = docs.ends[first[x]], docs.ends[last[x]]
                parts.append((np.full(b - a, x), docs.terms[a:b], docs.tf[a:b]))
                m[x] = docs.m[first[x] : last[x]].min(initial=np.iinfo(np.int64).max)
            node, term, tf = (np.concatenate(c) for c in zip(*parts, strict=True))
            key = node * terms + term
            order = np.argsort(key, kind="stable")
            key = key[order]
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=int)
            tf = np.maximum.reduceat(tf[order], start) if len(key) else tf
            node, term = key[start] // terms, key[start] % terms
            found.append((node, term, tf))
            if lo:
                np.minimum.at(m, parent[lo:hi], m[lo:hi])
                below = (parent[node], term, tf)
        node, term, tf = (np.concatenate(c) for c in zip(*reversed(found), strict=True))
        ends = np.searchsorted(node, np.arange(len(first) + 1))
        return Rows(ends, term, tf, m)

    def best(self, weights: np.ndarray, ids: np.ndarray, k: int, scores: np.ndarray, found: np.ndarray):
        """The ``k`` best scores and their documents, from those known (``scores``, ``found``) and this trie."""
        floor = scores[k - 1] if len(scores) == k else 1
        stack = [(int(self.nodes.scores(0, 1, weights)[0]), 0)]
        while stack:
            bound, x = stack.pop()
            if bound < floor:
                continue
            down, up = self.down[x], self.up[x]
            if down < up:
                bounds = self.nodes.scores(down, up, weights)
                alive = np.flatnonzero(bounds >= floor)
                alive = alive[np.argsort(bounds[alive], kind="stable")]
                stack.extend(zip(bounds[alive].tolist(), (down + alive).tolist(), strict=True))
                continue
            lo, hi = self.first[x], self.last[x]
            mine = self.docs.scores(lo, hi, weights)
            good = np.flatnonzero(mine >= floor)
            if len(good):
                scores, found = np.concatenate([scores, mine[good]]), np.concatenate([found, ids[lo + good]])
                order = np.lexsort((found, -scores))[:k]
                scores, found = scores[order], found[order]
                floor = scores[k - 1] if len(scores) == k else 1
        return scores, found


def _search(items: list[tuple[int, np.ndarray]], weight: np.ndarray, k: int):
    """The ``k`` best documents of a task for every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.int64)
        best = [(none, none)] * len(items)
        mask = np.zeros(len(weight), dtype=np.int64)
        for ids, docs in _blocks(batches):
            trie = Trie(docs, len(weight))
            for i, (_, terms) in enumerate(items):
                mask[terms] = weight[terms]
                best[i] = trie.best(mask, ids, k, *best[i])
                mask[terms] = 0
        names = np.repeat(np.array([i for i, _ in items], dtype=np.int64), [len(s) for s, _ in best])
        columns = [names, *(np.concatenate([none, *c]) for c in zip(*best, strict=True))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "score", "doc_id"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Rows]]:
    """Neighbouring documents, about ``BLOCK`` path entries at a time."""
    held: list[pa.RecordBatch] = []
    size = 0

    def block() -> tuple[np.ndarray, Rows]:
        whole = pa.Table.from_batches(held).combine_chunks()
        ids, m, path, tf = (whole.column(c).chunk(0) for c in range(4))
        ends = path.offsets.to_numpy().astype(np.int64)
        flat = [c.values.to_numpy()[ends[0] : ends[-1]].astype(np.int64) for c in (path, tf)]
        return ids.to_numpy(), Rows(ends - ends[0], *flat, m.to_numpy())

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += len(batch.column(2).flatten())
        if size >= BLOCK:
            yield block()
            held, size = [], 0
    if held:
        yield block()


def item_terms(items: DataFrame, item_id: str, text: str, label: str) -> DataFrame:
    """``item_id, terms, chunk``: the distinct terms of every item, and its chunk."""
    low = F.translate(F.col(text), UPPER, LOWER)
    rows = items.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("long").alias("item_id"), F.explode(F.regexp_extract_all(low, F.lit(TERM), F.lit(0))).alias("term")
    )
    asked = rows.groupBy("item_id").agg(F.array_sort(F.collect_set("term")).alias("terms")).withColumn("size", F.size("terms"))
    blocks = ordered_blocks(asked, ["item_id"], f"{label}-items")
    place = F.col("_start") + F.coalesce(F.sum("size").over(within_block([], ["item_id"])), F.lit(0))
    placed = blocks.join(block_starts(blocks, [], "size").select("_block", "_start"), "_block")
    return staged(placed.select("item_id", "terms", F.floor(place / ENTRIES).alias("chunk")), f"{label}-chunks")


def _search_chunk(asked: list[tuple[int, list[str]]], rows: DataFrame, k: int, label: str) -> DataFrame | None:
    spark = rows.sparkSession
    vocabulary = {t.encode(): i for i, t in enumerate(sorted({t for _, terms in asked for t in terms}))}
    vectors = staged(
        rows.mapInArrow(_restrict(vocabulary), "doc_id long, n long, terms array<int>, tf array<int>"), f"{label}-vectors"
    )
    facts = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("length")).first()
    if not facts["docs"]:
        return None
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    term, df = held["term"].to_numpy(), held["df"].to_numpy()
    order = np.lexsort((term, -df))
    number = np.full(len(vocabulary), -1, dtype=np.int64)
    weight = np.zeros(len(order) + 1, dtype=np.int64)
    for place, i in enumerate(order):
        weight[place] = math.floor(1000 * math.log((2 * facts["docs"] + 2) / (2 * int(df[i]) + 1)))
        # A term that weighs nothing decides nothing.
        number[term[i]] = place if weight[place] > 0 else -1
    wanted = []
    for item, terms in asked:
        mine = number[[vocabulary[t.encode()] for t in terms]]
        if (mine >= 0).any():
            wanted.append((item, mine[mine >= 0]))
    if not wanted:
        return None
    schema = "doc_id long, m long, path array<int>, tf array<int>"
    paths = vectors.where("doc_id IS NOT NULL").mapInArrow(_paths(number, facts["docs"], facts["length"]), schema)
    near = paths.where(F.size("path") > 0).repartitionByRange(F.slice("path", 1, HEAD), "doc_id")
    found = near.sortWithinPartitions("path", "doc_id").mapInArrow(
        _search(wanted, weight, k), "item_id long, score long, doc_id long"
    )
    best = W.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long").union(
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
    )


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", k: int = 10, label: str = "fp-tree",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for every item the ``k`` documents of highest score above 0."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    asked = item_terms(items, item_id, item_text, label)
    chunks = asked.agg(F.max("chunk")).first()[0]
    found = []
    for chunk in range(0 if chunks is None else chunks + 1):
        # At most ENTRIES terms and one item more.
        mine = asked.where(F.col("chunk") == chunk).select("item_id", "terms").collect()
        found.append(_search_chunk([(r["item_id"], r["terms"]) for r in mine], rows, k, label))
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, [x for x in found if x is not None], empty)
