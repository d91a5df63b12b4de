"""Near-duplicate documents: MinHash bands propose, sequential Bayesian tests prune, full sets decide.

A document's set holds its distinct shingles of ``shingle`` words (a shorter text is one shingle).
Texts with equal sets form a class, numbered within a run; only classes go on, each with one of its texts.

* Signatures of 128 minima are cut into 32 bands of 4. Two sets of similarity 0.8 agree in no band with
  probability below 5e-8.
* A bucket (equal band) is not expanded into pairs. In a few rounds each bucket compares its members with
  one centre, another one each round; what is linked joins one component and need not be compared any
  more. At last, buckets that share members are taken together, and documents outside the largest
  component of such a cluster are compared with all of it in blocks, so that no pair of a bucket is left
  out that could still join two components. No step makes a row for every pair of a group.
* A pair is tested on 32 minima at a time. With a uniform prior, the posterior probability of reaching
  the threshold after ``m`` of ``n`` agreements is a binomial tail; a pair is dropped as soon as that
  is below ``miss``. Survivors are compared on their full sets.

Defined results: null and empty texts have an empty set, are linked with nothing and kept; a row with
a null id is never linked, its component is null and it is kept; rows that repeat an id count as one
document, whose different texts are linked with each other and bring their own links; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import small_batches, split_by, tidy
from feedloom.llm.graphs import components
from feedloom.session import Scratch, staged

BANDS, ROWS, STEP = 32, 4, 32
MINIMA = BANDS * ROWS
ROUNDS = 3  # rounds with one centre per bucket, before the rest is compared in full
ASKING, ASKED = 1 << 18, 1 << 20  # shingles of either side in a block of that rest
_rng = np.random.default_rng(20240229)
FACTORS = _rng.integers(1, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _rng.integers(0, 2**63, MINIMA, dtype=np.uint64)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit over the whole number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, size: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit shingles of a text: A-Z lower-cased, words between ASCII white space."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    of_word = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(size, len(words))
    # Sequences of another length than ``size`` must not meet those of ``size`` words.
    code = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        code = mixed_bits(code * np.uint64(0x9E3779B97F4A7C15) + of_word[k : len(words) - width + 1 + k])
    return np.unique(code)


def signature(found: np.ndarray) -> np.ndarray:
    least = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 1024):
        least = np.minimum(least, (found[at : at + 1024, None] * FACTORS + OFFSETS).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key, sig = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text, size)
                n.append(len(found))
                key.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sig.append(signature(found).tobytes() if len(found) else None)
            made = [pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary())]
            arrays = [batch.column(0), batch.column(2), *made]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "same", "n_shingles", "key", "sig"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, size).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["rep", "members"])

    return run


def least_agreements(threshold: float, miss: float) -> list[tuple[int, int]]:
    """For every number of minima looked at, the fewest agreements with which a pair goes on."""
    out = []
    for n in range(STEP, MINIMA + 1, STEP):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _prune(threshold: float, miss: float):
    limits = least_agreements(threshold, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32).reshape(-1, MINIMA) for c in (2, 3)
            )
            left, agreed = np.arange(len(one)), np.zeros(len(one), dtype=int)
            for n, fewest in limits:
                agreed[left] += (one[left, n - STEP : n] == two[left, n - STEP : n]).sum(axis=1)
                left = left[agreed[left] >= fewest]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(left)) for c in (0, 1)], names=["a", "b"])

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                one, two = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                good.append(100 * both >= percent * (len(one) + len(two) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(good, pa.bool_())) for c in (0, 1)], names=["a", "b"]
            )

    return run


def _with(pairs: DataFrame, facts: DataFrame, column: str) -> DataFrame:
    """Pairs with ``column`` of both sides."""
    one = facts.select(F.col("rep").alias("a"), F.col(column).alias("x"))
    two = facts.select(F.col("rep").alias("b"), F.col(column).alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")


def links_of(pairs: DataFrame, sigs: DataFrame, sets: DataFrame, percent: int, miss: float, label: str) -> DataFrame:
    """Those of the candidate pairs that reach the threshold, written once."""
    likely = _with(pairs, sigs, "sig").mapInArrow(tidy(_prune(percent / 100, miss)), "a long, b long")
    linked = _with(likely, sets, "members").mapInArrow(tidy(_verify(percent)), "a long, b long")
    return staged(linked.distinct(), f"{label}-links")


def similar_sizes(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80,
    miss: float = 1e-6, label: str = "minhash",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row. Documents are linked if their sets share
    ``percent`` of their union; a component is named by its smallest id, and only that one is kept."""
    small_batches(docs.sparkSession)
    whole = F.col(text).cast("binary")
    # An id and the hash of its text name a row's text, also where the id stands for several texts.
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("same"))
    sketched = staged(
        rows.mapInArrow(tidy(_sketch(shingle)), "doc_id long, same long, n_shingles long, key binary, sig binary"),
        f"{label}-sketches",
    )
    known = sketched.where("doc_id IS NOT NULL AND key IS NOT NULL")
    classes = known.groupBy("key").agg(F.min(F.struct("doc_id", "same", "n_shingles", "sig")).alias("r"))
    reps = staged(
        classes.select("key", F.monotonically_increasing_id().alias("rep"), "r.doc_id", "r.same",
                       F.col("r.n_shingles").alias("n"), "r.sig"),
        f"{label}-classes",
    )
    band = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        i, F.col("sig").substr(i * F.lit(4 * ROWS) + 1, F.lit(4 * ROWS))
    ))).alias("band", "bucket")
    placed = reps.select("rep", "n", band).select("rep", "n", "bucket")
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket")
    buckets = staged(placed.join(shared, "bucket"), f"{label}-buckets")

    near = staged(buckets.select("rep").distinct(), f"{label}-near")
    sigs = reps.join(near, "rep", "left_semi").select("rep", "sig")
    shown = reps.join(near, "rep", "left_semi").select("rep", "doc_id", "same")
    shown = staged(shown, f"{label}-shown")
    texts = split_by(rows, shown, ["doc_id", "same"])[0].join(shown, ["doc_id", "same"]).dropDuplicates(["doc_id", "same"]).select("rep", "text")
    sets = staged(texts.mapInArrow(tidy(_sets(shingle)), "rep long, members binary"), f"{label}-sets")

    repeated = _of_one_id(known, reps, label)
    nodes = near if repeated is None else near.union(repeated.select("a")).union(repeated.select("b")).distinct()
    names = nodes.withColumn("component", F.col("rep"))
    if repeated is not None:
        names = _renamed(names, repeated, label)
    for turn in range(ROUNDS):
        open_ = _open_buckets(buckets, names, f"{label}-open")
        pairs = _star_pairs(open_, turn, percent)
        links = links_of(pairs, sigs, sets, percent, miss, label)
        if links.isEmpty() and turn:
            break
        names = _renamed(names, links, label)
    open_ = _open_buckets(buckets, names, f"{label}-open")
    links = rest_links(open_, sigs, sets, percent, miss, label)
    names = _renamed(names, links, label)

    of_class = reps.select("key", "rep", "doc_id")
    least = names.join(of_class, "rep").groupBy("component").agg(F.min("doc_id").alias("least"))
    class_names = of_class.join(names.join(least, "component").select("rep", "least"), "rep", "left").select(
        "key", F.coalesce("least", "doc_id").alias("component")
    )
    found = sketched.drop("sig", "same").join(class_names, "key", "left")
    component = F.coalesce("component", "doc_id")
    alone = F.when(F.col("doc_id").isNotNull(), component).alias("component_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    return found.select("doc_id", "n_shingles", alone, kept)


def _of_one_id(known: DataFrame, reps: DataFrame, label: str) -> DataFrame | None:
    """Classes that hold texts of one id, as links to one class of that id; None where no id has two."""
    ends = known.groupBy("doc_id").agg(F.min("key").alias("x"), F.max("key").alias("y"))
    several = staged(ends.where("x <> y").select("doc_id"), f"{label}-several")
    if several.isEmpty():
        return None
    mine = known.join(several, "doc_id", "left_semi").select("doc_id", "key").distinct()
    held = staged(mine.join(reps.select("key", "rep"), "key").select("doc_id", "rep"), f"{label}-held")
    first = held.groupBy("doc_id").agg(F.min("rep").alias("a"))
    links = held.join(first, "doc_id").where("a <> rep").select("a", F.col("rep").alias("b")).distinct()
    return staged(links, f"{label}-of-one-id")


def _open_buckets(buckets: DataFrame, names: DataFrame, label: str) -> DataFrame:
    """Members of the buckets that hold more than one component, with their component."""
    named = buckets.join(names, "rep")
    mixed = named.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    return staged(named.join(mixed.select("bucket"), "bucket"), label)


def _star_pairs(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """Every bucket's members with its centre. The order of centres is the same in all buckets of a
    turn, so that a group of near copies has few centres and a pair is met once."""
    order = F.struct(F.xxhash64(F.lit(turn), F.col("rep")).alias("o"), F.col("rep").alias("c"), F.col("n").alias("cn"),
                     F.col("component").alias("cc"))
    centres = members.groupBy("bucket").agg(F.min(order).alias("m")).select("bucket", "m.c", "m.cn", "m.cc")
    met = members.join(centres, "bucket").where((F.col("component") != F.col("cc")) & similar_sizes("n", "cn", percent))
    return met.select(F.least("rep", "c").alias("a"), F.greatest("rep", "c").alias("b")).distinct()


def rest_links(members: DataFrame, sigs: DataFrame, sets: DataFrame, percent: int, miss: float, label: str) -> DataFrame:
    """Links that could still join components, without a row per pair.

    Buckets that share members form a cluster. In each, the documents outside its largest component are
    compared with all of it, block by block: a task holds a bounded number of shingles of either side,
    tests signatures and then full sets, and gives a link for each component a document reaches.
    """
    first = members.groupBy("bucket").agg(F.min("rep").alias("b"))
    edges = members.join(first, "bucket").select(F.col("rep").alias("a"), "b")
    cluster = components(edges, f"{label}-clusters").select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    docs = staged(members.select("rep", "n", "component").distinct().join(cluster, "rep"), f"{label}-clustered")
    sizes = docs.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s"))
    whole = sizes.groupBy("cluster").agg(F.max(F.struct("k", "component", "s")).alias("m"), F.sum("s").alias("all"))
    parts = whole.select(
        "cluster",
        F.col("m.component").alias("main"),
        F.ceil((F.col("all") - F.col("m.s")) / ASKING).cast("int").alias("rows"),
        F.ceil(F.col("all") / ASKED).cast("int").alias("columns"),
    ).where("rows > 0")
    placed = docs.join(parts, "cluster").join(sigs, "rep").join(sets, "rep")
    spread = F.xxhash64("rep")
    up_to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    facts = ["cluster", "rep", "component", "sig", "members"]
    asked = placed.select(*facts, F.lit(False).alias("asks"), up_to("rows").alias("row"), F.pmod(spread, "columns").cast("int").alias("column"))
    asking = placed.where("component <> main").select(
        *facts, F.lit(True).alias("asks"), F.pmod(spread, "rows").cast("int").alias("row"), up_to("columns").alias("column")
    )
    blocks = asked.unionByName(asking).groupBy("cluster", "row", "column")
    return staged(blocks.applyInPandas(_compare(percent, miss), "a long, b long").distinct(), f"{label}-links")


def _compare(percent: int, miss: float):
    limits = least_agreements(percent / 100, miss)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        asks = rows[rows["asks"]]
        other = rows[~rows["asks"]].sort_values("rep")
        found = []
        if len(asks) and len(other):
            sig = np.frombuffer(b"".join(other["sig"]), dtype=np.uint32).reshape(-1, MINIMA)
            sets = [np.frombuffer(x, dtype=np.uint64) for x in other["members"]]
            n = np.array([len(x) for x in sets])
            # Shingles by number, so that membership in one set is a lookup in an array.
            names, number = np.unique(np.concatenate(sets), return_inverse=True)
            begin = np.concatenate([[0], np.cumsum(n)[:-1]])
            part, reps = other["component"].to_numpy(), other["rep"].to_numpy()
            mark = np.zeros(len(names) + 1, dtype=bool)
            for rep, component, mine, own in zip(asks["rep"], asks["component"], asks["sig"], asks["members"], strict=True):
                mine, own = np.frombuffer(mine, dtype=np.uint32), np.frombuffer(own, dtype=np.uint64)
                left = np.flatnonzero(
                    (part != component) & (100 * np.minimum(n, len(own)) >= percent * np.maximum(n, len(own)))
                )
                agreed = np.zeros(len(left), dtype=int)
                for upto, fewest in limits:
                    agreed += (sig[left, upto - STEP : upto] == mine[upto - STEP : upto]).sum(axis=1)
                    left, agreed = left[agreed >= fewest], agreed[agreed >= fewest]
                if not len(left):
                    continue
                at = np.searchsorted(names, own)
                known = at[(at < len(names)) & (names[np.minimum(at, len(names) - 1)] == own)]
                mark[known] = True
                both = np.array([np.count_nonzero(mark[number[begin[j] : begin[j] + n[j]]]) for j in left])
                mark[known] = False
                linked = left[100 * both >= percent * (n[left] + len(own) - both)]
                _, one_each = np.unique(part[linked], return_index=True)
                found.extend((min(rep, reps[j]), max(rep, reps[j])) for j in linked[one_each])
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _renamed(names: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """Components after more links were found."""
    ends = names.select("rep", "component")
    one = links.join(ends.select(F.col("rep").alias("a"), F.col("component").alias("x")), "a")
    two = one.join(ends.select(F.col("rep").alias("b"), F.col("component").alias("y")), "b")
    edges = two.select(F.col("x").alias("a"), F.col("y").alias("b"))
    merged = components(edges, label).select(F.col("node").alias("component"), F.col("component").alias("new"))
    joined = names.join(merged, "component", "left").select("rep", F.coalesce("new", "component").alias("component"))
    return staged(joined, f"{label}-names")


def deduplicated(docs: DataFrame, label: str = "dedup", **options) -> DataFrame:
    """Rows of ``docs`` with one document of each component; of rows that repeat an id, one stays."""
    scratch = Scratch(docs.sparkSession, label)
    inside = f"{scratch.path.rsplit('/', 1)[-1]}/{label}"
    found = staged(near_duplicates(docs, label=inside, **options), f"{label}-found")
    scratch.remove()
    gone = found.where(~F.col("kept")).select("doc_id")
    doubtful, sure = split_by(docs, gone, ["doc_id"])
    left = sure.unionByName(doubtful.join(gone, "doc_id", "left_anti"))
    named = found.where(F.col("kept") & F.col("doc_id").isNotNull())
    repeated = staged(named.groupBy("doc_id").count().where("count > 1").select("doc_id"), f"{label}-repeated")
    if repeated.isEmpty():
        return left
    once = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(repeated, "doc_id", "left_anti").unionByName(once)
