"""Language identification by prediction by partial matching over bytes.

Per language a variable-order context tree is counted from labelled texts: how often each byte
followed each context of up to ``order`` bytes. A byte is coded in the longest known context; if it
was never seen there, the context's escape probability is paid and the next shorter context is asked,
down to a uniform code (escape method C: ``distinct / (total + distinct)``). Statistics are frozen
after fitting, so the code length of a text is a sum over its byte windows, and all lengths of windows
seen in training are worked out beforehand. The language with the shortest code wins.

Fitting takes a bounded sample of whole labelled texts: about ``train_bytes`` bytes per language, and at
least one text, chosen by a hash of id and text; of more than ``most_langs`` languages those with most
bytes are learned. Scoring reads every byte of every text.

Defined results: a null text, or one without a letter, is ``und`` with score 0; without any labelled
text every row is ``und``; equal code lengths go to the language that sorts first; a null id counts as
the empty text when rows are held out; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import small_batches, tidy, whole_row
from feedloom.llm.tokenizing import slices

UNKNOWN = "und"
WINDOW = 1 << 19  # bytes scored at a time; bounds the memory of a task


def remainder(doc_id: Column, parts: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def windows(data: np.ndarray, order: int) -> np.ndarray:
    """For every byte from position ``order`` on, the byte and the ``order`` before it as one number."""
    keys = np.zeros(len(data) - order, dtype=np.uint64)
    for k in range(order + 1):
        keys = (keys << np.uint64(8)) | data[k : len(data) - order + k].astype(np.uint64)
    return keys


class Lookup:
    """Positions of 64-bit keys, found in whole arrays: a table of slots over the sorted keys."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(2 * max(1, len(keys)) - 1).bit_length())
        slots = self._slots(keys)
        self.order = np.argsort(slots, kind="stable").astype(np.int32)
        self.keys = np.append(keys[self.order], np.uint64(0))
        self.start = np.searchsorted(slots[self.order], np.arange((1 << self.bits) + 1)).astype(np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index into the original keys, -1 where a key is not there."""
        slots = self._slots(keys)
        at, end = self.start[slots], self.start[slots + np.uint64(1)]
        hit = (at < end) & (self.keys[at] == keys)
        found = np.where(hit, at, -1)
        open_ = np.flatnonzero(~hit & (at + 1 < end))
        at = at[open_]
        while len(open_):
            at = at + 1
            hit = self.keys[at] == keys[open_]
            found[open_[hit]] = at[hit]
            more = ~hit & (at + 1 < end[open_])
            open_, at = open_[more], at[more]
        known = found >= 0
        found[known] = self.order[found[known]]
        return found


@dataclass
class Model:
    """Frozen statistics. ``costs[k]``: bits per language of the windows of ``k + 1`` bytes that any
    language has seen; ``escapes[k]``: bits to leave a context of ``k`` bytes."""

    langs: list[str]
    order: int
    windows: list[Lookup]
    costs: list[np.ndarray]
    contexts: list[Lookup]
    escapes: list[np.ndarray]

    @classmethod
    def build(cls, langs: list[str], order: int, counts: dict[int, tuple]) -> Model:
        """``counts[k]``: arrays of language number, window of ``k + 1`` bytes, and count."""
        m = cls(langs, order, [], [], [], [])
        for k in range(order + 1):
            lang, window, count = counts[k]
            keys = np.unique(window)
            contexts = np.unique(keys >> np.uint64(8))
            seen = np.zeros((len(keys), len(langs)))
            seen[np.searchsorted(keys, window), lang] = count
            of = np.searchsorted(contexts, keys >> np.uint64(8))
            total, distinct = np.zeros((len(contexts), len(langs))), np.zeros((len(contexts), len(langs)))
            np.add.at(total, of, seen)
            np.add.at(distinct, of, seen > 0)
            room = np.where(total > 0, total + distinct, 1)
            escape = np.where(total > 0, -np.log2(np.where(total > 0, distinct, 1) / room), 0.0)
            shorter = m._bits(keys & np.uint64((1 << 8 * k) - 1), k - 1)
            cost = np.where(seen > 0, -np.log2(np.where(seen > 0, seen, 1) / room[of]), escape[of] + shorter)
            m.windows.append(Lookup(keys))
            m.costs.append(cost.astype(np.float32))
            m.contexts.append(Lookup(contexts))
            m.escapes.append(escape.astype(np.float32))
        return m

    def _bits(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Bits of the last byte of every window of ``k + 1`` bytes, per language."""
        if k < 0:
            return np.full((len(keys), len(self.langs)), 8.0, dtype=np.float32)
        at = self.windows[k].find(keys)
        out = self.costs[k][at]
        new = np.flatnonzero(at < 0)
        if len(new):
            left = keys[new]
            context = self.contexts[k].find(left >> np.uint64(8))
            escape = np.where((context >= 0)[:, None], self.escapes[k][context], np.float32(0))
            out[new] = escape + self._bits(left & np.uint64((1 << 8 * k) - 1), k - 1)
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of every text under every language."""
        out = np.zeros((len(texts), len(self.langs)))
        led = b"\n" * self.order
        part: list[tuple[int, bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            # A long text goes window by window; each window carries the bytes before it.
            whole = led + text
            for start in range(0, len(text), WINDOW):
                piece = whole[start : start + self.order + WINDOW]
                part.append((i, piece))
                size += len(piece)
                if size >= WINDOW:
                    self._add(part, out)
                    part, size = [], 0
        if part:
            self._add(part, out)
        return out

    def _add(self, part: list[tuple[int, bytes]], out: np.ndarray) -> None:
        data = np.frombuffer(b"".join(p for _, p in part), dtype=np.uint8)
        ends = np.cumsum([len(p) for _, p in part])
        bits = self._bits(windows(data, self.order), self.order)
        # Windows that reach over the border of two pieces belong to neither.
        starts = np.concatenate([[0], ends[:-1]])
        edges = np.stack([starts, ends - self.order], axis=1).ravel()
        sums = np.add.reduceat(bits, edges[:-1], axis=0, dtype=np.float64)
        np.add.at(out, [i for i, _ in part], sums[::2])


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "k", "window", "n"]
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            # A long text goes window by window; each window carries the bytes before it.
            for lang, whole, start in ((g, b"\n" * order + t, at) for g, t in rows for at in range(0, len(t), WINDOW)):
                data = np.frombuffer(whole[start : start + order + WINDOW], dtype=np.uint8)
                for k in range(order + 1):
                    keys, n = np.unique(windows(data[order - k :], k), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(keys)), pa.array(np.full(len(keys), k, dtype=np.int32)),
                            pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64)),
                        ],
                        names=names,
                    )

    return run


def fit(
    rows: DataFrame, lang: str, text: str, doc_id: str,
    order: int = 3, train_bytes: int = 400_000, most_langs: int = 1000,
) -> Model | None:
    """Model of the labelled ``rows``. The sample holds about ``train_bytes`` bytes per language."""
    small_batches(rows.sparkSession)
    draw = F.pmod(F.xxhash64(F.lit("language sample"), F.col(doc_id), F.col(text)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    usable = rows.where(F.col(lang).isNotNull() & (F.octet_length(text) > 0)).select(
        F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text"), draw.alias("draw")
    )
    sums = usable.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n"), F.min("draw").alias("least"))
    known = {r["lang"]: r for r in sums.orderBy(F.col("n").desc(), "lang").limit(most_langs).collect()}
    if not known:
        return None
    langs = sorted(known)
    share = F.create_map(*[F.lit(x) for g in langs for x in (g, max(known[g]["least"], min(1.0, train_bytes / known[g]["n"])))])
    # Rows that repeat id and text draw alike and count once.
    sample = usable.where(F.col("draw") <= share[F.col("lang")]).dropDuplicates(["lang", "draw"])
    counted = sample.select("lang", "text").mapInArrow(tidy(_count(order)), "lang string, k int, window long, n long")
    table = counted.groupBy("lang", "k", "window").agg(F.sum("n").alias("n")).toArrow()
    number = {g: i for i, g in enumerate(langs)}
    lang_no = np.array([number[g] for g in table["lang"].to_pylist()], dtype=np.int64)
    k = table["k"].to_numpy()
    window, n = table["window"].to_numpy().astype(np.uint64), table["n"].to_numpy()
    return Model.build(langs, order, {j: (lang_no[k == j], window[k == j], n[k == j]) for j in range(order + 1)})


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double"


def identify(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text", parts: int = 4, held: int = 2,
             keep: bool = False) -> DataFrame:
    """Language of every row. ``score`` is the probability of the best language if all are equally
    likely beforehand; ``bits_per_byte`` its code length per byte. ``keep`` adds the row as ``row``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model | None = shared.value
        for batch in (part for whole in batches for part in slices(whole, 2, 4 * WINDOW)):
            texts = batch.column(2).to_pylist()
            lettered = np.array(batch.column(3).to_pylist(), dtype=bool)
            scored = np.flatnonzero(lettered) if m else np.array([], dtype=int)
            best: list[str] = [UNKNOWN] * len(texts)
            score, per_byte = np.zeros(len(texts)), [None] * len(texts)
            if len(scored):
                bits = m.lengths([texts[i] for i in scored])
                first = bits.argmin(axis=1)
                over = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0)
                score[scored] = 1.0 / np.exp2(-over).sum(axis=1)
                for i, g, b in zip(scored, first, bits.min(axis=1), strict=True):
                    best[i], per_byte[i] = m.langs[g], float(b) / len(texts[i])
            arrays = [batch.column(0), batch.column(1), pa.array(best, pa.string()), pa.array(score), pa.array(per_byte, pa.float64())]
            names = ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"]
            if keep:
                arrays, names = [*arrays, batch.column(4)], [*names, "row"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    narrow = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (remainder(F.col(doc_id), parts) == held).alias("held_out"),
        F.when(letter, F.col(text).cast("binary")).alias("text"),
        letter.alias("lettered"),
        *[whole_row(docs)] * keep,
    )
    schema = T.StructType.fromDDL(SCHEMA)
    if keep:
        schema.add("row", narrow.schema["row"].dataType)
    return narrow.mapInArrow(tidy(run), schema)


def learn(docs: DataFrame, parts: int = 4, held: int = 2, **options) -> Model | None:
    """Model from the labelled rows that are not held out."""
    rows = docs.where(remainder(F.col("doc_id"), parts) != held)
    return fit(rows, "lang", "text", "doc_id", **options)


def kept(docs: DataFrame, most_bits: float = 8.0) -> DataFrame:
    """Rows of ``docs`` in some learned language: with a letter, and coded in at most ``most_bits``
    bits per byte, which is what a byte costs without any model."""
    found = identify(docs, learn(docs), keep=True)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("bits_per_byte") <= most_bits)).select("row.*")
