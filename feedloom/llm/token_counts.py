"""Exact token counts of whole texts, by overlap resynchronisation for huge ones.

A byte-level tokenizer cuts a text into pieces before it merges bytes. A space after a character that
is no white space always starts a new piece, whatever stands around it: such a boundary is stable.
Short texts are cut at all stable boundaries, and each distinct piece of a batch is encoded once.

A huge text is cut into chunks that overlap. Chunks are rows of their own, dealt out to all tasks;
each is encoded by itself, with offsets. Two neighbours are spliced at the first place of their
overlap that is a stable boundary, at which a token starts in both encodings, and after which both
give the same tokens up to the next such place. Where an overlap holds no such place the alignment has failed, and
the text is cut again with wider overlaps and chunks, in the end into a single chunk.

Defined results: a null text counts as empty, with 0 bytes and 0 tokens; a null id stays null;
repeated rows give repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.tokenizing import BEFORE_SPACE, byte_of, joined, ranked, slices, tokenizer, tokens_with
from feedloom.session import staged

CHUNK = 16_384  # characters of a chunk, without its overlap
OVERLAP = 512  # characters a chunk shares with the next, at first
WIDER = 8  # factor for both where alignment fails
PART = 4 << 20  # bytes of short texts encoded at a time
SPECIAL = "<|"  # Fixed value: how special strings begin; texts that hold it go to the tokenizer as they are.
SPACE = "Ġ"  # Fixed value: the space in the characters of a byte-level vocabulary.
LOOSE_SPACE = r"(^|[\s\p{Z}\x0b\x1c-\x1f\x{85}]) "

CHUNK_SCHEMA = "doc_id long, mark long, n_bytes long, chunk int, start long, last boolean, piece string"
SPLICE_SCHEMA = (
    "doc_id long, mark long, n_bytes long, chunk int, last boolean, n long, "
    "left array<long>, left_n array<long>, right array<long>, right_n array<long>"
)


def pattern() -> str:
    """How byte-level tokenizers cut a text before they merge bytes."""
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache(maxsize=4)
def token_bytes(file: str) -> np.ndarray:
    """Bytes of every token, 0 for special ones."""
    found, known = tokenizer(file).get_vocab(), byte_of()
    out = np.zeros(max(found.values()) + 1, dtype=np.int64)
    for token, i in found.items():
        out[i] = len(token) if all(c in known for c in token) else 0
    return out


def _short(file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = tokens_with(file, lambda t: t.startswith(SPACE))
        fast = ranked(file, pattern())
        for batch in (part for whole in batches for part in slices(whole, 2, PART)):
            texts, n = batch.column(2), np.zeros(batch.num_rows, dtype=np.int64)
            special = pc.match_substring(texts, SPECIAL).to_numpy(zero_copy_only=False)
            # A space behind white space or at the beginning is no boundary; such texts are not cut.
            loose = pc.match_substring_regex(texts, LOOSE_SPACE).to_numpy(zero_copy_only=False) & ~special
            whole_texts = texts.filter(pa.array(special)).to_pylist()
            n[special] = [len(e.ids) for e in tokenizer(file).encode_batch_fast(whole_texts, add_special_tokens=False)]
            n[loose] = [len(fast.encode_ordinary(t)) for t in texts.filter(pa.array(loose)).to_pylist()]
            tight = ~(special | loose)
            n[tight] = _distinct_counts(texts.filter(pa.array(tight)), fast, starts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def _distinct_counts(texts: pa.Array, fast, starts: np.ndarray) -> np.ndarray:
    """Tokens of texts whose every space is a stable boundary."""
    pieces = pc.split_pattern(texts, " ")
    flat, bounds = pieces.flatten(), pieces.offsets.to_numpy()
    if not len(flat):
        return np.zeros(len(texts), dtype=np.int64)
    size = np.zeros(len(flat), dtype=np.int64)
    # The first piece of a text has no space before it; white space may end the last one.
    first, last = bounds[:-1], bounds[1:] - 1
    size[first] = [len(fast.encode_ordinary(p)) for p in flat.take(pa.array(first)).to_pylist()]
    last = last[last > first]
    size[last] = [len(fast.encode_ordinary(" " + p)) for p in flat.take(pa.array(last)).to_pylist()]
    inner = np.ones(len(flat), dtype=bool)
    inner[first] = inner[last] = False
    met = flat.filter(pa.array(inner)).dictionary_encode()
    ids = np.array(fast.encode_ordinary(" " * bool(len(met)) + joined(met.dictionary, " ")), dtype=np.int64)
    begin = np.flatnonzero(starts[ids])
    if len(begin) != len(met.dictionary):
        raise RuntimeError("pieces and their encoding differ in number")
    size[inner] = np.diff(begin, append=len(ids))[met.indices.to_numpy()]
    return np.add.reduceat(size, first)


def _chunks(size: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                starts = range(0, max(1, len(row.text)), size)
                for k, s in enumerate(starts):
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array([row.doc_id], dtype="Int64"), "mark": [row.mark], "n_bytes": [row.n_bytes],
                            "chunk": [k], "start": [s], "last": [k == len(starts) - 1],
                            "piece": [row.text[s : s + size + overlap]],
                        }
                    )

    return run


def encoded(piece: str, file: str) -> tuple[np.ndarray, int]:
    """Where tokens start, as places in the piece, -1 for one that starts within a character; and the
    number of tokens."""
    if SPECIAL in piece:
        code = tokenizer(file).encode(piece, add_special_tokens=False)
        begins = np.array([b for b, _ in code.offsets], dtype=np.int64)
        inside = np.diff(begins, prepend=-1) == 0
        return np.where(inside, -1, begins), len(begins)
    ids = np.array(ranked(file, pattern()).encode_ordinary(piece), dtype=np.int64)
    size = token_bytes(file)[ids]
    # From bytes to characters: a byte that continues a character starts none.
    first = (np.frombuffer(piece.encode(), dtype=np.uint8) & 0xC0) != 0x80
    at = np.cumsum(size) - size
    return np.where(first[at], np.cumsum(first)[at] - 1, -1), len(ids)


def boundaries(piece: str, tokens: np.ndarray, start: int, low: int, high: int) -> tuple[list[int], list[int]]:
    """Stable boundaries of a piece from ``low`` to ``high`` at which a token starts: their places in
    the whole text and the number of tokens before them."""
    at = [m.start() for m in BEFORE_SPACE.finditer(piece, low, high)]
    here = np.flatnonzero((tokens >= low) & (tokens < high))
    number = dict(zip(tokens[here].tolist(), here.tolist(), strict=True))
    known = [p for p in at if p in number]
    return [start + p for p in known], [number[p] for p in known]


def _encode(file: str, size: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                first, n = encoded(row.piece, file)
                left = boundaries(row.piece, first, row.start, 1, overlap) if row.chunk else ([], [])
                # Near the cut end of a chunk nothing is proven; the last character has no follower.
                right = ([], []) if row.last else boundaries(row.piece, first, row.start, size, size + overlap - 1)
                out.append((row.doc_id, row.mark, row.n_bytes, row.chunk, row.last, n, *left, *right))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in SPLICE_SCHEMA.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return run


def spliced(chunks: pd.DataFrame) -> int | None:
    """Tokens of a text from its encoded chunks, or None where two neighbours do not align."""
    total, before = 0, 0
    rows = list(chunks.sort_values("chunk").itertuples(index=False))
    for one, two in zip(rows, rows[1:], strict=False):
        mine, other = dict(zip(one.right, one.right_n, strict=True)), dict(zip(two.left, two.left_n, strict=True))
        common = sorted(set(mine) & set(other))
        # Both must agree on what follows: as many tokens between two common boundaries.
        agreed = next((p for p, q in zip(common, common[1:], strict=False) if mine[q] - mine[p] == other[q] - other[p]), None)
        if agreed is None:
            return None
        total, before = total + mine[agreed] - before, other[agreed]
    return total + rows[-1].n - before


def _splice(key: tuple, chunks: pd.DataFrame) -> pd.DataFrame:
    first = chunks[chunks["chunk"] == 0]
    n = spliced(chunks.drop_duplicates("chunk"))
    out = first[["doc_id", "mark", "n_bytes"]].copy()
    out["doc_id"] = out["doc_id"].astype("Int64")
    out["n_tokens"] = pd.array([n] * len(out), dtype="Int64")
    return out


def count_tokens(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", file: str = "byte_bpe_50k.json",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row, whole texts."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.octet_length(body).cast("long").alias("n_bytes"), body.alias("text")
    )
    huge = F.length("text") > 2 * chunk
    parts = [rows.where(~huge).mapInArrow(_short(file), "doc_id long, n_bytes long, n_tokens long")]
    left = rows.where(huge).withColumn("mark", F.xxhash64("text"))
    failed, size, shared = None, chunk, overlap
    while True:
        # Repeated rows share their key; each gives a row of its own again.
        cut = left.select("doc_id", "mark", "n_bytes", "text").mapInPandas(_chunks(size, shared), CHUNK_SCHEMA)
        coded = cut.repartition("doc_id", "mark", "chunk").mapInPandas(_encode(file, size, shared), SPLICE_SCHEMA)
        done = staged(
            coded.groupBy("doc_id", "mark").applyInPandas(_splice, "doc_id long, mark long, n_bytes long, n_tokens long"),
            "token-counts",
        )
        parts.append(done.where("n_tokens IS NOT NULL").drop("mark"))
        failed = done.where("n_tokens IS NULL").select("doc_id", "mark").distinct()
        if failed.isEmpty():
            break
        same = left["doc_id"].eqNullSafe(failed["doc_id"]) & (left["mark"] == failed["mark"])
        left = left.join(failed, same, "left_semi")
        size, shared = size * WIDER, shared * WIDER
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total
