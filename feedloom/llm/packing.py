"""Packing documents into sequences along a space-filling curve.

Every document gets a vector: the mean of fixed pseudo-random directions of its token ids, in a few
dimensions. With the corpus mean and deviation of each dimension, vectors are laid on a grid, and the
cell's number along a Hilbert curve is the document's key, so that documents near each other on the
curve use similar tokens. Documents are range-sorted by key and laid end to end; cutting this line
every ``length`` tokens gives the sequences, of which only the last can be short.

Ids are encoded once and written, packed by zstd; a run of equal rows, as a mix leaves them, is written as
one row with the number of its copies. Sorting moves only keys and lengths; the place of each document on
the line comes from the totals of the range blocks before it. A hash of the id is the low part of the
key, so equal documents share no single block.

Defined results: a null or empty text is the closing id alone; a null id stays null; repeated rows are
packed each by itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import block_starts, ordered_blocks, small_batches, tidy, within_block
from feedloom.llm.tokenizing import joined, memory, ranked, runs, slices, tokens_with
from feedloom.session import staged

DIMENSIONS, BITS = 4, 9  # of the grid; the key has 36 bits, and 27 more of a hash of the id
TIE_BITS = 27
PART = 1 << 20  # bytes of text encoded at a time
ZSTD = pa.Codec("zstd", compression_level=3)
WORD_END = "</w>"  # Fixed value: how the vocabulary marks the end of a word.
#: Letters that lower-casing and composing leave alone or change one by one, and marks that are words of
#: their own behind a letter.
WORD, MARK = "[A-Za-zÀ-ÖØ-öø-ÿ]+", "[.,]"
WORD_OR_MARK = r"\p{L}+_|[.,]_"


def directions(ids: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A fixed direction for every token id."""
    return np.random.default_rng(7).standard_normal((ids, dimensions)).astype(np.float32)


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Number along the Hilbert curve of every row of grid coordinates below ``2 ** bits``.

    Coordinates are turned into the transposed index bit by bit from the top: a set bit inverts the
    lower bits of the first coordinate, an unset one exchanges them; a Gray decoding ends it.
    """
    x = cells.astype(np.uint64).T.copy()
    n, one = len(x), np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        low = q - one
        for i in range(n):
            is_set = (x[i] & q) != 0
            swap = np.where(is_set, 0, (x[0] ^ x[i]) & low).astype(np.uint64)
            x[0] ^= np.where(is_set, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        turn ^= np.where((x[n - 1] & q) != 0, q - one, np.uint64(0))
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key


def distinct_encoder(file: str):
    """Ids of distinct pieces, one after the other, and how many each has.

    Words of letters, with or without a mark behind, are most of them and are encoded as one text in lower
    case; what is left goes piece by piece and is remembered where it is met again.
    """
    fast = ranked(file, WORD_OR_MARK, WORD_END)
    ends, remembered = tokens_with(file, lambda t: t.endswith(WORD_END)), memory(file)

    def encode(pieces: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.match_substring_regex(pieces, f"^{WORD}{MARK}?$").to_numpy(zero_copy_only=False)
        words = pieces.filter(pa.array(plain))
        marked = pc.match_substring_regex(words, f"{MARK}$").to_numpy(zero_copy_only=False)
        text = pc.utf8_lower(pc.replace_substring_regex(words, f"({MARK})$", r"_\1"))
        flat, n = runs(fast.encode_ordinary(joined(text, "_") + "_" * bool(len(text))), ends, 1 + marked)
        rest = remembered.of(pieces.filter(pa.array(~plain)).to_pylist(), counts[~plain].tolist())
        size = np.zeros(len(pieces), dtype=np.int64)
        size[plain], size[~plain] = n, [len(x) // 4 for x in rest]
        pool, own = np.empty(size.sum(), dtype="<u4"), np.repeat(plain, size)
        pool[own], pool[~own] = flat, np.frombuffer(b"".join(rest), dtype="<u4")
        return pool, size

    return encode


def packed(ids: np.ndarray) -> bytes:
    """Ids as they are written and shuffled: 16 bits each, then zstd, which leaves two thirds."""
    return ZSTD.compress(ids.astype("<u2"), asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ZSTD.decompress(data, 2 * n), dtype="<u2").astype("<u4")


def neighbours(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    """The first row of each run of equal ids and texts, and how many rows the run has."""
    new = np.ones(batch.num_rows, dtype=bool)
    if batch.num_rows > 1:
        one, two = batch.slice(0, batch.num_rows - 1), batch.slice(1)
        both = [
            pc.or_(pc.fill_null(pc.equal(x, y), False), pc.and_(pc.is_null(x), pc.is_null(y)))
            for x, y in ((one.column(c), two.column(c)) for c in (0, 1))
        ]
        new[1:] = ~pc.and_(*both).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(new)
    return batch.filter(pa.array(new)), np.diff(first, append=batch.num_rows)


def _encode(file: str, ids: int, closing: int):
    axes = [f"v{i}" for i in range(DIMENSIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, way = distinct_encoder(file), directions(ids)
        for batch, copies in (neighbours(part) for whole in batches for part in slices(whole, 1, PART)):
            # A space is never part of a token of this vocabulary, so pieces between spaces are independent.
            spaced = pc.replace_substring(pc.fill_null(batch.column(1), ""), "\n", " ")
            pieces = pc.split_pattern(spaced, " ")
            distinct = pieces.flatten().dictionary_encode()
            code, bounds = distinct.indices.to_numpy(), pieces.offsets.to_numpy()
            pool, size = encode(distinct.dictionary, np.bincount(code, minlength=len(distinct.dictionary)))
            first = np.cumsum(size) - size
            # Ids of all pieces in order, then the closing id after those of every text.
            each = size[code]
            upto = np.concatenate([[0], np.cumsum(each)])
            n = upto[bounds[1:]] - upto[bounds[:-1]] + 1
            flat = np.full(n.sum(), closing, dtype="<u4")
            starts = np.cumsum(n) - n
            own = np.ones(len(flat), dtype=bool)
            own[starts + n - 1] = False
            flat[own] = pool[np.arange(upto[-1]) + np.repeat(first[code] - upto[:-1], each)]
            means = [np.add.reduceat(way[flat, i], starts, dtype=np.float64) / n for i in range(DIMENSIONS)]
            out = [packed(flat[s : s + k]) for s, k in zip(starts, n, strict=True)]
            arrays = [batch.column(0), batch.column(2), pa.array(copies, pa.int64()), pa.array(n), pa.array(out, pa.binary())]
            arrays += [pa.array(m, pa.float64()) for m in means]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "first", "copies", "n", "ids", *axes])

    return run


def _keys(mean: list[float], deviation: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.stack([batch.column(4 + i).to_numpy() for i in range(DIMENSIONS)], axis=1)
            z = np.clip((v - mean) / deviation, -4, 4)
            # A smooth step that gives the middle of the corpus most of the cells.
            cells = np.floor((1 / (1 + np.exp(-1.7 * z))) * ((1 << BITS) - 1)).astype(np.uint64)
            key = hilbert_key(cells, BITS).astype(np.int64) << TIE_BITS
            key = pa.array(key | batch.column(3).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], key], names=["first", "row", "n", "key"])

    return run


def _pieces(length: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, n, ids, at in zip(*[batch.column(c).to_pylist() for c in range(4)], strict=True):
                code, begin = unpacked(ids, n), 0
                while begin < n:
                    sequence, offset = divmod(at + begin, length)
                    size = min(n - begin, length - offset)
                    part = code[begin : begin + size]
                    out.append((doc_id, begin, size, zlib.crc32(part.tobytes()), n, sequence, offset, part.tobytes()))
                    begin += size
            columns = list(zip(*out, strict=True)) if out else [()] * 8
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", file: str = "word_bpe_49k.json", ids: int = 49_408,
    closing: int = 2, length: int = 4096, label: str = "packing",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and the
    ids themselves, little-endian unsigned 32-bit numbers. ``ids`` is at most 65,536."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    axes = [f"v{i}" for i in range(DIMENSIONS)]
    schema = "doc_id long, first long, copies long, n long, ids binary, " + ", ".join(f"{a} double" for a in axes)
    encoded = staged(rows.mapInArrow(tidy(_encode(file, ids, closing)), schema), f"{label}-ids")
    # Rows of a run are numbered one after the other.
    each = F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1)).alias("row")
    all_ = encoded.select("first", each, "n", "doc_id", *axes)
    stats = all_.agg(*[F.avg(a) for a in axes], *[F.stddev_pop(a) for a in axes]).first()
    # Rounded, so that the order in which Spark adds up does not move a document to another cell.
    mean = [round(x or 0.0, 6) for x in stats[:DIMENSIONS]]
    deviation = [round(x or 0.0, 6) or 1.0 for x in stats[DIMENSIONS:]]
    tie = F.pmod(F.xxhash64("doc_id", "row"), F.lit(1 << TIE_BITS))
    keyed = all_.select("first", "row", "n", tie.alias("tie"), *axes).mapInArrow(
        _keys(mean, deviation), "first long, row long, n long, key long"
    )
    order = ["key", "row"]
    blocks = ordered_blocks(keyed, order, f"{label}-order")
    before = F.coalesce(F.sum("n").over(within_block([], order)), F.lit(0))
    placed = blocks.withColumn("before", before).join(block_starts(blocks, [], "n").select("_block", "_start"), "_block")
    line = staged(placed.select("first", (F.col("_start") + F.col("before")).alias("at")), f"{label}-line")
    found = encoded.select("doc_id", "n", "ids", "first").join(line, "first").select("doc_id", "n", "ids", "at")
    return found.mapInArrow(
        tidy(_pieces(length)),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary",
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences themselves: their ids and length. A sequence has at most ``length`` pieces."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(ordered, F.lit(b"").cast("binary"), lambda all_, p: F.concat(all_, p["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), whole.alias("ids"))
