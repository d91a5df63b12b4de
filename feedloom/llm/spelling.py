"""Groups of spelling variants: near words found by Gram matrices of letter counts, edits verified.

Words differ by one inserted, deleted or replaced character. Such words have the same length or lengths
that differ by one, and if one is cut into halves, either their first halves or their last halves agree.
So a word of length ``n`` goes into four blocks, under its first and its last characters: those for pairs
of length ``n`` with ``n`` or ``n + 1``, and those for ``n - 1`` with ``n``. In a block, products of the
matrix of letter counts give the squared distance of any two words: 1 for an inserted or deleted
character, 2 for a replaced one. Pairs at most two apart are verified character by character. A pair
that shares both ends counts under its first characters only, so it is met once.

Blocks are dealt by hash into tasks, many small ones to a task; a block above ``TILE`` words is cut into
tiles whose pairs are tasks of their own. A strip of products is held at a time. No pairs leave a task:
each word gets its number of near words there and the best of them, which are then combined by word.

Words are counted by Spark functions over whole texts, with partial sums before the shuffle.

Defined results: a null or empty text has no words; a null id counts as the empty text when the character
to leave out is drawn; rows that repeat an id and text count again; words of equal count and form are
decided by code point; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.session import staged

#: The characters of words, and those that are lower-cased.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TILE = 8192  # words of a block's tile, about
STRIP = 1024  # rows of a tile whose products are held at a time
TASK = 100_000  # places of words in blocks that a task gets, about
SHOWN = "word string, near long, best_n long, best string"


def typed_words(docs: DataFrame, doc_id: str, text: str, least: int, drop_every: int) -> DataFrame:
    """One row per run of letters: ``word``, with a character left out where the draw says so."""
    run = F.explode(F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0)))
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    drawn = F.crc32(F.concat("name", F.lit(":"), "run").cast("binary"))
    place = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), place), F.col("run").substr(place + 2, F.length("run")))
    word = F.when(F.col("h") % drop_every == 0, shorter).otherwise(F.col("run"))
    # Shorter runs than the least word can give no word, with or without the draw.
    return docs.select(name.alias("name"), run.alias("run")).withColumn("h", drawn).select(word.alias("word"))


def blocks_of(words: DataFrame, least: int) -> DataFrame:
    """``word, n, g, side, key``: a word in the blocks of its length and of the one before."""
    size = F.length("word")
    # ``g`` is the smaller length of a pair; of ``g`` characters the first half is ``g // 2``.
    grouped = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("g"))
    grouped = grouped.where(F.col("g") >= least)
    half = F.floor(F.col("g") / 2).cast("int")
    first = F.struct(F.lit(0).alias("side"), F.col("word").substr(F.lit(1), half).alias("key"))
    last = F.struct(F.lit(1).alias("side"), F.col("word").substr(F.length("word") - (F.col("g") - half) + 1, F.col("g") - half).alias("key"))
    return grouped.select("word", "n", "g", F.inline(F.array(first, last)))


def characters(words: list[str], size: int) -> np.ndarray:
    """Words of one length as a matrix; all their characters are below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(-1, size)


def letter_counts(chars: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """How often every letter occurs in every word. ``letters`` gives a letter's column."""
    n, size = chars.shape
    width = int(letters.max(initial=0)) + 1
    at = (np.arange(n)[:, None] * width + letters[chars]).ravel()
    return np.bincount(at, minlength=n * width).reshape(n, width).astype(np.float32)


def replaced(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """True where words of one length differ in exactly one place."""
    return (one != two).sum(axis=1) == 1


def inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """True where the longer word is the other with one character more."""
    ahead = np.cumprod(short == long[:, :-1], axis=1).sum(axis=1)
    behind = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= short.shape[1]


def near_pairs(one: np.ndarray, two: np.ndarray, skip: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of two character matrices that are one edit apart, a strip of ``one`` at a time.
    ``skip``: pairs that agree in so many first characters belong to another block."""
    letters = np.zeros(256, dtype=np.int64)
    present = np.unique(np.concatenate([one.ravel(), two.ravel()]))
    letters[present] = np.arange(len(present))
    x, y = letter_counts(one, letters), letter_counts(two, letters)
    square_x, square_y = (x**2).sum(axis=1), (y**2).sum(axis=1)
    for at in range(0, len(x), STRIP):
        part = slice(at, at + STRIP)
        gram = x[part] @ y.T
        gram *= -2
        gram += square_x[part, None]
        gram += square_y
        i, j = np.nonzero(gram <= 2)
        i += at
        for low in range(0, len(i), 1 << 20):
            a, b = i[low : low + (1 << 20)], j[low : low + (1 << 20)]
            p, q = one[a], two[b]
            good = replaced(p, q) if p.shape[1] == q.shape[1] else inserted(p, q)
            if skip:
                good &= (p[:, :skip] != q[:, :skip]).any(axis=1)
            yield a[good], b[good]


class Near:
    """Number of near words and the best of them for the words of a block. Words are sorted, so that of
    two words of equal count the one at the smaller place comes first by code point."""

    def __init__(self, n: np.ndarray):
        self.n = n
        self.near = np.zeros(len(n), dtype=np.int64)
        # Places by rising count, equal counts by falling place: the best near word has the highest rank.
        order = np.lexsort((-np.arange(len(n)), n))
        self.rank = np.empty(len(n), dtype=np.int64)
        self.rank[order] = np.arange(len(n))
        self.order = order
        self.best = np.full(len(n), -1, dtype=np.int64)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.near += np.bincount(a, minlength=len(self.near))
        np.maximum.at(self.best, a, self.rank[b])


def _block(words: list[str], n: np.ndarray, tile: np.ndarray, tiles: tuple[int, int], g: int, side: int) -> tuple | None:
    """Near words within a block, or between two tiles of it."""
    size = np.array(list(map(len, words)))
    places = {(t, k): np.flatnonzero((tile == t) & (size == k)) for t in set(tiles) for k in (g, g + 1)}
    chars = {at: characters([words[i] for i in rows], at[1]) for at, rows in places.items() if len(rows)}
    found = Near(n)
    # Words of length ``g`` with those of ``g``, and with those of ``g + 1``.
    meets = [((tiles[0], g), (tiles[1], g)), ((tiles[0], g), (tiles[1], g + 1))]
    if tiles[0] != tiles[1]:
        meets.append(((tiles[1], g), (tiles[0], g + 1)))
    for one, two in meets:
        if one in chars and two in chars:
            for i, j in near_pairs(chars[one], chars[two], g // 2 if side else 0):
                a, b = places[one][i], places[two][j]
                found.add(a, b)
                if one != two:
                    found.add(b, a)
    met = np.flatnonzero(found.near)
    if not len(met):
        return None
    best = found.order[found.best[met]]
    return [words[i] for i in met], found.near[met], n[best], [words[i] for i in best]


def _tasks(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """All blocks of a task; rows of one block stand together after sorting."""
    by = ["g", "side", "a", "b", "key"]
    rows = rows.sort_values([*by, "word"], kind="stable")
    border = np.ones(len(rows) + 1, dtype=bool)
    columns = {c: rows[c].to_numpy() for c in [*by, "tile", "n"]}
    border[1:-1] = np.logical_or.reduce([columns[c][1:] != columns[c][:-1] for c in by])
    ends, words = np.flatnonzero(border), rows["word"].tolist()
    out: tuple[list, list, list, list] = ([], [], [], [])
    for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if hi - lo > 1:
            g, side, a, b = (int(columns[c][lo]) for c in by[:4])
            found = _block(words[lo:hi], columns["n"][lo:hi], columns["tile"][lo:hi], (a, b), g, side)
            for whole, part in zip(out, found or ((),) * 4, strict=True):
                whole.extend(part)
    kinds = (object, np.int64, np.int64, object)
    return pd.DataFrame({c: np.array(x, dtype=k) for c, x, k in zip(["word", "near", "best_n", "best"], out, kinds, strict=True)})


def near_words(words: DataFrame, least: int, label: str) -> DataFrame:
    """``word, near, best_n, best`` of the words (``word, n``) that have near words."""
    blocks = staged(blocks_of(words, least), f"{label}-blocks")
    sizes = blocks.groupBy("g", "side", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = sizes.withColumn("tiles", F.ceil(F.col("size") / TILE).cast("int"))
    total = sizes.agg(F.sum(F.col("size") * F.col("tiles"))).first()[0] or 0
    tasks = max(1, -(-total // TASK))
    dealt = blocks.join(sizes.drop("size"), ["g", "side", "key"])
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("word"), "tiles").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    sent = dealt.select("word", "n", "g", "side", "key", "tile", other).select(
        "word", "n", "g", "side", "key", "tile", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b")
    )
    task = F.pmod(F.xxhash64("g", "side", "key", "a", "b"), F.lit(tasks)).alias("task")
    found = sent.groupBy(task).applyInPandas(_tasks, SHOWN)
    return found.groupBy("word").agg(F.sum("near").alias("near"), _best().alias("m")).select(
        "word", "near", F.col("m.n").alias("best_n"), F.col("m.word").alias("best")
    )


def _best() -> Column:
    """Largest count; of equal ones the first by code point."""
    least = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return F.struct((-least["n"]).alias("n"), least["word"].alias("word"))


def roots(forms: DataFrame, label: str) -> DataFrame:
    """``word, root`` for words with a form (``word, form``): the form that has none itself. Counts rise
    from form to form, so there are no circles and chains are short."""
    point = staged(forms.select("word", F.col("form").alias("root")), f"{label}-roots")
    while True:
        step = point.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = staged(point.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), f"{label}-roots")
        point = jumped.select("word", "root")
        if jumped.where("next IS NOT NULL").isEmpty():
            return point


def variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 7, often: int = 2, ratio: int = 10,
    drop_every: int = 31, label: str = "spelling",
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of at least ``least`` characters and ``often``
    occurrences. Its form is its most frequent near word, if that is ``ratio`` times as frequent."""
    counted = typed_words(docs, doc_id, text, least, drop_every).where(F.length("word") >= least)
    words = staged(counted.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= often), f"{label}-words")
    near = staged(near_words(words, least, label), f"{label}-near")
    has_form = F.col("best_n") >= ratio * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", F.when(has_form, F.col("best")).alias("form"), "n", F.coalesce("near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("best_n")).alias("form_n"),
    )
    found = staged(found, f"{label}-forms")
    root = roots(found.where("form IS NOT NULL"), label)
    return found.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
