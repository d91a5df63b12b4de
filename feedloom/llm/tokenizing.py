"""Encoding on executors with public tokenizer files, and memory of pieces already encoded."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMORY = 500_000  # pieces remembered per Python worker; some 100 MB
ONCE = 500_000  # hashes of pieces met once; some 30 MB
SLICE = 1 << 20  # characters cut into pieces at a time

#: A space after a character that is no white space. The byte-level pattern never joins such a
#: character to a following space, so a token always starts there, whatever stands around.
BEFORE_SPACE = re.compile(r"(?<=\S) ")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file. Every machine has its own copy, so workers look it up themselves."""
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(batch: pa.RecordBatch, column: int, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose texts have about ``size`` bytes: pieces of text take a multiple
    of the text's memory, so only few are held at a time."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    total, at = np.cumsum(lengths), 0
    while at < batch.num_rows:
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + size, side="right")))
        yield batch.slice(at, end - at)
        at = end


@lru_cache(maxsize=4)
def tokenizer(name: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(name))


class Memory:
    """What pieces of text are encoded to, for those met more than once.

    Most distinct pieces of a corpus occur a single time; remembering them would only push out the
    others. A full memory starts anew, which costs time but changes no result.

    A full stop or comma at the end, after a letter or digit, is a piece of its own for both kinds of
    vocabulary, so it is put aside before a piece counts as new. With ``fold`` ASCII pieces are
    lower-cased, which a vocabulary without capitals does itself.
    """

    def __init__(self, encode: Callable[[list[str]], list], fold: bool):
        self.encode, self.fold = encode, fold
        self.known: dict[str, object] = {}
        self.once: set[int] = set()

    def split(self, piece: str) -> tuple[str, str]:
        core, mark = piece, ""
        if piece[-1:] in (".", ",") and piece[-2:-1].isalnum():
            core, mark = piece[:-1], piece[-1]
        if self.fold and core.isascii() and "<" not in core:
            core = core.lower()
        return core, mark

    def of(self, pieces: list[str], counts: list[int]) -> list:
        """Values of distinct pieces that were met so many times."""
        known = self.known
        new = [(p, n, *self.split(p)) for p, n in zip(pieces, counts, strict=True) if p not in known]
        cores: dict[str, int] = {}
        for _, n, core, mark in new:
            if core not in known:
                cores[core] = cores.get(core, 0) + n
            if mark and mark not in known:
                cores[mark] = 2
        known.update(zip(cores, self.encode(list(cores)), strict=True))
        for p, _, core, mark in new:
            if mark:
                known[p] = known[core] + known[mark]
            elif p != core:
                known[p] = known[core]
        out = list(map(known.__getitem__, pieces))
        rare = [c for c, n in cores.items() if n == 1 and hash(c) not in self.once]
        self.once.update(map(hash, rare))
        for p in [p for p, n, core, _ in new if p != core and n == 1] + rare:
            del known[p]
        if len(self.once) > ONCE:
            self.once = set()
        if len(known) > MEMORY:
            self.known = {}
        return out


def byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones for themselves, the
    others for the characters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def ranked(name: str, pattern: str, end: str = ""):
    """A faster encoder of the same vocabulary, for texts without special strings.

    Merges take place in the order of their tokens' ids, so the ids alone say all. Where words end in
    ``end``, that becomes the byte ``_``, which the texts then must not hold otherwise.
    """
    import tiktoken

    t, back, mark = tokenizer(name), byte_of(), ord("_")
    special = t.get_added_tokens_decoder()
    ranks: dict[bytes, int] = {}
    for token, number in t.get_vocab().items():
        last = bool(end) and token.endswith(end)
        raw = bytes(back[c] for c in (token[: -len(end)] if last else token)) if number not in special else b""
        if raw and not (end and mark in raw):
            ranks[raw + b"_" if last else raw] = number
    if end:
        ranks[b"_"] = max(t.get_vocab().values()) + 1
    return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def tokens_with(name: str, mark: Callable[[str], bool]) -> np.ndarray:
    """Per id whether its token in the vocabulary has a property."""
    found = tokenizer(name).get_vocab()
    out = np.zeros(max(found.values()) + 1, dtype=bool)
    out[[i for token, i in found.items() if mark(token)]] = True
    return out


def joined(texts: pa.StringArray, between: str) -> str:
    """All texts as one, without a Python string for each."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), between)[0].as_py()


def runs(ids: list[int], ends: np.ndarray, each: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces encoded as one text, and how many belong to every piece. ``ends`` marks ids that end
    a part, ``each`` is the number of parts of every piece."""
    flat = np.array(ids, dtype="<u4")
    stop = np.flatnonzero(ends[flat]) + 1
    upto = np.cumsum(each)
    if len(stop) != (upto[-1] if len(upto) else 0):
        raise RuntimeError("pieces and their encoding differ in number")
    last = stop[upto - 1]
    return flat, np.diff(last, prepend=0)


def ids_of(name: str) -> Callable[[list[str]], list[bytes]]:
    """Ids of pieces as bytes, each encoded by itself."""

    def encode(pieces: list[str]) -> list[bytes]:
        found = tokenizer(name).encode_batch_fast(pieces, add_special_tokens=False)
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in found]

    return encode


@lru_cache(maxsize=8)
def memory(name: str) -> Memory:
    """One memory per worker process and file; it outlives the task."""
    return Memory(ids_of(name), True)
