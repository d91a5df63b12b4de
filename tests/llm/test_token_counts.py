import pytest

from feedloom.llm import token_counts
from feedloom.llm.tokenizing import tokenizer

FILE = "byte_bpe_50k.json"


def whole(text):
    return len(tokenizer(FILE).encode(text or "", add_special_tokens=False).ids)


TEXTS = [
    None, "", " ", "a", "Hello  world\n\n it's  fine ", "x<|endoftext|> y <|endoftext|>", "naïve café   　日本 語", "a\x1cb \x85c",
    "word " * 3000, "no-space" * 2000, "\n" * 9000, "1 2 3 a's b'll " * 900, "é " * 4000, " \t x" * 3000,
]


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (500, 40), (16_384, 512)])
def test_counts_are_those_of_the_whole_text(documents, chunk, overlap):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(8, TEXTS[8]), (None, TEXTS[8]), (None, "a b")]
    got = token_counts.count_tokens(documents(rows), chunk=chunk, overlap=overlap).collect()
    want = [(i, len((t or "").encode()), whole(t)) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_table(documents):
    assert token_counts.count_tokens(documents([])).count() == 0


def test_both_encoders_of_the_vocabulary_agree():
    import random

    from feedloom.llm.tokenizing import ranked

    rng = random.Random(8)
    stock = [" ", "  ", "\n", "\t", "a", "the", "ing", "'s", "1", "23", "é", "ñ", "日", "😀", "...", "\u00a0", "\u3000", "\x1c", "\x85", "\u0301", "Ω", "_", "'"]
    stock += [chr(c) for c in range(33, 0x2500, 7)]
    fast, slow = ranked(FILE, token_counts.pattern()), tokenizer(FILE)
    for _ in range(20_000):
        text = "".join(rng.choices(stock, k=rng.randint(1, 15)))
        assert fast.encode_ordinary(text) == slow.encode(text, add_special_tokens=False).ids, text


def test_places_of_tokens():
    text = "né 日本 x  y<z 😀a"
    at, n = token_counts.encoded(text, FILE)
    assert n == whole(text) == len(at)
    # The other encoder, which a special string asks for, finds the same boundaries.
    other, special = token_counts.encoded(text + " <|x", FILE)
    assert special == whole(text + " <|x")
    here = [token_counts.boundaries(text, tokens, 100, 1, len(text)) for tokens in (at, other)]
    assert here[0] == here[1] and here[0][0] == [102, 105, 107, 112]
