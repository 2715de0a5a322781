import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import bpe, pretokens
from tillroll.llm.bpe import TokenAutomaton

LIBRARY = pretokens.tokenizer(bpe.TOKENIZER)
SPECIAL = "<|endoftext|>"


def by_merging(word, merges):
    """Plain byte-pair encoding: the earliest merge first, from the left."""
    parts = list(word)
    for left, right in merges:
        at = 0
        while at < len(parts) - 1:
            if (parts[at], parts[at + 1]) == (left, right):
                parts[at : at + 2] = [left + right]
            at += 1
    return parts


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_automaton_of_random_merges(data):
    tokens, merges = list("abc"), []
    for _ in range(data.draw(st.integers(0, 12))):
        left, right = data.draw(st.sampled_from(tokens)), data.draw(st.sampled_from(tokens))
        if left + right not in tokens:
            tokens.append(left + right)
            merges.append((left, right))
    vocab = {token: n for n, token in enumerate(tokens)}
    automaton = TokenAutomaton(vocab, merges)
    word = data.draw(st.text("abc", min_size=0, max_size=20))
    assert [tokens[n] for n in automaton.encode(word)] == by_merging(word, merges)


@pytest.mark.parametrize(
    "text",
    [
        "",
        " \t\n",
        "Hello World, it's 2024!!",
        f"a{SPECIAL}b{SPECIAL}{SPECIAL} <|startoftext|>c<|other|>",
        "ÉTÉ naïve Straße İstanbul ΣΊΣΥΦΟΣ ﬁn",
        "é 中文字 \U0001f600\U0001f600 İ \x1c \x85 \xa0 \xad  ",
        "a" * 4_000,
        "ab" * 4_000,
        "!?" * 2_000 + "1234567890" * 50,
        "don't we'll I'M they'RE 'sS",
        "x\r\ny",
    ],
)
def test_same_as_the_library(text):
    words = bpe.codec()
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    assert words.encode(text) == expected
    assert words.decode(expected) == LIBRARY.decode(expected, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=40))
def test_any_text(text):
    assert bpe.codec().encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_words_of_few_letters():
    rng = random.Random(2)
    words = bpe.codec()
    for _ in range(2_000):
        word = "".join(rng.choices("aest", k=rng.randint(1, 30)))
        assert words.encode(word) == LIBRARY.encode(word, add_special_tokens=False).ids


def test_only_produced_sequences_are_accepted():
    automaton = bpe.codec().automaton
    the = automaton.encode("the")
    assert len(the) == 1
    split = [automaton.vocab["t"], automaton.vocab["h"]]
    state = automaton.target[split[0]]
    assert not automaton.has_arc(state, split[1])


def test_cache_generations():
    made = []
    cache = pretokens.PieceCache(lambda piece: made.append(piece) or piece.upper(), limit=3)
    for piece in "abcabdae":
        assert cache[piece] == piece.upper()
    assert made.count("a") == 1 and len(cache) <= 3 and len(cache.old) <= 3


ROWS = [
    (1, "Some words, some words."),
    (2, None),
    (3, ""),
    (None, "no id"),
    (4, "w" * 50_000),
    (4, "again " * 20_000 + SPECIAL),
]


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    digests = (" ".join(map(str, ids)), decoded)
    return (len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in digests))


def test_digests(docs):
    got = sorted((tuple(r) for r in bpe.encoding_digests(docs(ROWS, ("ids", "n_tokens"))).collect()), key=str)
    assert got == sorted(((doc_id, *expected(text)) for doc_id, text in ROWS), key=str)
    assert bpe.encoding_digests(docs([])).collect() == []


def test_ids_and_text(docs):
    for row in bpe.encoded(docs(ROWS)).collect():
        assert bpe.codec().decode(row.ids) == row.decoded
