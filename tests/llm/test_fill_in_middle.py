import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import words

from tillroll.llm import fill_in_middle as fim

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.DOTALL)


def brute_force(doc_id, text):
    """n, form, characters of prefix and middle, and output, by cutting the list of tokens."""
    text = text or ""
    units = TOKEN.findall(text)
    name = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(name[at : at + 8], 16) for at in (0, 8, 16, 24)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@given(st.text(alphabet=st.sampled_from("abZ @[`{é<P>SM\n\U0001f600"), max_size=80), st.integers(0, 10**9))
@settings(max_examples=300, deadline=None)
def test_against_brute_force(text, doc_id):
    made = fim.formed(doc_id, text)
    assert (made.n, made.form, made.prefix_chars, made.middle_chars, made.output) == brute_force(doc_id, text)
    assert fim.rebuilt(made.form, made.output) == text


@given(st.lists(st.integers(0, 400), max_size=300), st.integers(1, 63))
@settings(max_examples=200, deadline=None)
def test_index_gives_every_boundary(steps, error):
    bounds = np.cumsum([0, *steps])
    index = fim.RankIndex.fit(bounds, error)
    assert index.cuts(list(range(len(bounds)))) == bounds.tolist()
    assert np.abs(index.residuals.astype(int)).max() <= error + 1


def test_pieces_are_as_long_as_the_error_allows():
    bounds = np.cumsum([0, *np.random.default_rng(1).integers(1, 9, 50_000)])
    loose, tight = fim.RankIndex.fit(bounds), fim.RankIndex.fit(bounds, 4)
    assert len(loose.starts) < len(tight.starts) < len(bounds) / 4
    # A straight run is one piece, whatever its length and the window.
    assert len(fim.RankIndex.fit(np.arange(20_000) * 3).starts) == 1
    jumps = np.concatenate([np.arange(5_000), 10**6 + np.arange(5_000)])
    assert fim.RankIndex.fit(jumps).starts.tolist() == [0, 5_000]


def test_long_words_and_texts():
    rng = random.Random(4)
    texts = ["x" * 300_000, " ".join(words(30_000, 2)), "".join(rng.choices("a \U0001f600\n", k=100_000))]
    for number, text in enumerate(texts):
        made = fim.formed(number, text)
        assert (made.n, made.form, made.prefix_chars, made.middle_chars, made.output) == brute_force(number, text)


@pytest.mark.parametrize("text", ["a <P> b", "<S>", "x<M>", ""])
def test_marked_and_empty_texts_stay_plain(text):
    assert all(fim.formed(n, text).form == "plain" for n in range(50))


def test_halves_of_markers_are_text():
    for number in range(200):
        text = "<P <S< M> <<P S> P><"
        made = fim.formed(number, text)
        assert fim.rebuilt(made.form, made.output) == text


ROWS = [
    (1, "One two, three!"),
    (1, "One two, three!"),
    (2, None),
    (3, ""),
    (None, "no id here"),
    (4, "Ünï cöde \U0001f600 end"),
    (5, "w " * 30_000),
    *[(n, f"{n} words and {n} more") for n in range(10, 60)],
]


def test_tables(docs):
    frame = docs(ROWS, ("n", "form", "output", "prefix_chars"))
    made = fim.transformed(frame)
    got = sorted((tuple(r) for r in made.collect()), key=str)
    assert got == sorted(((d, *brute_force(d, t)) for d, t in ROWS), key=str)
    back = sorted((tuple(r) for r in fim.restored(made).collect()), key=str)
    assert back == sorted(((d, t or "") for d, t in ROWS), key=str)
    digests = fim.form_digests(frame).collect()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = [(d, *brute_force(d, t)[:4], sha(brute_force(d, t)[4]), sha(t or "")) for d, t in ROWS]
    assert sorted(map(tuple, digests), key=str) == sorted(expected, key=str)


def test_indexes_as_a_table(docs):
    for row in fim.rank_indexes(docs(ROWS)).collect():
        index = fim.RankIndex(
            np.array(row.starts), np.array(row.offsets), np.array(row.slopes), np.frombuffer(row.residuals, np.int8)
        )
        texts = [text or "" for doc_id, text in ROWS if doc_id == row.doc_id]
        ends = [np.cumsum([0, *map(len, TOKEN.findall(text))]).tolist() for text in texts]
        assert index.cuts(list(range(len(index)))) in ends


def test_empty_table(docs):
    assert fim.form_digests(docs([])).collect() == []
    assert fim.transformed(docs([])).collect() == []
