import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import pretokens
from tillroll.llm import token_files as files

LIBRARY = pretokens.tokenizer(files.TOKENIZER)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def encoded(texts):
    return [list(np.frombuffer(ids, "<u4")) for ids in files.encoder().encode(texts)]


TEXTS = [
    "",
    " ",
    "  ",
    "\n",
    "a b",
    " a",
    "a ",
    "a  b   c",
    "a \nb\n c \n d\n\n e\t\tf \t g",
    "  two  blanks  ",
    "it's we'll <|endoftext|> x",
    "é İ Σ ς 中文 \x1c \x85 \xa0 \xad",
    "x" * 5_000,
    "word " * 5_000,
    "1234567890 " * 300 + "!?" * 300,
]


def test_same_as_the_library():
    assert encoded(TEXTS) == [library_ids(text) for text in TEXTS]
    for text in TEXTS:  # alone, and with what is known by now
        assert encoded([text]) == [library_ids(text)]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.text(st.sampled_from("ab ,.\n\t1é'"), max_size=30),
            st.text(st.characters(codec="utf-8"), max_size=15),
        ),
        max_size=4,
    )
)
def test_any_texts(texts):
    assert encoded(texts) == [library_ids(text) for text in texts]


ROWS = [
    (30, "third of them"),
    (10, "first, with some words that come again and again"),
    (20, None),
    (-5, "below zero"),
    (40, "again and again " * 5_000),
    (50, "one <|endoftext|> special"),
    *((1_000 + n, f"document number {n} with some words that come again") for n in range(300)),
]


def brute_force(rows):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library_ids(text), 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_against_brute_force(docs):
    got = files.token_digests(docs(ROWS, ("start", "shard", "first"))).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_force(ROWS))


def test_many_small_shards_and_single_documents(spark, docs, tmp_path):
    out = str(tmp_path / "t")
    files.write_tokens(docs(ROWS), out, shard_bytes=500)
    shards = files.read_shards(spark, out).orderBy("first").collect()
    assert len(shards) > 5
    dictionary, found = files.read_dictionary(spark, out), {}
    for row in shards:
        shard = files.Shard(bytes(row.content), dictionary)
        for place in reversed(range(len(shard.doc_ids))):  # any one without the others
            found[int(shard.doc_ids[place])] = list(shard.ids(place))
    assert found == {doc_id: [*library_ids(text), 0] for doc_id, text in ROWS}
    rows = files.token_rows(spark, out).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted(doc_id for doc_id, _ in ROWS)
    with pytest.raises(ValueError, match="another dictionary"):
        files.Shard(bytes(shards[0].content), b"other")
    with pytest.raises(ValueError, match="not a token-id shard"):
        files.Shard(b"x" * 100, dictionary)


def test_the_dictionary_is_shared_and_pays(docs):
    small = [(n, f"short text number {n} about the same few things") for n in range(400)]
    dictionary = files.train_dictionary(docs(small))
    assert dictionary
    width = files.id_width(files.TOKENIZER)
    assert width == 2

    def size(trained):
        writer = files.ShardWriter(trained, width)
        for n, ids in enumerate(files.encoder().encode([text for _, text in small])):
            writer.add(n, ids)
        return writer.bytes

    assert size(dictionary) < 0.9 * size(b"")


def test_null_and_repeated_ids(docs):
    rows = [(None, "a"), (None, "b"), (2, "same"), (2, "same"), (2, "other")]
    got = sorted((tuple(r) for r in files.token_digests(docs(rows)).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 2, 2, 2]
    assert [r[1] for r in got] == list(np.cumsum([0, *(r[2] for r in got[:-1])]))
    assert sorted(r[3] for r in got) == sorted(r[3] for r in brute_force(rows))


def test_empty_tables(docs):
    assert files.token_digests(docs([])).collect() == []
    assert [tuple(r)[:3] for r in files.token_digests(docs([(1, "")])).collect()] == [(1, 0, 1)]
