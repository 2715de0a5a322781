import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import words

from tillroll.llm import packing, pretokens


def brute_force(lengths, capacity):
    """Sequences one by one: greedy filling, then two for the shortest if they fill it better."""
    left, made = sorted(lengths, reverse=True), []
    while left:
        own, room = [], capacity
        for length in list(left):
            if length <= room:
                own.append(length)
                left.remove(length)
                room -= length
        if room and len(own) > 1:
            gap = room + own[-1]
            pairs = [
                (one + two, one, two)
                for at, one in enumerate(left)
                for two in left[at + 1 :]
                if own[-1] < one + two <= gap
            ]
            if pairs:
                _, one, two = max(pairs)
                left.append(own.pop())
                for length in (one, two):
                    left.remove(length)
                    own.append(length)
                left.sort(reverse=True)
        made.append(sorted(own, reverse=True))
    return made


def unrolled(runs, counts, capacity):
    ends = {}
    for length in counts:
        starts = sorted(r[1] for r in runs.tolist() if r[0] == length)
        ends.update({(length, a): b for a, b in zip(starts, [*starts[1:], counts[length]])})
    made = {}
    for length, start, sequence, each, offset in runs.tolist():
        for number in range(start, ends[length, start]):
            nth = number - start
            made.setdefault(sequence + nth // each, []).append((offset + nth % each * length, length))
    for own in made.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return [sorted((length for _, length in made[s]), reverse=True) for s in sorted(made)]


@given(st.lists(st.integers(1, 30), max_size=60), st.integers(30, 45))
@settings(max_examples=400, deadline=None)
def test_runs_are_what_sequence_by_sequence_gives(lengths, capacity):
    counts = Counter(lengths)
    assert unrolled(packing.packed_runs(counts, capacity), counts, capacity) == brute_force(lengths, capacity)


def test_two_replace_the_shortest():
    # Greedily 50 + 30 leaves 20; 28 + 21 fill the gap of 50 with 49, and the 30 goes on.
    runs = packing.packed_runs({50: 1, 30: 1, 28: 1, 21: 1}, 100)
    assert unrolled(runs, {50: 1, 30: 1, 28: 1, 21: 1}, 100) == [[50, 28, 21], [30]]


def test_runs_do_not_grow_with_the_pieces():
    rng = random.Random(2)
    counts = Counter(min(4_096, int(rng.lognormvariate(6, 1)) + 1) for _ in range(30_000))
    few = packing.packed_runs(counts)
    many = packing.packed_runs({length: n * 10**7 for length, n in counts.items()})
    assert len(many) < 20 * len(counts)
    total = sum(length * n for length, n in counts.items())
    sequences = len(unrolled(few, counts, 4_096))
    assert sequences <= -(-total // 4_096) * 1.01 + 1


def plain_texts():
    rng = random.Random(3)
    texts = [None, "", " ", "It's  a\ttest\n\nof 12 things", "ÉCOLE Ünï ſ", " x y", "İ ı ǅ"]
    texts += ["<|startoftext|>a <|endoftext|>", "a<|endoftext|>b", "漢字 and кириллица", "x" * 5_000]
    texts += [" ".join(words(rng.randint(1, 400), n)).title() for n in range(60)]
    return texts + ["w " * 9_000, " ".join(words(6_000, 99))]


def library_ids(text):
    library = pretokens.tokenizer(packing.TOKENIZER)
    return [*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_ids_are_the_librarys():
    texts = [text or "" for text in plain_texts()]
    got = packing.WordEncoder(packing.TOKENIZER).encode(pa.array(texts))
    assert [ids.tolist() for ids in got] == [library_ids(text)[:-1] for text in texts]


@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x180), max_size=30), max_size=5))
@settings(max_examples=150, deadline=None)
def test_ids_of_any_characters(texts):
    got = packing.WordEncoder(packing.TOKENIZER).encode(pa.array(texts, pa.string()))
    assert [ids.tolist() for ids in got] == [library_ids(text)[:-1] for text in texts]


def check(rows, got, capacity):
    pieces = Counter()
    for doc_id, text in rows:
        ids = library_ids(text)
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4")
            pieces[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert pieces == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values(), default=0) <= capacity
    lengths = [r.length for r in got]
    assert sorted(ends.values()) == sorted(map(sum, brute_force(lengths, capacity)))


@pytest.mark.parametrize("capacity", [4_096, 256])
def test_packing_of_documents(docs, capacity):
    rows = list(enumerate(plain_texts()))
    got = packing.packed(docs(rows), capacity=capacity, with_ids=False).collect()
    check(rows, got, capacity)


def test_sequences_hold_the_ids(docs):
    rows = list(enumerate(plain_texts()))
    whole = packing.packed(docs(rows))
    ids = {doc_id: library_ids(text) for doc_id, text in rows}
    starts = {(r.sequence_id, r.offset): r for r in whole.drop("ids").collect()}
    for row in packing.sequences(whole).collect():
        assert len(row.ids) <= 4_096
        for doc_id, at in zip(row.doc_ids, row.offsets):
            piece = starts[row.sequence_id, at]
            own = ids[doc_id][piece.start : piece.start + piece.length]
            assert row.ids[at : at + piece.length] == own and piece.doc_id == doc_id


def test_nulls_ties_repeats_and_clashing_columns(docs):
    rows = [(None, "a b"), (None, "a b"), (None, None), (1, "c"), (1, "c d"), (2, "")] + [(7, "same")] * 700
    frame = docs(rows, ("length", "part", "nth", "number", "sequence_id", "n"))
    got = packing.packed(frame, capacity=64, with_ids=False).collect()
    check(rows, got, 64)


def test_empty_table(docs):
    assert packing.packed_digests(docs([])).collect() == []
    assert packing.sequences(packing.packed(docs([]))).collect() == []
