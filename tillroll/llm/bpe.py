"""Byte-pair encoding by a tokenization automaton, and decoding by its arc labels.

A list of merges is compiled into a deterministic automaton over tokens that accepts exactly the
token sequences the merges produce. It starts with one state that every base symbol leads back to.
For each merge (u, v), in order, a gadget is put in: the state that u leads to is copied without its
arc v, u leads to the copy from now on, and wherever u could follow, the new token uv can too, to
where v led before. Copies are kept as differences: a state knows the token whose merges made it,
when, and what it lost, so the automaton takes a few numbers per merge, and arcs are read off it into
a table as words need them.

Since a sequence is accepted only if it is what the merges produce, a word has one accepted path and
so has every prefix of it. A word is encoded left to right by table look-ups, the longest open arc
first; an end that turns out not to lie on the word's path is never entered again, so the work stays
in proportion to the word's length.

Texts are normalised and split as the tokenizer file says (NFC, lower case, words); its special
tokens are taken as such wherever they stand in a text. Null text is empty and gives no tokens.
Words and texts may be of any length; nothing is cut. Columns beside doc_id and text are ignored,
rows are handled one by one, so ties, repeats and empty tables need nothing special.
"""

import bisect
import hashlib
import json
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import pretokens
from tillroll.llm.base import arrow_rows, held, text_or_empty, text_slices

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ARC_TABLE_SIZE = 200_000
KNOWN_STRETCHES = 400_000
KNOWN_WORDS = 50_000
SLICE_CHARS = 3_000_000


class TokenAutomaton:
    """Accepts the token sequences that a list of merges produces."""

    def __init__(self, vocab: dict[str, int], merges: Sequence[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.labels = {number: token for token, number in vocab.items()}
        # Of a state: the token whose merges made it and the merge it was copied at.
        self.owner: list[int | None] = [None]
        self.born: list[int] = [0]
        # Of a token: where it leads, where it led before its own first merge, when and from which
        # left part it was made, and its copies by time.
        self.target = dict.fromkeys(vocab.values(), 0)
        self.before = dict.fromkeys(vocab.values(), 0)
        self.made = dict.fromkeys(vocab.values(), 0)
        self.left: dict[int, int] = {}
        self.copies: dict[int, list[tuple[int, int]]] = {}
        self.lost: dict[tuple[int, int], int] = {}
        self.arcs: dict[int, bool] = {}
        self.row = max(vocab.values(), default=0) + 1
        for time, (left, right) in enumerate(merges, 1):
            self._add_gadget(time, vocab[left], vocab[right], vocab[left + right])
        self.longest = max((len(self._plain(token)) for token in vocab), default=0)
        self.arcs.clear()
        # Tokens inside a word and at its end; without a suffix they are the same.
        self.inner = {t: n for t, n in vocab.items() if not suffix or not t.endswith(suffix)}
        self.final = {self._plain(t): n for t, n in vocab.items() if t.endswith(suffix)}

    def _plain(self, token: str) -> str:
        return token.removesuffix(self.suffix)

    def _add_gadget(self, time: int, left: int, right: int, joined: int) -> None:
        led = self.target[right]
        if not self.has_arc(self.target[left], right):
            self.made[joined], self.left[joined] = time, -1
            return
        copy = len(self.owner)
        self.owner.append(left)
        self.born.append(time)
        self.copies.setdefault(left, []).append((time, copy))
        self.lost[left, right] = time
        self.target[left] = copy
        self.target[joined] = self.before[joined] = led
        self.made[joined], self.left[joined] = time, left

    def _ancestor(self, state: int, time: int) -> int:
        """The state itself or the one it descends from that was there at this time."""
        while self.born[state] > time:
            copies = self.copies[self.owner[state]]
            place = bisect.bisect_right(copies, (time, len(self.owner)))
            state = copies[place - 1][1] if place else self.before[self.owner[state]]
        return state

    def has_arc(self, state: int, token: int) -> bool:
        """Whether the token may follow; an entry of the arc table."""
        entry = state * self.row + token
        found = self.arcs.get(entry)
        if found is None:
            if len(self.arcs) >= ARC_TABLE_SIZE:
                self.arcs.clear()
            found = self.arcs[entry] = self._arc(state, token)
        return found

    def _arc(self, state: int, token: int) -> bool:
        made, at = self.made[token], state
        while at and self.born[at] > made:
            owner = self.owner[at]
            if self.lost.get((owner, token), self.born[at] + 1) <= self.born[at]:
                return False
            copies = self.copies[owner]
            if copies[0][0] <= made:
                break
            at = self.before[owner]
        if not made:
            return True
        left = self.left[token]
        return left >= 0 and self.has_arc(self._ancestor(state, made), left)

    def encode(self, word: str) -> list[int]:
        """Token numbers of one word given as base symbols."""
        size, longest, arcs, row = len(word), self.longest, self.arcs, self.row
        inner, final, target = self.inner, self.final, self.target
        # Path so far: where each token starts and the state before it. An end from which the word
        # cannot be finished is tried once, as only one state goes with it.
        starts, states, found, dead = [], [], [], set()
        start, state, end = 0, 0, min(size, longest)
        while start < size:
            while end > start:
                if end == size:
                    token = final.get(word[start:])
                else:
                    token = None if end in dead else inner.get(word[start:end])
                if token is not None:
                    open_arc = arcs.get(state * row + token)
                    if open_arc or (open_arc is None and self.has_arc(state, token)):
                        break
                end -= 1
            if end > start:
                starts.append(start)
                states.append(state)
                found.append(token)
                start, state, end = end, target[token], min(size, end + longest)
            else:
                dead.add(start)
                end = start - 1
                start, state = starts.pop(), states.pop()
                found.pop()
        return found

    def decode(self, numbers: Iterable[int]) -> str:
        """Labels of the arcs taken, a blank between two."""
        return " ".join(map(self.labels.__getitem__, numbers))


class WordCodec:
    """A word-level tokenizer file: splitting, the automaton, and what words gave so far.

    Results of stretches between blanks are kept as Arrow arrays, some tens of bytes each, so a slice
    of texts costs Python work for its new stretches only. When there are more than
    `KNOWN_STRETCHES`, all are worked out anew as they come.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.path, self.library = path, pretokens.tokenizer(path)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        suffix = model["end_of_word_suffix"] or ""
        self.automaton = TokenAutomaton(model["vocab"], merges, suffix)
        self.specials = pretokens.special_tokens(path)
        for name, number in self.specials.items():
            self.automaton.labels[number] = name
        self.words = pretokens.PieceCache(self._word, KNOWN_WORDS)
        self.forget()

    def forget(self) -> None:
        self.names = self.ids = self.decoded = pa.array([], pa.large_string())
        self.counts = np.empty(0, np.int64)

    def _word(self, piece: str) -> list[int]:
        return self.automaton.encode(pretokens.byte_text(piece))

    def _odd(self, text: str) -> list[int]:
        """A text without special tokens, split by the library."""
        normal = self.library.normalizer.normalize_str(text)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [n for piece, _ in pieces for n in self.automaton.encode(piece)]

    def _stretch(self, stretch: str) -> list[int]:
        pieces = pretokens.WORD_PATTERN.findall(stretch)
        return [n for piece in pieces for n in self.words[piece]]

    def _is_plain(self, text: str) -> bool:
        has_special = "<|" in text and any(name in text for name in self.specials)
        return pretokens.is_plain(text) and not has_special

    def encode(self, text: str) -> list[int]:
        pattern = pretokens.special_pattern(self.path)
        found, at = [], 0
        for match in pattern.finditer(text) if pattern and "<|" in text else ():
            found += self.encode(text[at : match.start()])
            found.append(self.specials[match[0]])
            at = match.end()
        rest = text[at:] if at else text
        return found + (self._stretch(rest.lower()) if self._is_plain(rest) else self._odd(rest))

    def decode(self, numbers: Iterable[int]) -> str:
        return self.automaton.decode(numbers)

    def _written(self, numbers: list[int]) -> tuple[str, str]:
        return " ".join(map(str, numbers)), self.decode(numbers)

    def _rows(self, stretches: pa.Array) -> np.ndarray:
        """Where the results of distinct stretches stand, after those that are new were added."""
        if len(self.names) > KNOWN_STRETCHES:
            self.forget()
        place = pc.index_in(stretches, value_set=self.names)
        unseen = pc.is_null(place)
        fresh = stretches.filter(unseen)
        numbers = [self._stretch(s) for s in fresh.to_numpy(zero_copy_only=False).tolist()]
        written = [self._written(found) for found in numbers]
        kind, known = pa.large_string(), len(self.names)
        self.names = pa.concat_arrays([self.names, fresh])
        self.ids = pa.concat_arrays([self.ids, pa.array([w[0] for w in written], kind)])
        self.decoded = pa.concat_arrays([self.decoded, pa.array([w[1] for w in written], kind)])
        own = np.fromiter(map(len, numbers), np.int64, len(numbers))
        self.counts = np.concatenate([self.counts, own])
        rows = pc.fill_null(place, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        rows[unseen.to_numpy(zero_copy_only=False)] = known + np.arange(len(fresh))
        return rows

    def written(self, texts: list[str]) -> Iterator[tuple[int, int, str, str]]:
        """(place, token count, numbers as text, labels as text) of every text."""
        plain = [place for place, text in enumerate(texts) if self._is_plain(text)]
        for place in set(range(len(texts))).difference(plain):
            numbers = self.encode(texts[place])
            yield place, len(numbers), *self._written(numbers)
        cut = [texts[place].lower().split() for place in plain]
        bounds = np.cumsum([0, *map(len, cut)])
        flat = pa.array(list(chain.from_iterable(cut)), pa.large_string()).dictionary_encode()
        rows = self._rows(flat.dictionary)[flat.indices.to_numpy()]
        totals = np.concatenate([[0], np.cumsum(self.counts[rows])])[bounds]
        offsets, blank = pa.array(bounds), pa.scalar(" ", pa.large_string())
        ids, decoded = (
            pc.binary_join(pa.LargeListArray.from_arrays(offsets, column.take(pa.array(rows))), blank)
            for column in (self.ids, self.decoded)
        )
        for at, place in enumerate(plain):
            yield place, int(totals[at + 1] - totals[at]), ids[at].as_py(), decoded[at].as_py()


def codec(path: str = TOKENIZER) -> WordCodec:
    """Compiled once per worker."""
    return held(("bpe", path), lambda: WordCodec(path))


def _digests(path: str):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids_sha256", pa.string()),
            ("decoded_sha256", pa.string()),
        ]
    )

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(path)
        for part, texts in text_slices(batches, chars=SLICE_CHARS):
            found = [(0, "", "")] * len(texts)
            for place, count, *written in words.written(texts):
                digests = (hashlib.sha256(text.encode()).hexdigest() for text in written)
                found[place] = (count, *digests)
            yield arrow_rows(schema, [part.column(0), *(list(column) for column in zip(*found))])

    return rows


def encoded(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id, `ids` and `decoded` of every text."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    )

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(path)
        for part, texts in text_slices(batches):
            ids = [words.encode(text) for text in texts]
            yield arrow_rows(schema, [part.column(0), ids, [words.decode(row) for row in ids]])

    return _texts(docs).mapInArrow(rows, "doc_id bigint, ids array<int>, decoded string")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def encoding_digests(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256; numbers and text never leave the task."""
    return _texts(docs).mapInArrow(
        _digests(path),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )
