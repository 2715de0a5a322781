"""Secrets in texts: listed patterns, and values in credential context that are costly to guess.

The listed kinds are found leftmost and non-overlapping, each kind by itself, and too short matches
dropped: `assign` (a credential name with a value of 6 characters or more; the span is the whole
match), `access` (20 or more), `hex` (24 or more).

`guess` spans are added to them: values that stand behind a credential name, whatever characters they
are made of, and that a guesser would need many tries for. The number of tries is the least over all
ways of cutting the value into dictionary words (with capitals and look-alike digits), dates,
repeats, keyboard walks and brute-force stretches, found by dynamic programming over the value; the
block of a repeat is priced by the same programme. So "password is required" is no secret and "password
is k7#Qw9!zLp" is.

Words are ranked by their place in a public tokenizer's vocabulary, which is sorted by frequency, so
nothing is learned from the corpus. Spans are code-point offsets, end exclusive. Texts, words, walks and
repeated blocks may be of any length; a value is cut on only while that costs less than the limit. Null
text is empty and has no spans. Each row is judged by itself, in one pass without a shuffle, so repeated
rows agree and an empty table gives an empty result. Columns beside doc_id and text are ignored,
whatever their names.
"""

import functools
import hashlib
import json
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.base import arrow_rows, text_or_empty, text_slices

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
MIN_LOG10_GUESSES = 10.0

# The listed patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
# In this pattern only the names are without case; the value class holds both cases anyway.
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "guess")

CONTEXT = re.compile(
    r"""(?:password|passwd|passphrase|passcode|pwd|secret|token|credentials?|(?:api|access|private)[_ -]?key)"""
    r"""["']?[ \t]*(?:[:=]|\bis\b|\bwas\b)[ \t]*["'`]?([^\s"'`,;<>]{6,})""",
    re.IGNORECASE | re.ASCII,
)

# Passwords in common use, most used first.
COMMON = (
    "123456 password 12345678 qwerty 123456789 12345 1234 111111 1234567 dragon 123123 baseball "
    "abc123 football monkey letmein shadow master 666666 qwertyuiop 123321 mustang 1234567890 "
    "michael 654321 superman 1qaz2wsx 7777777 121212 000000 qazwsx 123qwe killer trustno1 jordan "
    "jennifer zxcvbnm asdfgh hunter buster soccer harley batman andrew tigger sunshine iloveyou "
    "charlie robert thomas hockey ranger daniel starwars 112233 george computer michelle jessica "
    "pepper 1111 zxcvbn 555555 11111111 131313 freedom 777777 pass maggie 159753 aaaaaa ginger "
    "princess joshua cheese amanda summer love ashley nicole chelsea matthew access yankees "
    "987654321 dallas austin thunder taylor matrix admin welcome login secret changeme default"
).split()
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "0123456789")
YEAR_NOW = 2025

LONGEST_DATE = 10
_DATE = re.compile(
    r"(?:(?P<y1>(?:19|20)\d\d)([-/._]?)(?:0[1-9]|1[0-2])\2(?:0[1-9]|[12]\d|3[01]))$"
    r"|(?:(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|[12]\d|3[01])\3(?P<y2>(?:19|20)\d\d|\d\d))$"
    r"|(?P<y3>(?:19|20)\d\d)$",
    re.ASCII,
)


@functools.lru_cache(maxsize=2)
def word_ranks(path: str = VOCABULARY) -> dict[str, int]:
    """Lower-case words of three letters and more by rank, common passwords first."""
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    ranks = {word: rank for rank, word in enumerate(COMMON, 1)}
    for token, _ in sorted(vocab.items(), key=lambda entry: entry[1]):
        word = token.removeprefix("Ġ").lower()
        if len(word) >= 3 and word.isascii() and word.isalpha():
            ranks.setdefault(word, len(ranks) + 1)
    return ranks


def _neighbours() -> dict[str, dict[str, tuple[int, int]]]:
    """Keys beside each key, with the direction, of a keyboard whose rows are shifted by half a key."""
    at = {key: (row, 2 * place + row) for row, keys in enumerate(KEY_ROWS) for place, key in enumerate(keys)}
    return {
        key: {
            other: (r - row, p - place)
            for other, (r, p) in at.items()
            if (r == row and abs(p - place) == 2) or (abs(r - row) == 1 and abs(p - place) == 1)
        }
        for key, (row, place) in at.items()
    }


NEIGHBOURS = _neighbours()


def _case_tries(word: str) -> float:
    upper = sum(map(str.isupper, word))
    if not upper:
        return 0.0
    if upper == len(word) or (upper == 1 and (word[0].isupper() or word[-1].isupper())):
        return math.log10(2)
    return math.log10(2) * min(upper, len(word) - upper) + math.log10(len(word))


def word_cost(piece: str, ranks: dict[str, int]) -> float | None:
    lowered, best = piece.lower(), None
    plain = lowered.translate(LOOKALIKES)
    swaps = sum(a != b for a, b in zip(lowered, plain))
    for word, extra in ((lowered, 0.0), (plain, math.log10(2) * swaps)):
        rank = ranks.get(word)
        if rank is not None:
            cost = math.log10(rank) + extra + _case_tries(piece)
            best = cost if best is None else min(best, cost)
    return best


def date_cost(piece: str) -> float | None:
    if not 4 <= len(piece) <= LONGEST_DATE:
        return None
    found = _DATE.match(piece)
    if not found:
        return None
    year = found["y1"] or found["y2"] or found["y3"]
    number = int(year) if len(year) == 4 else 1900 + int(year) + 100 * (int(year) < 50)
    years = math.log10(max(20, abs(YEAR_NOW - number)))
    separator = math.log10(4) if not piece.isdigit() else 0.0
    return years if found["y3"] else years + math.log10(365) + separator


@functools.lru_cache(maxsize=256)
def char_cost(char: str) -> float:
    """Tries for one character by brute force: the size of its class."""
    if char.isascii():
        sizes = ((str.isdigit, 10), (str.islower, 26), (str.isupper, 26))
        return math.log10(next((size for test, size in sizes if test(char)), 33))
    return math.log10(1000)


WALK_START = math.log10(len(NEIGHBOURS))
WALK_TURN = math.log10(4)
PIECE = math.log10(2)


def _step(before: str, after: str) -> tuple | None:
    """Kind and direction of the move from one key to the next, if it is part of a walk."""
    for alphabet in ALPHABETS:
        if before in alphabet and after in alphabet:
            gap = alphabet.index(after) - alphabet.index(before)
            if abs(gap) == 1:
                return "order", gap
    direction = NEIGHBOURS.get(before, {}).get(after)
    return None if direction is None else ("keys", direction)


def _walks(steps: list, start: int) -> Iterator[tuple[int, float]]:
    """(end, cost) of the walks over three keys and more that begin at `start`."""
    if start + 1 >= len(steps) or steps[start + 1] is None:
        return
    turns, first = 1, steps[start + 1]
    for end in range(start + 2, len(steps)):
        step = steps[end]
        if step is None or step[0] != first[0]:
            return
        turns += step != steps[end - 1]
        yield end + 1, WALK_START + WALK_TURN * turns + math.log10(end + 1 - start)


class _Words:
    """Ranked words and all that they begin with."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=0)
        self.beginnings = {word[:size] for word in ranks for size in range(1, len(word) + 1)}

    def from_(self, value: str, start: int) -> Iterator[tuple[int, float]]:
        """(end, cost) of the words that begin at `start`."""
        lowered = value[start : start + self.longest].lower()
        plain, known = lowered.translate(LOOKALIKES), self.beginnings
        for size in range(1, len(lowered) + 1):
            if lowered[:size] not in known and plain[:size] not in known:
                return
            if lowered[:size] in self.ranks or plain[:size] in self.ranks:
                yield start + size, word_cost(value[start : start + size], self.ranks)


@functools.lru_cache(maxsize=2)
def ranked_words(path: str = VOCABULARY) -> _Words:
    return _Words(word_ranks(path))


class Guesser:
    """Least log10 of tries over all cuts of a value; each piece after the first doubles them.

    Costs of `limit` and more count as infinite, and nothing is cut on from there, so a long value
    that is dear is settled by its beginning.
    """

    def __init__(self, words: _Words, limit: float = math.inf):
        self.words, self.limit, self.blocks = words, limit, {}

    def cost(self, value: str) -> float:
        lowered, codes = value.lower(), np.frombuffer(value.encode("utf-32-le", "surrogatepass"), "<u4")
        # The way to each key from the one before; lower-casing may make a character two.
        steps = [None, *map(_step, lowered, lowered[1:])] if len(lowered) == len(value) else [None] * len(value)
        # Least cost up to each end, and of cuts whose last piece is a brute-force stretch, which goes
        # on by a character at a time.
        best, brute = np.full(len(value) + 1, math.inf), math.inf
        best[0] = 0.0
        for start, char in enumerate(value):
            so_far = float(best[start])
            if so_far >= self.limit and brute >= self.limit:
                brute = math.inf
                continue
            joint = so_far + PIECE * (start > 0)
            brute = min(brute, joint) + char_cost(char)
            best[start + 1] = min(best[start + 1], brute)
            if joint >= self.limit:
                continue
            for end, cost in self.words.from_(value, start):
                best[end] = min(best[end], joint + cost)
            for end, cost in _walks(steps, start):
                best[end] = min(best[end], joint + cost)
            if char.isdigit():
                for end in range(start + 4, min(len(value), start + LONGEST_DATE) + 1):
                    if (cost := date_cost(value[start:end])) is not None:
                        best[end] = min(best[end], joint + cost)
            for width, times in self._repeats(value, codes, start):
                cost = joint + self._block(value[start : start + width])
                ends = best[start + 2 * width : start + times * width + 1 : width]
                np.minimum(ends, cost + _logs(times)[2:], out=ends)
        return float(best[-1]) if best[-1] < self.limit else math.inf

    def _block(self, block: str) -> float:
        if block not in self.blocks:
            self.blocks[block] = char_cost(block) if len(block) == 1 else self.cost(block)
        return self.blocks[block]

    def _repeats(self, value: str, codes: np.ndarray, start: int) -> Iterator[tuple[int, int]]:
        """(width, times) of the blocks that begin at `start` and stand there twice and more.

        A block that is itself a repeat says what its own block says, unless it is a word. Inside a
        run of blocks there are no others but such, so only wider ones than fit twice into it are
        looked for beyond it.
        """
        widths = np.flatnonzero(codes[start + 1 : (len(codes) + start) // 2 + 1] == codes[start]) + 1
        at, beyond = 0, 0
        while at < len(widths):
            width = int(widths[at])
            if self.words.longest < width <= beyond:
                at = int(np.searchsorted(widths, beyond, "right"))
                continue
            at += 1
            if value[start : start + width] != value[start + width : start + 2 * width]:
                continue
            differ = np.flatnonzero(codes[start + width :] != codes[start : len(codes) - width])
            run = int(differ[0]) + width if len(differ) else len(codes) - start
            yield width, run // width
            beyond = max(beyond, run // 2)


@functools.lru_cache(maxsize=64)
def _logs_to(size: int) -> np.ndarray:
    return np.log10(np.maximum(1, np.arange(size)))


def _logs(times: int) -> np.ndarray:
    """log10 of 0 to `times`."""
    return _logs_to(1 << (times + 1).bit_length())[: times + 1]


def log10_guesses(value: str, ranks: dict[str, int] | None = None, limit: float = math.inf) -> float:
    """Least log10 of tries over all cuts of the value, infinite from `limit` on."""
    words = ranked_words() if ranks is None else _Words(ranks)
    return Guesser(words, limit).cost(value)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the listed kinds."""
    found = [
        (m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN
    ]
    if "AKIA" in text:
        found += [
            (m.start(), m.end(), "access")
            for m in ACCESS.finditer(text)
            if len(m[0]) >= LEAST_ACCESS
        ]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= LEAST_HEX]
    return sorted(found, key=_by_start)


def guess_spans(text: str, minimum: float, words: _Words) -> list[tuple[int, int, str]]:
    return [
        (m.start(1), m.end(1), "guess")
        for m in CONTEXT.finditer(text)
        if Guesser(words, minimum).cost(m[1]) >= minimum
    ]


def _by_start(span: tuple[int, int, str]) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


def written(spans: Iterable[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scanned(
    docs: DataFrame, minimum: float = MIN_LOG10_GUESSES, vocabulary: str = VOCABULARY
) -> DataFrame:
    """Counts and spans of every document: doc_id, n_assign, n_access, n_hex, n_guess, base, spans."""
    counts = tuple(f"n_{kind}" for kind in KINDS)
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            *((name, pa.int64()) for name in counts),
            ("base_sha256", pa.string()),
            ("spans", pa.string()),
        ]
    )

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = ranked_words(vocabulary)
        for part, texts in text_slices(batches):
            found = []
            for text in texts:
                base = base_spans(text)
                every = sorted(base + guess_spans(text, minimum, words), key=_by_start)
                kinds = [span[2] for span in every]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                found.append((*(kinds.count(kind) for kind in KINDS), digest, written(every)))
            yield arrow_rows(schema, [part.column(0), *(list(column) for column in zip(*found))])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    columns = ", ".join(f"{name} bigint" for name in counts)
    return texts.mapInArrow(rows, f"doc_id bigint, {columns}, base_sha256 string, spans string")
