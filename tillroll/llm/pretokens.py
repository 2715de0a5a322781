"""Splitting texts into the pieces that byte-pair tokenizers encode by themselves.

Patterns of the public tokenizer files are written out for a range of plain characters, where
Python's `re` and lower-casing agree with the tokenizers library; other texts are recognised and go
through the library's own normaliser and splitter.
"""

import functools
import re

from tokenizers import Tokenizer

# Letters and numbers among the characters up to U+017F, blanks aside.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
NUMBERS = "0-9²³¹¼½¾"
SUFFIXES = "'s|'t|'re|'ve|'m|'ll|'d"
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ſ]*")

WORD_PATTERN = re.compile(f"{SUFFIXES}|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+")
BYTE_PATTERN = re.compile(
    f"{SUFFIXES}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\\s{LETTERS}{NUMBERS}]+|\\s+(?!\\S)|\\s+"
)


def is_plain(text: str) -> bool:
    return PLAIN.fullmatch(text) is not None


@functools.lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """The library's tokenizer, once per worker, without truncation and padding."""
    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@functools.lru_cache(maxsize=4)
def special_tokens(path: str) -> dict[str, int]:
    added = tokenizer(path).get_added_tokens_decoder()
    return {token.content: number for number, token in added.items()}


@functools.lru_cache(maxsize=4)
def special_pattern(path: str) -> re.Pattern | None:
    names = sorted(special_tokens(path), key=len, reverse=True)
    return re.compile("|".join(map(re.escape, names))) if names else None


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, others from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = (byte for byte in range(256) if byte not in printable)
    letters = {byte: chr(byte) for byte in printable}
    letters |= {byte: chr(256 + place) for place, byte in enumerate(moved)}
    return [letters[byte] for byte in range(256)]


BYTE_LETTERS = _byte_letters()
_FROM_LATIN = {byte: letter for byte, letter in enumerate(BYTE_LETTERS)}


def byte_text(piece: str) -> str:
    """The bytes of a piece, a letter each."""
    return piece.encode().decode("latin-1").translate(_FROM_LATIN)


class PieceCache(dict):
    """What was worked out for pieces already seen, in two generations of up to `limit` each.

    A full cache becomes the old generation; what is asked for again moves over, the rest goes when
    the next one is full. Frequent pieces stay and memory is bounded.
    """

    def __init__(self, work, limit: int = 150_000):
        super().__init__()
        self.work, self.limit, self.old = work, limit, {}

    def __missing__(self, piece):
        found = self.old.get(piece)
        if found is None:
            found = self.work(piece)
        self.put(piece, found)
        return found

    def put(self, piece, found) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[piece] = found

    def clear_all(self) -> None:
        self.clear()
        self.old = {}
