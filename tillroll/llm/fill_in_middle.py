"""Fill-in-middle: texts cut at two token boundaries and written in another order.

A text falls into tokens (a run of letters, or any other single character). The offsets of all its
boundaries are kept as a learned index over ranks: straight pieces, each as long as its line stays
within `ERROR` characters of every boundary it covers, and what is left at each boundary as one signed
byte. A cut at a rank is the line's prediction plus that byte, so it is exact, and the index takes
little more than a byte a token however long the text.

Two hashed ranks cut a text into prefix, middle and suffix, written as psm or spm; a hashed share stays
plain, and so do empty texts and ones that hold a marker. Without markers in the text the written form
has one reading, so the text is rebuilt from form and output alone.

Hashes depend on the id alone: rows that repeat an id are cut at the same hashes, a null id counts as
an empty one. Null text is empty. Texts are cut whole whatever their length; one text is held at a
time beside its slice. Rows are handled one by one, in one pass without a shuffle, so an empty table
gives an empty result; columns beside doc_id and text are ignored, whatever their names.
"""

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.base import arrow_rows, text_or_empty, text_slices

SEED = "1"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FORMED_PERCENT = 90
SPM_PERCENT = 20
# Residuals are signed bytes, and rounding may add one.
ERROR = 63
WINDOW = 2_048


def boundaries(text: str) -> np.ndarray:
    """Code-point offsets of the token boundaries, 0 and the text's end among them."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(codes):
        return np.zeros(1, np.int64)
    letter = ((codes | 0x20) - np.uint32(ord("a"))) < 26
    inner = np.flatnonzero(~(letter[1:] & letter[:-1])) + 1
    return np.concatenate([[0], inner, [len(codes)]])


@dataclass
class RankIndex:
    """Boundary offsets by rank: straight pieces and residuals."""

    starts: np.ndarray
    offsets: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray

    @classmethod
    def fit(cls, bounds: np.ndarray, error: int = ERROR) -> "RankIndex":
        """Each piece goes on while one line through its first boundary is near enough to all."""
        starts, slopes, at = [], [], 0
        while at < len(bounds):
            low, high, end, width = -np.inf, np.inf, at + 1, WINDOW
            while end < len(bounds):
                stop = min(len(bounds), end + width)
                steps, rise = np.arange(end - at, stop - at), bounds[end:stop] - bounds[at]
                lows = np.maximum(np.maximum.accumulate((rise - error) / steps), low)
                highs = np.minimum(np.minimum.accumulate((rise + error) / steps), high)
                apart = lows > highs
                fit = int(apart.argmax()) if apart[-1] else len(apart)
                if fit:
                    low, high = lows[fit - 1], highs[fit - 1]
                end += fit
                if fit < len(apart):
                    break
            starts.append(at)
            slopes.append((low + high) / 2 if end > at + 1 else 0.0)
            at = end
        starts = np.array(starts, np.int64)
        index = cls(starts, bounds[starts], np.array(slopes), np.zeros(0, np.int8))
        index.residuals = (bounds - index._predicted(np.arange(len(bounds)))).astype(np.int8)
        return index

    def _predicted(self, ranks: np.ndarray) -> np.ndarray:
        piece = np.searchsorted(self.starts, ranks, "right") - 1
        line = self.slopes[piece] * (ranks - self.starts[piece])
        return self.offsets[piece] + np.floor(line + 0.5).astype(np.int64)

    def __len__(self) -> int:
        return len(self.residuals)

    def cuts(self, ranks: list[int]) -> list[int]:
        """Offsets of the boundaries at these ranks."""
        wanted = np.array(ranks, np.int64)
        return (self._predicted(wanted) + self.residuals[wanted]).tolist()


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    """The four hashed numbers of a document."""
    text = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(text[at : at + 8], 16) for at in range(0, 32, 8)]


@dataclass(frozen=True)
class Formed:
    """A text's written form; prefix and middle in characters, None if plain."""

    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: str


def formed(doc_id: int | None, text: str, seed: str = SEED) -> Formed:
    index = RankIndex.fit(boundaries(text))
    n = len(index) - 1
    first, second, share, order = draws(doc_id, seed)
    marked = any(marker in text for marker in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or share % 100 >= FORMED_PERCENT:
        return Formed(n, PLAIN, None, None, text)
    start, end = index.cuts(sorted((first % (n + 1), second % (n + 1))))
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if order % 100 < SPM_PERCENT:
        form, output = SPM, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = PSM, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return Formed(n, form, start, end - start, output)


def rebuilt(form: str, output: str) -> str:
    """The text that was written in this form."""
    if form == PLAIN:
        return output
    opening, second = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    one, _, rest = output.removeprefix(opening).partition(second)
    other, _, middle = rest.partition(MIDDLE)
    prefix, suffix = (one, other) if form == PSM else (other, one)
    return f"{prefix}{middle}{suffix}"


def _rows(
    docs: DataFrame, columns: str, schema: pa.Schema, row: Callable[[int | None, str], tuple]
) -> DataFrame:
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found = [row(doc_id, text) for doc_id, text in zip(part.column(0).to_pylist(), texts)]
            yield arrow_rows(schema, [list(column) for column in zip(*found)])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(rows, columns)


_HEAD = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"
_HEAD_ARROW = [
    ("doc_id", pa.int64()),
    ("n", pa.int64()),
    ("form", pa.string()),
    ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()),
]


def transformed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the text as it is written, `output`."""

    def row(doc_id: int | None, text: str) -> tuple:
        made = formed(doc_id, text, seed)
        return doc_id, made.n, made.form, made.prefix_chars, made.middle_chars, made.output

    schema = pa.schema([*_HEAD_ARROW, ("output", pa.string())])
    return _rows(docs, f"{_HEAD}, output string", schema, row)


def restored(outputs: DataFrame) -> DataFrame:
    """doc_id and text from `form` and `output` of `transformed`."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, 2):
            rebuilt_texts = list(map(rebuilt, part.column(1).to_pylist(), texts))
            yield arrow_rows(schema, [part.column(0), rebuilt_texts])

    return outputs.select("doc_id", "form", "output").mapInArrow(rows, "doc_id bigint, text string")


def rank_indexes(docs: DataFrame) -> DataFrame:
    """The boundary index of every text: pieces as lists, residuals as a byte each."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("starts", pa.list_(pa.int64())),
            ("offsets", pa.list_(pa.int64())),
            ("slopes", pa.list_(pa.float64())),
            ("residuals", pa.binary()),
        ]
    )

    def row(doc_id: int | None, text: str) -> tuple:
        index = RankIndex.fit(boundaries(text))
        return doc_id, index.starts, index.offsets, index.slopes, index.residuals.tobytes()

    lists = "starts array<bigint>, offsets array<bigint>, slopes array<double>"
    return _rows(docs, f"doc_id bigint, {lists}, residuals binary", schema, row)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def form_digests(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """What `transformed` and `restored` give, the texts as digests; they never leave the task."""
    digests = [("output_sha256", pa.string()), ("restored_sha256", pa.string())]

    def row(doc_id: int | None, text: str) -> tuple:
        made = formed(doc_id, text, seed)
        written = (_sha256(made.output), _sha256(rebuilt(made.form, made.output)))
        return doc_id, made.n, made.form, made.prefix_chars, made.middle_chars, *written

    columns = f"{_HEAD}, output_sha256 string, restored_sha256 string"
    return _rows(docs, columns, pa.schema([*_HEAD_ARROW, *digests]), row)
