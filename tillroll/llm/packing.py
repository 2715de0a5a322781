"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

A document is its ids and an end id; one that is longer than a sequence is cut into pieces of that
length, and the last piece may be shorter. Nothing else is cut.

A sequence is filled greedily, each time with the longest piece that still fits. If room is left and it
holds two pieces or more, its shortest one is put back when two unpacked pieces fill the gap that this
opens more tightly: of all pairs the one with the largest sum, then with the longer first piece.

Pieces of one length are alike, so this is worked out on the number of pieces of each length: a table
of at most `capacity` rows whatever the input, the only thing the driver gets. The choices for a
sequence stay the same while the pieces they take are there, so sequences come in runs of equal
ones, and the runs are exactly what filling sequence by sequence gives. They are as many as there are
times at which a length runs short, which depends on the lengths and not on the number of documents.

Which piece goes where follows from its number among the pieces of its length. Each task numbers its
own, running sums over tasks, length by length, give the rest, and a piece finds its run, sequence and
offset by a look-up in the runs. No text and no list of pieces is sorted, and a length that a third of
all pieces have is as spread as they are.

Null text is empty and leaves just the end id; rows that repeat an id, and null ids, are documents of
their own; pieces of equal length take the order in which tasks read them. Texts of any length are
encoded whole. An empty table gives an empty result, columns beside doc_id and text are ignored.
"""

import json
import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm import pretokens
from tillroll.llm.base import arrow_rows, batch_slices, held, stored, text_or_empty

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
CAPACITY = 4_096
KNOWN_STRETCHES = 1_000_000
SLICE_CHARS = 4_000_000

_PLAIN = rf"\A{pretokens.PLAIN.pattern}\z"


class WordEncoder:
    """Ids of texts by the tokenizers library, which sees each stretch between blanks once.

    The tokenizer drops blanks and never joins what stands on both sides of one. Stretches are found
    and told apart in Arrow; what the library gave for them is kept as two arrays, stretches and ids.
    When there are more than `KNOWN_STRETCHES`, all are learned anew as they come. Texts with
    characters beyond the plain ones, or with a special token, go to the library as a whole.
    """

    def __init__(self, path: str):
        self.library = pretokens.tokenizer(path)
        self.specials = tuple(pretokens.special_tokens(path))
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.ends_piece = np.zeros(max(model["vocab"].values(), default=0) + 1, bool)
        suffix = model["end_of_word_suffix"] or ""
        self.ends_piece[[n for token, n in model["vocab"].items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.names = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_list(pa.uint32()))

    def alone(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, stretches: pa.Array) -> pa.LargeListArray:
        """Ids of stretches, encoded some at a time as one text.

        Each piece the tokenizer splits off ends with a token of its own kind, so the stretches are
        found again by their numbers of pieces.
        """
        names = stretches.to_numpy(zero_copy_only=False).tolist()
        n_pieces = pc.count_substring_regex(stretches, pretokens.WORD_PATTERN.pattern).to_numpy()
        found, sizes = [np.empty(0, "<u4")], [np.zeros(1, np.int64)]
        for at in range(0, len(names), 200):
            part = names[at : at + 200]
            ids, last = self.alone(" ".join(part)), np.cumsum(n_pieces[at : at + 200])
            ends = np.flatnonzero(self.ends_piece[ids]) + 1
            if len(last) and len(ends) == last[-1]:
                found.append(ids)
                sizes.append(np.diff(np.concatenate([[0], ends])[last], prepend=0))
            else:
                found += map(self.alone, part)
                sizes.append(np.array(list(map(len, found[len(found) - len(part) :]))))
        offsets = np.cumsum(np.concatenate(sizes))
        return pa.LargeListArray.from_arrays(offsets, pa.array(np.concatenate(found), pa.uint32()))

    def _rows(self, stretches: pa.Array) -> np.ndarray:
        """Where the ids of distinct stretches stand, after new ones were added."""
        if len(self.names) > KNOWN_STRETCHES:
            self.forget()
        place = pc.index_in(stretches, value_set=self.names)
        unseen = pc.is_null(place)
        fresh = stretches.filter(unseen)
        learned = self._learn(fresh)
        known = len(self.names)
        self.names = pa.concat_arrays([self.names, fresh])
        self.ids = pa.concat_arrays([self.ids, learned])
        rows = pc.fill_null(place, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        rows[unseen.to_numpy(zero_copy_only=False)] = known + np.arange(len(fresh))
        return rows

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text."""
        texts = texts.cast(pa.large_string())
        plain = pc.match_substring_regex(texts, _PLAIN)
        for special in self.specials:
            plain = pc.and_not(plain, pc.match_substring(texts, special))
        chosen = plain.to_numpy(zero_copy_only=False)
        results: list[np.ndarray] = [np.empty(0, "<u4")] * len(texts)
        for place in np.flatnonzero(~chosen).tolist():
            results[place] = self.alone(texts[place].as_py())
        cut = pc.utf8_split_whitespace(pc.utf8_lower(texts.filter(plain)))
        if not len(cut):
            return results
        # Blanks at a text's ends leave empty stretches, which have no ids.
        flat = cut.flatten().dictionary_encode()
        rows = self._rows(flat.dictionary.cast(pa.large_string()))
        lists = self.ids.take(pa.array(rows[flat.indices.to_numpy()]))
        values, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        bounds = cut.offsets.to_numpy()
        bounds = (ends - ends[0])[bounds - bounds[0]].tolist()
        for place, start, end in zip(np.flatnonzero(chosen).tolist(), bounds, bounds[1:]):
            results[place] = values[start:end]
        return results


def encoder(path: str = TOKENIZER) -> WordEncoder:
    return held(("packing", path), lambda: WordEncoder(path))


_PIECES = (
    "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint, part int, nth bigint"
)
_PIECES_ARROW = [
    ("doc_id", pa.int64()),
    ("piece", pa.int32()),
    ("start", pa.int64()),
    ("length", pa.int32()),
    ("ids_crc32", pa.int64()),
    ("part", pa.int32()),
    ("nth", pa.int64()),
]


def _cut(path: str, end_id: int, capacity: int, with_ids: bool):
    schema = pa.schema([*_PIECES_ARROW, ("ids", pa.binary())] if with_ids else _PIECES_ARROW)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        words, end = encoder(path), np.array([end_id], "<u4")
        for slice_ in batch_slices(batches, chars=SLICE_CHARS):
            found = []
            for doc_id, own in zip(slice_.column(0).to_pylist(), words.encode(slice_.column(1))):
                ids = np.concatenate([own, end])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    raw = ids[start : start + capacity].astype("<u4").tobytes()
                    length = len(raw) // 4
                    row = (doc_id, piece, start, length, zlib.crc32(raw), part, seen[length])
                    found.append((*row, raw) if with_ids else row)
                    seen[length] += 1
            yield arrow_rows(schema, [list(column) for column in zip(*found)])

    return rows


def pieces(
    docs: DataFrame,
    path: str = TOKENIZER,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    with_ids: bool = True,
) -> DataFrame:
    """Stored pieces of all documents, numbered by length in the task that made them."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    columns = f"{_PIECES}, ids binary" if with_ids else _PIECES
    return stored(texts.mapInArrow(_cut(path, end_id, capacity, with_ids), columns))


# Columns of a run's entry for one length: the first piece it takes, the first sequence, pieces of
# this length in a sequence, and the offset of the first of them.
RUN = ("length", "taken_from", "sequence", "each", "offset")


class _Left:
    """Pieces left of each length, and the longest length left that is not above a limit."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.counts = np.zeros(capacity + 1, np.int64)
        for length, count in counts.items():
            self.counts[length] = count
        self.below = np.where(self.counts > 0, np.arange(capacity + 1), -1).tolist()
        self.below = [at if at >= 0 else max(0, place - 1) for place, at in enumerate(self.below)]

    def longest(self, limit: int) -> int:
        at = limit
        while self.below[at] != at:
            self.below[at] = self.below[self.below[at]]
            at = self.below[at]
        return at

    def take(self, length: int, count: int) -> None:
        self.counts[length] -= count
        if not self.counts[length]:
            self.below[length] = length - 1


def _filled(left: _Left, capacity: int) -> tuple[dict[int, int], int]:
    """Pieces by length of a greedily filled sequence, longest first, and the room left."""
    room, limit, taken = capacity, capacity, {}
    while length := left.longest(min(room, limit)):
        taken[length] = min(int(left.counts[length]), room // length)
        room, limit = room - taken[length] * length, length - 1
    return taken, room


def _best_two(left: _Left, taken: dict[int, int], room: int) -> tuple[int, int] | None:
    """The two unpacked lengths that fill the gap without the shortest piece best, if tighter."""
    shortest = min(taken)
    gap = room + shortest
    free = left.counts[: gap + 1].copy()
    for length, count in taken.items():
        if length <= gap:
            free[length] -= count
    longer = np.flatnonzero(free)
    if not len(longer):
        return None
    longest = np.maximum.accumulate(np.where(free > 0, np.arange(gap + 1), 0))
    limit = np.minimum(gap - longer, longer - (free[longer] < 2))
    other = longest[limit]
    sums = np.where(other > 0, longer + other, 0)
    best = int(sums.max())
    if best <= shortest:
        return None
    place = int(np.flatnonzero(sums == best)[-1])
    return int(longer[place]), int(other[place])


def packed_runs(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs of equal sequences that pack `counts` pieces of each length; columns as in `RUN`."""
    left, taken_from, sequence, rows = _Left(counts, capacity), [0] * (capacity + 1), 0, []
    while left.longest(capacity):
        taken, room = _filled(left, capacity)
        needed, used = dict(taken), dict(taken)
        if room and sum(taken.values()) > 1 and (two := _best_two(left, taken, room)):
            used[min(taken)] -= 1
            for length in two:
                needed[length] = needed.get(length, 0) + 1
                used[length] = used.get(length, 0) + 1
        # The same again while the pieces that the choices rest on are there.
        times = min(
            (int(left.counts[length]) - needed[length]) // count + 1
            for length, count in used.items()
            if count
        )
        offset = 0
        for length, count in sorted(used.items(), reverse=True):
            if count:
                rows.append((length, taken_from[length], sequence, count, offset))
                offset += length * count
                taken_from[length] += times * count
                left.take(length, times * count)
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(len(rows), len(RUN))


_PLACED = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
    "sequence_id bigint, offset bigint"
)
_PLACED_ARROW = [
    ("doc_id", pa.int64()),
    ("piece", pa.int32()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
]
# Lengths stand above this bit, numbers of pieces below.
_LENGTH_BIT = 48


def placed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Stored pieces with their sequence and offset."""
    spark = cut.sparkSession
    held_by = stored(cut.groupBy("length", "part").agg(F.count("*").alias("n")))
    # At most a row for each possible length.
    totals = held_by.groupBy("length").agg(F.sum("n").alias("n")).collect()
    shared = spark.sparkContext.broadcast(packed_runs({r.length: r.n for r in totals}, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = stored(
        held_by.select(
            F.col("length").alias("of_length"),
            F.col("part").alias("of_part"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"),
        )
    )
    numbered = cut.join(
        earlier, (F.col("length") == F.col("of_length")) & (F.col("part") == F.col("of_part"))
    ).withColumn("number", F.col("earlier") + F.col("nth"))
    own = ["doc_id", "piece", "start", F.col("length").cast("long"), "ids_crc32", "number"]
    extra = [name for name in ("ids",) if name in cut.columns]
    schema = pa.schema([*_PLACED_ARROW, *((name, pa.binary()) for name in extra)])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        keys = (runs[:, 0] << _LENGTH_BIT) + runs[:, 1]
        for batch in batches:
            length, number = (batch.column(at).to_numpy() for at in (3, 5))
            run = runs[np.searchsorted(keys, (length << _LENGTH_BIT) + number, "right") - 1]
            nth, each = number - run[:, 1], run[:, 3]
            place = [run[:, 2] + nth // each, run[:, 4] + nth % each * length]
            columns = [batch.column(at) for at in range(5)] + [pa.array(p) for p in place]
            yield arrow_rows(schema, columns + [batch.column(6 + at) for at in range(len(extra))])

    columns = ", ".join([_PLACED, *(f"{name} binary" for name in extra)])
    return numbered.select(*own, *extra).mapInArrow(rows, columns)


def packed(
    docs: DataFrame,
    path: str = TOKENIZER,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    with_ids: bool = True,
) -> DataFrame:
    """Every piece with its ids (little-endian 32-bit), sequence and offset there."""
    return placed(pieces(docs, path, end_id, capacity, with_ids), capacity)


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_ids and the offsets at which they begin, from `packed` with ids."""
    schema = pa.schema(
        [
            ("sequence_id", pa.int64()),
            ("ids", pa.list_(pa.int32())),
            ("doc_ids", pa.list_(pa.int64())),
            ("offsets", pa.list_(pa.int64())),
        ]
    )

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (row for b in batches for row in zip(*(column.to_pylist() for column in b.columns)))
        for sequence, group in groupby(every, key=lambda row: row[0]):
            offsets, doc_ids, raw = zip(*(row[1:] for row in group))
            ids = np.frombuffer(b"".join(raw), "<i4")
            yield arrow_rows(schema, [[sequence], [ids], [list(doc_ids)], [list(offsets)]])

    # A sequence holds at most `capacity` pieces.
    dealt = packed_pieces.select("sequence_id", "offset", "doc_id", "ids").repartition("sequence_id")
    return dealt.sortWithinPartitions("sequence_id", "offset").mapInArrow(
        rows, "sequence_id bigint, ids array<int>, doc_ids array<bigint>, offsets array<bigint>"
    )


def packed_digests(docs: DataFrame, path: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Places and checksums of all pieces; ids never leave the task that made them."""
    return packed(docs, path, end_id, with_ids=False)
