"""Language identification, words first.

A known word is scored by its log frequency in each language. An unseen word falls back to its
character n-grams (the word's ends marked), the longest order of which any is known, down to single
characters; it counts as one observation, the mean over its known n-grams. A word without any known
n-gram says nothing. The language with the highest sum is predicted, ties going to the one with more
labelled documents and then to the first in text order. The score is the mean, over the words that say
something, of the probability that the word gives to that language; 0 if none does.

The classifier is fitted on a bounded sample, at most about `docs_per_language` labelled documents
of each language picked by a hash of the id, and keeps the `max_words` most frequent words and
`max_ngrams` most frequent n-grams; counting is a Spark aggregate over the sample. The model is some
megabytes whatever the input, and is broadcast. Every whole text is predicted in one pass without a
shuffle, whatever its length.

A text that is null, empty or without a letter is `und` with score 0, as is everything when there
are no labelled rows. Rows are judged one by one, so repeats agree and an empty table gives an empty
result. Columns beside doc_id, text and lang are not looked at, whatever their names; the filter keeps
them as they are.
"""

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.base import arrow_rows, held, stored, text_or_empty, text_slices

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 4_000
MAX_WORDS = 60_000
MAX_NGRAMS = 60_000
LONGEST_NGRAM = 5
SMOOTHING = 0.5
SEEN_WORDS = 150_000
SLICE_CHARS = 2_000_000
MIN_SURE = 0.5
FEW_WORDS = 3
# Languages are told apart by columns of a table; more labels than this are something else.
MAX_LANGUAGES = 1_000

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of the id as text divides by five."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


@dataclass
class LanguageModel:
    """Languages by rank; words and n-grams with their row in a table of log frequencies."""

    languages: list[str] = field(default_factory=list)
    words: dict[str, int] = field(default_factory=dict)
    word_scores: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    ngrams: dict[str, int] = field(default_factory=dict)
    ngram_scores: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))

    def known_ngrams(self, word: str) -> tuple[list[int], bool]:
        """Rows of the word's n-grams of the longest order of which any is known; whether none is longer."""
        marked, ngrams = f"^{word}$", self.ngrams
        longest = min(LONGEST_NGRAM, len(marked))
        for order in range(longest, 0, -1):
            pieces = [marked[at : at + order] for at in range(len(marked) - order + 1)]
            found = [row for row in map(ngrams.get, pieces) if row is not None]
            if found:
                return found, order == longest
        return [], False

    def unseen_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word the mean over its known n-grams, zeros if there are none; and whether any of
        the longest order is known."""
        known = [self.known_ngrams(word) for word in words]
        rows = [found for found, _ in known]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        scores = np.zeros((len(words), len(self.languages)))
        if sizes.any():
            flat = np.fromiter(chain.from_iterable(rows), np.int64, int(sizes.sum()))
            starts = np.cumsum(sizes[sizes > 0]) - sizes[sizes > 0]
            sums = np.add.reduceat(self.ngram_scores[flat], starts, axis=0)
            scores[sizes > 0] = sums / sizes[sizes > 0, None]
        return scores, np.fromiter((sure for _, sure in known), bool, len(known))


def _probabilities(scores: np.ndarray) -> np.ndarray:
    weights = np.exp(scores - scores.max(axis=1, keepdims=True))
    return weights / weights.sum(axis=1, keepdims=True)


class Scorer:
    """Scores texts, every distinct word of a slice once.

    Row 0 of the table is for words that say nothing. Known words have rows for good, unseen ones
    until the table is full; then they are worked out anew.
    """

    def __init__(self, model: LanguageModel, seen_words: int = SEEN_WORDS):
        self.model, self.n = model, len(model.languages)
        self.lasting = len(model.words) + 1
        self.table = np.zeros((self.lasting + seen_words, 2 * self.n))
        self.sure = np.zeros(len(self.table), bool)
        self.sure[1 : self.lasting] = True
        self.places: dict[str, int] = {}
        if model.words:
            scores = model.word_scores
            self.table[1 : self.lasting] = np.hstack([scores, _probabilities(scores)])
        self._forget()

    def _forget(self) -> None:
        self.places = {word: row + 1 for word, row in self.model.words.items()}
        self.next = self.lasting

    def _rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A row for each distinct word, in the table or in the extra rows behind it, and which are sure."""
        found = list(map(self.places.get, words))
        missing = [place for place, row in enumerate(found) if row is None]
        extra, sure = np.empty((0, 2 * self.n)), np.empty(0, bool)
        if missing:
            scores, sure = self.model.unseen_scores([words[place] for place in missing])
            extra = np.hstack([scores, _probabilities(scores)])
            said = scores.any(axis=1)
            room = len(self.table) - self.next
            if len(missing) > room and self.next > self.lasting:
                self._forget()
                return self._rows(words)
            kept = min(room, len(missing))
            self.table[self.next : self.next + kept] = extra[:kept]
            self.sure[self.next : self.next + kept] = sure[:kept]
            for number, place in enumerate(missing):
                if not said[number]:
                    found[place] = 0
                else:
                    found[place] = self.next + number if number < kept else len(self.table) + number
                if number < kept:
                    self.places[words[place]] = found[place]
            self.next += kept
        rows = np.fromiter(found, np.int64, len(found))
        flags = self.sure[np.minimum(rows, len(self.table) - 1)]
        beyond = rows >= len(self.table)
        flags[beyond] = sure[rows[beyond] - len(self.table)]
        return rows, extra, flags

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        names, scores, _ = self.judge(texts)
        return names, scores

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float], list[tuple[int, int]]]:
        """Language, score, and (distinct words, how many of them are sure) of each text.

        A word is sure if it is known, or one of its n-grams of the longest order.
        """
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        evidence = [(0, 0)] * len(texts)
        if not self.n:
            return names, scores, evidence
        found = [_WORD.findall(text.lower()) if text else [] for text in texts]
        spoken = [
            place
            for place, words in enumerate(found)
            if any(any(map(str.isalpha, word)) for word in words)
        ]
        if not spoken:
            return names, scores, evidence
        flat = pa.array([w for place in spoken for w in found[place]], pa.large_string())
        encoded = flat.dictionary_encode()
        distinct = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        rows, extra, sure = self._rows(distinct)
        beyond = rows >= len(self.table)
        values = self.table[np.where(beyond, 0, rows)]
        values[beyond] = extra[rows[beyond] - len(self.table)]
        numbers = encoded.indices.to_numpy()
        bounds = np.cumsum([0, *(len(found[place]) for place in spoken)])
        for place, start, end in zip(spoken, bounds, bounds[1:]):
            own = numbers[start:end]
            counts = np.bincount(own) if end - start > len(distinct) else None
            total = counts @ values[: len(counts)] if counts is not None else values[own].sum(axis=0)
            said = int(np.count_nonzero(rows[own]))  # words, repeats counted
            best = int(total[: self.n].argmax())
            names[place] = self.model.languages[best]
            own = np.flatnonzero(counts) if counts is not None else np.unique(own)
            evidence[place] = (len(own), int(np.count_nonzero(sure[own])))
            scores[place] = float(min(1.0, total[self.n + best] / said)) if said else 0.0
        return names, scores, evidence


def labelled_sample(docs: DataFrame, per_language: int) -> tuple[DataFrame, list[str]]:
    """Sampled lang and text, and the languages by number of labelled documents."""
    known = docs.select(
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("doc_id").cast("string")).alias("spread"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    found = {row.lang: row.n for row in counts.limit(MAX_LANGUAGES + 1).collect()}
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"lang has more than {MAX_LANGUAGES} values")
    bounds = {lang: int((1 << 30) * min(1.0, per_language / n)) for lang, n in found.items()}
    bound = F.lit(0)
    for lang, limit in bounds.items():
        bound = F.when(F.col("lang") == lang, limit).otherwise(bound)
    sample = known.where(F.pmod("spread", F.lit(1 << 30)) < bound).select("lang", "text")
    return sample, list(found)


def _frequencies(
    counts: DataFrame, name: str, languages: list[str], most: int
) -> tuple[dict[str, int], np.ndarray]:
    """The most frequent items with their row in a table of smoothed log frequencies."""
    per_item = (
        counts.groupBy(name)
        .agg(
            F.sum("n").alias("total"),
            F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_language"),
        )
        .orderBy(F.desc("total"), name)
        .limit(most)
        .collect()
    )
    totals = {row.lang: row.n for row in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    sizes = np.array([totals.get(language, 0) for language in languages], float)
    found = np.array([[r.by_language.get(lang, 0) for lang in languages] for r in per_item], float)
    found = found.reshape(len(per_item), len(languages))
    scores = np.log((found + SMOOTHING) / (sizes + SMOOTHING * max(1, len(per_item))))
    return {row[name]: place for place, row in enumerate(per_item)}, scores


def fit(
    docs: DataFrame,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    max_words: int = MAX_WORDS,
    max_ngrams: int = MAX_NGRAMS,
) -> LanguageModel:
    """A model from labelled documents (doc_id, text, lang)."""
    sample, languages = labelled_sample(docs, docs_per_language)
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"))
    words = stored(
        sample.select("lang", F.explode(found).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )
    marked = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    starts = F.sequence(F.lit(1), F.length(marked))
    orders = F.array(*(F.lit(order) for order in range(1, LONGEST_NGRAM + 1)))
    ngrams = stored(
        words.select("lang", "n", marked.alias("marked"), F.explode(starts).alias("start"))
        .select("lang", "n", "marked", "start", F.explode(orders).alias("size"))
        .where(F.col("start") + F.col("size") - 1 <= F.length("marked"))
        .select("lang", "n", F.substring("marked", F.col("start"), F.col("size")).alias("ngram"))
        .where(~F.col("ngram").isin("^", "$"))
        .groupBy("lang", "ngram")
        .agg(F.sum("n").alias("n"))
    )
    return LanguageModel(
        languages,
        *_frequencies(words, "word", languages, max_words),
        *_frequencies(ngrams, "ngram", languages, max_ngrams),
    )



def _scorer(model: LanguageModel) -> Scorer:
    """Kept from task to task; it holds the model, so no other can have the same identity."""
    return held(("language", id(model)), lambda: Scorer(model))


def predicted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared.value)
        for part, texts in text_slices(batches, chars=SLICE_CHARS):
            yield arrow_rows(schema, [part.column(0), *scorer.predict(texts)])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(rows, "doc_id bigint, lang_pred string, score double")


def identified(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, held_out, lang_pred and score, learned from the documents that are not held out."""
    learned = docs.where(~held_out(F.col("doc_id")))
    found = predicted(docs, fit(learned, **limits))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def in_known_languages(
    docs: DataFrame, min_sure: float = MIN_SURE, few_words: int = FEW_WORDS, **limits
) -> DataFrame:
    """The documents, all columns, in a language that is learned.

    Learned from the same documents, but for the held-out ones. A text goes if it has no letter or
    nothing in common with a learned language, and if less than `min_sure` of its distinct words are
    sure: known, or with a known n-gram of the longest order. So gibberish and languages that no label
    names go, and text that repeats a few words all languages have stays, though its score is low. A
    text of less than `few_words` distinct words is not judged by them. Without labelled rows no text
    is in a learned language.
    """
    model = fit(docs.where(~held_out(F.col("doc_id"))), **limits)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared.value)
        for part, texts in text_slices(batches, place, SLICE_CHARS):
            good = [
                name != UNKNOWN and score > 0 and (n < few_words or sure >= min_sure * n)
                for name, score, (n, sure) in zip(*scorer.judge(texts))
            ]
            yield part.filter(pa.array(good))

    return docs.mapInArrow(rows, docs.schema)
