import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm.language_id import (
    LanguageModel,
    Scorer,
    fit,
    held_out,
    identified,
    in_known_languages,
)

PIECES = {
    "en": ["the", "th", "ing", "er", "and", "wh", "ould", "ly"],
    "fr": ["le", "eau", "eux", "que", "ment", "é", "ou", "oi"],
    "de": ["der", "ung", "sch", "ein", "keit", "ü", "ch", "tz"],
}


def text(lang, rng, n):
    return " ".join("".join(rng.choices(PIECES[lang], k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    langs = ["en"] * 4 + ["fr", "de"]
    return [(n, text(langs[n % 6], rng, rng.randint(3, 60)), langs[n % 6]) for n in range(600)]


def test_held_out_documents_are_told(docs, rows):
    truth = {doc_id: lang for doc_id, _, lang in rows}
    got = identified(docs(rows, ("score", "spread", "lang_pred"))).collect()
    assert {r.doc_id for r in got} == set(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    unseen = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in unseen]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_nothing_is_learned_from_held_out_documents(docs, rows):
    changed = [
        (d, t, "zz" if zlib.crc32(str(d).encode()) % 5 == 0 else lang) for d, t, lang in rows
    ]
    assert {r.lang_pred for r in identified(docs(changed)).collect()} <= set(PIECES)
    assert sorted(identified(docs(changed)).collect()) == sorted(identified(docs(rows)).collect())


def by_hand(model, text):
    """Word by word, as the method says."""
    total, said, chances = np.zeros(len(model.languages)), 0, np.zeros(len(model.languages))
    for word in __import__("re").findall(r"[^\W\d_]+", text.lower()):
        scores = None
        if word in model.words:
            scores = model.word_scores[model.words[word]]
        else:
            marked = f"^{word}$"
            for order in range(5, 0, -1):
                pieces = [marked[i : i + order] for i in range(len(marked) - order + 1)]
                known = [model.ngram_scores[model.ngrams[p]] for p in pieces if p in model.ngrams]
                if known:
                    scores = np.mean(known, axis=0)
                    break
        if scores is not None:
            total += scores
            weights = np.exp(scores - scores.max())
            chances += weights / weights.sum()
            said += 1
    return total, chances, said


def test_words_first_then_shorter_ngrams(docs, rows):
    model = fit(docs(rows), max_words=50, max_ngrams=400)
    assert len(model.words) == 50 and len(model.ngrams) == 400
    scorer = Scorer(model, seen_words=40)  # so small that it forgets again and again
    texts = [t + " zq zqzq ωω" for _, t, _ in rows[:60]]
    names, scores = scorer.predict(texts)
    for name, score, text in zip(names, scores, texts):
        total, chances, said = by_hand(model, text)
        best = int(total.argmax())
        assert name == model.languages[best]
        assert score == pytest.approx(chances[best] / said)


def test_log_frequencies_are_smoothed_counts(docs):
    model = fit(docs([(1, "a a b", "x"), (2, "b", "y")]))
    assert model.languages == ["x", "y"]
    a = model.word_scores[model.words["a"]]
    assert a == pytest.approx(np.log([2.5 / (3 + 1), 0.5 / (1 + 1)]))


def test_the_sample_is_bounded_per_language(docs, rows):
    full, small = fit(docs(rows)), fit(docs(rows), docs_per_language=20)
    assert small.languages == full.languages == ["en", "de", "fr"]
    assert 0 < len(small.words) < len(full.words)


ODD = [
    (1, None, None),
    (2, "", "en"),
    (3, "123 ² ½ !!", None),
    (None, "the and thing", "en"),
    (4, "中文", None),
    (5, "ing" * 100_000, None),
    (5, "the the", None),
]


def test_odd_texts(docs, rows):
    got = {(r.doc_id, r.lang_pred): r for r in identified(docs(rows + [(10**6 + (d or 0) if d else None, t, l) for d, t, l in ODD])).collect()}
    by_id = {}
    for (doc_id, lang), row in got.items():
        by_id.setdefault(doc_id, []).append(row)
    for doc_id in (1, 2, 3):
        (row,) = by_id[10**6 + doc_id]
        assert (row.lang_pred, row.score) == ("und", 0.0)
    assert by_id[None][0].lang_pred == "en" and by_id[None][0].held_out
    assert by_id[10**6 + 4][0].lang_pred in PIECES and by_id[10**6 + 4][0].score == 0


def test_words_that_all_languages_repeat_do_not_cost_a_document(docs, rows):
    hot = [(d, f"{t} {'zwo dri ' * 200}", lang) for d, t, lang in rows]
    assert in_known_languages(docs(hot)).count() == len(hot)


UNLEARNED = (
    "La lingvo Esperanto estas konstruita lingvo kiu celas faciligi komunikadon inter homoj de malsamaj "
    "landoj kaj estis kreita de Ludoviko Zamenhof en la jaro mil okcent okdek sep"
)


def test_gibberish_and_unlearned_languages_go(docs, rows):
    rng = random.Random(2)
    random_words = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(n))
    planted = [(9_000 + n, random_words(3 * n + 4)) for n in range(20)] + [(9_100, UNLEARNED), (9_101, UNLEARNED * 50)]
    planted += [(9_200, "ing ing ing " * 2_000), (9_201, "The the. THE!"), (9_202, "ould erly thing whing " * 9)]
    kept = {r.doc_id for r in in_known_languages(docs(rows + planted)).collect()}
    assert kept == {d for d, *_ in rows} | {9_200, 9_201, 9_202}


def test_evidence_counts_distinct_words(docs, rows):
    model = fit(docs(rows), max_words=50)
    texts = [t + " zqxj zqxj wvkq" for _, t, _ in rows[:40]]
    for (n, sure), text in zip(Scorer(model, seen_words=30).judge(texts)[2], texts):
        words = set(__import__("re").findall(r"[^\W\d_]+", text.lower()))
        marked = {w: f"^{w}$" for w in words}
        known = {
            w for w, m in marked.items()
            if w in model.words or any(m[i : i + min(5, len(m))] in model.ngrams for i in range(max(1, len(m) - 4)))
        }
        assert (n, sure) == (len(words), len(known))


def test_without_labels_or_rows(docs):
    assert {r.lang_pred for r in identified(docs([(1, "some text"), (2, None)])).collect()} == {"und"}
    assert identified(docs([])).collect() == []
    assert Scorer(LanguageModel()).predict(["a"]) == (["und"], [0.0])


def test_filter_keeps_columns_and_clean_documents(docs, rows):
    frame = docs(rows + [(9_001, "12 34"), (9_002, None), (9_003, "漢字 中文")], ("score",))
    kept = in_known_languages(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [d for d, *_ in rows]


def test_held_out_rule(spark):
    frame = spark.range(50).select("id", held_out(F.col("id")).alias("h"))
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in frame.collect())
