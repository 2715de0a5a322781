import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tillroll.llm import url_filter
from tillroll.llm.url_filter import ALLOW, BLOCK, RULES, HostRule, judged, labelled_sample, located, mined_rules, url_tokens

SCHEMA = "page_id bigint, url string"


@pytest.fixture
def pages(spark):
    return lambda rows, schema=SCHEMA: spark.createDataFrame(rows, schema).repartition(2)


PARTS = {
    None: ("", ""),
    "": ("", ""),
    "no scheme/here": ("", ""),
    "http://A.Example.ORG": ("a.example.org", ""),
    "http://a.org/x/y?q#f": ("a.org", "/x/y"),
    "http://a.org?x/y": ("a.org", ""),
    "http://a.org#x/y": ("a.org", ""),
    "x://y://z/w": ("y:", "//z/w"),
    "://h/p": ("h", "/p"),
    "http://É.org/É": ("É.org", "/É"),
    "http://a.org/line\nbreak?q": ("a.org", "/line\nbreak"),
}


def test_host_and_path(pages):
    rows = located(pages(list(enumerate(PARTS)))).collect()
    assert {r.url: (r.host, r.path) for r in rows} == PARTS


def listed_by_hand(host, path, rules=RULES):
    fitting = [
        rule
        for rule in rules
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)
    ]
    return max(fitting, key=lambda rule: len(rule.text), default=None)


CASES = [
    "http://org/", "http://x.org/", "http://xorg/", "http://x.org", "http://x.org?/",
    "http://example.org/es/1", "http://a.example.org/es/1", "http://myexample.org/es/1",
    "http://example.org/en/1", "http://example.org/en/123", "http://example.org/en/2",
    "http://a.com/fr/1", "http://a.com/de/1", "http://a.com/en/1", "http://A.COM/de/", "http://a.com/DE/",
]


def test_the_longest_listed_rule_wins(pages):
    for row in judged(pages(list(enumerate(CASES)), SCHEMA)).collect():
        rule = listed_by_hand(row.host, row.path)
        assert row.rule == (rule and rule.text), row.url
        if rule:
            assert row.verdict == rule.verdict


def mined_by_hand(baskets, support, confidence):
    """All token sets with the label they go with, by counting; then pruned."""
    counts, with_label = {}, {}
    for tokens, label in baskets:
        for size in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), size):
                counts[part] = counts.get(part, 0) + 1
                with_label[part, label] = with_label.get((part, label), 0) + 1
    least = support * len(baskets)
    rules = {
        key: n / counts[key[0]] for key, n in with_label.items() if n >= least and n / counts[key[0]] >= confidence
    }
    return {
        key: sure
        for key, sure in rules.items()
        if not any(
            rules.get((tuple(t for t in key[0] if t != gone), key[1]), -1) >= sure for gone in key[0]
        )
    }


@pytest.fixture(scope="module")
def baskets():
    rng = random.Random(4)
    made = []
    for _ in range(400):
        tokens = {t for t in "abcdef" if rng.random() < 0.5} or {"a"}
        bad = {"a", "b"} <= tokens or "f" in tokens and rng.random() < 0.8
        made.append((sorted(tokens), BLOCK if bad else ALLOW))
    return made


def test_mined_rules_are_those_counting_gives(spark, baskets):
    sample = spark.createDataFrame(baskets, "tokens array<string>, label string")
    got = mined_rules(sample, 0.02, 0.7).collect()
    expected = mined_by_hand(baskets, 0.02, 0.7)
    assert {(tuple(r.rule_tokens), r.verdict) for r in got} == set(expected)
    for row in got:
        assert row.confidence == pytest.approx(expected[tuple(row.rule_tokens), row.verdict])
        assert row.filed in row.rule_tokens


def test_rules_hold_for_whole_urls_of_many_tokens(spark):
    """Twelve frequent tokens a URL: eleven that tell much, and one that is rarely the first ten's."""
    rng = random.Random(5)
    made = []
    for n in range(600):
        bad = rng.random() < 0.5
        odds = 0.9 if bad else 0.6
        tokens = {f"t{k:02d}" for k in range(12) if rng.random() < odds} | {"z"}
        if rng.random() < 0.3:
            tokens.add("q" if bad == (n % 5 > 0) else "r")
        made.append((sorted(tokens), BLOCK if bad else ALLOW))
    sample = spark.createDataFrame(made, "tokens array<string>, label string")
    rows = mined_rules(sample, 0.2, 0.6).collect()
    got = {(tuple(r.rule_tokens), r.verdict): r.confidence for r in rows}
    assert got == pytest.approx(mined_by_hand(made, 0.2, 0.6))


def test_long_urls_that_are_alike_do_not_multiply(spark):
    """Sixty tokens that only come together have more combinations than can be listed."""
    long = [f"t{k:02d}" for k in range(60)]
    made = [(long + ["u"] * (n % 2), BLOCK if n % 4 == 1 else ALLOW) for n in range(100)]
    sample = spark.createDataFrame(made, "tokens array<string>, label string")
    rows = mined_rules(sample, 0.1, 0.7).collect()
    assert {(tuple(r.rule_tokens), r.verdict, r.confidence) for r in rows} == {
        ((token,), ALLOW, 0.75) for token in long
    }


def test_verdicts_against_brute_force(pages):
    """Labels by listed rules, tokens mined, and the best rule by looking at all of them."""
    rng = random.Random(9)
    rows = [
        (n, f"http{'s' * (n % 2)}://{rng.choice(['a', 'b'])}.example.{rng.choice(['org', 'com', 'net'])}"
            f"/{rng.choice(['en', 'fr', 'de', 'es'])}/{n}{rng.choice(['', '/', '.html'])}")
        for n in range(500)
    ]
    frame = pages(rows)
    tokens = {r.page_id: r.t for r in located(frame).select("page_id", url_tokens().alias("t")).collect()}
    got = {r.page_id: r for r in judged(frame).collect()}
    known = [(tokens[n], got[n].verdict) for n in got if got[n].rule]
    rules = mined_by_hand(known, url_filter.MIN_SUPPORT, url_filter.MIN_CONFIDENCE)
    support = {key: sum(set(key[0]) <= set(t) and label == key[1] for t, label in known) for key in rules}
    usual = max((ALLOW, BLOCK), key=lambda label: sum(v == label for _, v in known))
    for n, row in got.items():
        if row.rule is None:
            fitting = [key for key in rules if set(key[0]) <= set(tokens[n])]
            best = min(fitting, key=lambda k: (-rules[k], -support[k], len(k[0]), k), default=None)
            assert row.verdict == (best[1] if best else usual)


def test_labels_from_a_table(pages):
    labels = [(f"http://x.net/{'bad' if n % 2 else 'good'}/{n}", BLOCK if n % 2 else ALLOW) for n in range(60)]
    frame = pages([(1, "http://y.net/bad/7"), (2, "http://y.net/good/7"), (3, "http://q.info/")])
    got = judged(frame, (), pages(labels, "url string, label string"))
    assert {r.page_id: r.verdict for r in got.collect()} == {1: BLOCK, 2: ALLOW, 3: ALLOW}


def test_the_labelled_sample_is_bounded(pages):
    frame = pages([(n, "http://hot.org/") for n in range(2_000)]).select(
        "url", F.col("page_id").alias("salt"), F.array(F.lit("t")).alias("tokens"), F.lit("x").alias("label")
    )
    assert 100 < labelled_sample(frame, 200).count() < 300
    assert labelled_sample(frame, 5_000).count() == 2_000


@pytest.mark.parametrize("given", [True, False])
def test_rows_of_a_hot_url_are_drawn_one_by_one(pages, monkeypatch, given):
    """A third of the labels on one URL, from a table of labels and from pages without an id."""
    urls = [f"http://{'hot' if n % 3 == 0 else f'h{n}'}.net/" for n in range(3_000)]
    labels = pages([(url, BLOCK) for url in urls], "url string, label string")
    taken = []
    draw = url_filter.labelled_sample
    monkeypatch.setattr(url_filter, "labelled_sample", lambda *a: taken.append(draw(*a)) or taken[-1])
    if given:
        judged(pages([(1, "http://y.net/")]), (), labels, labelled_rows=600)
    else:
        judged(labels.select("url"), (HostRule(BLOCK, "net/"),), labelled_rows=600)
    sample = taken[0]
    assert 480 < sample.count() < 720
    assert 140 < sample.where(F.array_contains("tokens", "host:hot")).count() < 260


def test_odd_rows_and_clashing_columns(pages):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "http://a.org/", "x"), (4, "http://a.net/" + "y/" * 20_000, "x")]
    frame = pages(rows, "page_id bigint, url string, label string").withColumns(
        {name: F.lit("clash") for name in ("host", "rule", "verdict", "tokens", "rule_verdict", "salt")}
    )
    got = judged(frame).collect()
    assert len(got) == len(rows)
    assert {(r.page_id, r.host, r.rule, r.verdict) for r in got if (r.page_id or 0) < 4} == {
        (1, "", None, ALLOW),
        (2, "", None, ALLOW),
        (None, "a.org", "org/", ALLOW),
    }


def test_empty_table(pages):
    assert judged(pages([])).collect() == []


def test_no_python_in_the_plan(pages):
    plan = judged(pages(list(enumerate(CASES))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rule_text():
    rule = HostRule(BLOCK, "example.org/en/1")
    assert (rule.host, rule.path) == ("example.org", "/en/1")
