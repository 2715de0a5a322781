"""URL filtering by a rule list and by mined association rules, with DataFrame functions only.

Listed rules decide first: a rule fits its host and all subdomains if the path starts with the
rule's, and the longest fitting rule wins. What no listed rule fits is judged by association rules:
combinations of URL tokens that go with a label are mined by Spark's FP-growth, with the label as an
item of its URL, rules below the wanted support or confidence are pruned, and so is a rule when part of
its tokens says the same at least as surely. Whole token sets are mined, less what cannot change the
result: tokens below the support, and ones whose URLs have one label, which are rules by themselves and
in longer ones would be pruned; and tokens that always come together are mined as one and put in again
afterwards. So support and confidence are exact however many tokens a URL has.
The rules left are matched by an inverted index: each is filed under its rarest token, is met through
that token, and applies if all its tokens are there. Of the rules that apply the surest wins, then
the one with more support, fewer tokens, and the first in text order; without any, the label most
URLs have.

Tokens are scheme, host labels, path segments, file ending, names in the query and whether there is
a fragment, with digits made alike. Matching runs over distinct token sets, so a pattern that a third
of all URLs share is judged once; the verdicts come back by a join whose hot keys adaptive execution
splits. Mining is a fit: it takes at most `labelled_rows` labelled URLs, drawn by a hash, with all their
tokens; judging covers every row and every token. FP-growth lists every frequent combination: frequent
tokens of both labels that come and go independently of each other multiply, see the README.

Null URLs, and ones without `://`, have an empty host and path and no tokens; they get the most
frequent label unless a rule fits. Repeated rows are judged alike, URLs of any length are taken
whole, and an empty table gives an empty result. Added columns replace ones of the same name.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.base import folded, stored

ALLOW, BLOCK = "allow", "block"
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.75
LABELLED_ROWS = 500_000
SEED = 3
# Marks a basket's label among its items; no token begins so.
LABEL = "label:"


@dataclass(frozen=True)
class HostRule:
    """Verdict for a host, its subdomains, and paths that start alike; text like `net/`."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | F.endswith(host, F.lit(f".{self.host}"))
        return own & F.startswith(path, F.lit(self.path))


# The rule list of the registered query.
RULES = (
    HostRule(ALLOW, "org/"),
    HostRule(BLOCK, "example.org/es/"),
    HostRule(BLOCK, "example.org/en/1"),
    HostRule(ALLOW, "com/fr/"),
    HostRule(BLOCK, "com/de/"),
)

_URL = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?"


def _part(number: int, url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), _URL, number), F.lit(""))


def located(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add `host` (A-Z lower-cased) and `path`."""
    return pages.withColumns({"host": folded(_part(2, url)), "path": _part(3, url)})


def listed(pages: DataFrame, rules: Sequence[HostRule]) -> DataFrame:
    """Add `rule` and `rule_verdict` of the longest listed rule that fits, else null."""
    by_length = sorted(rules, key=lambda rule: (-len(rule.text), rule.text))
    rule = verdict = F.lit(None).cast("string")
    for one in reversed(by_length):
        fits = one.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, F.lit(one.text)).otherwise(rule)
        verdict = F.when(fits, F.lit(one.verdict)).otherwise(verdict)
    return pages.withColumns({"rule": rule, "rule_verdict": verdict})


def url_tokens(url: str = "url") -> Column:
    """Distinct tokens of a URL in text order; host and path must be there."""

    def marked(mark: str, parts: Column) -> Column:
        alike = F.transform(parts, lambda part: F.regexp_replace(F.lower(part), "[0-9]+", "#"))
        return F.transform(
            F.filter(alike, lambda part: part != ""), lambda part: F.concat(F.lit(mark), part)
        )

    path = F.col("path")
    segments = F.split(F.regexp_replace(path, r"\.[A-Za-z0-9]{1,5}$", ""), "/")
    names = F.transform(
        F.split(F.ltrim(F.lit("?"), _part(4, url)), "&"), lambda pair: F.split_part(pair, F.lit("="), F.lit(1))
    )
    return F.array_sort(
        F.array_distinct(
            F.concat(
                marked("scheme:", F.array(_part(1, url))),
                marked("host:", F.split(F.col("host"), r"\.")),
                marked("path:", segments),
                marked("ending:", F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1))),
                marked("query:", names),
                F.when(_part(5, url) != "", F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
            )
        )
    )


def labelled_sample(labelled: DataFrame, rows: int) -> DataFrame:
    """`tokens` and `label` of at most about `rows` labelled URLs, by hash of URL and the row's salt."""
    known = labelled.where(F.col("label").isNotNull())
    total = known.count()
    if total > rows:
        spread = F.pmod(F.xxhash64("url", "salt"), F.lit(1 << 30))
        known = known.where(spread < int((1 << 30) * rows / total))
    return stored(known.select("tokens", "label"))


def mined_rules(
    sample: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Stored rules: rule_tokens, verdict, confidence, support, and the token they are filed under."""
    total = sample.count()
    schema = (
        "rule_tokens array<string>, verdict string, confidence double, support double, filed string"
    )
    if not total:
        return sample.sparkSession.createDataFrame([], schema)
    alike = stored(sample.groupBy("tokens", "label").agg(F.count("*").alias("n")))
    single = stored(_single(alike, min_support * total))
    tokens = single.select("token", "n")
    pure = _rules(single.where("not mixed"), total, min_confidence)
    # Of tokens that always come together one is mined for all.
    classes = stored(
        single.where("mixed")
        .groupBy("n", "urls", "same_urls")
        .agg(F.min("token").alias("item"), F.sort_array(F.collect_list("token")).alias("members"))
        .select("item", "members")
    )
    # At most tokens-per-URL / min_support names, whatever the size of the input.
    names = [row.item for row in classes.select("item").collect()]
    rules = pure
    if names:
        kept = F.array_intersect(F.col("tokens"), F.lit(names).cast("array<string>"))
        items = F.array_append(kept, F.concat(F.lit(LABEL), F.col("label"))).alias("items")
        baskets = alike.select(items, F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
        model = FPGrowth(itemsCol="items", minSupport=min_support).fit(stored(baskets.select("items")))
        found = _labelled_sets(stored(model.freqItemsets), total, min_confidence)
        rules = pure.unionByName(_expanded(_pruned(stored(found)), classes))
    return _filed(stored(rules), tokens)


def _single(alike: DataFrame, least: float) -> DataFrame:
    """Tokens that some label has `least` times: n, hits by label, and what tells their URLs apart.

    `mixed` ones have URLs of two labels; with others, no further token makes a surer rule.
    """
    one = alike.withColumn("token", F.explode("tokens"))
    hits = one.groupBy("token", "label").agg(
        F.sum("n").alias("hits"),
        F.bit_xor(F.xxhash64("tokens", "label")).alias("urls"),
        F.bit_xor(F.xxhash64(F.lit(SEED), "label", "tokens")).alias("same_urls"),
    )
    return (
        hits.groupBy("token")
        .agg(
            F.sum("hits").alias("n"),
            F.collect_list(F.when(F.col("hits") >= least, F.struct("label", "hits"))).alias("by_label"),
            F.bit_xor("urls").alias("urls"),
            F.bit_xor("same_urls").alias("same_urls"),
        )
        .where(F.size("by_label") > 0)
        .withColumn("mixed", F.exists("by_label", lambda one: one["hits"] < F.col("n")))
    )


def _rules(single: DataFrame, total: int, min_confidence: float) -> DataFrame:
    """Rules of one token."""
    one = single.select(F.array("token").alias("rule_tokens"), "n", F.explode("by_label").alias("one"))
    return _sure(one.select("rule_tokens", "n", "one.label", "one.hits"), total, min_confidence)


def _sure(counted: DataFrame, total: int, min_confidence: float) -> DataFrame:
    confidence = F.col("hits") / F.col("n")
    return counted.where(confidence >= min_confidence).select(
        "rule_tokens",
        F.col("label").alias("verdict"),
        confidence.alias("confidence"),
        (F.col("hits") / F.lit(total)).alias("support"),
    )


def _labelled_sets(sets: DataFrame, total: int, min_confidence: float) -> DataFrame:
    """Rules from frequent sets: those with a label over those of the same tokens without."""

    def is_label(item: Column) -> Column:
        return F.startswith(item, F.lit(LABEL))

    with_label, without = F.filter("items", is_label), F.filter("items", lambda item: ~is_label(item))
    parted = sets.select(
        F.array_sort(without).alias("rule_tokens"), F.get(with_label, F.lit(0)).alias("label"), "freq"
    )
    plain = parted.where("label is null").select(
        F.col("rule_tokens").alias("plain_tokens"), F.col("freq").alias("n")
    )
    label = F.substring("label", len(LABEL) + 1, 1 << 20).alias("label")
    rows = parted.where("label is not null").join(plain, F.col("rule_tokens") == F.col("plain_tokens"))
    return _sure(rows.select("rule_tokens", "n", label, F.col("freq").alias("hits")), total, min_confidence)


def _expanded(rules: DataFrame, classes: DataFrame) -> DataFrame:
    """Each rule once for every choice of a token from the class of each of its items."""
    spread = rules.withColumn("own", F.explode("rule_tokens"))
    met = spread.join(classes, F.col("own") == F.col("item")).groupBy(*rules.columns)
    chosen = F.aggregate(
        F.collect_list("members"),
        F.array(F.array().cast("array<string>")),
        lambda begun, members: F.flatten(
            F.transform(begun, lambda one: F.transform(members, lambda token: F.array_append(one, token)))
        ),
    )
    named = met.agg(chosen.alias("choices")).withColumn("choice", F.explode("choices"))
    rest = [name for name in rules.columns if name != "rule_tokens"]
    return named.select(F.array_sort("choice").alias("rule_tokens"), *rest)


def _parts(level: DataFrame) -> DataFrame:
    """Each row once for every token, with `part`, the other tokens."""
    others = F.transform("rule_tokens", lambda t: F.array_remove(F.col("rule_tokens"), t))
    return level.withColumn("part", F.explode(others))


def _containing(rows: DataFrame, filed: DataFrame) -> DataFrame:
    """Each filed row once for every row of `rows` that has all its tokens."""
    return (
        rows.withColumn("filed", F.explode("tokens"))
        .join(filed, "filed")
        .where(F.size(F.array_except("rule_tokens", "tokens")) == 0)
    )


def _pruned(rules: DataFrame) -> DataFrame:
    """Rules without those of which one token less says the same at least as surely."""
    parts = _parts(rules).select("rule_tokens", "verdict", "confidence", "part")
    simpler = rules.select(
        F.col("rule_tokens").alias("part"),
        F.col("verdict").alias("part_verdict"),
        F.col("confidence").alias("part_confidence"),
    )
    needless = parts.join(
        simpler,
        (parts["part"] == simpler["part"])
        & (F.col("verdict") == F.col("part_verdict"))
        & (F.col("part_confidence") >= F.col("confidence")),
        "left_semi",
    ).select(F.col("rule_tokens").alias("gone"), F.col("verdict").alias("gone_verdict"))
    return rules.join(
        needless,
        (F.col("rule_tokens") == F.col("gone")) & (F.col("verdict") == F.col("gone_verdict")),
        "left_anti",
    )


def _filed(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Add the rarest token of each rule, the one the index files it under."""
    spread = rules.withColumn("member", F.explode("rule_tokens"))
    rarest = F.min_by("member", F.struct("n", "member")).alias("filed")
    return stored(
        spread.join(tokens, F.col("member") == F.col("token")).groupBy(*rules.columns).agg(rarest)
    )


def matched(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """`tokens` and the verdict of the best rule that applies, for token sets with one."""
    met = _containing(token_sets, rules)
    rank = F.struct(
        -F.col("confidence"), -F.col("support"), F.size("rule_tokens"), "rule_tokens", "verdict"
    )
    return met.groupBy("tokens").agg(F.min_by("verdict", rank).alias("mined_verdict"))


def judged(
    pages: DataFrame,
    rules: Sequence[HostRule] = RULES,
    labelled: DataFrame | None = None,
    labelled_rows: int = LABELLED_ROWS,
    **mining,
) -> DataFrame:
    """Every page with host, path, the listed rule if one fits, and the verdict.

    `labelled` has `url` and `label`; without it the pages that a listed rule fits are the labelled
    ones, and the mined rules carry the list's judgement over to the others.
    """
    added = ("host", "path", "rule", "rule_verdict", "tokens", "mined_verdict", "verdict")
    own = pages.drop(*added)
    at = listed(located(own), rules).withColumn("tokens", url_tokens())
    # Rows of one URL are drawn one by one: by page id or, where there is none, by a number of the row.
    drawn = F.rand(SEED)
    if labelled is None:
        if "page_id" in own.columns:
            drawn = F.coalesce(F.col("page_id").cast("string"), drawn.cast("string"))
        known = at.select("url", "tokens", drawn.alias("salt"), F.col("rule_verdict").alias("label"))
    else:
        rows = stored(labelled.select("url", "label").withColumn("salt", drawn))
        known = located(rows).withColumn("tokens", url_tokens())
    sample = labelled_sample(known, labelled_rows)
    usual = (
        sample.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").first()
    )
    usual = usual.label if usual else ALLOW
    open_sets = at.where(F.col("rule").isNull()).select("tokens").distinct()
    verdicts = stored(matched(open_sets, mined_rules(sample, **mining))).withColumnRenamed(
        "tokens", "verdict_tokens"
    )
    found = F.coalesce("rule_verdict", "mined_verdict", F.lit(usual))
    return (
        at.join(
            verdicts, F.col("rule").isNull() & (F.col("tokens") == F.col("verdict_tokens")), "left"
        )
        .withColumn("verdict", found)
        .drop("rule_verdict", "tokens", "verdict_tokens", "mined_verdict")
    )
