"""Mixing sources to target weights by temperature, with DataFrame functions only.

The share of tokens of each source is raised to an exponent and normalised: 0 makes all sources equal,
1 leaves them as they are, larger ones favour large sources. The exponent is found by bisection: the
smallest at which the entropy of the weights is at most the target, but none at which a source is
repeated more often than the limit allows. Where the two exclude each other the limit wins. Each round
is one aggregate over the per-source totals, which stay a table.

The weights become whole budgets that add up to the budget, and are realised to the token. A source
with budget b and t tokens is taken whole `b div t` times; the rest comes from one more epoch, in which
its documents stand in the order of an MD5 permutation and are taken while their running sum fits. The
permutation is cut into blocks by the first digits of the key. Blocks combine to sums before any
shuffle, and the block in which a source's budget ends is found level by level; only that one is summed
key by key, so a hot source is never gathered in one task. What is left of all this is one cutoff key
per source, and the documents are passed once more, row by row.

A null source is a source of its own. Null texts count as empty. Without an id a document's place
comes from its text. Documents that tie in the permutation are taken or left together, and count as one
key with their sum. Sources without tokens get no weight and lose their documents; an empty table gives
an empty mixture. All columns of the documents are kept unless they have the names of the added ones,
which replace them; those names can be chosen.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.base import stored, text_or_empty

ENTROPY_SHARE = 0.95
MAX_REPEATS = 4.0
SEED = "mix-1"
ROWS_PER_BLOCK = 512
# Hexadecimal digits of a key that one level of blocks stands for.
DIGITS = 2
CHILDREN = 16**DIGITS
# Exponents are tried in steps of 1 / GRID up to LARGEST, about PARTS of them in a round.
GRID = 1 << 20
LARGEST = 64
PARTS = 32


def token_count(text: Column) -> Column:
    """Runs of characters other than blank, tab and line ends."""
    return F.regexp_count(text, F.lit("[^ \\t\\n\\r]+")).cast("long")


def permutation_key(seed: str, epoch: Column, identity: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), identity))


def _identity() -> Column:
    text_key = F.concat(F.lit("text:"), F.md5(text_or_empty().cast("binary")))
    return F.coalesce(F.col("doc_id").cast("string"), text_key)


def _measures(shares: DataFrame, steps: list[int], budget: int) -> dict[int, tuple[float, float]]:
    """Entropy of the weights and repetition of the most repeated source at each exponent.

    Exponents are whole numbers of `1 / GRID`; all are measured in one aggregate.
    """
    step = F.explode(F.array(*(F.lit(step) for step in sorted(set(steps)))))
    powered = shares.withColumn("step", step).withColumn(
        "powered", F.pow("share", F.col("step") / F.lit(float(GRID)))
    )
    logs = F.when(F.col("powered") > 0, F.col("powered") * F.ln("powered")).otherwise(0.0)
    rows = powered.groupBy("step").agg(
        F.sum("powered").alias("z"),
        F.sum(logs).alias("logs"),
        F.max(F.col("powered") / F.col("tokens")).alias("densest"),
    )
    return {
        row.step: (math.log(row.z) - row.logs / row.z, budget * row.densest / row.z)
        for row in rows.collect()
    }


def bisected_exponent(shares: DataFrame, entropy: float, repeats: float, budget: int) -> float:
    """The exponent for a target entropy, within the repetition limit.

    Entropy falls with the exponent; repetition is least at 1 and grows to both sides. The smallest
    exponent with at most the target entropy is taken, the largest possible one if none has it. Where
    some source would then be repeated too often, the limit wins: the exponent is the nearest that
    keeps it. Each round measures some steps inside all three brackets at once.
    """

    def flat(measured: tuple[float, float]) -> bool:
        return measured[0] <= entropy + 1e-12

    def kept(measured: tuple[float, float]) -> bool:
        return measured[1] <= repeats + 1e-12

    # (step below, step at or above) the first step at which the test holds.
    brackets = [(-1, LARGEST * GRID, flat), (-1, GRID, kept), (GRID, LARGEST * GRID + 1, lambda m: not kept(m))]
    while any(high - low > 1 for low, high, _ in brackets):
        tried = [
            sorted({low + (high - low) * n // PARTS for n in range(1, PARTS)} - {low, high})
            for low, high, _ in brackets
        ]
        found = _measures(shares, [step for steps in tried for step in steps], budget)
        for number, (low, high, test) in enumerate(brackets):
            holds = [step for step in tried[number] if test(found[step])]
            fails = [step for step in tried[number] if not test(found[step])]
            brackets[number] = (max([low, *fails]), min([high, *holds]), test)
    (_, wanted, _), (_, least, _), (most, _, _) = brackets
    return min(max(wanted, least), most) / GRID


def _budgeted(shares: DataFrame, exponent: float, budget: int) -> DataFrame:
    """source, tokens, weight and whole budgets that add up to `budget`, by largest remainder.

    What is a whole number but for rounding counts as one. Ties go to the first source, null first.
    """
    powered = shares.withColumn("powered", F.pow("share", F.lit(exponent)))
    z = powered.agg(F.sum("powered")).first()[0]
    exact = F.col("weight") * F.lit(float(budget))
    floor = F.floor(exact + 1e-6 + exact * 1e-12).cast("long")
    floored = stored(
        powered.select("source", "tokens", (F.col("powered") / z).alias("weight"))
        .withColumn("budget", floor)
        .withColumn("over", exact - F.col("budget"))
    )
    left = budget - floored.agg(F.sum("budget")).first()[0]
    # Fewer than there are sources.
    more = floored.orderBy(F.desc("over"), F.asc_nulls_first("source")).limit(left)
    more = more.select(F.col("source").alias("more"), F.lit(1).cast("long").alias("one"))
    return (
        floored.join(more, F.col("source").eqNullSafe(F.col("more")), "left")
        .withColumn("budget", F.col("budget") + F.coalesce("one", F.lit(0)))
        .select("source", "tokens", "weight", "budget")
    )


def mixing_plan(
    docs: DataFrame,
    budget: int | None = None,
    entropy_share: float = ENTROPY_SHARE,
    max_repeats: float = MAX_REPEATS,
    seed: str = SEED,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """One row per source: tokens, weight, budget, whole epochs and the cutoff of the last one.

    `entropy_share` is the target entropy as a share of the entropy of equal weights. `budget` is in
    tokens, all tokens of the input if not given.
    """
    spark = docs.sparkSession
    narrow = stored(
        docs.select(
            F.col("source").cast("string").alias("source"),
            _identity().alias("identity"),
            token_count(text_or_empty()).alias("n_tokens"),
        )
    )
    totals = stored(
        narrow.groupBy("source").agg(
            F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs")
        )
    ).where("tokens > 0")
    whole = totals.agg(
        F.sum("tokens").alias("tokens"),
        F.max("n_docs").alias("n_docs"),
        F.count("*").alias("sources"),
    ).first()
    schema = (
        "source string, tokens bigint, weight double, budget bigint, "
        "whole_epochs bigint, cutoff string"
    )
    if not whole.tokens:
        return spark.createDataFrame([], schema)
    budget = whole.tokens if budget is None else budget
    if budget > max_repeats * whole.tokens:
        raise ValueError("the budget needs more repetition than max_repeats allows")
    shares = totals.withColumn("share", F.col("tokens") / F.lit(float(whole.tokens)))
    target = entropy_share * math.log(whole.sources)
    exponent = bisected_exponent(shares, target, max_repeats, budget)
    planned = stored(
        _budgeted(shares, exponent, budget)
        .withColumn("whole_epochs", F.expr("budget div tokens"))
        .withColumn("rest", F.expr("budget % tokens"))
    )
    levels = 0
    while whole.n_docs > rows_per_block * CHILDREN**levels:
        levels += 1
    cut = _cutoffs(narrow, planned, seed, levels)
    return (
        planned.join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left")
        .select("source", "tokens", "weight", "budget", "whole_epochs", "cutoff")
    )


def _cutoffs(narrow: DataFrame, planned: DataFrame, seed: str, levels: int) -> DataFrame:
    """The last permutation key of each source that still fits into the rest of its budget.

    Found level by level: of the keys that begin with what is known of the cutoff, the sums by the
    next digits, at most `CHILDREN` rows a source, say how it goes on. The keys that are left at the
    end are summed one by one; equal ones are one row by then.
    """
    ends = planned.where("rest > 0").select(
        F.col("source").alias("cut_source"), "rest", (F.col("whole_epochs") + 1).alias("epoch")
    )
    placed = (
        narrow.join(ends, F.col("source").eqNullSafe(F.col("cut_source")))
        .withColumn("key", permutation_key(seed, F.col("epoch"), F.col("identity")))
        .groupBy("cut_source", "key")
        .agg(F.sum("n_tokens").alias("n_tokens"))
    )
    placed = stored(placed)
    # `begin` is the known beginning of the cutoff, `room` what is left of the rest before it.
    at = ends.select("cut_source", F.lit("").alias("begin"), F.col("rest").alias("room"))
    for level in range(levels):
        known = level * DIGITS
        child = F.substring("key", known + 1, DIGITS).alias("child")
        sums = _beginning(placed, at).groupBy("cut_source", "begin", "room", child)
        upto = F.sum("held").over(Window.partitionBy("cut_source").orderBy("child"))
        running = sums.agg(F.sum("n_tokens").alias("held")).withColumn("upto", upto)
        # The first child that no longer fits as a whole; there is one, as the rest is below the sum.
        start = F.struct(
            F.concat("begin", "child").alias("begin"),
            (F.col("room") - F.col("upto") + F.col("held")).alias("room"),
        )
        at = stored(
            running.where("upto > room")
            .groupBy("cut_source")
            .agg(F.min_by(start, "child").alias("at"))
            .select("cut_source", "at.begin", "at.room")
        )
    last = Window.partitionBy("cut_source").orderBy("key")
    inside = _beginning(placed, at).withColumn("upto", F.sum("n_tokens").over(last))
    fits = F.max(F.when(F.col("upto") <= F.col("room"), F.col("key"))).alias("fits")
    # What a key begins with stands before the key.
    return (
        inside.groupBy("cut_source", "begin")
        .agg(fits)
        .select("cut_source", F.coalesce("fits", "begin").alias("cutoff"))
    )


def _beginning(placed: DataFrame, at: DataFrame) -> DataFrame:
    """Keys of each source that begin as its cutoff does, with `begin` and `room`."""
    found = at.withColumnRenamed("cut_source", "at_source")
    same = F.col("cut_source").eqNullSafe(F.col("at_source")) & F.startswith("key", "begin")
    return placed.join(found, same).drop("at_source")


def mixture(
    docs: DataFrame, plan: DataFrame, seed: str = SEED, epoch: str = "epoch", place: str = "place"
) -> DataFrame:
    """The documents as often as the plan says, with their epoch and the sort key in it."""
    planned = stored(
        plan.select(F.col("source").alias("plan_source"), "whole_epochs", F.col("cutoff"))
    ).toDF("__plan_source", "__whole", "__cutoff")
    last = F.col("__whole") + 1
    taken = permutation_key(seed, last, _identity()) <= F.col("__cutoff")
    copies = F.col("__whole") + F.coalesce(taken, F.lit(False)).cast("long")
    return (
        docs.drop(epoch, place)
        .join(planned, F.col("source").cast("string").eqNullSafe(F.col("__plan_source")))
        .withColumn("__copies", copies)
        .where("__copies > 0")
        .withColumn(epoch, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
        .withColumn(place, permutation_key(seed, F.col(epoch), _identity()))
        .drop("__plan_source", "__whole", "__cutoff", "__copies")
    )


def mixed(
    docs: DataFrame, seed: str = SEED, epoch: str = "epoch", place: str = "place", **options
) -> DataFrame:
    """Documents repeated or left out so that the sources have their target weights.

    Sorted by (epoch, place) the rows are the training order: every epoch is a permutation of its
    own, dealt in blocks of equal key prefix.
    """
    return mixture(docs, mixing_plan(docs, seed=seed, **options), seed, epoch, place)
