"""Quartile scores and top-k ranks over whole tables without a single-partition sort."""

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000


@dataclass(frozen=True)
class Order:
    """Sort by one numeric column, NULLs last."""

    column: str
    ascending: bool = True

    def before(self, value) -> Column:
        """Rows that sort strictly before `value`."""
        col = F.col(self.column)
        if value is None:
            return col.isNotNull()
        return F.coalesce(col < value if self.ascending else col > value, F.lit(False))

    def tied(self, value) -> Column:
        return F.col(self.column).eqNullSafe(F.lit(value))

    def after(self, value) -> Column:
        col = F.col(self.column)
        if value is None:
            return F.lit(False)
        return F.coalesce(col > value if self.ascending else col < value, F.lit(True))


@dataclass(frozen=True)
class Wanted:
    """The value at 0-based `rank`, ascending, of the `rows` non-NULL values where `where` holds."""

    column: str
    where: Column
    rank: int
    rows: int

    @property
    def values(self) -> Column:
        return F.when(self.where, F.col(self.column))


def values_at_ranks(
    df: DataFrame, wanted: Mapping[object, Wanted], accuracy: int = SKETCH_ACCURACY
) -> dict:
    """Exact values at the wanted ranks; a rank past the last non-NULL value gives None.

    Every round is one-row aggregates over all wanted ranks at once. A quantile sketch proposes
    two values around each rank, exact counts then say whether one of them is the answer or which
    open interval holds it, and the interval is searched again. The counts make the result exact
    however rough the sketch is; heavy ties resolve by being a bound themselves.
    """
    found = {name: None for name, w in wanted.items() if w.rank >= w.rows}
    pending = {name: w for name, w in wanted.items() if name not in found}
    while pending:
        narrowed = _narrow(df, pending, accuracy)
        found.update({name: v for name, v in narrowed.items() if not isinstance(v, Wanted)})
        pending = {name: v for name, v in narrowed.items() if isinstance(v, Wanted)}
    return found


def _narrow(df: DataFrame, pending: Mapping[object, Wanted], accuracy: int) -> dict:
    """For each pending rank either its value or a smaller search."""
    brackets = _brackets(df, pending, accuracy)
    counts = df.agg(
        *(
            F.struct(
                F.count_if(w.values < low).alias("below_low"),
                F.count_if(w.values <= low).alias("to_low"),
                F.count_if(w.values < high).alias("below_high"),
                F.count_if(w.values <= high).alias("to_high"),
            )
            for w, (low, high) in zip(pending.values(), brackets.values())
        )
    ).first()
    return {
        name: _settle(df, w, *brackets[name], counted)
        for (name, w), counted in zip(pending.items(), counts)
    }


def _brackets(df: DataFrame, pending: Mapping[object, Wanted], accuracy: int) -> dict:
    """A value somewhat below and one somewhat above each rank, from one sketch per set of rows."""
    sketches: dict = {}
    for name, w in pending.items():
        sketches.setdefault((w.column, id(w.where)), []).append(name)

    def shares(w: Wanted) -> list[float]:
        share, slack = (w.rank + 0.5) / w.rows, 2 / accuracy
        return [max(share - slack, 0.0), min(share + slack, 1.0)]

    row = df.agg(
        *(
            F.percentile_approx(
                pending[names[0]].values,
                [share for name in names for share in shares(pending[name])],
                accuracy,
            )
            for names in sketches.values()
        )
    ).first()
    found = {
        name: (values[2 * i], values[2 * i + 1])
        for names, values in zip(sketches.values(), row)
        for i, name in enumerate(names)
    }
    return {name: found[name] for name in pending}


def _settle(df: DataFrame, w: Wanted, low, high, counted):
    col = F.col(w.column)
    if counted.below_low <= w.rank < counted.to_low:
        return low
    if counted.below_high <= w.rank < counted.to_high:
        return high
    if w.rank < counted.below_low:
        inner = replace(w, where=w.where & (col < low), rows=counted.below_low)
    elif w.rank >= counted.to_high:
        inner = replace(
            w,
            where=w.where & (col > high),
            rank=w.rank - counted.to_high,
            rows=w.rows - counted.to_high,
        )
    else:
        inner = replace(
            w,
            where=w.where & (col > low) & (col < high),
            rank=w.rank - counted.to_low,
            rows=counted.below_high - counted.to_low,
        )
    return inner if inner.rows < w.rows else _value_by_steps(df, w)


def _value_by_steps(df: DataFrame, w: Wanted):
    """Value at the rank by going from each distinct value to the next, one small aggregate a step.

    Reached only when the sketch cannot tell the values apart (64-bit integers that share one
    double), so few distinct values are left.
    """
    while True:
        value = df.agg(F.min(w.values)).first()[0]
        rows = df.agg(F.count_if(w.values == value)).first()[0]
        if w.rank < rows:
            return value
        where = w.where & (F.col(w.column) > value)
        w = replace(w, where=where, rank=w.rank - rows, rows=w.rows - rows)


def ntile(
    df: DataFrame,
    key: str,
    scores: Mapping[str, Order],
    tiles: int = 4,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Add `NTILE(tiles) OVER (ORDER BY <order>, key)` for each score.

    A tile number only depends on the rows that open the tiles. Their sort keys are found with
    `values_at_ranks`, first by value and then by `key` within a tied value, and the scores become
    comparisons with literals: the table itself is neither sorted nor shuffled, whatever the ties.

    `key` must be numeric and unique. The frame is read a few times, so pass a stored table.
    """
    base = df.agg(
        F.count("*"), *(F.count(order.column) for order in scores.values())
    ).first()
    rows, filled = base[0], dict(zip(scores, base[1:]))
    size, longer = divmod(rows, tiles)
    starts = {t: t * size + min(t, longer) for t in range(1, tiles)}
    cuts = [(name, t) for name in scores for t, start in starts.items() if start < rows]
    if not cuts:
        return df.withColumns({name: F.lit(1).cast("bigint") for name in scores})

    def ascending_rank(name: str, t: int) -> int:
        start, n = starts[t], filled[name]
        return start if scores[name].ascending or start >= n else n - 1 - start

    everywhere = F.lit(True)
    opening = {
        (name, t): Wanted(scores[name].column, everywhere, ascending_rank(name, t), filled[name])
        for name, t in cuts
    }
    values = values_at_ranks(df, opening, accuracy)
    ties = df.agg(
        *(
            F.struct(
                F.count_if(scores[name].before(values[name, t])).alias("ahead"),
                F.count(F.when(scores[name].tied(values[name, t]), F.col(key))).alias("keys"),
            )
            for name, t in cuts
        )
    ).first()
    split = {
        (name, t): Wanted(
            key, scores[name].tied(values[name, t]), starts[t] - tie.ahead, tie["keys"]
        )
        for (name, t), tie in zip(cuts, ties)
        if starts[t] > tie.ahead
    }
    keys = values_at_ranks(df, split, accuracy) if split else {}

    def opened(name: str, t: int) -> Column:
        """Whether the row stands at or behind the first row of the tile after `t`."""
        order, value = scores[name], values[name, t]
        behind_key = F.lit(True)
        if (name, t) in keys:
            first = keys[name, t]
            behind_key = F.col(key).isNull()
            if first is not None:
                behind_key = behind_key | (F.col(key) >= first)
        return order.after(value) | (order.tied(value) & behind_key)

    def score(name: str) -> Column:
        tile = F.lit(1)
        for cut in cuts:
            if cut[0] == name:
                tile = tile + opened(*cut).cast("int")
        return tile.cast("bigint")

    return df.withColumns({name: score(name) for name in scores})


def top_ranked(
    df: DataFrame, order: Order, tie_break: str, limit: int, rank: str = "rank"
) -> DataFrame:
    """First `limit` rows by `order` with `RANK() OVER (ORDER BY <order>)`.

    The rank of a row depends only on the rows before it, so ranking after the limit gives the
    same numbers, and the window sees `limit` rows instead of the table.
    """
    direction = F.asc_nulls_last if order.ascending else F.desc_nulls_last
    first = df.orderBy(direction(order.column), F.asc_nulls_last(tie_break)).limit(limit)
    ranked = F.rank().over(Window.orderBy(direction(order.column)))
    return first.withColumn(rank, ranked.cast("bigint")).orderBy(
        direction(order.column), F.asc_nulls_last(tie_break)
    )
