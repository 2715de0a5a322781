"""Declarative quality rules, judged together in one aggregate over the table.

Names and message texts of the rules are fixed values: alerts are matched on them.
"""

import datetime
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(Protocol):
    """Aggregates to take over the table, and the check row to make of them."""

    def measures(self) -> dict[str, Column]: ...

    def verdict(self) -> Column: ...


class QualityCheckFailed(Exception):
    """At least one quality rule did not hold."""


def _verdict(name: str, passed: Column, message: Column, observed: Column, threshold) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        message.alias("message"),
        observed.cast("double").alias("observed"),
        F.lit(threshold).cast("double").alias("threshold"),
    )


def _when_ok(passed: Column, ok: Column, failed: Column) -> Column:
    return F.when(passed, ok).otherwise(failed)


@dataclass(frozen=True)
class MinRows:
    minimum: int = 700_000
    name: str = "row_count"

    def measures(self) -> dict[str, Column]:
        return {"rows": F.count("*")}

    def verdict(self) -> Column:
        rows = F.col("rows")
        passed = rows >= self.minimum
        message = _when_ok(
            passed,
            F.format_string("Row count %d OK", rows),
            F.format_string(f"Row count %d below minimum {self.minimum}", rows),
        )
        return _verdict(self.name, passed, message, rows, self.minimum)


@dataclass(frozen=True)
class MaxNullRate:
    columns: tuple[str, ...] = ("invoice", "customerid", "revenue")
    maximum: float = 0.0
    name: str = "critical_nulls"

    def measures(self) -> dict[str, Column]:
        nulls = {f"null_{c}": F.count_if(F.isnull(c)) for c in self.columns}
        return {"rows": F.count("*"), **nulls}

    def verdict(self) -> Column:
        rates = {c: F.try_divide(F.col(f"null_{c}"), F.col("rows")) for c in self.columns}
        worst = F.array_max(F.array(*rates.values()))
        passed = worst <= self.maximum
        broken = F.array_compact(
            F.array(
                *(
                    F.when(rate > self.maximum, F.format_string(f"{c} null rate %.4f", rate))
                    for c, rate in rates.items()
                )
            )
        )
        message = (
            F.when(worst.isNull(), "Null rates undefined: no rows")
            .when(passed, f"Null rates within threshold (max allowed {self.maximum})")
            .otherwise(F.array_join(broken, "; "))
        )
        return _verdict(self.name, passed, message, worst, self.maximum)


@dataclass(frozen=True)
class MinTotal:
    column: str = "revenue"
    minimum: float = 1_000_000.0
    name: str = "revenue_sanity"

    def measures(self) -> dict[str, Column]:
        return {f"total_{self.column}": F.sum(self.column)}

    def verdict(self) -> Column:
        total = F.col(f"total_{self.column}")
        passed = total >= self.minimum
        message = (
            F.when(total.isNull(), "Total revenue undefined: no values")
            .when(passed, F.format_string("Total revenue %,.2f OK", total))
            .otherwise(
                F.format_string(f"Total revenue %,.2f below minimum {self.minimum:,.2f}", total)
            )
        )
        return _verdict(self.name, passed, message, F.round(total, 2), self.minimum)


@dataclass(frozen=True)
class YearsPresent:
    years: tuple[str, ...] = ("2009", "2010", "2011")
    name: str = "partitions"

    def measures(self) -> dict[str, Column]:
        return {"years": F.collect_set(F.col("year").cast("string"))}

    def verdict(self) -> Column:
        expected = F.array(*(F.lit(y) for y in sorted(self.years)))
        missing = F.array_except(expected, F.col("years"))
        passed = F.size(missing) == 0

        def listed(years: Column) -> Column:
            quoted = F.array_join(F.array_sort(years), "', '")
            return F.when(F.size(years) > 0, F.concat(F.lit("['"), quoted, F.lit("']"))).otherwise(
                "[]"
            )

        message = _when_ok(
            passed,
            F.concat(F.lit("All expected year partitions present: "), listed(F.col("years"))),
            F.concat(F.lit("Missing year partitions: "), listed(missing)),
        )
        return _verdict(self.name, passed, message, F.size(missing), 0)


DEFAULT_RULES = (MinRows(), MaxNullRate(), MinTotal(), YearsPresent())


def run_checks(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """One row per rule, in rule order, from a single pass over `df`."""
    measures: dict[str, Column] = {}
    for rule in rules:
        measures.update(rule.measures())
    measured = df.agg(*(column.alias(name) for name, column in measures.items()))
    return measured.select(F.inline(F.array(*(rule.verdict() for rule in rules))))


def dead_letter_check(dead: DataFrame, since: datetime.datetime) -> DataFrame:
    """The alert on dead letters as a check row: passed while none arrived since then."""
    recent = dead.agg(F.count_if(F.col("ingested_at") >= F.lit(since)).alias("n"))
    message = F.format_string("Dead letters %d", F.col("n"))
    return recent.select(
        F.inline(F.array(_verdict("dead_letters", F.col("n") == 0, message, F.col("n"), 0)))
    )


def enforce(checks: DataFrame) -> dict:
    """Result of all checks as a dict; raises once, naming every check that failed."""
    results = checks.collect()
    failed = [f"{r.check}: {r.message}" for r in results if not r.passed]
    if failed:
        raise QualityCheckFailed("; ".join(failed))
    return {
        "status": "PASSED",
        "checks": {r.check: {"passed": r.passed, "message": r.message} for r in results},
    }
