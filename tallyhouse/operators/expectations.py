"""Row rules: warnings are counted, failures stop the run. A NULL verdict is a violation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

WARN = "warn"
FAIL = "fail"


class ExpectationFailed(Exception):
    pass


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    severity: str = FAIL

    def violated(self) -> Column:
        return ~F.coalesce(F.expr(self.predicate), F.lit(False))


def required(*columns: str) -> list[Rule]:
    return [Rule(f"{c}_present", f"{c} IS NOT NULL") for c in columns]


def check(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """(table_name, rule, severity, violations), all rules counted in one aggregation."""
    counts = df.agg(*[F.count_if(rule.violated()).alias(f"r{i}") for i, rule in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(rule.name).alias("rule"),
            F.lit(rule.severity).alias("severity"),
            F.col(f"r{i}").alias("violations"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


class RuleCounts:
    """Violations of a table's rules, counted by the job that writes the table.

    Give `watch` the frame that is written; `rows` waits until that job is done. A job that
    breaks a failure rule never ends, so only warnings count above zero.
    """

    def __init__(self, table: str, rules: Sequence[Rule]):
        self.table, self.rules = table, list(rules)
        self._seen = Observation(f"rules of {table}")

    def watch(self, df: DataFrame) -> DataFrame:
        if not self.rules:
            return df
        return df.observe(self._seen, *[F.count_if(rule.violated()).alias(f"r{i}") for i, rule in enumerate(self.rules)])

    def rows(self) -> list[tuple[str, str, str, int]]:
        counts = self._seen.get if self.rules else {}
        return [(self.table, rule.name, rule.severity, counts[f"r{i}"]) for i, rule in enumerate(self.rules)]


def report(spark: SparkSession, counts: Sequence[RuleCounts]) -> DataFrame:
    """What `check` returns, from counts that were taken while the tables were written."""
    rows = [row for count in counts for row in count.rows()]
    return spark.createDataFrame(rows, "table_name string, rule string, severity string, violations bigint")


def enforce(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """Count first, raise if a failure rule is violated, otherwise return `df` unchanged."""
    broken = check(df, [r for r in rules if r.severity == FAIL], table).filter("violations > 0").collect()
    if broken:
        raise ExpectationFailed(", ".join(f"{r.table_name}.{r.rule}: {r.violations} rows" for r in broken))
    return df


def abort_on_violation(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """Stop the running job at the first row that breaks a failure rule.

    Used while a table is written, so that the check costs no second pass.
    """
    failing = [r for r in rules if r.severity == FAIL]
    if not failing:
        return df
    broken = [F.when(r.violated(), F.lit(r.name)) for r in failing]
    names = F.concat_ws(", ", *broken)
    message = F.concat(F.lit(f"{table} breaks "), names)
    return df.filter(F.when(names == "", True).otherwise(F.raise_error(message).cast("boolean")))
