"""Declarative data-quality rules, one aggregation job per table.

A table's rules are evaluated together: rows are combined per unique key first (so that
duplicates need no DISTINCT expansion) and then summed to one row, which is turned into
report rows (table_name, rule, column_name, violations, passed, row_count).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.keys import valid_date_key
from tramline.operators.joins import orphans

REPORT = "table_name string, rule string, column_name string, violations long, passed boolean, row_count long"


@dataclass(frozen=True)
class TableRules:
    """What must hold for one table. ``ordered_pair`` is (start, end, exempt start, exempt end)."""

    name: str
    columns: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    date_keys: tuple[str, ...] = ()
    not_blank: tuple[str, ...] = ()
    row_count: int | None = None
    min_rows: int | None = None
    ordered_pair: tuple[str, str, int, int] | None = None
    total_of: tuple[str, str, str] | None = None
    empty: str = "error"  # error | ok | warn
    foreign: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def for_update(self) -> TableRules:
        """Update runs accept an empty batch and an open row count."""
        changes = {**self.__dict__, "empty": "ok"}
        if self.name in ("dim_location", "dim_transport_type"):
            changes["row_count"] = None
        return TableRules(**changes)


def check(df: DataFrame, rules: TableRules) -> DataFrame:
    """Report of all single-table rules (foreign keys: see ``check_foreign``)."""
    spark = df.sparkSession
    missing = [c for c in rules.columns if c not in df.columns]
    if missing:
        rows = [(rules.name, "columns", c, 1, False, None) for c in missing]
        return spark.createDataFrame(rows, REPORT)

    per_row = _row_violations(df, rules)
    measures = {f"m{i}": flag for i, (_, _, flag) in enumerate(per_row)}
    keys = [F.col(c) for c in rules.unique]
    if keys:
        # Extra rows of a key are violations; NULL keys count as equal.
        grouped = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("__n"), *(F.count_if(flag).alias(m) for m, flag in measures.items())
        )
        totals = grouped.agg(
            F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"),
            *(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures),
        )
    else:
        totals = df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.lit(0).cast("long").alias("duplicates"),
            *(F.count_if(flag).alias(m) for m, flag in measures.items()),
        )

    rows = F.col("rows")
    outcomes: list[tuple[str, str, Column]] = [("columns", ",".join(rules.columns), F.lit(0))]
    if rules.empty == "error":
        outcomes.append(("not_empty", "", F.when(rows == 0, 1).otherwise(0)))
    elif rules.empty == "warn":
        outcomes.append(("warn_empty", "", F.when(rows == 0, 1).otherwise(0)))
    if rules.row_count is not None:
        outcomes.append(("row_count", "", F.abs(rows - rules.row_count)))
    if rules.min_rows is not None:
        outcomes.append(("row_count_at_least", "", F.greatest(F.lit(rules.min_rows) - rows, F.lit(0))))
    if keys:
        outcomes.append(("unique", ",".join(rules.unique), F.col("duplicates")))
    outcomes += [(rule, column, F.col(f"m{i}")) for i, (rule, column, _) in enumerate(per_row)]
    cells = [
        F.struct(
            F.lit(rules.name).alias("table_name"),
            F.lit(rule).alias("rule"),
            F.lit(column).alias("column_name"),
            violations.cast("long").alias("violations"),
            (F.lit(rule.startswith("warn")) | (violations == 0)).alias("passed"),
            rows.cast("long").alias("row_count"),
        )
        for rule, column, violations in outcomes
    ]
    return totals.select(F.inline(F.array(*cells)))


def _row_violations(df: DataFrame, rules: TableRules) -> list[tuple[str, str, Column]]:
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    found: list[tuple[str, str, Column]] = []
    found += [("not_null", c, F.col(c).isNull()) for c in rules.not_null]
    found += [("not_blank", c, F.trim(F.col(c)) == "") for c in rules.not_blank]
    found += [("non_negative", c, F.col(c) < 0) for c in rules.non_negative if c in numeric]
    found += [("date_key", c, ~valid_date_key(F.col(c))) for c in rules.date_keys]
    if rules.ordered_pair:
        start, end, free_start, free_end = rules.ordered_pair
        exempt = (F.col(start) == free_start) & (F.col(end) == free_end)
        found.append(("ordered_pair", f"{start},{end}", ~(F.col(start) < F.col(end)) & ~exempt))
    if rules.total_of:
        total, a, b = rules.total_of
        known = F.col(a).isNotNull() & F.col(b).isNotNull()
        found.append(("total_of", ",".join(rules.total_of), known & (F.col(total) != F.col(a) + F.col(b))))
    return found


def check_foreign(df: DataFrame, rules: TableRules, dims: Mapping[str, DataFrame]) -> DataFrame | None:
    """Orphan count per foreign key ``{column: (dim table, dim column)}``."""
    parts = []
    for column, (dim, dim_column) in rules.foreign.items():
        lost = orphans(df.select(column), column, dims[dim], dim_column)
        parts.append(
            lost.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(rules.name).alias("table_name"),
                F.lit("foreign_key").alias("rule"),
                F.lit(f"{column}->{dim}.{dim_column}").alias("column_name"),
                "violations",
                (F.col("violations") == 0).alias("passed"),
                F.lit(None).cast("long").alias("row_count"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else None


def validate(candidates: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> DataFrame:
    """Report over all candidate tables that have rules."""
    reports = [check(df, rules[name]) for name, df in candidates.items() if name in rules]
    if not reports:
        return SparkSession.active().createDataFrame([], REPORT)
    return reduce(lambda a, b: a.unionByName(b), reports)


def summary(report: DataFrame) -> DataFrame:
    """Checks passed and failed per table."""
    return report.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.bool_and("passed").alias("all_passed"),
    )


class Failure(NamedTuple):
    table: str
    rule: str
    column: str
    violations: int


class RejectedWave(RuntimeError):
    """A table of the wave broke a rule, so nothing of the wave is written."""

    def __init__(self, failures: Sequence[Failure]):
        super().__init__("; ".join(f"{f.table}: {f.rule} {f.column} ({f.violations})" for f in failures))
        self.failures = list(failures)


def gate(report: DataFrame) -> None:
    """Raise if any check failed. The report has a handful of rows per table."""
    failed = report.filter(~F.col("passed")).select("table_name", "rule", "column_name", "violations").collect()
    if failed:
        raise RejectedWave([Failure(*r) for r in failed])


# --- expectations on one measured value -----------------------------------------------------

COMPARATORS: dict[str, Callable] = {
    "==": lambda a, e: a == e,
    "!=": lambda a, e: a != e,
    "<": lambda a, e: a < e,
    "<=": lambda a, e: a <= e,
    ">": lambda a, e: a > e,
    ">=": lambda a, e: a >= e,
}


def expect(measured: DataFrame, value: str, *, op: str | None = None, expected: float | None = None,
           low: float | None = None, high: float | None = None, tolerance: float | None = None) -> DataFrame:
    """Add ``passed``: exact / operator compare, closed range, or within a tolerance."""
    actual = F.col(value)
    if low is not None or high is not None:
        ok = actual.between(low, high)
    elif tolerance is not None:
        ok = F.abs(actual - F.lit(expected)) <= tolerance
    else:
        ok = COMPARATORS[op or "=="](actual, F.lit(expected))
    return measured.withColumn("passed", F.coalesce(ok, F.lit(False)))


def expectation_value(fact: DataFrame, dim: DataFrame, on: tuple[str, str], name: str, pattern: str,
                      measure: str, key: str, low: int, high: int, how: str = "sum") -> DataFrame:
    """avg, count or sum of a measure for dim members matching a pattern, within a key range."""
    aggregate = {"sum": F.sum, "avg": F.avg, "count": F.count}[how]
    members = dim.filter(F.col(name).ilike(pattern)).select(F.col(on[1]).alias("__k"))
    chosen = fact.filter(F.col(key).between(low, high)).join(members, F.col(on[0]) == F.col("__k"))
    return chosen.agg(aggregate(measure).alias("value"))


def rules_with(rules: TableRules, **changes: object) -> TableRules:
    return TableRules(**{**rules.__dict__, **changes})
