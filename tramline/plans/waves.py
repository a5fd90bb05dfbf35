"""Wave runner: build, validate, gate, write."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tramline.operators import rules
from tramline.operators.incremental import assign_keys
from tramline.plans.schemas import LOAD_RULES, UPDATE_RULES
from tramline.sources.files import write_table

Builder = Callable[["Warehouse"], DataFrame]


@dataclass
class Warehouse:
    """Parquet tables below one folder."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class Target:
    """How a candidate table is written. ``surrogate`` is (key column, natural key columns)."""

    name: str
    build: Builder
    mode: str = "append"
    partition_by: tuple[str, ...] = ()
    surrogate: tuple[str, tuple[str, ...]] | None = None


def run_wave(
    warehouse: Warehouse, targets: Sequence[Target], rule_set: Mapping[str, rules.TableRules] | None = None
) -> DataFrame:
    """Build all targets, check them, write them only if every check passes. Returns the report.

    Candidates are persisted to disk-backed storage for the wave, because validation and
    writing both read them.
    """
    rule_set = LOAD_RULES if rule_set is None else rule_set
    candidates = {t.name: t.build(warehouse).persist(StorageLevel.MEMORY_AND_DISK) for t in targets}
    try:
        report = rules.validate(candidates, rule_set)
        rows = report.collect()  # a few rows per table
        report = warehouse.spark.createDataFrame(rows, rules.REPORT)
        rules.gate(report)
        for target in targets:
            write_target(warehouse, target, candidates[target.name])
    finally:
        for df in candidates.values():
            df.unpersist()
    return report


def write_target(warehouse: Warehouse, target: Target, rows: DataFrame) -> bool:
    if target.surrogate:
        key, natural = target.surrogate
        existing = warehouse.read(target.name) if _exists(warehouse, target.name) else None
        if existing is None:
            existing = warehouse.spark.createDataFrame([], f"{key} int")
        rows = assign_keys(rows, existing, key, list(natural))
    return write_table(rows, warehouse.path(target.name), target.mode, target.partition_by)


def load(warehouse: Warehouse, target: Target, update: bool = False) -> DataFrame:
    """Single-table load: build, validate, append."""
    return run_wave(warehouse, [target], UPDATE_RULES if update else LOAD_RULES)


def run_waves(warehouse: Warehouse, waves: Sequence[Sequence[Target]], update: bool = False) -> list[DataFrame]:
    """Waves in order; a rejected wave stops the run, so later waves never see partial dimensions."""
    return [run_wave(warehouse, wave, UPDATE_RULES if update else LOAD_RULES) for wave in waves]


def existing_or_none(warehouse: Warehouse, name: str) -> DataFrame | None:
    return warehouse.read(name) if _exists(warehouse, name) else None


def _exists(warehouse: Warehouse, name: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        warehouse.read(name)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True
