"""A warehouse whose waves are published whole or not at all.

Tables lie below one folder as Parquet. A run builds the tables of a wave into a staging folder of its own, reads them back,
checks exactly what was written (rules, keys against the target, foreign keys) and, only if all tables of the wave pass, appends one
file to the manifest: the list of folders that make up every table from then on. Readers take the newest version of the
manifest, so they see a wave whole or not at all; a rejected or broken run leaves staged folders that no version names. One writer
at a time; a replayed run publishes the same rows, as loaders leave out what the target has.

``append`` adds the new rows' folder, ``snapshot`` puts it in the place of all others, ``periods`` puts its months in the place of the same
months: a month that comes again replaces what was stored of it. The manifest of a version has one row per folder and month.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators import rules
from tramline.operators.incremental import assign_keys

MANIFEST = "version long, table_name string, folder string, period int"


class Store:
    """Published tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._newest: tuple[int, list[tuple[str, str, int | None]]] | None = None

    def _manifest(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def entries(self) -> tuple[int, list[tuple[str, str, int | None]]]:
        """The newest version and its (table, folder, period): as many as there are folders. Read once; see ``refresh``."""
        if self._newest is None:
            manifest = self._manifest()
            rows = [] if manifest is None else manifest.filter(F.col("version") == manifest.agg(F.max("version")).scalar()).collect()
            self._newest = (rows[0]["version"] if rows else 0, [tuple(r[1:]) for r in rows if r["folder"] is not None])
        version, entries = self._newest
        return version, list(entries)

    def refresh(self) -> Store:
        """See what another session has published since."""
        self._newest = None
        return self

    def find(self, name: str, without: Iterable[int] = ()) -> DataFrame | None:
        """The published table (``without`` some periods), or None where nothing is published."""
        gone = set(without)
        paths = [f if p is None else f"{f}/period={p}" for n, f, p in self.entries()[1] if n == name and (p is None or p not in gone)]
        return self.spark.read.parquet(*sorted(paths)) if paths else None

    def read(self, name: str) -> DataFrame:
        found = self.find(name)
        if found is None:
            raise LookupError(f"nothing is published of {name}")
        return found

    def publish(self, staged: Sequence[Staged]) -> int:
        """One new version with all staged tables; the append of one file is the commit."""
        version, entries = self.entries()
        for s in staged:
            if s.mode == "snapshot":
                entries = [e for e in entries if e[0] != s.name]
            elif s.mode == "periods":
                entries = [e for e in entries if e[0] != s.name or e[2] not in s.periods]
            entries += [(s.name, s.folder, p) for p in (s.periods if s.mode == "periods" else [None])]
        return self._put(version + 1, entries)

    def drop_periods(self, name: str, periods: Iterable[int]) -> int:
        """A new version without some months of a table stored by ``periods``."""
        version, entries = self.entries()
        gone = set(periods)
        return self._put(version + 1, [e for e in entries if e[0] != name or e[2] not in gone])

    def _put(self, version: int, entries: list[tuple[str, str, int | None]]) -> int:
        rows = [(version, *e) for e in sorted(entries, key=str)] or [(version, "", None, None)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        self._newest = (version, entries)
        return version


@dataclass(frozen=True)
class Job:
    """How a table is loaded. ``needs``: tables that must be published before. ``surrogate``: (key column, natural key columns)."""

    name: str
    build: Callable[[Store], DataFrame]
    needs: tuple[str, ...] = ()
    mode: str = "append"
    period: Callable[[], Column] | None = None
    surrogate: tuple[str, tuple[str, ...]] | None = None


@dataclass(frozen=True)
class Staged:
    name: str
    folder: str
    mode: str
    periods: tuple[int, ...] = ()


def waves(jobs: Sequence[Job]) -> list[list[Job]]:
    """Jobs by dependency: each wave needs earlier waves only (or tables that no job of the run loads)."""
    left, done, found = list(jobs), set(), []
    names = {j.name for j in jobs}
    if len(names) < len(jobs):
        raise ValueError("a table has two jobs")
    while left:
        ready = [j for j in left if not (set(j.needs) & names) - done]
        if not ready:
            raise ValueError(f"tables need each other: {sorted(j.name for j in left)}")
        found.append(ready)
        done |= {j.name for j in ready}
        left = [j for j in left if j not in ready]
    return found


def check_target(batch: DataFrame, target: DataFrame | None, table: rules.TableRules) -> DataFrame | None:
    """Rows of the batch whose unique key the target has already.

    The target is read only between the batch's smallest and largest first key column; Spark tests its keys against a filter of
    the batch's keys before the exact join.
    """
    if target is None or not table.unique:
        return None
    low, high = batch.agg(F.min(table.unique[0]), F.max(table.unique[0])).first()
    first = F.col(table.unique[0])
    near = target if low is None else target.filter(first.between(low, high) | first.isNull())
    known = near.select(*[F.col(c).alias(f"__{c}") for c in table.unique]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in table.unique])
    again = batch.select(*table.unique).join(known, same, "left_semi")
    return again.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table.name).alias("table_name"), F.lit("target_unique").alias("rule"), F.lit(",".join(table.unique)).alias("column_name"),
        "violations", (F.col("violations") == 0).alias("passed"), F.lit(None).cast("long").alias("row_count"),
    )


def _stage(store: Store, job: Job, run: str) -> tuple[Staged, DataFrame]:
    rows = job.build(store)
    if job.surrogate:
        key, natural = job.surrogate
        existing = store.find(job.name)
        rows = assign_keys(rows, store.spark.createDataFrame([], f"{key} int") if existing is None else existing, key, list(natural))
    folder = f"{store.root}/staged/{run}/{job.name}"
    if job.mode != "periods":
        rows.write.parquet(folder)
        return Staged(job.name, folder, job.mode), store.spark.read.parquet(folder)
    # A month's rows meet in few files; adaptive execution splits a month that is too large for one task.
    rows.withColumn("period", job.period()).hint("rebalance", "period").write.partitionBy("period").parquet(folder)
    written = store.spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, period int").parquet(folder)
    months = tuple(sorted(r[0] for r in written.select("period").distinct().collect()))
    return Staged(job.name, folder, job.mode, months), written.drop("period")


def run(
    store: Store, jobs: Sequence[Job], rule_set: Mapping[str, rules.TableRules], foreign: Mapping[str, Mapping[str, tuple[str, str]]]
) -> DataFrame:
    """Load all jobs wave by wave; returns the report of all checks. A rejected wave publishes nothing, and later waves do not run."""
    reports = []
    for k, wave in enumerate(waves(jobs)):
        report = run_wave(store, wave, rule_set, foreign).collect()  # a few rows per table
        reports += [(k, *r) for r in report]
    return store.spark.createDataFrame(reports, f"wave int, {rules.REPORT}")


def run_wave(store: Store, wave: Sequence[Job], rule_set, foreign) -> DataFrame:
    """Stage, check and publish one wave."""
    lacking = [j.name for j in wave if j.name not in rule_set]
    if lacking:
        raise ValueError(f"no rules for {lacking}")
    token = uuid.uuid4().hex
    staged = {j.name: _stage(store, j, token) for j in wave}
    parts = []
    for name, (s, rows) in staged.items():
        table = rules.rules_with(rule_set[name], foreign=dict(foreign.get(name, {})))
        parts.append(rules.check(rows, table))
        dims = {}
        for dim, _ in table.foreign.values():
            published, fresh = store.find(dim), staged[dim][1] if dim in staged else None
            both = [d for d in (published, fresh) if d is not None]
            if not both:
                raise LookupError(f"{name} refers to {dim}, of which nothing is published")
            dims[dim] = reduce(lambda a, b: a.unionByName(b), both)
        parts.append(rules.check_foreign(rows, table, dims))
        if s.mode != "snapshot":
            parts.append(check_target(rows, store.find(name, without=s.periods), table))
    found = reduce(lambda a, b: a.unionByName(b), [p for p in parts if p is not None]).collect()
    report = store.spark.createDataFrame(found, rules.REPORT)
    rules.gate(report)
    counts = {r["table_name"]: r["row_count"] for r in found if r["row_count"] is not None}
    kept = [s for name, (s, _) in staged.items() if counts.get(name, 1) > 0]
    if kept:
        store.publish(kept)
    return report
