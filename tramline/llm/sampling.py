"""Bounded samples of rows, for fitting models: by hash, so without a sort and the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = 1 << 30


def below(share: Column, *by: str) -> Column:
    """True for about ``share`` of the values of ``by``."""
    return F.pmod(F.xxhash64(*by), F.lit(_STEPS)) < share * _STEPS


def bounded(rows: DataFrame, bound: int, by: list[str], group: str | None = None) -> DataFrame:
    """About ``bound`` rows (of each ``group``, of which there are few), or all where there are fewer."""
    if group is None:
        count = rows.count()
        return rows if count <= bound else rows.filter(below(F.lit(bound / count), *by))
    counts = rows.groupBy(group).count().collect()
    shares = [(r[group], bound / r["count"]) for r in counts if r["count"] > bound]
    if not shares:
        return rows
    share = F.create_map(*[x for g, s in shares for x in (F.lit(g), F.lit(s))])
    return rows.filter(below(F.coalesce(F.try_element_at(share, F.col(group)), F.lit(1.0)), *by))
