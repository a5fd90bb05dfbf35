"""Every operator and report on the shared test tables, each with the SQL it must equal."""

from tramline.catalog import (  # noqa: F401
    builders,
    cleaning,
    columns,
    functions,
    grouping,
    incremental,
    joining,
    landed,
    models,
    params,
    quality,
    reporting,
    reshaping,
    statistics,
    streams,
    texts,
    warehouse,
    windowing,
)
from tramline.catalog.base import COVERS, ORACLES, QUERIES

__all__ = ["COVERS", "ORACLES", "QUERIES"]
