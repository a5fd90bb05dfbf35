"""Scalar rules whose NULL, unknown-value or rounding behaviour is chosen on purpose."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _literal_map(mapping: dict[Any, Any]) -> Column:
    return F.create_map(*(F.lit(x) for x in chain.from_iterable(mapping.items())))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def map_values(value: Column, mapping: dict[Any, Any]) -> Column:
    """Dictionary lookup; a value outside the dictionary becomes NULL."""
    return F.try_element_at(_literal_map(mapping), value)


def replace_values(value: Column, mapping: dict[Any, Any]) -> Column:
    """Dictionary lookup; a value outside the dictionary stays as it is."""
    return F.coalesce(map_values(value, mapping), value)


def clip_floor(value: Column, floor: float = 0) -> Column:
    """Raise values below ``floor`` to it. NULL stays NULL (``greatest`` would return the floor)."""
    return F.when(value < floor, F.lit(floor)).otherwise(value)


def empty_to_null(text: Column) -> Column:
    """NULL for blank text, otherwise the text itself."""
    return F.when(F.trim(text) != "", text)


def lenient_number(text: Column, kind: str = "double") -> Column:
    """Number or NULL; accepts a decimal comma."""
    return F.replace(text.cast("string"), F.lit(","), F.lit(".")).try_cast(kind)


def lenient_boolean(text: Column) -> Column:
    """'True'/'false' text (or a boolean) to boolean, anything else to NULL."""
    lowered = F.lower(F.trim(text.cast("string")))
    return F.when(lowered == "true", True).when(lowered == "false", False)


def truncated_average(value: Column) -> Column:
    """Average of an integer column cut to an integer, as integer SQL engines report it."""
    return F.call_function("div", F.sum(value), F.count(value)).cast("bigint")


def circular_distance(a: Column, b: Column, cycle: int = 12) -> Column:
    """Shortest way round a cycle, e.g. between months."""
    gap = F.abs(a - b)
    return F.least(gap, F.lit(cycle) - gap)


def half_even(value: Column, digits: int = 0) -> Column:
    return F.bround(value, digits)


def one_hot(value: Column, levels: list[Any], prefix: str) -> list[Column]:
    """One 0/1 column per level."""
    return [F.when(value == F.lit(k), 1).otherwise(0).alias(f"{prefix}{k}") for k in levels]
