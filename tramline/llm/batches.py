"""How much text a Python worker is handed at a time, and what it gives back afterwards."""

from __future__ import annotations

import ctypes
import ctypes.util
import gc
from collections.abc import Callable
from functools import lru_cache, wraps

import pyarrow as pa
from pyspark.sql import SparkSession

_KEY, _MOST = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20


def small(spark: SparkSession, most: int = _MOST) -> None:
    """Lower the session's Arrow batches to 16 MB or ``most``: a worker holds a few times that while it works on texts."""
    now = spark.conf.get(_KEY, None) or ""
    digits = now.rstrip("bB")
    if not digits.isdigit() or int(digits) > most:
        spark.conf.set(_KEY, f"{most}b")


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    """The C library's way to give freed memory back, where it has one."""
    name = ctypes.util.find_library("c")
    return getattr(ctypes.CDLL(name), "malloc_trim", None) if name else None


_held: dict[tuple, object] = {}


def held(key: tuple, build: Callable[[], object]):
    """``build()``, kept for the batches to come. A worker keeps one model at a time, whichever operator it serves."""
    if key not in _held:
        _held.clear()
        _held[key] = build()
    return _held[key]


def _begin(keep: bool) -> None:
    if not keep:
        _held.clear()


def _end() -> None:
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def tidy(keep: bool = False) -> Callable[[Callable], Callable]:
    """Of a function of a batch: before it, the model of another operator goes (unless ``keep``: the function uses ``held``); after
    it, freed memory goes back to the machine, as workers wait idle between stages. With ``keep`` garbage collection
    waits until the batch is done, as it would walk through the whole model again and again.
    """

    def around(work: Callable) -> Callable:
        @wraps(work)
        def run(*columns):
            _begin(keep)
            pause = keep and gc.isenabled()
            if pause:
                gc.disable()
            try:
                return work(*columns)
            finally:
                if pause:
                    gc.enable()
                _end()

        return run

    return around
