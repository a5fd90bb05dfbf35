"""Radius and nearest-neighbour joins over a grid instead of a cross product."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.geo import haversine_m

# A little less than the length of a degree, so that cells are never too small.
_DEGREE_M = 111_000
# Rows of one position that meet the like number of rows near it in one group.
_PART = 1024


def _cos(lat_degrees: Column) -> Column:
    return F.greatest(F.cos(F.radians(F.least(F.abs(lat_degrees), F.lit(89.0)))), F.lit(0.01))


def _row(lat: Column, metres: float) -> Column:
    return F.floor(lat / F.lit(metres / _DEGREE_M)).cast("long")


def _width(row: Column, metres: float) -> Column:
    """Cell width in degrees of a grid row, taken at the row's edge nearest to a pole."""
    height = metres / _DEGREE_M
    edge = F.greatest(F.abs(row * height), F.abs((row + 1) * height))
    return F.lit(height) / _cos(edge)


def _cell(lat: Column, lon: Column, metres: float) -> Column:
    row = _row(lat, metres)
    return F.struct(row.alias("r"), F.floor(lon / _width(row, metres)).cast("long").alias("c"))


def _reachable_cells(lat: Column, lon: Column, metres: float) -> Column:
    """Cells that may hold a point within ``metres``: three rows, the columns the circle spans."""
    row = _row(lat, metres)
    height = metres / _DEGREE_M
    reach = F.lit(height) / _cos(F.abs(lat) + 2 * height)

    def cells(r: Column) -> Column:
        width = _width(r, metres)
        columns = F.sequence(
            F.floor((lon - reach) / width).cast("long"), F.floor((lon + reach) / width).cast("long")
        )
        return F.transform(columns, lambda c: F.struct(r.alias("r"), c.alias("c")))

    return F.flatten(F.transform(F.array(row - 1, row, row + 1), cells))


def _near_spots(
    left: DataFrame, right: DataFrame, metres: float, left_xy: tuple[str, str], right_xy: tuple[str, str],
    distance: str,
) -> DataFrame:
    """All pairs at most ``metres`` apart (inclusive) of tables that hold each position once."""
    (la, lo), (ra, ro) = left_xy, right_xy
    a = left.filter(F.col(la).isNotNull() & F.col(lo).isNotNull()).withColumn(
        "__cell", _cell(F.col(la), F.col(lo), metres)
    )
    b = right.filter(F.col(ra).isNotNull() & F.col(ro).isNotNull()).withColumn(
        "__cell", F.explode(_reachable_cells(F.col(ra), F.col(ro), metres))
    )
    pairs = a.join(b, "__cell").drop("__cell")
    apart = haversine_m(F.col(la), F.col(lo), F.col(ra), F.col(ro))
    return pairs.withColumn(distance, apart).filter(F.col(distance) <= metres)


def within_radius(
    left: DataFrame, right: DataFrame, metres: float, left_xy: tuple[str, str], right_xy: tuple[str, str],
    distance: str = "distance_m", digits: int | None = None,
) -> DataFrame:
    """All pairs at most ``metres`` apart (inclusive), the distance rounded to ``digits`` if given.

    Distances are taken once per pair of distinct positions. The pairs of rows then come from an equality
    join on the left position, where the rows of both sides are dealt by hash into parts of about ``_PART``:
    each part meets each part of the other side once, so no task gets a whole position, however many rows share it.
    """
    (la, lo), (ra, ro) = left_xy, right_xy
    spots = left.groupBy(F.col(la).alias("__la"), F.col(lo).alias("__lo")).agg(F.count(F.lit(1)).alias("__n"))
    targets = right.groupBy(F.col(ra).alias("__ra"), F.col(ro).alias("__ro")).agg(F.count(F.lit(1)).alias("__m"))
    near = _near_spots(spots, targets, metres, ("__la", "__lo"), ("__ra", "__ro"), distance)
    if digits is not None:
        near = near.withColumn(distance, F.round(distance, digits))
    sized = near.groupBy("__la", "__lo").agg(
        F.ceil(F.max("__n") / _PART).cast("int").alias("__parts"), F.ceil(F.sum("__m") / _PART).cast("int").alias("__meets")
    )
    here = ["__la", "__lo"]

    def dealt(rows: DataFrame, parts: str) -> Column:
        hashed = [f.name for f in rows.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
        return F.pmod(F.xxhash64(*hashed), F.col(parts)).cast("int")

    def each(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    a = left.join(sized, (F.col(la) == F.col("__la")) & (F.col(lo) == F.col("__lo")))
    a = a.withColumn("__a", dealt(left, "__parts")).withColumn("__b", each("__meets")).drop("__parts", "__meets")
    b = right.join(near.join(sized, here), (F.col(ra) == F.col("__ra")) & (F.col(ro) == F.col("__ro"))).drop("__ra", "__ro", "__n", "__m")
    b = b.withColumn("__b", dealt(right, "__meets")).withColumn("__a", each("__parts")).drop("__parts", "__meets")
    # Merged, as a broadcast would leave all pairs to the few tasks that scan the left table.
    return a.join(b.hint("merge"), [*here, "__a", "__b"]).drop(*here, "__a", "__b")


def nearest(
    left: DataFrame, right: DataFrame, metres: float, left_xy: tuple[str, str], right_xy: tuple[str, str],
    right_key: str, out: str = "nearest_key",
) -> DataFrame:
    """Key of the closest right row within ``metres``, else NULL; ties go to the smallest key.

    Both sides are reduced to distinct positions first, so copies of a position cost nothing.
    """
    la, lo = left_xy
    spots = left.select(F.col(la).alias("__la"), F.col(lo).alias("__lo")).distinct()
    targets = right.groupBy(F.col(right_xy[0]).alias("__ra"), F.col(right_xy[1]).alias("__ro")).agg(
        F.min(right_key).alias("__key")
    )
    pairs = _near_spots(spots, targets, metres, ("__la", "__lo"), ("__ra", "__ro"), "__d")
    best = pairs.groupBy("__la", "__lo").agg(F.min_by("__key", F.struct("__d", "__key")).alias(out))
    on = (F.col(la) == F.col("__la")) & (F.col(lo) == F.col("__lo"))
    return left.join(best, on, "left").drop("__la", "__lo")


def near_any(
    left: DataFrame, right: DataFrame, metres: float, left_xy: tuple[str, str], right_xy: tuple[str, str]
) -> DataFrame:
    """Left rows with at least one right row within ``metres``."""
    la, lo = left_xy
    spots = left.select(F.col(la).alias("__la"), F.col(lo).alias("__lo")).distinct()
    targets = right.select(F.col(right_xy[0]).alias("__ra"), F.col(right_xy[1]).alias("__ro")).distinct()
    hit = _near_spots(spots, targets, metres, ("__la", "__lo"), ("__ra", "__ro"), "__d").select("__la", "__lo").distinct()
    return left.join(hit, (F.col(la) == F.col("__la")) & (F.col(lo) == F.col("__lo")), "left_semi")


assert _DEGREE_M < math.pi * 6_371_000 / 180
