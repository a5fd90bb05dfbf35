"""Joins with the key semantics of the warehouse.

No side is ever hinted as broadcast: Spark broadcasts a side only when its measured size
is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with AQE
splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Names = Sequence[str]


def _same(left: DataFrame, right: DataFrame, keys: Names) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def new_rows(df: DataFrame, existing: DataFrame, keys: Names) -> DataFrame:
    """Rows of ``df`` whose key is not in ``existing``; NULL equals NULL, types are kept."""
    known = existing.select(*keys).distinct().alias("known")
    batch = df.alias("batch")
    on = reduce(lambda a, b: a & b, (F.col(f"batch.{k}").eqNullSafe(F.col(f"known.{k}")) for k in keys))
    return batch.join(known, on, "left_anti")


def known_rows(df: DataFrame, dim: DataFrame, keys: Names) -> DataFrame:
    """Rows whose key occurs in ``dim`` (membership filter, EXISTS)."""
    return df.join(dim.select(*keys).distinct(), list(keys), "left_semi")


def orphans(df: DataFrame, column: str, dim: DataFrame, dim_column: str) -> DataFrame:
    """Rows with a non-NULL foreign key that ``dim`` lacks."""
    targets = dim.select(F.col(dim_column).alias("__target")).distinct()
    return df.filter(F.col(column).isNotNull()).join(targets, F.col(column) == F.col("__target"), "left_anti")


def lookup(df: DataFrame, dim: DataFrame, on: dict[str, str], take: dict[str, str], how: str = "left") -> DataFrame:
    """Add ``{new: dim column}`` by equality of ``{df column: dim column}``."""
    right = dim.select(
        *(F.col(d).alias(f"__k{i}") for i, d in enumerate(on.values())),
        *(F.col(c).alias(new) for new, c in take.items()),
    )
    cond = reduce(lambda a, b: a & b, (F.col(c) == F.col(f"__k{i}") for i, c in enumerate(on)))
    return df.join(right, cond, how).drop(*(f"__k{i}" for i in range(len(on))))


def reconcile(left: DataFrame, right: DataFrame, keys: Names, out: str = "provenance") -> DataFrame:
    """Full outer join of two feeds, tagged both / left_only / right_only.

    Non-key columns keep their name on the left and get the suffix ``_right`` on the right.
    """
    a = left.withColumn("__l", F.lit(True))
    b = right.select(
        *(F.col(k).alias(f"__{k}") for k in keys),
        *(F.col(c).alias(f"{c}_right") for c in right.columns if c not in keys),
        F.lit(True).alias("__r"),
    )
    on = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    tag = F.when(F.col("__l").isNull(), "right_only").when(F.col("__r").isNull(), "left_only").otherwise("both")
    return a.join(b, on, "full").select(
        *(F.when(F.col("__l").isNull(), F.col(f"__{k}")).otherwise(F.col(k)).alias(k) for k in keys),
        *(c for c in left.columns if c not in keys),
        *(f"{c}_right" for c in right.columns if c not in keys),
        tag.alias(out),
    )


def on_days(intervals: DataFrame, start: str, end: str, ordinal: str, label: str, day: str = "day") -> DataFrame:
    """Intervals to one labelled row per day; where they overlap the highest ordinal wins.

    Turns a range join into an equality join on the day. The highest ordinal of each day is found first: its buffer
    has a fixed width, so the days of all intervals are aggregated by hash and never sorted, and only the intervals
    that win a day carry their label on.
    """

    def days(rows: DataFrame, *columns: str) -> DataFrame:
        kept = rows.filter(F.col(start) <= F.col(end))
        return kept.select(F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))).alias(day), *columns)

    numbered = intervals.withColumn("__o", F.col(ordinal))
    top = days(numbered, "__o").groupBy(day).agg(F.max("__o").alias("__top"))
    winners = numbered.join(top.select(F.col("__top").alias("__o")).distinct(), "__o", "left_semi")
    labels = days(winners.withColumn("__l", F.col(label)), "__o", "__l").join(
        top.select(F.col(day).alias("__day"), "__top"), (F.col(day) == F.col("__day")) & (F.col("__o") == F.col("__top"))
    )
    won = labels.groupBy(day).agg(F.max("__l").alias(label))
    return top.select(day).join(won, day, "left")


def first_by(df: DataFrame, keys: Names, order: Names, take: Names) -> DataFrame:
    """First row per key by an explicit order, as a combinable aggregate (no sort per key)."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*take), F.struct(*order)).alias("__f")).select(
        *keys, *(F.col(f"__f.{c}").alias(c) for c in take)
    )


def last_by(df: DataFrame, keys: Names, order: Names) -> DataFrame:
    """Deduplicate on ``keys`` keeping the row with the highest order."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__l"))
    return picked.select(*keys, *(F.col(f"__l.{c}").alias(c) for c in rest)).select(*df.columns)


def name_parts(name: Column) -> Column:
    """Lower-case pieces of a hyphenated or spaced name."""
    return F.filter(F.split(F.lower(name), r"[-\s]"), lambda p: p != "")


def named_within(
    df: DataFrame, text: str, dim: DataFrame, on: Names, name: str, rank: str, out: str, whole_first: bool = False
) -> DataFrame:
    """First dim name (by ``rank``), within equal ``on`` keys, that ``text`` contains whole or in part.

    With ``whole_first`` a whole-name hit anywhere in the list beats a part hit.
    """
    subjects = df.select(*on, text).filter(F.col(text).isNotNull()).distinct()
    options = dim.select(*on, name, rank)
    lowered = F.lower(F.col(text))
    whole = F.contains(lowered, F.lower(F.col(name)))
    part = F.exists(name_parts(F.col(name)), lambda p: F.contains(lowered, p))
    level = F.when(whole, 0).otherwise(1) if whole_first else F.lit(0)
    hits = subjects.join(options, list(on)).filter(whole | part)
    best = hits.groupBy(*on, text).agg(F.min_by(name, F.struct(level, F.col(rank))).alias(out))
    return df.join(best, [*on, text], "left")


def location_cascade(df: DataFrame, locations: DataFrame, name: str | None = None) -> DataFrame:
    """Link rows to a location key.

    ``df`` brings ``postal_code`` (from the coordinates) plus ``alt_postal_code`` and
    ``alt_municipality`` (second opinion); ``locations`` has location_key, postal_code,
    municipality (title case). Order of attempts: the municipality of an unambiguous postal
    code, else the second opinion; then (postal code, municipality), municipality alone, a
    municipality of the postal code named in ``name``, the first location of the postal code.
    The first location is the one with the lowest key.
    """
    from tramline.functions.text import title_case

    by_code = locations.groupBy(F.col("postal_code").alias("__c1")).agg(
        F.count(F.lit(1)).alias("__n"), F.min("municipality").alias("__only")
    )
    step = df.join(by_code, F.col("postal_code") == F.col("__c1"), "left")
    unique = F.coalesce(F.col("__n") == 1, F.lit(False))
    step = step.withColumns(
        {
            "__code": F.when(unique, F.col("postal_code")).otherwise(F.col("alt_postal_code")),
            "__town": title_case(F.when(unique, F.col("__only")).otherwise(F.col("alt_municipality"))),
        }
    )
    both = locations.groupBy(F.col("postal_code").alias("__c2"), F.col("municipality").alias("__m2")).agg(
        F.min("location_key").alias("__k_both")
    )
    town = locations.groupBy(F.col("municipality").alias("__m3")).agg(F.min("location_key").alias("__k_town"))
    code = locations.groupBy(F.col("postal_code").alias("__c4")).agg(F.min("location_key").alias("__k_code"))
    step = (
        step.join(both, (F.col("__code") == F.col("__c2")) & (F.col("__town") == F.col("__m2")), "left")
        .join(town, F.col("__town") == F.col("__m3"), "left")
        .join(code, F.col("__code") == F.col("__c4"), "left")
    )
    attempts = ["__k_both", "__k_town"]
    if name is not None:
        # Only places no equality matched are compared by name; a NULL text matches nothing.
        open_name = F.when(F.col("__k_both").isNull() & F.col("__k_town").isNull(), F.col(name))
        step = named_within(
            step.withColumn("__open", open_name), "__open", locations, ["postal_code"], "municipality", "location_key", "__named"
        )
        named = town.select(F.col("__m3").alias("__m5"), F.col("__k_town").alias("__k_named"))
        step = step.join(named, F.col("__named") == F.col("__m5"), "left")
        attempts.append("__k_named")
    attempts.append("__k_code")
    found = F.when(F.col("__town").isNotNull(), F.coalesce(*(F.col(a) for a in attempts)))
    return step.withColumn("location_key", found).select(*df.columns, "location_key")


# --- closest name -------------------------------------------------------------------------

_CUTOFF = 0.6


def closest_name(df: DataFrame, column: str, options: DataFrame, option: str, out: str = "match", unknown: str = "unknown") -> DataFrame:
    """The option most like the name, with a similarity of at least 0.6, else ``unknown``.

    Similarity is 1 less the edit distance over the longer length. Each distinct name is compared once,
    with the options it can reach (see ``_candidate_pairs``); equal similarities go to the
    alphabetically last option.
    """
    names = df.select(F.col(column).alias("__name")).filter(F.col("__name").isNotNull()).distinct()
    listed = options.select(F.col(option).alias("__option")).filter(F.col("__option").isNotNull()).distinct()
    longer = F.greatest(F.length("__name"), F.length("__option"), F.lit(1))
    score = 1 - F.levenshtein("__name", "__option") / longer.cast("double")
    best = (
        _candidate_pairs(names, listed)
        .withColumn("__score", score)
        .filter(F.col("__score") >= _CUTOFF)
        .groupBy("__name")
        .agg(F.max_by("__option", F.struct("__score", "__option")).alias(out))
    )
    joined = df.join(best, F.col(column) == F.col("__name"), "left").drop("__name")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(unknown)))


def _candidate_pairs(names: DataFrame, options: DataFrame) -> DataFrame:
    """Pairs that can reach the cutoff: the rarest characters of both must meet, and the lengths must be near.

    An edit distance of at most 0.4 n, n the longer length, leaves at least 0.6 n characters (counted with
    repetition) in common. So each shares at least 0.6 of its own characters with any partner, and in one order of all
    characters two partners meet within the first ``length - ceil(0.6 length) + 1`` of each. Rare
    characters come first in that order, so that few pairs meet; how often each occurs is counted in the data.
    """

    def characters(df: DataFrame, col: str) -> DataFrame:
        chars = F.array_sort(F.filter(F.split(F.col(col), ""), lambda c: c != ""))
        tagged = F.transform(chars, lambda c, i: F.struct(c.alias("c"), (i - F.array_position(chars, c) + 1).alias("k")))
        return df.select(col, F.explode(tagged).alias("t"))

    ours, theirs = characters(names, "__name"), characters(options, "__option")
    often = ours.select("t").union(theirs.select("t")).groupBy("t").agg(F.count(F.lit(1)).alias("__often"))

    def prefixed(found: DataFrame, col: str) -> DataFrame:
        ranked = found.join(often, "t").groupBy(col).agg(F.array_sort(F.collect_list(F.struct("__often", "t"))).alias("__order"))
        n = F.size("__order")
        first = F.slice("__order", F.lit(1), (n - F.ceil(n * 3 / 5) + 1).cast("int"))
        return ranked.select(col, F.explode(F.transform(first, lambda x: x.t)).alias("t"))

    shorter = F.least(F.length("__name"), F.length("__option"))
    longer = F.greatest(F.length("__name"), F.length("__option"))
    return prefixed(ours, "__name").join(prefixed(theirs, "__option"), "t").filter(shorter * 5 >= longer * 3).select("__name", "__option").distinct()
