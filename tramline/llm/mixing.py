"""Mixing sources to target weights by hash-threshold histograms, in DataFrame functions only.

Sizes are summed by source and hash bucket. Each source's budget then falls into one bucket: everything
below it is taken, and only that bucket is summed again by the next digits of the hash, until single
hash values are left. The result is one threshold per source, so the mix is a filter without a sort, and
mixes of growing budgets are nested. Texts are never shuffled where the sources are few, nor those of any source with many rows.

A target above its source's size is met by repeating: every document is taken ``floor(target / size)``
times and those below the threshold once more. A document is never taken more than ``most`` times, as
targets stop at ``most`` times the source's size.

Defined cases: a null text has size 0 and is taken 0 words; a null source is a source of its own, last in
order; the hash covers id and text, so rows equal in both share one decision (at most such a group
stands between a source's taken words and its target); an empty table gives no rows; further columns
are kept; names starting with ``mix__`` are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.session import cut_lineage

#: Up to so many sources their plan is broadcast. Of more, those with over ``1 / FEW`` of the rows (so at most as many) are,
#: and the others meet their plan by a join on the source, in which none of them weighs much.
FEW = 10_000
#: Hex digits of the hash by which one round tells buckets apart, and how many rounds: 15 digits (60 bits) decide.
DIGITS, ROUNDS = 3, 5


def words(text: Column) -> Column:
    """Number of runs of non-space characters."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def position(doc: Column, text: Column) -> Column:
    """A document's place in its source's order: leading hex digits of a hash of id and text."""
    return F.substring(F.md5(F.concat(F.coalesce(doc.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit("")))), 1, DIGITS * ROUNDS)


def targets(sizes: DataFrame, most: float = 3.0, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """source, source_size -> also target. One row per source.

    The targets stop where a common level times the weight exceeds ``most`` times the size: with sources
    ordered by ``size / weight`` the stopped ones come first, and the level is what the others share.
    The windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("mix__limit", F.col("source").isNull(), F.col("source").cast("binary")).rowsBetween(Window.unboundedPreceding, -1)
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    ranked = sizes.withColumn("mix__weight", F.element_at(weights, ((F.row_number().over(order) - 1) % len(cycle) + 1).cast("int")))
    ranked = ranked.withColumn("mix__limit", most * F.col("source_size") / F.col("mix__weight"))
    ranked = ranked.select(
        "*",
        F.sum("source_size").over(every).alias("mix__total"), F.sum("mix__weight").over(every).alias("mix__weights"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("mix__size_before"),
        F.coalesce(F.sum("mix__weight").over(before), F.lit(0.0)).alias("mix__weight_before"),
    )
    level = (F.col("mix__total") - most * F.col("mix__size_before")) / (F.col("mix__weights") - F.col("mix__weight_before"))
    ranked = ranked.withColumn("mix__level", F.max(F.when(level <= F.col("mix__limit"), level)).over(every))
    target = F.when(
        F.col("mix__level").isNull() | (F.col("mix__limit") < F.col("mix__level")), most * F.col("source_size")
    ).otherwise(F.col("mix__level") * F.col("mix__weight"))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def with_plan(rows: DataFrame, source: str, plan: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Rows with what ``plan`` (``mix__source`` and more) says of their source; rows of other sources go.

    ``hot``: sources (``mix__hot``, at most ``FEW``) whose rows must not meet in one task; None where the plan has ``FEW`` rows at most.
    """
    same = F.col(source).eqNullSafe(F.col("mix__source"))
    if hot is None:
        return rows.join(F.broadcast(plan), same)
    planned = F.col("mix__source").eqNullSafe(F.col("mix__hot"))
    many = rows.join(F.broadcast(plan.join(F.broadcast(hot), planned, "left_semi")), same)
    return many.union(rows.join(F.broadcast(hot), F.col(source).eqNullSafe(F.col("mix__hot")), "left_anti").join(plan, same))


def thresholds(rows: DataFrame, goals: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """rows: source, size, place; goals: source, budget; hot: as in ``with_plan``. -> source, threshold: places below it are within budget.

    Each round keeps the buckets of the source's boundary prefix, one row per bucket (at most 16 ** DIGITS
    of each source), and moves on to the bucket in which the running sum passes the budget. At the end the
    boundary holds one hash value, which is taken if that brings the sum nearer to the budget.
    """
    open_ = goals.select(F.col("source").alias("mix__source"), F.col("budget").alias("mix__left"), F.lit("").alias("mix__prefix"))
    for k in range(1, ROUNDS + 1):
        inside = with_plan(rows, "source", open_, hot).filter(F.substring("place", 1, (k - 1) * DIGITS) == F.col("mix__prefix"))
        buckets = inside.groupBy("source", "mix__left", F.substring("place", 1, k * DIGITS).alias("mix__bucket")).agg(F.sum("size").alias("mix__size"))
        running = F.sum("mix__size").over(Window.partitionBy("source").orderBy("mix__bucket").rowsBetween(Window.unboundedPreceding, 0))
        buckets = buckets.withColumn("mix__upto", running)
        passed = buckets.filter(F.col("mix__upto") > F.col("mix__left"))
        first = passed.groupBy("source").agg(F.min(F.struct("mix__bucket", "mix__upto", "mix__size", "mix__left")).alias("b"))
        left = F.col("b.mix__left") - (F.col("b.mix__upto") - F.col("b.mix__size"))
        open_ = cut_lineage(first.select(F.col("source").alias("mix__source"), left.alias("mix__left"), F.col("b.mix__bucket").alias("mix__prefix"), F.col("b.mix__size").alias("mix__size")))
        if k < ROUNDS:
            open_ = open_.drop("mix__size")
    above = F.concat(F.col("mix__prefix"), F.lit("~"))  # sorts behind every place with that prefix
    return open_.select(F.col("mix__source").alias("source"), F.when(2 * F.col("mix__left") > F.col("mix__size"), above).otherwise(F.col("mix__prefix")).alias("threshold"))


def mix(docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", most: float = 3.0, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target, copies (how often it is in the mix) and taken.

    Columns of these names in ``docs`` are replaced.
    """
    sized = docs.select(
        *[c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")],
        words(F.col(text)).alias("size"), position(F.col(doc), F.col(text)).alias("mix__place"),
    )
    slim = cut_lineage(sized.select(F.col(source).alias("source"), "size", F.col("mix__place").alias("place")))
    sizes = cut_lineage(slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("mix__rows")))
    hot = None
    if sizes.count() > FEW:
        rows = sizes.agg(F.sum("mix__rows")).first()[0]
        hot = sizes.filter(F.col("mix__rows") * FEW > rows).select(F.col("source").alias("mix__hot"))
    goals = cut_lineage(targets(sizes.drop("mix__rows"), most, cycle))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    plan = goals.withColumn("mix__whole", whole).withColumn("mix__budget", F.col("target") - F.col("mix__whole") * F.col("source_size"))
    cuts = thresholds(slim.filter("size > 0"), plan.select("source", F.col("mix__budget").alias("budget")).filter("budget > 0"), hot)
    plan = plan.join(cuts.withColumnRenamed("source", "mix__s"), F.col("source").eqNullSafe(F.col("mix__s")), "left").select(
        F.col("source").alias("mix__source"), "source_size", "target", "mix__whole", F.coalesce("threshold", F.lit("")).alias("mix__threshold")
    )
    copies = F.col("mix__whole") + (F.col("mix__place") < F.col("mix__threshold")).cast("bigint")
    return (
        with_plan(sized, source, cut_lineage(plan), hot)
        .withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("mix__source", "mix__whole", "mix__threshold", "mix__place")
    )


def materialised(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row ``copies`` times."""
    taken = mixed.filter("copies > 0")
    return taken.withColumn("mix__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("mix__copy")
