"""Counter series, site catalogues and titles out of stored HTML pages.

All parsing is done by JVM expressions over the whole page text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.text import clean_label, find_first, strip_tags
from tramline.functions.values import empty_to_null, let

_POINT = "struct<timestamp: string, traffic: struct<counts: int>>"
_SERIES = f"array<struct<direction: string, directionName: string, data: array<{_POINT}>>>"


def embedded_array(html: Column, key: str) -> Column:
    r"""Text from the '[' after ``key":`` to its matching ']', with \" unescaped.

    The matching bracket is where the running count of brackets first returns to zero. The
    text is cut at its closing brackets and only the pieces' opening brackets are counted.
    """
    start = F.regexp_instr(html, F.lit(rf'{key}\\?":\s*\['))
    return let(F.when(start > 0, F.substr(html, start)), lambda tail: let(F.substr(tail, F.instr(tail, "[")), _balanced))


def _balanced(tail: Column) -> Column:
    return let(F.split(tail, r"\]"), _rejoin)


def _rejoin(pieces: Column) -> Column:
    """The pieces up to the one that closes the first bracket, joined again."""
    opens = F.transform(pieces, lambda p: F.length(p) - F.length(F.replace(p, F.lit("["), F.lit(""))))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("taken"), F.lit(False).alias("done"))

    def step(acc: Column, opened: Column) -> Column:
        # Depth after a piece: the openings so far minus its closing bracket.
        depth = acc["depth"] + opened - 1
        return F.struct(
            depth.alias("depth"),
            F.when(acc["done"], acc["taken"]).otherwise(acc["taken"] + 1).alias("taken"),
            (acc["done"] | (depth == 0)).alias("done"),
        )

    def body(walked: Column) -> Column:
        text = F.concat(F.array_join(F.slice(pieces, F.lit(1), walked["taken"]), "]"), F.lit("]"))
        return F.when(walked["done"], F.replace(text, F.lit('\\"'), F.lit('"')))

    return let(F.aggregate(opens, start, step), body)


def _direction(series: Column, name: str) -> Column:
    return F.get(F.filter(series, lambda s: s["direction"] == name), F.lit(0))


def counter_series(pages: DataFrame, point: str, html: str) -> DataFrame:
    """Daily counts per page: in/out series zipped, or a single series counted as 'in'.

    Output: point, day, direction_in, direction_out, total. Each page is parsed once.
    """
    two_way = F.from_json(embedded_array(F.col(html), "directionGraphData"), _SERIES)
    one_way = F.from_json(embedded_array(F.col(html), "chartData"), _SERIES)
    has_two = F.rlike(F.col(html), F.lit(r'directionGraphData\\?":\s*\['))

    def zipped(series: Column) -> Column:
        into, out = _direction(series, "in")["data"], _direction(series, "out")["data"]
        pairs = F.slice(F.arrays_zip(into.alias("i"), out.alias("o")), F.lit(1), F.least(F.size(into), F.size(out)))
        return F.when(
            into.isNotNull() & out.isNotNull(), F.transform(pairs, lambda z: _count(z["i"], z["i"], z["o"]))
        )

    def single(series: Column) -> Column:
        return F.transform(F.flatten(F.transform(series, lambda s: s["data"])), lambda d: _count(d, d, None))

    counts = F.when(has_two, let(two_way, zipped)).otherwise(let(one_way, single))
    return pages.select(point, F.inline(counts)).select(
        point,
        F.col("day").cast("date").alias("day"),
        "direction_in",
        "direction_out",
        (F.col("direction_in") + F.col("direction_out")).alias("total"),
    )


def _count(at: Column, into: Column, out: Column | None) -> Column:
    return F.struct(
        F.split(at["timestamp"], "T")[0].alias("day"),
        into["traffic"]["counts"].alias("direction_in"),
        (F.lit(0) if out is None else out["traffic"]["counts"]).alias("direction_out"),
    )


def direction_names(pages: DataFrame, point: str, html: str) -> DataFrame:
    """Names of the two directions; a one-way page uses its title for the first."""
    series = F.from_json(embedded_array(F.col(html), "directionGraphData"), _SERIES)
    title = empty_to_null(page_title(F.col(html)))

    def label(side: str) -> Column:
        return F.trim(F.split(_direction(F.col("__s"), side)["directionName"], "->")[0])

    return pages.select(point, series.alias("__s"), title.alias("__title")).select(
        point,
        F.when(F.col("__s").isNull(), F.col("__title")).otherwise(empty_to_null(label("in"))).alias("direction_name_in"),
        empty_to_null(label("out")).alias("direction_name_out"),
    )


def page_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1))


def visible_text(html: Column) -> Column:
    return F.trim(F.regexp_replace(strip_tags(html), r"\s+", " "))


def site_catalogue(pages: DataFrame, html: str, known: DataFrame | None = None) -> DataFrame:
    """Counting sites announced in a page's pushed script chunks, one row per site id.

    Sites without a location block are skipped; of repeated ids the first in the text stays.
    Sites already in ``known`` (counting_point_id) are left out.
    """
    chunks = F.regexp_extract_all(F.col(html), F.lit(r'(?s)self\.__next_f\.push\(\[1,"(.*?)"\]\)'), F.lit(1))
    text = F.replace(F.replace(F.array_join(chunks, ""), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))
    objects = F.split(text, r'(?=\{"id":\d{8,},)')
    rows = pages.select(F.posexplode(objects).alias("__pos", "c"))
    c = F.col("c")
    site = rows.filter(c.contains('"location":{')).select(
        "__pos",
        find_first(c, r'^\{"id":(\d+)').alias("id"),
        empty_to_null(find_first(c, r'"customId":"(.*?)"')).alias("custom_id"),
        clean_label(find_first(c, r'"name":"(.*?)"')).alias("name"),
        find_first(c, r'"lat":(-?\d+\.\d+)').try_cast("double").alias("latitude"),
        find_first(c, r'"lon":(-?\d+\.\d+)').try_cast("double").alias("longitude"),
        F.left(find_first(c, r'"firstData":"(.*?)"'), F.lit(10)).alias("first_data"),
        F.left(find_first(c, r'"lastData":"(.*?)"'), F.lit(10)).alias("last_data"),
        find_first(c, r'"granularity":"(.*?)"').alias("granularity"),
        (find_first(c, r'"directional":(true|false)')).alias("directional"),
        find_first(c, r'"domain":\{"id":(\d+)').try_cast("int").alias("domain_id"),
        clean_label(find_first(c, r'"domain":\{"id":\d+,"name":"(.*?)"\}')).alias("domain_name"),
        empty_to_null(clean_label(find_first(c, r'"description":"(.*?)"'))).alias("description"),
        find_first(c, r'"addressPostcode":"(.*?)"').alias("postcode"),
    ).filter(F.col("id") != "")
    fields = [f for f in site.columns if f not in ("__pos", "id")]
    first = site.groupBy(F.col("id").cast("long").alias("counting_point_id")).agg(
        F.min_by(F.struct(*fields), "__pos").alias("f")
    )
    out = first.select("counting_point_id", *(F.col(f"f.{f}").alias(f) for f in fields))
    # A site without usable coordinates cannot be placed.
    out = out.filter(F.col("longitude").isNotNull() & (F.col("longitude") != 0))
    if known is not None:
        out = out.join(known.select(F.col("counting_point_id").cast("long")).distinct(), "counting_point_id", "left_anti")
    return out
