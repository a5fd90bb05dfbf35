"""Not-modified revisits of a web archive resolved to full responses, in DataFrame functions.

A revisit record says that the server answered "not modified". It is joined as of its date to the latest earlier full
response of the same canonical URL; its validators (entity tag, else modification date; payload digest) must not
contradict that response's; then the response's headers are updated by those that such an answer may change,
and its payload stands for the revisit's.

The as-of join is a window over (URL, day), fed with the last response of earlier days, one row for each URL and
day: a URL with very many captures is spread over its days. Only record ids and validators go through the windows;
headers and payloads are joined to the result by record id, which must be unique.

Defined cases: a null or empty URL, or a null date, resolves to nothing; of responses at one moment the one with the larger id is later, and a
response at the revisit's own moment is not earlier; a validator that one side lacks is not checked; null headers are none;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a not-modified answer does not change: those that describe the stored body or one connection only.
KEPT = ("connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive", "te", "trailer", "transfer-encoding", "upgrade")


def canonical(url: Column) -> Column:
    """Lower-case scheme and host without a default port, no fragment, parameters sorted and without tracking."""
    plain = F.regexp_replace(url, "#.*$", "")
    base = F.regexp_replace(plain, r"\?.*$", "")
    origin = F.regexp_replace(F.lower(F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)), r"^(http://.*):80$|^(https://.*):443$", "$1$2")
    path = F.regexp_replace(base, "^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    given = F.split(F.regexp_extract(plain, r"\?(.*)$", 1), "&")
    params = F.array_sort(F.filter(given, lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|gclid|fbclid)=")))
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    return F.when(url != "", F.concat(origin, F.when(path == "", "/").otherwise(path), query))


def _lowered(headers: Column) -> Column:
    """Header names in lower case; of equal names the later one stays."""
    pairs = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e.key).alias("key"), e.value.alias("value")))
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(F.aggregate(pairs, empty, lambda acc, e: F.map_concat(F.map_filter(acc, lambda k, _: k != e.key), F.create_map(e.key, e.value))), empty)


def _agree(a: Column, b: Column) -> Column:
    return F.coalesce(a == b, F.lit(True))


def resolve(records: DataFrame) -> DataFrame:
    """records: record_id bigint, url, is_revisit, date timestamp, digest, headers map, payload.

    One row for each revisit: record_id, resolved_id (or null), status (resolved, contradicted, missing), headers, payload.
    """
    headers = _lowered(F.col("headers"))
    tag = F.regexp_replace(headers["etag"], "^W/", "")
    slim = records.select(
        "record_id", canonical(F.col("url")).alias("place"), F.coalesce("is_revisit", F.lit(False)).alias("is_revisit"), "date", F.to_date("date").alias("day"),
        F.struct("record_id", tag.alias("tag"), headers["last-modified"].alias("modified"), "digest").alias("said"),
    )
    usable = slim.filter("place is not null and date is not null")
    full = F.when(~F.col("is_revisit"), F.col("said"))
    # Of one moment revisits come first, so that a response at that moment is not yet seen.
    within = Window.partitionBy("place", "day").orderBy("date", F.col("is_revisit").desc(), "record_id").rowsBetween(Window.unboundedPreceding, 0)
    days = usable.filter("not is_revisit").groupBy("place", "day").agg(F.max_by("said", F.struct("date", "record_id")).alias("last"))
    days = days.unionByName(usable.filter("is_revisit").select("place", "day").distinct().withColumn("last", F.lit(None).cast(days.schema["last"].dataType)))
    days = days.groupBy("place", "day").agg(F.first("last", ignorenulls=True).alias("last"))
    before = Window.partitionBy("place").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select("place", "day", F.last("last", ignorenulls=True).over(before).alias("carried"))
    seen = usable.withColumn("today", F.last(full, ignorenulls=True).over(within)).filter("is_revisit")
    found = seen.join(carried, ["place", "day"]).select("record_id", "said", F.coalesce("today", "carried").alias("then"))
    lost = slim.filter("is_revisit and (place is null or date is null)").select("record_id", "said", F.lit(None).cast(found.schema["then"].dataType).alias("then"))
    found = found.union(lost)
    by_tag = F.col("said.tag").isNotNull() & F.col("then.tag").isNotNull()
    valid = F.when(by_tag, F.col("said.tag") == F.col("then.tag")).otherwise(_agree(F.col("said.modified"), F.col("then.modified")))
    valid = valid & _agree(F.col("said.digest"), F.col("then.digest"))
    status = F.when(F.col("then").isNull(), "missing").when(valid, "resolved").otherwise("contradicted")
    found = found.select("record_id", status.alias("status"), F.when(status == "resolved", F.col("then.record_id")).alias("resolved_id"))

    fresh = records.filter("is_revisit").select("record_id", headers.alias("fresh"))
    stored = records.filter("not coalesce(is_revisit, false)").select(F.col("record_id").alias("resolved_id"), headers.alias("stored"), "payload")
    joined = found.join(fresh, "record_id").join(stored, "resolved_id", "left")
    changes = F.map_filter("fresh", lambda k, _: ~k.isin(*KEPT))
    merged = F.map_concat(F.map_filter("stored", lambda k, _: ~F.map_contains_key(changes, k)), changes)
    return joined.select("record_id", "resolved_id", "status", F.coalesce(merged, F.col("fresh")).alias("headers"), "payload")
