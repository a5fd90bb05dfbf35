"""Reimbursement mails to structured rows, with deterministic acceptance rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.dates import short_period
from tramline.operators.joins import last_by
from tramline.operators.reshape import ensure_columns, union_all

# Labels of the mail form, one value per line.
FIELDS = {
    "staff_id": r"PersoneelsID:\s*(\d+)",
    "entity": r"Gekozen entiteit:.*-\s*(.*)",
    "period": r"Periode:\s*(\d{2}/\d{4})",
    "distance": r"Afstand:\s*(\d+(?:,\d+)?)",
    "single_trips": r"Totaal aantal dagen enkele rit:\s*(\d+)",
    "return_trips": r"Totaal aantal dagen heen-en-terug:\s*(\d+)",
    "departure": r"Vertrekplaats:\s*(.*)",
}
# '<weekday> <day> <month> <year>: <kind>'. The possessive parts cannot match differently, as each
# is followed by another character class; they spare the back-tracking over long texts.
DAY_LINE = r"(?U)(?<!\w)(\w++)\s++(\d++)\s++(\w++)\s++(\d{4}):\s++(.*)"
MAX_DISTANCE_KM = 30

# Dutch month names as written in day lines.
_MONTHS = [
    "januari", "februari", "maart", "april", "mei", "juni",
    "juli", "augustus", "september", "oktober", "november", "december",
]


def extract_mails(mails: DataFrame, body: str) -> DataFrame:
    """Fields and day lines of every mail that has all fields; others are dropped.

    Each pattern scans a text once and gives its matched line; the value is cut out of that
    line. The row is built inside a generator, which keeps the optimiser from evaluating the
    scans a second time for the completeness filter.
    """
    # Without a match the line is empty and so is the value.
    scans = [F.regexp_extract(F.col(body), p, 0).alias(f) for f, p in FIELDS.items()]
    scans.append(F.regexp_extract_all(F.col(body), F.lit(DAY_LINE), F.lit(0)).alias("lines"))
    whole = F.filter(F.array(F.struct(*scans)), lambda m: ~F.array_contains(F.array(*(m[f] for f in FIELDS)), ""))
    found = mails.select("*", F.inline(whole))
    value = {f: F.trim(F.regexp_extract(F.col(f), p, 1)) for f, p in FIELDS.items()}
    value["distance"] = F.replace(value["distance"], F.lit(","), F.lit(".")).cast("double")
    value["single_trips"] = value["single_trips"].cast("int")
    value["return_trips"] = value["return_trips"].cast("int")
    value["period_short"] = short_period(value["period"])
    parsed = found.withColumns(value).filter(F.col("period_short").isNotNull())
    return parsed.withColumn("days", F.transform("lines", _day)).drop("lines")


def _day(line: Column) -> Column:
    part = [F.regexp_extract(line, DAY_LINE, i) for i in range(6)]
    return F.struct(
        part[2].try_cast("int").alias("day"),
        F.array_position(F.array(*map(F.lit, _MONTHS)), F.lower(part[3])).cast("int").alias("month"),
        part[4].cast("int").alias("year"),
        F.contains(F.lower(part[5]), F.lit("heen en terug")).alias("both_ways"),
    )


def accepted(mail: DataFrame) -> DataFrame:
    """Mails within the rules: plausible distance, days inside the period, no day twice."""
    month = F.split("period", "/")[0].cast("int")
    year = F.split("period", "/")[1].cast("int")
    inside = F.forall("days", lambda d: (d["month"] == month) & (d["year"] == year))
    once = F.size(F.array_distinct(F.transform("days", lambda d: d["day"]))) == F.size("days")
    return mail.filter((F.col("distance") <= MAX_DISTANCE_KM) & F.coalesce(inside, F.lit(False)) & once)


def day_slots() -> Column:
    """31 distances by day of month; all zero unless the day lines match the declared totals."""
    declared = F.col("single_trips") + F.col("return_trips")

    def slot(i: Column) -> Column:
        hits = F.filter("days", lambda d: d["day"] == i)
        last = F.element_at(hits, -1)
        return F.when(F.size(hits) == 0, F.lit(0.0)).when(
            last["both_ways"], F.col("distance") * 2
        ).otherwise(F.col("distance"))

    filled = F.transform(F.sequence(F.lit(1), F.lit(31)), slot)
    return F.when(F.size("days") == declared, filled).otherwise(F.array_repeat(F.lit(0.0), 31))


def reimbursements(mails: DataFrame, mail_id: str, body: str) -> DataFrame:
    """Accepted mails as wide reimbursement rows (dag 1..dag 31)."""
    rows = accepted(extract_mails(mails, body)).withColumn("slots", day_slots())
    total = F.col("distance") * (F.col("return_trips") * 2 + F.col("single_trips"))
    return rows.select(
        F.col(mail_id).alias("mail_id"),
        F.col("staff_id").cast("int"),
        "entity",
        F.col("departure").alias("campus"),
        total.alias("total_km"),
        F.col("period_short").alias("period"),
        *(F.get("slots", F.lit(i)).alias(f"dag {i + 1}") for i in range(31)),
    )


def process_new(raw: DataFrame, final: DataFrame, mail_id: str, body: str) -> DataFrame:
    """Final table after adding the mails not processed before.

    Rows of older files may lack ``mail_id``. Of rows with equal staff, period and distance
    the newest stays: mails outrank id-less rows, a higher id outranks a lower one.
    """
    final = ensure_columns(final, {"mail_id": "long"})
    done = final.select(F.col("mail_id").alias(mail_id)).filter(F.col(mail_id).isNotNull()).distinct()
    todo = raw.join(done, mail_id, "left_anti").filter(F.trim(F.col(body)) != "")
    both = union_all([final, reimbursements(todo, mail_id, body)])
    ranked = both.withColumn("__rank", F.coalesce(F.col("mail_id").cast("long"), F.lit(-1)))
    return last_by(ranked, ["staff_id", "period", "total_km"], ["__rank"]).drop("__rank")
