"""Extraction from pages, mails and log lines. Every job reads the whole text column."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.catalog.base import Tables, query
from tramline.functions import text
from tramline.sources import access_log, mail, pages


def _point(day: str, count) -> list:
    return [F.lit(r'{\"timestamp\":\"' + day + r'T00:00:00\",\"traffic\":{\"counts\":'), count.cast("string"), F.lit("}}")]


def _series(direction: str, name, first, second) -> list:
    head = [F.lit(r'{\"direction\":\"' + direction + r'\",\"directionName\":\"'), name, F.lit(r'\",\"data\":[')]
    return [*head, *_point("2024-03-01", first), F.lit(","), *_point("2024-03-02", second), F.lit("]}")]


def _counter_pages(t: Tables):
    """Stored pages with a counter block appended: two-way on even ids, one-way on odd ones."""
    p = F.col("page_id")
    two = F.concat(
        F.lit(r'<script>push("{\"directionGraphData\":['),
        *_series("in", F.concat(F.lit("Stad "), p.cast("string"), F.lit(" -> Kust")), p % 100, p % 70),
        F.lit(","),
        *_series("out", F.lit("Kust -> Stad"), p % 50, p % 30),
        F.lit(r'],\"tags\":[\"x\"]}")</script>'),
    )
    one = F.concat(F.lit(r'<script>push("{\"chartData\":['), *_series("", F.lit(""), p % 90, p % 60), F.lit(r'],\"more\":[1]}")</script>'))
    return t.pages.select("page_id", F.concat("html", F.when(p % 2 == 0, two).otherwise(one)).alias("html"))


@query(
    "counter_series",
    "S11 F31 F5",
    """SELECT page_id, DATE '2024-03-01' AS day, (CASE WHEN page_id % 2 = 0 THEN page_id % 100 ELSE page_id % 90 END)::INT AS direction_in, (CASE WHEN page_id % 2 = 0 THEN page_id % 50 ELSE 0 END)::INT AS direction_out,
      (CASE WHEN page_id % 2 = 0 THEN page_id % 100 + page_id % 50 ELSE page_id % 90 END)::INT AS total FROM pages
    UNION ALL SELECT page_id, DATE '2024-03-02', (CASE WHEN page_id % 2 = 0 THEN page_id % 70 ELSE page_id % 60 END)::INT, (CASE WHEN page_id % 2 = 0 THEN page_id % 30 ELSE 0 END)::INT,
      (CASE WHEN page_id % 2 = 0 THEN page_id % 70 + page_id % 30 ELSE page_id % 60 END)::INT FROM pages""",
)
def counter_series(t: Tables):
    return pages.counter_series(_counter_pages(t), "page_id", "html")


@query(
    "direction_names",
    "S13 F5",
    """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'Stad ' || page_id ELSE nullif(trim(regexp_extract(html, '<title>(.*?)</title>', 1, 's')), '') END AS direction_name_in,
      CASE WHEN page_id % 2 = 0 THEN 'Kust' END AS direction_name_out FROM pages""",
)
def direction_names(t: Tables):
    return pages.direction_names(_counter_pages(t), "page_id", "html")


@query(
    "page_titles",
    "S13 F4",
    r"""SELECT page_id, trim(regexp_extract(html, '<title>(.*?)</title>', 1, 's')) AS title, length(regexp_replace(html, '<.*?>', '', 'g'))::INT AS text_length FROM pages""",
)
def page_titles(t: Tables):
    return t.pages.select("page_id", pages.page_title(F.col("html")).alias("title"), F.length(text.strip_tags(F.col("html"))).alias("text_length"))


def _catalogue_pages(t: Tables):
    """Stored pages with a site announced in two script chunks; ids repeat every 150 pages."""
    site = (F.col("page_id") % 150 + 10_000_000).cast("string")
    first = F.concat(
        F.lit(r'<script>self.__next_f.push([1,"x:[{\"id\":'), site, F.lit(r',\"customId\":\"c'), F.col("page_id").cast("string"), F.lit(r'\",\"name\":\"Teller <b>'), site
    )
    second = F.concat(
        F.lit(r'"])self.__next_f.push([1,"</b>,\",\"location\":{\"lat\":51.'), F.col("page_id").cast("string"),
        F.lit(r',\"lon\":3.5},\"firstData\":\"2020-01-01T00:00\",\"granularity\":\"PT15M\",\"directional\":true,\"domain\":{\"id\":77,\"name\":\"Vlaanderen\"},\"description\":\"\",\"addressPostcode\":\"9000\"}]"])</script>'),
    )
    return t.pages.select("page_id", F.concat("html", first, second).alias("html"))


@query(
    "site_catalogue",
    "S12 F4 F5 F8 P29",
    """SELECT (page_id % 150 + 10000000)::BIGINT AS counting_point_id, 'Teller ' || (page_id % 150 + 10000000) AS name, 3.5::DOUBLE AS longitude, '2020-01-01' AS first_data, 'PT15M' AS granularity, 'true' AS directional,
      77 AS domain_id, 'Vlaanderen' AS domain_name, NULL::VARCHAR AS description, '9000' AS postcode, count(*) > 0 AS found FROM pages WHERE page_id % 150 >= 3 GROUP BY page_id % 150""",
)
def site_catalogue(t: Tables):
    known = t.pages.select((F.col("page_id") % 150 + 10_000_000).alias("counting_point_id")).filter("counting_point_id < 10000003")
    sites = pages.site_catalogue(_catalogue_pages(t), "html", known)
    return sites.select(
        "counting_point_id", "name", "longitude", "first_data", "granularity", "directional", "domain_id", "domain_name", "description", "postcode",
        (F.col("custom_id").isNotNull() & (F.col("latitude") > 51)).alias("found"),
    )


@query("repaired_texts", "F8", "SELECT doc_id, text FROM documents")
def repaired_texts(t: Tables):
    """UTF-8 read as Latin-1 and repaired gives the text back."""
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return t.documents.select("doc_id", text.repair_mojibake(broken).alias("text"))


def _mails(t: Tables):
    """Documents with the reimbursement form appended; some break a rule."""
    d = F.col("doc_id")
    n = lambda c: c.cast("string")
    body = F.concat(
        "text", F.lit("\nPersoneelsID: "), n(d), F.lit("\nGekozen entiteit: School - E"), n(d % 5),
        F.lit("\nPeriode: 09/2025\nAfstand: "), n(d % 40), F.lit(",5\nTotaal aantal dagen enkele rit: 1\nTotaal aantal dagen heen-en-terug: "),
        F.when(d % 6 == 0, "3").otherwise("1"), F.lit("\nVertrekplaats: Gent \ndinsdag 2 september 2025: enkele rit\nwoensdag "),
        F.when(d % 7 == 0, "2").otherwise("3"), F.lit(" september 2025: Heen en terug\n"),
    )
    return t.documents.select("doc_id", body.alias("body"))


@query(
    "mail_reimbursements",
    "S14 J3 F5 F20 F21 F32",
    """SELECT doc_id AS mail_id, doc_id::INT AS staff_id, 'E' || doc_id % 5 AS entity, 'Gent' AS campus, (doc_id % 40 + 0.5)::DOUBLE * (CASE WHEN doc_id % 6 = 0 THEN 7 ELSE 3 END) AS total_km, 'sep/25' AS period,
      CASE WHEN doc_id % 6 = 0 THEN 0.0 ELSE (doc_id % 40 + 0.5) END::DOUBLE AS dag_2, CASE WHEN doc_id % 6 = 0 THEN 0.0 ELSE 2 * (doc_id % 40 + 0.5) END::DOUBLE AS dag_3, 0.0::DOUBLE AS dag_4
    FROM documents WHERE doc_id % 40 < 30 AND doc_id % 7 <> 0 AND NOT regexp_matches(text, '\\w+\\s+\\d+\\s+\\w+\\s+\\d{4}:\\s')""".replace("\\\\", "\\"),
)
def mail_reimbursements(t: Tables):
    rows = mail.reimbursements(_mails(t), "doc_id", "body")
    return rows.select("mail_id", "staff_id", "entity", "campus", "total_km", "period", F.col("dag 2").alias("dag_2"), F.col("dag 3").alias("dag_3"), F.col("dag 4").alias("dag_4"))


@query(
    "mails_processed_once",
    "R13 P10 P32",
    """SELECT doc_id % 2 = 0 AS was_known, count(*) AS n FROM documents WHERE doc_id % 40 < 30 AND doc_id % 7 <> 0 AND NOT regexp_matches(text, '\\w+\\s+\\d+\\s+\\w+\\s+\\d{4}:\\s') GROUP BY 1""".replace("\\\\", "\\"),
)
def mails_processed_once(t: Tables):
    mails = _mails(t)
    final = mail.reimbursements(mails.filter("doc_id % 2 = 0"), "doc_id", "body")
    both = mail.process_new(mails, final, "doc_id", "body")
    return both.groupBy((F.col("staff_id") % 2 == 0).alias("was_known")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "parsed_log_lines",
    "S18 A25",
    """SELECT date_trunc('second', ts) AS logged_at, '10.0.0.' || user_id AS remote, 'GET' AS method, '/points/' || event_id AS path, (200 + (props->>'k')::INT)::INT AS status, value AS duration_ms, event_type AS endpoint, 'n=' || event_id AS query FROM events""",
)
def parsed_log_lines(t: Tables):
    """Events written as request log lines and read back."""
    k = F.get_json_object("props", "$.k").cast("int")
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(",000 remote=10.0.0."), F.col("user_id").cast("string"), F.lit(' method=GET path="/points/'), F.col("event_id").cast("string"),
        F.lit('" status='), (k + 200).cast("string"), F.lit(" duration_ms="), F.format_string("%.2f", "value"), F.lit(" endpoint="), "event_type", F.lit(' query="n='), F.col("event_id").cast("string"), F.lit('"'),
    )
    noise = t.events.select(F.concat(F.lit("worker started "), F.col("event_id").cast("string")).alias("line"))
    return access_log.parse_access_log(t.events.select(line.alias("line")).unionByName(noise), "line")
