import json
from datetime import date, datetime

import pytest

from tramline.sources import access_log, files, mail, pages


def test_csv_with_semicolons_and_optional_file(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("id;km\n1;12,5\n2;\n")
    schema = "id int, km string"
    assert rows(files.read_csv(spark, str(tmp_path / "a.csv"), schema, ";")) == [(1, "12,5"), (2, None)]
    missing = files.read_optional(spark, str(tmp_path / "none.csv"), schema)
    assert missing.isEmpty() and missing.columns == ["id", "km"]
    (tmp_path / "empty.csv").write_text("")
    assert files.read_optional(spark, str(tmp_path / "empty.csv"), schema).isEmpty()


def test_value_labels(spark, tmp_path, rows):
    (tmp_path / "meta.json").write_text(json.dumps({"value_labels": {"labels4": {"15.0": "Trein", "14": "Fiets"}}}, indent=1))
    assert rows(files.read_labels(spark, str(tmp_path / "meta.json"))) == [("labels4", 14.0, "Fiets"), ("labels4", 15.0, "Trein")]


def test_liveboard(spark, tmp_path, rows):
    board = {"station_key": 1, "polled_at": "2026-03-21T09:00:00", "arrivals": {"arrival": [{"vehicle": "IC1", "time": "1774083600", "delay": "120", "canceled": "1"}]}}
    (tmp_path / "1.json").write_text(json.dumps(board))
    (tmp_path / "2.json").write_text(json.dumps({"station_key": 2, "polled_at": "2026-03-21T09:00:00"}))
    got = files.flatten_liveboard(files.read_json(spark, str(tmp_path), files.LIVEBOARD))
    assert rows(got) == [("IC1", 1, 20260321, 1000, 120, True, datetime(2026, 3, 21, 9, 0))]


def test_sinks(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 202601), (2, 202602)], "v int, month int")
    assert files.write_table(df, path, "overwrite", ["month"])
    assert not files.write_table(df.filter("false"), path)
    assert files.write_table(spark.createDataFrame([(9, 202602)], "v int, month int"), path, "overwrite", ["month"])
    assert rows(spark.read.parquet(path)) == [(1, 202601), (9, 202602)]
    files.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


def _page(kind, body):
    return f'<html><title> Site [x] </title><script>push("{{\\"{kind}\\":{json.dumps(body).replace(chr(34), chr(92) + chr(34))},\\"z\\":[1,[2]]}}")</script></html>'


def _series(direction, name, counts):
    return {"direction": direction, "directionName": name, "tags": [["a"], []], "data": [{"timestamp": f"2024-03-{i + 1:02d}T00:00", "traffic": {"counts": c}} for i, c in enumerate(counts)]}


def test_counter_series_shapes(spark, rows):
    data = [
        (1, _page("directionGraphData", [_series("in", "A -> B", [1, 2, 3]), _series("out", "B -> A", [4, 5])])),
        (2, _page("chartData", [_series(None, "", [7]), _series(None, "", [8])])),
        (3, "<html>nothing [here]</html>"),
        (4, _page("directionGraphData", [_series("in", "A -> B", [1])])),
        (5, 'x directionGraphData": [ [1, 2'),
        (6, None),
    ]
    df = spark.createDataFrame(data, "id int, html string")
    assert rows(pages.counter_series(df, "id", "html")) == [
        (1, date(2024, 3, 1), 1, 4, 5), (1, date(2024, 3, 2), 2, 5, 7), (2, date(2024, 3, 1), 7, 0, 7), (2, date(2024, 3, 1), 8, 0, 8)
    ]
    names = {r["id"]: (r["direction_name_in"], r["direction_name_out"]) for r in pages.direction_names(df, "id", "html").collect()}
    assert names[1] == ("A", "B") and names[2] == ("Site [x]", None) and names[4] == ("A", None) and names[3] == (None, None)


BODY = """Beste
PersoneelsID: 1001
Gekozen entiteit: School - DIT
Periode: 09/2025
Afstand: 12,5
Totaal aantal dagen enkele rit: 1
Totaal aantal dagen heen-en-terug: 1
Vertrekplaats: Gent
dinsdag 2 september 2025: enkele rit
woensdag 3 september 2025: Heen en terug
"""


@pytest.mark.parametrize(
    ("body", "slots"),
    [
        (BODY, [12.5, 25.0]),
        (BODY.replace("enkele rit: 1", "enkele rit: 4"), [0.0, 0.0]),
        (BODY.replace("Afstand: 12,5", "Afstand: 31"), None),
        (BODY.replace("woensdag 3", "woensdag 2"), None),
        (BODY.replace("3 september", "3 oktober"), None),
        (BODY.replace("Vertrekplaats", "Vertrek"), None),
        (BODY.replace("09/2025", "13/2025"), None),
    ],
)
def test_mail_rules(spark, body, slots):
    df = spark.createDataFrame([(7, body)], "id int, body string")
    got = mail.reimbursements(df, "id", "body").collect()
    if slots is None:
        assert got == []
    else:
        assert [got[0]["dag 2"], got[0]["dag 3"]] == slots
        assert (got[0]["staff_id"], got[0]["entity"], got[0]["campus"], got[0]["period"]) == (1001, "DIT", "Gent", "sep/25")


def test_mails_are_processed_once_and_newest_stays(spark, rows):
    raw = spark.createDataFrame([(1, BODY), (2, BODY), (3, " ")], "id long, body string")
    legacy = mail.reimbursements(raw.filter("id = 1"), "id", "body").drop("mail_id")
    final = mail.process_new(raw, legacy, "id", "body")
    assert rows(final, "mail_id", "staff_id") == [(2, 1001)]
    assert rows(mail.process_new(raw.filter("id = 2"), final, "id", "body"), "mail_id") == [(2,)]


def test_access_log(spark, tmp_path):
    (tmp_path / "a.log").write_text(
        '2026-05-04 10:57:13,362 remote=127.0.0.1 method=GET path="/" status=200 duration_ms=0.09 endpoint=root query=""\n'
        '2026-05-04 10:57:14,362 remote=127.0.0.1 method=GET path="/" status=404 duration_ms=0.11 endpoint=root query="a=1"\n'
        "not a request line\n"
    )
    got = access_log.endpoint_metrics(access_log.read_access_log(spark, str(tmp_path / "a.log"))).collect()
    assert len(got) == 1
    assert (got[0]["requests"], got[0]["errors"], got[0]["last_status"], got[0]["max_ms"]) == (2, 1, 404, 0.11)
    assert got[0]["avg_ms"] == pytest.approx(0.1)
