"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from tests.harness import TESTDATA, connect, differences
from tramline.catalog import COVERS, ORACLES, QUERIES

FOLDER = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not available")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).count() == 1


def test_every_query_names_what_it_covers():
    assert all(COVERS[name] for name in QUERIES)


@pytest.mark.parametrize("name", ["daily_rises", "quartiles", "promoted_arrivals", "standing_of_stations"])
def test_partition_count_does_not_matter(spark, rows, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        seen = []
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(rows(QUERIES[name](spark, FOLDER)))
        assert seen[0] == seen[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("name, column", [
    ("totals_since_start", "o_orderdate"), ("totals_on_day", "o_orderdate"), ("busiest_points", "o_orderdate"),
    ("wind_of_day", "l_shipdate"), ("availability_last_week", "ts"), ("last_seven_days", "ts"),
])
def test_day_range_reaches_the_scan(spark, capsys, name, column):
    QUERIES[name](spark, FOLDER).explain("formatted")
    pushed = [x for x in capsys.readouterr().out.splitlines() if x.startswith("PushedFilters")]
    assert any(f"GreaterThanOrEqual({column}," in x and f"LessThan({column}," in x for x in pushed), pushed
