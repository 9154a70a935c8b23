import datetime as dt

import pytest

from vigil.functions.dates import parse_offset
from vigil.operators.timeliness import on_time_rows, timeliness


def test_site_timeliness_golden(sites):
    row = timeliness(sites, "last_sync", "days:-1", as_of="2024-03-10", database="ods", table="sites").collect()[0]
    assert row["expected_date"] == "2024-03-09"
    assert (row["count_data"], row["count_timely"], row["timeliness_pct"]) == (2, 1, 50.0)
    row = timeliness(sites, "last_sync", "days:-1", as_of="2024-03-12").collect()[0]
    assert row["timeliness_pct"] == 0.0


def test_empty_table_gives_null(spark):
    df = spark.createDataFrame([], "d date")
    row = timeliness(df, "d", "days:-1", as_of="2024-01-02").collect()[0]
    assert row["count_data"] == 0 and row["timeliness_pct"] is None


def test_timestamp_matches_whole_day(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0),), (dt.datetime(2024, 1, 1, 23, 59),), (dt.datetime(2024, 1, 2, 0, 0),)],
        "ts timestamp_ntz",
    )
    row = timeliness(df, "ts", "days:-1", as_of=dt.date(2024, 1, 2)).collect()[0]
    assert row["count_timely"] == 2
    assert on_time_rows(df, "ts", 0, as_of="2024-01-02").count() == 1


def test_date_column_and_default_as_of(spark):
    df = spark.createDataFrame([(dt.date.today() - dt.timedelta(days=1),)], "d date")
    assert timeliness(df, "d").collect()[0]["timeliness_pct"] == 100.0


def test_offsets():
    assert parse_offset("days:-1") == -1
    assert parse_offset("days: 3") == 3
    assert parse_offset(-2) == -2
    with pytest.raises(ValueError):
        parse_offset("hours:-1")


def test_rejects_other_types(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(TypeError):
        timeliness(df, "x")
