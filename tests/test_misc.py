"""Remaining table-driven checks: SQL names, flag filter, views, date parsing, approx percentiles."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import stats
from tessera.plans import standins as S
from tessera.sources import io


def test_case_insensitive_sql_and_temp_view_p11_s12(spark):
    dim = io.from_rows(spark, [("US1", 40.5, -74.0)], "Station string, Latitude double, Longitude double")
    io.register_view(dim, "stations_tmp")
    r = spark.sql("SELECT station, latitude FROM stations_tmp").first()
    assert r[0] == "US1" and r[1] == 40.5


def test_second_pass_flag_filter_p14(spark):
    df = io.from_rows(spark, [(1, 1), (2, 0), (3, 1)], "id int, TPWS2 long")
    assert [r["id"] for r in df.where(F.col("TPWS2") == 1).orderBy("id").collect()] == [1, 3]


def test_date_parsing_f22(spark):
    df = spark.createDataFrame([("Sep-1-1987", "2010-04-01 12:00:00.123456")], "d string, t string")
    r = df.select(F.to_date("d", "MMM-d-yyyy").alias("d"), F.try_to_timestamp("t", F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("t")).first()
    assert r["d"] == dt.date(1987, 9, 1)
    assert r["t"].microsecond == 123456


def test_missing_marker_to_null(spark):
    df = io.from_rows(spark, [(1, -999.9), (2, 10.0)], "id int, elevation double")
    got = {r["id"]: r["elevation"] for r in io.missing_marker_to_null(df, "elevation").collect()}
    assert got == {1: None, 2: 10.0}


def test_extreme_percentiles_exact_vs_approx(spark):
    e = S.table(spark, SF_SMALL, "events", "event_id", "value")
    ex = stats.extreme_percentiles(e, "value", "event_id", method="exact").first()
    ap = stats.extreme_percentiles(e, "value", "event_id", method="approx").first()
    vals = sorted(r["value"] for r in e.collect())
    n = len(vals)
    assert ex["low100"] == vals[n // 100] and ex["high100"] == vals[-(n // 100)]
    assert ap["low100"] == pytest.approx(ex["low100"], rel=0.05, abs=1.0)


def test_null_fraction_without_grid(spark):
    df = io.from_rows(spark, [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)], "yr int, st string, v double")
    got = {r["st"]: r["null_fraction"] for r in stats.null_fraction(df, "yr", "st", "v", by="st").collect()}
    assert got == {"a": 0.0, "b": 0.5}
