"""Typed reads that keep what they cannot read, and forecast loads that lose no value."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierline.model import table_spec
from tierline.operators import rows
from tierline.plans import forecast
from tierline.scratch import scratch_path
from tierline.sources import files

TYPES = {"day": "date", "at": "timestamp", "amount": "decimal(10,2)", "n": "int", "name": "string"}


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)
    return f"{folder}/{name}"


def _told(df):
    return {(r["name"] or r[files.SOURCE_TEXT]): r[files.SOURCE_REASON] for r in df.collect()}


def test_rows_are_typed_once_and_bad_ones_keep_text_and_reason(spark, tmp_path):
    head = "Day;At;Amount;N;Name\n"
    body = (
        "2026-01-02;2026-01-02T03:04:05;1.50;7;good\n"
        ";;;;empty\n"
        "soon;2026-01-02T00:00:00;1;1;day\n"
        "2026-01-02;never;x;1.5;three\n"
        "2026-02-30;;;;no such day\n"
        ";;12345678901;;digits\n"
        "2026-01-02;2026-01-02T00:00:00;1;1\n"
        '2026-01-02;;;;"quoted; text"\n'
        "2026-01-02;2026-01-02T00:00:00;1;1;more;cells\n"
    )
    other = "name,n,extra\nsecond,3,x\nbad,y,z\n"
    paths = [_write(tmp_path, "a.csv", head + body), _write(tmp_path, "b.csv", other), _write(tmp_path, "c.csv", "name,n\n")]
    read = files.read_rescued(spark, paths, TYPES)
    assert {f.name: f.dataType.simpleString() for f in read.schema.fields if f.name in TYPES} == TYPES
    told = _told(read)
    assert {k: v for k, v in told.items() if v} == {
        "day": "day", "three": "at,amount,n", "no such day": "day", "digits": "amount", "bad": "n",
        "2026-01-02;2026-01-02T00:00:00;1;1": "cells", "more": "cells",
    }
    assert {"good", "empty", "quoted; text", "second"} <= {k for k, v in told.items() if not v}
    good = read.filter("name = 'good'").first()
    assert (good["day"], good["at"], good["n"], good[files.SOURCE_TEXT]) == (dt.date(2026, 1, 2), dt.datetime(2026, 1, 2, 3, 4, 5), 7, None)
    bad = read.filter("name = 'three'").first()
    assert bad[files.SOURCE_TEXT] == "2026-01-02;never;x;1.5;three" and bad[files.SOURCE_PATH].endswith("a.csv")
    assert files.read_rescued(spark, [], TYPES).count() == 0


def test_one_bad_row_holds_back_its_file(spark):
    df = spark.createDataFrame([("f", 1), ("f", -1), ("g", 2), (None, 3), (None, -3), ("h", None)], "path string, n int")
    good, bad = rows.split_whole(df, F.coalesce(F.col("n") < 0, F.lit(False)), "path")
    assert sorted(map(str, good.collect())) == sorted(map(str, df.filter("path in ('g', 'h') or n = 3").collect()))
    assert Counter(tuple(r) for r in bad.collect()) == Counter([("f", 1), ("f", -1), (None, -3)])


FORECAST_HEAD = "CLIENT_NAME,CLIENT_GROUP_NAME,PARTNER_NAME,PARTNER_GROUP_NAME,PERIOD_START_DATE,TRAFFIC_VOLUME,FORECAST_OR_ACTUAL_IND\n"


@pytest.fixture
def landed(tmp_path):
    good = _write(f"{tmp_path}/landed", "good.csv", FORECAST_HEAD + "a,A,p,P,2026-01-01T00:00:00,1.5,F\n" * 2)
    bad = "b,B,p,P,2026-02-01T00:00:00,7,F\nb,B,p,P,soon,bad,A\n"
    return good, _write(f"{tmp_path}/landed", "bad.csv", FORECAST_HEAD + bad)


def test_forecast_files_with_unreadable_values_are_held_back_whole(spark, landed):
    bad = scratch_path(spark, "bad")
    forecast.load_forecast(spark, "typed", forecast.read_forecast(spark, list(landed)), "0", "2026-03-01 00:00:00", bad)
    bronze = spark.table(table_spec("forecast", "bronze").full_name("typed"))
    assert [(r["client_name"], float(r["traffic_volume"])) for r in bronze.collect()] == [("a", 1.5)] * 2
    held = spark.read.option("header", True).csv(f"{bad}/_batch=0").collect()
    assert sorted(r["error_message"] for r in held) == ["file", "period_start_date,traffic_volume"]
    assert {r[files.SOURCE_TEXT] for r in held} == {None, "b,B,p,P,soon,bad,A"}
    # Mended, the file comes again in its batch; nothing is held back any more.
    rows_ = [("b", "B", "p", "P", "2026-02-01T00:00:00", "7", "F")]
    again = spark.createDataFrame(rows_, ", ".join(f"{c} string" for c in FORECAST_HEAD.strip().split(",")))
    forecast.load_forecast(spark, "typed", again, "0", "2026-03-02 00:00:00", bad)
    assert [r["client_name"] for r in bronze.sparkSession.table(table_spec("forecast", "bronze").full_name("typed")).collect()] == ["b"]
    assert spark.read.option("header", True).csv(f"{bad}/_batch=0").count() == 0


@pytest.mark.parametrize("as_text", [True, False])
def test_without_quarantine_an_unreadable_value_fails_the_load_before_it_writes(spark, landed, as_text):
    raw = forecast.read_forecast(spark, list(landed))
    if as_text:
        raw = files.read_delimited(spark, list(landed))
    tenant = f"strict{int(as_text)}"
    with pytest.raises(ValueError, match="traffic_volume"):
        forecast.load_forecast(spark, tenant, raw, "0", "2026-03-01 00:00:00")
    assert spark.table(table_spec("forecast", "bronze").full_name(tenant)).count() == 0
