"""End-to-end loads: landed files to gold, repeated, in several batches, by stream."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierline import model
from tierline.operators import facts, marts, quality, shape
from tierline.plans import forecast, queries, settlement, usage
from tierline.scratch import scratch_path
from tierline.sources import derived, files
from tierline.streaming.landing import ingest_stream


def _bag(df, *columns):
    return Counter(map(tuple, df.select(*columns).collect()))


def _with_path(df, path="s3a://landing/tenant/EE/Bronze/Traffic/f.csv"):
    return df.withColumn(files.SOURCE_PATH, F.lit(path))


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


MONTHLY = [*model.USAGE_MONTHLY_GRAIN, "total_volume", "total_event_count", "distinct_imsi_count", "distinct_apn_count"]


def queries_sample():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landed(spark):
    rows = derived.usage_raw(spark, queries_sample()).filter(F.col("Call Month").between("1995-01", "1995-02"))
    path = scratch_path(spark, "landed")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_usage_batches_equal_one_load(spark, landed):
    early, late = landed.filter("`Call Date` < '1995-02'"), landed.filter("NOT `Call Date` < '1995-02'")
    quarantine = scratch_path(spark, "bad")
    for batch, part in (("0", early), ("1", late), ("0", early)):
        usage.load_usage(spark, "Twice", _with_path(part), batch, "2026-01-01 00:00:00", quarantine)

    bronze = usage.usage_bronze(landed)
    fact = facts.usage_fact(bronze)
    stored_fact = spark.table("twice_silver.fact_imsi_level_traffic")
    assert _bag(stored_fact, *fact.columns) == _bag(fact, *fact.columns)

    dims = {d: spark.table(f"twice_silver.{d}") for d in model.USAGE_DIMENSIONS}
    for d in model.USAGE_DIMENSIONS.values():
        assert quality.duplicate_keys(dims[d.table], d.key).count() == 0
    daily = marts.usage_daily(fact, dims)
    stored_daily = spark.table("twice_gold.imsi_level_traffic_daily")
    assert _bag(stored_daily, *daily.columns) == _bag(daily, *daily.columns)
    stored_monthly = spark.table("twice_gold.client_partner_traffic_monthly")
    assert _bag(stored_monthly, *MONTHLY) == _bag(marts.usage_monthly(daily), *MONTHLY)
    assert quality.duplicate_keys(stored_monthly, *model.USAGE_MONTHLY_GRAIN).count() == 0

    invalid = usage.split_usage(usage.clean_usage(landed))[1].count()
    assert invalid > 0
    assert spark.read.parquet(quarantine).count() == invalid
    stored = spark.table("twice_bronze.imsi_level_traffic")
    assert usage.accepted_rows(spark, "twice").count() == bronze.count()
    assert stored.count() == bronze.count() + invalid


def test_forecast_batches_equal_one_load(spark):
    path = scratch_path(spark, "forecast")
    derived.forecast_raw(spark, queries_sample()).filter("PERIOD_START_DATE < '1995-05'").write.parquet(path)
    raw = spark.read.parquet(path)
    at = "2026-01-01 00:00:00"
    # The halves share months, so the second batch must add to what the first one stored.
    halves = [raw.filter("TRAFFIC_DIRECTION = 'CR'"), raw.filter("TRAFFIC_DIRECTION <> 'CR'")]
    for batch, half in (("0", halves[0]), ("1", halves[1]), ("0", halves[0])):
        forecast.load_forecast(spark, "fc", half, batch, at)

    fact = forecast.forecast_fact(forecast.forecast_bronze(raw, at), at)
    expected = {**forecast.GOLD, "forecast_monthly": marts.forecast_monthly}
    for domain, build in expected.items():
        whole = build(fact)
        stored = spark.table(model.table_spec(domain, "gold").full_name("fc"))
        assert _bag(stored, *whole.columns) == _bag(whole, *whole.columns), domain
    report = forecast.stored_quality_report(spark, "fc")
    failed = {r.check_name for r in report.collect() if not r.passed}
    assert "foreign_keys" not in failed and "volume_accuracy" not in failed and "dim_partner_uniqueness" not in failed


def test_settlement_load_repeats(spark):
    raw = _with_path(derived.settlement_raw(spark, queries_sample()), "s3a://b/tenant/EE/Gold/Settlement/s.csv")
    quarantine = scratch_path(spark, "bad")
    for _ in range(2):
        settlement.load_settlement(spark, "se", raw, "7", "2026-01-01 00:00:00", quarantine)
    stored = spark.table("se_gold.settlement")
    whole = settlement.settlement_gold(raw)
    assert _bag(stored, *whole.columns) == _bag(whole, *whole.columns)
    assert stored.select("_tenant", "_batch").distinct().collect() == [("ee", "7")]
    invalid = spark.read.csv(f"{quarantine}/_batch=7", header=True).count()
    assert invalid == raw.count() - stored.count() > 0


def test_discovery_and_layouts(spark, tmp_path):
    root = str(tmp_path)
    place = f"{root}/tenant/EE/Bronze/Traffic"
    _write(place, "a.csv", "\ufeffClient Operator;IMSI;IMSI\n x;1;2\n;;\n")
    _write(place, "b.CSV", '\n\nIMSI~"Client ~ Operator"\n7~q\n')
    _write(f"{place}/sub", "c.csv", "imsi\n9\n")
    for done in ("processed", "Failed/2026", "invalid", "original"):
        _write(f"{place}/{done}", "z.csv", "imsi\n1\n")
    _write(f"{root}/tenant/EE/Silver/Traffic", "z.csv", "imsi\n1\n")
    _write(f"{root}/tenant/EE/Bronze/Traffic/settlement", "z.csv", "imsi\n1\n")
    _write(place, "readme.txt", "no")
    found = files.discover_files(spark, root, "Traffic", "Bronze").collect()
    names = sorted(r.path.rsplit("/", 1)[1] for r in found)
    assert names == ["a.csv", "b.CSV", "c.csv"]
    assert {r.tenant for r in found} == {"ee"}

    paths = [r.path for r in found]
    layouts = {r.path.rsplit("/", 1)[1]: r.delimiter for r in files.detect_layouts(spark, paths).collect()}
    assert layouts == {"a.csv": ";", "b.CSV": "~", "c.csv": "~"}
    rows = files.read_files(spark, paths)
    assert {"client_operator", "imsi", "imsi_1", files.SOURCE_PATH} <= set(rows.columns)
    assert {r.imsi for r in rows.collect()} == {"1", None, "7", "9"}
    assert usage.clean_usage(rows).count() == 3


def test_typed_read_fails_on_a_bad_value(spark, tmp_path):
    _write(str(tmp_path), "f.csv", "n,s\n1,a\n,b\n")
    _write(str(tmp_path), "g.csv", "n,s\nx,a\n")
    schema = model.schema_of("n int, s string")
    assert {r.n for r in files.read_typed(spark, [f"{tmp_path}/f.csv"], schema).collect()} == {1, None}
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_typed(spark, [f"{tmp_path}/g.csv"], schema).collect()


def test_quoted_and_multi_line_values(spark, tmp_path):
    _write(str(tmp_path), "q.csv", 'home_pmn,Note\n"a,b","two\nlines ""quoted"""\n')
    row = files.read_delimited(spark, [f"{tmp_path}/q.csv"], multi_line=True).first()
    assert (row.home_pmn, row.note) == ("a,b", 'two\nlines "quoted"')


def test_missing_and_extra(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert {tuple(r) for r in shape.missing_and_extra(df, ["b", "c"]).collect()} == {("c", "missing"), ("a", "extra")}


def test_stream_loads_each_file_once(spark, tmp_path):
    root, checkpoint = f"{tmp_path}/landing", f"{tmp_path}/checkpoint"
    place = f"{root}/tenant/EE/Bronze/Traffic"
    archive = f"{tmp_path}/archive"
    seen = []

    def handler(tenant, raw, batch, loaded_at):
        assert tenant == "ee"
        seen.append((batch, sorted(r.imsi for r in usage.clean_usage(raw).collect()), loaded_at))

    def run():
        stream = ingest_stream(spark, root, "traffic", "bronze", checkpoint, handler, archive=archive)
        stream.awaitTermination()

    _write(place, "a.csv", "IMSI;Call Date\n1;20240101\n")
    run()
    run()
    _write(place, "b.csv", "IMSI|Call Date\n2|20240101\n")
    _write(f"{place}/processed", "c.csv", "IMSI\n3\n")
    run()
    assert [s[1] for s in seen] == [["1"], ["2"]]
    assert len({s[0] for s in seen}) == 2


def test_stream_feeds_the_usage_tables(spark, landed, tmp_path):
    place = f"{tmp_path}/landing/tenant/EE/Bronze/Traffic"
    landed.repartition(3).write.options(header=True, sep="|", ignoreLeadingWhiteSpace=False).csv(place)
    quarantine = scratch_path(spark, "bad")

    def handler(tenant, raw, batch, loaded_at):
        usage.load_usage(spark, "st", raw, batch, loaded_at, quarantine)

    stream = ingest_stream(
        spark, f"{tmp_path}/landing", "traffic", "bronze", f"{tmp_path}/checkpoint", handler, files_per_batch=2
    )
    stream.awaitTermination()
    stored = spark.table("st_silver.fact_imsi_level_traffic")
    direct = facts.usage_fact(usage.usage_bronze(landed.withColumn("RP-TADIG", F.expr("nullif(`RP-TADIG`, '')"))))
    assert _bag(stored, "traffic_fact_id", "volume", "event_count") == _bag(direct, "traffic_fact_id", "volume", "event_count")
    assert spark.table("st_bronze.imsi_level_traffic").select("_batch").distinct().count() == 2


def test_every_query_with_sql_is_registered():
    from tierline.plans import oracle

    assert set(oracle.sql()) <= set(queries.QUERIES)
    assert set(queries.QUERIES) == set(oracle.sql())


def test_repeat_on_another_day_with_fewer_days_replaces_the_batch(spark, landed):
    finished = F.coalesce(F.col("Batch ID"), F.lit("F")) == "F"
    first, other = landed.filter(finished), landed.filter(~finished)
    fewer = first.filter("`Call Month` <> '1995-01'")
    for batch, part, day in (("0", first, 1), ("1", other, 1), ("0", fewer, 2)):
        usage.load_usage(spark, "again", _with_path(part), batch, f"2026-01-0{day} 00:00:00", scratch_path(spark, "bad"))
    bronze = usage.usage_bronze(fewer.union(other))
    assert usage.accepted_rows(spark, "again").count() == bronze.count()
    fact = facts.usage_fact(bronze)
    assert _bag(spark.table("again_silver.fact_imsi_level_traffic"), *fact.columns) == _bag(fact, *fact.columns)
    # Members stay once they are known, so labels are those of the stored dimensions.
    dims = {d: spark.table(f"again_silver.{d}") for d in model.USAGE_DIMENSIONS}
    whole = marts.usage_monthly(marts.usage_daily(fact, dims))
    totals = [*model.USAGE_MONTHLY_GRAIN, "total_volume", "total_event_count"]
    assert _bag(spark.table("again_gold.client_partner_traffic_monthly"), *totals) == _bag(whole, *totals)


def test_streams_route_tenants_and_set_bad_files_aside(spark, tmp_path):
    root, failed = f"{tmp_path}/landing", f"{tmp_path}/failed"
    north, south = f"{root}/tenant/North/Bronze/Traffic", f"{root}/tenant/south/bronze/traffic"
    _write(north, "a.csv", "IMSI;Call Date\n1;20240101\n")
    _write(south, "b.csv", "IMSI;Call Date\n2;20240101\n")
    _write(south, "bad.parquet", "not a parquet file")
    _write(f"{root}/tenant/south/bronze/settlement", "s.csv", "IMSI\n9\n")
    seen = []

    def handler(tenant, raw, batch, loaded_at):
        seen.append((tenant, sorted(r.imsi for r in usage.clean_usage(raw).collect()), batch))

    for checkpoint in ("one", "two"):
        stream = ingest_stream(spark, root, "traffic", "bronze", f"{tmp_path}/{checkpoint}", handler, failed=failed, archive=f"{tmp_path}/done")
        stream.awaitTermination()
    assert sorted(s[:2] for s in seen) == [("north", ["1"])] * 2 + [("south", ["2"])] * 2
    assert len({s[2] for s in seen}) == 2
    listed = spark.read.parquet(failed).collect()
    assert {r.path.rsplit("/", 1)[1] for r in listed} == {"bad.parquet"} and all(r.reason for r in listed)
    assert os.path.exists(f"{root}/tenant/south/bronze/settlement/s.csv")


def test_rows_that_do_not_fit_their_header_or_type_are_rejected(spark, tmp_path):
    _write(str(tmp_path), "f.csv", "IMSI;Call Date;Duration;CDR Count\n1;20240101;1.5;3\n2;2024-13-45;1;3\n3;20240101;1;3.0\n4;20240101;12345678901234567;1\n5;20240101;1;3;extra\n6;20240101\n")
    cleaned = usage.clean_usage(files.read_files(spark, [f"{tmp_path}/f.csv"], aliases=model.USAGE_ALIASES))
    valid, invalid = usage.split_usage(cleaned)
    assert {r.imsi for r in valid.collect()} == {"1"}
    reasons = {r.imsi: r.reason for r in invalid.withColumn("reason", usage.usage_reasons(cleaned.columns)).collect()}
    assert reasons == {"2": "call_date", "3": "event_count", "4": "duration", "5": "cells", "6": "cells"}


def test_required_values_are_judged_by_the_rows_own_file(spark, tmp_path):
    _write(str(tmp_path), "a.csv", "Home PMN,Partner PMN\nh,\n")
    _write(str(tmp_path), "b.csv", "Home PMN,Note\nh,x\n")
    cleaned = settlement.clean_settlement(files.read_files(spark, [f"{tmp_path}/{n}.csv" for n in "ab"]))
    valid, invalid = settlement.split_settlement(cleaned)
    assert [r.note for r in valid.collect()] == ["x"] and invalid.count() == 1
