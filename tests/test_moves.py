"""How wide rows are when they move, and what landed files are: plans and small hand-made tables."""

import glob

import pytest
from pyspark.sql import functions as F

from tierline import model
from tierline.functions import packed_texts, unpacked_texts
from tierline.operators import codes, facts, marts, tables
from tierline.plans import forecast, queries, usage
from tierline.scratch import scratch_path, staged
from tierline.sources import derived
from tests.test_operators import RECORDS, _bronze
from tests.test_scale import _plan, folder  # noqa: F401

ODD = ("a", "", "\x1f", "\x1e", "\x1e0", "\x1e1", "a\x1fb", "\x1f\x1e")


def test_packed_texts_come_back_and_differ(spark):
    each = spark.createDataFrame([(x,) for x in ODD], "x string")
    pairs = each.crossJoin(each.withColumnRenamed("x", "y")).withColumn("packed", packed_texts("x", "y"))
    told = pairs.withColumn("told", unpacked_texts(F.col("packed")))
    assert told.filter("told[0] = x and told[1] = y and size(told) = 2").count() == len(ODD) ** 2
    assert pairs.select("packed").distinct().count() == len(ODD) ** 2


def test_usage_rows_move_as_one_text_and_the_subscriber(spark):
    bronze = _bronze(spark, RECORDS).withColumn("apn", F.explode(F.array(*[F.lit(x) for x in ODD])))
    for found in (facts.usage_fact(bronze), facts.usage_fact_by(bronze, model.USAGE_DIMENSIONS["dim_imsi"])):
        plan = _plan(found)
        below = plan[plan.index("Exchange hashpartitioning") :].split("\n")
        assert "AS _packed#" in next(x for x in below[1:] if "Project" in x)
        assert "keys=[imsi#" in plan and "keys=[client_pmn#" not in plan
    lines = facts.usage_lines(bronze)
    grain = [*model.USAGE_FACT_KEYS.values()]
    sums = [F.sum(m).alias(m) for m in model.USAGE_MEASURES]
    plain = lines.groupBy(*grain).agg(*sums, F.min("source_system").alias("source_system"), F.min("batch_id").alias("batch_id"))
    combined = facts.combine_usage(lines).select(*plain.columns)
    assert plain.exceptAll(combined).isEmpty() and combined.exceptAll(plain).isEmpty() and plain.count() >= len(ODD)


@pytest.mark.parametrize("apns", [3, 130])
def test_placed_daily_rows_give_the_same_months(spark, apns, monkeypatch):
    names = F.array(*[F.lit(x) for x in (None, "unknown", " UnKnown", "7", "8")])
    points = F.array(*[F.lit(str(k)) for k in range(apns)], F.lit(None))
    bronze = _bronze(spark, RECORDS).withColumn("imsi", F.explode(names)).withColumn("apn", F.explode(points))
    bronze = staged(bronze, "bronze")
    dimensions = usage.staged_dimensions(bronze)
    daily = usage.usage_daily(bronze, dimensions, placed=True)
    expected = marts.usage_monthly(usage.usage_daily(bronze, dimensions))
    for most in (codes.MOST_VALUES, 2):
        # With small dictionaries some columns, or the access points, stay text.
        monkeypatch.setattr(codes, "MOST_VALUES", most)
        found = marts.usage_monthly(daily, dimensions)
        assert found.dtypes == expected.dtypes
        assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    assert found.agg(F.max("distinct_apn_count")).first()[0] == apns


def test_months_of_placed_rows_move_daily_rows_once(spark):
    bronze = _bronze(spark, RECORDS)
    dimensions = usage.staged_dimensions(bronze)
    plan = _plan(marts.usage_monthly(usage.usage_daily(bronze, dimensions, placed=True), dimensions))
    # Once by subscriber, once by group, as numbers; the dimensions are broadcast.
    assert plan.count("Exchange hashpartitioning") == 2 and "inline" not in plan
    assert "_word0" in plan[plan.index("Exchange hashpartitioning") :].split("\n")[0]


def test_a_dictionary_numbers_values_in_their_order(spark):
    df = spark.createDataFrame([("b", 7), (None, 9), ("a", 7), ("a", None)], "t string, n int")
    made = codes.dictionaries({"t": df.select("t"), "n": df.select("n")})
    assert made.sizes == {"t": 2, "n": 2}
    places = made.places(["t", "n"])
    packed = made.packed(df.withColumns({"was_t": F.col("t"), "was_n": F.col("n")}), places)
    told = made.named(packed, places, {"t": "string", "n": "int"})
    assert packed.columns == ["was_t", "was_n", "_word0"]
    assert told.filter("t <=> was_t and n <=> was_n").count() == 4
    assert [r[0] for r in made.of("t").orderBy("code").select("value").collect()] == ["a", "b"]


def test_mixed_headers_land_packed(spark, folder, monkeypatch):  # noqa: F811
    seen = []
    read = queries.read_delimited
    monkeypatch.setattr(queries, "read_delimited", lambda s, paths, **more: seen.extend(paths) or read(s, paths, **more))
    assert queries.mixed_headers(spark, folder).count() == 4
    landed = [f for p in seen for f in glob.glob(f"{p.removeprefix('file:')}/part-*")]
    assert landed and all(f.endswith(".csv.gz") for f in landed)


def test_forecast_files_are_gathered_before_they_are_text(spark, folder):  # noqa: F811
    plan = _plan(derived.forecast_raw(spark, folder, gathered_by="s_nation"))
    moved = next(x for x in plan[plan.index("Exchange hashpartitioning(s_nation") :].split("\n")[1:] if "Project" in x)
    assert "l_extendedprice" in moved and "PARTNER_GROUP_NAME" not in moved and "c_nation#" not in moved
    files = queries._files_under(spark, queries._forecast_files(spark, folder))
    assert len(files) == 1 and files[0].endswith(".csv.gz")


def test_a_forecast_load_writes_its_rows_and_facts_once(spark, folder, monkeypatch):  # noqa: F811
    labels = []
    for module in (forecast, tables):
        monkeypatch.setattr(module, "staged", lambda df, label, **more: labels.append(label) or staged(df, label, **more))
    raw = queries._forecast_bronze(spark, folder)
    raw = staged(raw.withColumn("agreement_reference", F.explode(F.array(F.lit("x"), F.lit(None)))), "rows")
    for most in (codes.MOST_VALUES, 0):
        # Without dictionaries the rows move as they are.
        monkeypatch.setattr(codes, "MOST_VALUES", most)
        forecast.load_forecast(spark, f"narrow{most}", raw, "0", "2026-01-01 00:00:00", None, True)
        stored = spark.table(model.table_spec("forecast", "silver").full_name(f"narrow{most}")).drop("_batch", "created_at")
        expected = forecast.forecast_fact(forecast.forecast_bronze(raw, "2026-01-01 00:00:00"), "2026-01-01 00:00:00", "forecast_0")
        expected = expected.select(*stored.columns)
        assert stored.exceptAll(expected).isEmpty() and expected.exceptAll(stored).isEmpty() and expected.count() == 6
        assert expected.filter("iot_agreement_id is null").count() == 3
    assert "landed" not in labels and "fact" not in labels


def test_a_load_writes_packed_tables_and_bronze_in_split_methods(spark, monkeypatch):
    raw = _bronze(spark, RECORDS).withColumn("_source_path", F.lit("s3a://landing/tenant/EE/Bronze/Traffic/f.csv"))
    limits, write, limit = [], tables.replace_batch, "spark.sql.codegen.hugeMethodLimit"
    monkeypatch.setattr(tables, "replace_batch", lambda *more: limits.append(spark.conf.get(limit)) or write(*more))
    before = spark.conf.get(limit)
    spark.conf.set(limit, "65535")
    try:
        usage.load_usage(spark, "packed", raw, "0", "2026-01-01 00:00:00", scratch_path(spark, "bad"))
        assert limits == ["8000"] and spark.conf.get(limit) == "65535"
    finally:
        spark.conf.set(limit, before)
    written = [f for spec in usage.usage_specs() for f in spark.table(spec.full_name("packed")).inputFiles()]
    assert written and all(".zstd." in f for f in written)
