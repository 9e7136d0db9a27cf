"""Row, shape, dimension, fact and quality operators on small hand-made frames."""

import datetime as dt
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tierline import model
from tierline.operators import dimensions, facts, marts, quality, rows, shape, tables


def test_normalized_names():
    assert shape.normalized_names(["A b", "a-B", "A b 1", "", "%%", "_x_", "a_b"]) == [
        "a_b", "a_b_1", "a_b_1_1", "col", "col_1", "x", "a_b_2",
    ]


def test_remap_takes_the_first_alias_and_drops_the_rest(spark):
    df = spark.createDataFrame([("1", "2", "3", "x")], "duration string, billed_minutes string, cdr_count string, note string")
    out = shape.remap_columns(df, model.USAGE_ALIASES)
    assert out.first().asDict() == {"duration": "2", "event_count": "3", "note": "x"}


def test_coalesce_aliases(spark):
    df = spark.createDataFrame([(None, "2"), ("1", "9")], "billed_minutes string, duration string")
    out = shape.coalesce_aliases(df, {"duration": ("billed_minutes", "duration")})
    assert [r.duration for r in out.collect()] == ["2", "1"]


def test_empty_rows_are_all_null_or_empty(spark):
    df = spark.createDataFrame([("", None), (None, None), (" ", None), ("a", "")], "a string, b string")
    assert rows.filter_empty_rows(df).count() == 2
    assert quality.empty_row_count(df).first().empty_rows == 2
    numbers = spark.createDataFrame([(None,), (0,)], "n bigint")
    assert rows.filter_empty_rows(numbers).count() == 1


def test_split_by_type(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "1.5"), ("01/02/2024", "1"), ("2024-01-01", "1e3"), ("", ""), (None, None)],
        "call_date string, volume string",
    )
    valid, invalid = rows.split_by_type(df, model.USAGE_TYPES)
    assert (valid.count(), invalid.count()) == (3, 2)


def test_split_by_required(spark):
    df = spark.createDataFrame([("a", "b"), (" ", "b"), ("a", None)], "home_pmn string, partner_pmn string")
    valid, invalid = rows.split_by_required(df, model.SETTLEMENT_REQUIRED_VALUES)
    assert (valid.count(), invalid.count()) == (1, 2)
    one = df.select("home_pmn")
    assert rows.split_by_required(one, model.SETTLEMENT_REQUIRED_VALUES)[0].count() == 3


def test_split_stats_of_nothing(spark):
    df = spark.createDataFrame([], "volume string")
    stats = rows.split_stats(df, rows.type_violation(df.columns, model.USAGE_TYPES)).first()
    assert (stats.valid_rows, stats.invalid_rows, stats.valid_pct) == (0, 0, Decimal("0.0"))


def test_align_to_schema(spark):
    df = spark.createDataFrame([("x", "12", "?")], "extra string, n string, bad string")
    out = shape.align_to_schema(df, model.schema_of("missing string, n int, bad int"))
    assert out.first().asDict() == {"missing": None, "n": 12, "bad": None}


def test_audit_columns(spark):
    df = spark.createDataFrame([("s3a://landing/tenant/EE/Bronze/Traffic/f.CSV",)], "p string")
    got = shape.add_audit_columns(
        df, F.col("p"), tenant=F.lit("EE"), layer="Bronze", domain="Traffic", ingested_at="2026-01-02 03:04:05"
    ).first()
    assert (got._source_bucket, got._source_key) == ("landing", "tenant/EE/Bronze/Traffic/f.CSV")
    assert (got._source_file_name, got._source_format, got._tenant) == ("f.CSV", "csv", "ee")
    assert (got._layer, got._stage, got._ingest_date) == ("bronze", "traffic", dt.date(2026, 1, 2))


def _bronze(spark, records):
    names = list(model.USAGE_FACT_KEYS.values()) + [*model.USAGE_MEASURES, "source_system", "batch_id"]
    names += ["roaming_partner_country", "destination_category"]
    full = [tuple(r.get(n) for n in names) for r in records]
    return spark.createDataFrame(full, ", ".join(f"{n} string" for n in names))


RECORDS = [
    {"client_pmn": " abc", "imsi": "1", "roamer_indicator": "P", "call_type": "V", "call_type_level_2": "x",
     "call_date": "2024-01-01", "call_month": "2024-01", "volume": "1.5", "partner_pmn": "q"},
    {"client_pmn": "ABC", "imsi": "1", "roamer_indicator": "P", "call_type": "V", "call_type_level_2": "x",
     "call_date": "2024-01-01", "call_month": "2024-01", "volume": "2.5", "partner_pmn": "q",
     "roaming_partner_country": "NL"},
    {"client_pmn": "ABC", "imsi": "1", "roamer_indicator": "T", "call_type": "V", "call_type_level_2": "y",
     "call_date": "2024-01-01", "call_month": "2024-01", "volume": "10", "partner_pmn": "q",
     "roaming_partner_country": "BE"},
    {"client_pmn": None, "imsi": "2", "volume": "bad", "call_date": "2024-01-02", "call_month": "2024-01"},
]


def test_fact_sums_spellings_together(spark):
    fact = facts.usage_fact(_bronze(spark, RECORDS))
    assert sorted(str(r.volume) for r in fact.collect()) == ["10.000000", "4.000000", "None"]
    assert fact.select("traffic_fact_id").distinct().count() == 3
    assert [f.name for f in fact.schema.fields] == [
        f.name for f in model.schema_of(model.USAGE_FACT_DDL).fields
    ]


def test_combining_partial_sums_equals_one_pass(spark):
    bronze = _bronze(spark, RECORDS * 3)
    once = facts.combine_usage(facts.usage_lines(bronze))
    halves = [facts.combine_usage(facts.usage_lines(_bronze(spark, part))) for part in (RECORDS, RECORDS * 2)]
    again = facts.combine_usage(halves[0].unionByName(halves[1]))
    assert Counter(map(tuple, once.collect())) == Counter(map(tuple, again.collect()))


def test_dimensions_hold_one_row_per_key(spark):
    bronze = _bronze(spark, RECORDS)
    for dim in model.USAGE_DIMENSIONS.values():
        built = dimensions.build_dimension(bronze, dim)
        assert built.count() == built.select(dim.key).distinct().count()
    client = dimensions.build_dimension(bronze, model.USAGE_DIMENSIONS["dim_client"])
    assert [r.pmn for r in client.collect()] == [" abc"]
    operator = dimensions.build_dimension(bronze, model.USAGE_DIMENSIONS["dim_operator"])
    assert [r.pmn_country for r in operator.collect()] == ["BE"]


def test_one_scan_members_equal_single_dimensions(spark):
    bronze = _bronze(spark, RECORDS)
    dims = list(model.USAGE_DIMENSIONS.values())
    members = dimensions.all_members(bronze, dims)
    for dim in dims:
        apart = dimensions.build_dimension(bronze, dim)
        together = dimensions.from_members(members.filter(F.col("dimension") == dim.table), dim)
        assert Counter(map(tuple, apart.collect())) == Counter(map(tuple, together.collect()))


def test_star_join_keeps_rows_and_totals(spark):
    bronze = _bronze(spark, RECORDS)
    fact = facts.usage_fact(bronze)
    built = {d.table: dimensions.build_dimension(bronze, d) for d in model.USAGE_DIMENSIONS.values()}
    daily = marts.usage_daily(fact, built).collect()
    assert len(daily) == 3
    assert sum(r.total_volume or 0 for r in daily) == Decimal("14")
    levels = {(r.call_type_level_2, r.roamer_indicator) for r in daily}
    assert levels == {("x", "P"), ("y", "T"), (None, None)}


def test_star_join_without_broadcast_survives_a_hot_key(spark):
    records = [{"imsi": "1", "client_pmn": str(i), "volume": "1", "call_date": "2024-01-01"} for i in range(300)]
    records += [{"imsi": str(i), "client_pmn": "c", "volume": "1", "call_date": "2024-01-01"} for i in range(100)]
    bronze = _bronze(spark, records)
    built = {d.table: dimensions.build_dimension(bronze, d) for d in model.USAGE_DIMENSIONS.values()}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        daily = marts.usage_daily(facts.usage_fact(bronze), built)
        assert daily.count() == 400
        assert daily.filter("imsi = '1'").count() == 301
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_monthly_against_brute_force(spark):
    bronze = _bronze(spark, RECORDS)
    built = {d.table: dimensions.build_dimension(bronze, d) for d in model.USAGE_DIMENSIONS.values()}
    daily = marts.usage_daily(facts.usage_fact(bronze), built)
    expected = defaultdict(set)
    for r in daily.collect():
        expected[tuple(r[c] for c in model.USAGE_MONTHLY_GRAIN)].add(r.imsi)
    got = {tuple(r[c] for c in model.USAGE_MONTHLY_GRAIN): r.distinct_imsi_count for r in marts.usage_monthly(daily).collect()}
    assert got == {k: len(v) for k, v in expected.items()}


def _forecast_fact(spark, records):
    ddl = (
        "client_master_entity_id bigint, iot_service_type_id bigint, traffic_direction string, "
        "period_start_date date, forecast_or_actual_ind string, traffic_volume decimal(20,6), "
        "tap_charge_sdr_net decimal(20,6)"
    )
    day = dt.date(2024, 7, 1)
    return spark.createDataFrame([(c, 1, "CR", day, i, Decimal(v), Decimal(v)) for c, i, v in records], ddl)


def test_variance(spark):
    fact = _forecast_fact(
        spark, [(1, "F", 12), (1, "A", 10), (2, "F", 5), (3, "A", 4), (None, "F", 3), (None, "A", 2), (4, "X", 9)]
    )
    got = {r.client_key: r for r in marts.forecast_variance(fact).collect()}
    assert set(got) == {"1", "2", "3", None}
    assert got["1"].variance_pct == Decimal("20.00")
    assert got["2"].variance_pct is None and got["2"].actual_traffic_volume == 0
    assert got["3"].variance_pct == Decimal("-100.00")
    assert got[None].variance_traffic == Decimal("1.00")
    joined = marts.forecast_variance_by_join(fact).collect()
    assert len([r for r in joined if r.client_key is None]) == 2
    assert {r for r in joined if r.client_key} == {r for r in got.values() if r.client_key}


def test_new_members(spark):
    candidates = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    existing = spark.createDataFrame([("a",)], "k string")
    assert {r.k for r in dimensions.new_members(candidates, existing, "k").collect()} == {"b", None}


def test_orphans_count_null_keys(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(2,)], "id int")
    got = {r.missing_key: r.fact_rows for r in quality.orphans(fact, "k", dim, "id").collect()}
    assert got == {1: 2, None: 1}
    assert quality.orphan_count(fact, "k", dim, "id").first().orphaned == 3
    assert quality.orphan_count(fact.filter("k = 2"), "k", dim, "id").first().orphaned == 0


def test_uniqueness_reports(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    assert quality.row_uniqueness(df).first().asDict() == {"total": 3, "unique_rows": 2}
    assert quality.row_uniqueness(df.limit(0)).first().asDict() == {"total": 0, "unique_rows": 0}
    assert [r.k for r in quality.duplicate_keys(df, "k").collect()] == [1]


def test_validation_of_an_empty_table_fails_softly(spark):
    empty = spark.createDataFrame([], "client_key string, n int")
    got = {r.check_name: r.passed for r in quality.validate_gold("t", empty, ["client_key"]).collect()}
    assert got == {"t_records": False, "t_duplicates": True}


def test_cell_issues_and_first_issues(spark):
    data = [(f"{i:04d}", "soon" if i % 2 else "2024-01-01", "1,000.5" if i % 3 else "x") for i in range(40)]
    df = spark.createDataFrame(data, "row_id string, agreement_start_date string, conversion_rate string")
    issues = quality.cell_issues(df, "row_id", ["agreement_start_date"], ["conversion_rate", "absent"])
    assert Counter(r.kind for r in issues.collect()) == {"INVALID_DATE_FORMAT": 20, "INVALID_VALUE": 14}
    first = quality.first_issues(issues, "row_id").collect()
    assert sorted(r.row_id for r in first if r.kind == "INVALID_VALUE") == ["0000", "0003", "0006", "0009", "0012"]


def test_first_issues_are_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([("1", "k", "c", "v")], "row_id string, kind string, column_name string, value string")
    plan = quality.first_issues(df, "row_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_week_over_week_uses_dates_not_positions(spark):
    days = [(dt.date(2024, 1, 1), 100), (dt.date(2024, 1, 8), 130), (dt.date(2024, 1, 9), 1), (dt.date(2024, 1, 15), 120)]
    daily = spark.createDataFrame(days, "day date, row_count bigint")
    assert [str(r.day) for r in quality.week_over_week(daily).collect()] == ["2024-01-08"]


def test_missing_days(spark):
    df = spark.createDataFrame([("2024-01-01", "F"), ("2024-01-03", "F"), ("2024-01-03", "A")], "d string, i string")
    got = quality.missing_days(df, F.col("d"), F.col("i"), ["F", "A"], "1 DAY").collect()
    assert sorted((str(r.day), r.details[-1]) for r in got) == [
        ("2024-01-01", "A"), ("2024-01-02", "A"), ("2024-01-02", "F"),
    ]


@pytest.mark.parametrize("run_at, status", [("2024-01-02 00:00:00", "OK"), ("2024-01-03 00:00:00", "STALE_DATA")])
def test_freshness(spark, run_at, status):
    df = spark.createDataFrame([("2024-01-01 12:00:00",), ("2023-01-01 00:00:00",)], "t string")
    assert quality.freshness(df, "t", run_at).first().status == status


def test_reconcile_tolerances(spark):
    fact = spark.createDataFrame([(Decimal("10.9"), Decimal("1.00"))], "traffic_volume decimal(20,6), tap_charge_sdr_net decimal(20,6)")
    gold = spark.createDataFrame([(Decimal("10"), Decimal("1.01"))], "total_traffic_volume decimal(20,2), total_tap_charge_net decimal(20,5)")
    got = quality.reconcile_totals(fact, gold).first()
    assert (got.volume_ok, got.charge_ok) == (True, False)


def test_with_type_refuses_lossy_casts(spark):
    df = spark.createDataFrame([("1",), (None,)], "n string")
    assert [r.n for r in tables.with_type(df, "n", "bigint").collect()] == [1, None]
    for value, kind in ((1.75, "double"), (3.9, "decimal(3,1)")):
        lossy = spark.range(1).select(F.lit(value).cast(kind).alias("n"))
        with pytest.raises(Exception, match="does not fit"):
            tables.with_type(lossy, "n", "bigint").collect()
    bad = tables.with_type(spark.createDataFrame([("x",)], "n string"), "n", "bigint")
    with pytest.raises(PySparkException):
        bad.collect()


def test_registry():
    assert model.table_spec("Traffic", "BRONZE").full_name("EE") == "ee_bronze.imsi_level_traffic"
    with pytest.raises(ValueError, match="known"):
        model.table_spec("traffic", "platinum")
    assert ("settlement", "gold") in model.managed_tables()


def test_settlement_schema_shape(spark):
    fields = model.schema_of(model.SETTLEMENT_DDL).fields
    assert (len(fields), fields[0].name, fields[-1].name) == (57, "home_pmn", "traffic_volume_not_rounded")
    assert len(model.SETTLEMENT_REQUIRED_COLUMNS) == 37
    assert len(model.schema_of(model.USAGE_FACT_DDL).fields) == 26
