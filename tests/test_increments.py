"""Merged partial sums, and the mergeable state of the monthly table."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierline.operators import increments, marts, tables
from tierline.plans import usage
from tierline.scratch import scratch_path, staged

DDL = "v long, batch_of string, call_day string, _batch string"


@pytest.fixture
def table(spark, request):
    database = f"inc_{abs(hash(request.node.name)) % 10**8}_silver"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"{database}.sums"
    tables.create_table(spark, name, DDL, ("call_day", "_batch"))
    yield name
    spark.sql(f"DROP DATABASE {database} CASCADE")


def put(spark, name, batch, rows):
    """A load of a batch: (day, value) rows in place of what it had."""
    stale = increments.days_of(spark, name, batch) - {d for d, _ in rows}
    frame = spark.createDataFrame([(v, batch, d, batch) for d, v in rows], DDL)
    if rows:
        tables.overwrite_partitions(frame, name)
    increments.forget(spark, name, batch, stale)


def counted(df):
    return Counter((r["batch_of"], r["call_day"], r["v"]) for r in df.collect())


def bag(batches):
    return Counter((b, d, v) for b, rows in batches.items() for d, v in rows)


def test_fifty_batches_leave_one_set_of_files_and_stay_replaceable(spark, table):
    batches = {str(b): [("2026-01-01", b), ("2026-01-01", b), ("2026-01-02", 100 + b)] for b in range(50)}
    whole = spark.createDataFrame([(v, b, d, b) for b, rows in batches.items() for d, v in rows], DDL)
    tables.append_table(whole, table)
    days = ["2026-01-01", "2026-01-02"]
    assert increments.compact(spark, table, days, 16) == days
    assert {d: (len(h.generations), len(h.batches)) for d, h in increments.held(spark, table).items()} == dict.fromkeys(days, (1, 0))
    assert len(spark.table(table).inputFiles()) == 2
    assert counted(increments.live(spark, table)) == bag(batches)
    assert increments.compact(spark, table, days, 16) == []

    # A merged batch comes again: with other rows, without one of its days, with a new day.
    batches["7"] = [("2026-01-02", 7007), ("2026-01-03", 7)]
    put(spark, table, "7", batches["7"])
    assert counted(increments.live(spark, table)) == bag(batches)
    assert increments.days_of(spark, table, "7") == {"2026-01-02", "2026-01-03"}
    # Without rows it leaves nothing behind.
    batches["8"] = []
    put(spark, table, "8", [])
    increments.compact(spark, table, [*days, "2026-01-03"], 2)
    assert counted(increments.live(spark, table)) == bag(batches) and increments.days_of(spark, table, "8") == set()
    assert all(len(h.generations) + len(h.batches) == 1 for h in increments.held(spark, table).values())


@pytest.mark.parametrize("stop", ["drop", "write"])
def test_a_stopped_merge_reads_the_same_rows(spark, table, monkeypatch, stop):
    batches = {b: [("d1", k), ("d2", 10 + k)] for k, b in enumerate("abc")}
    for b, rows in batches.items():
        put(spark, table, b, rows)
    increments.compact(spark, table, ["d1", "d2"], 2)
    for b in "xy":
        batches[b] = [("d1", 50), ("d1", 50)]
        put(spark, table, b, batches[b])

    def fail(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(increments, "drop_partitions" if stop == "drop" else "overwrite_partitions", fail)
        with pytest.raises(RuntimeError):
            increments.compact(spark, table, ["d1"], 2)
    assert counted(increments.live(spark, table)) == bag(batches)
    # A batch may come again before the merge is repeated.
    batches["x"] = [("d1", 51)]
    put(spark, table, "x", batches["x"])
    assert counted(increments.live(spark, table)) == bag(batches)
    increments.compact(spark, table, ["d1"], 2)
    assert counted(increments.live(spark, table)) == bag(batches)
    assert len(increments.held(spark, table)["d1"].generations) == 1


def test_only_the_days_partitions_are_read(spark, table):
    for b in "ab":
        put(spark, table, b, [("d1", 1), ("d2", 2)])
    increments.compact(spark, table, ["d1"], 2)
    put(spark, table, "a", [("d1", 5), ("d2", 2)])
    plan = increments.live(spark, table, ["d1"])._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "call_day" in filters and "d2" not in filters
    assert increments.live(spark, table, ["absent"]).count() == 0


def test_values_with_quotes_name_partitions(spark, table):
    put(spark, table, "o'clock", [(day, 1) for day in ("it's", 'a "day"', "back\\slash")])
    assert increments.days_of(spark, table, "o'clock") == {"it's", 'a "day"', "back\\slash"}
    increments.forget(spark, table, "o'clock", ["it's", "back\\slash"])
    assert increments.days_of(spark, table, "o'clock") == {'a "day"'}


def test_batches_do_not_look_like_generations(spark):
    with pytest.raises(ValueError, match="kept"):
        increments.checked_batch("~1")


def _daily(spark, rows):
    """Daily rows (group, imsi, apn, volume, day); the other columns are the same throughout or NULL."""
    made = spark.createDataFrame(rows, "call_type string, imsi string, apn string, n int, call_day string")
    known = {"call_type", "imsi", "apn", "call_day"}
    sums = {t: F.col("n").cast("bigint" if t == "total_event_count" else "decimal(28,6)") for t in marts.USAGE_TOTALS.values()}
    rest = [c for c in (*marts.USAGE_MONTHLY_GRAIN,) if c not in known]
    types = {"year": "int", "month": "int"}
    fixed = [F.lit(None).cast(types.get(c, "string")).alias(c) for c in rest]
    return made.select("call_type", "imsi", "apn", "call_day", *fixed, *[s.alias(t) for t, s in sums.items()])


def test_states_of_days_unite_exactly(spark):
    rows = [
        ("a", "1", "x", 1, "d1"), ("a", "1", "y", 2, "d1"), ("a", "1", "x", 4, "d2"), ("a", "2", None, 8, "d2"), ("a", None, "x", 16, "d2"),
        (None, "1", None, 32, "d1"), (None, None, None, None, "d2"), ("b", "3", "z", None, "d1"),
    ] + [("hot", str(k % 50), str(k % 3), 1, f"d{k % 4}") for k in range(1000)]
    daily = _daily(spark, rows)
    expected = Counter(
        (r["call_type"], r["total_volume"], r["i"], r["p"])
        for r in daily.groupBy("call_type").agg(
            F.sum("total_volume").alias("total_volume"), F.count_distinct("imsi").alias("i"), F.count_distinct("apn").alias("p")
        ).collect()
    )

    def found(monthly):
        return Counter((r["call_type"], r["total_volume"], r["distinct_imsi_count"], r["distinct_apn_count"]) for r in monthly.collect())

    assert found(marts.usage_monthly(daily)) == expected
    state = staged(marts.usage_month_state(daily, "call_day"), "state")
    assert found(marts.usage_months(marts.merged_state(state))) == expected
    assert state.count() == state.select("call_day", *marts.STATE_KEYS).distinct().count()
    assert marts.usage_monthly(_daily(spark, [])).count() == 0


def test_monthly_plan_has_no_expand_and_hash_aggregates_only(spark):
    daily = _daily(spark, [("a", "1", "x", 1, "d1")])
    for monthly in (marts.usage_monthly(daily), marts.usage_months(marts.merged_state(marts.usage_month_state(daily, "call_day")))):
        plan = monthly._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    plan = marts.usage_monthly(daily)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_month_is_updated_from_the_state_of_its_changed_days(spark):
    """A second batch of one day changes the month; the daily rows of the other days are not needed for it."""
    from tests.test_operators import RECORDS, _bronze

    raw = _bronze(spark, RECORDS)
    usage.create_usage_tables(spark, "state")
    path = "s3a://landing/tenant/EE/Bronze/Traffic/f.csv"
    landed = raw.withColumn("_source_path", F.lit(path))
    for batch in ("0", "1"):
        usage.load_usage(spark, "state", landed, batch, "2026-01-01 00:00:00", scratch_path(spark, "bad"), compact_at=2)
    both = usage.usage_bronze(raw.union(raw))
    columns = [*marts.USAGE_MONTHLY_GRAIN, *marts.USAGE_TOTALS.values(), *marts.COUNTED_MEMBERS.values()]
    expected = Counter(map(tuple, marts.usage_monthly(usage.usage_daily(both)).select(*columns).collect()))
    stored = spark.table("state_gold.client_partner_traffic_monthly")
    assert Counter(map(tuple, stored.select(*columns).collect())) == expected


def test_alerts_from_stored_counts_are_those_of_a_scan(spark, request):
    from tierline.operators import counts, quality

    name = "counted_silver.event_counts"
    spark.sql("CREATE DATABASE IF NOT EXISTS counted_silver")
    counts.create_counts(spark, name)
    rows = [(f"2026-01-{1 + k % 20:02d} 0{k % 9}:00:00", "ab"[k % 2] if k % 20 != 5 else "a") for k in range(300)]
    rows += [(None, "a"), ("2026-01-15 10:00:00", None)] + [("2026-01-12 11:00:00", "b")] * 40
    events = spark.createDataFrame(rows, "at string, kind string").withColumn("at", F.col("at").cast("timestamp"))
    batch = F.pmod(F.xxhash64("at", "kind"), F.lit(3))
    for b, part in (("0", batch == 0), ("1", F.col("kind") == "a"), ("2", batch == 2), ("1", batch == 1)):
        counts.update_counts(spark, name, events.filter(part), b, "at", "kind", compact_at=2)
    stored = counts.stored_counts(spark, name)
    assert stored.agg(F.sum("row_count")).first()[0] == events.count()
    for run_at in ("2026-01-20 12:00:00", "2026-02-20 12:00:00"):
        found = counts.alerts(stored, ["a", "b", "c"], run_at)
        expected = quality.completeness_alerts(events, "at", "kind", ["a", "b", "c"], run_at)
        assert Counter(map(tuple, found.collect())) == Counter(map(tuple, expected.collect()))
    assert all(len(h.generations) + len(h.batches) <= 2 for h in increments.held(spark, name).values())
