"""Stored tables: creation, idempotent writes, evolution, retirement, inventory, quarantine."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from tierline.operators import tables
from tierline.scratch import scratch_path, shared_dir, staged
from tierline.sources.tables import inventory, list_tables, read_table


@pytest.fixture
def db(spark):
    name = "t_" + dt.datetime.now().strftime("%H%M%S%f")
    tables.create_schemas(spark, name)
    yield name
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE {name}_{layer} CASCADE")


def _rows(spark, name, *columns):
    return sorted(map(tuple, spark.table(name).select(*columns).collect()), key=str)


def _days(spark, *rows):
    return spark.createDataFrame([(n, dt.date.fromisoformat(d)) for n, d in rows], "n int, day date")


def test_create_is_idempotent_and_drop_ignores_absent(spark, db):
    name = f"{db}_gold.t"
    tables.create_table(spark, name, "n int, day date", ("day",))
    tables.append_table(_days(spark, (1, "2024-01-01")), name)
    tables.create_table(spark, name, "n int, day date", ("day",))
    assert spark.table(name).count() == 1
    tables.drop_table(spark, name)
    tables.drop_table(spark, name)
    with pytest.raises(ValueError, match="does not exist"):
        tables.append_table(_days(spark, (1, "2024-01-01")), name)


def test_append_aligns_by_name(spark, db):
    name = f"{db}_gold.t"
    tables.create_table(spark, name, "n int, note string, day date", ("day",))
    frame = spark.createDataFrame([("2024-01-01", "7", "x")], "day string, n string, extra string")
    tables.append_table(frame, name)
    assert _rows(spark, name, "n", "note", "day") == [(7, None, dt.date(2024, 1, 1))]


def test_overwrite_replaces_only_its_partitions(spark, db):
    name = f"{db}_gold.t"
    tables.create_table(spark, name, "n int, day date", ("day",))
    tables.overwrite_partitions(_days(spark, (1, "2024-01-01"), (2, "2024-01-02")), name)
    for _ in range(2):
        tables.overwrite_partitions(_days(spark, (5, "2024-01-02"), (6, "2024-01-02")), name)
    assert [r[0] for r in _rows(spark, name, "n")] == [1, 5, 6]


def test_schema_changes(spark, db):
    name = f"{db}_gold.t"
    tables.create_table(spark, name, "n int, day date", ("day",))
    tables.append_table(_days(spark, (1, "2024-01-01")), name)
    tables.add_column(spark, name, "note", "string")
    assert _rows(spark, name, "n", "note") == [(1, None)]
    tables.rename_column(spark, name, "note", "remark")
    tables.update_column_type(spark, name, "n", "bigint")
    assert dict(spark.table(name).dtypes) == {"n": "bigint", "remark": "string", "day": "date"}
    tables.drop_column(spark, name, "remark")
    assert spark.table(name).columns == ["n", "day"]
    tables.rename_table(spark, name, f"{db}_gold.u")
    tables.rename_table(spark, f"{db}_gold.u", f"{db}_silver.u")
    assert _rows(spark, f"{db}_silver.u", "n") == [(1,)]
    assert not spark.catalog.tableExists(name) and not spark.catalog.tableExists(f"{db}_gold.u")


def test_lossy_type_change_leaves_the_table_alone(spark, db):
    name = f"{db}_gold.t"
    tables.create_table(spark, name, "s string")
    tables.append_table(spark.createDataFrame([("x",)], "s string"), name)
    with pytest.raises(PySparkException):
        tables.update_column_type(spark, name, "s", "int")
    assert _rows(spark, name, "s") == [("x",)]


def test_retire_partitions(spark, db):
    name, archive = f"{db}_gold.t", f"{db}_gold.old"
    for t in (name, archive):
        tables.create_table(spark, t, "n int, day date", ("day",))
    tables.append_table(_days(spark, (1, "2020-01-01"), (2, "2023-12-31"), (3, "2024-01-01"), (4, "2025-06-01")), name)
    for _ in range(2):
        tables.retire_partitions(spark, name, archive, "day", "2026-01-01")
        assert [r[0] for r in _rows(spark, name, "n")] == [3, 4]
        assert [r[0] for r in _rows(spark, archive, "n")] == [1, 2]
    # A late row of a day that is archived already joins it.
    tables.append_table(_days(spark, (9, "2020-01-01")), name)
    tables.retire_partitions(spark, name, archive, "day", "2026-01-01")
    assert sorted(r[0] for r in _rows(spark, archive, "n")) == [1, 2, 9]
    # So does one that equals a row of the archive: it is a row of its own.
    tables.append_table(_days(spark, (9, "2020-01-01"), (9, "2020-01-01")), name)
    tables.retire_partitions(spark, name, archive, "day", "2026-01-01")
    assert sorted(r[0] for r in _rows(spark, archive, "n")) == [1, 2, 9, 9, 9]
    assert [r[0] for r in _rows(spark, name, "n")] == [3, 4]


def test_retiring_moves_files_and_survives_a_stop(spark, db, monkeypatch):
    name, archive = f"{db}_gold.t", f"{db}_gold.old"
    for t in (name, archive):
        tables.create_table(spark, t, "n int, day date", ("day",))
    tables.append_table(_days(spark, *[(k, f"2020-01-0{k % 3 + 1}") for k in range(30)], (99, "2025-06-01")), name)
    files = {f.rsplit("/", 1)[1] for f in spark.table(name).inputFiles() if "2020" in f}
    moved = []

    def stopping(session, source, target, move=tables._move_files):
        if len(moved) == 2:
            raise RuntimeError("stopped")
        moved.append(source)
        move(session, source, target)

    with monkeypatch.context() as m:
        m.setattr(tables, "_move_files", stopping)
        with pytest.raises(RuntimeError):
            tables.retire_partitions(spark, name, archive, "day", "2026-01-01")
    tables.retire_partitions(spark, name, archive, "day", "2026-01-01")
    assert [r[0] for r in _rows(spark, name, "n")] == [99]
    assert sorted(r[0] for r in _rows(spark, archive, "n")) == list(range(30))
    assert {f.rsplit("/", 1)[1] for f in spark.table(archive).inputFiles()} == files


def test_retiring_needs_tables_of_one_shape(spark, db):
    name, archive = f"{db}_gold.t", f"{db}_gold.old"
    tables.create_table(spark, name, "n int, day date", ("day",))
    tables.create_table(spark, archive, "n bigint, day date", ("day",))
    with pytest.raises(ValueError, match="must have"):
        tables.retire_partitions(spark, name, archive, "day", "2026-01-01")


def test_inventory(spark, db):
    tables.create_table(spark, f"{db}_gold.t", "n int, day date", ("day",))
    tables.append_table(_days(spark, (1, "2024-01-01")), f"{db}_gold.t")
    tables.create_table(spark, f"{db}_bronze.e", "n int")
    assert [tuple(r) for r in list_tables(spark, db).collect()] == [(f"{db}_bronze", "e"), (f"{db}_gold", "t")]
    assert [tuple(r) for r in inventory(spark, db).collect()] == [(f"{db}_bronze", "e", 1, 0), (f"{db}_gold", "t", 2, 1)]
    assert read_table(spark, db.upper(), "gold", "t").count() == 1


def test_quarantine(spark):
    path = scratch_path(spark, "quarantine")
    bad = spark.createDataFrame([(" a", dt.date(2024, 1, 1)), (None, dt.date(2024, 1, 2))], "v string, _ingest_date date")
    tables.quarantine_parquet(bad, path)
    tables.quarantine_parquet(bad.filter("v IS NULL"), path)
    assert spark.read.parquet(path).count() == 2
    tables.quarantine_csv(bad, f"{path}-csv")
    assert {r.v for r in spark.read.csv(f"{path}-csv", header=True).collect()} == {" a", None}


def test_staged_uses_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    frame = staged(spark.range(10), "numbers")
    assert frame.count() == 10
    assert all(shared_dir(spark) in f for f in frame.inputFiles())
