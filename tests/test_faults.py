"""Which files of a failed batch cannot be read, found in a number of jobs that does not follow the number of files."""

import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tierline.sources.files import HEADERS_AT_ONCE, SOURCE_PATH, files_by_layout, header_lines, read_delimited
from tierline.streaming.landing import ingest_stream, unreadable


def _parquet(path, rows, damage=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    # Plain pages in several row groups, so damage to a page leaves the others readable.
    columns = {name: pa.array([f"{name}{k}" for k in range(rows)], pa.string()) for name in ("client_pmn", "n")}
    pq.write_table(
        pa.table(columns), path,
        row_group_size=100, compression="gzip", use_dictionary=False,
    )
    if damage:
        data = bytearray(open(path, "rb").read())
        if damage == "page":
            start = pq.ParquetFile(path).metadata.row_group(1).column(0).data_page_offset
            data[start + 30 : start + 60] = b"\0" * 30
        elif damage == "cut":
            data = data[: len(data) // 2]
        else:
            data = bytearray(b"no such format")
        with open(path, "wb") as f:
            f.write(data)
    return path


def _jobs(spark, action):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return action(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("count", [10, 200])
def test_bad_files_are_found_in_a_fixed_number_of_jobs(spark, tmp_path, count):
    paths = [_parquet(f"{tmp_path}/in put/{k}.parquet", 3) for k in range(count)]
    bad = {
        _parquet(f"{tmp_path}/in put/cut.parquet", 500, "cut"): "cut off",
        _parquet(f"{tmp_path}/in put/odd.parquet", 500, "format"): "not a columnar file",
        _parquet(f"{tmp_path}/in put/page.parquet", 500, "page"): "of 500 rows",
        f"{tmp_path}/in put/gone.parquet": "gone",
    }
    empty = _parquet(f"{tmp_path}/in put/empty.parquet", 0)
    text = f"{tmp_path}/in put/a.csv"
    with open(text, "w", encoding="utf-8") as f:
        f.write("a;b\n1;2\n")
    found, jobs = _jobs(spark, lambda: unreadable(spark, [*paths, *bad, empty, text]))
    assert set(found) == set(bad) and all(part in found[p] for p, part in bad.items())
    # The schema, the counts with their shuffle stages, the probe of the silent files.
    assert jobs <= 6


def test_nothing_readable_and_nothing_wrong(spark, tmp_path):
    odd = _parquet(f"{tmp_path}/odd.parquet", 1, "format")
    assert set(unreadable(spark, [odd])) == {odd}
    assert unreadable(spark, [_parquet(f"{tmp_path}/good.parquet", 1), _parquet(f"{tmp_path}/empty.parquet", 0)]) == {}
    assert unreadable(spark, []) == {}


def test_files_that_contradict_each_other_are_nobodys_fault(spark, tmp_path):
    paths = [_parquet(f"{tmp_path}/a.parquet", 1), f"{tmp_path}/b.parquet"]
    pq.write_table(pa.table({"n": [1]}), paths[1])
    assert unreadable(spark, paths) == {}


def test_strict_text_files_are_told_by_their_rows(spark, tmp_path):
    good, bad = f"{tmp_path}/good.csv", f"{tmp_path}/bad.csv"
    for path, row in ((good, "1;2"), (bad, "1;2;3")):
        with open(path, "w", encoding="utf-8") as f:
            f.write(f"a;b\n{row}\n")
    found = unreadable(spark, [good, bad], mode="FAILFAST")
    assert set(found) == {bad} and "1;2;3" in found[bad]


def test_a_stream_sets_a_damaged_page_aside(spark, tmp_path):
    root, failed, store = f"{tmp_path}/landing", f"{tmp_path}/failed", f"{tmp_path}/store"
    place = f"{root}/tenant/North/Bronze/Traffic"
    for k in range(5):
        _parquet(f"{place}/{k}.parquet", 4)
    _parquet(f"{place}/bad.parquet", 500, "page")

    def keep(tenant, raw, batch, loaded_at):
        raw.drop(SOURCE_PATH).write.mode("overwrite").parquet(f"{store}/{batch}")

    ingest_stream(spark, root, "traffic", "bronze", f"{tmp_path}/check", keep, failed=failed).awaitTermination()
    assert spark.read.parquet(f"{store}/*").count() == 20
    aside = spark.read.parquet(failed).select(F.element_at(F.split("path", "/"), -1), "reason").collect()
    assert [r[0] for r in aside] == ["bad.parquet"] and "of 500 rows" in aside[0]["reason"]


def test_headers_take_one_job_for_many_files_and_a_few_lines_of_each(spark, tmp_path):
    place = f"{tmp_path}/in put [1]"
    os.makedirs(place)
    for k in range(HEADERS_AT_ONCE + 1):
        with open(f"{place}/{k:03d}.csv", "w", encoding="utf-8") as f:
            f.write("\ufeff \n\ta;b\n1;2\n" if k % 2 else "c|d|e\n1|2|3\n\n")
    open(f"{place}/none.csv", "w").close()
    paths = [f"{tmp_path}/in put \\[1\\]/{n}" for n in sorted(os.listdir(place))]
    found, jobs = _jobs(spark, lambda: files_by_layout(spark, paths))
    assert [(layout, len(names)) for layout, names in found] == [((";", "\ta;b"), 32), (("|", "c|d|e"), 33)]
    assert jobs <= 3  # Spark lists many paths by a job of its own
    assert read_delimited(spark, paths).filter("c = '1'").count() == 33
    # A limit for each file stops its reader. Nothing moves, and no Python reads on.
    plan = header_lines(spark, paths[:3])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LocalLimit") == 3 and "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan
