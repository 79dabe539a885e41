"""File gates and versioned tables."""

import os
import time

from shopflow.sinks.tables import read_version, versions, write_version
from shopflow.sources import files


def touch(path, text="{}\n"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_scan_day_only_that_day(spark, tmp_dir):
    touch(f"{tmp_dir}/sessions_20250102_a.json", '{"a": 1}\n{"a": 2}\n')
    touch(f"{tmp_dir}/sessions_20250103_a.json", '{"a": 3}\n')
    touch(f"{tmp_dir}/session_20250102_b.json", '{"a": 4}\n')
    day = files.scan_day(spark, tmp_dir, "2025-01-02")
    assert sorted(r["value"] for r in day.collect()) == ['{"a": 1}', '{"a": 2}']
    assert files.scan_day(spark, tmp_dir, "20250104").count() == 0


def test_changed_and_new_files(spark, tmp_dir):
    touch(f"{tmp_dir}/users.csv")
    touch(f"{tmp_dir}/orders.csv")
    listing = files.file_listing(spark, tmp_dir, "*.csv")
    # marks are a stored table in use; materialise them here (a lazy frame would re-list)
    marks = spark.createDataFrame(listing.filter("file_name = 'users.csv'").select("file_name", "modified").collect(),
                                  "file_name string, modified timestamp")
    assert [r["file_name"] for r in files.changed_files(listing, marks).collect()] == ["orders.csv"]
    time.sleep(1.1)
    touch(f"{tmp_dir}/users.csv", "changed\n")
    listing = files.file_listing(spark, tmp_dir, "*.csv")
    assert sorted(r["file_name"] for r in files.changed_files(listing, marks).collect()) == ["orders.csv", "users.csv"]
    ledger = spark.createDataFrame([("users.csv",)], "file_name string")
    assert [r["file_name"] for r in files.new_files(listing, ledger).collect()] == ["orders.csv"]


def test_versioned_table_backfill_and_reset(spark, tmp_dir):
    path = f"{tmp_dir}/report"
    schema = "report_date string, n long"
    assert read_version(spark, path, spark.createDataFrame([], schema).schema).count() == 0
    write_version(spark.createDataFrame([("d1", 1)], schema), path)
    write_version(spark.createDataFrame([("d1", 5), ("d2", 2)], schema), path)  # backfill = new version
    assert versions(spark, path) == [0, 1]
    assert sorted(tuple(r) for r in read_version(spark, path).collect()) == [("d1", 5), ("d2", 2)]
    assert read_version(spark, path, version=0).count() == 1  # old version still readable
    write_version(spark.createDataFrame([], schema), path)  # reset
    assert read_version(spark, path).count() == 0
    os.makedirs(f"{path}/v=9")  # an uncommitted (crashed) write is invisible
    assert versions(spark, path) == [0, 1, 2]


def test_reset_table(spark, tmp_dir):
    from shopflow.schemas import USERS
    from shopflow.sinks.tables import reset_table
    path = f"{tmp_dir}/users"
    write_version(spark.createDataFrame([("u1", "a", "a@b", None, None, None, None)], USERS), path)
    reset_table(spark, path, USERS)
    out = read_version(spark, path)
    assert out.count() == 0 and out.columns == USERS.fieldNames()
