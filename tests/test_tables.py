"""Stored tables: commits that hold as a whole, versions, ranges that read only their months."""

from __future__ import annotations

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from vitalgrid.params import MetricParams
from vitalgrid.plans import metrics as m
from vitalgrid.plans.queries import in_range
from vitalgrid.sources.tables import Commit, committed, read_table, read_tables, remove_old_versions, write_table


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v long")


def held(spark, root, name):
    table = read_table(spark, root, name)
    return None if table is None else sorted(r["v"] for r in table.collect())


def test_a_write_that_fails_leaves_the_old_tables(spark, tmp_path):
    root = str(tmp_path)
    with Commit(spark, root) as commit:
        commit.write(numbers(spark, 1), "a")
        commit.write(numbers(spark, 2), "b")
    broken = numbers(spark, 5, 6).select(F.when(F.col("v") > 5, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("v")).alias("v"))
    with pytest.raises(Exception, match="killed"):
        with Commit(spark, root) as commit:
            commit.write(numbers(spark, 3), "a")
            assert held(spark, root, "a") == [1]  # not yet there
            commit.write(broken, "b")
    assert (held(spark, root, "a"), held(spark, root, "b")) == ([1], [2])
    # what a killed program leaves: files without a commit
    numbers(spark, 9).write.parquet(f"{root}/a/00000000000000000000000000000000")
    assert held(spark, root, "a") == [1] and sorted(read_tables(spark, root)) == ["a", "b"]


def test_tables_of_a_commit_come_together(spark, tmp_path):
    root = str(tmp_path)
    write_table(numbers(spark, 1), root, "a")
    with Commit(spark, root) as commit:
        commit.write(numbers(spark, 3), "a", about="third")
        commit.write(numbers(spark, 4), "_hidden")
    assert held(spark, root, "a") == [3] and held(spark, root, "_hidden") == [4]
    assert committed(spark, root)["a"]["about"] == "third" and list(read_tables(spark, root)) == ["a"]
    assert len(glob.glob(f"{root}/a/*")) == 2
    assert len(remove_old_versions(spark, root)) == 1 and len(glob.glob(f"{root}/a/*")) == 1
    assert held(spark, root, "a") == [3] and remove_old_versions(spark, root) == []


def test_folders_written_by_others(spark, tmp_path):
    root = str(tmp_path)
    numbers(spark, 7).write.parquet(f"{root}/plain")
    assert held(spark, root, "plain") == [7] and list(read_tables(spark, root)) == ["plain"]
    assert held(spark, root, "nothing") is None
    assert read_table(spark, root, "nothing", "v long").count() == 0


@pytest.fixture
def stored(spark, tmp_path):
    """Two years of steps of three persons, who stop at different times."""
    root = str(tmp_path / "store")
    days = spark.range(730).select(F.explode(F.array(*map(F.lit, ("ann", "bob", "cy")))).alias("user_id"),
                                   F.expr("timestamp_ntz'2022-01-01' + make_dt_interval(int(id))").alias("day_time"),
                                   (F.col("id") * 10).cast("double").alias("steps"))
    write_table(days.where("user_id = 'ann' or (user_id = 'bob' and day_time < '2023-12-20') or day_time < '2022-03-05'"),
                root, "steps_daily")
    return root


def test_ranges_read_their_months(spark, stored):
    whole = m.load_metrics(spark, stored)
    assert "month" not in whole.columns and whole.count() == 730 + 718 + 63
    for name in ("7d", "30d", "90d", "all"):
        found = m.load_range(spark, stored, name)
        assert found.columns == whole.columns
        assert sorted(found.collect()) == sorted(in_range(whole, name).collect())
    found = m.load_range(spark, stored, "7d")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    months = re.search(r"PartitionFilters: \[(?:isnotnull\(month#\d+\), )?(?:month#\d+ IN \(([^)]*)\)|.*?INSET ([^\]]*))", plan)
    assert months and sorted(re.findall(r"\d{4}-\d\d", months[0])) == ["2022-02", "2022-03", "2023-12"]


def test_metrics_and_what_they_were_built_with_are_one_commit(spark, stored, monkeypatch):
    before = sorted(m.load_metrics(spark, stored).collect())
    seq = committed(spark, stored)["metrics_daily"]["seq"]
    profiles = spark.createDataFrame([("ann", 600)], "user_id string, target_sleep_min int").selectExpr(
        "user_id", "null as sex", "null as hr_max", "null as hr_rest", "target_sleep_min")
    write = Commit.write

    def fail(self, df, name, *args, **kwargs):
        if name == m.PROFILES_TABLE:
            raise RuntimeError("killed")
        write(self, df, name, *args, **kwargs)

    monkeypatch.setattr(Commit, "write", fail)
    with pytest.raises(RuntimeError):
        m.load_metrics(spark, stored, MetricParams(target_sleep_min=500), profiles.selectExpr(
            "user_id", "cast(sex as string) sex", "cast(hr_max as double) hr_max", "cast(hr_rest as double) hr_rest", "target_sleep_min"))
    assert committed(spark, stored)["metrics_daily"]["seq"] == seq
    assert sorted(m.load_metrics(spark, stored).collect()) == before
    assert os.path.isdir(f"{stored}/_commits")
