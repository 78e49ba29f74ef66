"""S15 by period: files, moves, replays, killed loads."""

import datetime as dt
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from cauce.sources import fs, periods

SCHEMA = "k long, day date, amount double, note string"


def rows(spark, *data):
    return spark.createDataFrame([(k, dt.date(2024, m, d), a, n) for k, m, d, a, n in data], SCHEMA)


def load(spark, path, df):
    return periods.upsert_periods(spark, path, df, "k", periods.month_of("day"))


def files(path):
    """Data file -> time of its last change."""
    base = pathlib.Path(path.removeprefix("file:")) / "data"
    return {str(f.relative_to(base)): os.stat(f).st_mtime_ns for f in base.rglob("*.parquet")}


def content(spark, path):
    return sorted((r.k, r.day.month, r.amount, r.note) for r in periods.read_periods(spark, path).collect())


@pytest.fixture
def three_months(spark, tmp_table_dir):
    data = [(i, 1 + i % 3, 1 + i % 28, float(i), None if i % 2 else "x") for i in range(60)]
    assert load(spark, tmp_table_dir, rows(spark, *data)) == (60, 0)
    return tmp_table_dir, data


def test_loading_one_month_rewrites_one_month(spark, three_months):
    path, data = three_months
    before, live = files(path), periods.manifest(spark, path)
    assert set(live) == {"p2024-01", "p2024-02", "p2024-03"}
    # a changed and a new row of February
    assert load(spark, path, rows(spark, (1, 2, 2, -1.0, None), (100, 2, 5, 1.0, "new"))) == (1, 1)
    after, now = files(path), periods.manifest(spark, path)
    assert {p for p in now if now[p] != live[p]} == {"p2024-02"}
    assert all(after[f] == t for f, t in before.items() if "2024-02" not in f)
    assert all("_period=p2024-02" in f for f in set(after) - set(before))
    want = [(k, m, a, n) for k, m, _, a, n in data if k != 1] + [(1, 2, -1.0, None), (100, 2, 1.0, "new")]
    assert content(spark, path) == sorted(want)


def test_a_replay_writes_nothing(spark, three_months):
    path, data = three_months
    before, version = files(path), periods.current_manifest(spark, path)
    assert load(spark, path, rows(spark, *data)) == (0, 60)
    assert load(spark, path, rows(spark, *data[:5])) == (0, 5)
    assert files(path) == before and periods.current_manifest(spark, path) == version


def test_values_that_swap_with_a_null_count_as_changed(spark, tmp_table_dir):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), "a", None)], "k long, day date, x string, y string")
    swapped = spark.createDataFrame([(1, dt.date(2024, 1, 1), None, "a")], "k long, day date, x string, y string")
    load(spark, tmp_table_dir, df)
    assert load(spark, tmp_table_dir, swapped) == (0, 1)
    assert tuple(periods.read_periods(spark, tmp_table_dir).select("x", "y").first()) == (None, "a")


def test_a_key_that_moves_leaves_its_old_month(spark, three_months):
    path, data = three_months
    before, live = files(path), periods.manifest(spark, path)
    assert load(spark, path, rows(spark, (0, 3, 9, 5.0, "moved"))) == (0, 1)      # was in January
    now = periods.manifest(spark, path)
    assert {p for p in now if now[p] != live[p]} == {"p2024-01", "p2024-03"}
    assert all(files(path)[f] == t for f, t in before.items() if "2024-02" in f)
    assert content(spark, path) == sorted([(k, m, a, n) for k, m, _, a, n in data if k] + [(0, 3, 5.0, "moved")])
    # the last row of a month that moves away takes the month with it
    load(spark, path, rows(spark, (500, 7, 1, 1.0, None)))
    load(spark, path, rows(spark, (500, 8, 1, 1.0, None)))
    assert "p2024-07" not in periods.manifest(spark, path) and "p2024-08" in periods.manifest(spark, path)


def test_a_killed_publish_leaves_the_old_table(spark, three_months, monkeypatch):
    path, data = three_months
    want, version = content(spark, path), periods.current_manifest(spark, path)

    def killed(*a):
        raise KeyboardInterrupt
    monkeypatch.setattr(periods, "_publish", killed)
    with pytest.raises(KeyboardInterrupt):
        load(spark, path, rows(spark, (1, 2, 2, -1.0, None)))
    monkeypatch.undo()
    assert content(spark, path) == want and periods.current_manifest(spark, path) == version
    # a manifest without its marker doesn't count either, and does not block the next load
    half = pathlib.Path(path.removeprefix("file:")) / "manifest" / f"v={version + 1}"
    half.mkdir()
    (half / "part-0.json").write_text('{"period":"p2024-01","load":99,"columns":"{}"}')
    assert content(spark, path) == want
    assert load(spark, path, rows(spark, (1, 2, 2, -1.0, None))) == (0, 1)
    assert (1, 2, -1.0, None) in content(spark, path)


def test_updates_with_repeated_keys_change_nothing(spark, three_months, tmp_table_dir):
    path, _ = three_months
    want = content(spark, path)
    twice = rows(spark, (1, 2, 2, -1.0, None), (1, 2, 2, -2.0, None))
    with pytest.raises(ValueError):
        load(spark, path, twice)
    assert content(spark, path) == want
    with pytest.raises(ValueError):
        load(spark, f"{path}-other", twice)
    assert periods.read_periods(spark, f"{path}-other") is None


def test_null_keys_and_periods_and_new_columns(spark, tmp_table_dir):
    df = spark.createDataFrame([(None, None, 1.0, "a"), (1, None, 2.0, "b"), (2, dt.date(2024, 1, 1), 3.0, "c")], SCHEMA)
    assert load(spark, tmp_table_dir, df) == (3, 0)
    assert load(spark, tmp_table_dir, df) == (0, 3)
    wider = df.filter("k = 2").withColumn("extra", F.lit(7))
    assert load(spark, tmp_table_dir, wider) == (0, 1)
    got = {r.k: r.extra for r in periods.read_periods(spark, tmp_table_dir).collect()}
    assert got == {None: None, 1: None, 2: 7}
    assert load(spark, tmp_table_dir, df.limit(0)) == (0, 0)


def test_old_loads_and_manifests_are_cleared(spark, tmp_table_dir):
    for i in range(6):
        load(spark, tmp_table_dir, rows(spark, (1, 1, 1, float(i), None), (2, 2, 1, 0.0, None)))
    assert len(fs.list_dirs(spark, f"{tmp_table_dir}/manifest")) <= periods.KEEP_MANIFESTS
    assert len(fs.list_dirs(spark, f"{tmp_table_dir}/data")) <= periods.KEEP_MANIFESTS + 1
    assert content(spark, tmp_table_dir) == [(1, 1, 5.0, None), (2, 2, 0.0, None)]


def test_only_key_columns_of_the_stored_table_are_scanned(spark, three_months):
    path, _ = three_months
    live = periods.manifest(spark, path)
    plan = periods._read(spark, path, live).select("k", periods.PERIOD, periods.ROW)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint,_row:bigint>" in plan
    one = periods.read_periods(spark, path, ["p2024-01"])
    assert {r.day.month for r in one.collect()} == {1}
