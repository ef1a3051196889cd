"""What is shuffled and written grows no faster than the tables."""

import re
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures import derive, landing
from sunledger.operators.asof import Match, asof_join, month_index
from sunledger.operators.intervals import day_index, interval_join, intervals
from sunledger.sources import files

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


@pytest.fixture
def conf(spark):
    """Settings for one test."""
    was = {}

    def put(key, value):
        was.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield put
    for key, value in was.items():
        spark.conf.set(key, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def key(row):
    return [(x is not None, x) for x in row]


# --- F1, F5, F12, F14 to F16, F19 to F21: input files


def test_a_site_gets_one_file_whatever_the_number_of_tasks(spark, conf, tmp_path):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    paths = [landing.logger_csv(spark, SF, path=str(tmp_path / "csv")), landing.series_json(spark, SF, {"view": "PowerProduced"})]
    for path in paths:
        folders = list(Path(path).glob("site_id=*"))
        assert folders and all(len(list(f.glob("part-*"))) == 1 for f in folders)
    mixed = Path(landing.mixed_csv(spark, SF))
    assert all(len(list(f.glob("part-*"))) <= 3 for f in mixed.glob("site_id=*"))


def test_more_sites_make_larger_micro_batches_not_more(spark, tmp_path):
    for n, want in ((20, 8), (400, 25)):
        for i in range(n):
            (tmp_path / f"{n}" / f"site_id={i}").mkdir(parents=True)
        assert landing.files_a_batch(spark, str(tmp_path / f"{n}")) == want


# --- F2, F3: joins by intervals


def test_interval_joins_over_one_key_move_the_left_side_once(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = spark.createDataFrame([(i % 3, T0 + timedelta(hours=i)) for i in range(-30, 300)] + [(0, None)], "site_id int, k timestamp_ntz")
    right = spark.createDataFrame([(i % 2, T0 + timedelta(hours=7 * i), i) for i in range(30)], "site_id int, rk timestamp_ntz, v int")
    m = Match(right, F.col("rk"), {"v": "v"})
    got = interval_join(left, F.col("k"), intervals(m, by=["site_id"], bucket=day_index), ["v"]).withColumnRenamed("v", "before")
    got = interval_join(got, F.col("k"), intervals(m, by=["site_id"], bucket=day_index, forward=True), ["v"])
    text = plan_of(got)
    site = re.search(r"\[site_id#(\d+),\s*k#", text).group(1)
    assert len(re.findall(rf"hashpartitioning\(site_id#{site},", text)) == 1
    want = asof_join(left, F.col("k"), [m], by=["site_id"], bucket=month_index).withColumnRenamed("v", "before")
    want = asof_join(want, F.col("k"), [m], by=["site_id"], forward=True, bucket=month_index)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


# --- F4: exports


def test_csv_exports_may_be_compressed(spark, tmp_path):
    df = spark.createDataFrame([(i, f'a;"{i}",b') for i in range(100)] + [(None, None)], "n int, s string")
    for codec, end in ((None, ".csv"), ("gzip", ".csv.gz")):
        path = files.export_tables({"t": df}, str(tmp_path / str(codec)), compression=codec)["t"]
        assert all(p.name.endswith(end) for p in Path(path).glob("part-*"))
        back = spark.read.schema(df.schema).option("header", True).option("escape", "\\").csv(path)
        assert sorted(map(tuple, back.collect()), key=key) == sorted(map(tuple, df.collect()), key=key)


# --- F6 to F11, F13, F17, F18: the stored measurements


def test_days_are_stored_and_quarter_hours_made_of_them(spark):
    stored, days = derive.stored_measurements(spark, SF), derive.measured_days(spark, SF)
    assert spark.read.parquet(*stored.inputFiles()).count() == days.count()
    wanted = derive.measurements(spark, SF)
    assert [(f.name, f.dataType) for f in stored.drop("month").schema] == [(f.name, f.dataType) for f in wanted.schema]
    assert stored.drop("month").exceptAll(wanted).isEmpty() and wanted.exceptAll(stored.drop("month")).isEmpty()
    assert stored.where(F.col("month") != F.date_format("measured_on", "yyyy-MM")).isEmpty()
    text = plan_of(stored.where(F.col("month") == "1996-01"))
    assert "1996-01" in text[text.index("PartitionFilters") : text.index("PushedFilters")]


# --- F10, F11: as-of joins by union


def test_a_left_row_is_shuffled_as_it_is(spark):
    left = spark.createDataFrame([(0, T0, "x")], "site_id int, k timestamp_ntz, more string")
    right = spark.createDataFrame([(0, T0, 1)], "site_id int, rk timestamp_ntz, v int")
    got = asof_join(left, F.col("k"), [Match(right, F.col("rk"), {"v": "v"})], by=["site_id"], bucket=month_index)
    lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    under = lines[next(i for i, x in enumerate(lines) if "Union" in x) + 1]
    assert "Project [site_id" in under and under.count("#") <= 4  # its columns and one that is null


@pytest.mark.parametrize("forward", [False, True])
def test_buckets_change_nothing_with_several_right_sides(spark, forward):
    left = spark.createDataFrame([(i % 3, T0 + timedelta(days=11 * i), i) for i in range(60)] + [(7, T0, -3)], "site_id int, k timestamp_ntz, n int")
    rights = [
        spark.createDataFrame([(i % 2, T0 + timedelta(days=a + b * i), None if i % 4 == 0 else i) for i in range(20)] + [(0, None, 5)], "site_id int, rk timestamp_ntz, v int")
        for a, b in ((-3, 40), (50, 3))
    ]
    ms = [Match(r, F.col("rk"), {f"rk{i}": "rk", f"v{i}": "v"}) for i, r in enumerate(rights)]
    shifted = F.timestamp_add("DAY", F.lit(2), F.col("k"))
    for inner in (False, True):
        one, two = (asof_join(left, shifted, ms, by=["site_id"], forward=forward, inner=inner, bucket=b) for b in (None, month_index))
        assert one.columns == two.columns
        assert sorted(map(tuple, one.collect()), key=key) == sorted(map(tuple, two.collect()), key=key)
