"""Versioned tables, and insert-if-absent that looks at filters before keys."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sunledger.operators import presence, upsert
from sunledger.sources.versioned import Conflict, VersionedTable

SCHEMA = "k int, at timestamp_ntz, v int"
MONTH = "date_format(at, 'yyyy-MM')"


def rows(*of):
    """(key, month, value)"""
    return [(k, datetime(2024, m, 1), v) for k, m, v in of]


def got(df):
    return sorted((r.k, r.at.month, r.v) for r in df.collect())


@pytest.fixture
def frame(spark):
    return lambda *of: spark.createDataFrame(rows(*of), SCHEMA)


@pytest.fixture
def table(spark, tmp_path, frame):
    t = VersionedTable(spark, str(tmp_path / "t"), SCHEMA)
    assert t.read().collect() == [] and t.read().columns == ["k", "at", "v", "month"]
    t.append(frame((1, 1, 1), (2, 2, 2), (3, 3, 3)).withColumn("month", F.expr(MONTH)), t.manifest())
    return t


def opened(df):
    """Partitions and parts whose files a plan would read."""
    return {tuple(f.split("/")[-3:-1]) for f in df.inputFiles()}


def months(df):
    return sorted({m.removeprefix("month=") for _, m in opened(df)})


def test_only_wanted_partitions_are_opened(table):
    assert months(table.read()) == ["2024-01", "2024-02", "2024-03"]
    assert months(table.read(partitions=["2024-02", "2030-01"])) == ["2024-02"]
    assert got(table.read(partitions=["2024-02"])) == [(2, 2, 2)]


def test_a_merge_shows_whole_or_not_at_all(table, frame, monkeypatch):
    old = table.read()
    new = frame((1, 1, 10), (4, 4, 40))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_put", fail)
        with pytest.raises(RuntimeError, match="lost"):
            upsert.merge_into(table, new, ["k", "at"], {"v": "replace"}, F.expr(MONTH))
    before = [(1, 1, 1), (2, 2, 2), (3, 3, 3)]
    assert got(table.read()) == before
    state = table.manifest()
    upsert.merge_into(table, new, ["k", "at"], {"v": "replace"}, F.expr(MONTH))
    assert got(table.read()) == [(1, 1, 10), (2, 2, 2), (3, 3, 3), (4, 4, 40)]
    # readers of the state before still see it, and untouched months are the same files
    assert got(old) == before and got(table.read(state)) == before
    assert table.manifest().parts["2024-02"] == state.parts["2024-02"]


def test_of_two_writers_one_gives_way(table, frame):
    base = table.manifest()
    table.replace(frame((1, 1, 5)).withColumn("month", F.expr(MONTH)), ["2024-01"], base)
    with pytest.raises(Conflict):
        table.replace(frame((1, 1, 6)).withColumn("month", F.expr(MONTH)), ["2024-01"], base)
    # another month does not concern them
    table.replace(frame((2, 2, 6)).withColumn("month", F.expr(MONTH)), ["2024-02"], base)
    assert got(table.read()) == [(1, 1, 5), (2, 2, 6), (3, 3, 3)]
    with pytest.raises(Conflict):
        table.commit(table.manifest(1), {}, {"x": 1}) and table.commit(table.manifest(1), {}, {"x": 2})


def test_a_merge_starts_again_after_a_conflict(table, frame, monkeypatch):
    commit, raced = VersionedTable.commit, []

    def late(self, base, changed, properties=None):
        if not raced:
            raced.append(1)
            part, _ = self.write_part(frame((1, 1, 100)).withColumn("month", F.expr(MONTH)))
            commit(self, base, {"2024-01": [part]})
        return commit(self, base, changed, properties)

    monkeypatch.setattr(VersionedTable, "commit", late)
    upsert.merge_into(table, frame((9, 1, 9)), ["k", "at"], {"v": "replace"}, F.expr(MONTH))
    assert got(table.read()) == [(1, 1, 100), (2, 2, 2), (3, 3, 3), (9, 1, 9)]


def test_replaced_partitions_can_become_empty(table, frame):
    table.replace(frame().withColumn("month", F.expr(MONTH)), ["2024-01"], table.manifest())
    assert got(table.read()) == [(2, 2, 2), (3, 3, 3)] and "2024-01" not in table.manifest().parts


def test_vacuum_keeps_what_newer_states_name(table, frame):
    for v in range(3):
        table.replace(frame((1, 1, v)).withColumn("month", F.expr(MONTH)), ["2024-01"], table.manifest())
    assert table.vacuum(keep=1) == 2
    assert got(table.read()) == [(1, 1, 2), (2, 2, 2), (3, 3, 3)]
    table.append(frame((7, 1, 7)).withColumn("month", F.expr(MONTH)), table.manifest())
    assert (7, 1, 7) in got(table.read())


# --- insert if absent ---


def test_filters_never_rule_out_a_key_that_is_there(spark):
    known = spark.range(5000).selectExpr("cast(id * 3 as int) k", "'2024-01' month")
    asked = spark.range(15000).selectExpr("cast(id as int) k", "'2024-01' month")
    filters = presence.marks(known, ["k"], "month", 1024)
    maybe = {r.k for r in presence.possibly_present(asked, filters, ["k"], "month", 1024).collect()}
    assert {3 * i for i in range(5000)} <= maybe
    assert len(maybe) - 5000 < 600  # of 10,000 that are not there
    assert presence.possibly_present(asked.withColumn("month", F.lit("2024-02")), filters, ["k"], "month", 1024).count() == 0


@pytest.fixture
def looked_at(monkeypatch):
    """Months whose keys have been read, by call."""
    read, seen = VersionedTable.read, []

    def noted(self, at=None, partitions=None):
        df = read(self, at, partitions)
        seen.append(months(df))
        return df

    monkeypatch.setattr(VersionedTable, "read", noted)
    return seen


def week(first, value):
    return [(h, first + timedelta(hours=h), value) for h in range(24 * 7)]


def test_a_week_opens_its_own_months_and_only_if_needed(spark, tmp_path, looked_at, monkeypatch):
    t = VersionedTable(spark, str(tmp_path / "t"), SCHEMA)
    year = [(0, datetime(2024, 1, 1) + timedelta(hours=h), 0) for h in range(24 * 200)]
    presence.insert_absent(t, spark.createDataFrame(year, SCHEMA), ["k", "at"], F.expr(MONTH))
    looked_at.clear()
    delivery = spark.createDataFrame(week(datetime(2024, 4, 27), 1), SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_put", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            presence.insert_absent(t, delivery, ["k", "at"], F.expr(MONTH))
    presence.insert_absent(t, delivery, ["k", "at"], F.expr(MONTH))
    presence.insert_absent(t, delivery, ["k", "at"], F.expr(MONTH))  # repeated: all keys are there
    assert looked_at and all(set(x) <= {"2024-04", "2024-05"} for x in looked_at)
    looked_at.clear()
    assert t.read().count() == 24 * 200 + 24 * 7 - 1  # hour 0 of the week was there with key 0
    looked_at.clear()
    presence.insert_absent(t, spark.createDataFrame([(5, datetime(2030, 1, 1), 1)], SCHEMA), ["k", "at"], F.expr(MONTH))
    assert looked_at == [[]]  # a month without rows: no key is read


def test_existing_rows_win_and_of_equal_keys_the_smallest(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), SCHEMA)
    t.append(spark.createDataFrame(rows((1, 1, 1)), SCHEMA).withColumn("month", F.expr(MONTH)), t.manifest())  # a part without filters
    for _ in range(2):
        presence.insert_absent(t, spark.createDataFrame(rows((1, 1, 5), (2, 1, 9), (2, 1, 8), (3, 2, 3)), SCHEMA), ["k", "at"], F.expr(MONTH))
    assert got(t.read()) == [(1, 1, 1), (2, 1, 8), (3, 2, 3)]
