"""The logger's stream: windows that close once, late lines, repeats, restarts and failures in between."""

from datetime import datetime, timedelta
from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from sunledger.operators import ingest
from sunledger.plans import imports
from sunledger.sources import files
from sunledger.sources.versioned import VersionedTable
from sunledger.streaming import logger

T = datetime(2024, 1, 1)


def got(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


class Stream:
    """A landing folder, its checkpoint and what the stream has given out."""

    def __init__(self, spark, tmp_path):
        self.spark, self.land = spark, tmp_path / "in"
        self.land.mkdir()
        self.target, self.cp = str(tmp_path / "given"), str(tmp_path / "cp")

    def file(self, name, lines, site=None):
        folder = self.land if site is None else self.land / f"site_id={site}"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("".join(f"{at:%Y-%m-%dT%H:%M:%S};{power}\n" for at, power in lines))

    def run(self, delivery=0, delay="1 hour", once=False, sink=None, **options):
        lines = logger.logger_stream(self.spark, str(self.land), **options)
        logger.run_available(logger.windows(lines, delivery=delivery, delay=delay, once=once), self.cp, sink or logger.batches_sink(self.target))

    def rows(self):
        """(kind, site, time, total in W, number) given out so far, and what is open."""
        df = logger.given(self.spark, self.target).drop("batch").unionByName(logger.still_open(self.spark, self.cp))
        at = F.expr("timestampadd(MICROSECOND, at, timestamp_ntz '1970-01-01 00:00:00')").alias("t")
        return sorted((r.kind, r.site_id, r.t, r.total // 1_000_000, r.n) for r in df.select("kind", "site_id", at, "total", "n").collect())

    def quarters(self):
        return logger.delivered_quarters(self.spark, self.target, self.cp)


def minutes(*at, day=0):
    return [(T + timedelta(days=day, minutes=m), p) for m, p in at]


def test_a_window_is_given_out_once_when_it_closes(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.file("1.csv", minutes((0, 100), (14, 300), (15, 50)))
    s.run()
    assert s.rows() == [("open", 0, T, 400, 2), ("open", 0, T + timedelta(minutes=15), 50, 1)]
    # 01:15:01 moves the watermark to 00:15:01: the first window has ended
    s.file("2.csv", [*minutes((3, 200)), (T + timedelta(minutes=75, seconds=1), 7)])
    s.run()
    closed = ("closed", 0, T, 600, 3)
    assert s.rows() == [closed, ("open", 0, T + timedelta(minutes=15), 50, 1), ("open", 0, T + timedelta(minutes=75), 7, 1)]
    # nothing new: the query is started again from its checkpoint and gives out nothing
    s.run()
    assert [r for r in s.rows() if r[0] == "closed"] == [closed]


def test_late_lines_are_given_out_beside_the_windows(spark, tmp_path):
    """One site is days behind: none of its lines is lost."""
    s = Stream(spark, tmp_path)
    s.file("a.csv", [(T + timedelta(days=9, minutes=i), 100 * i) for i in range(15)], site=1)
    s.run()
    s.file("b.csv", minutes((0, 7), (5, 9), day=6), site=2)
    s.file("c.csv", [(T + timedelta(days=9, minutes=14), 5)], site=1)
    s.run()
    kinds = {(r[0], r[1]): r[4] for r in s.rows()}
    assert kinds == {("late", 2): 1, ("open", 1): 16}
    assert got(s.quarters(), "site_id", "production") == [(1, Decimal("656.563")), (2, Decimal(8))]


@pytest.mark.parametrize("delay", ["0 seconds", "6 hours", "400 days"])
def test_means_do_not_depend_on_micro_batches(spark, tmp_path, delay):
    """Lines in random order, a file for each few: all ways to close windows give the batch's means."""
    r = Random(4)
    s = Stream(spark, tmp_path)
    lines = [(site, T + timedelta(minutes=r.randrange(3000)), r.randrange(1000)) for site in (1, 2) for _ in range(120)]
    for i in range(8):
        for site in (1, 2):
            s.file(f"{i}.csv", [x[1:] for x in lines[i::8] if x[0] == site], site=site)
    s.run(delay=delay, maxFilesPerTrigger=2)
    batch = ingest.logger_quarters(files.csv_source(spark, str(s.land), files.LOGGER))
    cols = ("site_id", "measured_on", "production")
    assert got(s.quarters(), *cols) == got(batch, *cols)
    if delay == "0 seconds":
        assert "late" in {x[0] for x in s.rows()}


def store(spark, tmp_path, *rows):
    df = spark.createDataFrame([(0, at, Decimal(p)) for at, p in rows], "site_id int, measured_on timestamp_ntz, production decimal(8,3)")
    return imports.write(df.selectExpr("site_id", "measured_on", "production", *[f"cast(0 as decimal(8,3)) {c}" for c in ("consumption", "import", "export")],
                                       "cast(null as decimal(8,3)) buffered", "cast(null as decimal(8,3)) released", "cast(null as smallint) state_of_charge"), str(tmp_path / "m"))


def test_deliveries_are_settled_in_order(spark, tmp_path):
    """Stored 100; the first delivery says 300 and then 500, the second 600, late, and 80 for a new quarter."""
    s = Stream(spark, tmp_path)
    table = store(spark, tmp_path, (T, 100), (T + timedelta(days=40), 1))
    s.file("1.csv", [*minutes((0, 300), (10, 500)), (T + timedelta(hours=5), 50)])
    s.run(0)
    state = logger.settle(spark, s.target, table)
    assert got(table.read(), "measured_on", "production") == [(T, Decimal(250)), (T + timedelta(days=40), Decimal(1))]
    s.file("2.csv", [*minutes((5, 600), (60, 80)), (T + timedelta(hours=5, minutes=1), 70)])
    s.run(1)
    state = logger.settle(spark, s.target, table)
    assert state.parts["2024-02"] == table.manifest(1).parts["2024-02"]  # a month without lines is not touched
    want = [(T, Decimal(425)), (T + timedelta(hours=1), Decimal(80)), (T + timedelta(days=40), Decimal(1))]
    assert got(table.read(), "measured_on", "production") == want
    # nothing is left to do
    assert logger.settle(spark, s.target, table) == state
    # the open quarter has a value of each delivery, which meet like any others
    pending = logger.delivered_quarters(spark, s.target, s.cp, after=state.properties[logger.LEDGER])
    both = logger.fold_deliveries(table.read(state), pending)
    assert got(both, "measured_on", "production") == sorted([*want, (T + timedelta(hours=5), Decimal(60))])


def test_a_failure_between_merge_and_commit_changes_nothing(spark, tmp_path, monkeypatch):
    s = Stream(spark, tmp_path)
    table = store(spark, tmp_path, (T, 100))
    s.file("1.csv", [*minutes((0, 300)), (T + timedelta(hours=5), 50)])
    s.run()
    before = table.manifest()

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_put", fail)
        with pytest.raises(RuntimeError, match="lost"):
            logger.settle(spark, s.target, table)
    assert table.manifest() == before and got(table.read(), "production") == [(Decimal(100),)]
    for _ in range(2):  # again, and once more after it has worked
        logger.settle(spark, s.target, table)
        assert got(table.read(), "production") == [(Decimal(200),)]


def test_a_replayed_micro_batch_overwrites_itself(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.file("1.csv", [*minutes((0, 300)), (T + timedelta(hours=5), 50)])
    write, failed = logger.batches_sink(s.target), []

    def sink(batch, batch_id):
        write(batch, batch_id)
        if not failed and batch.count():
            failed.append(batch_id)
            raise RuntimeError("lost after writing")

    with pytest.raises(Exception, match="lost after writing"):
        s.run(sink=sink)
    s.run()
    assert failed and s.rows() == [("closed", 0, T, 300, 1), ("open", 0, T + timedelta(hours=5), 50, 1)]


def test_repeated_lines_count_once(spark, tmp_path):
    """Within open windows by the state, later by the days they fall on; only new batches are read."""
    s = Stream(spark, tmp_path)
    table = VersionedTable(spark, str(tmp_path / "lines"), logger.LINES, "day")
    first = [*minutes((0, 100), (1, 200), (1, 150)), *minutes((0, 1), day=2)]
    s.file("1.csv", first)
    s.run(once=True)
    logger.settle_lines(spark, s.target, table)
    one = table.manifest()
    assert got(table.read(), "measured_on", "power") == [(T, Decimal(100)), (T + timedelta(minutes=1), Decimal(200))]
    s.file("2.csv", [*first, *minutes((1, 250), (2, 9)), *minutes((0, 5), day=1), *minutes((0, 3), day=4)])
    s.run(once=True)
    two = logger.settle_lines(spark, s.target, table)
    assert two.properties[logger.LEDGER] > one.properties[logger.LEDGER]
    want = [(T, 100), (T + timedelta(minutes=1), 250), (T + timedelta(minutes=2), 9), (T + timedelta(days=1), 5), (T + timedelta(days=2), 1), (T + timedelta(days=4), 3)]
    assert got(logger.lines_once(spark, table, s.cp), "measured_on", "power") == [(t, Decimal(p)) for t, p in want]
    assert logger.settle_lines(spark, s.target, table) == two


def test_lines_without_time_or_power_count_nowhere(spark, tmp_path):
    s = Stream(spark, tmp_path)
    (s.land / "x.csv").write_text(";5\n2024-01-01T10:00:00;\n2024-01-01T10:00:00;4\n")
    s.run()
    assert s.rows() == [("open", 0, T + timedelta(hours=10), 4, 1)]
