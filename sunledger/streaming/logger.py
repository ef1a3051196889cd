"""Logger lines as a stream: windows of event time, late rows, repeats.

One stateful query keeps the open quarter hours of each site and day.  A window is given out once, when the watermark has
passed its end; its state goes then.  A line of a window that is closed already is late: it is given out as it is, beside
the windows, and loses nothing.  Both kinds go to the folder of the micro-batch, so a replayed batch overwrites itself.

What a run of the stream finds is a delivery.  Windows and late lines carry it, so the mean of a quarter hour is that over all
lines of its delivery however they fell into micro-batches, and later deliveries meet the stored value by the merge rule.
``settle`` merges what has been given out into a versioned table, which keeps the number of the last batch it has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sunledger.functions.timecols import quarter_start
from sunledger.operators.ingest import ZERO_DEFAULTS
from sunledger.operators.upsert import RULES, merge, to_power
from sunledger.sources.files import LOGGER, with_site
from sunledger.sources.scratch import exists
from sunledger.sources.versioned import Manifest, VersionedTable, values_of
from sunledger.tables import SITE

KEYS = (SITE, "measured_on")
#: Length of a window in microseconds.
WINDOW = 15 * 60 * 1_000_000
_DAY = 24 * 3_600 * 1_000_000
_EPOCH = "timestamp_ntz '1970-01-01 00:00:00'"

#: ``at`` is the start of a window, or the time of a line; sums are in millionths.
GIVEN = "kind string, site_id int, delivery bigint, at bigint, total bigint, n bigint"
_HELD = "at array<bigint>, total array<bigint>, n array<bigint>"
CLOSED, LATE, OPEN = "closed", "late", "open"
#: A settled table of lines.
LINES = "site_id int, measured_on timestamp_ntz, power decimal(18,6)"

#: Days or months of one settlement that are named in a filter.
NAMED = 400


def logger_stream(spark: SparkSession, path: str, **options: Any) -> DataFrame:
    """Lines ``measured_on;power`` appearing in ``path`` or, per site, below ``path/site_id=<n>/``.

    ``maxFilesPerTrigger`` bounds a micro-batch.
    """
    source = {k: v for k, v in options.items() if k.startswith("max")}
    reader = spark.readStream.schema(LOGGER).options(sep=";", **{k: v for k, v in options.items() if k not in source})
    return with_site(reader.options(**source).csv(path))


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process what is there and stop."""
    q: StreamingQuery = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sink)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def _kept(once: bool) -> Callable[..., Iterator[pd.DataFrame]]:
    """What to do with the lines of a (site, delivery, day): ``once`` keeps lines by their time, else sums by window."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        front = state.getCurrentWatermarkMs() * 1000
        site, delivery, _ = key
        held = [np.array(x, np.int64) for x in (state.get if state.exists else ((), (), ()))]

        def given(kind: str, at: np.ndarray, total: np.ndarray, n: np.ndarray) -> pd.DataFrame:
            return pd.DataFrame({"kind": kind, "site_id": np.full(len(at), site, np.int32), "delivery": np.full(len(at), delivery, np.int64), "at": at, "total": total, "n": n})

        for frame in frames:
            at, power = frame["at"].to_numpy(np.int64), frame["power"].to_numpy(np.int64)
            late = at - at % WINDOW + WINDOW < front
            if late.any():
                yield given(LATE, at[late], power[late], np.ones(late.sum(), np.int64))
            at, power = at[~late], power[~late]
            place = at if once else at - at % WINDOW
            both = [np.concatenate(x) for x in zip(held, (place, power, np.ones(len(at), np.int64)), strict=True)]
            keys, back = np.unique(both[0], return_inverse=True)
            total, n = np.full(len(keys), np.iinfo(np.int64).min) if once else np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
            (np.maximum if once else np.add).at(total, back, both[1])
            (np.maximum if once else np.add).at(n, back, both[2])
            held = [keys, total, n]
        ends = held[0] - held[0] % WINDOW + WINDOW
        done = ends < front
        if done.any():
            yield given(CLOSED, *[x[done] for x in held])
        if done.all():
            state.remove()
        else:
            state.update(tuple(x[~done].tolist() for x in held))
            state.setTimeoutTimestamp(int(ends[~done].min()) // 1000)

    return run


def windows(lines: DataFrame, *, delivery: int = 0, delay: str = "1 day", once: bool = False) -> DataFrame:
    """``GIVEN`` rows of a stream of lines: windows that have closed, and lines that came after that.

    ``delay`` is how far the newest line may be ahead of a window's end before it closes.  With ``once``, lines take the
    place of windows: each site and time once, of several values the largest, as long as its window is open; all runs
    then have to name the same ``delivery``.
    Lines without time or power count nowhere.
    """
    # by parts of the local time, so that no zone comes in
    minutes = (F.unix_date(F.col("measured_on").cast("date")) * 24 + F.hour("measured_on")) * 60 + F.minute("measured_on")
    at = minutes.cast("bigint") * 60_000_000 + (F.expr("extract(second from measured_on)") * 1_000_000).cast("bigint")
    event = F.timestamp_micros(at)
    # A line that carries event time would be dropped unseen once it is behind the watermark.  So a copy of each
    # moves the watermark and ends there, and the line itself goes on without; the function decides about it.
    rows = lines.where("measured_on is not null and power is not null").select(
        SITE,
        F.lit(delivery).cast("bigint").alias("delivery"),
        at.alias("at"),
        (F.col("power") * 1_000_000).cast("bigint").alias("power"),
        F.explode(F.array(event, F.lit(None).cast("timestamp"))).alias("event"),
    )
    rows = rows.withWatermark("event", delay).where(F.col("event").isNull()).withColumn("day", F.floor(F.col("at") / F.lit(_DAY)))
    return rows.groupBy(SITE, "delivery", "day").applyInPandasWithState(_kept(once), GIVEN, _HELD, "append", GroupStateTimeout.EventTimeTimeout)


def batches_sink(target: str) -> Callable[[DataFrame, int], None]:
    """Keep what a micro-batch gives out under its id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return write


def given(spark: SparkSession, target: str, after: int = -1) -> DataFrame:
    """``GIVEN`` rows and ``batch`` of all micro-batches after one; earlier ones are not opened."""
    if not exists(spark, target):
        return spark.createDataFrame([], f"{GIVEN}, batch int")
    return spark.read.schema(f"{GIVEN}, batch int").parquet(target).where(F.col("batch") > after)


def still_open(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``GIVEN`` rows of the windows (or lines) that the query's state holds."""
    state = spark.read.format("statestore").load(checkpoint)
    held = F.arrays_zip(*[F.col(f"value.groupState.{c}").alias(c) for c in ("at", "total", "n")])
    return state.select(F.lit(OPEN).alias("kind"), f"key.{SITE}", "key.delivery", F.inline(held))


def _time(at: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, {at}, {_EPOCH})")


def _power(total: Column) -> Column:
    return (total.cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(26,6)")


def quarters(rows: DataFrame) -> DataFrame:
    """Quarter-hour means of each delivery, from ``GIVEN`` rows of any kind."""
    sums = rows.groupBy(SITE, quarter_start(_time("at")).alias("measured_on"), "delivery").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    power = to_power(_power(F.col("total")).cast("double") / F.col("n"))
    return sums.select(*KEYS, "delivery", power.alias("production"))


def delivered_quarters(spark: SparkSession, target: str, checkpoint: str, after: int = -1) -> DataFrame:
    """Quarter-hour means of each delivery, windows that are open still included."""
    return quarters(given(spark, target, after).drop("batch").unionByName(still_open(spark, checkpoint)))


def fold_deliveries(stored: DataFrame, delivered: DataFrame, rule: str = "mean_unless_zero") -> DataFrame:
    """Merge the stored power and all later deliveries in their order.

    Per key there is one value for each delivery that has touched it and has not been settled.
    """
    first = stored.select(*KEYS, F.lit(-1).cast("bigint").alias("delivery"), "production")
    later = delivered.select(*KEYS, "delivery", "production")
    values = F.transform(
        F.array_sort(F.collect_list(F.struct("delivery", "production"))), lambda x: x["production"]
    ).alias("vs")
    merge_two = RULES[rule]
    folded = F.aggregate(F.slice("vs", 2, F.size("vs")), F.element_at("vs", 1), merge_two)
    return first.unionByName(later).groupBy(*KEYS).agg(values).select(*KEYS, folded.alias("production"))


#: Property of a table that says which micro-batch it has merged last.
LEDGER = "batch"


def _last_batch(state: Manifest) -> int:
    return int(state.properties.get(LEDGER, -1))


def _pending(spark: SparkSession, target: str, state: Manifest) -> tuple[DataFrame, int] | None:
    """What was given out since the table's last settlement, and the number of its last batch.

    Batches that gave out nothing have no rows and count with the next one.
    """
    rows = given(spark, target, _last_batch(state))
    last = rows.agg(F.max("batch")).head()[0]
    return None if last is None else (rows.where(F.col("batch") <= last), last)


def settle(spark: SparkSession, target: str, table: VersionedTable, rule: str = "mean_unless_zero") -> Manifest:
    """Merge all that was given out since the last settlement into stored measurements, between two runs of the stream.

    Rows and ledger change in one step: after a failure anywhere before it nothing has happened, and when repeated after it
    nothing is left to do.  Only the months concerned are read and written.  ``table`` has ``production`` and 0 as its
    default for the other flows of a new row.
    """
    def change(state: Manifest) -> Manifest:
        pending = _pending(spark, target, state)
        if pending is None:
            return state
        rows, last = pending
        fresh = quarters(rows).withColumn(table.partition, F.date_format("measured_on", "yyyy-MM"))
        months = values_of(fresh, table.partition, NAMED)
        stored = table.read(state, months if months is not None else state.parts)
        folded = fold_deliveries(stored.join(fresh.select(*KEYS).distinct(), list(KEYS), "left_semi"), fresh, rule)
        merged = merge(stored.drop(table.partition), folded, KEYS, {"production": "replace"}, ZERO_DEFAULTS)
        merged = merged.withColumn(table.partition, F.date_format("measured_on", "yyyy-MM"))
        return table.replace(merged, months if months is not None else state.parts, state, {LEDGER: last}, KEYS)

    return table.retried(change)


def settle_lines(spark: SparkSession, target: str, table: VersionedTable) -> Manifest:
    """Add the lines that were given out since the last settlement to a table of lines by ``day``, each site and time once.

    A closed window's lines are new.  A late line may be there already: the days of late lines are read and written anew,
    of several values the largest stays; other days are only added to.
    """

    def change(state: Manifest) -> Manifest:
        pending = _pending(spark, target, state)
        if pending is None:
            return state
        rows, last = pending
        fresh = rows.select(SITE, _time("at").alias("measured_on"), _power(F.col("total")).cast("decimal(18,6)").alias("power"), "kind")
        fresh = fresh.withColumn(table.partition, F.date_format("measured_on", "yyyy-MM-dd"))
        late = values_of(fresh.where(F.col("kind") == LATE), table.partition, NAMED)
        again = sorted(state.parts) if late is None else late
        concerned = F.col(table.partition).isin(again) if again else F.lit(False)
        old = table.read(state, again)
        met = old.unionByName(fresh.where(concerned).drop("kind")).groupBy(*KEYS, table.partition).agg(F.max("power").alias("power"))
        part, found = table.write_part(met.select(*KEYS, "power", table.partition).unionByName(fresh.where(~concerned).drop("kind")), KEYS)
        parts = {p: [part] if p in again else [*state.parts.get(p, []), part] for p in found}
        return table.commit(state, parts, {LEDGER: last})

    return table.retried(change)


def lines_once(spark: SparkSession, table: VersionedTable, checkpoint: str) -> DataFrame:
    """All settled lines and those of open windows; a line that both have (a late one that came first) counts once."""
    held = still_open(spark, checkpoint).select(SITE, _time("at").alias("measured_on"), _power(F.col("total")).cast("decimal(18,6)").alias("power"))
    return table.read().select(*KEYS, "power").unionByName(held).groupBy(*KEYS).agg(F.max("power").alias("power"))
