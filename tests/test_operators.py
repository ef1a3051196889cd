"""Hand-made edge cases of the reusable operators."""

from datetime import date, datetime, timedelta
from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from sunledger.functions.numeric import half_away, half_even_int
from sunledger.operators import spine, upsert
from sunledger.operators.asof import Match, asof_join, month_index
from sunledger.operators.chain import unbroken_chain
from sunledger.operators.intervals import day_index, hour_index, interval_join, intervals
from sunledger.operators.pivot import drop_empty_columns
from sunledger.operators.steps import step_lookup

D = date.fromisoformat
T0 = datetime(2020, 1, 1)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_half_away_uses_the_binary_value(spark):
    df = spark.createDataFrame([(1.005,), (-2.5,), (2.675,)], "x double")
    assert [r[0] for r in df.select(half_away(F.col("x"), 2)).collect()] == [1.0, -2.5, 2.68]
    assert [r[0] for r in df.select(half_away(F.col("x"))).collect()] == [1.0, -3.0, 3.0]


def test_half_even_int(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert [r[0] for r in df.select(half_even_int(F.col("x"))).collect()] == [0, 2, 2]


# --- chain ---


def reachable(periods):
    """The recursive definition, literally."""
    found = [p for p in periods if not any(o[0] < p[0] and o[1] is not None for o in periods)]
    queue = list(found)
    while queue:
        p = queue.pop()
        nxt = [q for q in periods if p[1] is not None and q[0] == p[1] + timedelta(days=1)]
        found += nxt
        queue += nxt
    return sorted(found, key=lambda p: p[0])


CHAINS = {
    "gap": [("2020-01-01", "2020-01-31"), ("2020-02-01", "2020-02-29"), ("2020-03-05", None)],
    "overlap": [("2020-01-01", "2020-01-10"), ("2020-01-05", "2020-01-20"), ("2020-01-11", "2020-01-31"), ("2020-02-01", None)],
    "open first": [("2020-01-01", None), ("2020-02-01", "2020-02-29"), ("2020-03-01", None)],
    "single": [("2020-01-01", None)],
    "open in between": [("2020-01-01", "2020-01-31"), ("2020-02-01", None), ("2020-03-01", "2020-03-31")],
}


def test_chain_equals_recursion(spark):
    data = {k: [(D(a), D(b) if b else None) for a, b in v] for k, v in CHAINS.items()}
    rnd = Random(5)
    for i in range(30):
        starts = sorted(rnd.sample(range(60), 12))
        data[f"random {i}"] = [
            (D("2020-01-01") + timedelta(days=s), None if rnd.random() < 0.15 else D("2020-01-01") + timedelta(days=s + rnd.randrange(9)))
            for s in starts
        ]
    flat = [(k, a, b, i) for k, v in data.items() for i, (a, b) in enumerate(v)]
    df = spark.createDataFrame(flat, "g string, valid_from date, valid_until date, v int")
    got = {}
    for r in unbroken_chain(df, ["g"], ["v"]).collect():
        got.setdefault(r.g, []).append((r.valid_from, r.valid_until))
    assert {k: sorted(v, key=lambda p: p[0]) for k, v in got.items()} == {k: reachable(v) for k, v in data.items()}


# --- as-of ---


def brute_asof(left, right, forward):
    out = []
    for s, k in left:
        c = [(rk, v) for rs, rk, v in right if rs == s and (rk >= k if forward else rk <= k)]
        best = (min if forward else max)(c, key=lambda x: x[0], default=(None, None))
        out.append((s, k, best[0], best[1]))
    return out


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("bucket", [None, month_index])
def test_asof_equals_brute_force(spark, forward, bucket):
    rnd = Random(7)
    # site 0 holds most rows, site 2 has no right rows, site 3 no left rows
    left = [(0, T0 + timedelta(hours=7 * i)) for i in range(600)]
    left += [(s, T0 + timedelta(hours=rnd.randrange(5000))) for s in (1, 2) for _ in range(40)]
    right = [(0, T0 + timedelta(hours=h), None if h % 3 == 0 else h) for h in rnd.sample(range(4000), 50)]
    right += [(0, T0 + timedelta(hours=14), -1)] if not any(r[1] == T0 + timedelta(hours=14) for r in right) else []
    right += [(s, T0 + timedelta(hours=h), h) for s in (1, 3) for h in (4000, 100)]
    ldf = spark.createDataFrame(left, "site_id int, k timestamp_ntz")
    rdf = spark.createDataFrame(right, "site_id int, rk timestamp_ntz, v int")
    m = Match(rdf, F.col("rk"), {"rk": "rk", "v": "v"})
    got = asof_join(ldf, F.col("k"), [m], by=["site_id"], forward=forward, bucket=bucket)
    key = lambda r: (r[0], r[1])
    want = sorted(brute_asof(left, right, forward), key=key)
    assert sorted((tuple(r) for r in got.select("site_id", "k", "rk", "v").collect()), key=key) == want
    inner = asof_join(ldf, F.col("k"), [m], by=["site_id"], forward=forward, bucket=bucket, inner=True)
    assert inner.count() == sum(w[2] is not None for w in want)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("bucket", [month_index, day_index, hour_index])
def test_intervals_equal_the_union_form(spark, forward, bucket):
    """Gaps, rows before the first and after the last key, NULL inside a match, sites with one side only, left rows without key."""
    rnd = Random(11)
    left = [(s, T0 + timedelta(minutes=rnd.randrange(400_000))) for s in (0, 0, 0, 1, 2) for _ in range(120)] + [(0, None), (9, None)]
    left += [(0, datetime(1990, 1, 1)), (0, datetime(9999, 1, 1)), (1, datetime(2020, 2, 29, 23, 59, 59))]
    keys = {0: rnd.sample(range(250_000), 150), 1: [40_000], 3: [5]}
    right = [(s, T0 + timedelta(minutes=m), None if m % 3 == 0 else m) for s, ms in keys.items() for m in ms] + [(0, None, 7)]
    left += [(s, k) for s, k, _ in right[:20]]
    ldf = spark.createDataFrame(left, "site_id int, k timestamp_ntz")
    rdf = spark.createDataFrame(right, "site_id int, rk timestamp_ntz, v int")
    m = Match(rdf, F.col("rk"), {"rk": "rk", "v": "v"})
    made = intervals(m, by=["site_id"], bucket=bucket, forward=forward)
    key = lambda r: (r[0], str(r[1]))
    for inner in (False, True):
        got = interval_join(ldf, F.col("k"), made, ["rk", "v"], inner=inner)
        want = asof_join(ldf, F.col("k"), [m], by=["site_id"], forward=forward, inner=inner, bucket=month_index)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_intervals_scan_the_left_side_once_and_do_not_sort_it(spark, tmp_path):
    spark.createDataFrame([(i % 3, T0 + timedelta(hours=i)) for i in range(100)], "site_id int, k timestamp_ntz").write.parquet(str(tmp_path / "left"))
    ldf = spark.read.parquet(str(tmp_path / "left"))
    spark.createDataFrame([(0, T0, 1)], "site_id int, rk timestamp_ntz, v int").write.parquet(str(tmp_path / "right"))
    rdf = spark.read.parquet(str(tmp_path / "right"))
    made = intervals(Match(rdf, F.col("rk"), {"v": "v"}), by=["site_id"], bucket=month_index)
    text = plan_of(interval_join(ldf, F.col("k"), made, ["v"]))
    assert text.count(f"{tmp_path}/left") == 1
    sorts = [line for line in text.splitlines() if "Sort [" in line]
    assert "SortMergeJoin" not in text and all("__from" in line for line in sorts)  # those of the right side's lead


def test_a_stray_left_key_costs_one_carry_row(spark):
    left = spark.createDataFrame([(s, T0) for s in range(50)] + [(0, datetime(9999, 1, 1))], "site_id int, k timestamp_ntz")
    right = spark.createDataFrame([(s, T0 - timedelta(days=400), s) for s in range(50)], "site_id int, rk timestamp_ntz, v int")
    got = asof_join(left, F.col("k"), [Match(right, F.col("rk"), {"v": "v"})], by=["site_id"], bucket=month_index)
    rows = got.collect()
    assert len(rows) == 51 and all(r["v"] == r["site_id"] for r in rows)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in text.lower()


def test_asof_never_broadcasts_a_side(spark):
    ldf = spark.createDataFrame([(0, T0)], "site_id int, k timestamp_ntz")
    plan = asof_join(ldf, F.col("k"), [Match(ldf, F.col("k"), {"o": "k"})], by=["site_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in text and "Cartesian" not in text


def test_step_lookup_with_ties_and_nulls(spark):
    left = spark.createDataFrame([(y,) for y in (1989, 1990, 1995, 2030, None, 1995)], "year int")
    steps = spark.createDataFrame([(1990, 7), (1993, 5), (1993, 8), (2000, 9), (None, 99)], "y int, value int")
    got = step_lookup(left, "year", steps, "y", ["value"])
    want = [(None, None), (1989, None), (1990, 7), (1995, 8), (1995, 8), (2030, 9)]
    assert [tuple(r) for r in got.orderBy("year").collect()] == want


# --- merge ---


def p(x):
    return None if x is None else Decimal(x).quantize(Decimal("0.001"))


@pytest.mark.parametrize(
    ("rule", "want"),
    [
        ("replace", {1: 5, 2: 8, 3: 2, 4: 6, 5: 4}),
        ("mean_unless_zero", {1: 5, 2: 6, 3: 3, 4: 6, 5: 4}),
        ("raise_only", {1: 5, 2: 6, 3: 4, 4: 6, 5: 4}),
    ],
)
def test_merge_rules(spark, rule, want):
    """1: stored 0, 2: lower, 3: higher, 4: only new, 5: only stored."""
    old = spark.createDataFrame([(1, p(0), p(9)), (2, p(4), p(9)), (3, p(4), p(9)), (5, p(4), p(9))], "k int, v decimal(8,3), w decimal(8,3)")
    new = spark.createDataFrame([(1, p(5)), (2, p(8)), (3, p(2)), (4, p(6))], "k int, v decimal(8,3)")
    got = upsert.merge(old, new, ["k"], {"v": rule}, {"w": 0})
    assert {r.k: r.v for r in got.collect()} == {k: p(v) for k, v in want.items()}
    assert {r.k: r.w for r in got.collect()} == {1: p(9), 2: p(9), 3: p(9), 4: p(0), 5: p(9)}
    if rule == "replace":
        again = upsert.merge(got, new, ["k"], {"v": rule}, {"w": 0})
        assert sorted(again.collect()) == sorted(got.collect())


def test_keep_first_fills_gaps_only(spark):
    old = spark.createDataFrame([(1, None), (2, p(3))], "k int, v decimal(8,3)")
    new = spark.createDataFrame([(1, p(7)), (2, p(9))], "k int, v decimal(8,3)")
    once = upsert.merge(old, new, ["k"], {"v": "keep_first"})
    assert rows(once, "k", "v") == [(1, p(7)), (2, p(3))]
    assert rows(upsert.merge(once, new, ["k"], {"v": "keep_first"}), "k", "v") == rows(once, "k", "v")


def test_insert_if_absent_matches_by_name(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([("x", 1), ("z", 2), ("y", 2)], "v string, k int")
    assert rows(upsert.insert_if_absent(old, new, ["k"]), "k", "v") == [(1, "a"), (2, "y")]


def test_merge_into_parquet_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [(0, datetime(2020, m, 1), p(4)) for m in (1, 2)]
    month = F.date_format("measured_on", "yyyy-MM")
    schema = "site_id int, measured_on timestamp_ntz, production decimal(8,3)"
    spark.createDataFrame(old, schema).withColumn("month", month).write.partitionBy("month").parquet(path)
    untouched = {f.name for f in (tmp_path / "t" / "month=2020-01").iterdir()}
    new = spark.createDataFrame([(0, datetime(2020, 2, 1), p(8)), (0, datetime(2020, 3, 1), p(1))], schema)
    upsert.merge_into_parquet(spark, path, new, ["site_id", "measured_on"], {"production": "replace"}, "month", month, schema)
    got = spark.read.parquet(path)
    assert rows(got, "measured_on", "production") == [(datetime(2020, 1, 1), p(4)), (datetime(2020, 2, 1), p(8)), (datetime(2020, 3, 1), p(1))]
    assert {f.name for f in (tmp_path / "t" / "month=2020-01").iterdir()} == untouched


# --- spine, pivot ---


def test_quarter_hours_end_before_tomorrows_midnight(spark):
    df = spark.createDataFrame([(0, D("2024-03-30"))], "site_id int, f date")
    got = [r.ts for r in spine.quarter_hours(df, F.col("f"), D("2024-03-31")).select("ts").collect()]
    assert sorted(got) == [datetime(2024, 3, 30) + timedelta(minutes=15 * i) for i in range(192)]


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(0, None, 1), (1, None, None)], "h int, a int, b int")
    assert drop_empty_columns(df, ["h"], {"b": "B"}).columns == ["h", "B"]
