"""Files nobody has described, and numbers for rows."""

from datetime import date, datetime
from decimal import Decimal
from random import Random

import pytest

from sunledger.operators import audit, surrogate
from sunledger.sources import dialect, files

T = datetime(2024, 1, 1, 10)


def got(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# The logger's own lines, an energy manager's and a portal's.
LOGGER = "2024-01-01T10:00:00;1234.500\n2024-01-01T10:01:00;400\n"
MANAGER = "DateTime,power\n2024-01-01 10:00,12.5\n2024-01-01 10:15,\n"
PORTAL = "DateTime;Leistung;Status\n2024-01-01T10:00:00;1,5;ok\n2024-01-01T10:05:00;;\n2024-01-01T10:10:00;0,75;ok\n"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (LOGGER, dialect.Dialect(";", None, 2)),
        (MANAGER, dialect.Dialect(",", ("DateTime", "power"), 2)),
        (PORTAL, dialect.Dialect(";", ("DateTime", "Leistung", "Status"), 3)),
        ('"a, b"\t"2024-01-01"\n"c"\t"2024-01-02"\n', dialect.Dialect("\t", None, 2)),
        ("x|1\n", dialect.Dialect("|", None, 2)),
        ("power\n5\n6\n", dialect.Dialect(";", ("power",), 1)),
        ("a;b\nc;d\n", dialect.Dialect(";", None, 2)),
    ],
)
def test_delimiter_and_header_are_found(spark, tmp_path, text, want):
    (tmp_path / "x.csv").write_text(text)
    assert list(dialect.dialects(spark, str(tmp_path))) == [want]


def test_the_three_formats_are_read_without_options(spark, tmp_path):
    for name, text in (("logger", LOGGER), ("manager", MANAGER), ("portal", PORTAL)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.csv").write_text(text)
    read = lambda name, schema: dialect.detected_csv(spark, str(tmp_path / name), schema)
    assert got(read("logger", files.LOGGER), "site_id", "measured_on", "power") == [(0, T, Decimal("1234.5")), (0, T.replace(minute=1), Decimal(400))]
    assert sorted(map(tuple, read("manager", files.QUARTER_HOURS).collect())) == [("2024-01-01 10:00", Decimal("12.5"), 0), ("2024-01-01 10:15", None, 0)]
    assert got(read("portal", files.LOCALISED).where("Leistung is not null"), "DateTime", "Leistung") == [(T, "1,5"), (T.replace(minute=10), "0,75")]


def test_files_of_one_input_may_differ(spark, tmp_path):
    for site, name, text in (
        (1, "a", "2024-01-01T10:00:00;1\n"),
        (1, "b", "power,more,measured_on\n2,\"x, y\",2024-01-01T10:00:00\n"),
        (2, "c", "measured_on\tpower\n2024-01-01T10:00:00\t3\n"),
        (2, "d", ""),
        (2, "e", "2024-01-01T10:00:00;4;surplus\n"),
        (3, "f", "measured_on;other\n2024-01-01T10:00:00;5\n"),
    ):
        (tmp_path / f"site_id={site}").mkdir(exist_ok=True)
        (tmp_path / f"site_id={site}" / f"{name}.csv").write_text(text)
    df = dialect.detected_csv(spark, str(tmp_path), files.LOGGER)
    assert df.columns == ["measured_on", "power", "site_id"]
    rows = sorted(((r.site_id, r.measured_on, None if r.power is None else int(r.power)) for r in df.collect()), key=str)
    assert rows == [(1, T, 1), (1, T, 2), (2, T, 3), (2, T, 4), (3, T, None)]


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "x.csv").write_text("\n \n")
    assert dialect.detected_csv(spark, str(tmp_path), files.LOGGER).collect() == []


# --- numbers ---


def test_numbers_are_dense_and_in_order(spark):
    keys = [(g, Random(1).random() + i) for i in range(500) for g in "abc"]
    df = spark.createDataFrame(keys, "g string, x double").repartition(7)
    rows = surrogate.numbered(df, ["g", "x"], after=10).orderBy("id").collect()
    assert [r.id for r in rows] == list(range(11, 1511))
    assert [(r.g, r.x) for r in rows] == sorted(keys)
    assert surrogate.numbered(df.limit(0), ["g", "x"]).collect() == []


def test_numbers_stay_when_rows_come_later(spark):
    first = spark.createDataFrame([("b", 1), ("d", 2)], "k string, v int")
    stored = surrogate.numbered(first, ["k"])
    later = spark.createDataFrame([("a", 3), ("b", 99), ("c", 4)], "k string, v int")
    both = surrogate.insert_numbered(stored, later, ["k"])
    assert got(both, "id", "k", "v") == [(1, "b", 1), (2, "d", 2), (3, "a", 3), (4, "c", 4)]
    assert got(surrogate.insert_numbered(both, later, ["k"]), "id", "k", "v") == got(both, "id", "k", "v")


def test_ids_are_audited_where_a_table_has_them(spark):
    rows = [(1, 0, Decimal(1), "buy", date(2020, 1, 1), None), (1, 0, Decimal(1), "buy", date(2021, 1, 1), None), (None, 1, Decimal(1), "buy", date(2021, 1, 1), None)]
    prices = spark.createDataFrame(rows, "id int, site_id int, value decimal(5,2), type string, valid_from date, valid_until date")
    found = {r.rule: r.violations for r in audit.audit({"prices": prices}, ["prices"]).collect() if r.violations}
    assert found == {"not_null(id)": 1, "unique(id)": 1}
    assert "unique(id)" not in {r.rule for r in audit.audit({"prices": prices.drop("id")}, ["prices"]).collect()}
