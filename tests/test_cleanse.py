"""Boundary rows of the cleansing expressions."""
from datetime import date, datetime

from pyspark.sql import functions as F

from ticketlake import rules as R
from ticketlake.functions import cleanse as X, scores as S


def one(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {dtype}")
    return [r[0] for r in df.select(expr.alias("r")).collect()]


def test_zero_dates_and_chronology(spark):
    assert one(spark, [None, "0000-00-00 00:00:00", "", "2014-01-02 03:04:05"], X.clean_ts("c")) == [None, None, None, datetime(2014, 1, 2, 3, 4, 5)]
    rows = [("2014-01-01", "2013-01-01"), ("2014-01-01", "2014-01-01"), (None, "2013-01-01"), ("2014-01-01", None)]
    df = spark.createDataFrame(rows, "s string, e string").select(X.not_before(F.col("e").cast("date"), F.col("s").cast("date")).alias("r"))
    assert [r[0] for r in df.collect()] == [None, date(2014, 1, 1), date(2013, 1, 1), None]


def test_elapsed_truncates(spark):
    df = spark.sql("SELECT timestamp_ntz'2014-01-01 00:00:00' AS a, timestamp_ntz'2014-01-01 00:59:00' AS b, timestamp_ntz'2014-01-01 01:01:00' AS c")
    assert df.select(X.elapsed("HOUR", "a", "b"), X.elapsed("HOUR", "a", "c")).first()[:] == (0, 1)


def test_day_month_date(spark):
    got = one(spark, ["31/12/2010", "12/31/2010", "05/06/2010", "13/13/2010", "2010-01-01", " ", None], X.day_month_date("c"))
    assert got == [date(2010, 12, 31), date(2010, 12, 31), date(2010, 6, 5), None, None, None, None]


def test_capacity_by_magnitude(spark):
    got = one(spark, ["0", "256", "257", "4096", "1000000000", "1000000001", "abc", " ", None], X.bytes_or_megabytes_gb("c"))
    assert got == [None, None, 0.25, 4.0, 976562.5, 0.93, None, None, None]


def test_blacklists_and_shapes(spark):
    assert one(spark, ["OEM_Serial", "12345678", " X1 ", "", None], X.null_if_in("c", R.BIOS_SERIAL_BLANKS)) == [None, None, "X1", None, None]
    assert one(spark, ["10.0.0.1", "10.0.0", "a.b.c.d", "999.1.1.1", None], X.ipv4_shape("c")) == [True, False, False, True, False]
    assert one(spark, [" TRUE ", "yes", "1", "0", None], X.text_bool("c")) == [True, True, True, False, False]


def test_tiers_at_their_cuts(spark):
    assert one(spark, [None, 0, 1, 2, 3, 4, 5, 6], X.tier("c", R.LEVEL_CUTS, "unknown"), "int") == [
        "unknown", "unknown", "low", "low", "medium", "high", "critical", "critical",
    ]
    assert one(spark, [-0.1, 0.0, 0.1, 4.0, 7.0, 9.0, None], X.tier("c", R.CVSS_CUTS, "unknown"), "double") == [
        "unknown", "unknown", "low", "medium", "high", "critical", "unknown",
    ]


def test_classifier_ignores_case_and_accents(spark):
    assert one(spark, ["RÉSEAU local", "Matériel", "x"], X.classify("c", R.CATEGORY_TYPE, "OTHER")) == ["NETWORK", "HARDWARE", "OTHER"]


def test_status_codes_and_words(spark):
    got = one(spark, ["1", "2", "3", "4", "5", "6", "0", None, "closed", "plan"], X.map_codes("c", R.DESK_STATUS, "unknown"))
    assert got == ["open", "open", "in_progress", "in_progress", "closed", "closed", "unknown", "unknown", "closed", "in_progress"]


def test_change_types(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("x", "X"), ("x", "y"), (None, None)], "o string, n string")
    assert [r[0] for r in df.select(X.change_type("o", "n")).collect()] == ["created", "deleted", "no_change", "updated", "no_change"]


def test_escalation_cases(spark):
    df = spark.createDataFrame([(5, 5, 5), (4, 4, 4), (3, 3, 3), (2, 2, 3), (5, 3, 3)], "p int, u int, i int")
    risk, strict = S.triage_escalation("p", "u", "i")
    _, loose = S.triage_escalation("p", "u", "i", strict=False)
    rows = df.select(risk, strict, loose).collect()
    assert [r[0] for r in rows] == [1.0, 0.6333, 0.2667, 0.0, 0.6]
    assert (rows[4][1], rows[4][2]) == (False, True)


def test_rule_score_bounds(spark):
    cols = "asset_age_years int, high_risk_software_count int, drive_health_encoded int, bios_risk_encoded int, days_since_last_inventory int"
    df = spark.createDataFrame([(0, 0, 0, 0, 0), (10, 6, 3, 3, 180), (None, None, None, None, None)], cols)
    assert [r[0] for r in df.select(S.rule_score()).collect()] == [5, 20, 5]
