"""Contracts: what they hold, and the compiled checks on rows with nulls, repeats and unknown values."""
from datetime import datetime

import pytest

import __spark_entry__ as entry
from ticketlake.contracts import Contract, contracts
from ticketlake.operators import contract_checks as K
from tools.check import compare

NOW = datetime(2024, 1, 1)
SMALL = Contract("m", "id", ["id", "level"], {"level": ("a", "b"), "flag": ("0", "1")}, {"range": "n < 0 OR n > 10", "late": "at > {as_of}"})
ROWS = [
    (1, "a", 0, 5, datetime(2023, 1, 1)), (1, "c", 2, None, None), (None, None, None, -1, datetime(2025, 1, 1)), (None, "b", 1, 11, None), (2, "a", None, 10, NOW),
]
SCHEMA = "id int, level string, flag int, n int, at timestamp"


def test_every_rule_is_there():
    all_ = contracts()
    assert (len(all_), sum(len(c.required) for c in all_), sum(len(c.accepted) for c in all_)) == (31, 260, 107)
    staging = [c for c in all_ if c.model.startswith("stg_")]
    assert len(staging) == 22 and all(list(c.rows) == ["row"] for c in staging)
    assert sum(len(c.rows) for c in all_ if c.model.startswith("silver_")) == 8


def test_counts(spark):
    got = {(r.column_name, r.check_name): (r.bad_rows, r.status) for r in K.check(spark.createDataFrame(ROWS, SCHEMA), SMALL, NOW).collect()}
    assert got == {
        ("id", "unique"): (1, "FAIL"), ("id", "not_null"): (2, "FAIL"), ("level", "not_null"): (1, "FAIL"), ("level", "accepted_values"): (1, "FAIL"),
        ("flag", "accepted_values"): (1, "FAIL"), ("range", "row_rule"): (2, "FAIL"), ("late", "row_rule"): (1, "FAIL"),
    }


def test_empty_model_passes(spark):
    rows = K.check(spark.createDataFrame([], SCHEMA), SMALL, NOW).collect()
    assert len(rows) == 7 and {(r.bad_rows, r.status) for r in rows} == {(0, "PASS")}


def test_failing_rows(spark):
    got = sorted((r.key, list(r.broken)) for r in K.failing(spark.createDataFrame(ROWS, SCHEMA), SMALL, NOW).collect() if r.key)
    assert got == [("1", ["accepted_values:flag", "accepted_values:level"])]
    broken = [list(r.broken) for r in K.failing(spark.createDataFrame(ROWS, SCHEMA), SMALL, NOW).collect() if not r.key]
    assert sorted(broken) == [["not_null:id", "not_null:level", "row_rule:late", "row_rule:range"], ["not_null:id", "row_rule:range"]]


def test_a_model_is_evaluated_once(spark):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        K.check(spark.createDataFrame(ROWS, SCHEMA), SMALL, NOW).explain()
    assert out.getvalue().count("Scan") == 1


@pytest.mark.parametrize("name", ["qa1_qa4_contracts_silver", "qa4_failing_rows_external"])
def test_queries_match_their_oracle(spark, folder, name):
    import duckdb

    from ticketlake.sources.tables import NAMES

    con = duckdb.connect()
    for n in NAMES:
        con.execute(f"create view {n} as select * from '{folder}/{n}.parquet'")
    df = entry.queries()[name](spark, folder)
    cur = con.execute(entry.oracle_sql()[name])
    assert compare(df.collect(), df.columns, cur.fetchall(), [d[0] for d in cur.description]) is None
