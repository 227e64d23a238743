"""Contracts compiled to Spark: one aggregation gives all counts of a model, one scan its failing rows."""
from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ticketlake.contracts import Contract
from ticketlake.functions import cleanse as X

REPORT = "model string, column_name string, check_name string, bad_rows bigint, status string"


def _condition(sql: str, as_of: datetime) -> Column:
    return F.expr(sql.replace("{as_of}", f"TIMESTAMP '{as_of:%Y-%m-%d %H:%M:%S}'"))


def conditions(contract: Contract, as_of: datetime) -> list[tuple[str, str, Column]]:
    """(column, check, condition of a bad row) for all checks that look at one row; unknown is not bad."""
    out = [(c, "not_null", F.col(c).isNull()) for c in contract.required]
    out += [(c, "accepted_values", X.is_true(~F.col(c).cast("string").isin(*values))) for c, values in contract.accepted.items()]
    out += [(name, "row_rule", X.is_true(_condition(sql, as_of))) for name, sql in contract.rows.items()]
    return out


def check(df: DataFrame, contract: Contract, as_of: datetime) -> DataFrame:
    """One row for each check of the contract: `model, column_name, check_name, bad_rows, status`.

    Rows are counted by key first, which tells repeated keys too, and the counts of all keys are added up: the model is
    evaluated once, and only keys and small counts are shuffled, summed up in every task before. Null keys do not repeat.
    An empty model passes every check.
    """
    checks = conditions(contract, as_of)
    bad = [F.count_if(condition).alias(f"c{k}") for k, (_, _, condition) in enumerate(checks)]
    by_key = df.groupBy(F.col(contract.key).alias("key")).agg(F.count("*").alias("n"), *bad)
    wide = by_key.agg(
        F.count_if(F.col("key").isNotNull() & (F.col("n") > 1)).alias("repeated"),
        *[F.coalesce(F.sum(f"c{k}"), F.lit(0)).alias(f"c{k}") for k in range(len(checks))],
    )
    rows = [F.struct(F.lit(contract.key).alias("column_name"), F.lit("unique").alias("check_name"), F.col("repeated").alias("bad_rows"))]
    rows += [F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("check_name"), F.col(f"c{k}").alias("bad_rows")) for k, (c, kind, _) in enumerate(checks)]
    status = F.when(F.col("bad_rows") == 0, "PASS").otherwise("FAIL")
    return wide.select(F.inline(F.array(*rows))).select(F.lit(contract.model).alias("model"), "column_name", "check_name", "bad_rows", status.alias("status"))


def failing(df: DataFrame, contract: Contract, as_of: datetime) -> DataFrame:
    """`model, key, broken` for every row that breaks a check on rows; broken: sorted `check:column`. One scan, no shuffle."""
    names = F.array(*[F.when(condition, F.lit(f"{kind}:{c}")) for c, kind, condition in conditions(contract, as_of)])
    broken = F.array_sort(F.array_compact(names))
    rows = df.select(F.lit(contract.model).alias("model"), F.col(contract.key).cast("string").alias("key"), broken.alias("broken"))
    return rows.filter(F.size("broken") > 0)
