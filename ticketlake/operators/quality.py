"""Data-quality operators: column contracts, row rules, feature validation, funnels."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ticketlake import rules as R
from ticketlake.functions import cleanse as X

REPORT = ("column_name", "check_name", "bad_rows", "status")


def _long(wide: DataFrame, entries: list[tuple[str, str, str]]) -> DataFrame:
    """Turn one wide row of counters into (column, check, bad_rows, status) rows."""
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("check_name"), F.col(name).cast("bigint").alias("bad_rows")) for c, k, name in entries]
    )
    return wide.select(F.inline(rows)).withColumn("status", F.when(F.col("bad_rows") == 0, "PASS").otherwise("FAIL"))


def check_columns(df: DataFrame, not_null=(), accepted: dict[str, tuple] | None = None) -> DataFrame:
    """not_null and accepted_values of any number of columns in a single pass."""
    aggs, entries = [], []
    for i, c in enumerate(not_null):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n{i}"))
        entries.append((c, "not_null", f"n{i}"))
    for i, (c, values) in enumerate((accepted or {}).items()):
        aggs.append(F.count_if(X.is_true(~F.col(c).isin(*values))).alias(f"a{i}"))
        entries.append((c, "accepted_values", f"a{i}"))
    return _long(df.agg(*aggs), entries)


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Number of key values that occur more than once (NULL keys are not compared)."""
    groups = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return _long(groups.agg(F.count_if(F.col("n") > 1).alias("u")), [(key, "unique", "u")])


def failing_rows(df: DataFrame, rules: list[Column]) -> DataFrame:
    """Rows that break at least one rule; a rule that is unknown does not fire."""
    return df.filter(reduce(lambda a, b: a | b, [X.is_true(r) for r in rules]))


def level_mismatch(df: DataFrame, level: str, score: str, ordinal=R.LEVEL_ORDINAL, default: int = 1) -> DataFrame:
    return df.filter(F.col(score) != X.map_codes(level, ordinal, default))


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def in_future(df: DataFrame, column: str, as_of, skew_days: int = 0) -> DataFrame:
    return df.filter(F.col(column) > X.moment(as_of) + F.expr(f"INTERVAL {int(skew_days)} DAY"))


def implausible_assets(df: DataFrame) -> DataFrame:
    """Cross-column plausibility of asset grades and ages."""
    bios, drive, age = F.col("bios_risk_encoded"), F.col("drive_health_encoded"), F.col("asset_age_years")
    return failing_rows(df, [age < 0, (drive >= 3) & bios.isNull(), (bios >= 3) & (drive == 0) & (age < 2)])


def validate_features(df: DataFrame, columns: list[str], numeric: list[str]) -> DataFrame:
    """(column, check, value, status): null share and variance of every feature, one aggregation."""
    aggs = [F.count("*").alias("_n")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    aggs += [F.var_samp(F.col(c).cast("double")).alias(f"var_{c}") for c in numeric]
    wide = df.agg(*aggs)

    def entry(c: str, check: str, value: Column, status: Column) -> Column:
        return F.struct(F.lit(c).alias("column_name"), F.lit(check).alias("check_name"), value.alias("value"), status.alias("status"))

    rows = []
    for c in columns:
        pct = X.ratio(F.col(f"null_{c}") * 100, F.col("_n"))
        rows.append(entry(c, "null_pct", pct, F.when(pct > R.MAX_NULL_PCT, "FAIL").when(pct == 0, "PASS").otherwise("WARN")))
    for c in numeric:
        var = F.col(f"var_{c}")
        low = F.coalesce(var < R.MIN_VARIANCE, F.lit(True))
        rows.append(entry(c, "variance", X.rounded(var, 4), F.when(low, "FAIL").otherwise("PASS")))
    return wide.select(F.inline(F.array(*rows)))


def label_support(df: DataFrame, targets) -> DataFrame:
    """Rows per target and class, NULLs as their own class; one shuffle for all targets."""
    pairs = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("string").alias("label")) for t in targets])
    return df.select(F.inline(pairs)).groupBy("target", "label").agg(F.count("*").alias("support"))


def quality_report(df: DataFrame, columns, numeric, targets) -> DataFrame:
    """Feature checks and label distributions as one dataset."""
    checks = validate_features(df, columns, numeric)
    labels = label_support(df, targets).select(
        F.col("target").alias("column_name"), F.concat(F.lit("label:"), F.coalesce("label", F.lit("null"))).alias("check_name"),
        F.col("support").cast("double").alias("value"), F.lit("INFO").alias("status"),
    )
    return checks.unionByName(labels)


def duplicate_columns(df: DataFrame) -> list[str]:
    seen, repeated = set(), []
    for c in df.columns:
        (repeated.append(c) if c in seen else seen.add(c))
    return repeated


def funnel(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Rows before and after each cumulative filter, in one pass."""
    aggs, ok = [F.count("*").alias("s0")], F.lit(True)
    for i, (_, cond) in enumerate(steps, 1):
        ok = ok & X.is_true(cond)
        aggs.append(F.count_if(ok).alias(f"s{i}"))
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.col(f"s{i - 1}").alias("before"), F.col(f"s{i}").alias("after"))
            for i, (n, _) in enumerate(steps, 1)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows)).withColumn("removed", F.col("before") - F.col("after"))
