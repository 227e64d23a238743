"""Profiling operators; every report is one aggregation turned into rows."""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from ticketlake.functions import cleanse as X
from ticketlake.operators.selection import exact_quantiles

QUANTILES = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def shape(df: DataFrame) -> DataFrame:
    """Row count, column count and number of columns per type."""
    kinds: dict[str, int] = {}
    for f in df.schema.fields:
        kinds[f.dataType.simpleString()] = kinds.get(f.dataType.simpleString(), 0) + 1
    entries = [("columns", len(df.columns))] + [(f"type:{k}", n) for k, n in sorted(kinds.items())]
    rows = F.array(
        F.struct(F.lit("rows").alias("item"), F.col("n").alias("value")),
        *[F.struct(F.lit(k).alias("item"), F.lit(v).cast("bigint").alias("value")) for k, v in entries],
    )
    return df.agg(F.count("*").alias("n")).select(F.inline(rows))


def null_counts(df: DataFrame) -> DataFrame:
    wide = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])
    return wide.select("_n", F.inline(rows)).select("column_name", "nulls", X.ratio(F.col("nulls") * 100, F.col("_n")).alias("null_pct"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first per key (NULL is a key)."""
    groups = df.groupBy(key).agg(F.count("*").alias("n"))
    return groups.agg(F.sum("n").alias("row_count"), (F.sum("n") - F.count("*")).alias("duplicates"))


def describe(df: DataFrame, columns, quantiles=QUANTILES) -> DataFrame:
    """count, mean, std, min, exact quantiles (linear), max per column."""
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        aggs += [
            F.count(v).alias(f"{c}__count"), X.rounded(F.avg(v), 4).alias(f"{c}__mean"), X.rounded(F.stddev_samp(v), 4).alias(f"{c}__std"),
            F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max"),
        ]
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{k}").alias(k) for k in ("count", "mean", "std", "min", "max")]) for c in columns]
    )
    exact = exact_quantiles(df, columns, quantiles)
    names = [f"p{int(q * 100)}" for q in quantiles]
    shares = df.sparkSession.createDataFrame([(c, *exact[c]) for c in columns], "column_name string, " + ", ".join(f"{n} double" for n in names))
    shares = shares.select("column_name", *[X.rounded(n, 4).alias(n) for n in names])
    return df.agg(*aggs).select(F.inline(rows)).join(shares, "column_name")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram; the last bin holds the maximum."""
    v = F.col(column).cast("double")
    low, high = df.agg(F.min(v)).scalar(), df.agg(F.max(v)).scalar()
    width = (high - low) / bins
    slot = F.when(width == 0, 0).otherwise(F.least(F.floor((v - low) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)))
    return df.filter(v.isNotNull()).groupBy(slot.cast("bigint").alias("bin")).agg(F.count("*").alias("n"))


def correlations(df: DataFrame, columns) -> DataFrame:
    """Pearson correlation of every pair, rows with a missing side left out of that pair."""
    pairs = list(combinations(columns, 2))
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    rows = F.array(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.col(f"c{i}"), 6).alias("corr")) for i, (a, b) in enumerate(pairs)]
    )
    return df.agg(*aggs).select(F.inline(rows))


def populated(df: DataFrame, a: str, b: str) -> DataFrame:
    left, right = X.has_text(F.col(a).cast("string")), X.has_text(F.col(b).cast("string"))
    return df.agg(F.count_if(left & right).alias("both"), F.count_if(left | right).alias("either"), F.count("*").alias("row_count"))
