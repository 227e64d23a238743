"""Rank, top-k, stable numbering and label encoding without a global sort in one task."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ticketlake.operators.relational import _cols
from ticketlake.session import cut_lineage


def rank_within(df: DataFrame, group, order, name: str = "rank") -> DataFrame:
    """Rank inside small groups such as the result lists of queries."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*_cols(group)).orderBy(*_cols(order))))


def rank_in_buckets(df: DataFrame, group: str, order, bucket, name: str = "rank") -> DataFrame:
    """Full ranking of large groups: ``bucket`` grows along ``order``, each bucket is numbered in its
    own task and shifted by the sizes of the buckets before it."""
    tagged = df.withColumn("_b", bucket)
    sizes = tagged.groupBy(F.col(group).alias("_g"), F.col("_b").alias("_sb")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_g").orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_g", "_sb", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(group, "_b").orderBy(*_cols(order))
    joined = tagged.withColumn("_rn", F.row_number().over(inside)).join(
        shift, F.col(group).eqNullSafe(F.col("_g")) & F.col("_b").eqNullSafe(F.col("_sb"))
    )
    return joined.select(*df.columns, (F.col("_rn") + F.col("_shift")).cast("int").alias(name))


def top_k(df: DataFrame, group, order, k: int, name: str = "rank") -> DataFrame:
    """Leading ``k`` rows per group with their rank; partitions pre-select before the shuffle."""
    w = Window.partitionBy(*_cols(group)).orderBy(*_cols(order))
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def head(df: DataFrame, order, n: int) -> DataFrame:
    """Global top-n report (each task keeps n rows)."""
    return df.orderBy(*_cols(order)).limit(n)


def number_in_order(df: DataFrame, key: str, name: str, start: int = 0) -> DataFrame:
    """Consecutive numbers in ``key`` order; equal keys are numbered in an arbitrary order.

    Rows are range-partitioned by sampled bounds and written once, numbered inside their partition and
    shifted by the sizes of the partitions before it, so only one row per partition is ever in one task.
    """
    placed = cut_lineage(df.repartitionByRange(F.col(key).asc_nulls_first()).withColumn("_b", F.spark_partition_id()))
    sizes = placed.groupBy("_b").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(F.col("_b").alias("_sb"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_b").orderBy(F.col(key).asc_nulls_first())
    return (
        placed.withColumn("_rn", F.row_number().over(inside))
        .join(shift, F.col("_b") == F.col("_sb"))
        .select(*df.columns, (F.col("_rn") + F.col("_shift") + (start - 1)).cast("bigint").alias(name))
    )


def label_classes(df: DataFrame, column: str) -> DataFrame:
    """Sorted classes with codes 0..n-1; NULL is a class of its own, written as ``None``."""
    classes = df.select(F.coalesce(F.col(column).cast("string"), F.lit("None")).alias("label")).distinct()
    return number_in_order(classes, "label", "code")


def label_encode(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    classes = label_classes(df, column).select(F.col("label").alias("_label"), F.col("code").alias(output or f"{column}_encoded"))
    return df.join(classes, F.coalesce(F.col(column).cast("string"), F.lit("None")) == F.col("_label"), "left").drop("_label")
