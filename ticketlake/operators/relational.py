"""Join, dedup, union and aggregation operators on DataFrames.

Scale notes. Facts join dimensions that are unique on the key, so a hot key only makes one fact
partition large, which adaptive execution splits. De-duplication ranks inside each input partition
before the shuffle (window group limit), so a key that owns a third of all rows still sends only its
leading rows per partition.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticketlake.functions import cleanse as X


def _cols(keys):
    return [k if isinstance(k, Column) else F.col(k) for k in ([keys] if isinstance(keys, (str, Column)) else keys)]


def evaluate_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add expensive columns behind a generator, so later filters and projections reuse the values
    instead of repeating the expressions."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def latest_per_key(df: DataFrame, keys, order, n: int = 1) -> DataFrame:
    """First ``n`` rows per key under ``order``; give a total order for a deterministic result."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def drop_duplicates_ordered(df: DataFrame, keys, order) -> DataFrame:
    """Keep-first de-duplication with an explicit order."""
    return latest_per_key(df, keys, order, 1)


def best_by_rules(left: DataFrame, right: DataFrame, rules: list[tuple[list[Column], list[Column]]], order: list[Column], keep: list[str]) -> DataFrame:
    """Left join to the first row of ``right`` in ``order`` among those that any rule matches.

    Each rule first reduces ``right`` to one row per key (a grouping with partial aggregates), so every
    join meets a unique side and a key that is frequent on both sides never multiplies. ``order`` holds
    sortable expressions, smallest first, with a unique last one; a NULL key never matches.
    """
    out, found = left, []
    for i, (lk, rk) in enumerate(rules):
        keys = [f"_k{i}_{j}" for j in range(len(rk))]
        best = right.groupBy(*[c.alias(k) for c, k in zip(rk, keys)]).agg(F.min(F.struct(F.struct(*order).alias("o"), F.struct(*keep).alias("r"))).alias(f"_b{i}"))
        # the left keys are columns of their own, so that names on the two sides cannot be confused
        out = out.withColumns({f"_l{i}_{j}": c for j, c in enumerate(lk)})
        out = out.join(best, reduce(lambda a, b: a & b, [F.col(f"_l{i}_{j}") == F.col(k) for j, k in enumerate(keys)]), "left").drop(*keys)
        found.append(F.col(f"_b{i}"))
    first = F.array_min(F.filter(F.array(*found), lambda b: b.isNotNull())) if len(found) > 1 else found[0]
    helpers = [c for c in out.columns if c.startswith(("_l", "_b"))]
    return out.withColumn("_first", first).drop(*helpers).select(*left.columns, *[F.col("_first.r").getField(c).alias(c) for c in keep])


def match_any(
    left: DataFrame,
    right: DataFrame,
    rules: list[tuple[list[Column], list[Column]]],
    left_id: str,
    right_id: str,
) -> DataFrame:
    """Left join on ``rule 1 OR rule 2 OR ...`` where each rule is a list of equalities.

    One equi-join per rule; a later rule skips the pairs an earlier rule has found, so the union of
    the matches needs no distinct and no nested loop is planned. ``left_id``/``right_id`` are unique.
    Rule columns are written against ``left``/``right``; a NULL key never matches.
    """
    ln = [(i, j) for i, (lk, _) in enumerate(rules) for j in range(len(lk))]
    lkeys = left.select(left_id, *[rules[i][0][j].alias(f"_l{i}_{j}") for i, j in ln])
    rkeys = right.select(F.col(right_id), *[rules[i][1][j].alias(f"_r{i}_{j}") for i, j in ln])

    def equal(i: int) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"_l{i}_{j}") == F.col(f"_r{i}_{j}") for j in range(len(rules[i][0]))])

    pairs = None
    for i in range(len(rules)):
        cond = equal(i)
        for earlier in range(i):
            cond = cond & ~F.coalesce(equal(earlier), F.lit(False))
        found = lkeys.join(rkeys, cond, "inner").select(left_id, right_id)
        pairs = found if pairs is None else pairs.unionByName(found)
    return left.join(pairs, left_id, "left").join(right, right_id, "left")


def union_aligned(schema, *branches: DataFrame) -> DataFrame:
    """UNION ALL of branches projected onto one target schema."""
    return reduce(DataFrame.unionByName, [X.align(b, schema) for b in branches])


def merge_with_coverage(left: DataFrame, right: DataFrame, left_key: str, right_key: str, columns) -> tuple[DataFrame, DataFrame]:
    """Left merge of selected columns plus a one-row coverage report (rows, unmatched, percentage).

    The report counts left rows without any partner, computed from keys only.
    """
    picked = right.select(F.col(right_key).alias("_rk"), *columns)
    merged = left.join(picked, F.col(left_key) == F.col("_rk"), "left").drop("_rk")
    known = right.select(F.col(right_key).alias("_rk")).filter(F.col("_rk").isNotNull()).distinct().withColumn("_hit", F.lit(1))
    report = (
        left.select(left_key)
        .join(known, F.col(left_key) == F.col("_rk"), "left")
        .agg(
            F.count("*").alias("row_count"),
            F.count_if(F.col("_hit").isNull()).alias("unmatched_rows"),
            X.ratio(F.count_if(F.col("_hit").isNull()) * 100, F.count("*")).alias("unmatched_pct"),
        )
    )
    return merged, report


def fetch_by_rank(ranked: DataFrame, lookup: DataFrame, key: str, group: str, rank: str, defaults: dict) -> DataFrame:
    """Lookup in rank order: ids de-duplicated per group (best rank kept), defaults where missing."""
    wanted = latest_per_key(ranked, [group, key], [F.col(rank)])
    found = wanted.join(lookup, key, "left")
    return found.select(
        *[c for c in found.columns if c not in defaults],
        *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()],
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts and percentage of the total per value (NULL is a value)."""
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    return counts.withColumn("pct", X.ratio(F.col("n") * 100, total))


def group_contrast(df: DataFrame, flag: str, features) -> DataFrame:
    """Mean of each feature for flag 0 and 1, difference and percentage difference; one pass."""
    aggs = []
    for f in features:
        aggs += [F.avg(F.when(F.col(flag) == v, F.col(f).cast("double"))).alias(f"{f}__{v}") for v in (0, 1)]
    wide = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.col(f"{f}__0").alias("normal_mean"), F.col(f"{f}__1").alias("anomaly_mean"))
            for f in features
        ]
    )
    delta = F.col("anomaly_mean") - F.col("normal_mean")
    return (
        wide.select(F.inline(rows))
        .withColumn("delta", delta)
        .withColumn("pct_diff", X.rounded(delta / (F.abs("normal_mean") + 1e-6) * 100, 1))
        .select("feature", *[X.rounded(c, 4).alias(c) for c in ("normal_mean", "anomaly_mean", "delta")], "pct_diff")
    )


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """Checked size bound before anything is broadcast or collected; reads at most ``max_rows + 1`` rows."""
    return df.limit(max_rows + 1).count() <= max_rows
