"""Exact order statistics of many columns at once, by narrowing ranges.

One aggregation samples splitters for every range that still holds a wanted position, and one more counts how many rows lie
between them and on each of them, for all columns in the same pass. A value that fills most of a column is a splitter and is
settled by its count alone; otherwise the next round looks only at the rows between two splitters. A range with few rows left
is read out. Every round divides a range by the number of splitters, so the rounds grow with the logarithm of the rows, and
no task or driver ever holds a column.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Splitters of a range, and rows of a range that are read out as they are.
SPLITTERS, SMALL = 64, 10_000


@dataclass
class _Range:
    """Rows of a column with low < value < high (None: open), `before` smaller rows ahead of them."""

    column: str
    low: float | None
    high: float | None
    before: int
    wanted: set[int]

    def holds(self, v: Column) -> Column:
        inside = v.isNotNull()
        inside = inside if self.low is None else inside & (v > F.lit(self.low))
        return inside if self.high is None else inside & (v < F.lit(self.high))


def _value(column: str) -> Column:
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v)


def _place(v: Column, splitters: Column) -> Column:
    """2i: before splitter i and after the one before it; 2i + 1: on splitter i."""
    return 2 * F.size(F.filter(splitters, lambda x: x < v)) + F.when(F.array_contains(splitters, v), 1).otherwise(0)


def _narrowed(df: DataFrame, ranges: list[_Range], found: dict[tuple[str, int], float]) -> list[_Range]:
    """Settles positions that lie on splitters or in small ranges; gives the ranges that are left."""
    cuts = [k / SPLITTERS for k in range(1, SPLITTERS)]
    held = [r.holds(_value(r.column)) for r in ranges]
    sampled = df.agg(*[F.percentile_approx(F.when(h, _value(r.column)), cuts, 1000).alias(f"s{k}") for k, (r, h) in enumerate(zip(ranges, held))]).first()
    splitters = [sorted(set(sampled[f"s{k}"] or [])) for k in range(len(ranges))]
    parts = []
    for k, (r, h, s) in enumerate(zip(ranges, held, splitters)):
        parts.append(F.when(h, F.struct(F.lit(k).alias("k"), _place(_value(r.column), F.lit(s).cast("array<double>")).alias("place"))))
    placed = df.select(F.explode(F.array_compact(F.array(*parts))).alias("x")).groupBy("x.k", "x.place").agg(F.count("*").alias("n")).collect()
    counts = {(r.k, r.place): r.n for r in placed}
    left = []
    for k, (r, s) in enumerate(zip(ranges, splitters)):
        before = r.before
        for place in range(2 * len(s) + 1):
            n = counts.get((k, place), 0)
            mine = {p for p in r.wanted if before <= p < before + n}
            if mine and place % 2:
                found.update({(r.column, p): s[place // 2] for p in mine})
            elif mine:
                i = place // 2
                left.append((n, _Range(r.column, s[i - 1] if i else r.low, s[i] if i < len(s) else r.high, before, mine)))
            before += n
    small = [r for n, r in left if n <= SMALL]
    if small:
        rows = F.array_compact(F.array(*[F.when(r.holds(_value(r.column)), F.struct(F.lit(k).alias("k"), _value(r.column).alias("v"))) for k, r in enumerate(small)]))
        values: dict[int, list[float]] = {}
        for x in df.select(F.explode(rows).alias("x")).select("x.k", "x.v").collect():  # at most SMALL for each wanted position
            values.setdefault(x.k, []).append(x.v)
        for k, r in enumerate(small):
            ordered = sorted(values[k])
            found.update({(r.column, p): ordered[p - r.before] for p in r.wanted})
    return [r for n, r in left if n > SMALL]


def order_statistics(df: DataFrame, wanted: dict[str, set[int]]) -> dict[tuple[str, int], float]:
    """Value at each wanted position (from 0) of each column's values in order, nulls and NaN left out."""
    found: dict[tuple[str, int], float] = {}
    ranges = [_Range(c, None, None, 0, set(p)) for c, p in wanted.items() if p]
    while ranges:
        ranges = _narrowed(df, ranges, found)
    return found


def exact_quantiles(df: DataFrame, columns, quantiles) -> dict[str, list[float | None]]:
    """Linear quantiles of every column, exactly; None for a column without values."""
    n = df.agg(*[F.count(_value(c)).alias(f"n{k}") for k, c in enumerate(columns)]).first()
    places = {c: [q * (n[f"n{k}"] - 1) for q in quantiles] if n[f"n{k}"] else [] for k, c in enumerate(columns)}
    found = order_statistics(df, {c: {f(p) for p in ps for f in (math.floor, math.ceil)} for c, ps in places.items()})

    def at(c: str, p: float) -> float:
        low, high = found[c, math.floor(p)], found[c, math.ceil(p)]
        return low + (high - low) * (p - math.floor(p))

    return {c: [at(c, p) for p in ps] or [None] * len(quantiles) for c, ps in places.items()}
