"""Anchored fixed-window rate detector, as a batch job and as a stateful stream.

The first event of a key opens a window; an event later than the window's length opens the next one.
Inside a window the first ``limit`` events pass and the rest are rejected with the seconds left.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ticketlake import rules as R
from ticketlake.functions import cleanse as X

OUT = "key string, id bigint, at double, allowed boolean, retry_after int"
STATE = "start double, used int"


def rule_for(path) -> tuple[Column, Column]:
    """(limit, seconds) of the first rule whose prefix starts the path."""
    limit, seconds = F.lit(R.RATE_DEFAULT[0]), F.lit(R.RATE_DEFAULT[1])
    for prefix, n, s in reversed(R.RATE_RULES):
        hit = F.startswith(X._c(path), F.lit(prefix))
        limit, seconds = F.when(hit, n).otherwise(limit), F.when(hit, s).otherwise(seconds)
    return limit, seconds


def _scan(at: np.ndarray, limit: int, seconds: float, start: float | None, used: int):
    """Decisions for one run of sorted times, jumping from window to window."""
    n = len(at)
    allowed, retry = np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int32)
    i = 0
    while i < n:
        if start is None or at[i] - start > seconds:
            start, used = float(at[i]), 0
        end = int(np.searchsorted(at, start + seconds, side="right"))
        while end > i and at[end - 1] - start > seconds:
            end -= 1
        end = max(end, i + 1)
        free = max(min(limit - used, end - i), 0)
        allowed[i : i + free] = True
        left = (seconds - (at[i + free : end] - start)).astype(np.int32)
        retry[i + free : end] = np.maximum(left, 1)
        used += free
        i = end
    return allowed, retry, start, used


def _prepared(events: DataFrame, key: str, ident: str, time: str) -> DataFrame:
    return events.select(F.col(key).cast("string").alias("key"), F.col(ident).alias("id"), F.unix_micros(F.col(time).cast("timestamp")).alias("us"))


def _slices(us: np.ndarray, width: int):
    """Sorted times cut into pieces of one window length: (slice number, offsets in it)."""
    number, offset = np.divmod(us, width)
    edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(us)]
    return [(int(number[a]), offset[a:b], a, b) for a, b in zip(edges, edges[1:])]


def _next_start(offsets: np.ndarray, previous):
    """Offset of the window opened in a slice, given the one opened in the slice before (-1: none)."""
    at = np.searchsorted(offsets, previous, side="right")
    return np.where(at < len(offsets), offsets[np.minimum(at, len(offsets) - 1)], -1)


def detect(events: DataFrame, key: str, ident: str, time: str, limit: int, seconds: int, slices_per_block: int = 64) -> DataFrame:
    """Batch form, parallel within a key.

    Time is cut into slices of one window length, so a slice opens at most one window: at its first
    event whose offset exceeds the offset at which the slice before opened one. A block of slices is
    therefore a step function from the offset before it to the offset after it. Blocks are reduced to
    these few steps in parallel, the steps of a key are chained, and the blocks then place their
    events. No task holds more than one block of a key.
    """
    width = int(seconds) * 1_000_000
    rows = _prepared(events, key, ident, time).withColumn("blk", F.floor(F.col("us") / F.lit(width * slices_per_block)).cast("bigint"))

    def steps(group: pd.DataFrame) -> pd.DataFrame:
        blk = int(group["blk"].iloc[0])
        cut = _slices(np.unique(group["us"].to_numpy()), width)
        first = blk * slices_per_block
        own = cut[0][1] if cut[0][0] == first else np.zeros(0, dtype=np.int64)
        current, upper = np.append(own, -1), np.append(own, width)
        known = {n: o for n, o, _, _ in cut}
        for n in range(first + 1, first + slices_per_block):
            current = _next_start(known[n], current) if n in known else np.full(len(current), -1)
        last_of_run = np.append(current[1:] != current[:-1], True)
        return pd.DataFrame({"key": group["key"].iloc[0], "blk": blk, "upper": upper[last_of_run], "leaves": current[last_of_run]})

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["blk", "upper"], kind="stable")
        before, last, out = -1, None, []
        for blk, step in group.groupby("blk", sort=True):
            if last is None or blk != last + 1:
                before = -1
            out.append((blk, before))
            at = int(np.searchsorted(step["upper"].to_numpy(), before, side="right"))
            before, last = int(step["leaves"].iloc[at]), blk
        return pd.DataFrame({"key": group["key"].iloc[0], "blk": [b for b, _ in out], "enters": [e for _, e in out]})

    def place(group: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame({"key": [], "id": [], "us": [], "opened": []})
        group = group.sort_values(["us", "id"], kind="stable")
        previous, last = int(entry["enters"].iloc[0]), int(group["blk"].iloc[0]) * slices_per_block - 1
        opened = np.empty(len(group), dtype=np.int64)
        for n, offsets, a, b in _slices(group["us"].to_numpy(), width):
            previous = previous if n == last + 1 else -1
            start = int(_next_start(offsets, previous))
            inside = (offsets >= start) if start >= 0 else np.zeros(len(offsets), dtype=bool)
            opened[a:b] = np.where(inside, n * width + start, (n - 1) * width + previous)
            previous, last = start, n
        return pd.DataFrame({"key": group["key"], "id": group["id"], "us": group["us"], "opened": opened})

    entries = (
        rows.groupBy("key", "blk").applyInPandas(steps, "key string, blk bigint, upper bigint, leaves bigint")
        .groupBy("key").applyInPandas(chain, "key string, blk bigint, enters bigint")
    )
    entries = entries.select(F.col("key").alias("ekey"), F.col("blk").alias("eblk"), "enters")
    placed = rows.groupBy("key", "blk").cogroup(entries.groupBy("ekey", "eblk")).applyInPandas(place, "key string, id bigint, us bigint, opened bigint")
    used = F.row_number().over(Window.partitionBy("key", "opened").orderBy("us", "id"))
    left = F.floor((F.lit(width) - (F.col("us") - F.col("opened"))) / F.lit(1_000_000)).cast("int")
    decided = placed.withColumn("allowed", used <= limit)
    return decided.select(
        "key", "id", (F.col("us") / F.lit(1e6)).alias("at"), "allowed",
        F.when(F.col("allowed"), 0).otherwise(F.greatest(left, F.lit(1))).alias("retry_after"),
    )


def detect_stream(events: DataFrame, key: str, ident: str, time: str, limit: int, seconds: int) -> DataFrame:
    """Streaming form: (window start, used) per key in the state store; a micro-batch is walked in time order."""
    rows = _prepared(events, key, ident, time)

    def step(group, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        data = pd.concat(list(frames), ignore_index=True).sort_values(["us", "id"], kind="stable")
        start, used = state.get if state.exists else (None, 0)
        at = data["us"].to_numpy() / 1e6
        allowed, retry, start, used = _scan(at, limit, float(seconds), start, used)
        state.update((start, used))
        yield pd.DataFrame({"key": group[0], "id": data["id"].to_numpy(), "at": at, "allowed": allowed, "retry_after": retry})

    return rows.groupBy("key").applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.NoTimeout)
