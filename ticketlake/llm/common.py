"""Helpers that several operators share: inputs, Arrow slices, word hashing and connected components."""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.session import checkpoint_dir, cut_lineage

#: Text bytes that one step inside a task works on; Arrow batches are cut down to it.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only what the operators read, so further columns, whatever their names, cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about `limit` bytes of `column`; a longer single value is a piece of its own."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        piece = (np.cumsum(sizes.astype(np.int64)) - sizes) // limit
        starts = np.concatenate([[0], np.flatnonzero(np.diff(piece)) + 1, [len(piece)]])
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the start of each row in them (one more than rows); null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]] if len(offsets) else whole[:0], offsets - (offsets[0] if len(offsets) else 0)


_MIX = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.random.Generator(np.random.PCG64(21)).integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


#: Bytes of words of letters and digits (with upper case folded), and of words between white space.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
UNSPACED = np.ones(256, bool)
UNSPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32


def word_spans(data: np.ndarray, rows: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of the runs of bytes for which `inside` holds; none crosses rows."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mask = inside[data]
    edge = np.empty(len(data) + 1, bool)
    edge[1:-1] = mask[1:] != mask[:-1]
    edge[0], edge[-1] = mask[0], mask[-1]
    inner = rows[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(data))])
    touching = inner[mask[inner] & mask[inner - 1]]  # a word ends and another begins where two rows meet
    at = np.flatnonzero(edge)
    if len(touching):
        at = np.sort(np.concatenate([at, touching, touching]))
    return at[0::2], at[1::2]


def span_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:stop], A-Z folded; no span may be empty."""
    out = np.zeros(len(start), np.uint64)
    total = np.cumsum(stop - start)
    at = 0
    while at < len(start):  # about a megabyte at a time, so that the work arrays stay small
        end = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 20))), at + 1)
        length = stop[at:end] - start[at:end]
        first = np.cumsum(length) - length
        place = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(first, length)
        value = _MIX[FOLD[data[place + np.repeat(start[at:end], length)]]] * _PLACE[place & 4095]
        value ^= value >> np.uint64(29)
        if length.max() > 4096:
            value *= (place >> 12).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        out[at:end] = scramble(np.add.reduceat(value, first) + length.astype(np.uint64))
        at = end
    return out


def words(data: np.ndarray, rows: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words in all rows, A-Z folded, and the first word of each row (one more than rows).

    `inside` says which bytes belong to words. Words never cross rows.
    """
    start, stop = word_spans(data, rows, inside)
    return span_hashes(data, start, stop), np.searchsorted(start, rows, side="left")


def shingles(hashes: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word runs of each row in order and the first run of each row; a shorter row, but not an empty one, is one run."""
    count = np.diff(starts)
    runs = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(runs)])
    row = np.repeat(np.arange(len(count)), runs)
    at = starts[:-1][row] + np.arange(first[-1]) - first[:-1][row]
    out = np.zeros(first[-1], np.uint64)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    end = starts[1:][row]
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + np.where(at + k < end, padded[at + k], np.uint64(k + 1))
        out ^= out >> np.uint64(32)
    return scramble(out), first


class Remembered(dict):
    """A bounded memo: what was used since the last turn-over stays, the rest is computed again when it is met."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        found = self.older.get(key)
        self[key] = found = self.compute(key) if found is None else found
        return found

    def fill(self, keys, compute_all) -> None:
        """Make sure that all `keys` are there, computing the missing ones in one call."""
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        new = []
        for key in keys:
            if key not in self:
                if (found := self.older.get(key)) is None:
                    new.append(key)
                else:
                    self[key] = found
        if new:
            self.update(zip(new, compute_all(new)))


def saved(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder, so that it is computed once and survives lost executors."""
    return cut_lineage(df)


def written(df: DataFrame, name: str) -> DataFrame:
    """Written as a table in the shared checkpoint folder and read back."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_key(df: DataFrame) -> DataFrame:
    """`df` as a join side that is always shuffled by key and sorted, so that a join runs alike at every size."""
    return df.hint("merge")


#: Edges that one task of `components` takes, and tasks that it has besides.
EDGES, TASKS = 1 << 16, 8


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node, component`: the smallest node reachable over undirected `edges`, for every node that has an edge.

    Alternates two steps until nothing changes: every node links its larger neighbours to the smallest node around it,
    then every node links its smaller neighbours to the smallest of them. Each step is a grouping with a partial minimum
    and a join, so no neighbourhood is ever gathered into one row. A round has no more edges than the one before, so the
    first ones say how many tasks (`EDGES` each, and `TASKS` more) the steps are dealt to: a dozen exchanges a round would
    otherwise leave a file for every partition of the session, however few the edges.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    pairs = saved(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    tasks = pairs.count() // EDGES + TASKS
    pairs = pairs.coalesce(tasks)
    before = None
    while True:
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(tasks)
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks).distinct().coalesce(tasks)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        pairs = saved(small.filter("u <> v").coalesce(tasks).distinct().coalesce(tasks))
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component")).coalesce(tasks)
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def sha256_of(numbers: Column) -> Column:
    return F.sha2(F.concat_ws(",", numbers.cast("array<string>")), 256)
