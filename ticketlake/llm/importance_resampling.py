"""Target-distribution importance resampling over hashed word n-grams, with CRCs cut out of running CRCs.

A text is scanned once: its words are joined by single spaces and the running CRC-32 is kept at the end of every word.
The CRC of any n-gram follows from two of them. Over GF(2), appending m bytes multiplies a CRC by x^(8m), so the n-gram
from a to b has the CRC run[b] ^ shift(run[a], b - a): shifting cancels all that stood before it. A shift by m bytes is
one 32 x 32 bit matrix for each binary digit of m, applied to whole arrays through byte tables.

The feature counts of each document are written once. Their sums over all documents and over the target texts make one
gain for each bucket (their number is a parameter, so the table of gains is bounded); a document's weight is the sum of the
gains of its features. Gumbel noise from a hash of the id turns the weights into a draw without replacement, and the ranks
of the draw come from range partitions, so no task orders all documents.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlake.llm.common import ALNUM, FOLD, saved, slices, written

#: Buckets of features, percent of the long enough documents to draw, words that make one, and the seed of the noise.
BUCKETS, PERCENT, LEAST_WORDS, SEED = 10_000, 10, 20, 2024
#: Bytes of one text that are worked on at a time.
STEP_BYTES = 1 << 20

_SPACED = bytes(int(FOLD[b]) if ALNUM[b] else 0x20 for b in range(256))
_FIELDS = "n_words bigint, n_features bigint, buckets array<int>, times array<int>"


def _byte_step() -> np.ndarray:
    """What one zero byte makes of each value of a CRC register's low byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ np.where(t & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return t


_STEP = _byte_step()


def _times(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A bit matrix, as four byte tables, times each of `x`."""
    return tables[0][x & 255] ^ tables[1][(x >> 8) & 255] ^ tables[2][(x >> 16) & 255] ^ tables[3][x >> 24]


@cache
def _shift_tables(digit: int) -> np.ndarray:
    """Byte tables of the matrix that shifts a CRC by 2**digit zero bytes; each is the square of the one before."""
    low = np.arange(256, dtype=np.uint32)
    units = np.stack([low << np.uint32(8 * k) for k in range(4)])
    if digit == 0:
        return _STEP[units & 255] ^ (units >> np.uint32(8))
    half = _shift_tables(digit - 1)
    return _times(half, _times(half, units))


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs moved past `length` further bytes: what is left of them in the running CRC there."""
    out = crc.astype(np.uint32)
    for digit in range(int(length.max(initial=0)).bit_length()):
        on = np.flatnonzero((length >> digit) & 1)
        out[on] = _times(_shift_tables(digit), out[on])
    return out


class Scan:
    """The words of one text in pieces of about `STEP_BYTES`, with running CRCs that go on over the pieces."""

    def __init__(self, text: bytes, low: int, high: int):
        self.text, self.low, self.high = text.translate(_SPACED), low, high
        self.n_words = self.n_features = 0

    def pieces(self) -> Iterator[list[bytes]]:
        at = 0
        while at < len(self.text):
            end = len(self.text)
            if end - at > STEP_BYTES:
                cut = self.text.rfind(b" ", at + 1, at + STEP_BYTES)
                cut = self.text.find(b" ", at + STEP_BYTES) if cut < 0 else cut  # a word longer than a piece stays whole
                end = cut if cut >= 0 else end
            if found := self.text[at:end].split():
                yield found
            at = end

    def crcs(self) -> Iterator[np.ndarray]:
        """CRCs of all features, n-gram sizes one after the other in each piece."""
        crc, place = 0, 0
        # running CRC and place before each of the last words, which longer features of the next piece begin with
        early, early_at = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for found in self.pieces():
            ends, head = [], crc
            for word in found:
                crc = crc32(word, crc)
                ends.append(crc)
                crc = crc32(b" ", crc)
            end = np.array(ends, np.uint32)
            size = np.fromiter(map(len, found), np.int64, len(found))
            end_at = place + np.cumsum(size + 1) - 1
            # one more byte, the space, turns the CRC at the end of a word into the one before the next
            inner = ~end[:-1]
            start = np.concatenate([[head], ~(_STEP[(inner ^ np.uint32(0x20)) & 255] ^ (inner >> np.uint32(8)))]).astype(np.uint32)
            start_at = end_at - size
            all_start, all_at = np.concatenate([early, start]), np.concatenate([early_at, start_at])
            for n in range(self.low, self.high + 1):
                # the feature that ends at word j begins n - 1 words before it
                first = np.arange(len(found)) + len(early) - (n - 1)
                ok = first >= 0
                first = first[ok]
                feature = end[ok] ^ shifted(all_start[first], end_at[ok] - all_at[first])
                self.n_features += len(feature)
                yield feature
            self.n_words += len(found)
            place = int(end_at[-1]) + 1
            keep = max(len(all_start) - (self.high - 1), 0)
            early, early_at = all_start[keep:], all_at[keep:]


def _counted(codes: list[np.ndarray], total: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and how often each occurs; `total` holds counts of earlier codes, by code."""
    codes = np.concatenate([np.zeros(0, np.int64), *codes])
    if total is None:
        return np.unique(codes, return_counts=True)
    total = total + np.bincount(codes, minlength=len(total))
    there = np.flatnonzero(total)
    return there, total[there]


def features(docs: DataFrame, low: int = 1, high: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """`docs` without `text`, and `n_words, n_features, buckets, times`: how often which bucket occurs in each text.

    Features are all runs of `low` to `high` consecutive words, joined by one space; words are runs of digits, letters and
    bytes above 0x7F, A-Z folded. A bucket is the feature's CRC-32 modulo `buckets`. A null text has no words.
    """
    others = [f for f in docs.schema if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, found, times, sizes = [], [], [], []
            for text in batch.column("text"):
                scan = Scan((text.as_py() or "").encode(), low, high)
                codes: list[np.ndarray] = []
                total = None
                for crc in scan.crcs():
                    codes.append((crc % np.uint32(buckets)).astype(np.int64))
                    if len(codes) == 64:  # a long text is added up as it goes
                        more = np.bincount(np.concatenate(codes), minlength=buckets)
                        total, codes = more if total is None else total + more, []
                code, count = _counted(codes, total)
                counts.append((scan.n_words, scan.n_features))
                found.append(code.astype(np.int32))
                times.append(count.astype(np.int32))
                sizes.append(len(code))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            n = np.array(counts, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in others), pa.array(n[:, 0]), pa.array(n[:, 1]),
                 pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found))), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times)))],
                [*(f.name for f in others), "n_words", "n_features", "buckets", "times"],
            )

    kind = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others) + _FIELDS
    return docs.mapInArrow(run, kind)


def bucket_totals(counted: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all rows of `features()`.

    A task adds up its own rows, so at most `buckets` numbers leave it and as many reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            codes, times = batch.column("buckets").flatten(), batch.column("times").flatten()
            total += np.bincount(np.asarray(codes), np.asarray(times), buckets).astype(np.int64)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], ["bucket", "n"])

    sums = counted.select("buckets", "times").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares of target and source) for each bucket."""
    buckets, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    out = [
        math.floor(1000 * math.log((t + 1.0) * (all_source + buckets) / ((s + 1.0) * (all_target + buckets))))
        for s, t in zip(source.tolist(), target.tolist())
    ]
    return np.array(out, np.int64)


def weighed(counted: DataFrame, gain: np.ndarray) -> DataFrame:
    """Rows of `features()` with `weight` in place of the buckets."""
    others = [f for f in counted.schema if f.name not in ("buckets", "times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, times = batch.column("buckets"), batch.column("times")
            part = gain[np.asarray(codes.flatten())] * np.asarray(times.flatten())
            ends = np.concatenate([[0], np.cumsum(part)])
            sizes = np.asarray(pc.list_value_length(codes))
            at = np.concatenate([[0], np.cumsum(sizes)])
            weight = ends[at[1:]] - ends[at[:-1]]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in others), pa.array(weight.astype(np.int64))], [*(f.name for f in others), "weight"])

    kind = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others) + "weight bigint"
    return counted.mapInArrow(run, kind)


def noisy_score(seed: int):
    """`weight` plus Gumbel noise in thousandths, drawn by the id; null without one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.col("weight") + F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(scored: DataFrame, percent: int) -> DataFrame:
    """`rank` among rows that are `open`, for the best floor(percent * N / 100) of these N; null for all others."""
    order = [F.col("open").desc(), F.col("score").desc_nulls_last(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    placed = saved(scored.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"), F.count_if("open").alias("open_n"))  # one row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    drawn = F.floor(F.sum("open_n").over(everything) * F.lit(percent).cast("decimal(10, 0)") / 100).cast("bigint")
    offset = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), drawn.alias("drawn"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("offset")
    joined = placed.join(F.broadcast(offset), "part").withColumn("place", place)  # as many rows as partitions
    return joined.withColumn("rank", F.when(F.col("open") & (F.col("place") <= F.col("drawn")), F.col("place"))).drop("part", "offset", "drawn", "place", "open")


def resample(
    docs: DataFrame, target: DataFrame, low: int = 1, high: int = 1, buckets: int = BUCKETS,
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """`doc_id, n_words, n_features, weight, score, rank` for every row of `docs`; target: a table with `text`.

    The draw has floor(percent * N / 100) of the N rows with a doc_id and at least `least_words` words: those with the highest
    scores, ties to the smaller doc_id; `rank` counts them from 1. All rows, drawn or not, count for the buckets. Null and
    empty texts have no features and weight 0. Rows without doc_id have no score and no rank. Repeated rows each count and come
    back; with equal scores they take neighbouring ranks. No target text, or no document, leaves the gains to the smoothing.
    Other columns of both tables are not read.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = written(features(plain, low, high, buckets), "features")
    aim = features(target.select(F.col("text").cast("string").alias("text")), low, high, buckets)
    weights = weighed(counted, gains(bucket_totals(counted, buckets), bucket_totals(aim, buckets)))
    is_open = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    return ranked(weights.withColumn("score", noisy_score(seed)).withColumn("open", is_open), percent)
