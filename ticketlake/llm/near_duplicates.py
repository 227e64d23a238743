"""MinHash near-duplicates with min-max hashing.

Each permutation is evaluated once per shingle and gives two signature values, the minimum and the maximum, so half the
evaluations serve a signature of the same length; the share of equal values is an unbiased estimate of the similarity.
Bands of the signature propose pairs and the full shingle sets decide.

A bucket is never expanded into its pairs. Equal sets are one node. In a bucket every node meets the smallest one; only
where nodes of a bucket are still in different components, their sets are compared block by block, and only links that
join components leave a block.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import UNSPACED, by_key, components, id_and_text, shingles, slices, text_bytes, words, written

SHINGLE = 5
#: 60 permutations give 120 values: 20 bands of 6 find a pair of similarity 0.85 with probability 0.9999; for a similarity of
#: 0.80, 24 bands of 5 do.
VALUES, ROWS = 120, 6
#: Nodes of a bucket in one block.
BLOCK = 256

_RNG = np.random.Generator(np.random.PCG64(9))
_TURN = _RNG.integers(1, 2**63, VALUES // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RNG.integers(1, 2**63, VALUES // 2, dtype=np.uint64)


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each row, and the first of each row."""
    runs, first = shingles(*words(*text_bytes(batch.column("text")), UNSPACED), SHINGLE)
    parts = [np.unique(runs[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
    return np.concatenate([*parts, np.zeros(0, np.uint64)]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def _signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """min, max, min, max, ... of each row under each permutation; rows must not be empty."""
    out = np.empty((len(first) - 1, VALUES), np.uint32)
    for k, (turn, flip) in enumerate(zip(_TURN, _FLIP)):
        v = (values ^ flip) * turn
        out[:, 2 * k] = np.minimum.reduceat(v, first[:-1]) >> np.uint64(32)
        out[:, 2 * k + 1] = np.maximum.reduceat(v, first[:-1]) >> np.uint64(32)
    return out


def _band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    keys = np.zeros((len(signature), VALUES // rows), np.uint64)
    for r in range(rows):
        keys = (keys ^ signature[:, r::rows].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def signatures(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """`doc_id, n_shingles, set_sum, set_mix, bands` of every row; the two digests name the set; no bands for empty sets.

    `rows` values make a band; it divides `VALUES`.
    """
    count = VALUES // rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, first = _sets(batch)
            n = np.diff(first)
            some = np.flatnonzero(n)
            total, mix = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            keys = np.zeros((0, count), np.int64)
            if len(some):
                starts = np.concatenate([first[some], [len(values)]])
                total[some] = np.add.reduceat(values, starts[:-1])
                mix[some] = np.add.reduceat((values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93), starts[:-1])
                keys = _band_keys(_signatures(values, starts), rows)
            offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, count, 0))]).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(total.view(np.int64)), pa.array(mix.view(np.int64)), bands],
                ["doc_id", "n_shingles", "set_sum", "set_mix", "bands"],
            )

    return id_and_text(docs).mapInArrow(run, "doc_id bigint, n_shingles bigint, set_sum bigint, set_mix bigint, bands array<bigint>")


def _shingle_sets(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, first = _sets(batch)
            sets = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sets], ["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id bigint, shingles array<bigint>").filter(F.size("shingles") > 0)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    own = sets.select("doc_id", "shingles")
    joined = pairs.join(by_key(own.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))), "b")
    joined = joined.join(by_key(own.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))), "a")
    small, large = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    return joined.filter(100 * small >= percent * large).select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def _shared_counts(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sizes of the intersections of all pairs of n sets, given as shingles and the set of each."""
    _, code, count = np.unique(values, return_inverse=True, return_counts=True)
    several = count > 1
    column = (np.cumsum(several) - 1)[code]
    keep = several[code]
    owner, column = owner[keep], column[keep]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((n, n), np.float32)
    step = 8192
    for low in range(0, int(several.sum()), step):
        a, b = np.searchsorted(column, [low, low + step])
        part = np.zeros((n, step), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _left_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join different components within a bucket. members: bucket, node, part, spread (its nodes).

    Each block of a bucket meets each block once, in a group of its own of at most about 2 * BLOCK nodes, and compares
    their full sets. Only links that bring components together leave it, fewer than it has nodes.
    """

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        nodes, part, block = (np.asarray(group.column(c)) for c in ("node", "part", "block"))
        sets_ = [x.values.to_numpy() for x in group.column("shingles")]
        size = np.array([len(x) for x in sets_])
        both = _shared_counts(np.concatenate(sets_), np.repeat(np.arange(len(sets_)), size), len(sets_))
        linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
        linked &= part[:, None] != part[None, :]
        if block.min() != block.max():
            linked &= block[:, None] != block[None, :]
        name, a, b = part.copy(), [], []
        for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(linked, 1)))):
            if name[i] != name[j]:
                name[name == name[j]] = name[i]
                a.append(nodes[i])
                b.append(nodes[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    blocks = F.ceil(F.col("spread") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    spread = members.join(by_key(sets.select(F.col("doc_id").alias("node"), "shingles")), "node").withColumn("block", own)
    meeting = spread.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    meeting = meeting.select("bucket", "node", "part", "shingles", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return meeting.groupBy("bucket", "i", "j").applyInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, percent: int = 85, rows: int = ROWS) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` for every row.

    Words are runs without ASCII white space, A-Z folded; a set holds the distinct runs of five words, or the whole text
    if it has fewer. Documents are linked if 100 * intersection >= percent * union; a component is named by its smallest
    doc_id. `rows` values of the signature make a band, fewer for a lower `percent`. Texts that are null or without words have an empty set and link with nothing. Rows that repeat a doc_id are
    one node with all their links; rows without doc_id link with nothing, have no component and are kept.
    """
    base = written(signatures(docs, rows), "signatures")
    named = base.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    group = F.struct("n_shingles", "set_sum", "set_mix")
    first = named.groupBy(group.alias("g")).agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.count("*").alias("n"))
    equal = named.select(group.alias("g"), "doc_id").join(first.filter("n > 1").select("g", "node"), "g").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))

    buckets = first.select("node", F.posexplode("bands").alias("band", "key")).select(F.struct("band", "key").alias("bucket"), "node")
    centres = buckets.groupBy("bucket").agg(F.min("node").alias("centre"), F.count("*").alias("spread")).filter("spread > 1")
    shared = written(buckets.join(centres, "bucket"), "buckets")
    candidates = shared.select(F.col("node").alias("doc_id")).distinct()
    sets = written(_shingle_sets(id_and_text(docs).join(by_key(candidates), "doc_id", "left_semi")), "sets")

    # a node first meets the smallest of its centres, then those of the others that this did not bring together with it
    star = shared.filter("centre < node")
    nearest = star.groupBy(F.col("node").alias("b")).agg(F.min("centre").alias("a")).select("a", "b")
    links = written(_confirmed(nearest, sets, percent), "links")
    parts = components(links)
    apart = star.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct().join(by_key(nearest), ["a", "b"], "left_anti")
    apart = apart.join(by_key(parts.select(F.col("node").alias("a"), F.col("component").alias("pa"))), "a", "left")
    apart = apart.join(by_key(parts.select(F.col("node").alias("b"), F.col("component").alias("pb"))), "b", "left")
    apart = apart.filter(F.coalesce("pa", "a") != F.coalesce("pb", "b")).select("a", "b")
    links = written(links.unionAll(_confirmed(apart, sets, percent)), "links")
    parts = written(components(links), "parts")
    # what the smallest node of a bucket did not bring together: nodes besides it, in more than one component
    open_ = shared.filter("spread > 2 and node <> centre").join(parts, "node", "left").select("bucket", "node", "spread", F.coalesce("component", "node").alias("part"))
    several = open_.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high").select("bucket")
    links = links.unionAll(_left_links(open_.join(several, "bucket"), sets, percent)).unionAll(equal)
    final = components(links)
    return base.join(by_key(final.withColumnRenamed("node", "doc_id")), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
