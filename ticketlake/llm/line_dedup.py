"""Line dedup with a suffix array over line ids.

Texts are sequences of line ids, and their suffixes are ordered by prefix doubling: from the order by the first k lines
and the order k lines further on follows the order by the first 2k lines. After each round a rank that several suffixes
share is an interval of common prefixes of at least k lines; suffixes with a rank of their own are done.

A maximal repeated run is a common prefix with an earlier suffix as far as it goes. It is the union of its shortest long
enough windows: the one that starts at its first line, and those that end at each line further on. So two kinds of windows
are judged, the shortest that starts at a line and the shortest that ends at one; both are inside the run, and repeated
with it, and together they cover it. A window's number of lines says in which round two ranks tell it: of the windows that
agree on all lines, the first stays and the others are later copies.

Each round shuffles only suffixes whose rank is shared. Ranks come from distinct rank pairs, counted with partial
aggregates and ordered by range partitions, so a line that fills a third of the corpus is one row there. The few groups
that hold a noticeable share of the rows meet their suffixes where these lie.
"""
from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.llm.common import by_key, saved, slices

MIN_WORDS = 50
#: Groups with more than one in so many of the rows are broadcast, and there are at most as many of them.
SHARE = 4096


def _windows(total: np.ndarray, min_words: int, min_lines: int) -> tuple[np.ndarray, np.ndarray]:
    """(first line, lines) of the shortest long enough windows from each line on and up to each line, sorted, none twice.

    `total` has the words before each line, and those of all lines last.
    """
    n = len(total) - 1
    line = np.arange(n)
    ahead = np.maximum(np.searchsorted(total, total[:-1] + min_words), line + min_lines)
    back = np.minimum(np.searchsorted(total, total[1:] - min_words, side="right") - 1, line + 1 - min_lines)
    first = np.concatenate([line[ahead <= n], back[back >= 0]])
    last = np.concatenate([ahead[ahead <= n], line[back >= 0] + 1])
    both = np.unique(first * (n + 1) + last)
    return both // (n + 1), both % (n + 1) - both // (n + 1)


def _lines(docs: DataFrame, min_words: int, min_lines: int) -> DataFrame:
    """One row for each line: its 128-bit id, and the lines of the windows that start there and are to be judged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, version = np.asarray(batch.column("doc_id")), np.asarray(batch.column("version"))
            row, pos, digest, needs, sizes = [], [], [], [], []
            for r in range(batch.num_rows):
                lines = batch.column("text")[r].as_py().encode().split(b"\n")
                first, need = _windows(np.cumsum([0, *(len(x.split()) for x in lines)]), min_words, min_lines)
                needs.append(need)
                sizes.append(np.bincount(first, minlength=len(lines)))
                row.append(np.full(len(lines), r))
                pos.append(np.arange(len(lines)))
                digest.extend(blake2b(x, digest_size=16).digest() for x in lines)
            row = np.concatenate(row)
            halves = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row]), pa.array(version[row]), pa.array(np.concatenate(pos).astype(np.int32)), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(needs).astype(np.int32)))],
                ["doc_id", "version", "pos", "first", "second", "needs"],
            )

    return docs.mapInArrow(run, "doc_id bigint, version bigint, pos int, first bigint, second bigint, needs array<int>")


def _with_groups(rows: DataFrame, groups: DataFrame, key: list[str], n: str) -> DataFrame:
    """`rows` joined with `groups` (one row for each key, `n` rows share it), both saved.

    A group with more than a `SHARE`th of all rows is one of at most `SHARE`, so these are broadcast; what does not belong to
    them is shuffled, and no key is hot there.
    """
    large = (groups.agg(F.sum(n)).first()[0] or 0) // SHARE
    hot, cold = groups.filter(F.col(n) > large), groups.filter(F.col(n) <= large)
    there = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(by_key(cold), key)
    return there.unionByName(rest)


def _ranked(suffixes: DataFrame) -> DataFrame:
    """Suffixes with (first, second) in `rank`: how many have a smaller pair. Those alone with their pair are left out."""
    classes = suffixes.groupBy("first", "second").agg(F.count("*").alias("n"))
    spread = saved(classes.repartitionByRange("first", "second").withColumn("part", F.spark_partition_id()))
    sizes = spread.groupBy("part").agg(F.sum("n").alias("size"))  # one row for each partition
    offset = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("offset"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("first", "second")) - F.col("n")
    ranks = spread.withColumn("inside", inside).join(offset, "part").filter("n > 1")
    ranks = ranks.select("first", "second", (F.col("offset") + F.col("inside")).alias("rank"), "n")
    return _with_groups(suffixes, ranks, ["first", "second"], "n").drop("first", "second", "n")


def _later(decided: DataFrame) -> DataFrame:
    """All but the first window of each group of equal ones."""
    key = ["need", "rank", "end_rank"]
    decided = saved(decided.withColumn("place", F.struct("doc_id", "version", "pos")))
    first = decided.groupBy(*key).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    return _with_groups(decided, first, key, "n").filter("place <> first").select("doc_id", "version", "pos", "need")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_lines: int = 1) -> DataFrame:
    """`doc_id, version, pos, need`: windows of `need` lines that are later copies; the maximal runs are their unions.

    docs: doc_id, version, text, none null.
    """
    suffixes = saved(_lines(docs, min_words, min_lines))
    found = docs.sparkSession.createDataFrame([], "doc_id long, version long, pos int, need int")
    k = 1
    while True:
        suffixes = saved(_ranked(suffixes))
        most = suffixes.agg(F.max(F.array_max("needs"))).first()[0]
        if most is None:
            return found
        now = suffixes.select("doc_id", "version", "pos", "rank", F.explode("needs").alias("need")).filter((F.col("need") >= k) & (F.col("need") < 2 * k))
        end = suffixes.select("doc_id", "version", F.col("pos").alias("end"), F.col("rank").alias("end_rank"))
        whole = now.filter(F.col("need") == k).withColumn("end_rank", F.col("rank"))
        longer = now.filter(F.col("need") > k).withColumn("end", F.col("pos") + F.col("need") - k)
        decided = whole.unionByName(longer.join(end, ["doc_id", "version", "end"]).select(whole.columns))
        found = found.unionAll(_later(decided))
        if most < 2 * k:
            return found
        in_text = Window.partitionBy("doc_id", "version").orderBy("pos").rangeBetween(k, k)
        suffixes = suffixes.select("doc_id", "version", "pos", "needs", F.col("rank").alias("first"), F.max("rank").over(in_text).alias("second")).filter("second is not null")
        suffixes = saved(suffixes)
        k *= 2


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, min_lines: int = 1) -> DataFrame:
    """All columns of `docs` with `text` cut, and `n_lines, n_removed, n_runs` after them.

    Lines end at newlines and are equal if all their bytes are. A run is a sequence of at least `min_lines` lines with at
    least `min_words` words (separated by ASCII white space) in all. A line is removed if it lies in a run, however long, that
    also starts earlier: in a smaller doc_id, or earlier in its text; runs are judged on the input. `n_runs` counts the removed
    stretches. A null text stays null with 0 lines. Rows that repeat doc_id and text are one document; different texts
    under one doc_id are separate documents in an arbitrary but fixed order. Rows without doc_id lose nothing, and no row
    loses to them. Columns named like the three new ones are replaced.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed", "n_runs")]
    version = F.xxhash64(F.col("text").cast("string"))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), version.alias("version"), F.col("text").cast("string").alias("text")).dropna()
    runs = repeated_runs(plain, min_words, min_lines)
    cuts = runs.groupBy("doc_id", "version").agg(F.collect_list(F.struct("pos", "need")).alias("cuts"))
    # the input's columns travel in one struct, so that none of their names can clash
    rows = docs.select(F.struct(*keep).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), version.alias("version"))
    joined = rows.join(by_key(cuts), ["doc_id", "version"], "left").select("row", F.col("row.text").cast("string").alias("text"), "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for r in range(batch.num_rows):
                text, cut = batch.column("text")[r].as_py(), batch.column("cuts")[r]
                lines = [] if text is None else text.split("\n")
                n = len(lines)
                if not cut.is_valid:
                    out.append((text, n, 0, 0))
                    continue
                a, need = (np.asarray(cut.values.field(i)) for i in (0, 1))
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, a, 1)
                np.add.at(edge, a + need, -1)
                gone = np.cumsum(edge)[:n] > 0
                stretches = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append(("\n".join(x for x, g in zip(lines, gone.tolist()) if not g), n, int(gone.sum()), stretches))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], ["row", "cut_text", "n_lines", "n_removed", "n_runs"])

    counts = [T.StructField(c, T.LongType()) for c in ("n_lines", "n_removed", "n_runs")]
    kind = T.StructType([rows.schema["row"], T.StructField("cut_text", T.StringType()), *counts])
    done = joined.mapInArrow(run, kind)
    columns = [F.col("cut_text").alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in keep]
    return done.select(*columns, "n_lines", "n_removed", "n_runs")
