"""Suffix-array dedup: bytes covered by a 100-byte string that also starts earlier are removed.

1. Every 100-byte window is led by the smallest 20-byte digest in it. Equal windows have equal leaders at equal offsets,
   so runs of windows with one leader (segments) can be compared leader by leader, wherever they come from.
2. Of equal segments only the first is of interest; the windows of all others are repeats. Equal segments are told by
   digests: first inside a task's slice, where most copies of a hot passage end, then across slices.
3. Different segments under one leader may still share windows. Their text goes to shards by leader, and each shard sorts
   its suffixes: types are classified, leftmost-smaller substrings are sorted by induction and named, equal names are
   refined, and one more induction orders all suffixes. Permuted common prefixes of at least 100 bytes then show which
   windows are equal.

A leader with more distinct segments than a shard should hold is compared by window digests instead (grouped with partial
aggregates), so no shard grows with one passage.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlake.llm.common import by_key, id_and_text, scramble, slices, text_bytes, written

LENGTH = 100
LEADER = 20
#: Text in one shard, and segments of one leader that a shard takes.
SHARD_BYTES = 1 << 20
SHARD_SEGMENTS = 4000
#: Bytes of one text that are led at a time.
PIECE = 4 << 20

_RNG = np.random.Generator(np.random.PCG64(10))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, base, np.uint64))])


class _Digests:
    """Digests of any [a, b) of `data`, equal for equal contents."""

    _inverse = np.uint64(pow(int(_BASE), -1, 2**64))

    def __init__(self, data: np.ndarray):
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(_BASE, len(data))[:-1])])
        self.back = _powers(self._inverse, len(data))

    def of(self, a, b) -> np.ndarray:
        return (self.prefix[b] - self.prefix[a]) * self.back[a]


def segments(data: np.ndarray, rows: np.ndarray, length: int = LENGTH, k: int = LEADER):
    """(leader, digest, row, start in row, windows) of every segment of the rows that lie end to end in `data`."""
    none = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    if len(data) < length:
        return none
    digests = _Digests(data)
    at = np.arange(len(data) - k + 1)
    grams = scramble(digests.of(at, at + k))
    marked = (grams & ~np.uint64(0xFFFFFF)) | at.astype(np.uint64)
    w = length - k + 1
    padded = np.full(-(-len(marked) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(marked)] = marked
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(data) - length + 1
    lead = np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))[:n]
    valid = np.arange(n) + length <= rows[1:][row]
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = (lead[1:] != lead[:-1]) | (row[1:] != row[:-1]) | (valid[1:] != valid[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.concatenate([begin, [n]]))
    keep = valid[begin]
    begin, count = begin[keep], count[keep]
    digest = scramble(digests.of(begin, begin + count + length - 1) + count.astype(np.uint64))
    return lead[begin] >> np.uint64(24), digest, row[begin], begin - rows[row[begin]], count


def _pieces(batch: pa.RecordBatch, length: int):
    """Bytes and rows of a slice, with the row number and start of each piece; a very long text comes in several."""
    data, rows = text_bytes(batch.column("text"))
    if len(data) <= PIECE:
        yield data, rows, np.arange(len(rows) - 1), np.zeros(len(rows) - 1, np.int64)
        return
    for r, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
        for s in range(a, max(b - length + 1, a + 1), PIECE):
            part = data[s : min(s + PIECE + length - 1, b)]
            yield part, np.array([0, len(part)]), np.array([r]), np.array([s - a])


def _listed(docs: DataFrame, length: int) -> DataFrame:
    """All segments. What a slice has already seen is a repeat and gets a negative number as leader, each its own.

    `at` is the version of a doc_id (for ids that occur with several texts) and the start in the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, version = np.asarray(batch.column("doc_id")), np.asarray(batch.column("version")).astype(np.int64)
            for data, rows, number, moved in _pieces(batch, length):
                lead, digest, row, start, count = segments(data, rows, length)
                doc, at = ids[number[row]], (version[number[row]] << 32) + start + moved[row]
                order = np.lexsort((at, doc, digest, lead))
                lead, digest, doc, at, count = (x[order] for x in (lead.view(np.int64), digest.view(np.int64), doc, at, count))
                again, twice = np.zeros(len(lead), bool), np.zeros(len(lead), bool)
                again[1:] = (lead[1:] == lead[:-1]) & (digest[1:] == digest[:-1])
                twice[1:] = again[1:] & (doc[1:] == doc[:-1]) & (at[1:] == at[:-1])  # a repeated row is the same document
                again, lead, digest, doc, at, count = (x[~twice] for x in (again, lead, digest, doc, at, count))
                spread = scramble(scramble(doc.view(np.uint64)) ^ at.view(np.uint64)) | np.uint64(1 << 63)
                lead = np.where(again, spread.view(np.int64), lead)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (lead, digest, doc, at, count)], ["leader", "digest", "doc_id", "at", "windows"])

    return docs.mapInArrow(run, "leader bigint, digest bigint, doc_id bigint, at bigint, windows bigint")


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of `text` (small whole numbers) in order."""
    t = np.concatenate([text.astype(np.int64) + 1, [0]]).astype(np.uint16)
    n, k = len(t), int(t.max()) + 1
    change = np.flatnonzero(t[1:] != t[:-1])
    run = np.searchsorted(change, np.arange(n))  # the run of equal values that a position is in
    rising = np.concatenate([t[change] < t[change + 1], [True]])
    smaller = rising[run]  # the suffix is smaller than the next
    smaller[-1] = True
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) == 1:
        return _induced(t, smaller, lms, k)[1:]
    order = _induced(t, smaller, lms, k)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ranked = order[is_lms[order]]
    stop = np.zeros(n, np.int64)
    stop[lms] = np.concatenate([lms[1:], [n - 1]])
    size = stop[ranked] - ranked
    same = np.concatenate([[False], size[1:] == size[:-1]])
    live = np.flatnonzero(same)
    step = 0
    while len(live):
        differ = t[np.minimum(ranked[live] + step, n - 1)] != t[np.minimum(ranked[live - 1] + step, n - 1)]
        same[live[differ]] = False
        live = live[~differ]
        live = live[size[live] > step]
        step += 1
    name = np.zeros(n, np.int64)
    name[ranked] = np.cumsum(~same) - 1
    reduced = name[lms]
    return _induced(t, smaller, lms[_refined(reduced)], k)[1:]


def _refined(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the reduced text: equal names are told apart by what follows, twice as far each time."""
    rank, step = names, 1
    while True:
        follow = np.zeros(len(rank), np.int64)
        follow[:-step] = rank[step:] + 1
        key = rank * (len(rank) + 2) + follow
        order = np.argsort(key, kind="stable")
        rank = np.empty(len(rank), np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
        if rank.max() + 1 == len(rank):
            return order
        step *= 2


def _induced(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """All suffixes from the given order of the leftmost-smaller ones; a bucket of one first value at a time."""
    n = len(t)
    size = np.bincount(t, minlength=k)
    end = np.cumsum(size)
    begin = end - size
    sa = np.full(n, -1, np.int64)
    head, values = begin.copy(), t[lms]
    by_value = lms[np.argsort(values, kind="stable")]
    bound = np.concatenate([[0], np.cumsum(np.bincount(values, minlength=k))])

    def place(found: np.ndarray, ends: np.ndarray, sign: int) -> None:
        value = t[found]
        order = np.argsort(value, kind="stable")
        count = np.bincount(value, minlength=k)
        rank = np.arange(len(found)) - np.repeat(np.cumsum(count) - count, count)
        sa[np.repeat(ends, count) + sign * rank - (sign < 0)] = found[order]
        ends += sign * count

    for c in range(k):
        done = begin[c]
        while done < head[c]:
            now = sa[done : head[c]]
            done = head[c]
            before = now[now > 0] - 1
            place(before[~smaller[before]], head, 1)
        seeds = by_value[bound[c] : bound[c + 1]]
        before = seeds[seeds > 0] - 1
        place(before[~smaller[before]], head, 1)
    tail = end.copy()
    for c in range(k - 1, -1, -1):
        done = end[c]
        while done > tail[c]:
            now = sa[tail[c] : done][::-1]
            done = tail[c]
            before = now[now > 0] - 1
            place(before[smaller[before]], tail, -1)
        now = sa[begin[c] : head[c]][::-1]
        before = now[now > 0] - 1
        place(before[smaller[before]], tail, -1)
    sa[0] = n - 1
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, the length shared with the suffix before it in order, up to the next 0.

    Only where the characters before the two suffixes differ are they compared; from there on the length falls by one
    with each position.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    fresh = (before <= 0) | (at == 0) | (text[at - 1] != text[np.maximum(before, 1) - 1]) | (text[at - 1] == 0)
    live = np.flatnonzero(fresh & (before >= 0))
    length = np.zeros(n, np.int64)
    step = 0
    while len(live):
        a, b = live + step, before[live] + step
        inside = (a < n) & (b < n)
        live, a, b = live[inside], a[inside], b[inside]
        live = live[(text[a] == text[b]) & (text[a] != 0)]
        length[live] += 1
        step += 1
    source = np.maximum.accumulate(np.where(fresh, at, 0))
    return np.maximum(length[source] - (at - source), 0)


def repeated_windows(parts: list[np.ndarray], order: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(part, start) of each window of `length` that also starts in an earlier part, or earlier in its own; order ranks parts."""
    sizes = np.array([len(p) + 1 for p in parts], np.int64)
    text = np.zeros(int(sizes.sum()), np.int64)
    first = np.cumsum(sizes) - sizes
    part = np.repeat(np.arange(len(parts)), sizes)
    inside = np.ones(len(text), bool)
    inside[first + sizes - 1] = False
    text[inside] = np.concatenate(parts).astype(np.int64) + 1
    sa = suffix_array(text)
    shared = common_prefixes(text, sa)[sa] >= length
    start = np.flatnonzero(~shared)
    count = np.diff(np.concatenate([start, [len(sa)]]))
    place = sa - first[part[sa]]
    key = order[part[sa]] * (int(sizes.max()) + 1) + place
    earliest = np.repeat(np.minimum.reduceat(key, start), count)
    again = (key != earliest) & np.repeat(count > 1, count)
    return part[sa[again]], place[again]


def _shard(length: int):
    def run(group: pa.Table) -> pa.Table:
        doc, at = np.asarray(group.column("doc_id")), np.asarray(group.column("at"))
        place = np.lexsort((at, doc))
        # repeated rows bring their segments once more
        place = place[np.concatenate([[True], (np.diff(doc[place]) != 0) | (np.diff(at[place]) != 0)])]
        doc, at, order = doc[place], at[place], np.arange(len(place))
        parts = [np.frombuffer(x, np.uint8) for x in group.column("piece").take(pa.array(place)).to_pylist()]
        part, start = repeated_windows(parts, order, length)
        where = np.lexsort((start, part))
        part, start = part[where], start[where]
        new = np.ones(len(part), bool)
        new[1:] = (part[1:] != part[:-1]) | (start[1:] != start[:-1] + 1)
        begin = np.flatnonzero(new)
        count = np.diff(np.concatenate([begin, [len(part)]]))
        return pa.table({"doc_id": doc[part[begin]], "at": at[part[begin]] + start[begin], "windows": count})

    return run


def _window_digests(pieces: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                data = np.frombuffer(batch.column("piece")[r].as_buffer(), np.uint8)
                a = np.arange(len(data) - length + 1)
                digest = _Digests(data).of(a, a + length)
                doc, at = batch.column("doc_id")[r].as_py(), batch.column("at")[r].as_py()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("leader").slice(r, 1).take(pa.array(np.zeros(len(a), np.int64))), pa.array(digest.view(np.int64)), pa.array(np.full(len(a), doc)), pa.array(at + a)],
                    ["leader", "digest", "doc_id", "at"],
                )

    listed = pieces.mapInArrow(run, "leader bigint, digest bigint, doc_id bigint, at bigint")
    first = listed.groupBy("leader", "digest").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = listed.join(first, ["leader", "digest"]).filter(F.struct("doc_id", "at") != F.col("first"))
    return again.select("doc_id", "at", F.lit(1).cast("bigint").alias("windows"))


def _cut_out(joined: DataFrame, length: int) -> DataFrame:
    """The texts of wanted segments: leader, shard, doc_id, at, piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                raw = batch.column("text")[r].as_py().encode()
                wanted = batch.column("wanted")[r].as_py()
                starts = [x["at"] & 0xFFFFFFFF for x in wanted]
                pieces = [raw[s : s + x["windows"] + length - 1] for s, x in zip(starts, wanted)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x["leader"] for x in wanted], pa.int64()), pa.array([x["shard"] for x in wanted], pa.int64()),
                        pa.array([batch.column("doc_id")[r].as_py()] * len(wanted), pa.int64()), pa.array([x["at"] for x in wanted], pa.int64()), pa.array(pieces, pa.binary()),
                    ],
                    ["leader", "shard", "doc_id", "at", "piece"],
                )

    return joined.mapInArrow(run, "leader bigint, shard bigint, doc_id bigint, at bigint, piece binary")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`doc_id, at, windows`: runs of windows that also start earlier. docs: doc_id (not null), version, text."""
    by_leader = Window.partitionBy("leader")
    kinds = by_leader.orderBy("digest", "doc_id", "at")
    known = _listed(docs, length).withColumn("n", F.count("*").over(by_leader)).filter("n > 1 or leader < 0")
    known = known.withColumn("low", F.min("digest").over(by_leader)).withColumn("high", F.max("digest").over(by_leader))
    known = known.withColumn("before", F.lag("digest").over(kinds)).withColumn("place", F.lag(F.struct("digest", "doc_id", "at")).over(kinds))
    known = known.filter(F.coalesce(F.col("place") != F.struct("digest", "doc_id", "at"), F.lit(True)))  # repeated rows again
    known = known.withColumn("again", (F.col("leader") < 0) | F.coalesce(F.col("before") == F.col("digest"), F.lit(False)))
    known = known.withColumn("differing", F.sum(F.when(F.col("again"), 0).otherwise(1)).over(by_leader))
    known = written(known.filter("again or low <> high").select("leader", "doc_id", "at", "windows", "again", "differing"), "repeats")
    wanted = known.filter("not again")
    total = wanted.agg(F.sum(F.col("windows") + length)).first()[0] or 0
    shards = 1 + int(total // SHARD_BYTES)
    shard = F.when(F.col("differing") > SHARD_SEGMENTS, F.lit(-1)).otherwise(F.pmod(F.xxhash64("leader"), F.lit(shards))).cast("bigint")
    per_doc = wanted.withColumn("version", F.shiftright("at", 32)).groupBy("doc_id", "version").agg(F.collect_list(F.struct("leader", shard.alias("shard"), "at", "windows")).alias("wanted"))
    pieces = written(_cut_out(docs.join(by_key(per_doc), ["doc_id", "version"]).select("doc_id", "text", "wanted"), length), "pieces")
    kind = "doc_id bigint, at bigint, windows bigint"
    sorted_ = pieces.filter("shard >= 0").groupBy("shard").applyInArrow(_shard(length), kind)
    hot = _window_digests(pieces.filter("shard < 0"), length)
    return known.filter("again").select("doc_id", "at", "windows").unionAll(sorted_).unionAll(hot)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept` (binary) for every row.

    Each byte of a text's UTF-8 form that lies in a `length`-byte string which also starts earlier (in a smaller doc_id, or
    earlier in the same text) is removed; overlaps count and all strings are judged on the input. A null text is empty.
    Rows that repeat doc_id and text are one document. Different texts under one doc_id are separate documents in an
    arbitrary but fixed order. Rows without doc_id have no place in the order: they lose nothing and no row loses to them.
    """
    base = id_and_text(docs).withColumn("version", F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFF)))
    spans = repeated_spans(base.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length)), length)
    start = F.col("at").bitwiseAND(F.lit(0xFFFFFFFF))
    cuts = spans.select("doc_id", F.shiftright("at", 32).alias("version"), F.struct(start.alias("a"), (start + F.col("windows") + length - 1).alias("b")).alias("cut"))
    cuts = cuts.groupBy("doc_id", "version").agg(F.collect_list("cut").alias("cuts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for r in range(batch.num_rows):
                raw = (batch.column("text")[r].as_py() or "").encode()
                cut = batch.column("cuts")[r]
                n, kept, to = 0, [], 0
                if cut.is_valid:
                    a, b = (np.asarray(cut.values.field(i)) for i in (0, 1))
                    order = np.argsort(a, kind="stable")
                    a, b = a[order], np.maximum.accumulate(b[order])
                    new = np.flatnonzero(np.concatenate([[True], a[1:] > b[:-1]]))
                    for x, y in zip(a[new].tolist(), b[np.concatenate([new[1:] - 1, [len(b) - 1]])].tolist()):
                        kept.append(raw[to:x])
                        n, to = n + 1, y
                kept.append(raw[to:])
                whole = b"".join(kept)
                out.append((len(raw), len(raw) - len(whole), n, whole))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = base.join(by_key(cuts), ["doc_id", "version"], "left").select("doc_id", "text", "cuts")
    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
