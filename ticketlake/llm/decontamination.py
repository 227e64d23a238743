"""Benchmark decontamination with a distributed positional inverted index.

The training texts are cut into blocks of a few megabytes. Each block keeps, for every test term, the sorted positions of
that term (its postings), and is one row of a stored table. A search visits every block: a phrase starts from the postings
of its rarest term in that block, and what is left is intersected with the postings of the other terms, moved by their
offsets, from rare to frequent. Documents and postings are never shuffled, so a passage that many documents share is
only more matches in their own blocks.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import ALNUM, id_and_text, slices, text_bytes, words, written

#: Test text that travels with one search; a larger benchmark is searched in several rounds over the same index.
ROUND_BYTES = 16 << 20
#: Words in a window.
WINDOW = 10

_INDEX = (
    "doc_ids array<bigint>, first_word array<bigint>, terms array<bigint>, first_posting array<int>, positions array<int>, "
    "found array<struct<doc:int,item_id:bigint,start:int,stop:int>>"
)
_FOUND = pa.list_(pa.struct([("doc", pa.int32()), ("item_id", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())]))


def _hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return words(*text_bytes(pa.array(texts, pa.string())), ALNUM)


class Windows:
    """The distinct windows of a bounded set of test items."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW):
        hashes, starts = _hashed([t for _, t in items])
        self.window = window
        self.terms = np.unique(hashes)
        coded = np.searchsorted(self.terms, hashes)
        owners: dict[tuple, set[int]] = {}
        for (item, _), a, b in zip(items, starts[:-1].tolist(), starts[1:].tolist()):
            for s in range(a, max(b - window, a) + 1 if b > a else a):
                owners.setdefault(tuple(coded[s : min(s + window, b)].tolist()), set()).add(item)
        self.length = np.array([len(w) for w in owners], np.int64)
        self.matrix = np.full((len(owners), window), -1, np.int64)
        for i, w in enumerate(owners):
            self.matrix[i, : len(w)] = w
        self.owners = [sorted(x) for x in owners.values()]


def _bounded_rounds(benchmark: DataFrame, round_bytes: int) -> list[list[tuple[int, str]]]:
    """Items in lists of bounded text size, each fetched by itself. Rows without id or text are left out."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).dropna().distinct()
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    rounds = 1 + 2 * int(size // round_bytes)
    slot = F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds))
    return [[(r.item_id, r.text) for r in items.filter(slot == k).orderBy("item_id", "text").collect()] for k in range(rounds)]


def build_index(docs: DataFrame, terms: np.ndarray | None = None) -> DataFrame:
    """One row for each block of documents: ids, first word of each, and postings of `terms` (None: of all words).

    Words are runs of digits, letters and bytes above 0x7F, A-Z folded. A null text has no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if terms is not None:
            seen = np.zeros(1 << 20, bool)
            seen[(terms & np.uint64(0xFFFFF)).astype(np.int64)] = True
        for batch in slices(batches):
            hashes, starts = words(*text_bytes(batch.column("text")), ALNUM)
            at = np.arange(len(hashes))
            if terms is not None:
                at = np.flatnonzero(seen[(hashes & np.uint64(0xFFFFF)).astype(np.int64)])
                at = at[np.isin(hashes[at], terms)] if len(terms) else at[:0]
            there, code = np.unique(hashes[at], return_inverse=True)
            order = np.argsort(code, kind="stable")
            first = np.searchsorted(code[order], np.arange(len(there) + 1))
            row = {
                "doc_ids": batch.column("doc_id").to_pylist(), "first_word": starts, "terms": there.view(np.int64),
                "first_posting": first.astype(np.int32), "positions": at[order].astype(np.int32),
            }
            cells = [pa.array([v]) if isinstance(v, list) else pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v)) for v in row.values()]
            cells[0] = cells[0].cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*cells, pa.array([[]], _FOUND)], [*row, "found"])

    return id_and_text(docs).mapInArrow(run, _INDEX)


class _Block:
    def __init__(self, row: dict, terms: np.ndarray):
        self.first_word = np.asarray(row["first_word"], np.int64)
        self.positions = np.asarray(row["positions"], np.int64)
        there = np.asarray(row["terms"], np.int64).view(np.uint64)
        first = np.asarray(row["first_posting"], np.int64)
        slot = np.minimum(np.searchsorted(there, terms), max(len(there) - 1, 0))
        hit = there[slot] == terms if len(there) else np.zeros(len(terms), bool)
        self.begin = np.where(hit, first[slot], 0) if len(there) else np.zeros(len(terms), np.int64)
        self.count = np.where(hit, first[slot + 1] - first[slot], 0) if len(there) else np.zeros(len(terms), np.int64)
        #: postings of all terms as one sorted list of (term, position), for intersections
        self.span = int(self.first_word[-1]) + 1
        listed = np.flatnonzero(self.count)
        owner = np.repeat(listed, self.count[listed])
        self.keys = np.sort(owner * self.span + self.positions[_ranges(self.begin[listed], self.count[listed])])

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether `position` is in the postings of `term`."""
        key = term * self.span + position
        at = np.searchsorted(self.keys, key)
        return (position >= 0) & (position < self.span) & (self.keys[np.minimum(at, len(self.keys) - 1)] == key)

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first_word, position, side="right") - 1


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for count[0] numbers, then the same for the next."""
    first = np.cumsum(count) - count
    return np.arange(int(count.sum())) + np.repeat(begin - first, count)


def _rarest_first(block: _Block, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Windows all of whose terms are in the block, and their word offsets from the rarest term on."""
    counts = np.where(w.matrix >= 0, block.count[np.maximum(w.matrix, 0)], np.iinfo(np.int64).max)
    alive = np.flatnonzero(counts.min(axis=1, initial=1) > 0)
    return alive, np.argsort(counts[alive], axis=1, kind="stable")


def _phrases(block: _Block, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window, first word) of every occurrence."""
    if not len(w.owners) or not len(block.positions):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    alive, order = _rarest_first(block, w)
    rarest = w.matrix[alive, order[:, 0]]
    which = np.repeat(np.arange(len(alive)), block.count[rarest])
    start = block.positions[_ranges(block.begin[rarest], block.count[rarest])] - order[which, 0]
    for step in range(1, w.window):
        offset = order[which, step]
        term = w.matrix[alive[which], offset]
        keep = (term < 0) | block.has(np.maximum(term, 0), start + offset)
        which, start = which[keep], start[keep]
    window = alive[which]
    ok = (start >= 0) & (block.document(start) == block.document(start + w.length[window] - 1))
    return window[ok], start[ok]


def _near(block: _Block, w: Windows, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, position of its rarest term) wherever every term of the window lies within `slop` words of it."""
    if not len(w.owners) or not len(block.positions):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    alive, order = _rarest_first(block, w)
    rarest = w.matrix[alive, order[:, 0]]
    which = np.repeat(np.arange(len(alive)), block.count[rarest])
    centre = block.positions[_ranges(block.begin[rarest], block.count[rarest])]
    for step in range(1, w.window):
        term = w.matrix[alive[which], order[which, step]]
        doc = block.document(centre)
        low = np.maximum(centre - slop, block.first_word[doc])
        high = np.minimum(centre + slop, block.first_word[doc + 1] - 1)
        base = np.maximum(term, 0) * block.span
        keep = (term < 0) | (np.searchsorted(block.keys, base + high, side="right") > np.searchsorted(block.keys, base + low))
        which, centre = which[keep], centre[keep]
    return alive[which], centre


def _search(index: DataFrame, w: Windows, slop: int | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                one = batch.slice(r, 1)
                block = _Block({n: one.column(n)[0].values for n in ("first_word", "terms", "first_posting", "positions")}, w.terms)
                window, start = _phrases(block, w) if slop is None else _near(block, w, slop)
                size = w.length[window] if slop is None else np.ones(len(window), np.int64)
                doc = block.document(start)
                runs: dict[tuple[int, int], list[list[int]]] = {}
                for k in np.argsort(start, kind="stable").tolist():
                    a, b = int(start[k] - block.first_word[doc[k]]), int(start[k] + size[k] - block.first_word[doc[k]])
                    for item in w.owners[window[k]]:
                        spans = runs.setdefault((int(doc[k]), item), [])
                        if spans and a <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], b)
                        else:
                            spans.append([a, b])
                found = one.column("found")[0].as_py()
                found += [{"doc": d, "item_id": i, "start": a, "stop": b} for (d, i), spans in runs.items() for a, b in spans]
                yield pa.RecordBatch.from_arrays([*one.columns[:-1], pa.array([found], _FOUND)], one.schema.names)

    return index.mapInArrow(run, _INDEX)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int | None = None, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """`doc_id, n_words, matches` for every row of `docs`; matches: (item_id, start, stop) in words of the text.

    slop None: runs of words covered by windows of `window` consecutive item words (an item of fewer words is one window)
    that occur word by word. Otherwise: the places of a window's rarest term with all its other terms within `slop` words.
    Null texts have no words; items without id, text or words match nothing; repeated items count once; repeated rows and
    null ids of `docs` come back as they are.
    """
    rounds = [Windows(items, window) for items in _bounded_rounds(benchmark, round_bytes)]
    terms = np.unique(np.concatenate([w.terms for w in rounds]))
    found = written(build_index(docs, terms), "postings")
    for w in rounds:
        found = _search(found, w, slop)

    def per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column("doc_ids")[r].as_py()
                n = np.diff(np.asarray(batch.column("first_word")[r].values))
                own: list[list[dict]] = [[] for _ in ids]
                for x in batch.column("found")[r].as_py():
                    own[x["doc"]].append({"item_id": x["item_id"], "start": x["start"], "stop": x["stop"]})
                kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(own, kind)], ["doc_id", "n_words", "matches"])

    slim = found.select("doc_ids", "first_word", "found")
    return slim.mapInArrow(per_document, "doc_id bigint, n_words bigint, matches array<struct<item_id:bigint,start:int,stop:int>>")


def report(found: DataFrame) -> DataFrame:
    """From `matches()`: `doc_id, n_words, n_hit, n_items, items, contaminated` for every row."""
    spans = F.array_sort(F.transform("matches", lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("stop"))))
    hit = F.aggregate(
        spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda s, x: F.struct((s["n"] + F.greatest(x["stop"] - F.greatest(x["start"], s["to"]), F.lit(0))).alias("n"), F.greatest(s["to"], x["stop"]).alias("to")),
        lambda s: s["n"].cast("long"),
    )
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"].cast("string"))))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items")).withColumn("contaminated", F.col("n_hit") > 0)
