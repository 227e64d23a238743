"""Phrase collocation mining by best-first branch and bound.

A phrase grows word by word from its prefix, and a prefix q bounds all that grows from it: no extension is more frequent
than q, so at the cut after the first word w its score is at most f(q) to f(w) + f(q). Read from the other end, the same
holds for suffixes and the last word. Phrases are wanted by score, then frequency, so a prefix whose bound, with its own
frequency, comes after the last wanted phrase is never expanded.

Words and word pairs are counted first. The best pairs of each language give a level (score, frequency) that enough phrases
may reach; all prefixes and suffixes whose bounds reach it make the frontier, and one scan counts triples there, another
quadruples. Then every phrase at or above the level is known with all its parts, and so are the longer phrases that may
absorb it. Languages with too few survivors go on with a lower level, down to none: the result is exact, ties included.

A scan sends counts of keys that it has added up per slice, never texts. What it has to know about the frontier travels as
bitmaps of a fixed size: a chance hit in one counts a phrase too many, which later joins with exact tables leave out, so the
frontier may be larger than any memory. Words are 64-bit hashes of language and text, and their texts come back in the end.
"""
from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlake.llm.common import FOLD, by_key, scramble, slices, span_hashes, text_bytes, word_spans, written

#: Occurrences that make a candidate, phrases for each language, and the share (percent) of a phrase that absorbs it.
LEAST, TOP, ABSORBED = 30, 2000, 80
#: Bits of each bitmap, a power of two: 4 MB.
BITS = 1 << 25
#: The first level is the score of this many times TOP pairs; each further one takes four times as many.
AHEAD = 3

_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_INSIDE = ~_BREAKS
_INSIDE[[0x20, 0x09]] = False
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _key(*ids: np.ndarray) -> np.ndarray:
    """One 64-bit number for each run of word ids."""
    out = ids[0]
    for x in ids[1:]:
        out = scramble(out * _ODD + x)
    return out


def _language_hash(name: str) -> int:
    return int.from_bytes(blake2b(name.encode(), digest_size=8).digest(), "little")


class _Slice:
    """The words of some texts: ids, places, and whether each has the next one in its piece."""

    def __init__(self, batch: pa.RecordBatch):
        self.data, rows = text_bytes(batch.column("text"))
        self.start, self.stop = word_spans(self.data, rows, _INSIDE)
        self.languages = batch.column("lang").dictionary_encode()
        self.row = np.searchsorted(rows, self.start, side="right") - 1
        seeds = np.array([_language_hash(x) for x in self.languages.dictionary.to_pylist()], np.uint64)
        self.language = np.asarray(self.languages.indices)[self.row]
        self.ids = span_hashes(self.data, self.start, self.stop)
        if len(self.ids):
            self.ids = scramble(self.ids ^ seeds[self.language])
        broken = np.cumsum(_BREAKS[self.data], dtype=np.int64)[self.start] if len(self.start) else self.start
        self.next = (np.diff(broken) == 0) & (np.diff(self.row) == 0)

    def runs(self, n: int) -> np.ndarray:
        """First words of all runs of n words inside pieces."""
        if len(self.ids) < n:
            return np.zeros(0, np.int64)
        ok = np.ones(len(self.ids) - n + 1, bool)
        for k in range(n - 1):
            ok &= self.next[k : k + len(ok)]
        return np.flatnonzero(ok)

    def texts(self, which: np.ndarray) -> pa.Array:
        """The words themselves, A-Z folded."""
        size = self.stop[which] - self.start[which]
        ends = np.cumsum(size)
        at = np.arange(int(size.sum())) + np.repeat(self.start[which] - ends + size, size)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return pa.StringArray.from_buffers(len(which), pa.py_buffer(offsets.tobytes()), pa.py_buffer(FOLD[self.data[at]].tobytes()))


def _texts(docs: DataFrame, languages: list[str] | None = None) -> DataFrame:
    plain = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return plain if languages is None else plain.filter(F.col("lang").isin(languages))


def word_counts(docs: DataFrame) -> DataFrame:
    """`id, lang, word, f` for every word of every language; the row without word has the number of all its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            s = _Slice(batch)
            ids, first, n = np.unique(s.ids, return_index=True, return_counts=True)
            names = s.languages.dictionary
            total = np.bincount(s.language, minlength=len(names)) if len(s.ids) else np.zeros(len(names), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids.view(np.int64), np.zeros(len(names), np.int64)])), pa.concat_arrays([names.take(pa.array(s.language[first])), names]),
                 pa.concat_arrays([s.texts(first), pa.nulls(len(names), pa.string())]), pa.array(np.concatenate([n, total]))],
                ["id", "lang", "word", "f"],
            )

    return _texts(docs).mapInArrow(run, "id bigint, lang string, word string, f bigint").groupBy("id", "lang", "word").agg(F.sum("f").alias("f"))


def bitmap(keys: DataFrame, columns: list[str], bits: int = BITS) -> np.ndarray:
    """A bit set for each row's key, as 64-bit words. Tasks join their bits, so at most bits / 64 words reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits >> 6, np.uint64)
        for batch in batches:
            k = _key(*(np.asarray(batch.column(c)).view(np.uint64) for c in columns)) & np.uint64(bits - 1)
            np.bitwise_or.at(own, (k >> np.uint64(6)).astype(np.int64), np.uint64(1) << (k & np.uint64(63)))
        there = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(own[there].view(np.int64))], ["at", "mask"])

    parts = keys.select(*columns).mapInArrow(run, "at bigint, mask bigint").groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[np.asarray(parts.column("at").combine_chunks())] = np.asarray(parts.column("mask").combine_chunks()).view(np.uint64)
    return out


def _in(marked: np.ndarray, key: np.ndarray) -> np.ndarray:
    k = key & np.uint64(64 * len(marked) - 1)
    return (marked[(k >> np.uint64(6)).astype(np.int64)] >> (k & np.uint64(63))) & np.uint64(1) > 0


def _run_counts(docs: DataFrame, n: int, wanted, least: int, languages: list[str] | None = None) -> DataFrame:
    """`w1 .. wn, f`: runs of n words that `wanted` (a function of their ids) lets through, with `least` occurrences."""
    names = [f"w{k + 1}" for k in range(n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            s = _Slice(batch)
            at = s.runs(n)
            ids = [s.ids[at + k] for k in range(n)]
            ok = np.flatnonzero(wanted(*ids))
            ids = [x[ok] for x in ids]
            _, first, f = np.unique(_key(*ids), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[first].view(np.int64)) for x in ids), pa.array(f)], [*names, "f"])

    kind = ", ".join(f"{x} bigint" for x in (*names, "f"))
    return _texts(docs, languages).mapInArrow(run, kind).groupBy(*names).agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def ratio(a: Column, whole: Column) -> Column:
    """floor(2000000 a / whole), exactly."""
    top = F.lit(2_000_000).cast("decimal(10, 0)") * a.cast("decimal(20, 0)")
    return F.call_function("div", top, whole.cast("decimal(20, 0)"))


def _scored(grams: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """Adds `l, r, score` of the lowest-scoring cut; with equal scores the one with the shortest first part."""
    each = [F.struct(ratio(F.col("f"), F.col(x) + F.col(y)).alias("score"), F.lit(k).alias("k"), F.col(x).alias("l"), F.col(y).alias("r")) for k, (x, y) in enumerate(cuts)]
    best = F.least(*each) if len(each) > 1 else each[0]
    return grams.withColumn("_cut", best).select("*", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), F.col("_cut.score").alias("score")).drop("_cut")


def pair_table(docs: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """`w1, w2, f, lang, f1, f2, l, r, score` of all pairs with `least` occurrences."""
    frequent = bitmap(words.withColumnRenamed("id", "w1"), ["w1"])
    pairs = _run_counts(docs, 2, lambda a, b: _in(frequent, a) & _in(frequent, b), least)
    one = words.select(F.col("id").alias("w1"), "lang", F.col("f").alias("f1"))
    two = words.select(F.col("id").alias("w2"), F.col("f").alias("f2"))
    return _scored(pairs.join(by_key(one), "w1").join(by_key(two), "w2"), [("f1", "f2")])


def _reaches(value: Column) -> Column:
    """Whether (value, f) comes no later than the level of the row's language."""
    return (value > F.col("level")) | ((value == F.col("level")) & (F.col("f") >= F.col("level_f")))


def _at(grams: DataFrame, levels: dict[str, tuple[int, int]]) -> DataFrame:
    """Rows of the languages in `levels`, with `level, level_f`; there are as many levels as languages."""
    level = F.create_map(*[F.lit(x) for name, pair in levels.items() for x in (name, f"{pair[0]} {pair[1]}")])[F.col("lang")]
    parts = F.split(level, " ")
    return grams.filter(F.col("lang").isin(list(levels))).withColumn("level", parts[0].cast("long")).withColumn("level_f", parts[1].cast("long"))


def _triples(docs: DataFrame, pairs: DataFrame, levels: dict, least: int) -> DataFrame:
    """Triples of the frontier, with the counts of all their parts."""
    here = _at(pairs, levels)
    there = bitmap(here, ["w1", "w2"])
    grows = bitmap(here.filter(_reaches(ratio(F.col("f"), F.col("f") + F.col("f1")))), ["w1", "w2"])
    ends = bitmap(here.filter(_reaches(ratio(F.col("f"), F.col("f") + F.col("f2")))), ["w1", "w2"])

    def wanted(a, b, c):
        left, right = _key(a, b), _key(b, c)
        return (_in(grows, left) & _in(there, right)) | (_in(there, left) & _in(ends, right))

    counted = _run_counts(docs, 3, wanted, least, list(levels))
    left = pairs.select("w1", "w2", "lang", F.col("f1"), F.col("f").alias("f12"))
    right = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f23"), F.col("f2").alias("f3"))
    joined = counted.join(by_key(left), ["w1", "w2"]).join(by_key(right), ["w2", "w3"])
    return _scored(joined, [("f1", "f23"), ("f12", "f3")])


def _quadruples(docs: DataFrame, pairs: DataFrame, triples: DataFrame, levels: dict, least: int) -> DataFrame:
    """Quadruples of the frontier; the counts of parts outside it are null, and such a quadruple reaches no level."""
    names = ["w1", "w2", "w3"]
    here = _at(triples, levels)
    there = bitmap(_at(pairs, levels), ["w1", "w2"])
    grows = bitmap(here.filter(_reaches(ratio(F.col("f"), F.col("f") + F.col("f1")))), names)
    ends = bitmap(here.filter(_reaches(ratio(F.col("f"), F.col("f") + F.col("f3")))), names)
    good = bitmap(here.filter(_reaches(F.col("score"))), names)

    def wanted(a, b, c, d):
        left, right = _key(a, b, c), _key(b, c, d)
        return (_in(grows, left) & _in(ends, right)) | (_in(good, left) & _in(there, _key(c, d))) | (_in(there, _key(a, b)) & _in(good, right))

    counted = _run_counts(docs, 4, wanted, least, list(levels))
    left = triples.select(*names, F.col("lang"), "f1", "f12", F.col("f").alias("f123"))
    right = triples.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("w3").alias("w4"), F.col("f").alias("f234"), F.col("f23").alias("f34"), F.col("f3").alias("f4"))
    joined = counted.join(by_key(left), names, "left").join(by_key(right), ["w2", "w3", "w4"], "left")
    return _scored(joined, [("f1", "f234"), ("f12", "f34"), ("f123", "f4")])


def _survivors(grams: DataFrame, longer: DataFrame | None, names: list[str], levels: dict, absorbed: int) -> DataFrame:
    """Candidates at or above the level that no phrase of one more word absorbs.

    Whatever absorbs a phrase with two more words has a part with one more that does, as that is no less frequent.
    """
    rows = _at(grams, levels).filter(_reaches(F.col("score")))
    if longer is not None:
        more = [f"w{k + 2}" for k in range(len(names))]
        around = longer.select(*names, "f").unionAll(longer.select(*(F.col(x).alias(y) for x, y in zip(more, names)), "f"))
        rows = rows.join(by_key(around.groupBy(*names).agg(F.max("f").alias("longer"))), names, "left")
        share = F.col("longer").cast("decimal(20, 0)") * 100 >= F.col("f").cast("decimal(20, 0)") * absorbed
        rows = rows.filter(~F.coalesce(share, F.lit(False)))
    ids = [F.col(f"w{k + 1}") if k < len(names) else F.lit(None).cast("long").alias(f"w{k + 1}") for k in range(4)]
    return rows.select("lang", *ids, F.col("f").alias("a"), "l", "r", "score")


def _levels(pairs: DataFrame, rank: int, languages: list[str]) -> dict[str, tuple[int, int]]:
    """Score and frequency of each language's pair of that rank; (0, 0), which all reach, where there are fewer pairs."""
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("f").desc())
    found = pairs.filter(F.col("lang").isin(languages)).select("lang", "score", "f", F.row_number().over(order).alias("k")).filter(F.col("k") <= rank)
    last = {r.lang: (r.score, r.f) for r in found.filter(F.col("k") == rank).collect()}
    return {name: last.get(name, (0, 0)) for name in languages}


def mine_phrases(docs: DataFrame, least: int = LEAST, top: int = TOP, absorbed: int = ABSORBED, ahead: int = AHEAD) -> DataFrame:
    """`lang, rank, phrase, a, l, r, n, score`: the best phrases of two to four words of each language.

    Texts have A-Z folded and are split at `[.,;:!?\\x0A-\\x0D]` into pieces and these at blanks and tabs into words; a phrase
    lies inside a piece. Null languages are `und`, null texts empty. `a` counts a phrase, `l` and `r` the two parts of its
    lowest-scoring cut (ties: the shortest first part), `n` all words of the language; the score is
    floor(2000000 a / (l + r)). A phrase with fewer than `least` occurrences is no candidate; one that a longer candidate
    absorbs (with at least `absorbed` percent of its occurrences) is dropped. Order: score, then `a`, both descending, then
    the phrase by bytes. Repeated rows and rows without doc_id count as texts of their own; other columns are not read. A
    table without such phrases gives no rows.
    """
    counts = written(word_counts(docs).filter(F.col("word").isNull() | (F.col("f") >= least)), "words")
    words = counts.filter("word is not null")
    pairs = written(pair_table(docs, words, least), "pairs")
    open_ = [r.lang for r in pairs.select("lang").distinct().collect()]
    done, rank = [], ahead * top
    while open_:
        levels = _levels(pairs, rank, open_)
        triples = written(_triples(docs, pairs, levels, least), "triples")
        quadruples = written(_quadruples(docs, pairs, triples, levels, least), "quadruples")
        found = _survivors(pairs, triples, ["w1", "w2"], levels, absorbed)
        found = found.unionAll(_survivors(triples, quadruples, ["w1", "w2", "w3"], levels, absorbed))
        found = written(found.unionAll(_survivors(quadruples.filter("lang is not null"), None, ["w1", "w2", "w3", "w4"], levels, absorbed)), "survivors")
        size = {r.lang: r["count"] for r in found.groupBy("lang").count().collect()}
        settled = [x for x in open_ if size.get(x, 0) >= top or levels[x] == (0, 0)]
        done.append(found.filter(F.col("lang").isin(settled)))
        open_ = [x for x in open_ if x not in settled]
        rank *= 4
    kind = "lang string, w1 long, w2 long, w3 long, w4 long, a long, l long, r long, score long"
    best = docs.sparkSession.createDataFrame([], kind)
    for part in done:
        best = best.unionAll(part)
    for k in range(4):
        best = best.join(by_key(words.select(F.col("id").alias(f"w{k + 1}"), F.col("word").alias(f"t{k + 1}"))), f"w{k + 1}", "left")
    best = best.withColumn("phrase", F.concat_ws(" ", "t1", "t2", "t3", "t4"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = counts.filter("word is null").select("lang", F.col("f").alias("n"))
    return best.join(by_key(totals), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
