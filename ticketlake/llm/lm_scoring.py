"""LM scoring by cross-entropy difference of two matched n-gram models.

Both models are n-gram models over one vocabulary with the same smoothing; one is trained on the
target documents, the other on all documents. A token's loss difference is its loss under the target model less its loss
under the background model, and a document's score is the mean over its tokens: the lower, the more it is like the target.

The models are bigram models over words. Texts are dealt into slices. A slice asks for the counts of each of its bigrams and words
once; what is asked goes to the part of its hash, which adds up all slices and answers each in the order of the
question, so that answers need no keys. What travels is the texts, one hash for each different bigram of a slice, and counts
that are mostly ones; a bigram or word that every document has still arrives once for each slice.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import UNSPACED, id_and_text, scramble, text_bytes, words

#: Weight of the shorter context in a longer one.
BLEND = 8.0
#: Bytes of text in a slice, and of text whose counts one part adds up.
SLICE, PART = 8 << 20, 8 << 20
BIGRAM, WORD = range(2)
_ASKED = "slice int, part int, kind int, size int, keys binary, counts binary"
_ANSWERS = "slice int, part int, kind int, size int, counts binary, vocabulary bigint, n_all bigint, t_all bigint"


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed: small ones cost next to nothing."""
    return pa.compress(np.ascontiguousarray(values, np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * size, codec="zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(8, size).T).view(np.uint64).ravel()


@dataclass
class _Slice:
    """The documents of a slice: ids and word counts, and the bigrams and words that occur in them."""

    ids: pa.Array
    lengths: np.ndarray
    keys: list[np.ndarray]  # by kind: different hashes in order of (part, hash); contexts are words, a text's start is one too
    places: list[np.ndarray]  # by kind: place of each token's hash among them
    context: np.ndarray  # place of the word before each token
    starts: list[np.ndarray]  # by kind: first key of each part, one more than parts
    chosen: np.ndarray  # by token

    @staticmethod
    def of(rows: pa.Table, parts: int) -> _Slice:
        flag = np.asarray(rows.column("chosen").combine_chunks()).astype(bool)
        targets = np.asarray(rows.column("doc_id").filter(pa.array(flag)).drop_null())
        docs = rows.filter(pa.array(~flag)).combine_chunks()
        ids = pa.array(docs.column("doc_id").to_pylist(), pa.int64())
        word, first = words(*text_bytes(pa.array(docs.column("text").to_pylist(), pa.large_string())), UNSPACED)
        lengths = np.diff(first)
        target = np.asarray(ids.is_valid()) & np.isin(np.asarray(ids.fill_null(0)), targets)
        before = np.zeros(len(word), np.uint64)
        before[1:] = word[:-1]
        before[first[:-1][lengths > 0]] = 0
        keys, places, starts = [], [], []
        for k in (scramble(before * np.uint64(0x9E3779B97F4A7C15)) + word, np.concatenate([word, before])):
            unique, place = np.unique(scramble(k), return_inverse=True)
            part = (unique % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            keys.append(unique[order])
            places.append(back[place])
            starts.append(np.searchsorted(part[order], np.arange(parts + 1)))
        return _Slice(ids, lengths, keys, [places[0], places[1][: len(word)]], places[1][len(word) :], starts, np.repeat(target, lengths))

    def counts(self, kind: int) -> np.ndarray:
        """By key: occurrences in all and in target texts; of words also those as contexts."""
        size = len(self.keys[kind])
        on = [self.places[BIGRAM]] if kind == BIGRAM else [self.places[WORD], self.context]
        return np.stack([np.bincount(x, w, size) for x in on for w in (None, self.chosen)], axis=1).astype(np.uint64)


def _ask(parts: int):
    def run(rows: pa.Table) -> pa.Table:
        number = rows.column("slice")[0].as_py()
        own = _Slice.of(rows, parts)
        out = []
        for kind in (BIGRAM, WORD):
            counts, at = own.counts(kind), own.starts[kind]
            for part, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                # keys of a part grow, so their distances are packed
                step = np.diff(own.keys[kind][a:b], prepend=np.uint64(0))
                out.append((number, part, kind, b - a, _pack(step), _pack(counts[a:b].T.ravel())))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table({f.split()[0]: pa.array(c, k) for f, c, k in zip(_ASKED.split(", "), zip(*out), kinds)})

    return run


def _answer(rows: pa.Table) -> pa.Table:
    """The counts of all slices for what each of them asked; the words and tokens of the part in every row."""
    counts, total = [None] * rows.num_rows, {}
    size, kinds = (np.asarray(rows.column(c)) for c in ("size", "kind"))
    for kind in (BIGRAM, WORD):
        at = np.flatnonzero(kinds == kind).tolist()
        width = 2 if kind == BIGRAM else 4
        keys, place = np.unique(np.concatenate([np.cumsum(_unpack(rows.column("keys")[i].as_py(), size[i]), dtype=np.uint64) for i in at]), return_inverse=True)
        own = np.concatenate([_unpack(rows.column("counts")[i].as_py(), width * size[i]).reshape(width, -1) for i in at], axis=1)
        sums = np.stack([np.bincount(place, x, len(keys)) for x in own]).astype(np.uint64)
        first = np.concatenate([[0], np.cumsum(size[at])])
        for i, a, b in zip(at, first[:-1].tolist(), first[1:].tolist()):
            counts[i] = _pack(sums[:, place[a:b]].ravel())
        total[kind] = (int((sums[0] > 0).sum()), int(sums[0].sum()), int(sums[1].sum()))
    every = [total[k] for k in kinds.tolist()]
    out = {c: rows.column(c) for c in ("slice", "part", "kind", "size")}
    out["counts"] = pa.array(counts, pa.binary())
    return pa.table({**out, **{c: pa.array([x[i] for x in every], pa.int64()) for i, c in enumerate(("vocabulary", "n_all", "t_all"))}})


def _score(parts: int):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        own = _Slice.of(rows, parts)
        counts = []
        for kind in (BIGRAM, WORD):
            got = answers.filter(pa.array(np.asarray(answers.column("kind")) == kind)).sort_by("part")
            width = 2 if kind == BIGRAM else 4
            each = [_unpack(c, width * n).reshape(width, -1) for c, n in zip(got.column("counts").to_pylist(), got.column("size").to_pylist())]
            counts.append(np.concatenate(each, axis=1).astype(np.float64))
        vocabulary, *totals = (int(np.asarray(got.column(c)).sum()) for c in ("vocabulary", "n_all", "t_all"))
        # each bigram of the slice is scored once, with the word and context of one of its places
        at = np.zeros(len(own.keys[BIGRAM]), np.int64)
        at[own.places[BIGRAM]] = np.arange(len(own.places[BIGRAM]))
        word, context = own.places[WORD][at], own.context[at]
        loss = []
        for model, total in enumerate(totals):
            alone = (counts[WORD][model][word] + 1) / (total + vocabulary)
            loss.append(-np.log((counts[BIGRAM][model] + BLEND * alone) / (counts[WORD][2 + model][context] + BLEND)))
        difference = (loss[1] - loss[0])[own.places[BIGRAM]]
        sums = np.bincount(np.repeat(np.arange(len(own.lengths)), own.lengths), difference, len(own.lengths))
        return pa.table({"doc_id": own.ids, "n_tokens": pa.array(own.lengths, pa.int64()), "loss_difference": pa.array(sums / np.maximum(own.lengths, 1))})

    return run


def word_score(docs: DataFrame, target: DataFrame) -> DataFrame:
    """`doc_id, n_tokens, loss_difference` for every row of `docs`, under bigram models of words.

    Words are runs without ASCII white space, A-Z folded. target: `doc_id` of the target documents; nulls and repeats in it
    do not matter. If it names none, the target model knows the vocabulary only. A null or empty text has 0 tokens and a
    difference of 0. Repeated rows and null ids come back as they are; a repeated target row counts as often as it occurs.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    slices, parts = (max(1, -(-size // x)) for x in (SLICE, PART))
    marked = target.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct()
    rows = id_and_text(docs).withColumn("chosen", F.lit(False)).unionByName(marked.withColumns({"text": F.lit(None).cast("string"), "chosen": F.lit(True)}))
    # rows without an id are dealt out by their text
    home = F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(slices)).cast("int")
    placed = rows.select(home.alias("slice"), "doc_id", "text", "chosen").repartition(slices, "slice")
    asked = placed.groupBy("slice").applyInArrow(_ask(parts), _ASKED)
    answers = asked.repartition(parts, "part").groupBy("part").applyInArrow(_answer, _ANSWERS)
    return placed.groupBy("slice").cogroup(answers.repartition(slices, "slice").groupBy("slice")).applyInArrow(
        _score(parts), "doc_id bigint, n_tokens bigint, loss_difference double"
    )
