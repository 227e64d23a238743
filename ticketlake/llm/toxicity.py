"""Toxicity: a linear-chain conditional random field tags toxic spans.

Labels are given for documents. Words that occur in toxic documents far beyond chance, or whose stems do, become the labelled toxic tokens;
tokens of toxic documents that no clean document has are left open, all others are clean. The field is fitted on these
partly labelled chains. Forward-backward marginals of each token give the spans and, through a logistic calibration on
documents that the field has not seen, the score of a document.

Fitting uses a bounded sample of labelled documents, in one task, which holds them as codes of their words and works on some of them
at a time; scoring visits every document where it lies.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.llm.common import ALNUM, id_and_text, scramble, shingles, slices, span_hashes, text_bytes, word_spans, words

#: Labelled documents in the sample for fitting, and the size up to which a document may be in it.
SAMPLE, SAMPLE_TEXT = 6_000, 1 << 16
#: Hashed feature weights.
WEIGHTS = 1 << 18
#: Log-likelihood ratio from which a word, or a stem of 4 to 6 bytes, makes labelled toxic tokens.
EVIDENCE = 30.0
#: Clean documents with it, for each toxic one, that such a word may have.
IMPURE = 0.03
STEPS = 25
PREFIXES, SUFFIXES = (4, 5, 6), (4,)
#: Chain positions that are worked off one after the other, in all blocks at once.
BLOCK = 512
#: Text bytes that are tokenized or scored, and tokens of the sample that are fitted on, at a time.
STEP_BYTES, FIT_TOKENS = 1 << 20, 1 << 18


def held_out(doc_id: Column) -> Column:
    """Whether a document is in the fold that no label may be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class _Tokens:
    """Words of a slice: their code among the distinct words, the features of those, and the first word of each row."""

    def __init__(self, data: np.ndarray, rows: np.ndarray):
        self.start, self.stop = word_spans(data, rows, ALNUM)
        self.hashes = span_hashes(data, self.start, self.stop)
        self.first = np.searchsorted(self.start, rows, side="left")
        self.distinct, example, self.code = np.unique(self.hashes, return_index=True, return_inverse=True)
        a, b = self.start[example], self.stop[example]
        columns = [self.distinct]
        for kind, n in [(1, n) for n in PREFIXES] + [(2, n) for n in SUFFIXES]:
            long_ = b - a > n
            part = np.zeros(len(a), np.uint64)
            part[long_] = span_hashes(data, *((a[long_], a[long_] + n) if kind == 1 else (b[long_] - n, b[long_])))
            columns.append(np.where(long_, scramble(part ^ np.uint64(kind * 16 + n)), np.uint64(0)))
        table = np.stack(columns, axis=1) if len(a) else np.zeros((0, len(columns)), np.uint64)
        self.table = table
        #: slot 0 is for features that a word lacks; its weight stays 0
        self.features = np.where(table == 0, 0, 1 + (table % np.uint64(WEIGHTS - 1)).astype(np.int64))
        self.opens = np.zeros(len(self.code), bool)
        self.opens[self.first[:-1][np.diff(self.first) > 0]] = True


class _Chain:
    """Forward-backward over chains that lie end to end; state 1 is toxic.

    A chain's first position does not depend on the position before, so all chains are one. Blocks of it are first
    multiplied out side by side, then entered with what comes before and after them, so long texts cost no more steps.
    """

    def __init__(self, scores: np.ndarray, opens: np.ndarray, moves: np.ndarray, allowed: np.ndarray | None = None):
        n = len(scores)
        blocks = -(-n // BLOCK)
        out = np.ones((blocks * BLOCK, 2))
        out[:n, 1] = np.exp(np.clip(scores, -25, 25))
        if allowed is not None:
            out[:n] *= allowed
        step = np.empty((blocks * BLOCK, 2, 2))
        step[:] = np.exp(np.clip(moves[:4], -15, 15)).reshape(2, 2)
        start = np.ones(blocks * BLOCK, bool)
        start[:n] = opens
        step[start] = np.array([1.0, np.exp(np.clip(moves[4], -15, 15))])
        step *= out[:, None, :]
        step /= step.sum(axis=(1, 2), keepdims=True)
        m = step.reshape(blocks, BLOCK, 2, 2)
        whole = np.broadcast_to(np.eye(2), (blocks, 2, 2)).copy()
        for t in range(BLOCK):
            whole = np.einsum("bij,bjk->bik", whole, m[:, t])
            whole /= whole.sum(axis=(1, 2), keepdims=True)
        before, after = np.empty((blocks, 2)), np.empty((blocks, 2))
        v = np.array([0.5, 0.5])
        for b in range(blocks):
            before[b] = v
            v = v @ whole[b]
            v = v / v.sum()
        v = np.array([0.5, 0.5])
        for b in range(blocks - 1, -1, -1):
            after[b] = v
            v = whole[b] @ v
            v = v / v.sum()
        forward, backward = np.empty((blocks, BLOCK, 2)), np.empty((blocks, BLOCK, 2))
        v = before
        for t in range(BLOCK):
            v = np.einsum("bi,bij->bj", v, m[:, t])
            v = v / v.sum(axis=1, keepdims=True)
            forward[:, t] = v
        v = after
        for t in range(BLOCK - 1, -1, -1):
            backward[:, t] = v
            v = np.einsum("bij,bj->bi", m[:, t], v)
            v = v / v.sum(axis=1, keepdims=True)
        self.step, self.forward, self.backward = step[:n], forward.reshape(-1, 2)[:n], backward.reshape(-1, 2)[:n]

    def toxic(self) -> np.ndarray:
        both = self.forward * self.backward
        return both[:, 1] / both.sum(axis=1)

    def moves(self, opens: np.ndarray) -> np.ndarray:
        """Expected numbers of the four moves and of toxic starts."""
        at = np.flatnonzero(~opens)
        pairs = self.forward[at - 1][:, :, None] * self.step[at] * self.backward[at][:, None, :]
        pairs /= pairs.sum(axis=(1, 2), keepdims=True)
        return np.concatenate([pairs.sum(axis=0).ravel(), [self.toxic()[opens].sum()]])


class _Sample:
    """Documents as codes of their words: 4 bytes a token, whatever the work arrays of tokenizing or fitting take.

    Batches of text and toxic come in order. Copies and near copies would count one document's words many times, so only the
    first document of each pair of smallest shingles is kept.
    """

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        met: set[tuple[int, int]] = set()
        pieces, toxic = [], []
        for batch in slices(batches, limit=STEP_BYTES):
            hashes, first = words(*text_bytes(batch.column("text")), ALNUM)
            runs, first = shingles(hashes, first, 5)
            low = [tuple(int(scramble(runs[a:b] ^ np.uint64(k)).min()) if b > a else 0 for k in (1, 2)) for a, b in zip(first[:-1], first[1:])]
            keep = pa.array([i for i, pair in enumerate(low) if not (pair in met or met.add(pair))], pa.int64())
            tokens = _Tokens(*text_bytes(batch.column("text").take(keep)))
            pieces.append((tokens.distinct, tokens.table, tokens.features, tokens.code.astype(np.int32), np.diff(tokens.first)))
            toxic.append(np.asarray(batch.column("toxic").take(keep)).astype(np.int64))
        self.toxic = np.concatenate([np.zeros(0, np.int64), *toxic])
        if not pieces:
            return
        self.distinct, example = np.unique(np.concatenate([p[0] for p in pieces]), return_index=True)
        self.table, self.features = (np.concatenate([p[k] for p in pieces])[example] for k in (1, 2))
        self.code = np.concatenate([np.searchsorted(self.distinct, p[0]).astype(np.int32)[p[3]] for p in pieces])
        self.size = np.concatenate([p[4] for p in pieces])
        self.first = np.cumsum(self.size) - self.size

    def parts(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """`rows` in groups of about `FIT_TOKENS` tokens: the rows, the code of each token and the first token of each row (one more)."""
        size = self.size[rows]
        piece = (np.cumsum(size) - size) // FIT_TOKENS
        for some in np.split(rows, np.flatnonzero(np.diff(piece)) + 1):
            first = np.concatenate([[0], np.cumsum(self.size[some])])
            at = np.arange(first[-1]) + np.repeat(self.first[some] - first[:-1], self.size[some])
            yield some, self.code[at], first


def _opens(first: np.ndarray) -> np.ndarray:
    opens = np.zeros(first[-1], bool)
    opens[first[:-1][np.diff(first) > 0]] = True
    return opens


def _evidence(sample: _Sample, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct word: whether it or its stem marks toxic documents among `rows`, and how many clean ones have the word."""
    p = min(max(sample.toxic[rows].mean(), 1e-9), 1 - 1e-9)
    marks = np.zeros(len(sample.distinct), bool)
    clean = None
    for column in sample.table.T[: 1 + len(PREFIXES)]:
        value, kind = np.unique(column, return_inverse=True)
        a, b = np.zeros(len(value)), np.zeros(len(value))
        for some, code, first in sample.parts(rows):
            n = len(some)
            pair = np.unique(kind[code] * n + np.repeat(np.arange(n), np.diff(first)))
            feature, bad = pair // n, sample.toxic[some[pair % n]] == 1
            a += np.bincount(feature[bad], minlength=len(value))
            b += np.bincount(feature[~bad], minlength=len(value))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = 2 * (np.where(a > 0, a * np.log(a / (a + b) / p), 0) + np.where(b > 0, b * np.log(b / (a + b) / (1 - p)), 0))
        marks |= ((ratio >= EVIDENCE) & (b <= IMPURE * a) & (value != 0))[kind]
        clean = b[kind] if clean is None else clean
    return marks, clean


def _document_features(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """1, log-odds of the most toxic token, log of the expected number of toxic tokens."""
    out = np.tile([1.0, -12.0, 0.0], (len(first) - 1, 1))
    some = np.flatnonzero(np.diff(first))
    if len(some):
        top = np.clip(np.maximum.reduceat(p, first[:-1][some]), 1e-5, 1 - 1e-5)
        out[some, 1] = np.log(top / (1 - top))
        out[some, 2] = np.log1p(np.add.reduceat(p, first[:-1][some]))
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 0.1 * w
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), slope)
    return w


def _fit(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    """Feature weights, four moves and start, and calibration, end to end."""
    sample = _Sample(batches)
    model = np.zeros(WEIGHTS + 8)
    y = sample.toxic
    if len(y) == 0 or y.min() == y.max():
        model[-3] = 0 if len(y) == 0 else (12.0 if y.min() == 1 else -12.0)
        model[-3] = model[-3] or -12.0
        return model
    # documents for the calibration count as clean ones nowhere: their tokens are left out of the evidence
    unseen = np.arange(len(y)) % 4 == 3
    marks, clean = _evidence(sample, np.flatnonzero(~unseen))
    label = np.where(marks, 1, np.where(clean > 0, 0, -1))
    # the chains to fit on: toxic documents, and two clean ones for each
    bad = np.flatnonzero(~unseen & (y == 1))
    good = np.flatnonzero(~unseen & (y == 0))
    rows = np.sort(np.concatenate([bad, good[:: max(1, len(good) // (2 * len(bad) + 1))]]))
    weights, moves = np.zeros(WEIGHTS), np.array([0.0, -4.0, -1.0, -1.0, -4.0])
    size_w, size_m = np.full(WEIGHTS, 1e-3), np.full(5, 1e-3)
    for step in range(STEPS):
        score = weights[sample.features].sum(axis=1)
        per_word, turn = np.zeros(len(sample.distinct)), np.zeros(5)
        for some, code, first in sample.parts(rows):
            opens = _opens(first)
            own = np.where(np.repeat(y[some], np.diff(first)) == 1, label[code], 0)
            chain = _Chain(score[code], opens, moves, np.stack([own != 1, own != 0], axis=1))
            toxic, counts = chain.toxic(), chain.moves(opens)
            chain = _Chain(score[code], opens, moves)
            per_word += np.bincount(code, toxic - chain.toxic(), minlength=len(sample.distinct))
            turn += counts - chain.moves(opens)
            del chain
        slope = np.zeros(WEIGHTS)
        for f in sample.features.T:
            slope += np.bincount(f, per_word, minlength=WEIGHTS)
        slope -= 0.01 * weights
        slope[0] = 0
        size_w += slope**2
        weights += 1.0 * slope / np.sqrt(size_w)
        turn[0] = 0
        size_m += turn**2
        moves += 0.5 * turn / np.sqrt(size_m)
    model[:WEIGHTS], model[WEIGHTS : WEIGHTS + 5] = weights, moves
    score, fresh = weights[sample.features].sum(axis=1), []
    for some, code, first in sample.parts(np.flatnonzero(unseen)):
        fresh.append(_document_features(_Chain(score[code], _opens(first), moves).toxic() if len(code) else np.zeros(0), first))
    model[-3:] = _logistic(np.concatenate(fresh), y[unseen])
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The model, from at most `sample` labelled documents outside the held-out fold, chosen by a hash of their id.

    Rows of `labels` without doc_id or toxic are left out; of repeated ones the larger label counts. Only documents of up
    to `SAMPLE_TEXT` bytes are used for fitting. Without labels of both kinds the score is constant.
    """
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    chosen = chosen.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most `sample` short rows, so they can go to every task; repeated rows of a document count once
    rows = id_and_text(docs).filter(F.octet_length("text") <= SAMPLE_TEXT).join(F.broadcast(chosen), "doc_id").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([_fit(batches).tobytes()], pa.binary())], ["model"])

    found = rows.repartition(1).sortWithinPartitions("doc_id", "text").mapInArrow(run, "model binary").collect()
    return np.frombuffer(found[0].model, np.float64) if found else _fit(iter([]))


def tag(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """All columns of `docs` with `score, predicted, spans` after them; columns of these names are replaced.

    spans: (start, stop) in characters of runs of likely toxic words. A null or empty text has no words and gets the
    calibrated score of such texts. Repeated rows and null ids come back as they are.
    """
    small = model.astype(np.float32)
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    keep = [c for c in docs.columns if c not in ("score", "predicted", "spans")]
    # the input's columns travel in one struct, so that none of their names can clash
    rows_of = docs.select(F.struct(*keep).alias("row"), F.col("text").cast("string").alias("text"))
    # a text that is a string already is not sent a second time
    place = keep.index("text") if "text" in keep and docs.schema["text"].dataType == T.StringType() else None
    sent = rows_of if place is None else rows_of.select("row")

    def with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            yield batch if place is None else pa.RecordBatch.from_arrays([row, row.field(place)], ["row", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, moves, calibration = small[:WEIGHTS].astype(np.float64), small[WEIGHTS : WEIGHTS + 5].astype(np.float64), small[-3:].astype(np.float64)
        for batch in slices(with_text(batches), limit=STEP_BYTES):
            data, rows = text_bytes(batch.column("text"))
            tokens = _Tokens(data, rows)
            p = np.zeros(0)
            if len(tokens.code):
                p = _Chain(weights[tokens.features].sum(axis=1)[tokens.code], tokens.opens, moves).toxic()
            final = 1 / (1 + np.exp(-np.clip(_document_features(p, tokens.first) @ calibration, -30, 30)))
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            likely = np.flatnonzero(p >= 0.5)
            if len(likely):
                char = np.cumsum((data & 0xC0) != 0x80)  # characters up to and with each byte
                owner = np.searchsorted(tokens.first, likely, side="right") - 1
                new = np.concatenate([[True], (np.diff(likely) != 1) | (np.diff(owner) != 0)])
                begin = np.flatnonzero(new)
                end = np.concatenate([begin[1:] - 1, [len(likely) - 1]])
                for a, b in zip(begin.tolist(), end.tolist()):
                    r = owner[a]
                    zero = char[rows[r]] - 1
                    spans[r].append({"start": int(char[tokens.start[likely[a]]] - 1 - zero), "stop": int(char[tokens.stop[likely[b]] - 1] - zero)})
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(final), pa.array(spans, spans_type)], ["row", "score", "spans"])

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    found = sent.mapInArrow(run, T.StructType([sent.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))]))
    columns = [F.col("row").getField(c).alias(c) for c in keep]
    return found.select(*columns, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def score(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """`doc_id, score, predicted, spans` for every row, as `tag()` gives them."""
    return tag(id_and_text(docs), model).drop("text")
