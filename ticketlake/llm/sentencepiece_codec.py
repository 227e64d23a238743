"""SentencePiece encoding and decoding.

The vocabulary's pieces form an Aho-Corasick automaton. One pass over a text follows the output links at each position
and relaxes the best score of a segmentation that ends there; walking back gives the pieces. The pass runs once for each
distinct part of the texts in a task, because no piece crosses the borders at which parts are cut.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.llm.common import Remembered, slices

BLANK = "▁"
#: Segmented parts that a worker remembers before it starts over.
REMEMBERED = 200_000


class Pieces:
    """The pieces, scores and byte pieces of a model file, and the automaton over them."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of: list[bytes] = []
        self.byte_piece = [-1] * 256
        self.unknown = model.unk_id()
        self.scores: dict[str, tuple[int, float]] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_piece[int(piece[1:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.scores.setdefault(piece, (i, model.get_score(i)))
                self.bytes_of.append(piece.replace(BLANK, " ").encode())
        if min(self.byte_piece) < 0:
            raise ValueError("the model has no byte pieces, so unknown characters could not be restored")
        self.automaton = ahocorasick.Automaton()
        for piece, (i, score) in self.scores.items():
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.alphabet = set("".join(self.scores))
        self.alone = {c for c in self.alphabet if c in self.scores}
        self.unknown_score = min(s for _, s in self.scores.values()) - 10.0
        # blanks are written as the mark; a mark in the text itself is spelt in bytes
        inside = "".join(map(re.escape, sorted(self.alphabet - {BLANK})))
        crossing = any(BLANK in p.lstrip(BLANK) for p in self.scores)
        body = f"[ {inside}]+" if crossing else f" *[{inside}]+| +"
        self.parts = re.compile(f"{body}|[^ {inside}]+")

    def spelt(self, text: str) -> list[int]:
        return [self.byte_piece[b] for b in text.encode()]

    def segment(self, part: str) -> tuple[int, ...]:
        """Piece ids of the best segmentation; among equal scores the longest last piece wins."""
        if part[0] != " " and part[0] not in self.alphabet or part[0] == BLANK:
            return tuple(self.spelt(part))
        part = part.replace(" ", BLANK)
        n = len(part)
        best, back = [0.0] + [float("-inf")] * n, [(0, -1)] * (n + 1)
        done = 0  # ends below this also have their unknown step, which a piece from there may need
        plain = self.alone.issuperset(part)
        for end, (length, score, piece) in self.automaton.iter(part):
            if not plain:
                done = self._unknown_steps(part, best, back, done, end)
            s = best[end + 1 - length] + score
            if s > best[end + 1]:
                best[end + 1], back[end + 1] = s, (length, piece)
        if not plain:
            self._unknown_steps(part, best, back, done, n)
        out, at = [], n
        while at:
            length, piece = back[at]
            if piece < 0:
                out.extend(reversed(self.spelt(part[at - 1])))
                length = 1
            else:
                out.append(piece)
            at -= length
        return tuple(reversed(out))

    def _unknown_steps(self, part, best, back, done, upto):
        for k in range(done, upto):
            if part[k] not in self.alone and best[k] + self.unknown_score > best[k + 1]:
                best[k + 1], back[k + 1] = best[k] + self.unknown_score, (1, -1)
        return max(done, upto)


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """`docs` with the piece ids of `text` in a new column `ids` (array of int).

    A blank is put in front of a text that is not empty, as the library does; apart from that the text is coded as it is,
    without normalisation, so that decoding restores it exactly. A null text gives null, an empty one no ids. Every other
    column and row stays as it is; a column already named `ids` is replaced.
    """
    base = docs.drop(ids)
    schema = T.StructType([*base.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model_path)
        known, cut = Remembered(pieces.segment, REMEMBERED), pieces.parts.findall
        for batch in slices(batches, text):
            values, sizes, empty = [], [], []
            for t in batch.column(text).to_pylist():
                coded = list(chain.from_iterable(map(known.__getitem__, cut(" " + t)))) if t else []
                values.append(np.array(coded, np.int32))
                sizes.append(len(coded))
                empty.append(t is None)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), mask=np.array([*empty, False]))
            column = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(values)))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, ids])

    return base.mapInArrow(run, schema)


def decode(coded: DataFrame, model_path: str, ids: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """`coded` with the text that `ids` stand for in a new column `text`; null ids give null.

    Ids of control pieces stand for nothing; an id outside the vocabulary raises IndexError.
    """
    base = coded.drop(text)
    schema = T.StructType([*base.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = Pieces(model_path).bytes_of.__getitem__
        for batch in batches:
            out = []
            for row in range(0, batch.num_rows, 256):
                for x in batch.column(ids).slice(row, 256):
                    if not x.is_valid:
                        out.append(None)
                        continue
                    numbers = x.values.to_numpy().tolist()
                    whole = b"".join(map(spelling, numbers)).decode("utf-8", "replace")
                    out.append(whole[1:] if whole[:1] == " " else whole)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, text])

    return base.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """`docs` with `piece_ids`, `decoded` and whether decoding gave the text back (`exact`, true for a null text)."""
    both = decode(encode(docs, model_path), model_path)
    return both.withColumn("exact", F.col("text").eqNullSafe(F.col("decoded")))
