"""Token counts: batch encoding inside Arrow functions that return lengths only.

Texts are cut where the tokenizer always starts a new token (before a single blank between two non-blank characters), so
the counts of the parts add up to the count of the whole. Each distinct part of a batch is encoded once.
"""
from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import Remembered, id_and_text, slices

#: White space as `re` sees it includes all that the tokenizer's pattern does, so a cut is never inside a token.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Parts whose counts a worker remembers before it starts over.
REMEMBERED = 300_000


def _counter(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has dealt out the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    def lengths(parts: list[str]) -> list[int]:
        return list(map(len, encode(parts, add_special_tokens=False)))

    known = Remembered(None, REMEMBERED)

    def count(texts: list[str]) -> list[int]:
        # a part after a cut is encoded with its blank, which is left out of the key; the first part has none
        split = [_CUT.split(t) for t in texts]
        head = lengths([parts[0] for parts in split])
        rest = [parts[1:] for parts in split]
        known.fill(set(chain.from_iterable(rest)), lambda new: lengths([" " + p for p in new]))
        return [h + sum(map(known.__getitem__, parts)) for h, parts in zip(head, rest)]

    return count


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit` of every row.

    tokenizer_path: a `.json` of the tokenizers library, present on every worker. Counts are those of the whole text
    without begin, end or added special tokens; special strings inside a text are treated as the library does by default.
    A null text is empty: 0 bytes, 0 tokens. Repeated rows and null ids come back as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer_path)
        for batch in slices(batches):
            n = count([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    sized = id_and_text(docs).withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = sized.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
