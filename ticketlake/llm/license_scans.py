"""License scans: an exact set-similarity join of text blocks with license notices.

A block is a run of as many consecutive words as the notice (the template) has, at every word of a text; a shorter text is
one block. A block fits a template if it holds at least `PERCENT` of the template's distinct words. Texts are read once and
reduced to their template words and where these stand. Those are counted over all documents, and the counts order the
words of every template from the globally rarest on. Then each reduced text is joined with the templates:

* prefix: with n words of which `need` must be there, a block that has none of the n - need + 1 rarest cannot fit, so blocks
  are only looked at around those;
* length: a block with fewer than `need` template words cannot fit;
* position: if the i-th rarest word is the first that both have, at most n - i + 1 are shared, and at most one more than
  the block's words that are more frequent;

and the blocks that are left are counted word by word, so none is missed and none is wrong. Texts and blocks are never
shuffled; only the counts of the template words are, and the templates, whose size is checked, travel with the job.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import ALNUM, id_and_text, slices, text_bytes, words, written

#: Phrases that always give their label.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Notices that license holders are told to put into their works.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
#: Share of a template's distinct words that a block needs.
PERCENT = 90
#: The templates and phrases go to every task, so their text is bounded.
TEMPLATE_BYTES = 16 << 20

_REDUCED = "doc_id bigint, n_words bigint, code array<int>, at array<int>"
_BLOCK = pa.struct([("label", pa.string()), ("template", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("containment", pa.float64())])
_PLACE = pa.struct([("label", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])
_SCANNED = (
    "doc_id bigint, n_words bigint, places array<struct<label:string,start:int,stop:int>>, "
    "blocks array<struct<label:string,template:int,start:int,stop:int,containment:double>>"
)


def _hashes(text: str) -> np.ndarray:
    return words(*text_bytes(pa.array([text], pa.string())), ALNUM)[0]


class Templates:
    """Phrases and templates over one coded vocabulary."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, percent: int = PERCENT):
        if sum(len(t.encode()) for _, t in (*templates, *phrases)) > TEMPLATE_BYTES:
            raise ValueError("templates travel with every task and may not hold more than TEMPLATE_BYTES; scan in several runs")
        found = [(label, _hashes(t)) for label, t in templates]
        said = [(_hashes(t), label) for t, label in phrases]
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for _, h in found), *(h for h, _ in said)]))
        #: number, label, word codes in order, words in a block, words needed; templates without words fit nothing
        self.templates = []
        for k, (label, h) in enumerate(found):
            if len(h):
                code = np.unique(np.searchsorted(self.vocabulary, h))
                self.templates.append((k, label, code, len(h), -(-percent * len(code) // 100)))
        self.phrases = [(np.searchsorted(self.vocabulary, h), label) for h, label in said if len(h)]

    def ordered(self, counts: np.ndarray) -> None:
        """Order the vocabulary, and with it every template, from the rarest word of the corpus on."""
        self.rank = np.empty(len(self.vocabulary), np.int64)
        self.rank[np.lexsort([self.vocabulary, counts])] = np.arange(len(self.vocabulary))
        self.templates = [(k, label, code[np.argsort(self.rank[code])], size, need) for k, label, code, size, need in self.templates]


def reduce_texts(docs: DataFrame, templates: Templates) -> DataFrame:
    """`doc_id, n_words, code, at`: the template words of every whole text and the words before each of them."""
    vocabulary = templates.vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << 20, bool)
        seen[(vocabulary & np.uint64(0xFFFFF)).astype(np.int64)] = True
        for batch in slices(batches):
            hashes, starts = words(*text_bytes(batch.column("text")), ALNUM)
            at = np.flatnonzero(seen[(hashes & np.uint64(0xFFFFF)).astype(np.int64)])
            at = at[np.isin(hashes[at], vocabulary)] if len(at) else at
            code = np.searchsorted(vocabulary, hashes[at])
            first = np.searchsorted(at, starts)
            inside = at - np.repeat(starts[:-1], np.diff(first))
            offsets = pa.array(first.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(starts)), pa.ListArray.from_arrays(offsets, pa.array(code.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(inside.astype(np.int32)))],
                ["doc_id", "n_words", "code", "at"],
            )

    return id_and_text(docs).mapInArrow(run, _REDUCED)


def word_counts(reduced: DataFrame, size: int) -> np.ndarray:
    """Occurrences of each of the `size` template words in all documents; each task adds up its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.asarray(batch.column("code").flatten()), minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["code", "n"])

    out = np.zeros(size, np.int64)
    for r in reduced.select("code").mapInArrow(run, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect():
        out[r.code] = r.n
    return out


def _spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of the ranges first..last (both included), each once and in order."""
    ok = last >= first
    first, last = first[ok], last[ok]
    order = np.argsort(first, kind="stable")
    first, last = first[order], last[order]
    if len(first):
        first = np.maximum(first, np.concatenate([[first[0]], np.maximum.accumulate(last)[:-1] + 1]))
        first, last = first[first <= last], last[first <= last]
    size = last - first + 1
    return np.arange(int(size.sum())) + np.repeat(first - np.cumsum(size) + size, size)


class _Texts:
    """Reduced texts one after the other: code and place of each template word, and the texts' ends."""

    def __init__(self, n_words: np.ndarray, counts: np.ndarray, code: np.ndarray, at: np.ndarray, t: Templates):
        self.begin = np.cumsum(n_words) - n_words
        self.end = np.cumsum(n_words)
        self.code, self.at, self.t = code, at + np.repeat(self.begin, counts), t
        order = np.argsort(code, kind="stable")
        first = np.searchsorted(code[order], np.arange(len(t.vocabulary) + 1))
        self.places = [self.at[order[a:b]] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]

    def text(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.end, place, side="right")

    def phrase(self, code: np.ndarray) -> np.ndarray:
        """First words of all places where the words stand one after the other in one text."""
        start = self.places[code[0]]
        for k in range(1, len(code)):
            start = start[np.isin(start + k, self.places[code[k]], assume_unique=True)]
        return start[self.text(start) == self.text(start + len(code) - 1)]

    def blocks(self, code: np.ndarray, size: int, need: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all blocks with `need` of the template's words (ordered from rare to frequent), and how many they have."""
        left = []
        for i in range(len(code) - need + 1):  # prefix: one of these words must be in the block
            p = self.places[code[i]]
            if not len(p):
                continue
            text = self.text(p)
            begin, last = self.begin[text], np.maximum(self.end[text] - size, self.begin[text])
            start = _spread(np.maximum(p - size + 1, begin), np.minimum(p, last))
            a, b = np.searchsorted(self.at, start), np.searchsorted(self.at, self._stop(start, size))
            start, a, b = (x[b - a >= need] for x in (start, a, b))  # length
            later = np.concatenate([[0], np.cumsum(self.t.rank[self.code] > self.t.rank[code[i]])])
            shared = 1 + np.minimum(len(code) - i - 1, later[b] - later[a])  # position, if this is the first shared word
            left.append(start[shared >= need])
        start = np.unique(np.concatenate([np.zeros(0, np.int64), *left]))
        stop = self._stop(start, size)
        there = np.zeros(len(start), np.int64)
        for c in code:
            there += np.searchsorted(self.places[c], start) < np.searchsorted(self.places[c], stop)
        return start[there >= need], there[there >= need]

    def _stop(self, start: np.ndarray, size: int) -> np.ndarray:
        return np.minimum(start + size, self.end[self.text(start)]) if len(start) else start


def _joined(start: np.ndarray, text: np.ndarray, size: int, share: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
    """(text, start, stop, best share) of overlapping blocks of one template taken together."""
    edge = np.flatnonzero(np.concatenate([[True], (np.diff(start) > size) | (np.diff(text) > 0)])) if len(start) else np.zeros(0, np.int64)
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(start)]):
        yield int(text[a]), int(start[a]), int(start[b - 1]) + size, float(share[a:b].max())


def scan_reduced(reduced: DataFrame, templates: Templates) -> DataFrame:
    """Phrases and fitting blocks of every reduced text. `templates` must be ordered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("code")
            t = _Texts(
                np.asarray(batch.column("n_words")), np.asarray(pc.list_value_length(codes)), np.asarray(codes.flatten()).astype(np.int64),
                np.asarray(batch.column("at").flatten()).astype(np.int64), templates,
            )
            places: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            blocks: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for code, label in templates.phrases:
                start = t.phrase(code)
                text = t.text(start)
                for r, s in zip(text.tolist(), (start - t.begin[text]).tolist()):
                    places[r].append({"label": label, "start": s, "stop": s + len(code)})
            for k, label, code, size, need in templates.templates:
                start, there = t.blocks(code, size, need)
                for r, a, b, share in _joined(start, t.text(start), size, there / len(code)):
                    a, b = a - int(t.begin[r]), min(b, int(t.end[r])) - int(t.begin[r])
                    blocks[r].append({"label": label, "template": k, "start": a, "stop": b, "containment": share})
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(places, pa.list_(_PLACE)), pa.array(blocks, pa.list_(_BLOCK))],
                ["doc_id", "n_words", "places", "blocks"],
            )

    return reduced.mapInArrow(run, _SCANNED)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, percent: int = PERCENT) -> DataFrame:
    """`doc_id, n_words, places, blocks` for every row of `docs`, in words of the text, counted from 0.

    `places`: label, start and stop of every place where a phrase's words stand consecutively. `blocks`: label, number of the
    template, start, stop and best containment of every stretch of overlapping blocks that fit one template. Words are runs
    of digits, letters and bytes above 0x7F, A-Z folded. Null and empty texts have neither; repeated rows and rows without
    doc_id come back as they are; a template or phrase without words fits nothing. Other columns are not read.
    """
    coded = Templates(templates, phrases, percent)
    reduced = written(reduce_texts(docs, coded), "template-words")
    coded.ordered(word_counts(reduced, len(coded.vocabulary)))
    return scan_reduced(reduced, coded)


def report(scanned: DataFrame) -> DataFrame:
    """From `scan_licenses()`: `doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`.

    `base_labels` are those of the phrases, `labels` also those of the blocks. The score is 1 where a phrase stands, else the
    best containment of a fitting block, else 0.
    """
    starts = F.transform("places", lambda p: p["start"].cast("long"))
    base = F.transform("places", lambda p: p["label"])
    more = F.transform("blocks", lambda b: b["label"])
    best = F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0))

    def joined(labels):
        return F.concat_ws(",", F.array_sort(F.array_distinct(labels)))

    return scanned.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, more)).alias("labels"), F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
