"""Importance resampling against a plain version: CRCs, sums, scores and the draw."""
import math
import random
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from ticketlake.llm import importance_resampling as ir
from ticketlake.llm.importance_resampling import Scan, resample, shifted

from .test_text_operators import NASTY, alnum, frame, pairs, words

BENCH = "text string, doc_id long, weight string, buckets string"


def grams(text, low, high):
    w = words(text, alnum)
    return [" ".join(w[i : i + n]) for n in range(low, high + 1) for i in range(len(w) - n + 1)]


def plain(rows, target, low, high, percent, least):
    source = Counter(crc32(g.encode()) % 10_000 for _, t in rows for g in grams(t, low, high))
    aim = Counter(crc32(g.encode()) % 10_000 for t in target for g in grams(t, low, high))
    s_all, t_all = sum(source.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (s_all + 10_000) / ((source[b] + 1) * (t_all + 10_000)))) for b in source}
    out = []
    for i, t in rows:
        features = grams(t, low, high)
        weight = sum(gain[crc32(g.encode()) % 10_000] for g in features)
        score = None
        if i is not None:
            h = int(sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(features), weight, score, None, len(words(t, alnum))])
    drawn = sorted((r for r in out if r[0] is not None and r[5] >= least), key=lambda r: (-r[3], *r[:3]))
    for k, r in enumerate(drawn[: percent * len(drawn) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_shift_cancels_what_stood_before():
    rng = random.Random(1)
    for n in (0, 1, 2, 7, 255, 256, 70_000):
        a, b = rng.randbytes(9), rng.randbytes(n)
        assert shifted(np.array([crc32(a)], np.uint32), np.array([n]))[0] ^ crc32(a + b) == crc32(b)


@pytest.mark.parametrize("low, high", [(1, 1), (1, 3), (2, 4)])
@pytest.mark.parametrize("step", [1 << 20, 7])
def test_features_have_their_own_crc(monkeypatch, low, high, step):
    monkeypatch.setattr(ir, "STEP_BYTES", step)
    for text in ("", "one", "Größe, A-b c  dd\n\nEEE 字 f; a b", "x" * 40 + " y " + "z" * 9, " . "):
        scan = Scan(text.encode(), low, high)
        got = sorted(int(c) for part in scan.crcs() for c in part)
        assert got == sorted(crc32(g.encode()) for g in grams(text, low, high))
        assert (scan.n_words, scan.n_features) == (len(words(text, alnum)), len(got))


@pytest.mark.parametrize("low, high, percent", [(1, 1, 10), (1, 2, 35), (1, 1, 100)])
def test_draw_equals_the_plain_one(spark, low, high, percent):
    rng = random.Random(3)
    vocabulary = ["w%d" % k for k in range(40)] + ["Ab", "é", "don't"]
    rows = NASTY + [(100 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 60])))) for i in range(60)]
    rows += [rows[-1], rows[-1], (50, rows[-2][1]), (51, "w1 " * 30_000)]
    target = ["w1 w2 w3 AB", None, "", "w1 é"]
    docs, bench = frame(spark, rows), spark.createDataFrame([(t, 1, "w", "b") for t in target], BENCH)
    got = resample(docs, bench, low, high, percent=percent, least_words=10)
    assert dict(got.dtypes) == {c: "bigint" for c in ("doc_id", "n_words", "n_features", "weight", "score", "rank")}
    assert pairs(got, "doc_id", "n_features", "weight", "score", "rank") == plain(rows, target, low, high, percent, 10)


def test_empty_tables(spark):
    none = spark.createDataFrame([], BENCH)
    assert resample(frame(spark, []), none).count() == 0
    got = resample(frame(spark, [(1, "a " * 30)]), none, percent=100).first()
    assert (got.n_features, got["rank"]) == (30, 1) and got.weight < 0
