"""Phrase mining against counting every run of words."""
import random
import re
from collections import Counter

import pytest

from ticketlake.llm import phrase_mining
from ticketlake.llm.phrase_mining import mine_phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, w1 string, f long, n string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, "p", "w", 1, "n") for k, (lang, t) in enumerate(rows)], SCHEMA)


def plain(rows, least, top, absorbed):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", folded):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    gone = set()
    for (lang, g), a in candidates.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                if 100 * a >= absorbed * f[lang, g[i : i + k]]:
                    gone.add((lang, g[i : i + k]))
    out = {}
    for (lang, g), a in candidates.items():
        if (lang, g) not in gone:
            cuts = [(2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g))]
            score, _, l, r = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), a, l, r, score))
    return sorted((lang, k + 1, p.decode(), a, l, r, n[lang], score) for lang, found in out.items() for k, (_, _, p, a, l, r, score) in enumerate(sorted(found)[:top]))


def corpus(seed, size=120):
    rng = random.Random(seed)
    sentences = ["New York City is", "machine learning", "por favor no", "a b c d", "b c", "ß é ü", "machine learning model zoo"]
    rows = []
    for k in range(size):
        parts = [rng.choice(sentences) if rng.random() < 0.5 else rng.choice("a b c d e machine New x\ty z".split(" ")) for _ in range(rng.randint(0, 30))]
        rows.append((rng.choice(["en", "de", None, "fr"]), "".join(p + rng.choice([" ", "  ", " ", ". ", "\n", "\t", "\x0b,"]) for p in parts)))
    return rows + [("en", None), ("und", "a b c d"), ("en", ""), (None, " . "), rows[0], rows[0], ("es", "only once here")]


@pytest.mark.parametrize("least, top, absorbed, ahead", [(5, 4, 80, 1), (3, 25, 80, 1), (3, 2000, 50, 3), (30, 7, 100, 1), (2, 12, 80, 1)])
def test_equal_to_counting_everything(spark, least, top, absorbed, ahead):
    rows = corpus(least)
    got = mine_phrases(frame(spark, rows), least, top, absorbed, ahead)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, least, top, absorbed)


def test_full_bitmaps_change_nothing(spark, monkeypatch):
    bitmap = phrase_mining.bitmap
    monkeypatch.setattr(phrase_mining, "bitmap", lambda keys, columns: bitmap(keys, columns, 64))
    rows = corpus(8, 60)
    assert sorted(tuple(r) for r in mine_phrases(frame(spark, rows), 3, 5, 80, 1).collect()) == plain(rows, 3, 5, 80)


def test_products_pass_64_bits(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(phrase_mining.ratio(F.lit(9 * 10**15), F.lit(12 * 10**15 + 7)).alias("x")).first()
    assert row.x == 2_000_000 * 9 * 10**15 // (12 * 10**15 + 7)


def test_long_text(spark):
    rows = [("en", "a b c " * 50_000)]
    assert sorted(tuple(r) for r in mine_phrases(frame(spark, rows), 30, 10).collect()) == plain(rows, 30, 10, 80)


def test_empty_tables(spark):
    assert mine_phrases(frame(spark, [])).count() == 0
    assert mine_phrases(frame(spark, [("en", "a b")])).count() == 0
