"""Operators on documents against brute force, with nulls, empty and long texts, ties, repeats and clashing columns."""
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ticketlake.llm import decontamination, line_dedup, lm_scoring, near_duplicates, suffix_array, toxicity
from ticketlake.llm.queries import tokenizer_file
from ticketlake.llm.sentencepiece_codec import Pieces, decode, encode, round_trip
from ticketlake.llm.token_counts import count_tokens

SCHEMA = "doc_id long, text string, n_words long, matches string, row string, key string, version string, score string"
NASTY = [
    (1, ""), (2, None), (None, "a null id"), (3, " two  blanks \n\n and\ttabs "), (4, "x" * 5000), (5, "Größe ▁mark <|endoftext|> 字 \x00 \U0001f600"),
    (6, "same text"), (7, "same text"), (6, "same text"), (8, "\n"), (9, "it's  a'd 　 \x1c z"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "m", "r", "k", "v", "s") for i, t in rows], SCHEMA)


def pairs(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_codec_restores_every_text(spark):
    out = round_trip(frame(spark, NASTY).withColumn("piece_ids", F.lit("x")), tokenizer_file("piece_bpe_32k.model")).collect()
    assert len(out) == len(NASTY) and all(r.exact for r in out)
    assert {r.doc_id: r.piece_ids for r in out if r.doc_id in (1, 2)} == {1: [], 2: None}
    assert out[0].key == "k"


def test_codec_finds_the_best_segmentation():
    p = Pieces(tokenizer_file("piece_bpe_32k.model"))
    rng = random.Random(4)
    for _ in range(60):
        part = " " + "".join(rng.choice("abcdehiorstéß字\x07") for _ in range(rng.randint(1, 9)))
        for piece_text in p.parts.findall(part):
            ids = p.segment(piece_text)
            assert b"".join(p.bytes_of[i] for i in ids).decode() == piece_text
            if any(c not in p.alone for c in piece_text.replace(" ", "▁")):
                continue
            t = piece_text.replace(" ", "▁")
            best = [0.0] + [-math.inf] * len(t)
            for e in range(1, len(t) + 1):
                best[e] = max([best[b] + p.scores[t[b:e]][1] for b in range(e) if t[b:e] in p.scores], default=-math.inf)
            score = {i: s for i, s in p.scores.values()}
            assert sum(score[i] for i in ids) == best[-1]


def test_decode_skips_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id long, piece_ids array<int>")
    assert pairs(decode(df, tokenizer_file("piece_bpe_32k.model")), "doc_id", "decoded") == [(1, None), (2, "")]


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    rng = random.Random(5)
    rows = NASTY + [(20 + i, "".join(rng.choice(" \n\t'aZé1.<|endoftext|> 字s") for _ in range(200))) for i in range(40)]
    got = pairs(count_tokens(frame(spark, rows), tokenizer_file("byte_bpe_50k.json"), limit=20), "doc_id", "n_bytes", "n_tokens", "over_limit")
    lengths = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False))) for i, t in rows]
    assert got == sorted(((*x, x[2] > 20) for x in lengths), key=str)


def words(text, letters):
    out, word = [], ""
    for c in (text or "") + " ":
        if letters(c):
            word += c.lower() if "A" <= c <= "Z" else c
        elif word:
            out.append(word)
            word = ""
    return out


def alnum(c):
    return c.isalnum() and c.isascii() or ord(c) > 127


def corpus(seed, n=40, vocabulary=6, longest=60):
    rng = random.Random(seed)
    rows = [(i, rng.choice([" ", "\n"]).join(rng.choice("Ab cd e fé g1 h.".split()[:vocabulary]) for _ in range(rng.randint(0, longest)))) for i in range(n)]
    return rows + [(n + 1, None), (n + 2, ""), (None, rows[3][1]), rows[5], rows[5]]


@pytest.mark.parametrize("round_bytes", [1 << 20, 40])
def test_phrases(spark, round_bytes):
    rows = corpus(8)
    items = [(7, "ab cd e fé"), (100, rows[3][1]), (9, "cd cd"), (9, "e e"), (11, None), (None, "ab"), (12, "never seen"), (13, "..."), (7, "ab cd e fé")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = pairs(decontamination.report(decontamination.matches(frame(spark, rows), bench, window=4, round_bytes=round_bytes)), "doc_id", "n_words", "n_hit", "items", "contaminated")
    expected = []
    for i, t in rows:
        w = words(t, alnum)
        hit, owners = set(), set()
        for item, text in items:
            v = words(text, alnum)
            if item is None or not v:
                continue
            n = min(4, len(v))
            for g in {tuple(v[s : s + n]) for s in range(len(v) - n + 1)}:
                for s in range(len(w) - n + 1):
                    if tuple(w[s : s + n]) == g:
                        hit |= set(range(s, s + n))
                        owners.add(str(item))
        expected.append((i, len(w), len(hit), sorted(owners), bool(hit)))
    assert got == sorted(expected, key=str)


def test_proximity(spark):
    docs = frame(spark, [(1, "red x x blue x green"), (2, "red x x x x x blue green"), (3, None), (4, "green blue red")])
    bench = spark.createDataFrame([(5, "red green blue")], "item_id long, text string")
    got = {r.doc_id: len(r.matches) for r in decontamination.matches(docs, bench, slop=5).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 1}


@pytest.mark.parametrize("block", [512, 2])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    rng = random.Random(9)
    bases = [[rng.choice("abcdefghijklmnop") * 3 for _ in range(60)] for _ in range(4)]
    rows = []
    for i in range(50):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(60)] = "new%d" % rng.randrange(99)
        rows.append((i, " ".join(w)))
    rows += [(60, None), (61, " \n"), (62, "two words"), (63, "Two  words"), (None, rows[0][1]), rows[1], rows[1]]
    got = pairs(near_duplicates.near_duplicates(frame(spark, rows)), "doc_id", "n_shingles", "component_id", "kept")
    sets = []
    for _, t in rows:
        w = words(t, lambda c: c not in " \t\n\x0b\x0c\r")
        sets.append({tuple(w[s : s + 5]) for s in range(max(len(w) - 4, 1))} if w else set())
    part = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and rows[a][0] is not None and rows[b][0] is not None and (100 * len(x & y) >= 85 * len(x | y) or rows[a][0] == rows[b][0]):
                part = [part[b] if p == part[a] else p for p in part]
    low = {p: min(rows[i][0] for i in range(len(rows)) if part[i] == p and rows[i][0] is not None) for i, p in enumerate(part) if rows[i][0] is not None}
    expected = [(i, len(s), None if i is None else low[p], i is None or low[p] == i) for (i, _), s, p in zip(rows, sets, part)]
    assert got == sorted(expected, key=str)


@pytest.mark.parametrize("min_words, min_lines", [(1, 1), (4, 1), (9, 3)])
def test_line_dedup(spark, min_words, min_lines):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["a b", "c", "", "d e f", "c "]) for _ in range(rng.randint(1, 14)))) for i in range(30)]
    rows += [(40, None), (41, ""), (None, rows[2][1]), rows[4], rows[4]]
    got = line_dedup.drop_repeated_lines(frame(spark, rows).withColumn("n_runs", F.lit("clash")), min_words, min_lines)
    assert got.columns == [*SCHEMA.replace(" long", "").replace(" string", "").split(", "), "n_lines", "n_removed", "n_runs"]
    seen, cut = {}, {}
    for i, t in sorted({r for r in rows if None not in r}):
        lines = t.split("\n")
        gone = set()
        for s in range(len(lines)):
            for m in range(min_lines, len(lines) - s + 1):  # runs of every length, so the maximal ones too
                if sum(len(x.split()) for x in lines[s : s + m]) >= min_words and seen.setdefault(tuple(lines[s : s + m]), (i, s)) != (i, s):
                    gone |= set(range(s, s + m))
        cut[i] = gone
    expected = []
    for i, t in rows:
        lines = [] if t is None else t.split("\n")
        gone = cut.get(i, set()) if t is not None else set()
        left = None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
        expected.append((i, left, len(lines), len(gone), sum(k - 1 not in gone for k in gone)))
    assert pairs(got, "doc_id", "text", "n_lines", "n_removed", "n_runs") == sorted(expected, key=str)


@pytest.mark.parametrize("share", [4096, 2])
def test_repeated_runs_go_to_their_end(spark, monkeypatch, share):
    monkeypatch.setattr(line_dedup, "SHARE", share)
    a, b, c = (" ".join(f"{x}{k}" for k in range(n)) for x, n in (("a", 60), ("b", 20), ("c", 20)))
    rows = [(1, "\n".join(["own", a, b, c, "one"])), (2, "\n".join([b, c, a, b, c, "two"])), (3, "\n".join(["x", b, c])), (4, "\n".join([b, c, c, a, ""]))]
    got = line_dedup.drop_repeated_lines(frame(spark, rows))
    assert pairs(got, "doc_id", "n_removed", "n_runs") == [(1, 0, 0), (2, 3, 1), (3, 0, 0), (4, 2, 1)]


@pytest.mark.parametrize("segments, piece", [(4000, 1 << 22), (0, 1 << 22), (4000, 64)])
def test_suffix_dedup(spark, monkeypatch, segments, piece):
    monkeypatch.setattr(suffix_array, "SHARD_SEGMENTS", segments)
    monkeypatch.setattr(suffix_array, "PIECE", piece)
    rng = random.Random(10)
    shared = ["".join(rng.choice("abé\x00") for _ in range(50)) for _ in range(4)]
    rows = [(i, "".join(rng.choice([*shared, "x" * rng.randint(1, 40), str(rng.random())]) for _ in range(rng.randint(0, 7)))) for i in range(30)]
    rows += [(50, None), (51, ""), (None, shared[0] * 2), rows[6], (7, shared[1] + "other text of seven")]
    found = suffix_array.remove_repeats(frame(spark, rows), length=30)
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect() if r.doc_id not in (7,)}
    first, expected = set(), set()
    one = sorted({r for r in rows if None not in r}, key=lambda r: r[0])
    sevens = [r for r in one if r[0] == 7]
    for order in (sevens, sevens[::-1]):  # documents of one id have an arbitrary but fixed order
        seen, cuts = set(), {}
        for i, t in [r for r in one if r[0] < 7] + order + [r for r in one if r[0] > 7]:
            raw, gone = t.encode(), set()
            for s in range(len(raw) - 29):
                if raw[s : s + 30] in seen:
                    gone |= set(range(s, s + 30))
                seen.add(raw[s : s + 30])
            cuts[i] = gone
        expected = set()
        for i, t in rows:
            if i == 7:
                continue
            raw, gone = (t or "").encode(), cuts.get(i, set())
            expected.add((i, len(raw), len(gone), sum(k - 1 not in gone for k in gone), bytes(b for k, b in enumerate(raw) if k not in gone)))
        first |= {frozenset(expected)}
    assert frozenset(got) in first and found.count() == len(rows)


def test_suffix_array_and_prefixes():
    import numpy as np

    rng = random.Random(1)
    for _ in range(200):
        t = np.array([rng.randint(0, rng.choice([1, 3])) for _ in range(rng.randint(1, 40))])
        sa = suffix_array.suffix_array(t)
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        shared = suffix_array.common_prefixes(t, sa)
        for a, b in zip(sa[:-1].tolist(), sa[1:].tolist()):
            n = 0
            while max(a, b) + n < len(t) and t[a + n] == t[b + n] != 0:
                n += 1
            assert shared[b] == n


def test_word_loss_differences(spark):
    rows = [(1, "the cat sat"), (2, "the  dog\nSAT the cat"), (3, None), (4, " "), (None, "the cat"), (5, "sat cat the"), (1, "the cat sat"), (6, "dog dog dog dog")]
    target = spark.createDataFrame([(1,), (1,), (None,), (77,)], "doc_id long")
    tokens = [[None, *(t or "").lower().split()] for _, t in rows]
    vocabulary = len({w for t in tokens for w in t[1:]})

    def model(texts):
        two = Counter(g for t in texts for g in zip(t, t[1:]))
        one = Counter(w for t in texts for w in t[1:])
        before = Counter(v for t in texts for v in t[:-1])
        return lambda v, w: (two[v, w] + 8 * (one[w] + 1) / (sum(one.values()) + vocabulary)) / (before[v] + 8)

    good, all_ = model([t for (i, _), t in zip(rows, tokens) if i == 1]), model(tokens)
    expected = []
    for (i, _), t in zip(rows, tokens):
        each = [math.log(all_(v, w) / good(v, w)) for v, w in zip(t, t[1:])]
        expected.append((i, len(each), sum(each) / max(len(each), 1)))
    got = pairs(lm_scoring.word_score(frame(spark, rows), target), "doc_id", "n_tokens", "loss_difference")
    for (i, n, x), (j, m, y) in zip(got, sorted(expected, key=str), strict=True):
        assert (i, n) == (j, m) and x == pytest.approx(y, abs=1e-9)


def test_word_scores_do_not_depend_on_slices(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i if i % 9 else None, " ".join(rng.choice(["a", "b", "c", "dd", "é"]) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    target = spark.createDataFrame([(i,) for i in range(0, 40, 3)], "doc_id long")
    whole = pairs(lm_scoring.word_score(frame(spark, rows), target), "doc_id", "n_tokens", "loss_difference")
    monkeypatch.setattr(lm_scoring, "SLICE", 300)
    monkeypatch.setattr(lm_scoring, "PART", 400)
    for (i, n, x), (j, m, y) in zip(pairs(lm_scoring.word_score(frame(spark, rows), target), "doc_id", "n_tokens", "loss_difference"), whole, strict=True):
        assert (i, n) == (j, m) and x == pytest.approx(y, abs=1e-9)


def test_word_scores_without_target(spark):
    rows = [(1, "a b c"), (2, "a b " * 30_000)]
    got = {r.doc_id: r for r in lm_scoring.word_score(frame(spark, rows), spark.createDataFrame([(9,)], "doc_id long")).collect()}
    assert (got[1].n_tokens, got[2].n_tokens) == (3, 60_000) and all(math.isfinite(r.loss_difference) for r in got.values())


def test_lm_query_counts_words(spark, folder):
    from ticketlake.llm.queries import QUERIES

    lengths = {r.doc_id: len(words(r.text, lambda c: c not in " \t\n\x0b\x0c\r")) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in QUERIES["op1_lm_scoring"](spark, folder).collect()} == lengths


def test_toxicity_learns_words_and_stems(spark):
    rng = random.Random(6)
    plain = ["w%s" % "".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(300)]
    rows, labels = [], []
    for i in range(500):
        toxic = i % 5 == 0
        w = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = "vilest" + rng.choice(["er", "ing", "um", ""]) if i % 2 else "scoundrel"
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs = frame(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame([*labels, (None, 1), (3, None), (0, 0)], "doc_id long, toxic int"))
    fresh = [(1000, "a wabc vilestish wabd"), (1001, "wabc wabd"), (1002, ""), (1003, None), (None, "scoundrel here"), (1004, "é scoundrel! " + "wabc " * 3000)]
    got = {r.doc_id: r for r in toxicity.tag(frame(spark, fresh), model).collect()}
    assert [got[i].predicted for i in (1000, 1001, 1002, 1003, None, 1004)] == [1, 0, 0, 0, 1, 1]
    assert got[1000].spans[0].asDict() == {"start": 7, "stop": 16} and got[1004].spans[0].asDict() == {"start": 2, "stop": 11}
    scored = toxicity.score(docs, model).select("doc_id", "predicted", toxicity.held_out(F.col("doc_id")).alias("out")).filter("out").collect()
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in scored) >= 0.97 * len(scored)


def test_toxicity_reads_no_held_out_label(spark):
    docs = frame(spark, [(i, "bad" if i % 3 == 0 else "good") for i in range(60)])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert (toxicity.fit(docs, labels) == toxicity.fit(docs, turned)).all()


def test_toxicity_fits_in_parts(monkeypatch):
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = random.Random(9)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(2000)]
    texts, toxic = [], []
    for i in range(400):
        w = [rng.choice(plain) for _ in range(400)]
        w[7:7] = ["scoundrel"] * (i % 4 == 0)
        texts += [" ".join(w)] * (1 + i % 2)  # copies count once
        toxic += [int(i % 4 == 0)] * (1 + i % 2)
    texts[5] = None
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(toxic)], ["text", "toxic"])
    whole = toxicity._fit(iter([batch]))
    monkeypatch.setattr(toxicity, "STEP_BYTES", 1 << 15)
    monkeypatch.setattr(toxicity, "FIT_TOKENS", 1 << 12)
    tracemalloc.start()
    parts = toxicity._fit(iter([batch.slice(0, 100), batch.slice(100)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(whole, parts, atol=1e-9) and np.abs(whole).max() > 0.5
    assert peak < 48 << 20  # the weights take 2 MB an array, whatever the sample is; all tokens and chains at once took 79 MB


def test_toxicity_tags_rows_whatever_their_columns(spark):
    docs = frame(spark, NASTY).select(F.struct("key").alias("text 2"), "text", "doc_id")
    model = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, toxic int"))
    as_bytes = docs.withColumn("text", F.col("text").cast("binary"))
    got = [toxicity.tag(d, model) for d in (docs, as_bytes)]
    assert pairs(got[0], "doc_id", "score", "spans") == pairs(got[1], "doc_id", "score", "spans")
    assert pairs(got[0].select("doc_id", "text", F.col("`text 2`.key").alias("key")), "doc_id", "text", "key") == pairs(frame(spark, NASTY), "doc_id", "text", "key")


def test_marginals_equal_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(2)
    score, opens, moves = rng.normal(size=7), np.array([1, 0, 0, 1, 0, 0, 0], bool), rng.normal(size=5)
    total, toxic, first = 0.0, np.zeros(7), 0.0
    for y in itertools.product((0, 1), repeat=7):
        s = sum(score[k] * y[k] for k in range(7)) + sum(moves[4] * y[k] if opens[k] else moves[2 * y[k - 1] + y[k]] for k in range(7))
        total += math.exp(s)
        toxic += math.exp(s) * np.array(y)
        first += math.exp(s) * sum(y[k - 1] == 0 and y[k] == 1 for k in range(7) if not opens[k])
    chain = toxicity._Chain(score, opens, moves)
    assert np.allclose(chain.toxic(), toxic / total) and np.isclose(chain.moves(opens)[1], first / total)


@pytest.mark.parametrize("name", ["codec", "counts", "phrases", "near", "lines", "suffix", "lm", "toxicity"])
def test_empty_tables(spark, name):
    docs = frame(spark, [])
    run = {
        "codec": lambda: encode(docs, tokenizer_file("piece_bpe_32k.model")),
        "counts": lambda: count_tokens(docs, tokenizer_file("byte_bpe_50k.json")),
        "phrases": lambda: decontamination.report(decontamination.matches(docs, spark.createDataFrame([], "item_id long, text string"))),
        "near": lambda: near_duplicates.near_duplicates(docs),
        "lines": lambda: line_dedup.drop_repeated_lines(docs),
        "suffix": lambda: suffix_array.remove_repeats(docs),
        "lm": lambda: lm_scoring.word_score(docs, spark.createDataFrame([], "doc_id long")),
        "toxicity": lambda: toxicity.score(docs, toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))),
    }
    assert run[name]().count() == 0
