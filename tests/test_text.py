"""Text operators against plain Python on small inputs."""
import random
import re
import tracemalloc

import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ticketlake.functions import text as T
from ticketlake.plans import corpus as C


def py_clean(text):
    text = text.lower()
    text = re.sub(r"<.*?>", " ", text)
    text = re.sub(r"https?://\S+|www\.\S+", " ", text)
    text = re.sub(r"\S+@\S+", " ", text)
    text = re.sub(r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", " ", text)
    text = re.sub(r"(ticket|inc|req)[-_ ]?\d+", " ", text)
    text = re.sub(r"([!?.,])\1+", r"\1", text)
    text = re.sub(r"[^a-zA-Z0-9\s\-_./]", " ", text)
    return re.sub(r"\s+", " ", text).strip()


SAMPLES = [
    "Hello <b>World</b>!!! mail me@x.org or a@ b @c @@ x@@y", "see https://a.b/c?d www.x.y end", "INC-123 req 9 ticket_7 10.1.2.3 999.1.1.1.1",
    "Été  à\tParis\n\n...,,,??", "", "a--b ___ /x/ .", "<a\nb> <c>",
]


def test_clean_text_matches_python(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "c string")
    assert [r[0] for r in df.select(T.clean_text("c")).collect()] == [py_clean(s) for s in SAMPLES]


def test_clean_text_is_idempotent(spark, folder):
    d = spark.read.parquet(f"{folder}/documents.parquet").select(C.normalise(F.col("text"), collapse=False).alias("a"))
    assert d.filter(T.clean_text("a") != F.col("a")).count() == 0


PHRASE = re.compile(r"\b(.+?)(?:\s+\1\b)+")


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ab", "a-b", "b.", "-", "a/b", "_x", "1.2", "b-", "x."]), min_size=1, max_size=16))
def test_collapse_repeats_matches_regex(words):
    s = " ".join(words)
    assert T.collapse_repeats(s) == PHRASE.sub(r"\1", s)


def test_collapse_long_phrases():
    rng = random.Random(3)
    for _ in range(300):
        phrase = " ".join(rng.choice("pqrst") + str(rng.randint(0, 3)) for _ in range(rng.randint(5, 12)))
        head = " ".join(rng.choice(["u", "v-w", "x."]) for _ in range(20))
        s = f"{head} {phrase} {phrase} {head}"
        assert T.collapse_repeats(s) == PHRASE.sub(r"\1", s)


def test_repeat_detector(spark):
    rows = ["a b a b", "a b c a b d", "x y z q w e x y z q w e", "one one one", "", "p q r", "a-b a-b", "x y. x y", "foo, bar foo, bar", "ab ab ab abc", "a\tB A\nb", "u_v w u_v w."]
    rng = random.Random(5)
    rows += ["".join(rng.choice(["a", "b", "a ", "b ", " ", ". ", "_"]) for _ in range(14)) for _ in range(150)]
    df = spark.createDataFrame([(r,) for r in rows], "c string").select(T.spaced_words("c").alias("w"))
    # two to six words, then the same words again, with white space only in between
    detector = re.compile(r"(\b(?:\w+\s+){1,5}\w+\b)(?:\s+\1\b)+")
    want = [bool(detector.search(r.lower())) for r in rows]
    assert [r[0] for r in df.select(T.has_repeated_pattern("w")).collect()] == want


def test_chunks_cover_the_text(spark):
    lengths = [0, 4, 5, 206, 207, 256, 257, 462]
    df = spark.createDataFrame([(n, " ".join(f"w{i}" for i in range(n))) for n in lengths], "n int, c string")
    for n, chunks in df.select("n", T.chunks(T.words("c"))).collect():
        words = [f"w{i}" for i in range(n)]
        assert chunks == [" ".join(words[s : s + 256]) for s in range(0, n, 206)]


def test_query_expansion_key_case(spark):
    df = spark.createDataFrame([("my VPN is slow",), ("vpn",), ("nothing",)], "c string")
    assert [r[0] for r in df.select(T.expand_query("c")).collect()] == ["my VPN is slow slow sluggish performance timeout latency delay", "vpn", "nothing"]
    assert df.select(T.expand_query("c", fix_case=True)).collect()[1][0] == "vpn VPN remote access tunnel connection network"


def test_few_texts_of_a_batch_are_python_objects_at_a_time():
    texts = pa.array([f"text {k} " + "x" * 20_000 for k in range(1000)] + [None, "a b a b a b c"])
    tracemalloc.start()
    try:
        got = T.collapse_batch(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 8_000_000  # the batch has 20 MB
    assert got.to_pylist() == [None if t is None else T.collapse_repeats(t).strip() for t in texts.to_pylist()]
    assert T.collapse_batch(pa.array([], pa.string())).to_pylist() == []


def test_words_that_cannot_repeat_are_not_looked_at(monkeypatch):
    seen = []
    edge = T._boundary
    monkeypatch.setattr(T, "_boundary", lambda s, i: seen.append(i) or edge(s, i))
    text = " ".join(f"w{k}" for k in range(3000))
    assert T.collapse_batch(pa.array([text, f"{text} u v-w v-w."])).to_pylist() == [text, f"{text} u v-w."]
    assert len(seen) < 10  # each of 6,000 words before


def test_batches_collapse_as_single_texts_do():
    rng = random.Random(8)
    parts = ["a", "b", "ab", "a-b", "b.", "-", "a/b", "_x", "1.2", "b-", "x.", "é", "é-a", "_"]
    texts = [" ".join(rng.choice(parts[: rng.randint(2, 14)]) for _ in range(rng.randint(1, 40))) for _ in range(400)] + [None, ""]
    for some in (texts, [t for t in texts if t is None or t.isascii()]):
        got = T.collapse_batch(pa.array(some, pa.string()).slice(3), rows=7).to_pylist()
        assert got == [None if t is None else PHRASE.sub(r"\1", t).strip() for t in some[3:]]
