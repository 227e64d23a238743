"""Relational and retrieval operators against brute force, and the shape of their plans."""
import contextlib
import io
import math
import random
from collections import Counter

import numpy as np
import os

import pytest
from pyspark.sql import functions as F

from ticketlake.operators import context as CX, dense as D, fusion as FU, learning as L, ordering as O, relational as J, sparse as SP
from ticketlake.plans.warehouse import Warehouse
from ticketlake.sources.tables import Tables


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_match_any_equals_or_join(spark):
    rng = random.Random(1)
    left = [(i, rng.choice(["u1", "u2", "u3", None]), rng.choice(["h1", "h2", None]), rng.choice([1, 2])) for i in range(40)]
    right = [(100 + i, rng.choice(["u1", "u2", None]), rng.choice(["h1", "h3", None]), rng.choice([1, 2])) for i in range(30)]
    a = spark.createDataFrame(left, "id int, u string, h string, y int")
    b = spark.createDataFrame(right, "rid int, ru string, rh string, ry int")
    got = J.match_any(a, b, [([F.col("u")], [F.col("ru")]), ([F.col("h"), F.col("y")], [F.col("rh"), F.col("ry")])], "id", "rid")
    want = []
    for i, u, h, y in left:
        hits = [r[0] for r in right if (u is not None and u == r[1]) or (h is not None and h == r[2] and y == r[3])]
        want += [(i, r) for r in hits] or [(i, None)]
    assert sorted((r["id"], r["rid"] or 0) for r in got.collect()) == sorted((i, r or 0) for i, r in want)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    latest = J.latest_per_key(df, "k", [F.col("id").desc()])
    assert latest.filter("k = 0").first()["id"] == 999
    assert latest.count() == latest.select("k").distinct().count()
    assert "WindowGroupLimit" in plan(latest)


def test_numbering_is_consecutive(spark):
    df = spark.range(0, 5000, 7).withColumnRenamed("id", "k")
    rows = O.number_in_order(df, "k", "n").orderBy("k").collect()
    assert [r["n"] for r in rows] == list(range(len(rows)))


def test_no_nested_loops_in_the_models(spark, folder):
    w = Warehouse(Tables(spark, folder))
    for name in ("silver_assets", "silver_activity", "gold_sla", "gold_anomalies", "gold_similarity"):
        text = plan(getattr(w, name))
        assert "NestedLoop" not in text and "Cartesian" not in text, name


def bm25(corpus, query):
    n, avg = len(corpus), sum(map(len, corpus.values())) / len(corpus)
    df = Counter(t for tokens in corpus.values() for t in set(tokens))
    idf = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {t: floor if v < 0 else v for t, v in idf.items()}
    out = {}
    for d, tokens in corpus.items():
        tf = Counter(tokens)
        out[d] = sum(idf.get(t, 0) * tf[t] * 2.5 / (tf[t] + 1.5 * (0.25 + 0.75 * len(tokens) / avg)) for t in query.split())
    return out


@pytest.mark.parametrize("vocabulary", [5, 40])
def test_bm25_matches_brute_force(spark, vocabulary):
    rng = random.Random(vocabulary)
    corpus = {f"d{i:02d}": [f"t{rng.randint(0, vocabulary)}" for _ in range(rng.randint(1, 12))] for i in range(30)}
    queries = {"q1": "t1 t2 t1", "q2": "t3 none", "q3": "none"}
    index = SP.build_index(spark.createDataFrame(list(corpus.items()), "doc string, tokens array<string>"), "doc", "tokens")
    got = SP.bm25_search(index, spark.createDataFrame(list(queries.items()), "query_id string, text string"), 6).collect()
    for q, text in queries.items():
        scores = bm25(corpus, text)
        want = sorted(((round(s, 6), d) for d, s in scores.items()), key=lambda x: (-x[0], x[1]))[:6]
        mine = [(r["score"], r["doc"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])]
        assert [d for _, d in mine] == [d for _, d in want]
        assert np.allclose([s for s, _ in mine], [s for s, _ in want], atol=2e-6)


def test_search_in_place_equals_the_joined_one(spark, monkeypatch):
    rng = random.Random(3)
    corpus = [(f"d{i:03d}" if i else None, [f"term{min(rng.randint(0, 400), rng.randint(0, 400))}" for _ in range(rng.randint(0, 20))]) for i in range(300)]
    corpus += [(f"e{i}", ["term1", "term2"]) for i in range(50)]  # more equal scores than are kept
    asked = spark.createDataFrame([(f"q{i}" if i else None, " ".join(f"term{rng.randint(0, 450)}" for _ in range(8))) for i in range(9)] + [("copies", "term2 term1")], "query_id string, text string")
    index = SP.build_index(spark.createDataFrame(corpus, "doc string, tokens array<string>"), "doc", "tokens")
    order = ["query_id", "rank", "doc", "score"]

    def found():
        return [SP.bm25_search(index, asked, 7).select(order).sort(order).collect(), SP.sparse_search(index, asked, 7).select(order).sort(order).collect()]

    monkeypatch.setattr(SP, "BATCH_QUERIES", 4)
    monkeypatch.setattr(SP, "BLOCK_CELLS", 600)
    monkeypatch.setattr(SP, "KEPT_ROWS", 30)
    near = found()
    plan = SP.sparse_search(index, asked, 7)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" in plan  # no row for each document and query
    monkeypatch.setattr(SP, "BROADCAST_QUERY_TERMS", 0)
    for a, b in zip(near, found(), strict=True):
        assert [(r.query_id, r["rank"], r.doc) for r in a] == [(r.query_id, r["rank"], r.doc) for r in b]
        assert np.allclose([r.score for r in a], [r.score for r in b], atol=2e-8)


def _saved(spark, tmp_path, rows, **sizes):
    index = SP.build_index(spark.createDataFrame(rows, "doc string, tokens array<string>"), "doc", "tokens")
    return index, SP.save_index(index, str(tmp_path / "index"), **sizes)


def test_a_saved_index_has_one_file_for_each_bucket_and_the_same_rows(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"d{i:04d}", [f"t{rng.randint(0, 99)}" for _ in range(rng.randint(0, 30))]) for i in range(600)]
    rows += [rows[3], (None, ["t1", "t1", "t2"]), (None, ["t1", "t3"]), ("empty", []), ("none", None)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index, saved = _saved(spark, tmp_path, rows, least=7)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "index" / "postings").glob("*.parquet"))) <= 7

    def content(x):
        return [sorted((tuple(r) for r in df.collect()), key=str) for df in (x.postings.select("doc", "term", "tf", "dl"), x.terms, x.docs.select("doc"), x.stats)]

    assert content(saved) == content(index)
    grown = SP.save_index(index, str(tmp_path / "more"), bucket_rows=400)
    assert len(list((tmp_path / "more" / "postings").glob("*.parquet"))) > 15 and content(grown) == content(index)


def test_sparse_vectors_shuffle_only_rare_terms(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    rows = [(f"d{i:03d}" if i else None, [f"term{int(rng.paretovariate(0.8)) % 200}" for _ in range(rng.randint(0, 20))]) for i in range(300)]
    _, saved = _saved(spark, tmp_path, rows)
    before = sorted(map(tuple, SP.sparse_vectors(saved).collect()))
    monkeypatch.setattr(SP, "BROADCAST_TERMS", 12)
    split = SP.sparse_vectors(saved)
    assert "LeftAnti" in split._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, split.collect())) == before
    tf, df = {}, {}
    for doc, terms in rows:
        for x in terms:
            tf.setdefault(doc, {})[x] = tf.get(doc, {}).get(x, 0) + 1
    for terms in tf.values():
        for x in terms:
            df[x] = df.get(x, 0) + 1
    want = {(d, x): c / sum(terms.values()) * math.log(1 + (len(rows) - df[x] + 0.5) / (df[x] + 0.5)) for d, terms in tf.items() if d for x, c in terms.items()}
    assert {(d, x): pytest.approx(v) for d, x, v in before} == want


def test_dense_paths_agree(spark, monkeypatch):
    monkeypatch.setattr(D, "VECTORS_PER_BLOCK", 100)
    monkeypatch.setattr(D, "BROADCAST_QUERIES", 7)
    rng = np.random.default_rng(0)
    vectors = spark.createDataFrame([(f"d{i:03d}", rng.normal(size=8).tolist()) for i in range(400)], "doc string, embedding array<double>")
    queries = spark.createDataFrame([(f"q{i}", rng.normal(size=8).tolist()) for i in range(20)], "query_id string, embedding array<double>")
    a = D.dense_search(vectors, queries, 5, max_broadcast=100)
    b = D.dense_search(vectors, queries, 5, max_broadcast=3)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_rrf_does_not_depend_on_the_order_of_lists(spark):
    a = spark.createDataFrame([("q", "x", 1, 1.0), ("q", "y", 2, 0.5)], "query_id string, doc string, rank int, score double")
    b = spark.createDataFrame([("q", "y", 1, 9.0), ("q", "z", 2, 3.0)], "query_id string, doc string, rank int, score double")
    one = {tuple(r) for r in FU.rrf(FU.rank_union(bm25=a, dense=b)).collect()}
    two = {tuple(r) for r in FU.rrf(FU.rank_union(dense=b, bm25=a)).collect()}
    assert one == two and ("q", "y", round(1 / 61 + 1 / 62, 8)) in one


def test_context_stops_at_the_first_overflow(spark):
    rows = [("q", "a", 1, "x" * 40), ("q", "b", 2, " "), ("q", "a", 3, "x" * 40), ("q", "c", 4, "x" * 40), ("q", "d", 5, "x" * 400), ("q", "e", 6, "x" * 4)]
    df = spark.createDataFrame(rows, "query_id string, doc string, rank int, text string")
    assert [r["doc"] for r in CX.select_within_budget(df, 20).orderBy("rank").collect()] == ["a", "c"]


def test_stratified_split_shares(spark):
    df = spark.range(4000).withColumn("label", F.when(F.col("id") % 10 == 0, 1).otherwise(0))
    got = {(r["label"], r["is_test"]): r["count"] for r in L.stratified_split(df, "label", "id").groupBy("label", "is_test").count().collect()}
    assert got == {(0, True): 900, (0, False): 2700, (1, True): 100, (1, False): 300}


def test_isolation_forest_finds_the_outlier(spark):
    rng = np.random.default_rng(1)
    rows = [(i, *map(float, rng.normal(size=3))) for i in range(300)] + [(999, 25.0, -25.0, 25.0)]
    scored = L.isolation_forest(spark.createDataFrame(rows, "id bigint, a double, b double, c double"), "id", ["a", "b", "c"], trees=50)
    assert scored.orderBy(F.col("anomaly_score").desc()).first()["id"] == 999


@pytest.mark.parametrize("n, scale, copies", [(900, 1, False), (8, 1, False), (900, 1000, True), (300, 0, False)])
def test_nearest_points_equal_all_distances(n, scale, copies):
    v = np.random.default_rng(n).normal(size=(n, 7)) * scale
    if copies:
        v[::2] = v[0]
    u, same = v[:64], np.eye(min(64, n), n, dtype=bool)
    d = np.sqrt(((u[:, None, :] - v[None, :, :]) ** 2).sum(axis=2))
    d[same] = np.inf
    want = [(i, j, d[i, j]) for i in range(len(d)) for j in np.argsort(d[i], kind="stable")[:10] if np.isfinite(d[i, j])]
    assert list(zip(*L._nearest(u, v, same, 10))) == want


def test_local_outlier_factor_finds_the_outlier(spark):
    rng = np.random.default_rng(2)
    rows = [(i, *map(float, rng.normal(size=2))) for i in range(200)] + [(999, 30.0, 30.0)]
    scored = L.local_outlier_factor(spark.createDataFrame(rows, "id bigint, a double, b double"), "id", ["a", "b"])
    assert scored.count() == 201 and scored.orderBy(F.col("lof_score").desc()).first()["id"] == "999"


def test_equal_points_are_compared_once(spark, monkeypatch):
    """Ids that repeat or are null, and a place of very many ids: the same nearest rows as from all pairs, ties by id."""
    rng = np.random.default_rng(3)
    rows = [(f"p{k:03}", float(rng.integers(0, 4)), float(rng.integers(0, 3))) for k in range(90)] + [(f"z{k:04}", 0.0, 0.0) for k in range(700)]
    rows += rows[5:9] * 2 + rows[100:103] * 5 + [(None, 1.0, 1.0), (None, 1.0, 1.0), (None, 7.5, 0.0), ("nan", float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "id string, a double, b double").repartition(5)
    k, rank = 4, {i: n for n, i in enumerate(sorted({r[0] or "" for r in rows}))}
    some = [r for r in rows if r[1] == r[1]]
    want = []
    for i in {r[0] for r in some}:
        pool = []
        for r in (r for r in some if r[0] == i):
            pool += sorted((float(np.hypot(r[1] - q[1], r[2] - q[2])), rank[q[0] or ""]) for q in some if q[0] != i)[:k]
        want += [(i or "", d, o) for d, o in sorted(pool)[:k]]
    points = df.select("id", F.array("a", "b").alias("x"))
    top_k = L.top_k
    for block in (20_000, 40):
        monkeypatch.setattr(L, "LOF_BLOCK", block)
        nearest = top_k(L._nearest_pairs(points, k), "id", [F.col("dist"), F.col("other")], k, "_r").collect()
        got = sorted((r.id or "", r.dist, rank[r.other or ""]) for r in nearest)
        assert [g[::2] for g in got] == [w[::2] for w in sorted(want)]
        assert np.allclose([g[1] for g in got], [w[1] for w in sorted(want)])


def test_best_by_rules_with_one_hot_key(spark):
    """Ten thousand rows of one uuid on both sides stay ten thousand rows."""
    n = 10_000
    a = spark.range(n).select(F.col("id").alias("aid"), F.lit("hot").alias("u"), F.lit(None).cast("string").alias("h"))
    b = spark.range(n).select(F.col("id").alias("bid"), F.lit("HOT").alias("bu"), F.col("id").cast("string").alias("bh"))
    extra = spark.createDataFrame([(-1, None, "7"), (-2, "none", "none"), (-3, "hot", "3")], "aid long, u string, h string")
    got = J.best_by_rules(a.unionByName(extra), b, [([F.lower("u")], [F.lower("bu")]), ([F.col("h")], [F.col("bh")])], [-F.col("bid")], ["bid"])
    best = {r.aid: r.bid for r in got.filter("aid < 0").collect()}
    assert got.count() == n + 3 and best == {-1: 7, -2: None, -3: n - 1}
    assert got.filter("aid >= 0").agg(F.min("bid"), F.max("bid")).first() == (n - 1, n - 1)


def test_csv_files_are_split(spark, tmp_path):
    from ticketlake.sources import ingest as I

    path = str(tmp_path / "one.csv")
    with open(path, "w") as f:
        f.write("id\n" + "".join(f"{i}\n" for i in range(200_000)))
    seen = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        n = I.ingest_csv(spark, path, schema="id bigint", transform=lambda d: seen.append(d.rdd.getNumPartitions()) or d, dry_run=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert n == 200_000 and seen[0] > 5


def test_ingestion_counts_rows_of_its_own_run(spark, tmp_path):
    from ticketlake.sources import ingest as I

    for _ in range(2):
        report = I.ingest_years(spark, lambda table, year: spark.range(10), ("t",), (2020,), "S", str(tmp_path / "out"))
        assert [r.row_count for r in report.collect()] == [10]


def test_closed_stream_has_every_window(spark):
    from ticketlake.streaming import incremental as INC

    events = spark.sql("select timestamp'2024-01-01' + make_interval(0, 0, 0, id) as ts, 'a' as event_type from range(5)")
    rows = INC.closed(events, "ts", "event_type").collect()
    assert len(rows) == 6 and max(rows, key=lambda r: r.ts).event_type == INC.CLOSING


def test_checkpoint_folder_without_the_setting(spark, monkeypatch):
    from ticketlake import session

    class Settings:
        def get(self, key, default=None):
            return {"spark.master": master}.get(key, default)

        def set(self, *_):
            raise AssertionError("static settings cannot be set")

    class Bare:
        conf, sparkContext = Settings(), spark.sparkContext

    monkeypatch.setattr(session, "_LOCAL", {})
    master = "local[2]"
    folder = session.checkpoint_dir(Bare())
    assert os.path.isdir(folder) and session.checkpoint_dir(Bare()) == folder
    master = "spark://host:7077"
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Bare())


@pytest.mark.parametrize("round_bytes", [2 << 20, 80])
def test_holding_equals_contains(spark, round_bytes):
    from ticketlake.operators.evaluation import holding

    texts = [(1, "the cat sat on the mat"), (2, "concatenate"), (3, None), (4, ""), (1, "cat"), (5, "Größe der Welt\nneu"), (6, "x" * 50_000 + "cat sat")]
    asked = [("a", "cat"), ("b", "cat sat"), ("c", "at"), ("d", ""), ("e", None), ("f", "öße der Welt\n"), ("g", "cat"), ("h", "never")]
    got = holding(spark.createDataFrame(texts, "doc_id int, text string"), spark.createDataFrame(asked, "query_id string, text string"), round_bytes=round_bytes)
    expected = [(q, i) for i, t in texts for q, p in asked if t and p and p in t]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected) and "NestedLoop" not in plan(got)


def test_overlap_score(spark):
    rows = [("a b c", "B c  d", 0.5), ("", None, 0.0), ("x x", "X", 1.0), (None, "a", 0.0)]
    df = spark.createDataFrame(rows, "q string, t string, s double")
    assert all(r.got == r.s for r in df.withColumn("got", FU.overlap_score("q", "t")).collect())
    best = FU.rerank_by(spark.createDataFrame([("1", "d", 0.5), ("1", "b", 0.9), ("1", "a", 0.9)], "query_id string, doc string, s double"), 2, F.col("s"))
    assert [(r.doc, r.rerank_rank) for r in best.orderBy("rerank_rank").collect()] == [("a", 1), ("b", 2)]
