"""Pruned BM25: equal to the full search, with less read."""
import contextlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from ticketlake.operators import blocks as B, sparse as SP


def corpus(spark, seed, n=400, common=0.3):
    """Texts of rare words and a few very frequent ones; some words occur in most texts."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        rare = [f"r{int(rng.paretovariate(0.9)) % 300}" for _ in range(rng.randint(0, 25))]
        rows.append((f"d{k:05d}", rare + ["the"] * rng.randint(0, 3) + (["of"] if rng.random() < common else [])))
    return spark.createDataFrame(rows, "chunk string, tokens array<string>")


def built(spark, tmp_path, df, range_docs):
    index = SP.save_index(SP.build_index(df, "chunk", "tokens"), str(tmp_path / "index"))
    return index, B.save_blocks(index, str(tmp_path / "blocks"), range_docs)


@pytest.fixture
def asked(spark):
    texts = ["r1 r2 the of", "r7 r7 r250", "the of", "nothing known", "", "r9 r40 r41 r42 r43 r44 r45 r46 r47 r48 r49 the", "r3", None]
    return spark.createDataFrame([(f"q{k}", t) for k, t in enumerate(texts)], "query_id string, text string")


@pytest.mark.parametrize("k, range_docs, common", [(5, 8, 0.3), (10, 32, 0.3), (3, 1, 0.95), (450, 16, 0.3)])
def test_equal_to_the_full_search(spark, tmp_path, asked, k, range_docs, common):
    index, blocks = built(spark, tmp_path, corpus(spark, k, common=common), range_docs)
    columns = ["query_id", "doc", "score", "rank"]
    got = sorted(tuple(r) for r in B.pruned_search(blocks, asked, k).select(*columns).collect())
    assert got == sorted(tuple(r) for r in SP.bm25_search(index, asked, k).select(*columns).collect())


def test_bounds_hold_and_little_is_read(spark, tmp_path):
    index, blocks = built(spark, tmp_path, corpus(spark, 1, 3000), B.RANGE)
    asked = spark.createDataFrame([("a", "r120 r121 the of"), ("b", "r99 r40 the")], "query_id string, text string")
    weights = SP.query_weights(asked, index.terms, "query_id", "text")
    found = B.search_ranges(blocks, weights, 10)
    scores = SP.bm25_scores(index, weights, blocks.avgdl).join(index.docs, "doc").withColumn("block", F.floor((F.col("pos") - 1) / B.RANGE))
    best = scores.groupBy("query_id", "block").agg(F.max("score").alias("best"))
    assert found.ranges.join(best, ["query_id", "block"]).filter("best > bound + 1e-6").isEmpty()
    met, read = found.ranges.agg(F.sum("n"), F.sum(F.when(F.col("read"), F.col("n")))).first()
    assert read * 4 < met and read * 8 < index.postings.count()


def test_terms_reach_the_scan(spark, tmp_path, asked):
    index, blocks = built(spark, tmp_path, corpus(spark, 2), 16)
    weights = SP.query_weights(asked, index.terms, "query_id", "text")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        B.range_bounds(B.asked_blocks(blocks.blocks, weights), weights).explain("formatted")
    plan = out.getvalue()
    assert "PushedFilters" in plan and "In(term" in plan
    assert "pos:array" not in plan.split("ReadSchema", 1)[1].split("\n")[0]


def test_tasks_stay_small(spark, tmp_path, asked):
    """Partitions follow the postings, in order of term and range, and the blocks are the same."""
    index, blocks = built(spark, tmp_path, corpus(spark, 4, 2000), 16)
    cut = B.save_blocks(index, str(tmp_path / "cut"), 16, part_rows=500)
    rows = cut.blocks.groupBy(F.input_file_name()).agg(F.sum("n").alias("n"), F.min(F.struct("term", "block")).alias("a"), F.max(F.struct("term", "block")).alias("z")).sort("a").collect()
    assert len(rows) > 20 and max(r.n for r in rows) < 2000
    assert all(x.z < y.a for x, y in zip(rows, rows[1:]))
    assert sorted(map(str, cut.blocks.collect())) == sorted(map(str, blocks.blocks.collect()))


def test_a_task_sums_up_few_ranges(spark, tmp_path, asked):
    index, blocks = built(spark, tmp_path, corpus(spark, 5, 1500), 16)
    weights = SP.query_weights(asked, index.terms, "query_id", "text")
    plain, dealt = B.range_bounds(blocks.blocks, weights), B.range_bounds(blocks.blocks, weights, 6)
    assert sorted((r.query_id, r.block, r.n, round(r.bound, 9)) for r in dealt.collect()) == sorted((r.query_id, r.block, r.n, round(r.bound, 9)) for r in plain.collect())
    held = dealt.withColumn("part", F.spark_partition_id()).groupBy("block").agg(F.countDistinct("part").alias("parts"))
    assert held.filter("parts > 1").isEmpty()

    def moves_sums(df):
        return re.search(r"hashpartitioning\(query_id#\d+, block#", df._jdf.queryExecution().executedPlan().toString()) is not None

    assert moves_sums(plain) and not moves_sums(dealt)


def test_empty_index(spark, tmp_path, asked):
    _, blocks = built(spark, tmp_path, corpus(spark, 3, 0), 16)
    assert B.pruned_search(blocks, asked, 5).count() == 0
