"""Inverted lists of vectors against the exact search."""
import contextlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketlake.operators import dense as D, inverted_vectors as IV

SCHEMA = "doc string, embedding array<double>"


def vectors(spark, n=900, dims=8, seed=2, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    rows = [(f"d{k:04d}", [float(x) for x in centres[rng.integers(12)] + spread * rng.normal(size=dims)]) for k in range(n)]
    rows += [("same1", rows[0][1]), ("same2", rows[0][1]), ("zero1", [0.0] * dims), ("zero2", [0.0] * dims), ("none", None)]
    return spark.createDataFrame(rows, SCHEMA), rows


def asked(spark, rows, dims=8):
    rng = np.random.default_rng(9)
    q = [(f"q{k}", rows[k * 40 % (len(rows) - 1)][1]) for k in range(15)] + [("far", [float(x) for x in rng.normal(size=dims)]), ("zero", [0.0] * dims), ("null", None)]
    return spark.createDataFrame(q, "query_id string, embedding array<double>")


def result(df):
    return sorted(tuple(r) for r in df.select("query_id", "doc", "score", "rank").collect())


@pytest.mark.parametrize("lists, part_rows, query_rows, probes", [(None, 20_000, 2048, 4), (5, 37, 3, 1), (1, 20_000, 2048, 1)])
def test_equal_to_the_exact_search(spark, monkeypatch, lists, part_rows, query_rows, probes):
    monkeypatch.setattr(IV, "PART_ROWS", part_rows)
    monkeypatch.setattr(IV, "QUERY_ROWS", query_rows)
    docs, rows = vectors(spark)
    queries = asked(spark, rows)
    index = IV.build_lists(docs, lists=lists)
    assert result(IV.search_lists(index, queries, 7, probes=probes)) == result(D.dense_search(docs, queries, 7))


def test_recall_of_few_probes(spark):
    docs, rows = vectors(spark, 3000, 16)
    queries = asked(spark, rows, 16).filter("query_id like 'q%'")
    index = IV.build_lists(docs)
    found = IV.recall(IV.search_lists(index, queries, 10, probes=8, exact=False), D.dense_search(docs, queries, 10)).first()
    assert found.wanted == 150 and found.recall >= 0.95


def test_bounds_skip_cells(spark):
    docs, rows = vectors(spark, spread=0.02)
    queries = asked(spark, rows).filter("query_id = 'q3'")
    index = IV.build_lists(docs, lists=40)
    level = IV.top_k(IV._scored(index, IV._chosen(index, IV._units(queries, "query_id", "embedding"), 1, False), 5), "query_id", [F.col("score").desc(), "doc"], 5)
    known = IV._units(queries, "query_id", "embedding").crossJoin(level.groupBy().min("score").withColumnRenamed("min(score)", "level"))
    assert IV._chosen(index, known, 1, True).count() < index.cells.count() / 3


def test_plan_pairs_by_cell(spark):
    docs, rows = vectors(spark, 100)
    index = IV.build_lists(docs)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        IV.search_lists(index, asked(spark, rows), 3, exact=False).explain()
        IV._scored(index, IV._chosen(index, IV._units(asked(spark, rows), "query_id", "embedding"), 2, False), 3).explain()
    assert "NestedLoop" not in out.getvalue() and "Cartesian" not in out.getvalue()


def test_empty_tables(spark):
    docs, rows = vectors(spark, 50)
    none = docs.limit(0)
    assert IV.search_lists(IV.build_lists(none), asked(spark, rows), 3).count() == 0
    assert IV.search_lists(IV.build_lists(docs), asked(spark, rows).limit(0), 3).count() == 0
    zeros = docs.filter("doc like 'zero%'")
    assert result(IV.search_lists(IV.build_lists(zeros), asked(spark, rows), 1)) == result(D.dense_search(zeros, asked(spark, rows), 1))
