"""Rank fusion, hybrid search, reranking and solution lookup."""
from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ticketlake import rules as R
from ticketlake.functions import cleanse as X, text as T
from ticketlake.operators import dense, sparse
from ticketlake.operators.ordering import top_k
from ticketlake.operators.relational import drop_duplicates_ordered, fetch_by_rank


def rank_union(**lists: DataFrame) -> DataFrame:
    """Concatenate ranked lists under their retriever names."""
    return reduce(
        DataFrame.unionByName,
        [d.select(F.lit(name).alias("retriever"), "query_id", "doc", "rank", F.col("score").cast("double").alias("score")) for name, d in lists.items()],
    )


def rrf(ranked: DataFrame, k: int = R.RRF_K) -> DataFrame:
    """Sum of 1 / (k + rank) per query and document. A missing branch simply adds nothing."""
    return ranked.groupBy("query_id", "doc").agg(F.round(F.sum(1.0 / (k + F.col("rank"))), 8).alias("rrf_score"))


def hybrid_search(index: sparse.SparseIndex, vectors: DataFrame, queries: DataFrame, query_vectors: DataFrame, k: int, branch_k: int | None = None, dense_filter: Column | None = None) -> DataFrame:
    """BM25 and dense top lists fused by reciprocal rank, then the k best per query.

    ``dense_filter`` restricts the dense branch only.
    """
    n = branch_k or k
    docs = vectors if dense_filter is None else vectors.filter(dense_filter)
    bm25 = sparse.bm25_search(index, queries, n)
    near = dense.dense_search(docs, query_vectors, n)
    fused = rrf(rank_union(bm25=bm25, dense=near))
    return top_k(fused, "query_id", [F.col("rrf_score").desc(), F.col("doc")], k)


def hybrid_search_v2(index: sparse.SparseIndex, vectors: DataFrame, queries: DataFrame, query_vectors: DataFrame, k: int = R.HYBRID_K, branch_k: int = R.BRANCH_K, allowed: DataFrame | None = None) -> DataFrame:
    """Sparse dot products and dense scores fused by reciprocal rank.

    ``allowed`` (``doc``) restricts the dense branch only, as the service's metadata filter does.
    """
    docs = vectors if allowed is None else vectors.join(allowed.select("doc").distinct(), "doc", "left_semi")
    fused = rrf(rank_union(sparse=sparse.sparse_search(index, queries, branch_k), dense=dense.dense_search(docs, query_vectors, branch_k)))
    return top_k(fused, "query_id", [F.col("rrf_score").desc(), F.col("doc")], k)


def metadata_filter(conditions: dict) -> Column:
    """Exact match on every given column."""
    return reduce(lambda a, b: a & b, [X.is_true(F.col(c) == F.lit(v)) for c, v in conditions.items()], F.lit(True))


# ---- rerank --------------------------------------------------------------------------------------
def overlap_scorer(queries: pd.Series, texts: pd.Series) -> list[float]:
    """Stand-in pair scorer: shared distinct words over all distinct words."""
    out = []
    for q, t in zip(queries, texts):
        a, b = set((q or "").lower().split()), set((t or "").lower().split())
        out.append(round(len(a & b) / len(a | b), 6) if a | b else 0.0)
    return out


def overlap_score(a, b) -> Column:
    """The same score as an expression: distinct words of both texts over all distinct words."""
    one, other = (F.array_distinct(T.words(F.lower(X._c(x)))) for x in (a, b))
    both = F.size(F.array_union(one, other))
    return X.rounded(F.coalesce(F.size(F.array_intersect(one, other)) / F.nullif(both.cast("double"), F.lit(0.0)), F.lit(0.0)), 6)


def rerank_by(candidates: DataFrame, k: int, score: Column) -> DataFrame:
    """The k best candidates of each query by an expression, ties by document id."""
    return top_k(candidates.withColumn("rerank_score", score), "query_id", [F.col("rerank_score").desc(), F.col("doc")], k, "rerank_rank")


def rerank(candidates: DataFrame, k: int, scorer: Callable[[pd.Series, pd.Series], list[float]] | None = overlap_scorer, fallback: str = "rrf_score") -> DataFrame:
    """Score (query_text, text) pairs in batches and keep the k best; without a scorer use ``fallback``."""
    if scorer is None:
        scored = candidates.withColumn("rerank_score", F.col(fallback).cast("double"))
    else:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in candidates.schema.fields)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield b.assign(rerank_score=scorer(b["query_text"], b["text"]) if len(b) else [])

        scored = candidates.mapInPandas(run, f"{fields}, rerank_score double")
        scored = scored.withColumn("rerank_score", F.coalesce("rerank_score", F.col(fallback).cast("double")))
    return top_k(scored, "query_id", [F.col("rerank_score").desc(), F.col("doc")], k, "rerank_rank")


def parse_score(col) -> Column:
    """First number in a free text, clamped to 0..1; 0 where there is none."""
    number = F.regexp_extract(X._c(col), r"(\d+\.?\d*)", 1).try_cast("double")
    return F.least(F.greatest(F.coalesce(number, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))


# ---- solutions -----------------------------------------------------------------------------------
def solution_lookup(pairs: DataFrame) -> DataFrame:
    """Distinct id to (problem, solution)."""
    return drop_duplicates_ordered(
        pairs.select("rag_id", F.col("problem_text_clean").alias("problem_text"), F.col("solution_text_clean").alias("solution_text")),
        "rag_id",
        [F.col("problem_text"), F.col("solution_text")],
    )


def fetch_solutions(candidates: DataFrame, lookup: DataFrame) -> DataFrame:
    """Candidates in rank order with their solution; ``found`` tells the missing ones."""
    marked = lookup.withColumn("_found", F.lit(True))
    out = fetch_by_rank(candidates, marked, "rag_id", "query_id", "rank", {"problem_text": "", "solution_text": "", "_found": False})
    return out.withColumnRenamed("_found", "found")
