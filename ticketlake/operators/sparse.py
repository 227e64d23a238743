"""BM25 and TF-IDF over token arrays.

The index is partitioned by document: tokens are shuffled once by document id and everything per
document (term counts, scores of all queries) is aggregated in place. Only the per-term document
counts and the k best rows per query and partition cross the network again; a saved index is bucketed by document and skips even the first shuffle. A term that occurs in
most documents is spread over all partitions.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ticketlake import rules as R
from ticketlake.functions import text as T
from ticketlake.operators.ordering import number_in_order, top_k
from ticketlake.operators.relational import small_enough

#: distinct (query, term) rows up to which the query side is broadcast; beyond it the join shuffles
BROADCAST_QUERY_TERMS = 500_000
#: terms of the index that are broadcast with their document counts; postings of rarer terms are joined by a shuffle
BROADCAST_TERMS = 500_000
#: queries that are scored at once, cells of a dense block of documents, and candidates a task keeps before it cuts them
BATCH_QUERIES, BLOCK_CELLS, KEPT_ROWS = 128, 2_000_000, 1_000_000


@dataclass
class SparseIndex:
    postings: DataFrame  # doc, term, tf, dl
    terms: DataFrame  # term, df, idf
    docs: DataFrame  # doc, and pos (its place in id order) once saved
    stats: DataFrame  # one row: n_docs, avgdl
    texts: DataFrame | None = None  # doc, _t (its tokens) until saved


def _postings(placed: DataFrame) -> DataFrame:
    """Term counts of rows that are partitioned by doc, counted where they lie."""
    exploded = placed.select("doc", F.size("_t").alias("dl"), F.explode("_t").alias("term"))
    return exploded.groupBy("doc", "term", "dl").agg(F.count("*").alias("tf"))


def _with_idf(dfs: DataFrame, n: Column) -> DataFrame:
    raw = dfs.withColumn("raw_idf", F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    floor = raw.agg(F.avg("raw_idf") * R.BM25_EPSILON).scalar()
    return raw.select("term", "df", F.when(F.col("raw_idf") < 0, floor).otherwise(F.col("raw_idf")).alias("idf"))


def _frequencies(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(F.count("*").alias("df"))


def build_index(df: DataFrame, doc: str, tokens: str) -> SparseIndex:
    docs = df.select(F.col(doc).alias("doc"), F.col(tokens).alias("_t"))
    postings = _postings(docs.repartition("doc"))
    # sizes are taken before anything moves, so the tokens travel for the postings alone
    stats = docs.agg(F.count("*").alias("n_docs"), F.avg(F.size("_t")).alias("avgdl"))
    n = docs.agg(F.count("*").cast("double")).scalar()
    return SparseIndex(postings, _with_idf(_frequencies(postings), n), docs.select("doc"), stats, docs)


def query_weights(queries: DataFrame, terms: DataFrame, query: str, text: str) -> DataFrame:
    """(query, term) weights: occurrences in the query times idf; unknown terms drop out."""
    asked = (
        queries.select(F.col(query).alias("query_id"), F.explode(T.query_tokens(text)).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count("*").alias("qtf"))
    )
    return asked.join(terms, "term").select("query_id", "term", (F.col("qtf") * F.col("idf")).alias("w"))


def bm25_scores(index: SparseIndex, weights: DataFrame, avgdl) -> DataFrame:
    k1, b = R.BM25_K1, R.BM25_B
    side = F.broadcast(weights) if small_enough(weights, BROADCAST_QUERY_TERMS) else weights
    hit = F.col("w") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / avgdl))
    return index.postings.join(side, "term").groupBy("doc", "query_id").agg(F.round(F.sum(hit), 6).alias("score"))


def _leading(query: np.ndarray, place: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k best of each query, ties by place."""
    order = np.lexsort((place, -score, query))
    first = np.flatnonzero(np.diff(query[order], prepend=-1))
    within = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[within < k]


def best_in_place(postings: DataFrame, weights: DataFrame, share: Callable[[Column, Column, Column], Column], k: int, digits: int) -> DataFrame:
    """`query_id, doc, score`: all rows with a score above 0 that can be among the k best of a query, by sums of share times `w`.

    Documents are met where they lie, with their terms that any query asks for; a task multiplies blocks of documents with
    the weights and keeps k rows a query, so no row for each document and query is made. `weights` (`query_id, term, w`) is
    bounded by the caller's check; no `w` may be negative. `share` is a function of tf, dl and the document's sum of tf.
    """
    asked = weights.filter("w > 0").toArrow()
    names, query = _codes(asked.column("query_id"))
    terms, code = _codes(asked.column("term"))
    w = np.asarray(asked.column("w").combine_chunks()).astype(np.float64)
    spark = postings.sparkSession
    known = spark.createDataFrame(pa.table({"term": terms.cast(pa.string()), "code": pa.array(np.arange(len(terms)), pa.int32())}))
    found = postings.join(F.broadcast(known), "term", "left")
    hit = F.when(F.col("code").isNotNull(), F.struct("code", F.col("tf").cast("double").alias("tf"), F.col("dl").cast("double").alias("dl")))
    docs = found.groupBy("doc").agg(F.collect_list(hit).alias("hits"), F.sum("tf").cast("double").alias("total")).filter(F.size("hits") > 0)
    x = F.transform("hits", lambda h: share(h["tf"], h["dl"], F.col("total")))
    docs = docs.select("doc", F.col("hits.code").alias("code"), x.alias("x"))
    kind = postings.schema["doc"].dataType.simpleString()
    batches = []
    for a in range(0, len(names), BATCH_QUERIES):
        on = np.flatnonzero((query >= a) & (query < a + BATCH_QUERIES))
        own, local = np.unique(code[on], return_inverse=True)
        matrix = np.zeros((len(own), min(BATCH_QUERIES, len(names) - a)))
        np.add.at(matrix, (local, query[on] - a), w[on])
        batches.append((a, own, matrix))

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def cut() -> list[tuple[pa.Array, np.ndarray, np.ndarray]]:
            ids = pa.concat_arrays([i for i, _, _ in kept])
            q, score = (np.concatenate([x[c] for x in kept]) for c in (1, 2))
            rows = _leading(q, _places(ids), score, k)
            return [(ids.take(pa.array(rows)), q[rows], score[rows])]

        for block in blocks:
            ids, lists, values = block.column("doc"), block.column("code"), np.asarray(block.column("x").flatten())
            codes, sizes = np.asarray(lists.flatten()), np.asarray(lists.value_lengths())
            if not len(codes):
                continue
            row, place = np.repeat(np.arange(len(sizes)), sizes), _places(ids)
            for start, own, matrix in batches:
                at = np.minimum(np.searchsorted(own, codes), len(own) - 1)
                on = np.flatnonzero(own[at] == codes)
                step = max(1, BLOCK_CELLS // len(own))
                bounds = np.searchsorted(row[on], np.arange(0, len(sizes) + step, step))
                for b, (i, j) in enumerate(zip(bounds[:-1], bounds[1:])):
                    if i == j:
                        continue
                    part = on[i:j]
                    dense = np.zeros((min(step, len(sizes) - b * step), len(own)))
                    np.add.at(dense, (row[part] - b * step, at[part]), values[part])
                    scores = dense @ matrix
                    # at least the k-th best of each query; equal ones are told apart by the cut
                    least = np.partition(scores, -k, axis=0)[-k] if len(scores) > k else np.zeros(scores.shape[1])
                    d, q = np.nonzero((scores > 0) & (scores >= least - 10.0**-digits))
                    score = np.round(scores[d, q], digits)
                    best = _leading(q, place[d + b * step], score, k)
                    kept.append((ids.take(pa.array(d[best] + b * step)), q[best] + start, score[best]))
            if sum(len(q) for _, q, _ in kept) > KEPT_ROWS:
                kept = cut()
        if kept:
            ids, q, score = cut()[0]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(q)), ids, pa.array(score)], ["query_id", "doc", "score"])

    return docs.mapInArrow(run, f"query_id {weights.schema['query_id'].dataType.simpleString()}, doc {kind}, score double")


def _codes(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Different values, null among them, and the number of each row's value."""
    coded = pc.dictionary_encode(column.combine_chunks(), null_encoding="encode")
    return coded.dictionary, np.asarray(coded.indices).astype(np.int64)


def _places(ids: pa.Array) -> np.ndarray:
    """Place of each id in their order, null first."""
    place = np.empty(len(ids), np.int64)
    place[np.asarray(pc.array_sort_indices(ids, null_placement="at_start")).astype(np.int64)] = np.arange(len(ids))
    return place


def fill_zero_scores(scored: DataFrame, queries: DataFrame, docs: DataFrame, query: str, k: int) -> DataFrame:
    """Add the zero-score documents that a top-k may need.

    A query with m hits needs at most k - m others in id order, and those are among the k smallest
    ids. Adding zero to a document that was hit changes nothing, so one aggregation merges both.
    """
    first = docs.orderBy("doc").limit(k)
    listed = first.agg(F.sort_array(F.collect_list("doc"))).scalar()
    blank = queries.select(F.col(query).alias("query_id"), F.explode(listed).alias("doc"), F.lit(0.0).alias("score"))
    return scored.select("query_id", "doc", "score").unionByName(blank).groupBy("query_id", "doc").agg(F.sum("score").alias("score"))


def fill_below_zero(scored: DataFrame, queries: DataFrame, docs: DataFrame, query: str, k: int) -> DataFrame:
    """Zero-score rows where hits may score below zero (most terms in most documents).

    Then k documents without a hit can be needed, and they are among the first k + m ids of a query
    with m hits. Documents are numbered in id order and joined by position.
    """
    numbered = docs if "pos" in docs.columns else number_in_order(docs, "doc", "pos", start=1)
    hits = scored.groupBy("query_id").agg(F.count("*").alias("m"))
    asked = queries.select(F.col(query).alias("query_id")).join(hits, "query_id", "left")
    wanted = asked.select("query_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(k) + F.coalesce("m", F.lit(0)))).alias("pos"))
    blank = wanted.join(numbered.select("pos", "doc"), "pos").select("query_id", "doc", F.lit(0.0).alias("score"))
    return scored.select("query_id", "doc", "score").unionByName(blank).groupBy("query_id", "doc").agg(F.sum("score").alias("score"))


def bm25_search(index: SparseIndex, queries: DataFrame, k: int, query: str = "query_id", text: str = "text") -> DataFrame:
    """Top-k per query by BM25, zero scores filling up, ties by document id."""
    weights = query_weights(queries, index.terms, query, text)
    order = [F.col("score").desc(), F.col("doc")]
    lowest = index.terms.agg(F.min("idf")).first()[0]
    if lowest is not None and lowest < 0:
        return top_k(fill_below_zero(bm25_scores(index, weights, index.stats.select("avgdl").scalar()), queries, index.docs, query, k), "query_id", order, k)
    # no score is negative: the best k of each query are enough
    if small_enough(weights, BROADCAST_QUERY_TERMS):
        k1, b, mean = R.BM25_K1, R.BM25_B, F.lit(index.stats.first()["avgdl"])
        scored = best_in_place(index.postings, weights, lambda tf, dl, total: tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / mean)), k, 6)
    else:
        scored = bm25_scores(index, weights, index.stats.select("avgdl").scalar())
    best = top_k(scored, "query_id", order, k, "_r").drop("_r")
    return top_k(fill_zero_scores(best, queries, index.docs, query, k), "query_id", order, k)


def save_index(index: SparseIndex, folder: str, bucket_rows: int = 1_000_000, least: int = 8) -> SparseIndex:
    """Write the index once and read it back: postings bucketed by document, small tables as files.

    The number of buckets follows the number of tokens, so a bucket stays one task's work at any size. The tokens are
    partitioned into these very buckets: they move once, and a bucket is one file. Everything else comes from what is written.
    """
    spark = index.postings.sparkSession
    name = "idx_" + uuid.uuid4().hex
    tokens = index.texts.agg(F.sum(F.greatest(F.size("_t"), F.lit(0)))).first()[0] or 0
    buckets = max(least, -(-tokens // bucket_rows))
    postings = _postings(index.texts.repartition(buckets, "doc"))
    postings.write.bucketBy(buckets, "doc").option("path", f"{folder}/postings").format("parquet").saveAsTable(name)
    index.stats.write.parquet(f"{folder}/stats")
    _frequencies(spark.table(name)).write.parquet(f"{folder}/frequencies")
    n = spark.read.parquet(f"{folder}/stats").agg(F.max("n_docs").cast("double")).scalar()
    _with_idf(spark.read.parquet(f"{folder}/frequencies"), n).write.parquet(f"{folder}/terms")
    number_in_order(index.docs, "doc", "pos", start=1).write.parquet(f"{folder}/docs")
    return SparseIndex(postings=spark.table(name), **{part: spark.read.parquet(f"{folder}/{part}") for part in ("terms", "docs", "stats")})


def _with_term_values(postings: DataFrame, values: DataFrame) -> DataFrame:
    """`postings` with the columns of `values` (`term, df, ...`, one row a term); other terms drop out.

    The most frequent terms, which have most of the postings, are broadcast, so only postings of rare terms are shuffled.
    """
    if small_enough(values, BROADCAST_TERMS):
        return postings.join(F.broadcast(values), "term")
    # the k-th largest df is at most all of them over k, so at most BROADCAST_TERMS terms lie above it
    least = -(-values.agg(F.sum("df")).first()[0] // BROADCAST_TERMS)
    frequent = values.filter(F.col("df") > least)
    rare = postings.join(F.broadcast(frequent.select("term")), "term", "left_anti")
    return postings.join(F.broadcast(frequent), "term").unionByName(rare.join(values.filter(F.col("df") <= least), "term"))


def sparse_vectors(index: SparseIndex, length_floor: int = 2) -> DataFrame:
    """(doc, term, value) TF-IDF rows with the smoothed idf; only positive values.

    tf is the share of the document's tokens that are at least ``length_floor`` characters long.
    """
    n = index.docs.agg(F.count("*").cast("double")).scalar()
    kept = index.postings.filter((F.char_length("term") >= length_floor) & F.col("doc").isNotNull())
    shares = kept.select("doc", "term", (F.col("tf") / F.sum("tf").over(Window.partitionBy("doc"))).alias("share"))
    # the smoothed idf is a function of df, so a term brings no more than that
    met = _with_term_values(shares, index.terms.select("term", "df"))
    value = F.col("share") * F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return met.select("doc", "term", value.alias("value")).filter(F.col("value") > 0)


def sparse_queries(index: SparseIndex, queries: DataFrame, query: str = "query_id", text: str = "text", length_floor: int = 2) -> DataFrame:
    """(query_id, term, value) of the query side: share of the query's tokens times the same smoothed idf.

    Tokens that the index does not know count in the share and have no value.
    """
    n = index.docs.agg(F.count("*").cast("double")).scalar()
    tokens = F.filter(T.bm25_tokens(text), lambda x: F.char_length(x) >= length_floor)
    asked = queries.select(F.col(query).alias("query_id"), tokens.alias("_t")).select("query_id", F.size("_t").alias("total"), F.explode("_t").alias("term"))
    counts = asked.groupBy("query_id", "term", "total").agg(F.count("*").alias("tf"))
    idf = index.terms.select("term", F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("sidf"))
    value = F.col("tf") / F.col("total") * F.col("sidf")
    return counts.join(idf, "term").select("query_id", "term", value.alias("value")).filter(F.col("value") > 0)


def sparse_search(index: SparseIndex, queries: DataFrame, k: int, query: str = "query_id", text: str = "text") -> DataFrame:
    """The k documents with the largest dot product per query; documents that share no term are not returned."""
    asked = sparse_queries(index, queries, query, text).withColumnRenamed("value", "asked")
    if small_enough(asked, BROADCAST_QUERY_TERMS):
        n = index.docs.agg(F.count("*").cast("double")).scalar()
        sidf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
        weights = asked.join(index.terms, "term").select("query_id", "term", (F.col("asked") * sidf).alias("w"))
        kept = index.postings.filter(F.char_length("term") >= 2)
        scored = best_in_place(kept, weights, lambda tf, dl, total: tf / total, k, 8)
    else:
        scored = sparse_vectors(index).join(asked, "term").groupBy("doc", "query_id").agg(F.round(F.sum(F.col("value") * F.col("asked")), 8).alias("score"))
    return top_k(scored, "query_id", [F.col("score").desc(), F.col("doc")], k)


def hashed_vector(df: DataFrame, doc: str, tokens: str, dims: int = 1 << 20) -> DataFrame:
    """(doc, dim, count): one stable hash for index and query side."""
    return (
        df.select(F.col(doc).alias("doc"), F.explode(tokens).alias("term"))
        .withColumn("dim", F.pmod(F.xxhash64("term"), F.lit(dims)).cast("int"))
        .groupBy("doc", "dim")
        .agg(F.count("*").alias("value"))
    )
