"""BM25 over postings in blocks, with blocks skipped that cannot reach a query's k-th score.

Documents are numbered in id order and cut into ranges. A block holds the postings of one term in one range, and the best
share that any of them can give to a score. Blocks are stored in term order, so the terms of a batch of queries, pushed to
the scan, leave out the row groups of all other terms.

A search first reads only the best shares: for a range, the sum over the query's terms bounds the score of every document in
it. The ranges with the best bounds are scored, which gives each query a score that its k-th document reaches at least; of
the others only the ranges whose bound reaches it are read. What is skipped cannot be in the result, so the result is that
of the full search, ties included.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ticketlake import rules as R
from ticketlake.operators.ordering import top_k
from ticketlake.operators.relational import small_enough
from ticketlake.operators.sparse import BROADCAST_QUERY_TERMS, SparseIndex, bm25_search, query_weights
from ticketlake.session import checkpoint_dir, cut_lineage

#: Documents in a range: few, so that its bound is near what one of them reaches.
RANGE = 4
#: Ranges of a query that are scored before its level is known: enough for a level near the final k-th score.
FIRST = 64
#: Distinct terms of a batch up to which their list is pushed to the scan; beyond it only the join selects.
PUSHED_TERMS = 20_000
#: Bytes of a row group of the stored blocks: small enough that the rows of few terms share one.
ROW_GROUP = 4 << 20
#: Postings that one task groups into blocks, and bounds (of a range and a query) that one task sums up.
PART_ROWS = 1_000_000
#: Scores are rounded to six digits.
_SLACK = 1e-6


@dataclass
class BlockIndex:
    blocks: DataFrame  # term, block, n, best, pos[], tf[], dl[]
    docs: DataFrame  # doc, pos
    index: SparseIndex
    avgdl: float


def _share(tf, dl, avgdl: float):
    """What one occurrence list adds to a score for a term of weight 1."""
    k1, b = R.BM25_K1, R.BM25_B
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))


def save_blocks(index: SparseIndex, folder: str, range_docs: int = RANGE, part_rows: int = PART_ROWS) -> BlockIndex:
    """Group the postings of a saved index into blocks and write them in order of term and range.

    The number of partitions follows the number of postings, so that what a task groups and sorts stays the same.
    """
    spark = index.postings.sparkSession
    avgdl = index.stats.select("avgdl").first()[0] or 1.0
    placed = index.postings.join(index.docs.select("doc", "pos"), "doc")
    share = _share(F.col("tf"), F.col("dl"), avgdl)
    posting = F.struct(F.col("pos"), F.col("tf").cast("int").alias("tf"), F.col("dl").cast("int").alias("dl"))
    placed = placed.withColumn("block", F.floor((F.col("pos") - 1) / range_docs).cast("bigint"))
    parts = max(spark.sparkContext.defaultParallelism, -(-(index.terms.agg(F.sum("df")).first()[0] or 0) // part_rows))
    # a range bounds every group by its number of documents
    grouped = placed.repartitionByRange(parts, "term", "block").groupBy("term", "block").agg(
        F.count("*").cast("int").alias("n"), F.max(share).alias("best"), F.sort_array(F.collect_list(posting)).alias("p")
    )
    flat = grouped.select("term", "block", "n", "best", F.col("p.pos").alias("pos"), F.col("p.tf").alias("tf"), F.col("p.dl").alias("dl"))
    ordered = flat.sortWithinPartitions("term", "block")
    ordered.write.option("parquet.block.size", ROW_GROUP).parquet(f"{folder}/blocks")
    return BlockIndex(spark.read.parquet(f"{folder}/blocks"), index.docs, index, avgdl)


def asked_blocks(blocks: DataFrame, weights: DataFrame) -> DataFrame:
    """Blocks of the terms in `weights`; a bounded list of terms is pushed to the scan."""
    terms = [r.term for r in weights.select("term").distinct().limit(PUSHED_TERMS + 1).collect()]
    return blocks.filter(F.col("term").isin(terms)) if len(terms) <= PUSHED_TERMS else blocks


def range_bounds(blocks: DataFrame, weights: DataFrame, parts: int | None = None) -> DataFrame:
    """`query_id, block, bound, n`: no document of the range scores above the bound; n postings meet the query there.

    A term of negative weight adds at most nothing, as a document may lack it. With `parts` the blocks are dealt out by
    range first, so that a task sums up few ranges; as stored, by term, every task would hold all ranges of all queries.
    """
    read = blocks.select("term", "block", "n", "best")
    met = (read.repartition(parts, "block") if parts else read).join(F.broadcast(weights) if parts else weights, "term")
    return met.groupBy("query_id", "block").agg(F.sum(F.greatest("w", F.lit(0.0)) * F.col("best")).alias("bound"), F.sum("n").alias("n"))


def score_ranges(blocks: DataFrame, weights: DataFrame, wanted: DataFrame, avgdl: float) -> DataFrame:
    """`query_id, pos, score` of every document that shares a term with a query in the wanted (`query_id, block`)."""
    lists = wanted.select("query_id", "block").join(weights, "query_id")
    met = blocks.select("term", "block", "pos", "tf", "dl").join(lists, ["term", "block"])
    each = met.select("query_id", "w", F.inline(F.arrays_zip("pos", "tf", "dl")))
    k1, b = R.BM25_K1, R.BM25_B
    hit = F.col("w") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / avgdl))
    return each.groupBy("query_id", "pos").agg(F.round(F.sum(hit), 6).alias("score"))


@dataclass
class Searched:
    scores: DataFrame  # query_id, pos, score of all documents that were scored
    ranges: DataFrame  # query_id, block, bound, n, first (scored before the level was known), read
    level: DataFrame  # query_id, level


def search_ranges(index: BlockIndex, weights: DataFrame, k: int) -> Searched:
    """Score the ranges that can hold one of the k best documents of a query."""
    blocks = asked_blocks(index.blocks, weights)
    most = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("bound").desc(), F.col("block")))
    pairs = -(-index.docs.count() // RANGE) * weights.select("query_id").distinct().count()
    few = small_enough(weights, BROADCAST_QUERY_TERMS)  # otherwise the join shuffles by term
    parts = max(blocks.sparkSession.sparkContext.defaultParallelism, -(-pairs // PART_ROWS)) if few else None
    bounds = cut_lineage(range_bounds(blocks, weights, parts))
    first = bounds.withColumn("order", most).filter(F.col("order") <= FIRST)
    seen = cut_lineage(score_ranges(blocks, weights, first, index.avgdl))
    kth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("pos")))
    level = seen.withColumn("order", kth).filter(F.col("order") == k).select("query_id", F.col("score").alias("level"))
    ranges = bounds.join(first.select("query_id", "block", F.lit(True).alias("first")), ["query_id", "block"], "left").join(level, "query_id", "left")
    reaches = F.col("level").isNull() | (F.col("bound") >= F.col("level") - _SLACK)
    ranges = ranges.select("query_id", "block", "bound", "n", F.coalesce("first", F.lit(False)).alias("first"), (F.coalesce("first", F.lit(False)) | reaches).alias("read"))
    more = score_ranges(blocks, weights, ranges.filter("read and not first"), index.avgdl)
    return Searched(seen.unionByName(more), ranges, level)


def pruned_search(index: BlockIndex, queries: DataFrame, k: int, query: str = "query_id", text: str = "text") -> DataFrame:
    """Top-k per query by BM25, as `sparse.bm25_search` gives it: zero scores fill up, ties by document id.

    A query whose k-th score is not above zero may need documents without any of its terms; such queries take the full
    search.
    """
    asked = queries.select(F.col(query).alias("query_id"), F.col(text).alias("text"))
    weights = cut_lineage(query_weights(asked, index.index.terms, "query_id", "text"))
    found = search_ranges(index, weights, k).scores
    best = cut_lineage(top_k(found, "query_id", [F.col("score").desc(), F.col("pos")], k))
    full = best.filter((F.col("rank") == k) & (F.col("score") > 0)).select("query_id")
    done = best.join(full, "query_id", "left_semi").join(index.docs.select("doc", "pos"), "pos").select("query_id", "doc", "score", "rank")
    rest = asked.join(full, "query_id", "left_anti")
    if rest.isEmpty():
        return done
    return done.unionByName(bm25_search(index.index, rest, k).select("query_id", "doc", "score", "rank"))


def new_folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/blocks-{uuid.uuid4().hex}"
