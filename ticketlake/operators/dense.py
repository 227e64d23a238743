"""Exact dense top-k and the batch embedding job.

Vectors are scored in Arrow blocks next to where they lie; each block emits its k best rows per
query. A small query batch (checked) travels with the job; a larger one is cut into query blocks and
joined to vector blocks, so neither side is ever held whole.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ticketlake.functions import vectors as V
from ticketlake.operators.ordering import top_k
from ticketlake.operators.relational import small_enough

BROADCAST_QUERIES = 4096
VECTORS_PER_BLOCK = 50_000
SCORED = "query_id string, doc string, score double"


def _unit(matrix: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, size, out=np.zeros_like(matrix), where=size > 0)


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _best(ids: np.ndarray, vectors: np.ndarray, qids: np.ndarray, queries: np.ndarray, k: int) -> pd.DataFrame:
    """k best rows per query; ties at the cut are all kept so that the final order decides."""
    scores = np.round(_unit(queries) @ _unit(vectors).T, 6)
    picked = []
    for line in scores:
        if len(line) > k:
            cut = np.partition(line, len(line) - k)[len(line) - k]
            pick = np.flatnonzero(line >= cut)
        else:
            pick = np.arange(len(line))
        if len(pick) > k:  # many equal scores: smallest ids win
            pick = pick[np.lexsort((ids[pick], -line[pick]))[:k]]
        picked.append(pick)
    owner = np.repeat(np.arange(len(picked)), [len(p) for p in picked])
    column = np.concatenate([np.zeros(0, np.int64), *picked])
    return pd.DataFrame({"query_id": qids[owner], "doc": ids[column], "score": scores[owner, column]})


def no_scores() -> pd.DataFrame:
    """An empty result with the types of a filled one."""
    return pd.DataFrame({"query_id": np.zeros(0, object), "doc": np.zeros(0, object), "score": np.zeros(0)})


def _prepared(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("id"), V.as_double(vector).alias("v")).filter(F.col("v").isNotNull())


def dense_search(vectors: DataFrame, queries: DataFrame, k: int, key="doc", vector="embedding", query="query_id", max_broadcast=BROADCAST_QUERIES) -> DataFrame:
    """(query_id, doc, score, rank): exact top-k by cosine, ties by document id."""
    docs, asked = _prepared(vectors, key, vector), _prepared(queries, query, vector)
    scored = _with_small_batch(docs, asked, k) if small_enough(asked, max_broadcast) else _in_blocks(docs, asked, k)
    return top_k(scored, "query_id", [F.col("score").desc(), F.col("doc")], k)


def _with_small_batch(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    batch = asked.toPandas()  # bounded by the caller's check
    if batch.empty:
        return docs.sparkSession.createDataFrame([], SCORED)
    qids, matrix = batch["id"].to_numpy(dtype=object), _stack(batch["v"])

    def score(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks:
            if len(block):
                yield _best(block["id"].to_numpy(dtype=object), _stack(block["v"]), qids, matrix, k)

    return docs.mapInPandas(score, SCORED)


def _in_blocks(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Vector blocks x query blocks, each pair one bounded task."""
    n_docs = max(1, -(-docs.count() // VECTORS_PER_BLOCK))
    n_asked = max(1, -(-asked.count() // BROADCAST_QUERIES))

    def blocks(df: DataFrame, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(own_n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1)))
        )

    left = blocks(docs, "db", n_docs, "qb", n_asked)
    right = blocks(asked, "qb", n_asked, "db", n_docs)

    def score(block: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(batch):
            return no_scores()
        return _best(block["id"].to_numpy(dtype=object), _stack(block["v"]), batch["id"].to_numpy(dtype=object), _stack(batch["v"]), k)

    return left.groupBy("db", "qb").cogroup(right.groupBy("db", "qb")).applyInPandas(score, SCORED)


def label_centroids(embeddings: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """Mean vector per label, aggregated per dimension (a hot label is summed map-side)."""
    dims = embeddings.select(F.col(label).cast("string").alias("query_id"), F.posexplode(V.as_double(vector)).alias("pos", "x"))
    means = dims.groupBy("query_id", "pos").agg(F.avg("x").alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy("query_id").agg(F.transform(ordered, lambda s: s["x"]).alias("embedding"))


# ---- embedding job -------------------------------------------------------------------------------
_WORD = re.compile(r"[^\W]+", re.UNICODE)


@lru_cache(maxsize=200_000)
def _slot(token: str, dims: int) -> tuple[int, float]:
    digest = hashlib.md5(token.encode()).hexdigest()
    return int(digest[:4], 16) % dims, 1.0 if int(digest[4], 16) % 2 == 0 else -1.0


def hashing_encoder(texts: list[str], dims: int = 64) -> np.ndarray:
    """Offline stand-in encoder: signed hashed bag of words (whole numbers, exact in float32)."""
    out = np.zeros((len(texts), dims))
    for i, text in enumerate(texts):
        for token in _WORD.findall((text or "").lower()):
            dim, sign = _slot(token, dims)
            out[i, dim] += sign
    return out


def embed(df: DataFrame, text: str, encoder: Callable[[list[str]], np.ndarray] = hashing_encoder, encoder_id: str = "hashing-64", output: str = "embedding", normalize: bool = True) -> DataFrame:
    """Encode texts batch by batch with any ``list[str] -> matrix`` callable; the encoder id is kept."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = encoder(batch[text].fillna("").tolist()) if len(batch) else np.zeros((0, 1))
            vectors = _unit(vectors) if normalize else vectors
            yield batch.assign(**{output: [v.astype(np.float32) for v in vectors], "encoder_id": encoder_id})

    return df.mapInPandas(run, f"{fields}, `{output}` array<float>, encoder_id string")


def nearest_lsh(vectors: DataFrame, queries: DataFrame, k: int, key="doc", vector="embedding", query="query_id", tables: int = 8, width: float = 0.5, seed: int = 42) -> DataFrame:
    """Approximate variant: random-projection buckets on unit vectors, then exact scores of the bucket mates.

    Buckets are doubled until every query has k neighbours (or all vectors, if there are fewer).
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    def unit(df: DataFrame, col: str, name: str) -> DataFrame:
        return df.select(F.col(col).cast("string").alias(name), V.l2_normalize(vector).alias("a")).select(
            name, "a", array_to_vector("a").alias("v")
        )

    docs, asked = unit(vectors, key, "doc"), unit(queries, query, "query_id")
    wanted = docs.limit(k).count()
    while True:
        model = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", numHashTables=tables, bucketLength=width, seed=seed).fit(docs)
        near = model.approxSimilarityJoin(docs, asked, 2.01, "dist")  # no two unit vectors are farther apart
        scored = near.select(
            F.col("datasetB.query_id").alias("query_id"), F.col("datasetA.doc").alias("doc"),
            F.round(1 - F.col("dist") * F.col("dist") / 2, 6).alias("score"),
        )
        found = asked.select("query_id").join(scored.groupBy("query_id").agg(F.count("*").alias("n")), "query_id", "left")
        if width > 4 or found.filter(F.coalesce("n", F.lit(0)) < wanted).isEmpty():
            break
        width *= 2
    return top_k(scored, "query_id", [F.col("score").desc(), F.col("doc")], k)
