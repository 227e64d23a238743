"""Inverted lists of vectors: search that only meets lists which can hold one of the k nearest.

Coarse centroids are fitted on a bounded sample; every vector is stored in the list of its nearest centroid, in rings by its
angle to it. On the sphere angles obey the triangle inequality, so a query at angle a from a centroid is at least |a - b| away
from a vector at angle b. A search scores a query's nearest lists first; the k-th score found so far is a level, and every
further ring whose bound reaches it is read too. With that second step the result is exact; without it a search reads a
fixed number of lists, and `recall` says what that costs.

Query batches meet lists in an equi-join of list parts of bounded size, so neither a hot list nor a large batch is one task.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from ticketlake.functions import vectors as V
from ticketlake.operators import dense as D
from ticketlake.operators.ordering import top_k
from ticketlake.session import checkpoint_dir

#: Vectors that centroids are fitted on, most lists, rings of a list, rows of a list part and queries that meet it at once.
SAMPLE, MOST_LISTS, RINGS, PART_ROWS, QUERY_ROWS = 50_000, 4096, 8, 20_000, 2048
#: Lists that a query meets first.
PROBES = 4
_SLACK = 1e-6


@dataclass
class VectorLists:
    vectors: DataFrame  # list, ring, part, id, v (unit, or zero)
    cells: DataFrame  # list, ring, part, n, low, high (angles to the centroid)
    centroids: np.ndarray


def _units(df: DataFrame, key: str, vector: str) -> DataFrame:
    """`id, v` with unit vectors; rows with a null vector, or null or non-finite components, are left out."""
    plain = df.select(F.col(key).cast("string").alias("id"), V.as_double(vector).alias("v")).filter(F.col("v").isNotNull())
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return plain.filter(finite).select("id", V.l2_normalize("v").alias("v"))


def _centroids(units: DataFrame, lists: int, seed: int) -> np.ndarray:
    """Unit centroids of a sample of bounded size: the vectors with the smallest id hashes."""
    some = units.filter(F.exists("v", lambda x: x != 0)).select("v", F.xxhash64("id").alias("h")).orderBy("h").limit(SAMPLE)
    if lists == 1:
        mean = some.select(F.posexplode("v").alias("k", "x")).groupBy("k").agg(F.avg("x").alias("x")).orderBy("k").collect()
        return D._unit(np.array([[r.x for r in mean]]))
    fitted = KMeans(k=lists, seed=seed, maxIter=10, featuresCol="f").fit(some.select(array_to_vector("v").alias("f")))
    return D._unit(np.array(fitted.clusterCenters(), np.float64))


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def build_lists(df: DataFrame, key: str = "doc", vector: str = "embedding", lists: int | None = None, seed: int = 42) -> VectorLists:
    """Store the vectors by list and ring. `lists`: about the square root of their number if not given.

    Zero vectors are list -1. Vectors must be of one length.
    """
    spark = df.sparkSession
    units = _units(df, key, vector)
    n = units.count()
    folder = f"{checkpoint_dir(spark)}/lists-{uuid.uuid4().hex}"
    lists = max(1, min(lists or round(n**0.5), MOST_LISTS, n))
    centroids = _centroids(units, lists, seed) if units.filter(F.exists("v", lambda x: x != 0)).limit(lists).count() == lists else np.zeros((0, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.asarray(batch.column("v").flatten()).reshape(batch.num_rows, -1)
            place, angle = np.full(len(v), -1), np.zeros(len(v))
            some = np.flatnonzero(v.any(axis=1)) if v.shape[1] else np.zeros(0, int)
            for at in range(0, len(some) if len(centroids) else 0, 1024):
                own = some[at : at + 1024]
                near = _angles(v[own], centroids)
                place[own] = near.argmin(axis=1)
                angle[own] = near[np.arange(len(own)), place[own]]
            ring = np.minimum((angle / np.pi * 2 * RINGS).astype(np.int32), RINGS - 1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(place.astype(np.int32)), pa.array(ring), pa.array(angle)], ["id", "v", "list", "ring", "angle"])

    placed = units.mapInArrow(run, "id string, v array<double>, list int, ring int, angle double")
    placed.write.parquet(f"{folder}/placed")
    placed = spark.read.parquet(f"{folder}/placed")
    sizes = placed.groupBy("list", "ring").agg(F.count("*").alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high"))
    sizes = sizes.withColumn("parts", F.ceil(F.col("n") / PART_ROWS).cast("int"))
    # there are at most MOST_LISTS * RINGS + 1 rings
    parted = placed.join(F.broadcast(sizes.select("list", "ring", "parts")), ["list", "ring"])
    parted = parted.select("list", "ring", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "id", "v")
    parted.repartitionByRange("list", "ring", "part").sortWithinPartitions("list", "ring", "part").write.parquet(f"{folder}/vectors")
    cells = sizes.select("list", "ring", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "n", "low", "high")
    cells.coalesce(1).write.parquet(f"{folder}/cells")
    return VectorLists(spark.read.parquet(f"{folder}/vectors"), spark.read.parquet(f"{folder}/cells"), centroids)


def _chosen(index: VectorLists, asked: DataFrame, first: int, level: bool) -> DataFrame:
    """`list, ring, part, id, v`: cells that a query meets. level False: those of its `first` nearest lists; else all others
    whose bound reaches the query's `level` (null: all)."""
    rows = index.cells.orderBy("list", "ring", "part").toPandas()  # a bounded number of rings and their parts
    lists, low, high = rows["list"].to_numpy(), rows["low"].to_numpy(), rows["high"].to_numpy()
    centroids = index.centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[np.ndarray] = []
            for r in range(batch.num_rows):
                q = np.asarray(batch.column("v")[r].values)
                angle = _angles(q[None], centroids)[0] if len(centroids) else np.zeros(0)
                near = np.argsort(angle, kind="stable")[:first]
                mine = (lists < 0) | np.isin(lists, near) if q.any() else np.zeros(len(lists), bool)
                if level:
                    at = angle[np.maximum(lists, 0)] if len(angle) else np.zeros(len(lists))
                    best = np.cos(np.maximum(np.maximum(low - at, at - high), 0))
                    known = batch.column("level")[r].as_py()
                    mine = ~mine & ((best >= known - _SLACK) if known is not None and q.any() else True)
                out.append(np.flatnonzero(mine))
            owner = np.repeat(np.arange(len(out)), [len(x) for x in out])
            cell = np.concatenate([np.zeros(0, np.int64), *out]).astype(np.int64)
            met = batch.select(["id", "v"]).take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(rows[c].to_numpy()[cell].astype(np.int32)) for c in ("list", "ring", "part")), *met.columns], ["list", "ring", "part", "id", "v"]
            )

    return asked.mapInArrow(run, "list int, ring int, part int, id string, v array<double>")


def _scored(index: VectorLists, chosen: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query in each list part, and how many rows each part has."""

    def run(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(asked):
            return D.no_scores()
        return D._best(vectors["id"].to_numpy(dtype=object), D._stack(vectors["v"]), asked["id"].to_numpy(dtype=object), D._stack(asked["v"]), k)

    spark = index.vectors.sparkSession
    path = f"{checkpoint_dir(spark)}/chosen-{uuid.uuid4().hex}"
    chosen.write.parquet(path)
    place, cell = ["list", "ring", "part"], ["list", "ring", "part", "batch"]

    def batches() -> DataFrame:
        # queries of a part go in batches, so that a part which every query meets is several tasks; no more rows than cells
        counts = spark.read.schema(chosen.schema).parquet(path).groupBy(*place)
        return F.broadcast(counts.agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("batches")))

    met = spark.read.schema(chosen.schema).parquet(path).join(batches(), place).withColumn("batch", F.pmod(F.xxhash64("id"), F.col("batches")).cast("int"))
    held = index.vectors.join(batches(), place).withColumn("batch", F.explode(F.sequence(F.lit(0), F.col("batches") - 1)))
    return held.groupBy(*cell).cogroup(met.groupBy(*cell)).applyInPandas(run, D.SCORED)


def search_lists(index: VectorLists, queries: DataFrame, k: int, vector: str = "embedding", query: str = "query_id", probes: int = PROBES, exact: bool = True) -> DataFrame:
    """`query_id, doc, score, rank`: the k nearest by cosine, ties by id; exact as `dense.dense_search`, unless `exact` is off.

    Queries with a null vector, or null or non-finite components, get no rows. A zero query has cosine 0 with everything and
    meets all lists.
    """
    spark = index.vectors.sparkSession
    asked = _units(queries, query, vector)
    folder = f"{checkpoint_dir(spark)}/probes-{uuid.uuid4().hex}"
    _scored(index, _chosen(index, asked, probes, False), k).write.parquet(f"{folder}/first")
    found = spark.read.schema(D.SCORED).parquet(f"{folder}/first")
    order = [F.col("score").desc(), F.col("doc")]
    if exact:
        level = top_k(found, "query_id", order, k).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("level"))
        found = found.unionByName(_scored(index, _chosen(index, asked.join(level, "id", "left"), probes, True), k))
    return top_k(found, "query_id", order, k)


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: `wanted` pairs of the exact result, how many of them were `found`, and their share."""
    wanted = truth.select("query_id", "doc").join(found.select("query_id", "doc", F.lit(1).alias("hit")), ["query_id", "doc"], "left")
    counts = wanted.agg(F.count("*").alias("wanted"), F.count("hit").alias("found"))
    return counts.withColumn("recall", F.col("found") / F.nullif(F.col("wanted"), F.lit(0)))
