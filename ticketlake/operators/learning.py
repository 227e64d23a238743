"""ML preparation, triage training and prediction, metrics and anomaly models on Spark MLlib."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from ticketlake.functions import cleanse as X
from ticketlake.operators.ordering import top_k
from ticketlake.operators.selection import exact_quantiles
from ticketlake.session import written_once


# ---- preparation ---------------------------------------------------------------------------------
def select_features(df: DataFrame, candidates) -> DataFrame:
    """(feature, distinct values, keep): columns with one value carry nothing; one aggregation."""
    wide = df.agg(*[F.approx_count_distinct(c, 0.05).alias(c) for c in candidates], *[F.min(c).eqNullSafe(F.max(c)).alias(f"{c}__flat") for c in candidates])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("approx_distinct"), (~F.col(f"{c}__flat")).alias("keep")) for c in candidates])
    return wide.select(F.inline(rows))


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.25, salt: str = "42") -> DataFrame:
    """Mark ``is_test`` so that each class gives ``test_share`` of its rows.

    Rows are ordered by a keyed hash within their class and numbered through hash buckets, so a
    class that holds most rows is still numbered in parallel.
    """
    h = F.md5(F.concat(F.lit(salt + "|"), F.col(key).cast("string")))
    tagged = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, 3))
    sizes = tagged.groupBy(F.col(label).alias("_l"), F.col("_b").alias("_sb")).agg(F.count("*").alias("_n"))
    w = Window.partitionBy("_l").orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_l", "_sb", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_shift"), F.sum("_n").over(Window.partitionBy("_l")).alias("_total")
    )
    inside = Window.partitionBy(label, "_b").orderBy("_h", key)
    numbered = tagged.withColumn("_rn", F.row_number().over(inside))
    joined = numbered.join(shifts, F.col(label).eqNullSafe(F.col("_l")) & (F.col("_b") == F.col("_sb")))
    return joined.withColumn("is_test", F.col("_rn") + F.col("_shift") <= F.round(F.col("_total") * test_share)).select(*df.columns, "is_test")


def impute(df: DataFrame, columns, strategy: str = "median") -> DataFrame:
    """Missing values (null or NaN) as zero or as the exact median; a column without values stays as it is."""
    if strategy == "zero":
        return df.fillna(0, subset=list(columns))
    medians = exact_quantiles(df, columns, (0.5,))
    return as_doubles(df, columns).fillna({c: m[0] for c, m in medians.items() if m[0] is not None})


# ---- triage --------------------------------------------------------------------------------------
def train_classifier(df: DataFrame, target: str, features, trees: int = 200, depth: int = 6, seed: int = 42) -> PipelineModel:
    """Random forest as a storable pipeline; labels it has not seen are a class of their own."""
    index = StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep")
    assemble = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, subsamplingRate=0.8, seed=seed)
    known = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    return Pipeline(stages=[index, assemble, model]).fit(known.filter(F.col(target).isNotNull()))


def train_breach(sla: DataFrame, features, rounds: int = 100, depth: int = 5, seed: int = 42) -> PipelineModel:
    """SLA-breach classifier: medians of the training rows fill gaps inside the pipeline; the rare class weighs its inverse share."""
    share = sla.agg(F.avg(F.col("was_sla_breached").cast("double"))).first()[0] or 0.5
    weight = F.when(F.col("was_sla_breached") == 1, 0.5 / max(share, 1e-9)).otherwise(0.5 / max(1 - share, 1e-9))
    data = as_doubles(sla, features).withColumns({"weight": weight, "label": F.col("was_sla_breached").cast("double")})
    filled = [f"{c}_filled" for c in features]
    fill = Imputer(inputCols=list(features), outputCols=filled, strategy="median", relativeError=1e-6)
    assemble = VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(maxIter=rounds, maxDepth=depth, weightCol="weight", seed=seed)
    return Pipeline(stages=[fill, assemble, gbt]).fit(data)


def as_doubles(df: DataFrame, features) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in features})


# ---- metrics -------------------------------------------------------------------------------------
def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def class_metrics(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    sides = matrix.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed"), F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed"), F.lit(0).cast("bigint").alias("hit")),
            )
        )
    )
    per = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hit")])

    def share(a: str, b: str):
        return F.coalesce(F.col(a) / F.nullif(F.col(b).cast("double"), F.lit(0.0)), F.lit(0.0))

    per = per.withColumns({"precision": share("hit", "guessed"), "recall": share("hit", "support")})
    both = F.col("precision") + F.col("recall")
    return per.withColumn("f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / F.nullif(both, F.lit(0.0))).otherwise(0.0))


def summary_metrics(matrix: DataFrame) -> DataFrame:
    """Accuracy, macro F1, weighted F1 and macro recall in one row."""
    per = class_metrics(matrix)
    total = F.sum("support")
    return per.agg(
        X.rounded(F.sum("hit") / total, 4).alias("accuracy"), X.rounded(F.avg("f1"), 4).alias("macro_f1"),
        X.rounded(F.sum(F.col("f1") * F.col("support")) / total, 4).alias("weighted_f1"), X.rounded(F.avg("recall"), 4).alias("recall_macro"),
        F.count("*").alias("n_classes"), total.alias("n_test"),
    )


# ---- isolation forest ----------------------------------------------------------------------------
_TREE = "tree int, node int, feature int, threshold double, path double"


def _harmonic(n: float) -> float:
    """Average path length of an unsuccessful search in a tree of n points."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (np.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(points: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    rows, stack = [], [(1, points, 0)]
    while stack:
        node, x, depth = stack.pop()
        spread = x.max(axis=0) - x.min(axis=0) if len(x) else np.zeros(points.shape[1])
        usable = np.flatnonzero(spread > 0)
        if depth >= limit or len(x) <= 1 or not len(usable):
            rows.append((node, -1, 0.0, depth + _harmonic(len(x))))
            continue
        f = int(rng.choice(usable))
        cut = float(rng.uniform(x[:, f].min(), x[:, f].max()))
        rows.append((node, f, cut, 0.0))
        left = x[:, f] <= cut
        stack += [(2 * node, x[left], depth + 1), (2 * node + 1, x[~left], depth + 1)]
    return rows


def isolation_forest(df: DataFrame, key: str, features, trees: int = 200, sample: int = 256, contamination: float = 0.05, seed: int = 42) -> DataFrame:
    """(key, anomaly_score 0..1, is_anomaly): trees grow in parallel from bounded keyed samples.

    Each row draws a keyed hash per tree and enters a tree only below a cut-off that keeps samples a
    small multiple of ``sample``; the exact size is taken per tree. The finished trees (at most
    ``trees * 2 * sample`` nodes) travel with the scoring job.
    """
    n = df.count()
    values = df.select(F.col(key).alias("key"), F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]).alias("x"))
    share = min(1.0, 4.0 * sample / max(n, 1))
    draw = F.pmod(F.xxhash64("key", "tree", F.lit(seed)), F.lit(1 << 30))
    drawn = values.select("key", "x", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).withColumn("draw", draw)
    sampled = top_k(drawn.filter(F.col("draw") <= int(share * (1 << 30))), "tree", [F.col("draw"), F.col("key")], sample, "_r")
    size = min(sample, n)
    limit = int(np.ceil(np.log2(max(size, 2))))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        rows = _grow(np.stack(group["x"].to_numpy()), np.random.default_rng(seed * 100_003 + tree), limit)
        return pd.DataFrame([(tree, *r) for r in rows], columns=["tree", "node", "feature", "threshold", "path"])

    grown = sampled.select("tree", "x").groupBy("tree").applyInPandas(build, _TREE)
    forest = grown.toPandas()  # bounded: trees * 2 * sample nodes
    top = int(forest["node"].max()) + 1
    shape = (trees, top)
    feature, threshold, path = np.full(shape, -1, dtype=np.int32), np.zeros(shape), np.zeros(shape)
    at = (forest["tree"].to_numpy(), forest["node"].to_numpy())
    feature[at], threshold[at], path[at] = forest["feature"], forest["threshold"], forest["path"]
    norm = max(_harmonic(size), 1e-9)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            x = np.stack(b["x"].to_numpy())
            depth = np.zeros(len(x))
            for t in range(trees):
                node = np.ones(len(x), dtype=np.int64)
                for _ in range(limit + 1):
                    f = feature[t, node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    rows = np.flatnonzero(inner)
                    node[rows] = 2 * node[rows] + (x[rows, f[rows]] > threshold[t, node[rows]])
                depth += path[t, node]
            yield pd.DataFrame({"key": b["key"], "raw": np.power(2.0, -depth / trees / norm)})

    key_type = dict(df.dtypes)[key]
    raw = values.mapInPandas(score, f"key {key_type}, raw double")
    stats = raw.agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"), F.percentile_approx("raw", 1 - contamination, 100_000).alias("cut")).first()
    span = (stats["hi"] - stats["lo"]) or 1.0
    return raw.select(
        F.col("key").alias(key), F.round((F.col("raw") - stats["lo"]) / span, 4).alias("anomaly_score"), (F.col("raw") > stats["cut"]).cast("int").alias("is_anomaly")
    )


# ---- local outlier factor ------------------------------------------------------------------------
#: Rows of a block of points that is compared with another one.
LOF_BLOCK = 20_000


def _nearest(u: np.ndarray, v: np.ndarray, same: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row in u, row in v and distance of the k nearest rows of v to each row of u, ties by place; `same` pairs are left out.

    A matrix product finds all pairs that can be among them, with room for its rounding; only those are measured exactly.
    """
    near = u @ (-2 * v.T)
    uu, vv = (u**2).sum(axis=1), (v**2).sum(axis=1)
    near += uu[:, None]
    near += vv
    near[same | np.isnan(near)] = np.inf
    cut = np.partition(near, k - 1, axis=1)[:, k - 1] if near.shape[1] > k else np.full(len(u), np.inf)
    room = 1e-10 * (uu + (vv[np.isfinite(vv)].max() if np.isfinite(vv).any() else 0.0) + 1)
    rows, at = np.nonzero((near <= (cut + room)[:, None]) & np.isfinite(near))
    dist = np.sqrt(((u[rows] - v[at]) ** 2).sum(axis=1))
    order = np.lexsort((at, dist, rows))
    first = np.flatnonzero(np.diff(rows[order], prepend=-1))
    within = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    keep = order[within < k]
    return rows[keep], at[keep], dist[keep]


def _nearest_pairs(points: DataFrame, k: int) -> DataFrame:
    """`id, other, dist`: among them the k nearest rows of other ids to each row of `id, x`, ties by id.

    Equal points are one place, and only its first k + 1 ids can be neighbours of any point. These are compared block by
    block; every other id of a place has its k nearest there, at distance 0. Places that hold a NaN have no neighbours.
    """
    ids = points.groupBy("x", "id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"))
    ids = ids.filter(F.forall("x", lambda v: F.abs(v) < float("inf")))
    kept = top_k(ids, "x", [F.col("id").asc_nulls_first()], k + 1, "_r")
    kept = written_once(kept, "places")
    rows = kept.select("id", "x", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_c")).drop("_c")
    blocks = max(1, -(-rows.count() // LOF_BLOCK))
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    all_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = rows.withColumn("a", own).withColumn("b", all_blocks)
    right = rows.withColumn("b", own).withColumn("a", all_blocks).select(*[F.col(c).alias(f"{c}_") for c in ("id", "x", "a", "b")])

    def near(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(p) or not len(q):
            return pd.DataFrame({"id": [], "other": [], "dist": []})
        q = q.sort_values("id_", kind="stable", na_position="first")
        u, v = np.stack(p["x"].to_numpy()), np.stack(q["x_"].to_numpy())
        ids, others = p["id"].to_numpy(dtype=object), q["id_"].to_numpy(dtype=object)
        codes = pd.factorize(np.concatenate([ids, others]))[0]
        out = []
        for i in range(0, len(u), 256):
            rows, at, dist = _nearest(u[i : i + 256], v, codes[i : min(i + 256, len(u)), None] == codes[None, len(u) :], k)
            out.append(pd.DataFrame({"id": ids[i : i + 256][rows], "other": others[at], "dist": dist}))
        return pd.concat(out, ignore_index=True)

    pairs = left.groupBy("a", "b").cogroup(right.groupBy("a_", "b_")).applyInPandas(near, "id string, other string, dist double")
    # places of more ids: the first k rows there, and the id after which the others come
    full = kept.groupBy("x").agg(F.array_sort(F.collect_list(F.struct(F.col("_r"), "id", "copies"))).alias("m")).filter(F.size("m") > k)
    first = F.slice(F.flatten(F.transform("m", lambda r: F.array_repeat(F.struct(r["id"].alias("other")), r["copies"]))), 1, k)
    full = full.select("x", first.alias("first"), F.col("m")[k]["id"].alias("after"))
    rest = ids.join(full, "x").filter(F.col("id") > F.col("after"))
    there = F.slice(F.flatten(F.transform("first", lambda o: F.array_repeat(o, F.col("copies")))), 1, k)
    return pairs.unionByName(rest.select("id", F.explode(there).alias("o")).select("id", F.col("o.other").alias("other"), F.lit(0.0).alias("dist")))


def local_outlier_factor(df: DataFrame, key: str, features, k: int = 10) -> DataFrame:
    """Local outlier factor from exact nearest neighbours.

    Features are standardised with one aggregation. Neighbours come from blocks of different points compared
    block by block (``dense``-style cogroup), each task emitting k rows per point only.
    """
    stats = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(features)], *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(features)]).first()
    x = F.array(*[(F.coalesce(F.col(c).cast("double"), F.lit(stats[f"m{i}"] or 0.0)) - (stats[f"m{i}"] or 0.0)) / (stats[f"s{i}"] or 1.0) for i, c in enumerate(features)])
    pairs = _nearest_pairs(written_once(df.select(F.col(key).cast("string").alias("id"), x.alias("x")), "points"), k)
    # read three times, and the comparison is the costly part
    knn = written_once(top_k(pairs, "id", [F.col("dist"), F.col("other")], k, "_r").drop("_r"), "nearest")
    reach = knn.groupBy("id").agg(F.max("dist").alias("k_dist"))
    density = (
        knn.join(reach.select(F.col("id").alias("other"), "k_dist"), "other")
        .groupBy("id")
        .agg((1.0 / F.greatest(F.avg(F.greatest("dist", "k_dist")), F.lit(1e-10))).alias("lrd"))
    )
    around = knn.join(density.select(F.col("id").alias("other"), F.col("lrd").alias("other_lrd")), "other").groupBy("id").agg(F.avg("other_lrd").alias("mean_lrd"))
    return density.join(around, "id").select(F.col("id").alias(key), F.round(F.col("mean_lrd") / F.col("lrd"), 4).alias("lof_score"))
