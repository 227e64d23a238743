"""Multiclass gradient boosting with softmax over feature histograms, for several targets at once.

Features are cut into bins once. A tree grows level by level: every task routes its rows through what is grown so far and
adds up gradients and curvatures by class, node, feature and bin; the sums of all tasks make one table whose size is that
of a tree level, not of the data, and the driver picks the splits from it. Gradients are fixed-point numbers, so their sums
and therefore the trees do not depend on how rows are dealt out. All classes of all targets grow in the same passes. Scores of
the rows are written again after every few rounds, and lost tasks start from there. Rows that fit one partition are not worth
a job for each level: one task holds them and grows the same trees.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ticketlake.session import checkpoint_dir

#: Bins of a feature, rounds whose trees are evaluated on the fly before the rows' scores are written, bytes of a partition, and
#: bytes from which a partition is worth a core of its own.
BINS, CHUNK, PART_BYTES, LEAST_BYTES = 64, 4, 32 << 20, 1 << 20
#: Penalty on squared leaf values, least curvature of a child, and scale of the fixed-point sums.
PENALTY, LEAST_CHILD, SCALE = 1.0, 1.0, float(1 << 24)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Round:
    """One tree for each class, as heaps: node n has the children 2n and 2n + 1; feature -1 is a leaf."""

    feature: np.ndarray  # classes x nodes
    cut: np.ndarray
    value: np.ndarray


@dataclass
class Boosted:
    targets: list[str]
    features: list[str]
    classes: list[list[int]]  # by target, sorted
    edges: list[np.ndarray]  # by feature: bin b holds values up to edges[b]
    depth: int
    rounds: list[Round] = field(default_factory=list)
    gain: np.ndarray | None = None  # targets x features, summed over splits
    splits: np.ndarray | None = None

    @property
    def owner(self) -> np.ndarray:
        """Target of each class of each target, in order."""
        return np.repeat(np.arange(len(self.targets)), [len(c) for c in self.classes])


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return np.asarray(column.flatten()).astype(kind).reshape(-1, width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(values.ravel(), kind))


def route(tree: Round, k: int, bins: np.ndarray, levels: int) -> np.ndarray:
    """Node of each row in the tree of class k after so many levels."""
    node = np.ones(len(bins), np.int64)
    flat, row = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    feature, cut = np.maximum(tree.feature[k], 0).astype(np.int64), tree.cut[k]
    inner = tree.feature[k] >= 0
    for _ in range(levels):
        on = inner[node]
        if not on.any():
            break
        right = flat[row + feature[node]] > cut[node]
        node = np.where(on, 2 * node + right, node)
    return node


def add_scores(scores: np.ndarray, rounds: list[Round], bins: np.ndarray, depth: int) -> np.ndarray:
    out = scores.astype(np.float64)
    for tree in rounds:
        for k in range(out.shape[1]):
            out[:, k] += tree.value[k][route(tree, k, bins, depth)]
    return out


def gradients(scores: np.ndarray, labels: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the softmax loss of each class; rows without a label (-1) have none."""
    g, h = np.zeros_like(scores), np.zeros_like(scores)
    for t in range(labels.shape[1]):
        own = np.flatnonzero(owner == t)
        if not len(own):
            continue
        e = np.exp(scores[:, own] - scores[:, own].max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        known = labels[:, t] >= 0
        y = np.zeros_like(p)
        y[known, labels[known, t]] = 1
        g[:, own] = np.where(known[:, None], p - y, 0)
        h[:, own] = np.where(known[:, None], np.maximum(2 * p * (1 - p), 1e-16), 0)
    return g, h


def _drawn(key: np.ndarray, number: int, share: float) -> np.ndarray:
    """The rows of a round: a hash of row and round below the share."""
    x = (key.view(np.uint64) + np.uint64(number + 1)) * _MIX
    x ^= x >> np.uint64(29)
    x *= _MIX
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53) < share


def histograms(rows: DataFrame, model: Boosted, pending: list[Round], growing: Round, level: int, number: int, subsample: float) -> DataFrame:
    """`slot, g, h`: sums by (class, node of the level, feature, bin), as one number."""
    owner, depth, width, targets = model.owner, model.depth, len(model.features), len(model.targets)
    n_classes, first = len(owner), 1 << level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = first * width * BINS
        g_all, h_all = np.zeros((2, n_classes, size), np.int64)
        for batch in batches:
            keep = _drawn(np.asarray(batch.column("key")), number, subsample)
            bins = _matrix(batch.column("bins"), width, np.int64)[keep]
            if not len(bins):
                continue
            labels = _matrix(batch.column("labels"), targets, np.int64)[keep]
            scores = add_scores(_matrix(batch.column("scores"), n_classes, np.float64)[keep], pending, bins, depth)
            g, h = (np.rint(x * SCALE).astype(np.int64) for x in gradients(scores, labels, owner))
            place = np.arange(width) * BINS + bins
            for k in range(n_classes):
                node = route(growing, k, bins, level)
                on = np.flatnonzero((node >= first) & (h[:, k] > 0))
                slot = (((node[on] - first) * (width * BINS))[:, None] + place[on]).ravel()
                # sums of one batch stay below 2^53, so they are exact
                g_all[k] += np.bincount(slot, np.repeat(g[on, k], width), size).astype(np.int64)
                h_all[k] += np.bincount(slot, np.repeat(h[on, k], width), size).astype(np.int64)
        there = np.flatnonzero(h_all)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(g_all.ravel()[there]), pa.array(h_all.ravel()[there])], ["slot", "g", "h"])

    return rows.mapInArrow(run, "slot bigint, g bigint, h bigint").groupBy("slot").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(g: np.ndarray, h: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gain, feature, bin, left and right values) of each node's best split from sums over (node, feature, bin).

    Gain -inf: no split leaves LEAST_CHILD on both sides. Ties go to the first feature and the lowest bin.
    """
    left_g, left_h = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
    all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + PENALTY) + right_g**2 / (right_h + PENALTY) - all_g**2 / (all_h + PENALTY)
    gain = np.where((left_h >= LEAST_CHILD) & (right_h >= LEAST_CHILD) & allowed[None, :, None], gain, -np.inf)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    f, b = np.divmod(at, g.shape[2])
    nodes = np.arange(len(gain))
    values = np.stack([-left_g[nodes, f, b] / (left_h[nodes, f, b] + PENALTY), -right_g[nodes, f, b] / (right_h[nodes, f, b] + PENALTY)], axis=1)
    return flat[nodes, at], f, b, values


def _prepared(df: DataFrame, key: str, features, targets, train: dict[str, str] | None) -> tuple[DataFrame, Boosted]:
    """Rows with bins and labels, and a model without trees. Null features are 0, null targets no label."""
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    x = [F.when(F.isnan(c), 0.0).otherwise(c) for c in x]
    cuts = [k / BINS for k in range(1, BINS)]
    known = {t: F.col(t).isNotNull() & (F.lit(True) if train is None else F.col(train[t])) for t in targets}
    wide = df.agg(
        *[F.percentile_approx(c, cuts, 10_000).alias(f"e{k}") for k, c in enumerate(x)],
        *[F.array_sort(F.collect_set(F.when(known[t], F.col(t).cast("int")))).alias(f"c{k}") for k, t in enumerate(targets)],
    ).first()
    edges = [np.unique(np.array(wide[f"e{k}"] or [], np.float64)) for k in range(len(features))]
    model = Boosted(list(targets), list(features), [list(wide[f"c{k}"]) for k in range(len(targets))], edges, 0)
    model.gain = np.zeros((len(targets), len(features)))
    model.splits = np.zeros((len(targets), len(features)), np.int64)
    labels = []
    for t, classes in zip(targets, model.classes):
        code = F.array_position(F.lit(classes).cast("array<int>"), F.col(t).cast("int")).cast("int") - 1
        labels.append(F.when(known[t], code).otherwise(-1))
    rows = df.select(F.xxhash64(F.col(key).cast("string")).alias("key"), F.array(*x).alias("x"), F.array(*labels).alias("labels"))
    rows = rows.filter(F.exists("labels", lambda y: y >= 0))
    n_classes, width = len(model.owner), len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _binned(_matrix(batch.column("x"), width, np.float64), edges)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), _lists(bins, pa.int32()), batch.column("labels"), _lists(np.zeros((len(bins), n_classes)), pa.float64())], ["key", "bins", "labels", "scores"]
            )

    return rows.mapInArrow(run, "key bigint, bins array<int>, labels array<int>, scores array<double>"), model


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1) if len(edges) else np.zeros((len(x), 0), np.int64)


def _stored(rows: DataFrame, folder: str, parts: int | None = None) -> DataFrame:
    path = f"{folder}/{uuid.uuid4().hex}"
    (rows if parts is None else rows.repartition(parts)).write.parquet(path)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return stored.coalesce(1) if parts == 1 else stored  # one partition needs no shuffle to be added up


def partitions(size: int, cores: int) -> int:
    """Every level waits for its slowest task, so all cores share the rows as soon as there are enough of them.

    More partitions than that only when they get too large: each sends sums as large as a tree level.
    """
    return max(1, size // PART_BYTES, min(cores, size // LEAST_BYTES))


def fit(
    df: DataFrame, key: str, features, targets, train: dict[str, str] | None = None,
    rounds: int = 200, depth: int = 6, rate: float = 0.1, subsample: float = 0.8, columns: float = 0.8, seed: int = 42,
) -> Boosted:
    """One softmax model for each target. `train`: by target, the column that marks its training rows (None: all rows).

    Rows with a null target do not train that target's model. A target with fewer than two classes has no trees.
    """
    rows, model = _prepared(df, key, features, targets, train)
    model.depth = depth
    owner, width = model.owner, len(model.features)
    if not len(owner):
        return model
    folder = f"{checkpoint_dir(df.sparkSession)}/boosting-{uuid.uuid4().hex}"
    first = _stored(rows, folder)
    size = first.count() * (8 * len(owner) + 4 * (width + len(targets)) + 8)
    if size <= PART_BYTES:
        _grown_at_once(first, model, rounds, rate, subsample, columns, seed)
        return model
    parts = partitions(size, df.sparkSession.sparkContext.defaultParallelism)
    rows = _stored(first, folder, parts)
    rng = np.random.default_rng(seed)
    pending: list[Round] = []
    for number in range(rounds):
        tree, allowed = _planted(model, rng, columns)
        for level in range(depth):
            at = 1 << level
            sums = histograms(rows, model, pending, tree, level, number, subsample).toArrow()
            slot = np.asarray(sums.column("slot").combine_chunks())
            g, h = np.zeros((2, len(owner) * at * width * BINS))
            g[slot], h[slot] = (np.asarray(sums.column(c).combine_chunks()) / SCALE for c in ("g", "h"))
            g, h = (x.reshape(len(owner), at, width, BINS) for x in (g, h))
            if not any([_grow(tree, model, k, g[k], h[k], allowed[k], rate) for k in range(len(owner))]):
                break
        model.rounds.append(tree)
        pending.append(tree)
        if len(pending) == CHUNK and number + 1 < rounds:
            rows, pending = _stored(_advanced(rows, pending, model), folder, parts), []
    return model


def _planted(model: Boosted, rng: np.random.Generator, columns: float) -> tuple[Round, np.ndarray]:
    """Trees without splits and the features that each class may use in this round."""
    n_classes, nodes, width = len(model.owner), 2 << model.depth, len(model.features)
    tree = Round(np.full((n_classes, nodes), -1, np.int16), np.zeros((n_classes, nodes), np.int16), np.zeros((n_classes, nodes), np.float32))
    allowed = np.zeros((n_classes, width), bool)
    for k in range(n_classes):
        allowed[k, rng.permutation(width)[: max(1, round(columns * width))]] = True
    return tree, allowed


def _grow(tree: Round, model: Boosted, k: int, g: np.ndarray, h: np.ndarray, allowed: np.ndarray, rate: float) -> bool:
    """Splits of one level of the tree of class k, from its sums over (node, feature, bin); False: there was none."""
    at, t = len(g), model.owner[k]
    if at == 1:
        tree.value[k, 1] = -rate * g[0, 0].sum() / (h[0, 0].sum() + PENALTY)
    gain, f, b, values = best_splits(g, h, allowed)
    split = np.flatnonzero(gain > 1e-9)
    for n in split:
        node = at + n
        tree.feature[k, node], tree.cut[k, node] = f[n], b[n]
        tree.value[k, 2 * node : 2 * node + 2] = rate * values[n]
        model.gain[t, f[n]] += gain[n]
        model.splits[t, f[n]] += 1
    return len(split) > 0


def _grown_at_once(rows: DataFrame, model: Boosted, rounds: int, rate: float, subsample: float, columns: float, seed: int) -> None:
    """All rounds in one task that holds the rows. Only the smaller child of a split is added up; the larger one is the rest."""
    owner, depth, width, targets = model.owner, model.depth, len(model.features), len(model.targets)

    def tree_of(k: int, tree: Round, allowed: np.ndarray, bins: np.ndarray, place: np.ndarray, row: np.ndarray, drawn: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        node = np.ones(len(bins), np.int64)
        flat = bins.ravel()
        used = drawn[h[drawn] > 0]
        gains, curves = g[used], h[used]
        all_g, all_h = np.zeros((2, 1, width * BINS))
        for level in range(depth):
            first, size = 1 << level, (1 << level) * width * BINS
            at = node[used] - first
            if level:
                # rows that stayed in a leaf of an earlier level are left out; the sums of a parent cover both of its children
                count = np.bincount(at[at >= 0], minlength=first).reshape(-1, 2)
                small = np.stack([count[:, 0] <= count[:, 1], count[:, 0] > count[:, 1]], axis=1).ravel()
                some = np.flatnonzero((at >= 0) & small[at])
                parent = np.repeat(tree.feature[k, first // 2 : first] >= 0, 2)
            else:
                some, small, parent = np.arange(len(used)), np.ones(1, bool), np.ones(1, bool)
            slot = ((at[some] * (width * BINS))[:, None] + place[used[some]]).ravel()
            # whole numbers below 2^53, so the sums and what is left of a parent are exact
            own = [np.bincount(slot, np.repeat(x[some], width), size).reshape(first, -1) for x in (gains, curves)]
            if level:
                for x, up in zip(own, (all_g, all_h), strict=True):
                    rest = np.flatnonzero(~small & parent)
                    x[rest] = up[rest // 2] - x[rest ^ 1]
            all_g, all_h = own
            if not _grow(tree, model, k, *(x.reshape(first, width, BINS) / SCALE for x in own), allowed, rate):
                break
            feature, cut = tree.feature[k], tree.cut[k]
            on = (feature >= 0)[node]
            on &= node >= first
            right = flat[row + np.maximum(feature, 0).astype(np.int64)[node]] > cut[node]
            node = np.where(on, 2 * node + right, node)
        return tree.value[k][node]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.asarray(b.column("key")), _matrix(b.column("bins"), width, np.uint8), _matrix(b.column("labels"), targets, np.int8)) for b in batches]
        key, bins, labels = (np.concatenate(x) for x in zip(*held, strict=True))
        place, row, scores = np.arange(width) * BINS + bins.astype(np.int64), np.arange(len(key)) * width, np.zeros((len(key), len(owner)))
        rng = np.random.default_rng(seed)
        for number in range(rounds):
            tree, allowed = _planted(model, rng, columns)
            drawn = np.flatnonzero(_drawn(key, number, subsample))
            g, h = (np.rint(x * SCALE) for x in gradients(scores, labels, owner))
            for k in range(len(owner)):
                scores[:, k] += tree_of(k, tree, allowed[k], bins, place, row, drawn, np.ascontiguousarray(g[:, k]), np.ascontiguousarray(h[:, k]))
            parts = (tree.feature, tree.cut, tree.value, model.gain, model.splits)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in parts]], ["number", "feature", "cut", "value", "gain", "splits"])

    shape = (len(owner), 2 << depth)
    for r in sorted(rows.coalesce(1).mapInArrow(run, "number int, feature binary, cut binary, value binary, gain binary, splits binary").toArrow().to_pylist(), key=lambda r: r["number"]):
        model.rounds.append(Round(*(np.frombuffer(r[c], kind).reshape(shape) for c, kind in (("feature", np.int16), ("cut", np.int16), ("value", np.float32)))))
        model.gain, model.splits = (np.frombuffer(r[c], kind).reshape(targets, width) for c, kind in (("gain", np.float64), ("splits", np.int64)))


def _advanced(rows: DataFrame, pending: list[Round], model: Boosted) -> DataFrame:
    width, n_classes, depth = len(model.features), len(model.owner), model.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = add_scores(_matrix(batch.column("scores"), n_classes, np.float64), pending, _matrix(batch.column("bins"), width, np.int64), depth)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("bins"), batch.column("labels"), _lists(scores, pa.float64())], batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def predict(df: DataFrame, model: Boosted) -> DataFrame:
    """All columns of `df` with `<target>_pred` (int; null if the target had no class) and `<target>_share`, its probability."""
    width, owner = len(model.features), model.owner
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in model.features]
    x = F.array(*[F.when(F.isnan(c), 0.0).otherwise(c) for c in x])
    added = [n for t in model.targets for n in (f"{t}_pred", f"{t}_share")]
    keep = [c for c in df.columns if c not in added]
    rows = df.select(F.struct(*keep).alias("row"), x.alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _binned(_matrix(batch.column("x"), width, np.float64), model.edges)
            scores = add_scores(np.zeros((len(bins), len(owner))), model.rounds, bins, model.depth)
            out = [batch.column("row")]
            for t, classes in enumerate(model.classes):
                if not classes:
                    out += [pa.nulls(len(bins), pa.int32()), pa.nulls(len(bins), pa.float64())]
                    continue
                own = scores[:, owner == t]
                e = np.exp(own - own.max(axis=1, keepdims=True))
                best = own.argmax(axis=1)
                out += [pa.array(np.array(classes, np.int32)[best]), pa.array((e / e.sum(axis=1, keepdims=True))[np.arange(len(best)), best])]
            yield pa.RecordBatch.from_arrays(out, ["row", *added])

    kind = f"row {rows.schema['row'].dataType.simpleString()}, " + ", ".join(f"`{n}` {'int' if n.endswith('_pred') else 'double'}" for n in added)
    return rows.mapInArrow(run, kind).select("row.*", *added)


def importance(model: Boosted, spark) -> DataFrame:
    """`target, feature, importance, mean_importance, rank`: gain per split, as a share of the target's; the mean over targets."""
    each = model.gain / np.maximum(model.splits, 1)
    share = each / np.maximum(each.sum(axis=1, keepdims=True), 1e-300)
    rows = [(t, f, float(share[i, j]), float(share[:, j].mean())) for i, t in enumerate(model.targets) for j, f in enumerate(model.features)]
    df = spark.createDataFrame(rows, "target string, feature string, importance double, mean_importance double")
    return df.withColumn("rank", F.row_number().over(Window.partitionBy("target").orderBy(F.col("importance").desc(), "feature")))
