"""Embedding near-dedup by NN-descent.

The neighbour graph starts from leaves of random hyperplane tables and is refined through neighbours of neighbours: every
vector brings the vectors that list it or that it lists together, and they try each other. Rounds go on until they find
no new links; an audit then compares a hashed sample of vectors with all rows, and more tables follow while links are
missing. Equal vectors are one node that counts as often as it occurs. Lists that hold nothing but links are saturated:
their vectors may have more links than the list has room for. So vectors with saturated lists meet again in leaves of
further tables, which return only links that join components, until a round joins none; and components with a saturated
list are compared block by block and only counted.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.llm.common import by_key, components, saved, written

THRESHOLD = 0.93
#: Neighbours in a list, tables at the start, vectors in a leaf or block, vectors in the audit and recall it asks for.
NEIGHBOURS, TABLES, LEAF, AUDIT, RECALL = 8, 4, 512, 256, 0.98
#: Rounds of further tables after failed audits.
ROUNDS = 6
#: Number of the first table in which saturated vectors meet again; those before are for lists.
MEETINGS = 1 << 20
_BITS = 48


def _prepared(vectors: DataFrame) -> DataFrame:
    """`node, label, dim, vec` of the vectors that can link: one for each vec_id, the components as bytes."""
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    kind = np.float32 if single else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, dims, vecs = [], [], []
            for r in range(batch.num_rows):
                values = batch.column("embedding")[r].values
                if values is None or values.null_count or len(values) == 0:
                    continue
                v = np.asarray(values).astype(kind)
                if np.isfinite(v).all() and v.any():
                    keep.append(r)
                    dims.append(len(v))
                    vecs.append(v.tobytes())
            index = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("node").take(index), batch.column("label").take(index), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())], ["node", "label", "dim", "vec"])

    given = vectors.select(F.col("vec_id").cast("long").alias("node"), F.col("label").cast("string").alias("label"), "embedding").dropna()
    found = given.mapInArrow(run, "node bigint, label string, dim int, vec binary")
    return found.groupBy("node").agg(F.min(F.struct("label", "dim", "vec")).alias("x")).select("node", "x.*"), kind


def _unit(column, kind) -> np.ndarray:
    x = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _best(node: np.ndarray, sims: np.ndarray, k: int, above: np.ndarray | None = None) -> pa.Table:
    """The k best of each row of a square matrix, itself left out; only those above the row's bar if one is given."""
    np.fill_diagonal(sims, -3.0)
    k = min(k, len(node) - 1)
    if k < 1:
        return pa.table({"node": node[:0], "other": node[:0], "sim": np.zeros(0)})
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    value = np.take_along_axis(sims, top, axis=1)
    good = value > (-2.5 if above is None else above[:, None])
    return pa.table({"node": np.repeat(node, k).reshape(-1, k)[good], "other": node[top][good], "sim": value[good]})


_EDGE = "node bigint, other bigint, sim double"


def _leaves(vectors: DataFrame, kind, tables: range):
    """`vectors` grouped by leaves: those on the same side of as many random hyperplanes as the group's size asks for."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for t in tables:
                code = np.zeros(batch.num_rows, np.int64)
                for d in np.unique(dims).tolist():
                    at = np.flatnonzero(dims == d)
                    if (t, d) not in planes:
                        planes[t, d] = np.random.Generator(np.random.PCG64([t, d])).standard_normal((d, _BITS))
                    side = _unit(batch.column("vec").take(pa.array(at)), kind) @ planes[t, d] > 0
                    code[at] = side @ (1 << np.arange(_BITS - 1, -1, -1, dtype=np.int64))
                table = pa.array(np.full(batch.num_rows, t, np.int32))
                yield pa.RecordBatch.from_arrays([*batch.columns, table, pa.array(code)], [*batch.schema.names, "table", "code"])

    coded = vectors.mapInArrow(codes, T.StructType([*vectors.schema.fields, T.StructField("table", T.IntegerType()), T.StructField("code", T.LongType())]))
    sizes = vectors.groupBy("label", "dim").agg(F.greatest(F.ceil(F.log2(F.count("*") / (LEAF / 4))), F.lit(0)).cast("int").alias("depth"))
    placed = coded.join(sizes, ["label", "dim"]).withColumn("leaf", F.expr(f"shiftright(code, {_BITS} - least(depth, {_BITS}))"))
    crowd = placed.groupBy("label", "dim", "table", "leaf").agg(F.ceil(F.count("*") / LEAF).alias("parts"))
    split = placed.join(crowd, ["label", "dim", "table", "leaf"]).withColumn("part", F.pmod(F.xxhash64("node", "table"), "parts"))
    return split.groupBy("label", "dim", "table", "leaf", "part")


def _from_tables(vectors: DataFrame, kind, tables: range, k: int) -> DataFrame:
    """The best neighbours of each vector in its leaves."""

    def leaf(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        x = _unit(group.column("vec"), kind)
        return _best(np.asarray(group.column("node")), x @ x.T, k)

    return _leaves(vectors.select("node", "label", "dim", "vec"), kind, tables).applyInArrow(leaf, _EDGE)


def _joining(vectors: DataFrame, kind, tables: range, threshold: float) -> DataFrame:
    """Links between different components that meet in a leaf, fewer than it has vectors. vectors: with `component`."""

    def leaf(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        node, name = np.asarray(group.column("node")), np.asarray(group.column("component")).copy()
        a, b = [], []
        if len(np.unique(name)) > 1:
            x = _unit(group.column("vec"), kind)
            for i in range(len(node)):
                # the components that this vector links to: one link for each is enough
                near = np.flatnonzero((x @ x[i] >= threshold) & (name != name[i]))
                _, first = np.unique(name[near], return_index=True)
                for j in near[first].tolist():
                    a.append(node[i])
                    b.append(node[j])
                    name[name == name[j]] = name[i]
        return pa.table({"node": pa.array(a, pa.int64()), "other": pa.array(b, pa.int64())})

    return _leaves(vectors.select("node", "label", "dim", "vec", "component"), kind, tables).applyInArrow(leaf, "node bigint, other bigint")


def _lists(edges: DataFrame, k: int) -> DataFrame:
    """The k best different neighbours of each node; fresh: not there before."""
    once = edges.groupBy("node", "other").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "other"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def _refined(graph: DataFrame, vectors: DataFrame, kind, k: int, turn: int) -> DataFrame:
    """One round: all that list a node or are listed by it try each other, unless they have done so before."""

    def meet(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        fresh = np.asarray(group.column("fresh"))
        x = _unit(group.column("vec"), kind)
        sims = x @ x.T
        sims[~(fresh[:, None] | fresh[None, :])] = -3.0
        return _best(np.asarray(group.column("node")), sims, k, np.asarray(group.column("bar")))

    # of those that list a node, as many as a list holds, other ones in each round
    order = F.row_number().over(Window.partitionBy("centre").orderBy(F.desc("fresh"), F.xxhash64("node", F.lit(turn))))
    listing = graph.select(F.col("other").alias("centre"), "node", "fresh").withColumn("order", order).filter(F.col("order") <= k).drop("order")
    around = graph.select(F.col("node").alias("centre"), F.col("other").alias("node"), "fresh").unionByName(listing)
    around = around.groupBy("centre", "node").agg(F.max("fresh").alias("fresh"))
    active = around.groupBy("centre").agg(F.max("fresh").alias("any"), F.count("*").alias("n")).filter("any and n > 1").select("centre")
    bars = graph.groupBy("node").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(F.lit(-2.0)).alias("bar"))
    full = vectors.select("node", "vec").join(bars, "node")
    met = around.join(active, "centre").join(full, "node").groupBy("centre").applyInArrow(meet, _EDGE)
    old = graph.withColumn("fresh", F.lit(False))
    return _lists(old.unionByName(met.distinct().withColumn("fresh", F.lit(True))), k)


def audit(vectors: DataFrame, kind, links: DataFrame, threshold: float = THRESHOLD, sample: int = AUDIT, whole: DataFrame | None = None) -> tuple[int, int]:
    """Links that a hashed sample of vectors has, and how many of them are found.

    Found are those in `links` (node, other), and those whose ends are in one component of `whole` (node, component): its
    components are compared in full.
    """
    chosen = vectors.orderBy(F.xxhash64("node"), "node").limit(sample).collect()  # bounded by the sample
    if not chosen:
        return 0, 0
    groups: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    for key in {(r.label, r.dim) for r in chosen}:
        own = [r for r in chosen if (r.label, r.dim) == key]
        groups[key] = np.array([r.node for r in own]), _unit(pa.array([bytes(r.vec) for r in own]), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, dim = np.array(batch.column("label").to_pylist()), np.asarray(batch.column("dim"))
            for (a, d), (node, x) in groups.items():
                at = np.flatnonzero((label == a) & (dim == d))
                if len(at):
                    other = np.asarray(batch.column("node"))[at]
                    i, j = np.nonzero((x @ _unit(batch.column("vec").take(pa.array(at)), kind).T >= threshold) & (node[:, None] != other[None, :]))
                    yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(other[j])], ["node", "other"])

    true = vectors.mapInArrow(run, "node bigint, other bigint")
    hit = F.col("hit").isNotNull()
    found = true.join(links.select("node", "other", F.lit(1).alias("hit")), ["node", "other"], "left")
    if whole is not None:
        found = found.join(whole.select("node", F.col("component").alias("own")), "node", "left")
        found = found.join(whole.select(F.col("node").alias("other"), F.col("component").alias("its")), "other", "left")
        hit = hit | F.coalesce(F.col("own") == F.col("its"), F.lit(False))
    return tuple(found.agg(F.count("*"), F.count(F.when(hit, 1))).first())


def _counted(members: DataFrame, kind, threshold: float) -> DataFrame:
    """`node, n_links` within components (node, component, vec, copies), block by block; pairs are counted, not returned."""

    def run(group: pa.Table) -> pa.Table:
        node, block = np.asarray(group.column("node")), np.asarray(group.column("block"))
        x, copies = _unit(group.column("vec"), kind), np.asarray(group.column("copies"))
        low = block == block.min()
        if low.all():
            hits = x @ x.T >= threshold
            np.fill_diagonal(hits, False)
            return pa.table({"node": node, "n": hits @ copies})
        hits = x[low] @ x[~low].T >= threshold
        return pa.table({"node": np.concatenate([node[low], node[~low]]), "n": np.concatenate([hits @ copies[~low], copies[low] @ hits])})

    blocks = members.groupBy("component").agg(F.ceil(F.count("*") / LEAF).cast("int").alias("blocks"))
    placed = members.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("component", "node", "vec", "copies", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    return placed.groupBy("component", "i", "j").applyInArrow(run, "node bigint, n bigint").groupBy("node").agg(F.sum("n").alias("n_links"))


def linked_vectors(vectors: DataFrame, threshold: float = THRESHOLD, k: int = NEIGHBOURS) -> DataFrame:
    """`vec_id, n_links, component_id, kept` for every row of `vectors` (vec_id, embedding, label).

    Vectors link if their labels are equal and not null and their cosine is at least `threshold`. A vector that is null,
    empty, zero, or holds null or non-finite components links with nothing, and vectors of different length never link.
    Rows that repeat a vec_id are one vector (the smallest label and components count). Rows without vec_id have no
    links, no component and are kept.
    """
    given, kind = _prepared(vectors)
    given = written(given, "vectors")
    same = ["label", "dim", "vec"]
    ready = written(given.groupBy(*same).agg(F.min("node").alias("node"), F.count("*").alias("copies")).select("node", *same, "copies"), "different-vectors")
    graph, tables, meetings = None, 0, MEETINGS
    for turn in range(ROUNDS):
        more = range(tables, tables + TABLES * (turn + 1))
        tables = more.stop
        start = _from_tables(ready, kind, more, k).withColumn("fresh", F.lit(True))
        graph = saved(_lists(start if graph is None else graph.withColumn("fresh", F.lit(False)).unionByName(start), k))
        step = 0
        while True:
            graph = saved(_refined(graph, ready, kind, k, 100 * turn + step))
            step += 1
            new, all_ = graph.filter(F.col("sim") >= threshold).agg(F.count(F.when(F.col("fresh"), 1)), F.count("*")).first()
            if new <= 0.001 * all_:
                break
        listed = graph.filter(F.col("sim") >= threshold)
        full = saved(listed.groupBy("node").agg(F.count("*").alias("n")).filter(F.col("n") >= k).select("node"))
        crowded = saved(ready.join(full, "node", "left_semi"))
        links = listed.select("node", "other") if turn == 0 else links.unionAll(listed.select("node", "other"))
        links = saved(links.unionAll(links.select("other", "node")).distinct())
        while True:
            parts = saved(components(links, "node", "other"))
            joins = saved(_joining(crowded.join(parts, "node"), kind, range(meetings, meetings + TABLES * (turn + 1)), threshold))
            meetings += TABLES * (turn + 1)
            if joins.isEmpty():
                break
            links = saved(links.unionAll(joins).unionAll(joins.select("other", "node")).distinct())
        whole = saved(parts.join(parts.join(full, "node", "left_semi").select("component").distinct(), "component", "left_semi").select("node", "component"))
        there, found = audit(ready, kind, links, threshold, whole=whole)
        if found >= RECALL * there:
            break
    copies = ready.select(F.col("node").alias("other"), "copies")
    counted = links.join(copies, "other").groupBy("node").agg(F.sum("copies").alias("n_links"))
    enlarged = _counted(whole.join(ready.select("node", "vec", "copies"), "node"), kind, threshold).withColumnRenamed("n_links", "all_links")
    counts = ready.join(counted, "node", "left").join(enlarged, "node", "left").join(parts, "node", "left").select(
        *same, (F.coalesce("all_links", "n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"),
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    found = given.join(by_key(counts), same).select(F.col("node").alias("vec_id"), "n_links", "component")
    component = F.coalesce("component", "vec_id")
    return rows.join(found, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
