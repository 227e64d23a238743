"""Boosting: histograms and splits against plain sums, independence of the layout, and what it learns."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketlake.operators import boosting as B


def table(spark, n=400, parts=3):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(n):
        a, b, c = (float(x) for x in rng.integers(0, 12, 3))
        y = 2 + int(a > 5) + int(b > 7)
        rows.append((k, a, b if k % 17 else None, c, None if k % 11 == 0 else y, int(c > 3) if k % 5 else None, k % 4 > 0))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y int, z int, train boolean").repartition(parts)


def test_histograms_equal_plain_sums(spark):
    df = table(spark)
    rows, model = B._prepared(df, "id", ["a", "b", "c"], ["y", "z"], None)
    model.depth = 3
    growing = B.Round(np.full((5, 16), -1, np.int16), np.zeros((5, 16), np.int16), np.zeros((5, 16), np.float32))
    growing.feature[:, 1], growing.cut[:, 1] = 1, 4
    got = {r.slot: (r.g, r.h) for r in B.histograms(rows, model, [], growing, 1, 7, 0.8).collect()}
    expected = {}
    for r in rows.collect():
        if not B._drawn(np.array([r.key]), 7, 0.8)[0]:
            continue
        for k in range(5):
            t, own = (0, 3) if k < 3 else (1, 2)
            label = r.labels[t]
            if label < 0:
                continue
            p = 1 / own
            g, h = p - (label == k - 3 * t), 2 * p * (1 - p)
            node = 2 + (r.bins[1] > 4)
            for f in range(3):
                slot = ((k * 2 + node - 2) * 3 + f) * B.BINS + r.bins[f]
                a, b = expected.get(slot, (0, 0))
                expected[slot] = (a + int(np.rint(g * B.SCALE)), b + int(np.rint(h * B.SCALE)))
    assert got == expected and len(model.classes[0]) == 3


def test_best_split_equals_trying_all():
    rng = np.random.default_rng(1)
    g, h = rng.normal(size=(4, 3, 10)), rng.uniform(0, 1, size=(4, 3, 10))
    g[:, 1:] = g[:, 1:] - g[:, 1:].mean(axis=2, keepdims=True) + g[:, :1].mean(axis=2, keepdims=True)
    h[:, 1:] = h[:, 1:] / h[:, 1:].sum(axis=2, keepdims=True) * h[:, :1].sum(axis=2, keepdims=True)
    gain, f, b, values = B.best_splits(g, h, np.array([True, False, True]))
    for n in range(4):
        best = max(
            ((gl**2 / (hl + 1) + gr**2 / (hr + 1) - (gl + gr) ** 2 / (hl + hr + 1), x, y) for x in (0, 2) for y in range(10)
             for gl, hl, gr, hr in [(g[n, x, : y + 1].sum(), h[n, x, : y + 1].sum(), g[n, x, y + 1 :].sum(), h[n, x, y + 1 :].sum())] if hl >= 1 and hr >= 1),
        )
        assert (f[n], b[n]) == best[1:] and gain[n] == pytest.approx(best[0])


def same(a, b):
    return all((x.feature == y.feature).all() and (x.cut == y.cut).all() and np.allclose(x.value, y.value) for x, y in zip(a.rounds, b.rounds, strict=True))


def test_trees_do_not_depend_on_the_layout(spark, monkeypatch):
    args = ("id", ["a", "b", "c"], ["y", "z"], {"y": "train", "z": "train"})
    one = B.fit(table(spark), *args, rounds=5, depth=3)
    monkeypatch.setattr(B, "CHUNK", 2)
    monkeypatch.setattr(B, "PART_BYTES", 4000)
    assert same(one, B.fit(table(spark, parts=7), *args, rounds=5, depth=3))


def test_learns_and_tells_unknown_classes(spark):
    df = table(spark).withColumn("y", F.when((F.col("id") % 4 == 0) & (F.col("id") % 3 == 0), 9).otherwise(F.col("y")))
    model = B.fit(df, "id", ["a", "b", "c"], ["y", "z"], {"y": "train", "z": "train"}, rounds=15, depth=3)
    assert model.classes == [[2, 3, 4], [0, 1]]  # 9 is only in rows that do not train
    out = B.predict(df, model).filter("not train and y is not null and y <> 9 and b is not null").collect()
    assert sum(r.y == r.y_pred for r in out) >= 0.95 * len(out) and all(0 < r.y_share <= 1 for r in out)
    by = {(r.target, r.feature): r for r in B.importance(model, spark).collect()}
    assert by["z", "c"]["rank"] == 1 and by["y", "c"]["rank"] == 3
    assert sum(r.importance for (t, _), r in by.items() if t == "y") == pytest.approx(1)


def test_nothing_to_learn(spark):
    df = table(spark).withColumn("y", F.lit(None).cast("int")).withColumn("z", F.lit(3))
    model = B.fit(df, "id", ["a", "b"], ["y", "z"], rounds=2, depth=2)
    assert model.classes == [[], [3]]
    assert {(r.y_pred, r.z_pred) for r in B.predict(df, model).collect()} == {(None, 3)}
    assert B.predict(df.limit(0), B.fit(df.limit(0), "id", ["a"], ["y"], rounds=1)).count() == 0


def test_all_cores_share_the_rows_of_a_level():
    assert B.partitions(72 << 20, 12) == 12 and B.partitions(100, 12) == 1 and B.partitions(3 << 20, 12) == 3
    assert B.partitions(32 << 30, 12) == 1024


def test_rows_of_one_partition_grow_the_same_trees_in_one_task(spark, monkeypatch):
    args = ("id", ["a", "b", "c"], ["y", "z"], {"y": "train", "z": "train"})
    monkeypatch.setattr(B, "PART_BYTES", 1000)
    by_level = B.fit(table(spark), *args, rounds=6, depth=5)
    monkeypatch.undo()

    def no_job_for_a_level(*_):
        raise AssertionError("a level was added up in a job of its own")

    monkeypatch.setattr(B, "histograms", no_job_for_a_level)
    at_once = B.fit(table(spark, parts=5), *args, rounds=6, depth=5)
    assert same(by_level, at_once) and (by_level.splits == at_once.splits).all() and np.allclose(by_level.gain, at_once.gain, rtol=1e-12)


def test_triage_cleans_the_texts_once(spark, folder):
    from catalog.quality import Triage
    from ticketlake.sources.tables import Tables

    plan = Triage.data(Tables(spark, folder))._jdf.queryExecution().optimizedPlan().toString()
    assert "html" not in plan and "regexp_replace" not in plan and "text_corpus" not in plan
