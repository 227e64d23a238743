"""URL rules and embeddings against brute force, with nulls, ties, repeats and clashing columns."""
import itertools
import math
import random

import numpy as np
import pytest

from ticketlake.llm import url_rules, vector_duplicates


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")


def test_host_path_and_listed_rules(spark):
    cases = {
        "http://Shop.COM": ("shop.com", "", None, None), "https://a.com/x?y#z": ("a.com", "/x", "com/", "allow"), "ftp://www.example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://example.com/en/": ("example.com", "/en/", "example.com/en/", "block"), "http://m.www.example.com/en/2#t": ("m.www.example.com", "/en/2", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"), "no scheme.com/x": ("", "", None, None), "http://b.net/es/q": ("b.net", "/es/q", "net/es/", "block"),
        "http://b.net/es": ("b.net", "/es", None, None), "://c.com/": ("c.com", "/", "com/", "allow"), "http://ÄB.com/é": ("Äb.com", "/é", "com/", "allow"), "http://d.com?q=1/": ("d.com", "", None, None), "": ("", "", None, None),
    }
    rows = url_rules.judge(pages(spark, [*cases, None, *cases])).orderBy("page_id").collect()
    assert len(rows) == 2 * len(cases) + 1
    for r, (url, (host, path, rule, verdict)) in zip(rows, cases.items()):
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert verdict is None or r.verdict == verdict, url
    assert (rows[len(cases)].host, rows[len(cases)].verdict) == ("", "allow")


def test_mined_rules(spark):
    rng = random.Random(2)
    names = "abcdefg"
    rows = [(rng.sample(names, rng.randint(1, 5)), rng.choice(["allow", "block"]) if rng.random() < 0.2 else None) for _ in range(300)]
    rows = [(t, v or ("block" if "a" in t and "b" in t or "c" in t and "d" not in t else "allow")) for t, v in rows]
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    rules = {(tuple(r.antecedent), r.verdict): (r.support, r.confidence) for r in url_rules.mine(labelled, 0.02, 0.75).collect()}
    every = {}
    for size in range(1, len(names) + 1):
        for s in itertools.combinations(names, size):
            hit = [v for t, v in rows if set(s) <= set(t)]
            for v in ("allow", "block"):
                n = hit.count(v)
                if n >= math.ceil(0.02 * len(rows)) and n / len(hit) >= 0.75:
                    every[s, v] = (n, n / len(hit))
    assert rules and all(every[k] == v for k, v in rules.items())
    urls = spark.createDataFrame([(str(i), list(t)) for i, t in enumerate(itertools.chain.from_iterable(itertools.combinations(names, n) for n in (1, 2, 3, 4)))], "url string, tokens array<string>")
    got = {r.url: tuple(r.mined) for r in url_rules.best_rules(urls, url_rules.mine(labelled, 0.02, 0.75)).collect()}
    for r in urls.collect():
        fits = [(-c, -n, len(s), " ".join(s), v) for (s, v), (n, c) in every.items() if set(s) <= set(r.tokens)]
        best = min(fits, default=None)
        assert got.get(r.url) == (best and (best[4], best[3]))


def test_rules_of_many_tokens(spark):
    """Only four tokens together mean block; a page with all of them gets it, and not the verdict of a part."""
    rows = [(["a", "b", "c", "d"], "block")] * 50 + [(list(s), "allow") for s in itertools.combinations("abcd", 3)] * 150 + [(["z"], "allow")] * 94 + [(["z"], "block")] * 6
    urls = spark.createDataFrame([("all", ["a", "b", "c", "d", "z"]), ("three", ["a", "b", "c"])], "url string, tokens array<string>")
    got = {r.url: r.mined for r in url_rules.best_rules(urls, url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"))).collect()}
    assert (got["all"].verdict, got["all"].rule) == ("block", "a b c d") and got["three"].verdict == "allow"


def test_no_labels_and_no_pages(spark):
    rows = url_rules.judge(pages(spark, ["http://a.org/x", None])).collect()
    assert [r.verdict for r in rows] == ["allow", "allow"]
    assert url_rules.judge(pages(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("k, leaf", [(8, 512), (3, 16)])
def test_vectors(spark, monkeypatch, k, leaf):
    monkeypatch.setattr(vector_duplicates, "LEAF", leaf)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 16))
    rows = []
    for i in range(240):
        v = rng.normal(size=16) if i % 3 else centres[i % 6 if i % 2 else 0] + 0.12 * rng.normal(size=16)
        rows.append((i, [float(x) for x in v], int(i % 2)))
    twin = rows[0][1]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [*twin[:15], None], 0), (303, [*twin[:15], float("nan")], 0), (304, twin, None), (None, twin, 0), (305, [x * 3 for x in twin], 0), (306, twin[:8], 0), (306, twin[:8], 0), (307, [], 0)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    got = {r.vec_id: r for r in vector_duplicates.linked_vectors(df, k=k).collect()}
    assert vector_duplicates.linked_vectors(df.limit(0)).count() == 0
    good = {i: (np.float32(v).astype(float), y) for i, v, y in rows if i is not None and i < 300 or i == 305}
    links = {i: set() for i in good}
    for a, b in itertools.combinations(good, 2):
        (x, y), (u, w) = good[a], good[b]
        if y == w and x @ u / np.linalg.norm(x) / np.linalg.norm(u) >= 0.93:
            links[a].add(b)
            links[b].add(a)
    part = {}
    for i in sorted(good):
        stack = [] if i in part else [i]
        while stack:
            j = stack.pop()
            if j not in part:
                part[j] = i
                stack.extend(links[j])
    assert sum(map(len, links.values())) > 50
    for i in good:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(links[i]), part[i], part[i] == i)
    for i in (300, 301, 302, 303, 304, 306, 307):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, True)


@pytest.mark.parametrize("noise", [0.0, 0.02])
def test_groups_of_more_copies_than_a_list_holds(spark, noise):
    rng = np.random.default_rng(11)
    base, side = np.linalg.qr(rng.normal(size=(16, 2)))[0].T
    rows = []
    for i in range(40):
        v = base if i < 20 else 0.95 * base + math.sqrt(1 - 0.95**2) * side
        v = v + noise * rng.normal(size=16) / 4
        rows.append((i, [float(x) for x in v], 0))
    rows += [(40 + i, [float(x) for x in rng.normal(size=16)], 0) for i in range(2000)]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.93).sum(axis=1) - 1
    assert (links[:40] == 39).all()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_duplicates.linked_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert [got[i] for i in range(40)] == [(39, 0, i == 0) for i in range(40)]


def test_audit_counts_no_link_between_components(spark):
    rows = [(i, [1.0, 0.3 * (i >= 12) + 0.001 * i], 1) for i in range(24)]
    ready, kind = vector_duplicates._prepared(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    inside = [(a, b) for a in range(24) for b in range(24) if a != b and (a < 12) == (b < 12)]
    links = spark.createDataFrame(inside, "node long, other long")
    there, found = vector_duplicates.audit(ready, kind, links)
    assert (there, found) == (24 * 23, 24 * 11)
    whole = spark.createDataFrame([(i, 12 * (i >= 12)) for i in range(24)], "node long, component long")
    assert vector_duplicates.audit(ready, kind, links, whole=whole) == (24 * 23, 24 * 11)


def test_audit_sees_missing_links(spark):
    ready, kind = vector_duplicates._prepared(spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [0.0, 1.0], 1)], "vec_id long, embedding array<double>, label int"))
    none = spark.createDataFrame([], "node long, other long")
    assert vector_duplicates.audit(ready, kind, none) == (2, 0)
    assert vector_duplicates.audit(ready, kind, spark.createDataFrame([(1, 2), (2, 1)], "node long, other long")) == (2, 2)


def test_components(spark):
    from ticketlake.llm.common import components

    rng = random.Random(3)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(40)]
    name = {}
    for a, b in edges:
        name.setdefault(a, a), name.setdefault(b, b)
    for _ in range(100):
        for a, b in edges:
            name[a] = name[b] = min(name[a], name[b])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in got} == {n: c for n, c in name.items() if n in linked} and len(got) == len(linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_few_edges_run_in_few_tasks(spark):
    """Chains and a star, in a session of many partitions that adaptive execution does not bring together."""
    from ticketlake.llm.common import components

    edges = [(3 * k + j, 3 * k + j + 1) for k in range(0, 300, 2) for j in (0, 1)] + [(10_000, 10_000 + j) for j in range(1, 400)]
    settings = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, context = {k: spark.conf.get(k) for k in settings}, spark.sparkContext
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        context.setJobGroup("few edges", "")
        found = components(spark.createDataFrame(edges, "a long, b long"))
        tasks = [t.getStageInfo(s).numTasks for t in [context.statusTracker()] for j in t.getJobIdsForGroup("few edges") for s in t.getJobInfo(j).stageIds if t.getStageInfo(s)]
        got = {r.node: r.component for r in found.collect()}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {3 * k + j: 3 * k for k in range(0, 300, 2) for j in range(3)} | {10_000 + j: 10_000 for j in range(400)}
    assert found.rdd.getNumPartitions() < 97
    assert sum(tasks) < 97 * 16, sum(tasks)
