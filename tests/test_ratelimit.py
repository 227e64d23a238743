"""The parallel rate detector against a plain walk, with windows that cross block borders."""
import random

from ticketlake.streaming import ratelimit as RL


def walk(times, limit, seconds):
    start, used, out = None, 0, []
    for t in times:
        if start is None or t - start > seconds * 1_000_000:
            start, used = t, 1
            out.append((True, 0))
        elif used >= limit:
            out.append((False, max(int((seconds * 1_000_000 - (t - start)) // 1_000_000), 1)))
        else:
            used += 1
            out.append((True, 0))
    return out


def test_detector_matches_a_walk(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for key, mean in (("dense", 2), ("medium", 9), ("sparse", 60), ("border", 10)):
        t, times = 0, []
        for _ in range(400):
            t += 10_000_000 if key == "border" else rng.randint(0, mean * 2_000_000)
            times.append(t)
        for i, t in enumerate(times):
            rows.append((key, len(rows), t))
        want.update({(key, rows[len(rows) - 400 + i][1]): w for i, w in enumerate(walk(times, 3, 10))})
    df = spark.createDataFrame(rows, "k string, id bigint, us bigint").selectExpr("k", "id", "timestamp_micros(us) AS ts")
    got = {(r["key"], r["id"]): (r["allowed"], r["retry_after"]) for r in RL.detect(df, "k", "id", "ts", 3, 10, slices_per_block=4).collect()}
    assert got == want
