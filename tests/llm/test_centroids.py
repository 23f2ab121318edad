"""Centroid clustering: bounds, brute force, defined cases."""

import hashlib

import numpy as np
import pytest

from tillwise.llm import centroids


def brute(rows, k=16, rounds=3, dims=64, scale=64, seed="1"):
    """Lloyd's rounds in Python integers."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    now = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(now))
    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for j in range(len(now)):
            mine = [v for (_, v), f in zip(kept, found) if f == j]
            if mine:
                now[j] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [(i, *nearest(v)) for i, v in kept]
    own = [sum(d for _, d, j in last if j == c) for c in range(len(now))]
    told = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return sorted(((i, j, d, own[j], sum(own), told[j]) for i, d, j in last), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, cluster int, lower double")


def got(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=str)


def groups(seed, n, dims=64, wide=0.3):
    rng = np.random.default_rng(seed)
    homes = rng.normal(size=(12, dims))
    return [(i, (homes[i % 12] + wide * rng.normal(size=dims)).astype(np.float32).tolist()) for i in range(n)]


def test_drift_in_ball_bounds_every_point():
    rng = np.random.default_rng(5)
    less = 0
    for _ in range(300):
        c, p = rng.normal(size=(2, 5)) * 4
        q, radius = p + rng.normal(size=5) * rng.choice([0.1, 1.0, 4.0]), float(rng.choice([0.0, 0.5, 2.0, 8.0]))
        by = centroids.drift_in_ball(p, q, c, radius)
        x = rng.normal(size=(400, 5))
        x = c + radius * x / np.linalg.norm(x, axis=1)[:, None] * rng.random((400, 1)) ** 0.2
        assert (np.linalg.norm(x - p, axis=1) - np.linalg.norm(x - q, axis=1)).max() <= by + 1e-9
        assert by <= np.linalg.norm(q - p) + 1e-12
        less += by < 0.9 * np.linalg.norm(q - p)
    assert less > 100
    assert centroids.drift_in_ball(p, p, c, 1.0) == 0


def test_squares_are_exact():
    rng = np.random.default_rng(1)
    for top in (3, 1 << 10, 1 << 25, centroids.limit_of(64)):
        x, c = rng.integers(-top, top + 1, (7, 64)), rng.integers(-top, top + 1, (3, 64))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(u, v)) for v in c] for u in x]
        assert centroids.squares(x, c).tolist() == want
        assert centroids.own_squares(x, c, np.array([0, 1, 2, 0, 1, 2, 0])).tolist() == [want[i][i % 3] for i in range(7)]


def test_against_brute_force(spark):
    rows = groups(2, 400) + [(-1, None), (-2, []), (-3, [1.0] * 63), (-4, [1.0] * 65), (-5, [None] + [1.0] * 63), (-6, [float("nan")] * 64), (-7, [float("inf")] * 64),
                             (None, [0.25] * 64), (7, [0.1] * 64), (7, [0.1] * 64), (8, [-0.0] * 64), (9, [30000.5] * 64)]
    assert got(centroids.cluster(frame(spark, rows).repartition(5))) == brute(rows)


def test_tightened_bounds_scan_less_for_the_same_result(spark):
    rows = groups(3, 600)
    df = frame(spark, rows).repartition(3)
    tight, plain = centroids.cluster(df), centroids.cluster(df, tight=False)
    assert got(tight) == got(plain) == brute(rows)
    scans = [sum(r.scans for r in d.collect()) for d in (tight, plain)]
    assert scans[0] < scans[1] < 4 * len(rows)


def test_ties_copies_and_empty_clusters(spark):
    """All vectors equal: the smallest number takes all, the other centroids stay; fewer vectors than clusters."""
    same = [(i, [0.5] * 64) for i in range(40)]
    assert {r[1] for r in got(centroids.cluster(frame(spark, same)))} == {0}
    assert got(centroids.cluster(frame(spark, same))) == brute(same)
    few = groups(4, 5)
    assert got(centroids.cluster(frame(spark, few))) == brute(few)


def test_empty_and_too_large(spark):
    assert centroids.cluster(frame(spark, [])).collect() == []
    assert centroids.cluster(frame(spark, [(1, None)])).collect() == []
    with pytest.raises(Exception, match="does not fit"):
        centroids.cluster(frame(spark, [(1, [3e30] * 64), (2, [1.0] * 64)])).collect()
