import hashlib
import random

import numpy as np
import pytest

from tidyspark.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, cluster string, id string"


def brute(rows, k=8, rounds=10, components=64, seed=3):
    """Plain rounds with whole numbers."""
    kept = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == components and all(x is not None and np.isfinite(x) for x in v)]

    def key(r):
        return hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]
    middle = [v for _, v in sorted(kept, key=key)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middle)) for _, v in kept]
    for _ in range(rounds):
        to = assign()
        for c in range(len(middle)):
            mine = [v for (_, v), (_, t) in zip(kept, to) if t == c]
            if mine:
                middle[c] = [sum(col) // len(mine) for col in zip(*mine)]
    to = assign()
    inertia = {c: sum(d for d, t in to if t == c) for c in range(len(middle))}
    return sorted(((i, c, d, inertia[c], sum(inertia.values()),
                    hashlib.sha256(",".join(map(str, middle[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, to)), key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, C.clusters(df, **kw).collect()), key=repr)


def vectors(seed, n, components=64, spread=1.0, groups=5):
    rnd = np.random.default_rng(seed)
    middles = rnd.normal(size=(groups, components))
    return [(i, [float(x) for x in np.float32(middles[i % groups] + spread * rnd.normal(size=components))])
            for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_equals_plain_rounds(spark, spread):
    rows = vectors(1, 300, spread=spread)
    assert run(spark, rows) == brute(rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [0.5] * 64
    rows = [(1, None), (2, []), (3, [1.0] * 63), (4, [1.0] * 65), (5, [None] + good[1:]), (6, [nan] + good[1:]),
            (7, [inf] + good[1:]), (8, good), (8, good), (9, good), (None, [-0.25] * 64), (10, [0.0] * 64),
            (11, [-0.0] * 64)]
    got = run(spark, rows, rounds=3)
    assert got == brute(rows, rounds=3) and len(got) == 6
    assert run(spark, rows[:7]) == []
    assert run(spark, [(i, good) for i in range(50)], rounds=2) == brute([(i, good) for i in range(50)], rounds=2)


def test_ties_between_centroids_go_to_the_smaller_number(spark):
    rows = [(i, [float(x)]) for i, x in enumerate([0, 4, 8, 2, 6, 2, 6, 1, 7])]
    assert run(spark, rows, k=3, components=1, rounds=4) == brute(rows, k=3, components=1, rounds=4)


def test_large_components_stay_exact_and_too_large_ones_stop(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.uniform(-60_000, 60_000) for _ in range(64)]) for i in range(40)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(spark, rows, k=4, rounds=4) == brute(rows, k=4, rounds=4)
    with pytest.raises(Exception, match="squared distances over 63 bits"):
        run(spark, [(1, [1e9] * 64)])


def test_only_expired_vectors_are_popped():
    rnd = np.random.default_rng(3)
    middles = rnd.integers(-1000, 1000, (8, 64))
    x = np.concatenate([m + rnd.integers(-400, 400, (100, 64)) for m in middles]).astype(np.int64)
    step = C.Round(middles.copy(), np.zeros(8))
    heaps = C.BlockHeaps(x, int(np.abs(x).max()), step)
    heaps.first_scan()
    popped = []
    for _ in range(6):
        a = heaps.assigned()
        new = np.array([x[a == c].sum(0) // max(1, (a == c).sum()) for c in range(8)])
        step = step.moved_to(new)
        heaps.step = step
        popped.append(heaps.rescan())
        assert (heaps.assigned() == C.squared_distances(x, new, 2000).argmin(1)).all()
    assert popped[-1] < len(x) // 4


def test_rounds_join_without_exchange(spark):
    rows = vectors(2, 60)
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    stored = C._Bucketed(spark, 4)
    with C._small_batches(spark):
        packed = C._pack(df.select("vec_id", "embedding"), 64, 1024.0)
        blocks = spark.table(stored.write(packed.repartition(4, "block"), "t-blocks"))
        step = C.Round(np.array([v for _, v in rows[:3]]).astype(np.int64), np.zeros(3))
        heaps = spark.table(stored.write(C._pass(blocks, None, step, False), "t-heaps"))
        plan = C._pass(blocks, heaps, step, False)._jdf.queryExecution().executedPlan().toString()
    stored.drop_all()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
