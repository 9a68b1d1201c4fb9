import numpy as np
from pyspark.sql import types as T

from homesense.llm import lists
from homesense.llm.caps import near_vectors, plan
from homesense.llm.lists import components

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("row", T.StringType()),
                       T.StructField("n_links", T.StringType())])


def vectors(seed=3, n=300, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    x[40:140] = x[0] + 0.2 * rng.standard_normal((100, dim))
    x[150:160] = x[150]
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def brute(rows):
    x = [np.array(v, np.float32).astype(float) if v and None not in v else None for _, v in rows]
    ok = [v is not None and np.isfinite(v).all() and v.any() for v in x]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(x[i]) == len(x[j]):
                if x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= 0.9:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i, (vid, _) in enumerate(rows):
        least.setdefault(find(i), []).append(vid)
    name = [min((v for v in least[find(i)] if v is not None), default=None) for i in range(n)]
    return [(vid, k, c, vid is not None and vid == c) for (vid, _), k, c in zip(rows, links, name)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "r", "n") for i, v in rows], SCHEMA).repartition(3)


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple(-1 if v is None else v for v in r))


def test_against_brute_force(spark):
    rows = vectors()
    nan, inf = float("nan"), float("inf")
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [nan] + [1.0] * 15), (904, [inf] + [1.0] * 15),
             (905, [None] + [1.0] * 15), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (908, [3.0]), (150, rows[150][1]),
             (None, rows[151][1]), (909, [1e-30] * 16), (910, [1e30] * 16)]
    want, got = order(brute(rows)), order(near_vectors(frame(spark, rows)).collect())
    found, all_ = sum(r[1] for r in got), sum(r[1] for r in want)
    assert all_ >= found >= 0.99 * all_ and all(g[1] <= w[1] for g, w in zip(got, want))
    assert got == want


def test_long_lists_in_blocks(spark, monkeypatch):
    rows = vectors(seed=4)
    monkeypatch.setattr(lists.blocked, "__defaults__", (16,))
    assert order(near_vectors(frame(spark, rows)).collect()) == order(brute(rows))


def test_empty(spark):
    assert near_vectors(frame(spark, [])).count() == 0


def test_more_vectors_get_higher_caps_and_more_filters():
    small, large = plan(1000, 64), plan(1_000_000, 64)
    assert large[0] > small[0] and large[1] > small[1]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 130)] + [(130, 129), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {k: v for k, v in got.items() if k != v} == {**{i: 1 for i in range(2, 61)}, **{i: 100 for i in range(101, 131)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
