import hashlib
import math

import numpy as np
import pytest

from oracle import assert_matches
from touchline.llm import clustering
from touchline.llm.queries import ORACLES, op11_clustering

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, key string, v string, cluster string, distance double"


def plain(rows, k=40, rounds=5, dims=64):
    """``vec_id, cluster, distance`` and centroids, by plain loops over Python integers."""
    kept = []
    for i, e in rows:
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, [math.floor(256 * float(np.float32(x))) for x in e]))

    def name(row):
        return hashlib.sha256(f"2:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[1]

    centroids = [v for _, v in sorted(kept, key=name)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        where = [j for _, j in assign()]
        for j in range(len(centroids)):
            own = [v for (_, v), at in zip(kept, where) if at == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, j, d) for (i, _), (d, j) in zip(kept, assign())], centroids


def write(spark, folder, rows):
    full = [(i, e, "k", "v", "c", 0.5) for i, e in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    return folder


def test_query_matches_sql(spark):
    assert assert_matches(op11_clustering(spark, SF), ORACLES["op11_clustering"], SF) > 0


def mixed(n, seed, dims=64):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(0, rng.choice([0.02, 0.5, 3.0]), dims).tolist()) for i in range(n)]
    rows += [(n + i, rows[i % 7][1]) for i in range(60)]  # repeated vectors
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (None, [0.0] * dims)]
    broken = [None, [], [0.1] * (dims - 1), [0.1] * (dims + 1), [None] + [0.1] * (dims - 1)]
    broken += [[x] + [0.1] * (dims - 1) for x in (float("nan"), float("inf"), float("-inf"))]
    return rows + [(1000 + i, e) for i, e in enumerate(broken)]


def test_query_matches_plain_loops(spark, folder):
    rows = mixed(150, 1)
    found = op11_clustering(spark, write(spark, folder, rows)).collect()
    expected, centroids = plain(rows)

    def order(x):
        return [(-1 if i is None else i, j, d) for i, j, d in x]

    assert sorted(order((r["vec_id"], r["cluster"], r["distance"]) for r in found)) == sorted(order(expected))
    assert {r["inertia"] for r in found} == {sum(d for _, _, d in expected)}
    for r in found:
        own = [d for _, j, d in expected if j == r["cluster"]]
        text = ",".join(map(str, centroids[r["cluster"]]))
        assert (r["cluster_inertia"], r["centroid_sha256"]) == (sum(own), hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("count", [0, 1, 5])
def test_few_vectors(spark, folder, count):
    rows = [(i, [i / 8.0] * 64) for i in range(count)]
    found = op11_clustering(spark, write(spark, folder, rows)).collect()
    assert len(found) == count and {r["distance"] for r in found} <= {0}
    assert len({r["cluster"] for r in found}) == count


def test_equal_vectors_go_to_the_least_number(spark, folder):
    rows = [(i, [0.25] * 64) for i in range(100)]
    found = op11_clustering(spark, write(spark, folder, rows)).collect()
    assert [r["cluster"] for r in found] == [0] * 100


@pytest.mark.parametrize("size", [1, 3, 300])
def test_search_equals_brute_force(size):
    rng = np.random.default_rng(size)
    points = rng.integers(-500, 500, (size, 8))
    if size > 2:
        points[1] = points[2]
        points[0] = points[2][::-1]  # same mean and deviation
    x = np.concatenate([rng.integers(-500, 500, (400, 8)), rng.integers(-3, 3, (50, 8)), points, points[:, ::-1]])
    number, distance = clustering.Centroids(points).nearest(x)
    every = ((x[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_search_at_the_limit_of_components():
    points = np.array([[clustering.LIMIT - 1] * 64, [1 - clustering.LIMIT] * 64])
    number, distance = clustering.Centroids(points).nearest(points)
    assert number.tolist() == [0, 1] and distance.tolist() == [0, 0]
    far, apart = clustering.Centroids(points[:1]).nearest(points[1:])
    assert far[0] == 0 and apart[0] == 64 * (2 * clustering.LIMIT - 2) ** 2


def test_search_skips_most_centroids(monkeypatch):
    """Vectors around well separated means are measured against few centroids."""
    points = np.repeat(np.arange(200)[:, None] * 1000, 16, axis=1)
    x = points[np.arange(1000) % 200] + np.random.default_rng(0).integers(-9, 9, (1000, 16))
    measured = []
    real = np.einsum
    monkeypatch.setattr(clustering.np, "einsum", lambda *a: measured.append(len(a[1])) or real(*a))
    number, _ = clustering.Centroids(points).nearest(x)
    assert (number == np.arange(1000) % 200).all()
    assert sum(measured) < 1000 + 200 + 2 * 1000  # deviations of both, then at most two each
