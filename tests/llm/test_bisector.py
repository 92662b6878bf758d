"""Centroid clustering against plain integer arithmetic and against SQL."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from cinelens.llm import bisector, queries

NAN, INF = float("nan"), float("inf")
SF = "/root/testdata/sf0.001"


def plain(rows, p):
    kept = []
    for i, x in rows:
        if i is None or x is None or len(x) != p.dims or any(c is None or not math.isfinite(c) or not math.isfinite(p.scale * c) for c in x):
            continue
        kept.append((i, [math.floor(p.scale * c) for c in x]))
    centroids = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"{p.seed}:{r[0]}".encode()).hexdigest(), r[1]))[: p.k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(p.rounds):
        held = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            mine = [v for (_, v), h in zip(kept, held) if h == n]
            if mine:
                centroids[n] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [nearest(v) for _, v in kept]
    fits = lambda x: x if x < 1 << 63 else None
    total = {n: sum(d for d, h in last if h == n) for n in range(len(centroids))}
    if any(d >= 1 << 63 for d, _ in last):
        total = {n: None if any(d >= 1 << 63 for d, h in last if h == n) else t for n, t in total.items()}
    whole = None if None in total.values() else fits(sum(total.values()))
    digest = lambda n: hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()
    return sorted(((i, n, fits(d), total[n] if total[n] is None else fits(total[n]), whole, digest(n)) for (i, _), (d, n) in zip(kept, last)), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, x, 1, 2, "x") for i, x in rows], "vec_id long, embedding array<double>, cluster int, distance long, v string")


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def made(n=300, dims=6, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, dims))
    rows = [(i, (centres[i % 7] + 0.2 * rng.normal(size=dims)).tolist()) for i in range(n)]
    odd = [(9000, None), (9001, []), (9002, [1.0, None] + [0.0] * (dims - 2)), (9003, [NAN] * dims), (9004, [INF] * dims), (None, [1.0] * dims),
           (9005, [0.0] * dims), (9006, [1.0, 2.0]), (0, rows[0][1]), (0, rows[5][1]), (9007, [1e308] * dims)]
    return rows + odd + [(n + i, rows[i % 4][1]) for i in range(40)]


@pytest.mark.parametrize("k, rounds, block", [(10, 5, 2048), (1, 2, 16), (60, 3, 16), (7, 0, 5)])
def test_equals_plain_integers(spark, monkeypatch, k, rounds, block):
    p, rows = bisector.Params(dims=6, k=k, rounds=rounds), made()
    df = bisector.cluster(table(spark, rows).repartition(5), p)
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert got(df) == plain(rows, p)


def test_large_components(spark):
    """Beyond 64 bits: exact, and null where a long can't hold the value."""
    rows = made(60) + [(7000 + i, [1e9 * (i - 3), -1e9, 5e8, 0.25, 1.0, 2.0]) for i in range(7)]
    p = bisector.Params(dims=6, k=5, rounds=3)
    assert got(bisector.cluster(table(spark, rows), p)) == plain(rows, p)
    rows += [(8000 + i, [1e40 * (i - 2), 3e200, -1e-3, 0.0, 1e15, 2e17]) for i in range(5)]
    assert got(bisector.cluster(table(spark, rows), p)) == plain(rows, p)


def test_tournament_is_the_plain_minimum():
    rng = np.random.default_rng(5)
    p = bisector.Params(dims=4)
    for top in (2, 50, 1 << 20, 1 << 40):
        centroids = [[int(x) for x in c] for c in rng.integers(-top, top + 1, (30, 4))]
        centroids += centroids[:5]  # equal ones: the smaller number wins
        v = rng.integers(-top, top + 1, (200, 4)).astype(float)
        winner, distance = bisector.Bisectors(centroids, p).nearest(bisector.integers(v, p.narrow))
        want = [min((sum((int(a) - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids)) for x in v]
        assert [(int(d), int(n)) for d, n in zip(distance, winner)] == want


def test_many_centroids_without_stored_pairs(monkeypatch):
    monkeypatch.setattr(bisector, "PAIR_BYTES", 0)
    test_tournament_is_the_plain_minimum()


def test_few_rows_and_empty(spark):
    p = bisector.Params(dims=2, k=40)
    same = [(1, [0.5, -0.5]), (2, [0.5, -0.5]), (2, [0.5, -0.5])]
    assert got(bisector.cluster(table(spark, same), p)) == plain(same, p)
    empty = bisector.cluster(table(spark, same).limit(0), p)
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert bisector.cluster(table(spark, [(1, None), (2, [1.0])]), p).count() == 0


def test_registered_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = con.execute(queries.ORACLE["op13_centroids"])
    df = queries.QUERIES["op13_centroids"](spark, SF)
    assert [c[0] for c in want.description] == df.columns
    assert got(df) == sorted(want.fetchall(), key=repr)
