"""Regions: crowded cells, exact links, the split of large cells."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinelens.llm import jaccard, kernels, linededup, regions

from .fixtures import docs, words
from .test_near_copies import brute, near_copies, roots


#: A lambda, as workers can't import this module.
decode = lambda batch: [np.frombuffer(x, np.uint64) for x in batch.column("members").to_pylist()]


def table(spark, cells):
    """``cells``: {cell: {node: set}}"""
    rows = [(c, n, np.array(sorted(s), np.uint64).tobytes()) for c, nodes in cells.items() for n, s in nodes.items()]
    return spark.createDataFrame([(c, n, bytearray(m)) for c, n, m in rows], "cell long, node long, members binary")


def linked(x, y, num, den):
    both = len(x & y)
    return both > 0 and den * both >= num * (len(x) + len(y) - both)


def want(cells, num, den):
    every = {n for nodes in cells.values() for n in nodes}
    return roots(every, [(a, b) for nodes in cells.values() for a, b in combinations(nodes, 2) if linked(nodes[a], nodes[b], num, den)])


def spheres(rng, groups, size, width, spread):
    """Sets around centres, at distances on either side of eps."""
    out, n = {}, 0
    for g in range(groups):
        base = {g * 1000 + i for i in range(width)}
        for _ in range(size):
            s = set(base)
            for x in rng.sample(sorted(base), rng.randint(0, spread)):
                s.discard(x)
                s.add(10**6 + rng.randrange(60))
            out[n], n = s, n + 1
    return out


@pytest.mark.parametrize("limit, pivots", [(4096, 32), (15, 4), (15, 200), (6, 1)])
def test_links_have_the_components_of_all_pairs(spark, monkeypatch, limit, pivots):
    monkeypatch.setattr(regions, "LIMIT", limit)
    monkeypatch.setattr(regions, "PIVOTS", pivots)
    rng = random.Random(limit + pivots)
    a = spheres(rng, 4, 40, 24, 4)
    cells = {7: a, 8: {n + 1000: s for n, s in spheres(rng, 1, 90, 30, 1).items()}, 9: {1: a[1], 2: a[2], 5000: set()}, 10: {6000: {1, 2}}}
    # Copies of one set, and rows at like distances that no pivot splits.
    cells[11] = {7000 + i: {1, 2, 3} for i in range(50)}
    cells[12] = {8000 + i: {*range(8), *rng.sample(range(100, 140), 2)} for i in range(40)}
    got = regions.links(table(spark, cells).repartition(5), decode, 80, 100)
    pairs = [(r["a"], r["b"]) for r in got.collect()]
    every = {n: s for nodes in cells.values() for n, s in nodes.items()}
    assert all(a < b and linked(every[a], every[b], 80, 100) for a, b in pairs)
    assert roots(every, pairs) == want(cells, 80, 100)


def test_region_sends_a_link_a_row_at_most():
    rng = random.Random(3)
    for _ in range(30):
        sets = list(spheres(rng, 3, 30, 20, 4).values())
        region, sent = regions.Region(85, 100), []
        for n, s in enumerate(sets):
            sent += region.add(n, np.array(sorted(s), np.uint64))
        assert len(sent) < len(sets)
        assert roots(range(len(sets)), sent) == want({0: dict(enumerate(sets))}, 85, 100)


def test_a_node_with_several_sets(spark):
    rows = [(1, 5, {1, 2, 3}), (1, 5, {7, 8, 9}), (1, 6, {7, 8, 9}), (1, 9, {1, 2, 3}), (1, 5, {1, 2, 3})]
    df = spark.createDataFrame([(c, n, bytearray(np.array(sorted(s), np.uint64).tobytes())) for c, n, s in rows], "cell long, node long, members binary")
    pairs = [tuple(r) for r in regions.links(df, decode, 80, 100).collect()]
    assert set(roots([5, 6, 9], pairs).values()) == {5}
    assert regions.links(df.limit(0), decode, 80, 100).count() == 0


@pytest.mark.parametrize("batch", [3, 10_000])
def test_crowded_cells(spark, batch):
    rng = random.Random(1)
    cells = {c: {rng.randrange(60) for _ in range(rng.choice([1, 1, 2, 3, 9]))} for c in range(-200, 200)}
    cells[500], cells[501] = set(range(30)), set(range(30))
    cells[502] = {*range(30), 99}
    cells[900], cells[901] = set(range(10_000)), set(range(10_000))  # too large to be named by their nodes
    rows = [(c, n) for c, nodes in cells.items() for n in nodes for _ in range(rng.choice([1, 1, 2]))]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {}
        for r in regions.crowded(spark.createDataFrame(rows, "cell long, node long")).collect():
            got.setdefault(r["group"], []).append(r["node"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    small = {frozenset(n) for n in cells.values() if 1 < len(n) <= regions.LIMIT}
    assert all(len(set(n)) == len(n) for n in got.values())
    assert sorted(map(sorted, got.values())) == sorted([*map(sorted, small), *[list(range(10_000))] * 2])


def test_columns_with_clashing_names(spark):
    """Extra columns named like those that the stages make for themselves."""
    names = ["id", "row", "gone", "hash", "place", "_id", "_n", "_gone", "_hash", "rows", "head", "cell", "members"]
    base = " ".join(words(1, 40))
    texts = [(1, base), (2, base + " more"), (3, base), (3, base), (4, None), (None, base), (5, "short line\n" + base)]
    df = spark.createDataFrame([(d, t, *[i] * len(names)) for i, (d, t) in enumerate(texts)], "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    df = df.unionByName(df.limit(2))  # repeated rows
    for out in (jaccard.keep_one(df), linededup.remove(df)):
        assert out.columns == df.columns and out.count() >= 3
        assert all(r[n] == r["_id"] for r in out.collect() for n in names)
    kept = jaccard.keep_one(df).collect()
    assert sorted((r["doc_id"] or 0) for r in kept if r["text"]) == sorted([0, 1])
    assert [r["text"] for r in linededup.remove(df).filter("doc_id = 5").collect()] == ["short line"]


@pytest.mark.parametrize("limit", [4096, 20])
def test_join_where_cells_are_large(spark, monkeypatch, limit):
    """Without document pivots a group of near copies is one large cell."""
    monkeypatch.setattr(regions, "LIMIT", limit)
    rows = near_copies(4, 12)
    params = jaccard.Params(pivots=0)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(docs(spark, rows), params).collect()}
    assert got == brute(rows, params)


@pytest.mark.parametrize("batch", [3, 10_000])
def test_screening_keeps_every_row_with_a_link(spark, batch):
    rng = random.Random(5)
    groups = {g: list(spheres(rng, 3, rng.choice([1, 2, 5, 20]), 30, 8).items()) for g in range(30)}
    groups[99] = [(n, {n, n + 1, n + 2}) for n in range(6000)]  # too large to hold: all pass
    hashed = lambda s: np.unique(kernels.mix64(np.array(sorted(s), np.uint64)))
    rows = [(g, 100_000 * g + n, len(s), bytearray(kernels.sketch(hashed(s), 64))) for g, some in groups.items() for n, s in some]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch if batch > 3 else 50)
    try:
        df = spark.createDataFrame(rows, "group long, node long, n long, sketch binary")
        got = {r["node"]: r["group"] for r in regions.screened(df, 85, 100).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {n for n, g in got.items() if g == 99} == {100_000 * 99 + n for n in range(6000)}
    left = 0
    for g, some in groups.items():
        if g != 99:
            for a, x in some:
                for b, y in some:
                    if a != b and linked(x, y, 85, 100):
                        assert got[100_000 * g + a] == got[100_000 * g + b]
            left += len(some) - sum(n // 100_000 == g for n in got)
    assert left > 50  # rows far from all others go


def test_sketches_of_lines():
    lines = [b"abcabcabc", b"x", "é天é天é天".encode(), b" ".join(b"word%d" % i for i in range(90)), b"abcabcabc"]
    for ks in ([5] * 5, [2, 3, 2, 5, 5]):
        n, counts = linededup.sketched(ks, lines, 128)
        for i, (k, line) in enumerate(zip(ks, lines)):
            s = np.unique(linededup.shingles([line], k)[0])
            assert n[i] == len(s) and counts[i].tobytes() == kernels.sketch(s, 128)
