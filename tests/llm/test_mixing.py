"""Mixing against a plain computation, and the SQL of op2."""

import duckdb
import pytest

from cinelens.llm import mixing, queries

from .fixtures import awkward, docs, words


def plain_targets(sizes, weights, cap):
    """Reshare what is over the cap, by weight, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        whole = sum(weight[s] for s in sizes if s not in capped)
        target = {s: cap * sizes[s] if s in capped else left * weight[s] / whole for s in sizes}
        over = {s for s in sizes if s not in capped and target[s] > cap * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1, "c": 500, "d": 7}, {None: 50, "x": 3, "": 9}, {"a": 5}, {"a": 0, "b": 10}, {"a": 4, "b": 4, "c": 4, "d": 400}])
def test_targets(spark, sizes):
    got = mixing.source_targets(spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long"))
    want = plain_targets(sizes, mixing.WEIGHTS, 3)
    for r in got.collect():
        assert r["target"] == pytest.approx(want[r["source"]])


def corpus():
    return [(i, " ".join(words(i, i * 7 % 40)), "en", [None, "a", "b", "b", "b", "b", "c", "b"][i % 8]) for i in range(200)]


def test_taken_and_positions(spark):
    rows = corpus()
    d = docs(spark, rows)
    got = mixing.mix(d).collect()
    taken, target = {}, {}
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == len(rows[r["doc_id"]][1].split()) and r["taken"] <= 3 * r["size"]
        taken[s], target[s] = taken.get(s, 0) + r["taken"], r["target"]
        assert r["taken"] == sum(c["words"] for c in r["copies"])
        assert all(0 <= c["position"] < 1 for c in r["copies"])
    assert all(taken[s] == int(target[s]) for s in taken)
    # Demand: each source's words before time t follow its schedule's integral.
    kinds = {s: i % 3 for i, s in enumerate(sorted(taken, key=lambda s: (s is None, s or "")))}
    for s, (w0, w1) in ((s, [(1.5, 0.5), (1, 1), (0.5, 1.5)][k]) for s, k in kinds.items()):
        for t in (0.25, 0.5, 0.75):
            before = sum(c["words"] for r in got if source[r["doc_id"]] == s for c in r["copies"] if c["position"] < t)
            assert abs(before - target[s] * (w0 * t + (w1 - w0) * t * t / 2)) <= 40
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(d.repartition(5)).collect()))


def test_arranged(spark):
    d = docs(spark, corpus())
    plan = {r["doc_id"]: r["taken"] for r in mixing.mix(d).collect()}
    out = mixing.arrange(d)
    assert out.columns == d.columns
    got = {}
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(r["text"].split())
    assert got == {k: v for k, v in plan.items() if v}


def test_schedules():
    knots = ((0.0, 0.0), (0.25, 2.0), (0.5, 0.0), (1.0, 1.0))
    parts = mixing.segments(knots)
    assert parts[0][0] == 0 and parts[-1][1] == pytest.approx(1) and parts[0][1] == pytest.approx(1 / 3)
    with pytest.raises(ValueError):
        mixing.segments(((0.0, 0.0), (1.0, 0.0)))


def test_awkward(spark):
    d = docs(spark, awkward())
    got = mixing.mix(d).collect()
    assert len(got) == len(awkward()) and sum(r["taken"] for r in got) == sum(r["size"] for r in got)
    empty = docs(spark, [(1, None), (2, "  ")])
    assert [r["taken"] for r in mixing.mix(empty).collect()] == [0, 0] and mixing.arrange(empty).count() == 0
    assert mixing.mix(d.limit(0)).count() == 0 and mixing.arrange(d.limit(0)).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    names = ["doc_id", "position", "size", "source_size", "taken", "target"]
    rows = lambda p: sorted((tuple(None if x != x else round(float(x), 6) for x in r) for r in p[names].itertuples(index=False)), key=str)
    got = queries.QUERIES["op2_source_mix"](spark, sf).toPandas()
    assert rows(got) == rows(con.execute(queries.ORACLE["op2_source_mix"]).df())
