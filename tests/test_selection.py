"""Order statistics by histogram refinement, against sorting."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinelens.operators import profiling, selection

INF, NAN = float("inf"), float("nan")


def known(df, columns):
    row = df.agg(*[selection.facts(F.col(c).cast("double")) for c in columns]).first()
    return dict(zip(columns, row))


COLUMNS = {
    "spread": lambda rng, n: rng.normal(size=n) * 10.0 ** rng.integers(-12, 12, n),
    "few": lambda rng, n: rng.integers(0, 3, n).astype(float),
    "one": lambda rng, n: np.full(n, 2.5),
    "huge": lambda rng, n: rng.choice([-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324, 1e-300], n),
    "ends": lambda rng, n: rng.choice([-INF, INF, NAN, 1.0, 2.0], n),
    "close": lambda rng, n: 1.0 + rng.integers(0, 40, n) * 2.0**-52,
}


def test_every_rank_of_many_columns(spark):
    rng, n = np.random.default_rng(4), 60
    data = {c: make(rng, n).tolist() for c, make in COLUMNS.items()}
    data["few"][::4] = [None] * len(data["few"][::4])
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data)).repartition(3)
    order = {c: sorted((x for x in v if x is not None), key=lambda x: (math.isnan(x), 0.0 if math.isnan(x) else x)) for c, v in data.items()}
    got = selection.order_statistics(df, {c: set(range(len(v))) for c, v in order.items()}, known(df, list(data)))
    for c, v in order.items():
        for rank, want in enumerate(v):
            assert got[c, rank] == want or math.isnan(want) and math.isnan(got[c, rank]), (c, rank)


def test_passes_do_not_grow_with_columns(spark, monkeypatch):
    calls = []
    counted = selection._counted
    monkeypatch.setattr(selection, "_counted", lambda *a: calls.append(len(a[1])) or counted(*a))
    rng = np.random.default_rng(1)
    df = spark.createDataFrame(rng.normal(size=(400, 6)).tolist(), [f"c{i}" for i in range(6)])
    profiling.describe(df, ["c0"]).count()
    one, calls[:] = len(calls), []
    profiling.describe(df, df.columns).count()
    assert len(calls) <= one + 2 and max(calls) <= 18


@pytest.mark.parametrize("interpolation", ["nearest", "linear"])
def test_quantiles_and_describe(spark, interpolation):
    values = [3.0, None, 1.0, 10.0, 7.0, 7.0, -2.0]
    df = spark.createDataFrame([(x, None) for x in values], "`a b` double, empty double")
    clean = sorted(x for x in values if x is not None)
    got = {r["q"]: r["value"] for r in profiling.quantiles(df, "a b", (0.0, 0.1, 0.5, 1.0), interpolation).collect()}
    for q, x in got.items():
        at = q * (len(clean) - 1)
        assert x == pytest.approx(clean[math.floor(at + 0.5)] if interpolation == "nearest" else np.interp(at, range(len(clean)), clean))
    stats = {(r["column"], r["statistic"]): r["value"] for r in profiling.describe(df, ["a b", "empty"], interpolation).collect()}
    assert stats["a b", "count"] == 6 and stats["a b", "null_count"] == 1 and stats["a b", "max"] == 10 and stats["empty", "count"] == 0
    assert stats["empty", "50%"] is None and len(stats) == 18
    with pytest.raises(ValueError):
        profiling.quantiles(df, "a b", interpolation="middle")
