import numpy as np
import pytest

from cinelens.operators import evaluate
from cinelens.operators.scoring import top_n_unseen

V = "movieId long, vec array<double>"
R = "userId long, movieId long, rating double, timestamp long"


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.5, 0.5]), (4, [0.8, 0.2]), (5, [0.3, 0.7])], V)


def _profile(spark, items, rows):
    """FX13 through train_profiles: no held-out row (held key matches none)."""
    r = spark.createDataFrame([(1, m, x, 0) for m, x in rows], R)
    lr = evaluate.liked_rows(r, spark.createDataFrame([(1,)], "userId long"), -1.0, 42)
    held = spark.createDataFrame([(1, -1, -1.0, -1)], "userId long, held_movieId long, held_rating double, held_epoch long")
    out = evaluate.train_profiles(lr, held, items).collect()
    return None if not out else np.array(out[0].vec)


def test_weighted_profile_fx13(spark, items):
    assert np.allclose(_profile(spark, items, [(1, 4.0), (2, 2.0)]), [2 / 3, 1 / 3])
    assert _profile(spark, items, [(99, 4.0), (100, 2.0)]) is None
    assert np.allclose(_profile(spark, items, [(1, 4.0), (99, 5.0), (2, 2.0)]), [2 / 3, 1 / 3])
    assert np.allclose(_profile(spark, items, [(1, 0.0), (2, 0.0)]), [0.5, 0.5])  # Q20


def test_ranking_fx14(spark, items):
    prof = spark.createDataFrame([(1, [1.0, 0.0])], "userId long, vec array<double>")
    two = top_n_unseen(prof, items, None, 2, 2).collect()
    assert len(two) == 2
    seen = spark.createDataFrame([(1, 1), (1, 4)], "userId long, movieId long")
    excl = top_n_unseen(prof, items, seen, 5, 2).collect()
    assert not {r.movieId for r in excl} & {1, 4}
    four = sorted(top_n_unseen(prof, items, None, 4, 2).collect(), key=lambda r: r.rank)
    assert four[0].movieId == 1


def test_leave_one_out_fx15(spark, items):
    rows = [(1, 1, 5.0, 1), (1, 2, 4.0, 2), (1, 3, 4.5, 3), (1, 4, 4.0, 4), (1, 5, 5.0, 5), (1, 1, 3.0, 6),
            (2, 1, 5.0, 1), (2, 2, 4.0, 2), (2, 3, 4.5, 3), (2, 4, 4.0, 4), (2, 5, 5.0, 5), (2, 2, 3.0, 6)]
    ratings = spark.createDataFrame(rows, R)
    ev = evaluate.evaluate_leave_one_out(items, ratings, 2, k=3)
    lists = ev.lists
    r = evaluate.record(ev).first()
    assert r.n_users == 2 and r.k == 3
    assert r.hit_rate_at_k == 0.0 and r.coverage_at_k == 0.0  # everything seen: empty lists
    assert sorted(r.users_evaluated) == [1, 2]
    assert lists.count() == 0
    res10, _, _ = evaluate.evaluate_leave_one_out(items, ratings, 2, min_liked=10)
    assert res10.first().n_users == 0


def test_hit_rate_masked_vs_unmasked(spark):
    # Q1: the held-out movie is always seen, so the parity hit rate is 0;
    # the unmasked rate can find it.
    items = spark.createDataFrame([(i, [1.0, 0.01 * i]) for i in range(1, 8)] + [(9, [0.0, 1.0])], V)
    rows = [(1, m, 5.0, m) for m in range(1, 7)]
    res, lists, _ = evaluate.evaluate_leave_one_out(items, spark.createDataFrame(rows, R), 2, k=2)
    r = res.first()
    assert r.hit_rate_at_k == 0.0 and r.n_users == 1
    assert r.hit_rate_at_k_unmasked == 1.0
    assert 0.0 < r.coverage_at_k <= 1.0


def test_last_rating_taken_over_training_rows(spark):
    # Q14: movie 1 liked twice; whichever copy is held out, the other copy
    # weighs its own rating (the last among the rows that remain).
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], V)
    r = spark.createDataFrame([(1, 1, 4.0, 1), (1, 1, 5.0, 2), (1, 2, 4.0, 3)], R)
    rows = evaluate.liked_rows(r, spark.createDataFrame([(1,)], "userId long"), 4.0, 42)
    for held_row in [(1, 1, 4.0, 1), (1, 1, 5.0, 2), (1, 2, 4.0, 3)]:
        held = spark.createDataFrame([held_row], "userId long, held_movieId long, held_rating double, held_epoch long")
        vec = np.array(evaluate.train_profiles(rows, held, items).first().vec)
        left = [x for x in [(1, 4.0, 1), (1, 5.0, 2), (2, 4.0, 3)] if (1,) + x != held_row]
        last = {}
        for m, rating, ep in sorted(left, key=lambda t: t[2]):
            last[m] = rating
        w = {1: 0.0, 2: 0.0}
        for m, _, _ in left:
            w[m] += last[m]
        want = np.array([w[1], w[2]]) / (w[1] + w[2])
        assert np.allclose(vec, want), held_row
