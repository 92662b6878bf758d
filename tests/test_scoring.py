import numpy as np
import pytest

from cinelens.operators import scoring
from cinelens.operators.scoring import top_n_unseen


def _brute(users, items, seen, n):
    out = {}
    iu = items / np.maximum(np.linalg.norm(items, axis=1, keepdims=True), 1e-300)
    for u, vec in users.items():
        un = vec / np.linalg.norm(vec) if np.linalg.norm(vec) > 0 else vec
        sims = [(round(float(un @ iu[j]), 9), j) for j in range(len(items)) if (u, j) not in seen]
        sims.sort(key=lambda t: (-t[0], t[1]))
        out[u] = [j for _, j in sims[:n]]
    return out


@pytest.mark.parametrize("limit", [None, 0])
def test_blocked_kernel_matches_brute_force(spark, monkeypatch, limit):
    if limit is not None:  # no semi join: seen rows of unscored users reach the kernel
        monkeypatch.setattr(scoring, "BROADCAST_LIMIT_BYTES", limit)
    rng = np.random.default_rng(0)
    n_items, n_users, d = 57, 23, 6
    items = rng.normal(size=(n_items, d))
    items[5] = 0.0  # zero vector: similarity 0
    items[7] = items[8]  # exact tie, broken by movieId
    users = {u: rng.normal(size=d) for u in range(n_users)}
    seen = {(u, int(j)) for u in range(n_users) for j in rng.choice(n_items, size=rng.integers(0, 30), replace=False)}
    seen |= {(3, j) for j in range(n_items) if j not in (1, 2)}  # user 3 has 2 unseen items
    p = spark.createDataFrame([(u, v.tolist()) for u, v in users.items()], "userId long, vec array<double>")
    it = spark.createDataFrame([(j, items[j].tolist()) for j in range(n_items)], "movieId long, vec array<double>")
    extra = {(999, j) for j in range(10)}  # a user with no profile
    sn = spark.createDataFrame(sorted(seen | extra), "userId long, movieId long")
    # A tiny memory budget forces several item blocks and user salts.
    got = top_n_unseen(p, it, sn, 5, d, items_per_block=10, users_per_group=4)
    lists = {}
    for r in got.collect():
        lists.setdefault(r.userId, []).append((r.rank, r.movieId))
    want = _brute(users, items, seen, 5)
    for u in users:
        assert [m for _, m in sorted(lists.get(u, []))] == want[u], u


def test_copies_are_made_in_rounds(spark, monkeypatch):
    """With both sides large the copies of a grid grow with the square of the
    input; what lies in shuffle files at once does not."""
    assert scoring.salts_at_once(1, 1, 10, 10) == 1
    assert scoring.salts_at_once(1, 1000, 1 << 26, 1000 << 26) == 1000  # few items: a copy or two of the users
    for n in (35, 350):  # blocks, and salts, of 64 MB
        side = n << 26
        copied = scoring.salts_at_once(n, n, side, side, 24) * (side + side * n // n)
        assert copied <= scoring.COPIES * 2 * side
    assert scoring.salts_at_once(4, 40, 4 << 26, 40 << 26, 24) >= 6  # no idle cores

    rng = np.random.default_rng(3)
    n_items, n_users, d = 40, 33, 5
    items = rng.normal(size=(n_items, d))
    users = {u: rng.normal(size=d) for u in range(n_users)}
    seen = {(u, int(j)) for u in range(n_users) for j in rng.choice(n_items, size=8, replace=False)}
    p = spark.createDataFrame([(u, v.tolist()) for u, v in users.items()], "userId long, vec array<double>")
    it = spark.createDataFrame([(j, items[j].tolist()) for j in range(n_items)], "movieId long, vec array<double>")
    parts, real = [], scoring.stored
    monkeypatch.setattr(scoring, "stored", lambda df: parts.append(real(df)) or parts[-1])
    want = _brute(users, items, seen, 4)
    for sn in (spark.createDataFrame(sorted(seen), "userId long, movieId long"), None):
        parts.clear()
        got = top_n_unseen(p, it, sn, 4, d, items_per_block=1, users_per_group=1)
        lists = {}
        for r in got.collect():
            lists.setdefault(r.userId, []).append((r.rank, r.movieId))
        assert len(parts) > 5
        expected = want if sn is not None else _brute(users, items, set(), 4)
        assert {u: [m for _, m in sorted(x)] for u, x in lists.items()} == expected
