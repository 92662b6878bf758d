"""Kernels of the scoring grid: sparse products, bounds, early exit."""

import numpy as np
import pytest

from cinelens.operators import blocks


def dense_of(c, width):
    out = np.zeros((len(c), width))
    out[np.repeat(np.arange(len(c)), np.diff(c.start)), c.idx] = c.val
    return out


def random_csr(rng, rows, width, most, zero=()):
    sizes = rng.integers(0, most + 1, rows)
    sizes[list(zero)] = 0
    idx = [np.sort(rng.choice(width, n, replace=False)) for n in sizes]
    start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    every = np.concatenate([*idx, np.empty(0, np.int64)]).astype(np.int64)
    return blocks.Csr.unit(start, every, rng.random(len(every)) + 0.1)


def plain(users, items, ids, seen, n):
    out = []
    for u in range(len(users)):
        sims = users[u] @ items.T
        best = sorted((-round(float(s), 9), ids[j], j) for j, s in enumerate(sims) if (u, j) not in seen)[:n]
        out += [(u, j) for _, _, j in best]
    return out


@pytest.mark.parametrize("cost", [0, 40, 10**12])
@pytest.mark.parametrize("slab, matches", [(2048, 1 << 21), (3, 5)])
def test_sparse_product(monkeypatch, cost, slab, matches):
    """By matching entries, in slabs, and in small steps of either."""
    for name, value in (("MATCH_COST", cost), ("SLAB", slab), ("MATCHES", matches)):
        monkeypatch.setattr(blocks, name, value)
    rng = np.random.default_rng(1)
    a, b = random_csr(rng, 17, 60, 20, zero=(0, 5)), random_csr(rng, 23, 60, 40, zero=(22,))
    assert np.allclose(a.product(b), dense_of(a, 60) @ dense_of(b, 60).T, atol=1e-12)
    rows = np.array([3, 3, 0, 16])
    assert np.allclose(dense_of(a.take(rows), 60), dense_of(a, 60)[rows])
    assert a.nonzero().tolist() == dense_of(a, 60).any(axis=1).tolist()
    none = a.take(np.empty(0, np.int64))
    assert none.product(b).shape == (0, 23) and a.product(none).shape == (17, 0)


def case(rng, kind, n_users, n_items, clustered):
    """Users, items (ids in any order), with ties, zero rows and seen pairs."""
    if kind == "dense":
        width = 8
        centres = rng.normal(size=(12, width))
        make = lambda n: centres[rng.integers(0, 12, n)] + 0.05 * rng.normal(size=(n, width)) if clustered else rng.normal(size=(n, width))
        x, y = make(n_users), make(n_items)
        x[0] = y[min(3, n_items - 1)] = 0
        y[n_items // 2 :: 7] = y[0]
        users, items = blocks.Dense.unit(x), blocks.Dense.unit(y)
        return users, items, users.x, items.x
    width = 300
    if clustered:
        def make(n):
            base = rng.integers(0, 12, n)
            idx = [np.unique(np.r_[20 * b + rng.choice(20, 18, replace=False), 250 + rng.integers(0, 50, 1)]) for b in base]
            start = np.concatenate([[0], np.cumsum([len(i) for i in idx])]).astype(np.int64)
            return blocks.Csr.unit(start, np.concatenate(idx), np.ones(start[-1]))
        users, items = make(n_users), make(n_items)
    else:
        users, items = random_csr(rng, n_users, width, 30, zero=(0,)), random_csr(rng, n_items, width, 15, zero=(min(3, n_items - 1),))
    return users, items, dense_of(users, width), dense_of(items, width)


@pytest.mark.parametrize("kind", ["dense", "sparse"])
@pytest.mark.parametrize("clustered", [False, True])
@pytest.mark.parametrize("n_users, n_items, n", [(300, 900, 10), (5, 40, 3), (60, 700, 1), (40, 30, 50), (1, 1, 2)])
def test_top_unseen(monkeypatch, kind, clustered, n_users, n_items, n):
    monkeypatch.setattr(blocks, "PLAIN_ITEMS", 64)
    monkeypatch.setattr(blocks, "CHUNK_USERS", 64)
    rng = np.random.default_rng(n_items + n)
    users, items, x, y = case(rng, kind, n_users, n_items, clustered)
    ids = rng.permutation(n_items) * 3
    seen = {(int(u), int(j)) for u in range(n_users) for j in rng.choice(n_items, rng.integers(0, max(n_items // 3, 1)), replace=False)}
    # The best items of some users are seen, so that they have to look further.
    seen |= {(u, int(j)) for u in range(0, n_users, 2) for j in np.argsort(-(x[u] @ y.T))[: n_items // 4]}
    seen |= {(n_users - 1, j) for j in range(1, n_items)}
    pairs = np.array(sorted(seen) or np.empty((0, 2)), np.int64).reshape(-1, 2)
    rows, cols, sims, made = blocks.top_unseen(users, items, ids, pairs[:, 0], pairs[:, 1], n)
    assert list(zip(rows.tolist(), cols.tolist())) == plain(x, y, ids, seen, n)
    assert np.allclose(sims, (x[rows] * y[cols]).sum(axis=1), atol=1e-12)
    assert made <= n_users * n_items


def test_products_are_spared_where_items_cluster():
    shares = {}
    for kind in ("dense", "sparse"):
        for clustered in (True, False):
            users, items, _, _ = case(np.random.default_rng(2), kind, 512, 4096, clustered)
            none = np.empty(0, np.int64)
            made = blocks.top_unseen(users, items, np.arange(4096), none, none, 10)[3]
            shares[kind, clustered] = made / (512 * 4096)
    print(shares)
    assert shares["dense", True] < 0.3 and shares["sparse", True] < 0.5
    assert max(shares.values()) <= 1


def test_no_rows():
    none = np.empty(0, np.int64)
    some = blocks.Dense.unit(np.ones((2, 3)))
    for users, items in ((some.take(none), some), (some, some.take(none))):
        assert [len(c) for c in blocks.top_unseen(users, items, np.arange(len(items)), none, none, 3)[:3]] == [0, 0, 0]


def test_many_tiles_are_multiplied_together_where_bounds_spare_little(monkeypatch):
    """Unrelated sparse rows: a chunk's products are few calls, not one a tile."""
    users, items, _, _ = case(np.random.default_rng(4), "sparse", 512, 4096, False)
    calls, product = [], blocks.CsrIndex.product
    monkeypatch.setattr(blocks.CsrIndex, "product", lambda self, u, lo, hi: calls.append((hi - lo) * len(u)) or product(self, u, lo, hi))
    none = np.empty(0, np.int64)
    made = blocks.top_unseen(users, items, np.arange(4096), none, none, 10)[3]
    assert made > 0.9 * 512 * 4096
    assert sum(size > blocks.CHUNK_USERS * 4096 // 2 for size in calls) == 512 // blocks.CHUNK_USERS


def test_full_columns_are_dense(monkeypatch):
    monkeypatch.setattr(blocks, "SLAB", 3)
    rng = np.random.default_rng(5)
    a, b = random_csr(rng, 17, 9, 9), random_csr(rng, 23, 9, 9)
    index = b.index()
    assert index.full.shape == (23, 3)
    assert np.allclose(index.product(index.placed(a), 5, 14), (dense_of(a, 9) @ dense_of(b, 9).T)[:, 5:14], atol=1e-12)
