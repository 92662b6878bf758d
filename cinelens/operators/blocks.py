"""What one task of the scoring grid does: the best unseen items of its users
in its block of items.

Rows are unit vectors (zero rows stay zero), dense or sparse, behind the same
three calls: ``len``, ``take`` and ``product``.

*Bounds.* A block's items are dealt into tiles around pivots (items of the
block, about the square root of their number): each item goes to the pivot it
is nearest to, and the tile's radius is the largest angle to it. On the unit
sphere angles obey the triangle inequality, so a user at angle t from the pivot
has a cosine of at most ``cos(max(0, t - radius))`` with any item of the tile.

*Early exit.* Each user scores the tile with the highest bound first. Other
tiles are scored only for users whose n-th best unseen similarity so far does
not exceed the tile's bound, and that similarity rises tile by tile. So users
stop early where items cluster; where bounds spare less than half of a chunk's
products, they are made for many tiles at once. The lists are the same either way: similarities are compared
as they are ranked, rounded to 9 digits, with room for the rounding of angles.
"""

from __future__ import annotations

import numpy as np

#: Users scored together, items of a tile of a block too small for bounds.
CHUNK_USERS, PLAIN_ITEMS = 256, 512
#: Room for the rounding of similarities (9 digits) and of angles near 0.
SLACK = 2e-7
#: Most columns of a block held densely, their bytes, and matching entries of a
#: step (few enough to stay in a core's cache).
SLAB, FULL_BYTES, MATCHES = 2048, 32 << 20, 1 << 17
#: Cost of a matching pair of entries in multiplications of a dense product.
MATCH_COST = 100
#: Items multiplied together where bounds spare less than half of a chunk.
WIDE_ITEMS = 8192


class Dense:
    def __init__(self, x: np.ndarray):
        self.x = x

    @classmethod
    def unit(cls, x: np.ndarray) -> "Dense":
        norms = np.linalg.norm(x, axis=1, keepdims=True)
        return cls(np.divide(x, norms, out=np.zeros_like(x), where=norms > 0))

    @classmethod
    def from_arrow(cls, column, dims: int) -> "Dense":
        """Unit rows from a list column, read as one flat buffer."""
        flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return cls.unit(flat.astype(np.float64, copy=False).reshape(-1, dims))

    def __len__(self) -> int:
        return len(self.x)

    def take(self, rows: np.ndarray) -> "Dense":
        return Dense(self.x[rows])

    def nonzero(self) -> np.ndarray:
        return self.x.any(axis=1)

    def index(self) -> "DenseIndex":
        return DenseIndex(self)

    def product(self, other: "Dense") -> np.ndarray:
        return self.x @ other.x.T


class Csr:
    """Sparse rows: row r holds ``idx[start[r]:start[r + 1]]``, ascending."""

    def __init__(self, start: np.ndarray, idx: np.ndarray, val: np.ndarray):
        self.start, self.idx, self.val = start, idx, val

    @classmethod
    def unit(cls, start: np.ndarray, idx: np.ndarray, val: np.ndarray) -> "Csr":
        rows = np.repeat(np.arange(len(start) - 1), np.diff(start))
        norms = np.sqrt(np.bincount(rows, val * val, len(start) - 1))[rows]
        return cls(start, idx, np.divide(val, norms, out=np.zeros_like(val), where=norms > 0))

    @classmethod
    def from_arrow(cls, column) -> "Csr":
        """Unit rows from a column of structs (idx, val) of lists."""
        whole = column.combine_chunks()
        idx, val = whole.field("idx"), whole.field("val")
        sizes = idx.value_lengths().to_numpy(zero_copy_only=False)
        start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return cls.unit(start, idx.flatten().to_numpy(zero_copy_only=False), val.flatten().to_numpy(zero_copy_only=False))

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> "Csr":
        sizes = self.start[rows + 1] - self.start[rows]
        start = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.repeat(self.start[rows] - start[:-1], sizes) + np.arange(start[-1])
        return Csr(start, self.idx[flat], self.val[flat])

    def nonzero(self) -> np.ndarray:
        rows = np.repeat(np.arange(len(self)), np.diff(self.start))
        return np.bincount(rows, self.val != 0, len(self)) > 0

    def index(self) -> "CsrIndex":
        return CsrIndex(self)

    def product(self, other: "Csr") -> np.ndarray:
        """All inner products."""
        held = other.index()
        return held.product(held.placed(self), 0, len(other))


class DenseIndex:
    """Rows that others are multiplied with, piece by piece."""

    def __init__(self, rows: Dense):
        self.x = rows.x

    def placed(self, users: Dense) -> Dense:
        return users

    def product(self, users: Dense, lo: int, hi: int) -> np.ndarray:
        return users.x @ self.x[lo:hi].T


class Placed:
    """Sparse rows by an index's column places, its full columns apart."""

    def __init__(self, full: np.ndarray, rest: Csr):
        self.full, self.rest = full, rest

    def __len__(self) -> int:
        return len(self.rest)

    def take(self, rows: np.ndarray) -> "Placed":
        return Placed(self.full[rows], self.rest.take(rows))


class CsrIndex:
    """Sparse rows sorted by column once, for products with many users.

    A column in which so many rows have a value that a dense product costs
    less than its matching entries is kept in a dense table (at most ``SLAB``
    columns and ``FULL_BYTES``); of the other columns entries are matched: they
    are sorted by ``place of the column * rows + row``, so that the entries of
    a column in a range of rows are next to each other.
    """

    def __init__(self, rows: Csr):
        n = self.n = max(len(rows), 1)
        self.columns, col = np.unique(rows.idx, return_inverse=True)
        held = np.bincount(col, minlength=len(self.columns)).astype(np.int64)
        width = max(min(SLAB, FULL_BYTES // (8 * n)), 1)
        full = np.flatnonzero(held * held * MATCH_COST > n * n)
        full = full[np.argsort(-held[full], kind="stable")[:width]]
        self.at = np.full(len(self.columns), -1)  # a full column's place in the table
        self.at[full] = np.arange(len(full))
        row = np.repeat(np.arange(len(rows)), np.diff(rows.start))
        dense = self.at[col] >= 0
        self.full = np.zeros((len(rows), len(full)))
        np.add.at(self.full, (row[dense], self.at[col[dense]]), rows.val[dense])
        key = col[~dense] * n + row[~dense]
        by = np.argsort(key, kind="stable")
        self.key, self.val = key[by], rows.val[~dense][by]
        self.start = np.searchsorted(self.key, np.arange(len(self.columns) + 1) * n)

    def placed(self, users: Csr) -> Placed:
        row, full = np.repeat(np.arange(len(users)), np.diff(users.start)), np.zeros((len(users), self.full.shape[1]))
        if not len(self.columns):
            return Placed(full, Csr(np.zeros(len(users) + 1, np.int64), users.idx[:0], users.val[:0]))
        col = np.minimum(np.searchsorted(self.columns, users.idx), len(self.columns) - 1)
        known = self.columns[col] == users.idx
        dense = known & (self.at[col] >= 0)
        np.add.at(full, (row[dense], self.at[col[dense]]), users.val[dense])
        rest = known & ~dense
        start = np.concatenate([[0], np.cumsum(np.bincount(row[rest], minlength=len(users)))]).astype(np.int64)
        return Placed(full, Csr(start, col[rest], users.val[rest]))

    def product(self, users: Placed, lo: int, hi: int) -> np.ndarray:
        """Inner products of the users with the rows from ``lo`` to ``hi``."""
        out = users.full @ self.full[lo:hi].T
        rest, width = users.rest, hi - lo
        row, col = np.repeat(np.arange(len(rest)), np.diff(rest.start)), rest.idx
        if lo == 0 and hi == self.n:
            first, last = self.start[col], self.start[col + 1]
        else:
            first, last = (np.searchsorted(self.key, col * self.n + x) for x in (lo, hi))
        some = np.flatnonzero(last > first)
        row, first, matches, val = row[some], first[some], (last - first)[some], rest.val[some]
        # What a matching entry's key is moved by to be its place in the rows' products.
        shift = -lo - col[some] * self.n
        ends, at = np.cumsum(matches), 0
        while at < len(row):
            before = ends[at] - matches[at]
            to = max(at + 1, int(np.searchsorted(ends, before + MATCHES, "right")))
            m, r = matches[at:to], slice(row[at], row[to - 1] + 1)
            flat = np.repeat(first[at:to] - (ends[at:to] - m - before), m) + np.arange(ends[to - 1] - before)
            place = np.repeat((row[at:to] - row[at]) * width + shift[at:to], m) + self.key[flat]
            some = out[r]
            some += np.bincount(place, np.repeat(val[at:to], m) * self.val[flat], some.size).reshape(some.shape)
            at = to
        return out


class Tiles:
    """A block's items by nearest pivot, with a bound for each tile."""

    def __init__(self, items, many: bool):
        n = len(items)
        solid = np.flatnonzero(items.nonzero())
        t = int(np.sqrt(len(solid)))
        self.pivots = None
        if not many or n <= PLAIN_ITEMS or t < 2:
            self.rows = [np.arange(at, min(at + PLAIN_ITEMS, n)) for at in range(0, n, PLAIN_ITEMS)]
        else:
            # Evenly spaced rows: items come in no order that matters.
            self.pivots = items.take(solid[np.arange(t) * len(solid) // t]).index()
            near, angle = np.empty(n, np.int64), np.empty(n)
            for at in range(0, n, 4 * PLAIN_ITEMS):
                part = np.arange(at, min(at + 4 * PLAIN_ITEMS, n))
                sims = self.pivots.product(self.pivots.placed(items.take(part)), 0, t)
                near[part] = sims.argmax(axis=1)
                angle[part] = np.arccos(np.clip(sims.max(axis=1), -1.0, 1.0))
            zero = np.ones(n, bool)
            zero[solid] = False
            near[zero] = t  # rows of zeros have similarity 0 to every user
            self.rows = [np.flatnonzero(near == j) for j in range(t + 1)]
            self.radius = np.array([angle[r].max() if len(r) else 0.0 for r in self.rows[:t]])
        # Items in tile order: tile j is the places from cuts[j] to cuts[j + 1].
        self.order = np.concatenate(self.rows) if n else np.empty(0, np.int64)
        self.cuts = np.concatenate([[0], np.cumsum([len(r) for r in self.rows])]).astype(np.int64)
        self.place = np.empty(n, np.int64)
        self.place[self.order] = np.arange(n)
        self.tile = np.repeat(np.arange(len(self.rows)), np.diff(self.cuts))
        self.index = items.take(self.order).index()

    def bounds(self, users) -> np.ndarray:
        """What a user's similarity to any item of a tile can be at most."""
        if self.pivots is None:
            return np.full((len(users), len(self.rows)), np.inf)
        sims = self.pivots.product(self.pivots.placed(users), 0, len(self.radius))
        angle = np.arccos(np.clip(sims, -1.0, 1.0))
        top = np.cos(np.maximum(angle - self.radius, 0.0))
        return np.concatenate([top, np.zeros((len(users), 1))], axis=1) + SLACK


def top_unseen(users, items, item_ids: np.ndarray, seen_rows: np.ndarray, seen_cols: np.ndarray, n: int):
    """(user place, item place, similarity) of the ``n`` best unseen items of
    each user, best first, and the number of pairs multiplied.

    ``seen_rows, seen_cols``: places of users and their seen items.
    """
    made, found = 0, []
    if not len(users) or not len(items):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), made
    n = min(n, len(items))
    tiles = Tiles(items, len(users) >= 2 * np.sqrt(len(items)))
    cuts, sizes = tiles.cuts, np.diff(tiles.cuts)
    seen_places = tiles.place[seen_cols]
    by = np.lexsort((seen_places, seen_rows // CHUNK_USERS))
    seen_rows, seen_places = seen_rows[by], seen_places[by]
    for start in range(0, len(users), CHUNK_USERS):
        plain = users.take(np.arange(start, min(start + CHUNK_USERS, len(users))))
        chunk = tiles.index.placed(plain)
        lo, hi = np.searchsorted(seen_rows // CHUNK_USERS, [start // CHUNK_USERS, start // CHUNK_USERS + 1])
        masked_rows, masked = seen_rows[lo:hi] - start, seen_places[lo:hi]
        bounds = tiles.bounds(plain)
        best = np.full((len(plain), n), -np.inf)  # the n best keys so far
        done = np.zeros(bounds.shape, bool)
        slot = np.empty(len(plain), np.int64)

        def score(first: int, last: int, rows: np.ndarray) -> int:
            """The tiles from first up to last, where a user has not had them."""
            lo, hi = cuts[first], cuts[last]
            if lo == hi or not len(rows):
                return 0
            sims = tiles.index.product(chunk.take(rows), lo, hi)
            key = np.round(sims, 9)
            had = done[rows, first:last]
            if had.any():
                key[np.repeat(had, sizes[first:last], axis=1)] = -np.inf
            done[rows, first:last] = True
            slot[:] = -1
            slot[rows] = np.arange(len(rows))
            hide = slice(*np.searchsorted(masked, [lo, hi]))
            at = slot[masked_rows[hide]]
            key[at[at >= 0], masked[hide][at >= 0] - lo] = -np.inf
            both = np.concatenate([best[rows], key], axis=1)
            kth = np.partition(both, -n, axis=1)[:, -n:]
            best[rows] = np.sort(kth, axis=1)
            r, c = np.nonzero((key >= best[rows][:, :1]) & np.isfinite(key))
            found.append((start + rows[r], tiles.order[lo + c], sims[r, c], key[r, c]))
            return int((~had @ sizes[first:last]).sum())

        if tiles.pivots is not None:
            leading = bounds.argmax(axis=1)
            for tile in np.unique(leading).tolist():
                made += score(tile, tile + 1, np.flatnonzero(leading == tile))
        open_tiles = ~done & (bounds >= best[:, :1])
        if 2 * (open_tiles @ sizes).sum() > len(plain) * len(items):
            # Bounds spare little here: many tiles at a time.
            first = 0
            while first < len(sizes):
                last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + WIDE_ITEMS, "right")) - 1)
                promise = ~done[:, first:last] & (bounds[:, first:last] >= best[:, :1])
                made += score(first, last, np.flatnonzero(promise.any(axis=1)))
                first = last
            continue
        # Tiles that promise most to anybody first, as they raise the bar.
        for tile in np.argsort(-np.where(done, -np.inf, bounds).max(axis=0), kind="stable").tolist():
            made += score(tile, tile + 1, np.flatnonzero(~done[:, tile] & (bounds[:, tile] >= best[:, 0])))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), made
    rows, cols, sims, key = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((item_ids[cols], -key, rows))
    rows, cols, sims = rows[order], cols[order], sims[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows, "left") < n
    return rows[keep], cols[keep], sims[keep], made
