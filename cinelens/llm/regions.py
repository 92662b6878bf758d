"""Exact joins inside regions of a metric space: links, never candidate pairs.

The caller deals nodes into cells so that every linked pair shares one. A cell
is a region of the space of sets, with Jaccard distance, in which pairs at
distance eps or less link.

1. *Crowded cells* (:func:`crowded`). Cells with one node are left out, and of
   cells with the same nodes one stays, as near copies meet in many cells. Where
   rows carry a mark that tells most pairs without a link, a cell falls into
   the nodes that hang together by their marks.
2. *Screening* (:func:`screened`). Mapping sets to their counts by class does
   not lengthen distances: the sum of the counts' differences is at most the
   symmetric difference. Rows whose counts are too far from those of every
   other row of the cell for a link are left out, exactly. What is left of the
   cells is chained to regions (:func:`chained`), so that a node is in one. Only
   then do rows get what decides a pair (:func:`links` takes them with it).
3. *Large cells* (:func:`_split`) are split by pivots, some rows of the cell
   drawn by hash. A row's region is that of its nearest pivot p, and it is
   copied to the region of q if ``d(x, q) - d(x, p) <= 2 eps``: by the triangle
   inequality every linked pair then meets in the home region of either. A row
   within eps of its pivot links to it; if no row of the cell lies between eps
   and ``d(x, p) + eps`` from p, all its partners link to p as well, and it is
   settled (pivots that one row links to are linked). So a group of near copies
   ends here, however large, and the rest is
   split again. Rows are dealt by (cell, salt) with the pivots copied to each
   salt, so a cell is spread over many tasks. What pivots can't split, rows at
   like distances of each other, is dealt in pairs of blocks.
4. *Small regions* are decided by one task each (:class:`Region`), which holds
   at most ``2 * LIMIT`` rows. Rows gather in balls of radius eps around the
   first row that no ball took. A row is compared with the centres, and with
   members of a ball only where the triangle inequality leaves a link open and
   both are not connected yet. At most one link for each row leaves the task.

The links have the components of all linked pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm import kernels
from cinelens.llm.common import prepare, slices, unit_hash
from cinelens.llm.components import components
from cinelens.operators.joins import broadcast_if_small
from cinelens.session import release, stored

#: Rows of a region that one task decides, and pivots of a larger one.
LIMIT, PIVOTS = 4096, 32
#: A split that leaves more than this share of the rows is the last one.
SHRINK = 0.7
#: Copies at boundaries for each row of the cells split, at most: with more,
#: distances are too alike for pivots.
COPIES = 3
#: Nodes of a cell whose marks are compared; larger cells pass whole.
MARKED = 4096
#: Bytes of a (cell, count) row when broadcast.
CELL_ROW_BYTES = 32


def _named(nodes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A name made of the nodes, and the size, of each run; ``starts`` tells
    where runs begin. Runs that share a name by chance (one in 2**64 pairs) are
    one region, which costs comparisons but no link."""
    total = np.add.reduceat(kernels.mix64(nodes.view(np.uint64)), starts)
    sizes = np.diff(np.append(starts, len(nodes)))
    return kernels.mix64(total + sizes.astype(np.uint64)).view(np.int64), sizes


def hanging(group: np.ndarray, near: Callable) -> np.ndarray:
    """For each row the first row that it hangs together with, in steps for
    which ``near(rows, rows)`` is true. Rows come sorted by group; row i meets
    rows i + 1, i + 2, ..., where both do not hang together yet."""
    a = np.arange(len(group))
    sizes = np.diff(np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])) if len(group) else a
    follow = np.repeat(np.cumsum(sizes), sizes) - 1 - a  # rows of its group after it
    root = a.copy()
    step = 1
    while len(a := a[follow[a] >= step]):
        # Few rows take several steps at once, but not before copies are together.
        steps = min(max(PAIRS // len(a), 1), step)
        x, y = np.repeat(a, steps), (a[:, None] + np.arange(step, step + steps)).ravel()
        left = y - x <= follow[x]
        x, y = x[left], y[left]
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
        for at in range(0, len(x), PAIRS):
            i, j = x[at : at + PAIRS], y[at : at + PAIRS]
            found = near(i, j)
            for i, j in zip(i[found].tolist(), j[found].tolist()):
                while root[i] != i:
                    i = root[i]
                while root[j] != j:
                    j = root[j]
                root[max(i, j)] = min(i, j)
        while (root[root] != root).any():
            root = root[root]
        step += steps
    return root


def _whole(cells: np.ndarray, nodes: np.ndarray, marks: np.ndarray | None, near: Callable | None) -> tuple[np.ndarray, np.ndarray]:
    """``group, node`` of whole cells, sorted by cell; nodes may repeat."""
    many = np.r_[False, cells[1:] == cells[:-1], False]
    many = np.flatnonzero(many[1:] | many[:-1])
    many = many[np.lexsort((nodes[many], cells[many]))]
    cells, nodes = cells[many], nodes[many]
    fresh = np.r_[True, (cells[1:] != cells[:-1]) | (nodes[1:] != nodes[:-1])][: len(cells)]
    cells, nodes, many = cells[fresh], nodes[fresh], many[fresh]
    sizes = np.diff(np.flatnonzero(np.r_[True, cells[1:] != cells[:-1], True])) if len(cells) else np.empty(0, np.int64)
    size = np.repeat(sizes, sizes)
    left = size > 1
    cells, nodes, many, size = cells[left], nodes[left], many[left], size[left]
    if not len(cells):
        return cells, nodes
    part = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    part = np.repeat(part, np.diff(np.append(part, len(cells))))
    if near:
        marks, some = marks[many], np.flatnonzero(size <= MARKED)
        part[some] = some[hanging(part[some], lambda x, y: near(marks[some[x]], marks[some[y]]))]
        order = np.argsort(part, kind="stable")
        cells, nodes, part = cells[order], nodes[order], part[order]
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    names, sizes = _named(nodes, starts)
    names = np.repeat(np.where(sizes > LIMIT, cells[starts], names), sizes)
    many = np.repeat(sizes, sizes) > 1
    return names[many], nodes[many]


class _Cells:
    """The last cell of a sorted stream, which may go on in the next batch.
    At most LIMIT of its nodes are held; a larger cell keeps its own name."""

    def __init__(self, near: Callable | None):
        self.near, self.cell, self.held, self.size, self.large = near, None, [], 0, False

    def _joined(self) -> tuple[np.ndarray, np.ndarray | None]:
        return tuple(np.concatenate(x) if x[0] is not None else None for x in zip(*self.held))

    def close(self) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        if self.held and self.size > 1:
            nodes, marks = self._joined()
            out.append(_whole(np.zeros(len(nodes), np.int64), nodes, marks, self.near))
        self.cell, self.held, self.size, self.large = None, [], 0, False
        return out

    def add(self, cell: int, nodes: np.ndarray, marks: np.ndarray | None) -> list[tuple[np.ndarray, np.ndarray]]:
        out = [] if cell == self.cell else self.close()
        self.cell, self.size = cell, self.size + len(nodes)
        self.held.append((nodes, marks))
        if self.size > LIMIT:
            # Copies of a line come once for each task that read one.
            nodes, marks = self._joined()
            nodes, first = np.unique(nodes, return_index=True)
            self.held, self.size = [(nodes, marks[first] if self.near else None)], len(nodes)
            self.large |= self.size > LIMIT
        if self.large:
            out += [(np.full(len(x), cell), x) for x, _ in self.held]
            self.held = []
        return out


def _of_marks(near: Callable | None, spare: int) -> Callable | None:
    """``near`` of rows (mark, cell with spare bits)."""
    if not near or not spare:
        return near and (lambda x, y: near(x[:, 0], y[:, 0]))
    last = np.int64((1 << spare) - 1)
    return lambda x, y: near(x[:, 0], y[:, 0], more=(x[:, 1] ^ y[:, 1]) & last)


def _crowded_task(near: Callable | None, spare: int):
    """Rows (cell, node) sorted by cell: ``group, node`` of the cells with two
    nodes or more."""

    def run(batches):
        import pyarrow as pa

        open_cell = _Cells(_of_marks(near, spare))
        for batch in batches:
            cells, nodes = (batch.column(c).to_numpy() for c in ("cell", "node"))
            marks = np.stack([batch.column("mark").to_numpy(), cells], axis=1) if near else None
            cells = cells >> np.int64(spare)
            if not len(cells):
                continue
            of = lambda lo, hi: marks[lo:hi] if near else None  # noqa: B023, E731
            starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
            lo, hi = (starts[1], starts[-1]) if len(starts) > 1 else (len(cells), len(cells))
            out = open_cell.add(cells[0], nodes[:lo], of(0, lo))
            if len(starts) > 1:
                out += open_cell.close()
                if hi > lo:  # cells that lie wholly in this batch
                    out.append(_whole(cells[lo:hi], nodes[lo:hi], of(lo, hi), open_cell.near))
                out += open_cell.add(cells[-1], nodes[hi:], of(hi, len(cells)))
            for group, node in out:
                yield pa.RecordBatch.from_pydict({"group": group, "node": node})
        for group, node in open_cell.close():
            yield pa.RecordBatch.from_pydict({"group": group, "node": node})

    return run


def crowded(rows: DataFrame, near: Callable | None = None, spare: int = 0) -> DataFrame:
    """``group, node`` of ``rows(cell, node)`` (two longs): the cells that
    hold two different nodes, those with the same nodes once. A cell is read as
    a sorted stream. With ``near(marks, marks)``, which must be true of the
    marks of any two nodes that link, rows have a third long, ``mark``, and a
    cell of at most MARKED nodes falls into those that hang together. The last
    ``spare`` bits of ``cell`` are not the cell's but the mark's; ``near`` takes
    where they differ as ``more``."""
    prepare(rows.sparkSession)
    ordered = rows.select("cell", "node", *["mark"] * bool(near)).repartition(F.shiftright("cell", spare)).sortWithinPartitions("cell")  # one key is sorted by its bytes
    return ordered.mapInArrow(_crowded_task(near, spare), "group long, node long").distinct()


def near_rows(group: np.ndarray, n: np.ndarray, sketches: np.ndarray, num: int, den: int) -> np.ndarray:
    """For each row the first row that it hangs together with, in steps that
    the sketches allow to be links. Rows come sorted by group."""

    def near(x, y):
        # By size first, as the counts' sums differ by as much at least.
        out = den * np.minimum(n[x], n[y]) >= num * np.maximum(n[x], n[y])
        x, y = x[out], y[out]
        gap = np.abs(sketches[x].astype(np.int16) - sketches[y]).sum(axis=1, dtype=np.int64)
        out[out] = (den + num) * gap <= (den - num) * (n[x] + n[y])
        return out

    return hanging(group, near)


#: Pairs of rows compared at a time.
PAIRS = 1 << 13


def screened(rows: DataFrame, num: int, den: int) -> DataFrame:
    """``group, node`` of the ``rows(group, node, n, sketch)`` that may link to
    another one of their group: ``n`` is the size of the row's set, ``sketch``
    its counts by class (:func:`cinelens.llm.kernels.sketch`). A group falls
    into those of its rows that hang together. Groups of more than LIMIT rows
    pass as they are."""

    def run(batches):
        import pyarrow as pa

        held: list = []  # batches of the rows that may go on
        passed = None  # a group of which rows have passed already

        def decided(part: list, whole: bool):
            """Rows of groups that are complete; the last one is, if ``whole``."""
            table = pa.Table.from_batches(part).combine_chunks()
            group = table.column("group").to_numpy()
            end = len(group) if whole else int(np.searchsorted(group, group[-1]))
            done = table.slice(0, end)
            sizes = np.diff(np.flatnonzero(np.r_[True, group[1:end] != group[: end - 1], True])) if end else np.empty(0, np.int64)
            large = np.repeat(sizes, sizes) > LIMIT
            if passed is not None:
                large |= group[:end] == passed
            keep, name, node = large.copy(), group[:end].copy(), done.column("node").to_numpy()
            some = np.flatnonzero(~large)
            if len(some):
                sketches = np.stack([np.frombuffer(x, np.uint8) for x in done.column("sketch").take(pa.array(some)).to_pylist()])
                root = near_rows(name[some], done.column("n").to_numpy()[some], sketches, num, den)
                keep[some] = np.bincount(root, minlength=len(some))[root] > 1
                name[some] = kernels.mix64(kernels.mix64(name[some].view(np.uint64)) + node[some][root].view(np.uint64)).view(np.int64)
            return [pa.RecordBatch.from_pydict({"group": name[keep], "node": node[keep]})], table.slice(end).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            first, last = batch.column("group")[0].as_py(), batch.column("group")[-1].as_py()
            if held[0].column("group")[0].as_py() != last:
                out, held = decided(held, False)
                yield from out
            elif sum(b.num_rows for b in held) > LIMIT and first == last:
                # One group that is too large to hold: its rows pass.
                yield from (pa.RecordBatch.from_arrays([b.column("group"), b.column("node")], names=["group", "node"]) for b in held[:-1])
                held, passed = held[-1:], first
        if held:
            yield from decided(held, True)[0]

    ordered = rows.select("group", "node", "n", "sketch").repartition("group").sortWithinPartitions("group", "node")
    return ordered.mapInArrow(run, "group long, node long")


def chained(groups: DataFrame) -> DataFrame:
    """``cell, node``: the regions that ``groups(group, node)`` form where
    they overlap, so that a node is in one region only and its set travels
    once. Every pair that shares a group shares a region."""
    first = groups.groupBy("group").agg(F.min("node").alias("a"))
    chains = groups.join(first, "group").filter("a < node").select("a", F.col("node").alias("b"))
    return components(chains).select(F.col("component").alias("cell"), "node")


# --------------------------------------------------------------- one region


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common elements of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


class Region:
    """Links among sets that come one by one, up to their components."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.eps = 1 - num / den + 1e-9
        self.nodes: list[int] = []
        self.sets: list[np.ndarray] = []
        self.parent: list[int] = []
        self.balls: list[tuple[int, list[int], list[float]]] = []  # centre, members, their distances
        self.sizes = np.empty(0, np.int64)  # of the centres

    def _root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def _shared(self, i: int, j: int) -> tuple[float, bool]:
        """(distance, linked)."""
        x, y = self.sets[i], self.sets[j]
        both = overlap(x, y)
        union = len(x) + len(y) - both
        return 1 - both / union, self.den * both >= self.num * union

    def _join(self, i: int, j: int) -> tuple[int, int] | None:
        """A link between two components, which become one."""
        a, b = self._root(i), self._root(j)
        if a == b:
            return None
        self.parent[b] = a
        x, y = self.nodes[i], self.nodes[j]
        return None if x == y else (min(x, y), max(x, y))

    def add(self, node: int, members: np.ndarray) -> list[tuple[int, int]]:
        """Links of one more set to those before it. Not empty."""
        i, out, home = len(self.nodes), [], None
        self.nodes.append(node)
        self.sets.append(members)
        self.parent.append(i)
        n = len(members)
        low, high = np.minimum(self.sizes, n), np.maximum(self.sizes, n)
        # Distances are at least what the sizes tell.
        for b in np.flatnonzero(1 - low / np.maximum(high, 1) <= 2 * self.eps).tolist():
            centre, held, far = self.balls[b]
            d, link = self._shared(i, centre)
            if link:
                out.append(self._join(i, centre))
                if home is None:
                    home = b
                    held.append(i)
                    far.append(d)
            elif d <= 2 * self.eps:
                for j in (np.flatnonzero(np.abs(np.array(far) - d) <= self.eps)).tolist():
                    y = held[j]
                    if self._root(y) != self._root(i) and self._shared(i, y)[1]:
                        out.append(self._join(i, y))
        if home is None:
            self.balls.append((i, [], []))
            self.sizes = np.append(self.sizes, n)
        return [x for x in out if x]


def _region_task(decode: Callable, key: tuple[str, ...], num: int, den: int):
    def run(batches):
        import pyarrow as pa

        at, region = None, Region(num, den)
        for batch in slices(batches):
            out = []
            for where, node, members in zip(zip(*(batch.column(c).to_pylist() for c in key)), batch.column("node").to_pylist(), decode(batch)):
                if where != at:
                    at, region = where, Region(num, den)
                if len(members):
                    out += region.add(node, members)
            a, b = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


# ------------------------------------------------------------ large regions


def _near_task(decode: Callable, num: int, den: int):
    """Rows of one (cell, salt) against the cell's pivots: each row with its
    nearest pivot, whose distance, and the regions it belongs to; pivots that a
    row links to besides that one (rows without regions, once for each two
    pivots); and for each pivot the least distance beyond eps (rows without a
    node)."""
    eps = 1 - num / den + 1e-9

    def run(rows, pivots):
        import pyarrow as pa

        names = ["cell", "node"]
        sets, centres = (decode(t.combine_chunks().to_batches()[0]) if t.num_rows else [] for t in (rows, pivots))
        ids = pivots.column("node").to_numpy() if pivots.num_rows else np.empty(0, np.int64)
        home, dist, regions, both_near = [], [], [], set()
        ring = np.full(len(ids), np.inf)
        for s in sets:
            both = np.array([overlap(s, c) for c in centres], np.int64)
            union = np.array([len(c) for c in centres], np.int64) + len(s) - both
            d = 1 - both / np.maximum(union, 1)
            link = (den * both >= num * union) & (union > 0)
            ring = np.where(~link, np.minimum(ring, d), ring)
            if not len(ids):
                home, dist, regions = [*home, None], [*dist, None], [*regions, [0]]
                continue
            p = int(np.argmin(d))
            home.append(int(ids[p]))
            dist.append(float(d[p]) if link[p] else 2.0)
            regions.append(ids[d - d[p] <= 2 * eps].tolist())
            both_near.update((int(ids[p]), q) for q in ids[link].tolist() if q != ids[p])
        out = [rows.column(c).combine_chunks() for c in names]
        out += [pa.array(home, pa.int64()), pa.array(dist, pa.float64()), pa.array(regions, pa.list_(pa.int64()))]
        table = pa.Table.from_arrays(out, names=[*names, "home", "dist", "regions"])
        if len(ids) and rows.num_rows:
            cell = rows.column("cell")[0].as_py()

            def more(**fields):
                size = len(next(iter(fields.values())))
                fields = {"cell": [cell] * size, **fields}
                return pa.Table.from_arrays([pa.array(fields[f.name], f.type) if f.name in fields else pa.nulls(size, f.type) for f in table.schema], schema=table.schema)

            a, b = zip(*sorted(both_near)) if both_near else ((), ())
            table = pa.concat_tables([table, more(home=a, node=b, dist=[0.0] * len(a)), more(home=ids, dist=ring)])
        return table

    return run


def _split(rows: DataFrame, sizes: DataFrame, decode: Callable, num: int, den: int, depth: int, most: float) -> tuple[DataFrame, DataFrame | None]:
    """``(links, rows)`` of the large cells ``sizes(cell, n)`` after a split
    by pivots; the rows left are in cells of their own. No rows if copies at
    boundaries would make them more than ``most``."""
    eps = 1 - num / den + 1e-9
    payload = [c for c in rows.columns if c not in ("cell", "node")]
    salts = F.ceil(F.col("n") / F.lit(float(LIMIT))).cast("long")
    mine = rows.join(sizes, "cell").withColumn("salts", salts)
    drawn = stored(mine.filter(unit_hash("node", "cell", F.lit(depth)) < F.lit(float(PIVOTS)) / F.col("n")))
    spread = drawn.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    salted = mine.withColumn("salt", F.pmod(F.xxhash64("node", F.lit(depth)), F.col("salts")))
    keep = ["cell", "salt", "node", *payload]
    near = salted.select(*keep).groupBy("cell", "salt").cogroup(spread.select(*keep).groupBy("cell", "salt"))
    near = stored(near.applyInArrow(_near_task(decode, num, den), "cell long, node long, home long, dist double, regions array<long>"))
    found = near.filter("node is not null and dist <= 1 and home <> node").select(F.least("home", "node").alias("a"), F.greatest("home", "node").alias("b"))
    ring = near.filter("node is null").groupBy("cell", "home").agg(F.min("dist").alias("ring"))
    left = near.filter("node is not null").join(ring, ["cell", "home"], "left")
    left = left.filter(F.coalesce(F.col("dist") + F.lit(eps) >= F.col("ring"), F.lit(True)))
    left = stored(left.select("cell", "node", F.explode("regions").alias("region")).distinct())
    rest = None
    if left.count() <= most:
        region = F.xxhash64("cell", "region", F.lit(depth)).alias("cell")
        rest = stored(rows.join(left, ["cell", "node"]).select(region, "node", *payload))
    out = stored(found.distinct()), rest
    release(near, drawn, left)
    return out


def links(rows: DataFrame, decode: Callable, num: int, den: int) -> DataFrame:
    """Links ``(a, b)`` with the components of all pairs that share a cell
    and link: ``den * |x & y| >= num * |x | y|``.

    ``rows(cell, node, ...)``: two longs, and columns from which
    ``decode(batch)`` makes each row's set, a sorted array without repeats. A
    node with several sets links where any of them does. Empty sets link with
    nothing. ``rows`` are read several times: a stored table serves best.
    """
    spark = rows.sparkSession
    prepare(spark)
    found, depth, total, own_table = [], 0, math.inf, False
    payload = [c for c in rows.columns if c not in ("cell", "node")]
    while True:
        sizes = stored(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LIMIT))
        cells, now = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not cells or now > SHRINK * total:
            break
        known = broadcast_if_small(sizes, cells, CELL_ROW_BYTES)
        more, rest = _split(rows, known, decode, num, den, depth, COPIES * now)
        found.append(more)
        if rest is None:
            break
        both = stored(rows.join(broadcast_if_small(sizes.select("cell"), cells, CELL_ROW_BYTES), "cell", "left_anti").unionByName(rest))
        release(rest, sizes, *([rows] if own_table else []))
        rows, depth, total, own_table = both, depth + 1, now, True
    own = F.coalesce(F.ceil(F.col("n") / F.lit(float(LIMIT))), F.lit(1)).cast("long")
    dealt = rows.join(broadcast_if_small(sizes, cells, CELL_ROW_BYTES), "cell", "left").withColumn("blocks", own)
    block = F.pmod(F.xxhash64("node", F.lit(-1)), F.col("blocks"))
    # Every two blocks of a cell that is still large meet in a group.
    j = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = dealt.withColumn("own", block).withColumn("j", j).select("cell", F.least("own", "j").alias("block"), F.greatest("own", "j").alias("other"), "node", *payload)
    key = ("cell", "block", "other")
    ordered = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *key).sortWithinPartitions(*key, "node")
    out = ordered.mapInArrow(_region_task(decode, key, num, den), "a long, b long")
    for more in found:
        out = out.unionByName(more)
    out = stored(out.distinct())
    release(sizes, *found, *([rows] if own_table else []))
    return out
