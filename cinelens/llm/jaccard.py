"""Exact n-gram Jaccard join in the metric space of shingle sets.

Distance is 1 - |x ∩ y| / |x ∪ y|, a metric; x and y link at distance eps or
less. Equal sets are one class, held by its smallest doc_id.

*Document pivots.* From a bounded, documented sample come texts that stand
for large groups of near copies (an eps-net of the sampled texts most of whose
shingles recur in the sample). One pass measures every document against all of
them through an index of their shingles, which is broadcast (bounded by
``pivots`` and ``pivot_shingles``). A document's nearest pivot is the centre of
its region. Documents within eps of a pivot link to it. One at distance d can
only link to documents within d + eps of that pivot (triangle inequality): if
no document lies between eps and d + eps from it, it needs no other
comparison, and a group that holds a third of all rows ends here. All others
are boundary documents, replicated below.

*Shingle pivots.* Distances between unrelated texts are all close to 1, so
document pivots alone would leave nearly everything in one region. The rest is
partitioned by single shingles as pivots, in a total order: a document's home
region is its first shingle. If y links to x, then y holds at most
``n - ceil((1 - eps) n)`` shingles that x lacks; so y is replicated into the
regions of its first ``n - ceil((1 - eps) n) + 1`` shingles, the window that
inequality leaves open, and every linked pair meets in the region of its
smallest common shingle. The order puts shingles that are frequent in the
sample last, so that common passages rarely form regions; any order is exact.

*Recursion.* Regions are joined by :mod:`cinelens.llm.regions`: pivots within
a region, triangle-inequality windows, and again on what is left.

*Link counts.* Every link lies within a component, so the links of each
different set are counted there, once all components are known: a component's
sets are dealt into blocks of about ``block_shingles`` by hash, and each pair of
blocks is one group of a shuffle, so that a large component is spread over many
tasks, of which each holds two blocks. Overlaps are matrix products over the
shingles that both sides hold; only counts leave a task.

The sample only chooses pivots and the order; it has no effect on the result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelens.llm import kernels, regions
from cinelens.llm.common import prepare, slices, unit_hash
from cinelens.llm.components import components
from cinelens.operators.joins import broadcast_if_small
from cinelens.session import release, stored


@dataclass(frozen=True)
class Params:
    words: int = 4
    #: Linked if ``den * |x ∩ y| >= num * |x ∪ y|``.
    num: int = 85
    den: int = 100
    #: Documents sampled (about) to choose pivots and frequent shingles.
    sample_rows: int = 6000
    #: Times a shingle stands in the sample to count as frequent.
    frequent: int = 3
    max_frequent: int = 500_000
    pivots: int = 256
    pivot_shingles: int = 1_000_000
    #: Classes of the counts by which pairs are screened.
    classes: int = 256
    #: Shingles (about) of a block of sets whose links are counted together.
    block_shingles: int = 1 << 18


class Order:
    """Total order of shingles: frequent ones after all others."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray):
        by = np.argsort(frequent)
        self.counts, self.find = counts[by], kernels.Lookup(frequent[by])

    def count(self, shingles: np.ndarray) -> np.ndarray:
        out = np.zeros(len(shingles), np.int64)
        at, found = self.find(shingles)
        out[at] = self.counts[found]
        return out

    def first(self, shingles: np.ndarray, k: int) -> np.ndarray:
        """The first ``k`` of a sorted set."""
        count = self.count(shingles)
        rare = shingles[count == 0]
        if len(rare) >= k:
            return rare[:k]
        often = count > 0
        rest = shingles[often][np.argsort(count[often], kind="stable")]
        return np.concatenate([rare, rest])[:k]


class Pivots:
    """Index of the pivots' shingles: overlap of a set with all of them."""

    def __init__(self, sets: list[np.ndarray], params: Params):
        self.params, self.sizes = params, np.array([len(s) for s in sets], np.int64)
        if sets:
            every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
            by = np.argsort(every, kind="stable")
            self.every, self.owner = every[by], owner[by]
            keys, self.start = np.unique(self.every, return_index=True)
            self.find = kernels.Lookup(keys)
            self.end = np.append(self.start[1:], len(self.every))

    def near(self, shingles: np.ndarray) -> list[tuple[int, float, bool]]:
        """(pivot, distance, linked) of the pivots within twice eps."""
        if not len(self.sizes) or not len(shingles):
            return []
        at = self.find(shingles)[1]
        if not len(at):
            return []
        reps = self.end[at] - self.start[at]
        flat = np.repeat(self.start[at] - np.concatenate([[0], np.cumsum(reps)[:-1]]), reps) + np.arange(reps.sum())
        both = np.bincount(self.owner[flat], minlength=len(self.sizes))
        p = self.params
        union = len(shingles) + self.sizes - both
        hit = np.flatnonzero(p.den * both >= (2 * p.num - p.den) * union)
        return [(int(i), float(1 - both[i] / union[i]), bool(p.den * both[i] >= p.num * union[i])) for i in hit]


def _sample(docs: DataFrame, params: Params) -> tuple[Order, Pivots]:
    """Frequent shingles and pivots of a bounded sample."""
    # A row without an id takes no part, so it can be no pivot either.
    docs = docs.filter("doc_id is not null")
    total = docs.count()
    picked = docs.filter("text is not null").filter(unit_hash("text", F.lit(3)) < min(1.0, params.sample_rows / max(total, 1)))
    picked = stored(picked.select("text"))

    def shingles(batches):
        import pyarrow as pa

        for batch in slices(batches):
            sets = [kernels.shingle_set(t, params.words) for t in batch.column("text").to_pylist()]
            every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_pydict({"shingle": every.view(np.int64)})

    counts = picked.mapInArrow(shingles, "shingle long").groupBy("shingle").count().filter(F.col("count") >= params.frequent)
    top = counts.orderBy(F.desc("count"), "shingle").limit(params.max_frequent).toPandas()
    order = Order(top["shingle"].to_numpy(np.int64).view(np.uint64), top["count"].to_numpy(np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def recurring(batches):
        import pyarrow as pa

        for batch in slices(batches):
            found = []
            for t in batch.column("text").to_pylist():
                s = kernels.shingle_set(t, params.words)
                if len(s) and params.den * (shared.value.count(s) > 0).sum() >= params.num * len(s):
                    found.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64()))], names=["s"])

    # Several times the pivots wanted, as most are near one that came before.
    heads = picked.mapInArrow(recurring, "s array<long>").filter(F.size("s") <= params.pivot_shingles // 16).orderBy(F.xxhash64("s")).limit(8 * params.pivots).toPandas()
    net, room = Pivots([], params), params.pivot_shingles
    sets: list[np.ndarray] = []
    for s in heads["s"]:
        s = np.sort(np.asarray(s, np.int64).view(np.uint64))
        if len(sets) < params.pivots and len(s) <= room and not any(link for _, _, link in net.near(s)):
            sets.append(s)
            room -= len(s)
            net = Pivots(sets, params)
    release(picked)
    return order, net


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two longs."""
    d = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63)


def _measure(docs: DataFrame, order, pivots, params: Params) -> DataFrame:
    """``doc_id, n, hi, lo, near, cells, sketch``: size and 128-bit digest of
    each set, the pivots around it, its first shingles in the order, and its
    counts by class. The texts are shingled once for all of these.

    Every task ends with a row of n = -1 that sums up its documents: ``near``
    has the least distance beyond eps to each pivot, ``cells`` the pairs of
    pivots that some document links to both, one after the other. So what is
    needed of each pivot is never a row for each document and pivot."""

    def run(batches):
        import pyarrow as pa

        net, by = pivots.value, order.value
        ring: dict[int, float] = {}
        pairs: set[tuple[int, int]] = set()
        kind = pa.list_(pa.struct([("pivot", pa.int32()), ("dist", pa.float64()), ("link", pa.bool_())]))
        names = ["doc_id", "n", "hi", "lo", "near", "cells", "sketch"]
        for batch in slices(batches):
            n, hi, lo, near, cells, sketches = [], [], [], [], [], []
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                s = kernels.shingle_set(t, params.words)
                d = digest(s)
                n.append(len(s))
                hi.append(d[0])
                lo.append(d[1])
                around = net.near(s)
                near.append([{"pivot": p, "dist": d, "link": k} for p, d, k in around])
                if i is not None:
                    linked = sorted((d, p) for p, d, k in around if k)
                    pairs.update((linked[0][1], p) for _, p in linked[1:])
                    for p, d, k in around:
                        if not k and d < ring.get(p, np.inf):
                            ring[p] = d
                cells.append(by.first(s, len(s) - -(-params.num * len(s) // params.den) + 1).view(np.int64) if len(s) else [])
                sketches.append(kernels.sketch(s, params.classes))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(near, kind), pa.array(cells, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], names=names)
        sums = [[None], [-1], [0], [0], [[{"pivot": p, "dist": d, "link": False} for p, d in ring.items()]], [[p for pair in sorted(pairs) for p in pair]], [b""]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(sums, (*[pa.int64()] * 4, kind, pa.list_(pa.int64()), pa.binary()))], names=names)

    return docs.mapInArrow(run, "doc_id long, n long, hi long, lo long, near array<struct<pivot:int,dist:double,link:boolean>>, cells array<long>, sketch binary")


def _sets(docs: DataFrame, wanted: DataFrame, params: Params) -> DataFrame:
    """``node, members`` of the wanted documents (64-bit shingles, sorted)."""

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            found = [kernels.shingle_set(t, params.words).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], names=["node", "members"])

    ids = wanted.withColumnRenamed("node", "doc_id")
    return docs.join(broadcast_if_small(ids, ids.count(), 24), "doc_id", "left_semi").mapInArrow(run, "node long, members binary")


def _decode(batch) -> list[np.ndarray]:
    """Sets of a batch with a column members."""
    return [np.frombuffer(x, np.uint64) for x in batch.column("members").to_pylist()]


#: Rows of a matrix product, and shingles of one step of it.
ROWS, COLUMNS = 1024, 4096


def linked(a: list[np.ndarray], b: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Whether each set of ``a`` links to each of ``b``; sets are sorted and
    not empty."""
    n, m = (np.array([len(s) for s in x], np.int64) for x in (a, b))
    x, y = np.concatenate(a), np.concatenate(b)
    keys = np.intersect1d(x, y)
    both = np.zeros((len(a), len(b)))
    if len(keys):
        sides = []
        for every, sizes in ((x, n), (y, m)):
            at = np.minimum(np.searchsorted(keys, every), len(keys) - 1)
            held = np.flatnonzero(keys[at] == every)
            place, owner = at[held], np.repeat(np.arange(len(sizes)), sizes)[held]
            by = np.argsort(place, kind="stable")
            sides.append((place[by], owner[by], len(sizes)))
        for start in range(0, len(keys), COLUMNS):
            width = min(COLUMNS, len(keys) - start)
            tables = []
            for place, owner, rows in sides:
                lo, hi = np.searchsorted(place, [start, start + width])
                table = np.zeros((rows, width), np.float32)
                table[owner[lo:hi], place[lo:hi] - start] = 1
                tables.append(table)
            both += tables[0] @ tables[1].T
    both = both.astype(np.int64)
    return (both > 0) & (den * both >= num * (n[:, None] + m[None, :] - both))


def count_pairs(left: list[np.ndarray], right: list[np.ndarray] | None, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of each set of ``left`` and of ``right`` to the other side;
    without ``right``, to the others of ``left``."""
    same, right = right is None, left if right is None else right
    counts = [np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)]
    orders = [np.argsort([len(s) for s in side], kind="stable") for side in (left, right)]
    parts = [[o[i : i + ROWS] for i in range(0, len(o), ROWS)] for o in orders]
    for i, p in enumerate(parts[0]):
        for k, q in enumerate(parts[1]):
            # Sets of sizes too far apart cannot link.
            if same and k < i or den * len(left[p[-1]]) < num * len(right[q[0]]) or den * len(right[q[-1]]) < num * len(left[p[0]]):
                continue
            link = linked([left[x] for x in p], [right[x] for x in q], num, den)
            if same and i == k:
                counts[0][p] += link.sum(axis=1) - 1
            else:
                counts[0][p] += link.sum(axis=1)
                counts[0 if same else 1][q] += link.sum(axis=0)
    return counts[0], counts[1]


def _count_task(params: Params):
    """Task over rows (component, i, k, own, hi, lo, set) sorted by the first
    three: links of each set in its pair of blocks."""

    def count(rows: list) -> list[tuple[int, int, int]]:
        i, k = rows[0][1:3]
        sides = [[r for r in rows if r[3] == i], [r for r in rows if r[3] == k] if i != k else []]
        if not sides[0] or i != k and not sides[1]:
            return []
        sets = [[r[6] for r in side] for side in sides]
        found = count_pairs(sets[0], sets[1] if i != k else None, params.num, params.den)
        return [(r[4], r[5], int(n)) for side, counts in zip(sides, found) for r, n in zip(side, counts) if n]

    def run(batches):
        import pyarrow as pa

        group, names = [], ("component", "i", "k", "own", "hi", "lo")

        def sent(found):
            hi, lo, n = zip(*found) if found else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (hi, lo, n)], names=["hi", "lo", "links"])

        for batch in slices(batches):
            out, column = [], batch.column("set")
            for at, key in enumerate(zip(*(batch.column(c).to_pylist() for c in names))):
                if group and group[-1][:3] != key[:3]:
                    out += count(group)
                    group = []
                # A copy, which does not hold on to the whole batch.
                group.append((*key, column[at].values.to_numpy().view(np.uint64).copy()))
            yield sent(out)
        if group:
            yield sent(count(group))

    return run


def _link_counts(docs: DataFrame, found: DataFrame, params: Params) -> DataFrame:
    """``hi, lo, n_links`` of the sets that link to another one."""
    spark = docs.sparkSession
    members = stored(found.filter("doc_id is not null and n_shingles > 0").groupBy("hi", "lo").agg(
        F.min("component_id").alias("component"), F.first("class_id").alias("class_id"), F.first("n_shingles").alias("n")))
    sizes = stored(members.groupBy("component").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("sets")).filter("sets > 1").select(
        "component", F.ceil(F.col("total") / F.lit(float(params.block_shingles))).cast("long").alias("blocks")))
    several = stored(members.join(broadcast_if_small(sizes, sizes.count(), 24), "component").withColumn("own", F.expr("pmod(lo, blocks)")))
    release(members)

    def sets(batches):
        import pyarrow as pa

        for batch in slices(batches):
            hi, lo, found = [], [], []
            for t in batch.column("text").to_pylist():
                s = kernels.shingle_set(t, params.words)
                d = digest(s)
                hi.append(d[0])
                lo.append(d[1])
                found.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["hi", "lo", "set"])

    ids = several.select(F.col("class_id").alias("doc_id")).distinct()
    rows = several.count()
    texts = docs.join(broadcast_if_small(ids, rows, 24), "doc_id", "left_semi")
    whole = texts.select("text").mapInArrow(sets, "hi long, lo long, set array<long>").join(broadcast_if_small(several, rows, 56), ["hi", "lo"])
    whole = stored(whole.dropDuplicates(["hi", "lo"]).select("component", "blocks", "own", "hi", "lo", "set"))
    dealt = whole.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "component", F.least("own", "j").alias("i"), F.greatest("own", "j").alias("k"), "own", "hi", "lo", "set")
    key = ["component", "i", "k"]
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *key).sortWithinPartitions(*key)
    out = stored(dealt.mapInArrow(_count_task(params), "hi long, lo long, links long").groupBy("hi", "lo").agg(F.sum("links").alias("n_links")))
    release(sizes, several, whole)
    return out


def join(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id, n_links`` of each row of
    ``docs(doc_id, text)``. Rows of one set share a class; ``n_links`` is how
    many other sets the row's set links to, each looked at by itself (0 without
    words, null with a null doc_id).

    Words are runs of characters other than \\x20 and \\x09-\\x0D, with A-Z
    lower-cased; a set holds the distinct shingles of ``words`` words, the
    whole sequence if there are fewer, nothing without a word. A text without
    words (or null) links with nothing and is its own component. A row with a
    null doc_id has a null component and takes no part. Rows that repeat a
    doc_id are one document: it links where any of its texts does.
    """
    found = _components(docs, params)
    counts = _link_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), found, params)
    out = found.join(broadcast_if_small(counts, counts.count(), 32), ["hi", "lo"], "left")
    return out.select("doc_id", "n_shingles", "component_id", "class_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).alias("n_links"))


def _components(docs: DataFrame, params: Params) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id, hi, lo`` of each row."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order, net = _sample(docs, params)
    order, pivots = spark.sparkContext.broadcast(order), spark.sparkContext.broadcast(net)
    measured = stored(_measure(docs, order, pivots, params))
    full = measured.filter("doc_id is not null and n > 0")
    classes = stored(full.groupBy("hi", "lo").agg(F.min("doc_id").alias("class_id"), F.max("doc_id").alias("other")).filter("class_id < other").drop("other"))
    class_id = F.when(F.col("n") > 0, F.coalesce("class_id", "doc_id")).otherwise(F.col("doc_id"))
    named = measured.filter("n >= 0").join(classes, ["hi", "lo"], "left").withColumn("class_id", class_id)
    # Links that the document pivots give: a document to its nearest pivot, for
    # which the smallest node there stands, and pivots with one document near both.
    home = F.array_min(F.transform(F.filter("near", lambda x: x["link"]), lambda x: F.struct(x["dist"], x["pivot"])))["pivot"]
    ball = stored(named.filter("doc_id is not null").select(home.alias("pivot"), F.col("class_id").alias("b")).filter("pivot is not null").distinct())
    heads = ball.groupBy("pivot").agg(F.min("b").alias("a"))  # one row for each pivot
    sums = measured.filter("n = -1")
    links = ball.join(F.broadcast(heads), "pivot").select("a", "b")
    if len(net.sizes):
        both = sums.filter(F.size("cells") > 0).select(F.explode(F.transform(F.sequence(F.lit(1), F.size("cells"), F.lit(2)), lambda i: F.struct(F.element_at("cells", i).alias("p"), F.element_at("cells", i + 1).alias("q")))).alias("pair")).select("pair.*").distinct()
        first, second = (heads.select(F.col("pivot").cast("long").alias(c), F.col("a").alias(n)) for c, n in (("p", "a"), ("q", "b")))
        links = links.union(both.join(F.broadcast(first), "p").join(F.broadcast(second), "q").select("a", "b"))
    links = stored(links)
    release(ball)
    ring = np.full(len(net.sizes), np.inf)
    for r in sums.select(F.explode("near").alias("near")).groupBy("near.pivot").agg(F.min("near.dist").alias("dist")).collect():
        ring[r["pivot"]] = r["dist"]
    eps = 1 - params.num / params.den + 1e-9
    rings = F.array(*(F.lit(float(x)) for x in ring)) if len(ring) else F.array(F.lit(0.0))
    settled = F.exists("near", lambda x: x["link"] & (x["dist"] + F.lit(eps) < F.element_at(rings, x["pivot"] + 1)))
    heads_only = named.filter((F.col("doc_id") == F.col("class_id")) & (F.col("n") > 0) & ~settled)
    cells = heads_only.select(F.explode("cells").alias("cell"), F.col("class_id").alias("node"))
    groups = stored(regions.crowded(cells))
    sketches = heads_only.select(F.col("class_id").alias("node"), "n", "sketch")
    left = stored(regions.screened(groups.join(sketches, "node"), params.num, params.den))
    found = stored(regions.chained(left))
    release(groups, left)
    rows = stored(found.join(_sets(docs, found.select("node"), params), "node").select("cell", "node", "members"))
    more = regions.links(rows, _decode, params.num, params.den)
    known = links.unionByName(more)
    labels = components(known)
    out = stored(named.join(labels, named["class_id"] == labels["node"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "class_id").alias("component_id"), "class_id", "hi", "lo"))
    release(measured, classes, links, found, rows, more, labels)
    return out


def keep_one(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest
    doc_id, and with its columns (whatever their names). Documents without
    words and rows with a null doc_id stay; of rows that repeat a doc_id one
    stays (by hash of its text)."""
    named = _components(docs, params)
    ids = stored(named.filter("doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("head")))
    release(named)
    whole = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id") == F.col("id")
    gone = ids.filter("head = 0").select(F.col("doc_id").alias("id"))
    kept = whole.join(broadcast_if_small(gone, gone.count(), 24), same, "left_anti")
    repeated = ids.filter("head = 1 and rows > 1").select(F.col("doc_id").alias("id"))
    count = repeated.count()
    if count:
        several = broadcast_if_small(repeated, count, 24)
        order = Window.partitionBy("row.doc_id").orderBy(F.xxhash64("row.text"), "row.text")
        once = kept.join(several, same, "left_semi").withColumn("place", F.row_number().over(order)).filter("place = 1").select("row")
        kept = kept.join(several, same, "left_anti").unionByName(once)
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
