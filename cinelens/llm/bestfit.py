"""Best-fit packing of documents, after a dominance reduction.

*Pieces.* A document is its token ids and ``end_id``. Only a document of more
than ``capacity`` tokens is cut, into whole sequences and a shorter last piece.

*The instance is a histogram.* Pieces of one length are interchangeable, so the
problem is the number of pieces of each length from 1 to ``capacity``, which
Spark counts. The plan is made on these counts alone: its size depends on the
capacity and not on the number of documents.

*Dominance* (Martello and Toth's reduction). A set of pieces that fits one
sequence together with piece j dominates the others with j if each of them can
be dealt into the set's members so that no share is longer than its member:
some best packing then holds the set, which is fixed for good. Fixed are

- a piece that no other one fits beside,
- two pieces that fill a sequence exactly,
- with a piece j (longest first) the longest one k that fits beside it, if no
  two fit there, or if none that do are longer together than k,
- j with the two pieces a and b that are longest together, if no three fit
  there, a is the longest that fits at all, and no two pieces longer than b fit.

As many copies at once as the counts allow, since taking away pieces only makes
the tests easier to pass. So the instance shrinks.

*Best fit.* What is left goes in, longest first, each piece to the open
sequence with least room that takes it. Equal pieces and sequences with equal
room are again handled by their number: of sequences with room r each takes
``r // length`` pieces, which is what best fit does one by one.

*Placing.* The plan says for each length which ranks go where: an interval of
ranks fills a run of sequences, some pieces to each, from a known place. Ranks
within a length are numbered by partition, from a table of one row for each
partition and length. So a piece finds its sequence and place by a binary
search in the broadcast plan; nothing is sorted or moved between workers.

A null text counts as empty and gives its end id alone. Rows that repeat a
doc_id, or have none, are packed as documents of their own. An empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelens.llm import tokens
from cinelens.llm.common import prepare, slices
from cinelens.operators.joins import broadcast_if_small
from cinelens.session import stored


@dataclass(frozen=True)
class Params:
    capacity: int = 4096
    end_id: int = 1


# ---------------------------------------------------------------- the plan


class Plan:
    """Where each rank of each length goes.

    ``rows``: (length, first rank, pieces, first sequence, pieces in each
    sequence, place in the sequence).
    """

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()  # by length; place 0 is unused
        self.done = np.zeros_like(self.left)
        self.rows: list[tuple[int, ...]] = []
        self.sequences = 0

    def put(self, length: int, pieces: int, first: int, each: int, place: int) -> None:
        self.rows.append((length, int(self.done[length]), pieces, first, each, place))
        self.done[length] += pieces
        self.left[length] -= pieces

    def fix(self, times: int, *lengths: int) -> None:
        """``times`` new sequences, each of one piece of each length."""
        place = 0
        for x in lengths:
            self.put(x, times, self.sequences, 1, place)
            place += x
        self.sequences += times

    def times(self, *lengths: int) -> int:
        """How often the pieces left allow this set."""
        return min(int(self.left[x]) // lengths.count(x) for x in lengths)


def smallest(left: np.ndarray, some: int) -> list[int]:
    """The ``some`` shortest pieces left, with repeats."""
    out: list[int] = []
    for x in np.flatnonzero(left)[:some].tolist():
        out += [x] * min(int(left[x]), some - len(out))
    return out


def reduce(plan: Plan, capacity: int) -> None:
    """Fixes dominating sets of up to three pieces."""
    for j in range(capacity, (capacity - 1) // 2, -1):
        times = plan.times(j, capacity - j) if j < capacity else int(plan.left[j])
        if times:
            plan.fix(times, *((j, capacity - j) if j < capacity else (j,)))
    for j in range(capacity - 1, 0, -1):
        while plan.left[j] and (found := dominating(plan.left, j, capacity)):
            plan.fix(plan.times(*found), *found)


def dominating(left: np.ndarray, j: int, capacity: int) -> tuple[int, ...] | None:
    """A set with piece ``j`` that dominates all others with it; None if these
    tests find none. Every piece left may be a partner, longer ones too."""
    others = left.copy()
    others[j] -= 1
    room = capacity - j
    low = smallest(others, 3)
    if not low or low[0] > room:
        return (j,)
    held = np.flatnonzero(others[: room + 1])
    k = int(held[-1])
    if k == room or sum(low[:2]) > room or len(low) < 2:
        return (j, k)
    if len(low) > 2 and sum(low) <= room:
        return None
    # Two at most fit beside j: the two that are longest together.
    partner = np.searchsorted(held, room - held, "right") - 1
    partner = np.minimum(partner, np.arange(len(held)))
    single = (partner >= 0) & (held[partner] == held) & (others[held] < 2)
    partner = np.where(single, partner - 1, partner)
    fine = np.flatnonzero(partner >= 0)
    sums = held[fine] + held[partner[fine]]
    # Of equal sums the one with the longest piece, which may be k.
    best = fine[len(fine) - 1 - int(np.argmax(sums[::-1]))]
    a, b = int(held[best]), int(held[partner[best]])
    if k >= a + b:
        return (j, k)
    if a == k:
        above = others.copy()
        above[: b + 1] = 0
        longer = smallest(above, 2)
        if len(longer) < 2 or sum(longer) > room:
            return (j, a, b)
    return None


def best_fit(plan: Plan, capacity: int) -> None:
    """Puts what is left, longest first, where least room is left over."""
    open_at: dict[int, list[tuple[int, int]]] = {}  # room to runs (first, sequences)
    rooms: list[int] = []

    def free(room: int, first: int, sequences: int) -> None:
        if room and sequences:
            if room not in open_at:
                open_at[room] = []
                insort(rooms, room)
            open_at[room].append((first, sequences))

    for x in np.flatnonzero(plan.left)[::-1].tolist():
        while n := int(plan.left[x]):
            at = bisect_left(rooms, x)
            if at < len(rooms):
                room = rooms[at]
                first, m = open_at[room].pop()
                if not open_at[room]:
                    del open_at[room]
                    rooms.pop(at)
            else:
                room, first = capacity, plan.sequences
                m = -(-n // (capacity // x))
                plan.sequences += m
            each = room // x
            full = min(m, n // each)
            if full:
                plan.put(x, full * each, first, each, capacity - room)
                free(room - each * x, first, full)
            if full < m:
                rest = min(n - full * each, each)
                if rest:
                    plan.put(x, rest, first + full, rest, capacity - room)
                    free(room - rest * x, first + full, 1)
                free(room, first + full + (rest > 0), m - full - (rest > 0))


def planned(counts: np.ndarray, capacity: int) -> Plan:
    """The plan for ``counts[length]`` pieces of each length."""
    plan = Plan(counts)
    reduce(plan, capacity)
    best_fit(plan, capacity)
    return plan


# ---------------------------------------------------------------- Spark jobs


def cut_documents(docs: DataFrame, params: Params, tokenizer: str | None, with_ids: bool) -> DataFrame:
    """One row for each piece, numbered by length within its partition."""
    shared = docs.sparkSession.sparkContext.broadcast(tokens.read(tokenizer or tokens.default_path()))
    c = params.capacity

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        enc, part = tokens.encoder(shared.value), TaskContext.get().partitionId()
        end, numbers = np.array([params.end_id], "<u4").tobytes(), np.zeros(c + 1, np.int64)
        for batch in slices(batches):
            rows, blobs = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                raw = enc.ids(text) + end
                for piece, at in enumerate(range(0, len(raw), 4 * c)):
                    ids = raw[at : at + 4 * c]
                    n = len(ids) // 4
                    rows.append((i, piece, at // 4, n, zlib.crc32(ids), numbers[n]))
                    numbers[n] += 1
                    if with_ids:
                        blobs.append(np.frombuffer(ids, "<u4").astype(np.int32))
            if rows:
                at, *cols = np.array(rows, np.int64).T
                arrays = [batch.column("doc_id").take(pa.array(at)), *map(pa.array, cols), pa.array(np.full(len(at), part))]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(blobs, pa.list_(pa.int32()))] * with_ids, names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "number", "part"] + ["ids"] * with_ids
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"`{n}` long" for n in names[1:7]) + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def place(pieces: DataFrame, plan: Plan, with_ids: bool) -> DataFrame:
    """``pieces`` with ``sequence_id, offset``, from their ``length, rank``."""
    rows = np.array(sorted(plan.rows), np.int64).reshape(-1, 6)
    # Intervals in order of (length, first rank): a search for each alone.
    starts = np.searchsorted(rows[:, 0], np.arange(len(plan.left) + 1))
    shared = pieces.sparkSession.sparkContext.broadcast((rows, starts))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
    extra = ["ids"] * with_ids

    def run(batches):
        import pyarrow as pa

        rows, starts = shared.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.empty(len(length), np.int64)
            for x in np.unique(length).tolist():
                mine = np.flatnonzero(length == x)
                lo, hi = starts[x], starts[x + 1]
                at[mine] = lo + np.searchsorted(rows[lo:hi, 1], rank[mine], "right") - 1
            _, first_rank, _, first, each, offset = rows[at].T
            turn = rank - first_rank
            found = [pa.array(first + turn // each), pa.array(offset + turn % each * length)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + found + [batch.column(c) for c in extra], names=[*keep, "sequence_id", "offset", *extra])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"`{n}` long" for n in [*keep[1:], "sequence_id", "offset"]) + ", ids array<int>" * with_ids
    return pieces.select(*keep, "rank", *extra).mapInArrow(run, schema)


def pack(docs: DataFrame, params: Params = Params(), tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of
    each piece of ``docs(doc_id, text)``; ``with_ids`` adds its ids.

    ``piece`` counts a document's pieces from 0, ``start`` its ids before it;
    ``offset`` is the piece's place in its sequence, without gaps from 0.
    """
    prepare(docs.sparkSession)
    pieces = stored(cut_documents(docs, params, tokenizer, with_ids))
    counts = stored(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")))
    totals = np.zeros(params.capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row for each length
        totals[r["length"]] = r["n"]
    order = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(counts.select("length", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before")))
    ranked = pieces.join(broadcast_if_small(before, before.count(), 40), ["length", "part"]).withColumn("rank", F.col("before") + F.col("number"))
    return place(ranked, planned(totals, params.capacity), with_ids)
