"""Best-fit packing: the reduction, the plan, and an exact round trip."""

import zlib
from functools import lru_cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from cinelens.llm import bestfit, queries, tokens

from .fixtures import awkward, docs, words


@pytest.fixture(scope="module")
def own():
    return Tokenizer.from_file(tokens.default_path())


def fewest(lengths, capacity):
    """The fewest sequences, by trying every subset (small cases only)."""
    n = len(lengths)
    fits = [m for m in range(1, 1 << n) if sum(x for i, x in enumerate(lengths) if m >> i & 1) <= capacity]

    @lru_cache(None)
    def best(left):
        if not left:
            return 0
        low = left & -left
        return 1 + min(best(left & ~m) for m in fits if m & low and m & left == m)

    return best((1 << n) - 1)


def histogram(lengths, capacity):
    return np.bincount(lengths, minlength=capacity + 1)


def unfolded(plan, capacity):
    """Lengths in each sequence, after checking offsets."""
    held = {}
    for length, rank, pieces, first, each, place in plan.rows:
        for turn in range(pieces):
            held.setdefault(first + turn // each, []).append((place + turn % each * length, length))
    for x in held.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= capacity
    return [[n for _, n in sorted(x)] for x in held.values()]


def one_by_one(lengths, capacity):
    """Best fit decreasing, the plain way: sequences used."""
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - x)
        else:
            rooms.append(capacity - x)
    return len(rooms)


def test_reduction_keeps_the_optimum():
    rng = np.random.default_rng(3)
    reduced = 0
    for trial in range(150):
        capacity = int(rng.integers(8, 40))
        lengths = rng.integers(1 if trial % 2 else capacity // 5, capacity + 1, int(rng.integers(1, 10))).tolist()
        plan = bestfit.Plan(histogram(lengths, capacity))
        bestfit.reduce(plan, capacity)
        unfolded(plan, capacity)
        rest = [x for x in range(capacity + 1) for _ in range(int(plan.left[x]))]
        reduced += len(lengths) - len(rest)
        assert plan.sequences + (fewest(rest, capacity) if rest else 0) == fewest(lengths, capacity), (capacity, lengths)
    assert reduced > 300


def test_sets_that_dominate():
    fixed = lambda lengths, j, c: bestfit.dominating(histogram(lengths, c), j, c)
    assert fixed([7, 5, 5], 7, 10) == (7,)
    assert fixed([7, 3, 2, 1], 7, 10) == (7, 3)
    assert fixed([6, 3, 3, 2], 6, 10) == (6, 3)
    assert fixed([5, 4, 2, 2], 5, 10) == (5, 4)
    assert fixed([5, 3, 2, 2], 5, 10) == (5, 3, 2)
    assert fixed([5, 1, 1, 1, 1], 5, 10) is None


@pytest.mark.parametrize("capacity", [16, 100, 4096])
def test_plan_holds_every_piece_once(capacity):
    rng = np.random.default_rng(capacity)
    for n, top in ((1, capacity), (300, capacity), (3000, max(capacity // 8, 2)), (0, capacity), (500, 2)):
        lengths = rng.integers(1, top + 1, n)
        plan = bestfit.planned(histogram(lengths, capacity), capacity)
        sequences = unfolded(plan, capacity)
        assert len(sequences) == plan.sequences and not plan.left.any()
        assert sorted(x for s in sequences for x in s) == sorted(lengths.tolist())
        assert plan.sequences >= -(-int(lengths.sum()) // capacity)


def test_numbers_of_sequences_are_those_of_plain_best_fit():
    rng = np.random.default_rng(9)
    for _ in range(40):
        capacity = int(rng.integers(10, 200))
        lengths = rng.integers(1, int(rng.integers(2, capacity + 1)), int(rng.integers(1, 400)))
        plan = bestfit.Plan(histogram(lengths, capacity))
        bestfit.best_fit(plan, capacity)
        assert plan.sequences == one_by_one(lengths.tolist(), capacity) == len(unfolded(plan, capacity))


def test_plan_does_not_grow_with_the_corpus():
    counts = np.random.default_rng(1).integers(0, 50, 4097)
    counts[0] = counts[1500:] = 0  # longer ones force more sequences than their sum
    few, many = bestfit.planned(counts, 4096), bestfit.planned(counts * 1_000_003, 4096)
    assert len(many.rows) < 3 * len(few.rows) + 100
    assert many.sequences <= 1.0001 * (np.arange(4097) @ (counts * 1_000_003)) / 4096 + 1


def check(rows, texts, own, capacity, end=1):
    ids = {d: np.array(own.encode(t or "", add_special_tokens=False).ids + [end], "<u4") for d, t in texts}
    at, sequences = {d: 0 for d in ids}, {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        x = ids[r["doc_id"]]
        part = x[r["start"] : r["start"] + r["length"]]
        assert r["start"] == at[r["doc_id"]] == capacity * r["piece"]
        assert len(part) == r["length"] and r["ids_crc32"] == zlib.crc32(part.tobytes())
        at[r["doc_id"]] += r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert at == {d: len(x) for d, x in ids.items()}
    for x in sequences.values():
        end_of = 0
        for offset, n in sorted(x):
            assert offset == end_of
            end_of += n
        assert end_of <= capacity
    return len(sequences), sum(map(len, ids.values()))


def test_round_trip(spark, own):
    texts = [(i, " ".join(words(i, 1 + i * i % 900))) for i in range(200)] + [(500, None), (501, ""), (502, "a <|endoftext|> b"), (503, " ".join(words(5, 9000)))]
    d = docs(spark, texts)
    for part in (1, 7):
        for capacity in (4096, 128):
            got = bestfit.pack(d.repartition(part), bestfit.Params(capacity=capacity), with_ids=True).collect()
            used, total = check(got, texts, own, capacity)
            assert used <= 1.01 * total / capacity + 1
            assert all(len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)


def test_awkward_and_empty(spark):
    d = docs(spark, awkward())
    got = bestfit.pack(d)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.filter("piece = 0").count() == len(awkward())
    alone = got.filter("doc_id in (1, 2, 3)").collect()
    assert [(r["piece"], r["start"], r["length"]) for r in alone] == [(0, 0, 1)] * 3
    assert got.select("sequence_id", "offset").distinct().count() == got.count()
    assert bestfit.pack(d.limit(0)).count() == 0


def test_registered_query(spark, own):
    sf = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    used, total = check(queries.QUERIES["op12_best_fit"](spark, sf).collect(), texts, own, 4096)
    assert used <= -(-total // 4096) + 1
