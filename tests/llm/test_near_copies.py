"""Jaccard join, line dedup and components against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest

from cinelens.llm import bloom, jaccard, linededup, queries, regions
from cinelens.llm.components import components

from .fixtures import awkward, docs, words


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "ring"])
def test_components(spark, shape):
    rng = random.Random(9)
    n = 60
    links = {"path": [(i, i + 1) for i in range(n)], "star": [(n, i) for i in range(n)], "ring": [(i * 7 % n, (i + 1) * 7 % n) for i in range(n)],
             "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]}[shape]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = roots({x for e in links for x in e}, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {k: v for k, v in want.items() if k in linked}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, params):
    sets = defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingle_set(t, params.words))
    ids, links = sorted(sets), []
    for n, a in enumerate(ids):
        for b in ids[:n]:
            for x in sets[a]:
                for y in sets[b]:
                    both = len(x & y)
                    if both and params.den * both >= params.num * (len(x) + len(y) - both):
                        links.append((b, a))
    return roots(ids, links)


def near_copies(groups=12, size=9):
    """Groups around one text with up to a twentieth of the words changed; all share
    passages, and one group is large."""
    rng = random.Random(4)
    passage = words(1000, 25)
    rows = []
    for g in range(groups):
        base = words(g, rng.randint(5, 160)) + passage
        for j in range(size if g else 60):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // (20 if g else 60)))):
                w[rng.randrange(len(w))] = f"w{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    return rows + [(len(rows) + i, " ".join(words(5000 + i, rng.randint(1, 60)))) for i in range(60)]


@pytest.mark.parametrize("params", [jaccard.Params(), jaccard.Params(words=5, num=80), jaccard.Params(pivots=0, max_frequent=10), jaccard.Params(words=1, num=60, pivots=8)])
def test_join_equals_brute_force(spark, params):
    rows = near_copies()
    got = jaccard.join(docs(spark, rows), params).collect()
    want = brute(rows, params)
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(set(want.values())) < len(want) - 20
    assert all(r["n_shingles"] == len(shingle_set(rows[r["doc_id"]][1], params.words)) for r in got)


def brute_counts(rows, params):
    """Links of each row's set to other sets."""
    sets = [frozenset(shingle_set(t, params.words)) if i is not None else frozenset() for i, t in rows]
    different = set(sets) - {frozenset()}
    link = lambda x, y: params.den * len(x & y) >= params.num * len(x | y)
    counts = {x: sum(x != y and link(x, y) for y in different) for x in different} | {frozenset(): 0}
    return sorted((i, len(s), counts[s]) for (i, _), s in zip(rows, sets) if i is not None)


@pytest.mark.parametrize("params", [jaccard.Params(), jaccard.Params(num=80, block_shingles=300)])
def test_link_counts_equal_brute_force(spark, params):
    rows = near_copies()
    rows += [(5000 + i, t) for i, t in rows[:70:7]] + [(5000, rows[40][1]), (None, rows[3][1])]
    got = jaccard.join(docs(spark, rows), params).collect()
    want = brute_counts(rows, params)
    assert sorted((r["doc_id"], r["n_shingles"], r["n_links"]) for r in got if r["doc_id"] is not None) == want
    assert [r["n_links"] for r in got if r["doc_id"] is None] == [None]
    assert max(n for _, _, n in want) > 20 and sum(n > 0 for _, _, n in want) > 60


def test_counts_over_several_parts(monkeypatch):
    rng = random.Random(6)
    base = rng.sample(range(10**9), 60)
    sets = [jaccard.np.unique(jaccard.np.array([rng.randrange(10**9) if rng.random() < 0.06 else x for x in base[: rng.randint(45, 60)]], jaccard.np.uint64)) for _ in range(50)]
    monkeypatch.setattr(jaccard, "ROWS", 7)
    monkeypatch.setattr(jaccard, "COLUMNS", 11)
    link = lambda x, y: 100 * len(set(x.tolist()) & set(y.tolist())) >= 85 * len(set(x.tolist()) | set(y.tolist()))
    assert jaccard.count_pairs(sets, None, 85, 100)[0].tolist() == [sum(i != k and link(x, y) for k, y in enumerate(sets)) for i, x in enumerate(sets)]
    left, right = jaccard.count_pairs(sets[:20], sets[20:], 85, 100)
    assert left.tolist() == [sum(link(x, y) for y in sets[20:]) for x in sets[:20]]
    assert right.tolist() == [sum(link(x, y) for x in sets[:20]) for y in sets[20:]]


def test_rows_without_id_join_nothing(spark):
    rows = []
    for g in range(12):
        middle = [f"g{g}w{i}" for i in range(120)]
        first, second = ["x"] * 2 + middle[2:], middle[:-2] + ["y"] * 2
        first[40], second[80] = "x", "y"
        rows += [(None, " ".join(middle))] * 3 + [(6 * g + i, " ".join(w)) for i, w in enumerate([first] * 3 + [second] * 3)]
    params = jaccard.Params(num=90)
    got = jaccard.join(docs(spark, rows), params).collect()
    want = brute(rows, params)
    assert len(set(want.values())) == 24
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want


def test_join_awkward(spark):
    rows = awkward()
    got = jaccard.join(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert by[1] == by[1] and {n for n, _ in by[1] | by[2] | by[3]} == {0} and by[2] == {(0, 2)}
    assert {c for _, c in by[6] | by[7]} == {6} and {c for _, c in by[4] | by[9]} == {4, 9} or {c for _, c in by[4] | by[9]} == {4}
    assert {c for _, c in by[None]} == {None}
    assert jaccard.join(docs(spark, rows).limit(0)).count() == 0


def test_keep_one(spark):
    rows = near_copies(6, 5) + awkward()[:5]
    d = docs(spark, [(1000 + i, t) for i, t in rows[-5:]] + rows[:-5])
    kept = jaccard.keep_one(d)
    want = {c for c in brute([(i, t) for i, t in rows[:-5]], jaccard.Params()).values()} | {1001, 1002, 1003, 1004, 1005}
    assert kept.columns == d.columns and sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(want)
    twice = jaccard.keep_one(d.union(d))
    assert twice.filter("n_chars > 20").count() == kept.filter("n_chars > 20").count()


def line_table():
    rng = random.Random(8)
    rows, base = [], [" ".join(words(i, 25)) for i in range(30)]
    for i in range(80):
        lines = []
        for b in rng.sample(base, 2):
            x = b.split()
            if rng.random() < 0.5:
                x[rng.randrange(len(x))] += "x"
            lines.append(("  " if rng.random() < 0.3 else " ").join(x).upper() if rng.random() < 0.3 else " ".join(x))
        rows.append((i, "\n".join([*lines, "", " ".join(words(900 + i, 12))])))
    return rows


def brute_lines(rows, params):
    lines = [(i, n, b) for i, t in rows for n, b in linededup.normalized(t)]
    grams = [{b[j : j + params.shingle] for j in range(max(1, len(b) - params.shingle + 1))} for _, _, b in lines]
    links = [(x, y) for y in range(len(lines)) for x in range(y)
             if params.den * len(grams[x] & grams[y]) >= params.num * len(grams[x] | grams[y])]
    root = roots(range(len(lines)), links)
    first = {}
    for k in sorted(range(len(lines)), key=lambda k: lines[k][:2]):
        first.setdefault(root[k], lines[k][:2])
    return {lines[k][:2]: first[root[k]] for k in range(len(lines))}


@pytest.mark.parametrize("params", [linededup.Params(), linededup.Params(shingle=5)])
def test_lines_equal_brute_force(spark, params):
    rows = line_table()
    got = {(r["doc_id"], r["line_no"]): (r["keeper_doc_id"], r["keeper_line_no"]) for r in linededup.lines(docs(spark, rows), params).collect()}
    want = brute_lines(rows, params)
    assert got.keys() == want.keys()
    assert sum(got[k] == want[k] for k in want) >= 0.99 * len(want)
    assert sum(k != v for k, v in want.items()) > 60


def edited(line, at, n, letters):
    """``line`` with ``n`` characters changed from place ``at`` on."""
    return line[:at] + "".join(letters[(letters.index(c) + 1) % len(letters)] if c in letters else c for c in line[at : at + n]) + line[at + n :]


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余成岁律吕调阳"])
def test_small_edits_link(spark, letters):
    rng, rows, near, far = random.Random(3), [], [], []
    cases = [(n, 1) for n in range(20, 81, 3)] + [(40, 3), (45, 3), (50, 3), (60, 4), (70, 4), (80, 4)]
    for length, changed in cases * 3:
        line = "".join(rng.choice(letters) for _ in range(length))
        near.append((len(rows), len(rows) + 1))
        rows += [(len(rows), line), (len(rows) + 1, edited(line, rng.randrange(6, length - 9), changed, letters))]
    for length in (20, 40, 80):
        line = "".join(rng.choice(letters) for _ in range(length))
        far.append((len(rows), len(rows) + 1))
        rows += [(len(rows), line), (len(rows) + 1, edited(line, length // 3, length // 3, letters))]
    keeper = {r["doc_id"]: r["keeper_doc_id"] for r in linededup.lines(docs(spark, rows)).collect()}
    assert [(rows[a][1], rows[b][1]) for a, b in near if keeper[a] != a or keeper[b] != a] == []
    assert all(keeper[b] == b for _, b in far)


def test_line_digests_stay_off_the_driver(spark, monkeypatch):
    def refused(*a, **b):
        raise AssertionError("digests of lines collected")

    d = docs(spark, line_table()[:20])
    for name in ("toPandas", "toArrow"):
        monkeypatch.setattr(type(d), name, refused)
    assert linededup.lines(d).filter("not kept").count() > 0


def test_shingles_are_characters():
    for k in (2, 3, 5):
        for line in ("abcabd", "é天a\U0001F600bé天a", "x", "天地", "\ud800a\udc00"):
            got, sizes = linededup.shingles([line.encode("utf-8", "surrogatepass")] * 2, k)
            grams = [line[i : i + k] for i in range(max(1, len(line) - k + 1))]
            assert sizes.tolist() == [len(grams)] * 2 and len(set(got.tolist())) == len(set(grams))


def test_removed_lines(spark):
    d = docs(spark, [(1, "keep this line of text\nand another one here"), (2, "Keep  this line of text\n\nsomething else entirely"), (3, "keep this line of text"),
                     (4, None), (5, ""), (6, "a\nb"), (7, "only a copy\nonly a copy"), (8, "a"), (None, "no id on this row")])
    out = linededup.remove(d)
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == d.columns
    # A null id sorts before all others.
    assert got == {1: "keep this line of text\nand another one here", 2: "\nsomething else entirely", 4: None, 5: "", 6: "a\nb", 7: "only a copy", None: "no id on this row"}


def test_lines_awkward(spark):
    rows = awkward()
    got = linededup.lines(docs(spark, rows))
    assert got.filter("doc_id in (1, 2, 3)").count() == 0 and got.filter("doc_id = 6 and kept").count() == 2
    assert linededup.lines(docs(spark, rows).limit(0)).count() == 0 and linededup.remove(docs(spark, rows).limit(0)).count() == 0


def test_join_equals_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(queries.ORACLE["op4_ngram_jaccard"])
    got = queries.QUERIES["op4_ngram_jaccard"](spark, sf)
    assert [c[0] for c in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def brute_grades(texts):
    """Components of lines by all pairs, with every grade of gram sizes, on
    character sets; ``{line: component}`` of different normalized lines."""
    import numpy as np

    p = linededup.Params()
    lines = sorted({b.decode("utf-8", "surrogatepass") for t in texts for _, b in linededup.normalized(t)})
    links = []
    for most, k in ((10**9, p.shingle), *p.short):
        some = [i for i, x in enumerate(lines) if len(x) <= most]
        grams = [{lines[i][j : j + k] for j in range(max(1, len(lines[i]) - k + 1))} for i in some]
        index = {g: n for n, g in enumerate(sorted(set().union(*grams)))} if grams else {}
        size = np.array([len(g) for g in grams])
        held = np.zeros((len(some), len(index)), np.float32)
        for row, g in enumerate(grams):
            held[row, [index[x] for x in g]] = 1
        both = held @ held.T
        a, b = np.nonzero(p.den * both >= p.num * (size[:, None] + size[None, :] - both))
        links += [(some[i], some[j]) for i, j in zip(a.tolist(), b.tolist()) if i < j]
    root = roots(range(len(lines)), links)
    return {x: root[i] for i, x in enumerate(lines)}, len(links)


def test_lines_of_the_table_equal_all_pairs(spark):
    """op6 on sf0.001 against all pairs with all grades: nothing is joined
    that should not be, and at most one line in 200 misses its component."""
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    component, links = brute_grades([t for _, t in rows])
    at, first = {}, {}
    for i, t in sorted(rows):
        for n, b in linededup.normalized(t):
            at[i, n] = component[b.decode("utf-8", "surrogatepass")]
            first.setdefault(at[i, n], (i, n))
    got = {(r["doc_id"], r["line_no"]): (r["keeper_doc_id"], r["keeper_line_no"]) for r in queries.QUERIES["op6_line_dedup"](spark, sf).collect()}
    assert got.keys() == at.keys() and links > 20
    assert all(at[k] == at[v] for k, v in got.items())
    same = sum(first[at[k]] == v for k, v in got.items())
    print("lines with the right keeper:", same, "of", len(at), "links:", links)
    assert same >= 0.995 * len(at)


def test_queries_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r["doc_id"]: r["component_id"] for r in queries.QUERIES["op4_ngram_jaccard"](spark, sf).collect()}
    assert got == brute(rows, jaccard.Params())
    lines = {(r["doc_id"], r["line_no"]): (r["keeper_doc_id"], r["keeper_line_no"]) for r in queries.QUERIES["op6_line_dedup"](spark, sf).collect()}
    want = {}
    for i, t in rows:
        for n, b in linededup.normalized(t):
            want[(i, n)] = b
    assert lines.keys() == want.keys()
    kept = {k for k, v in lines.items() if k == v}
    assert {want[k] for k in kept} >= {want[v] for v in lines.values()} and len(kept) < len(want)


def test_marks_keep_links_and_tell_strangers():
    """Marks let all lines that link pass, and few of those that only meet."""
    import numpy as np

    rng, p = random.Random(8), linededup.Params()
    signer, letters = linededup.Signer(p), "abcdefghijklmnopqrstuvwxyz "
    for k, lengths in ((2, (20, 50)), (3, (30, 80)), (5, (50, 95)), (5, (150, 600))):
        near, far = [], []
        for _ in range(300):
            line = "".join(rng.choices(letters, k=rng.randint(*lengths)))
            other = edited(line, rng.randrange(len(line) // 2), rng.randint(1, max(1, len(line) // 20)), letters)
            near.append((line.encode(), other.encode()))
            far.append((line.encode(), "".join(rng.choices(letters, k=rng.randint(*lengths))).encode()))
        grams = lambda x: {x[i : i + k] for i in range(len(x) - k + 1)}  # noqa: B023, E731
        near = [(x, y) for x, y in near if 100 * len(grams(x) & grams(y)) >= 80 * len(grams(x) | grams(y))]
        pairs = near + far
        bands, x = signer([a for a, _ in pairs], k)
        _, y = signer([b for _, b in pairs], k)
        assert (bands == signer.bands([a for a, _ in pairs], k)).all()
        passed = linededup.may_link(x, y, p.num, p.den)
        assert len(near) > 100 and passed[: len(near)].all() and passed[len(near) :].sum() <= 6
        assert (linededup.may_link(x, np.full(len(x), -1), p.num, p.den)).all()


def test_crowded_cells_fall_apart_by_marks(spark):
    """A cell of strangers is no group; one of two pairs is two groups."""
    rows = [(1, 10, 5), (1, 11, 6), (2, 10, 5), (2, 20, 5), (2, 11, 6), (2, 30, 6), (2, 40, 7), (3, 50, 8)]
    rows += [(4, n, n) for n in range(1000, 1000 + regions.MARKED + 1)]
    got = {}
    for r in regions.crowded(spark.createDataFrame(rows, "cell long, node long, mark long"), lambda x, y: x == y).collect():
        got.setdefault(r["group"], set()).add(r["node"])
    large = set(range(1000, 1000 + regions.MARKED + 1))
    assert sorted(map(sorted, got.values())) == [[10, 20], [11, 30], sorted(large)]


def test_normal_form_of_odd_white_space():
    for text in ("a  b\n c", "a\x1fb", "\x1c\n x", "é  x\ny", "a\x0bb\x7f\x00c\n\n z ", "\n", " ", "a\r\nb", "x\n\ny\n", "É\x85b", "é\xa0b é",
                 "a\u2003b", "é\u2028x", "天\u3000天", "é y\n é", "É’s y\nÜx", "\ud800 a", "é\u1680x", "a\u205fb\u202f", "Plain text\nof Two lines"):
        want = [(i, " ".join(x.split()).encode("utf-8", "surrogatepass")) for i, x in enumerate(text.lower().split("\n")) if x.split()]
        assert linededup.normalized(text) == want


def test_marks_tell_sizes_and_meeting_strangers():
    """An exact mark beside one that is not passes only near it in size, and
    few pairs of long lines with a third of their shingles in common pass."""
    import numpy as np

    rng, p = random.Random(9), linededup.Params()
    signer, letters = linededup.Signer(p), "abcdefghijklmnopqrstuvwxyz "
    line = lambda n: "".join(rng.choices(letters, k=n))
    short, long = [line(rng.randint(20, 100)).encode() for _ in range(200)], [line(rng.randint(250, 600)).encode() for _ in range(200)]
    (_, x), (_, y) = signer(short, 5), signer(long, 5)
    assert not linededup.may_link(x, y, p.num, p.den).any() and not linededup.may_link(y, x, p.num, p.den).any()
    border = [line(n) for n in range(84, 101) for _ in range(20)]  # 80 to 96 shingles
    (_, x), (_, y) = signer([b.encode() for b in border], 5), signer([(b + line(6)).encode() for b in border], 5)
    assert linededup.may_link(x, y, p.num, p.den).all()
    pairs = [(both + line(125), both + line(125)) for both in (line(125) for _ in range(1000))]
    (u, x), (v, y) = signer([a.encode() for a, _ in pairs], 5), signer([b.encode() for _, b in pairs], 5)
    more = u[:, 0] ^ v[:, 0]
    # Two bits of 31 bins let 190 of these pairs pass.
    assert linededup.may_link(x, y, p.num, p.den, more=more).sum() < 100
    near = [(b, edited(b, 50, 6, letters)) for b in (line(250) for _ in range(1000))]
    (u, x), (v, y) = signer([a.encode() for a, _ in near], 5), signer([b.encode() for _, b in near], 5)
    assert linededup.may_link(x, y, p.num, p.den, more=u[:, 0] ^ v[:, 0]).all()
    again = linededup.Signer(p)([a.encode() for a, _ in near], 5)
    assert (again[0] == u).all() and (again[1] == x).all() and ((u & ((1 << linededup.SPARE) - 1)) == (u[:, :1] & ((1 << linededup.SPARE) - 1))).all()
    assert len(np.unique(u >> linededup.SPARE)) > 0.999 * u.size


def test_popular_cells_fall_apart_by_marks(spark):
    """A cell of many strangers passes only those with a partner, repeated
    rows are one node, and the last bits of a cell can belong to the mark."""
    rows = [(1, n, n) for n in range(2000)] + [(1, n, n - 10000) for n in (10007, 11000)]
    rows += [(2, 5, 1)] * 9000 + [(3, 5, 1)] * 3 + [(3, 6, 1)] * 2
    got = {}
    for r in regions.crowded(spark.createDataFrame(rows, "cell long, node long, mark long"), lambda x, y: x == y).collect():
        got.setdefault(r["group"], set()).add(r["node"])
    assert sorted(map(sorted, got.values())) == [[5, 6], [7, 10007], [1000, 11000]]
    rows = [(1 << 8 | 3, 10, 0), (1 << 8 | 2, 11, 0), (1 << 8 | 3, 12, 0), (2 << 8 | 3, 13, 0), (-1 << 8 | 1, 14, 0), (-1 << 8 | 1, 15, 0)]
    near = lambda x, y, more: (x == y) & (more == 0)
    got = {}
    for r in regions.crowded(spark.createDataFrame(rows, "cell long, node long, mark long"), near, 8).collect():
        got.setdefault(r["group"], set()).add(r["node"])
    assert sorted(map(sorted, got.values())) == [[10, 12], [14, 15]]


def test_bloom_filter_loses_no_key(spark, monkeypatch):
    rng = np.random.default_rng(4)
    keys, others = rng.integers(-(1 << 63), 1 << 63, 50_000), rng.integers(-(1 << 63), 1 << 63, 50_000)
    table = spark.createDataFrame([(int(k),) for k in keys[:20_000]], "key long")
    held = bloom.fitted(table, 20_000)
    assert held.may_hold(keys[:20_000]).all() and held.may_hold(others).mean() < 0.02
    monkeypatch.setattr(bloom, "MOST", bloom.BLOCK // 8)  # too few bits for them
    small = bloom.fitted(spark.createDataFrame([(int(k),) for k in keys], "key long"), len(keys))
    assert small.blocks == 1 and small.may_hold(keys).all() and small.may_hold(others).mean() < 0.5
    assert not bloom.fitted(table.limit(0), 0).may_hold(others).any()


def test_only_lines_that_may_be_wanted_are_sent(spark, monkeypatch):
    """Where the wanted lines are too many to broadcast, the join shuffles what tasks send."""
    rng = random.Random(5)
    line = lambda: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(12))
    twin = line()
    table = docs(spark, [(i, line()) for i in range(300)] + [(300, twin), (301, twin + "x")])
    seen, real = [], linededup._sent

    def counted(*args):
        rows = real(*args)
        seen.append(rows.count())
        return rows

    monkeypatch.setattr(linededup, "broadcast_if_small", lambda df, *a: df)
    monkeypatch.setattr(linededup, "_sent", counted)
    lost = [r["doc_id"] for r in linededup.lines(table).filter("not kept").collect()]
    assert lost == [301] and 2 <= seen[0] <= 10
