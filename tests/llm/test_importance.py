"""Importance resampling against a plain computation and against SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from cinelens.llm import importance, queries

from .fixtures import awkward, docs, words

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, most):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = WORD.findall(lower)
    return found, [" ".join(found[i : i + n]).encode() for n in range(1, most + 1) for i in range(len(found) - n + 1)]


def plain(rows, target, p):
    """{row number: (n_features, weight, score, rank)}"""
    bucket = lambda f: zlib.crc32(f) % p.buckets
    count = lambda texts: Counter(bucket(f) for t in texts for f in features(t, p.max_words)[1])
    s, t = count(x for _, x in rows), count(target)
    total, aimed = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total + p.buckets) / ((s[b] + 1) * (aimed + p.buckets))))
    out = {}
    for i, (d, text) in enumerate(rows):
        found, grams = features(text, p.max_words)
        weight = sum(gain(bucket(g)) for g in grams)
        score = None
        if d is not None:
            h = int(hashlib.sha256(f"{p.seed}:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = [d, len(grams), weight, score, None]
    fit = sorted((-o[3], o[0], i) for i, o in out.items() if o[0] is not None and len(features(rows[i][1], 1)[1]) >= p.least_words)
    for rank, (_, _, i) in enumerate(fit[: p.percent * len(fit) // 100], 1):
        out[i][4] = rank
    return sorted(map(tuple, out.values()), key=repr)


@pytest.mark.parametrize("most, dictionary", [(1, 100_000), (2, 5), (3, 0)])
def test_equals_plain_computation(spark, most, dictionary):
    rows = [(i, " ".join(words(i, 3 * i)) + "; Été, x" * (i % 3)) for i in range(60)] + [(100 + i, t) for i, (_, t) in enumerate(awkward())] + [(None, " ".join(words(77, 50)))]
    target = [" ".join(words(900 + i, 40, "river stone cloud")) for i in range(5)] + [None, ""]
    p = importance.Params(max_words=most, buckets=500, percent=30, dictionary_words=dictionary)
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, weight int")
    if not dictionary:
        p = importance.Params(max_words=most, buckets=500, percent=30, word_bytes=0)
    got = importance.resample(docs(spark, rows).repartition(5), aim, p)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, target, p)


def test_crc_of_joined_strings():
    rng = np.random.default_rng(2)
    c = importance.Composer()
    parts = [bytes(rng.integers(0, 256, n, np.uint8)) for n in [0, 1, 2, 3, 7, 64, 1000, 70_000]]
    crc, length = np.array([zlib.crc32(x) for x in parts], np.uint32), np.array([len(x) for x in parts])
    for a, x in zip(crc, parts):
        got = c.join(np.full(len(parts), a, np.uint32), crc, length)
        assert got.tolist() == [zlib.crc32(x + y) for y in parts]


@pytest.mark.parametrize("most", [1, 2, 4])
def test_scan_in_small_parts(monkeypatch, most):
    """Gaps, ends and runs across the parts that matches are handled in."""
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(importance, "MATCHES", size)
        for known in ([], [b"a"], [b"a", b"bb", b"river"], [b"zz"]):
            scan = importance.Scanner(known)
            for text in ("a", "zz", "a bb zz zz a", "zz a river a a bb zz", "A-BB_zz  \n 7 \xe9t\xe9", "", None, "..."):
                got = np.concatenate([np.empty(0, np.uint32), *scan.features(text, most)])
                assert sorted(got.tolist()) == sorted(map(zlib.crc32, features(text, most)[1])), (size, known, text)


def test_repeated_rows_and_empty_tables(spark):
    text = " ".join(words(4, 30))
    d = docs(spark, [(1, text), (1, text), (2, text), (3, text + " more")])
    aim = spark.createDataFrame([(text,)], "text string")
    got = importance.resample(d, aim, importance.Params(percent=50))
    assert sorted(map(tuple, got.collect()), key=repr) == plain([(1, text), (1, text), (2, text), (3, text + " more")], [text], importance.Params(percent=50))
    assert importance.resample(d.limit(0), aim).count() == 0
    assert importance.resample(d, aim.limit(0)).count() == 4


def test_registered_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES["op11_importance"](spark, SF)
    want = con.execute(queries.ORACLE["op11_importance"])
    names = [c[0] for c in want.description]
    assert names == got.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
