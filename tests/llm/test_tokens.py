"""Token spans, section counts and packing against the tokenizer itself."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cinelens.llm import packing, tokens

from .fixtures import awkward, docs, words

HARD = ["The café's don't — I'll, we've 123 4567 x1y2", "ÀÉÎ ß ÿ ¿Qué? ¡sí!", "tabs\tand\r\nlines  and   gaps ", "漢字 and é İ ﬁ",
        "<|endoftext|> is text", "a b \x0c c \x1c d", "'s 't're", "ÆØÅ×÷ ªº µ", "x" * 3000, "''''s''", "ǅ ŉ"]


@pytest.fixture(scope="module")
def own():
    """The tokenizer as its file sets it up."""
    return Tokenizer.from_file(tokens.default_path())


def test_fast_path_equals_tokenizer(own):
    enc = tokens.Encoder(tokens.read(tokens.default_path()))
    for text in HARD + [" ".join(words(i, 200)) + ", Übër; x" for i in range(20)]:
        whole = own.encode(text, add_special_tokens=False)
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == whole.ids, text
        assert [tuple(s) for s in enc.spans(text).tolist()] == list(whole.offsets), text
    assert enc.ids(None) == b"" and len(enc.spans("")) == 0


@pytest.mark.parametrize("rule", tokens.RULES)
def test_section_counts(spark, own, rule):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(100 + i, t) for i, (_, t) in enumerate(awkward())]
    d = docs(spark, rows).withColumn("sections", tokens.pages(F.col("text"), 7))
    got = {}
    for r in tokens.section_counts(d, rule).collect():
        got.setdefault(r["doc_id"], {})[r["section"]] = r["tokens"]
    for i, text in rows:
        spans = own.encode(text or "", add_special_tokens=False).offsets
        want = np.zeros(max(1, -(-len(text or "") // 7)))
        for s, e in spans:
            if rule == "first":
                want[s // 7] += 1
            elif rule == "middle":
                want[(s + max(e - 1, s)) // 2 // 7] += 1
            else:
                for c in range(s, max(e, s + 1)):
                    want[min(c // 7, len(want) - 1)] += 1 / max(e - s, 1)
        assert np.allclose([got[i][k] for k in range(len(want))], want, atol=1e-6), (rule, text[:40])


def test_overlapping_and_null_sections(spark):
    d = spark.createDataFrame([(1, "one two three", [(0, 13), None, (4, 7), (5, None), (9, 2)]), (2, "x", None), (3, None, [(0, 0)])],
                              "doc_id long, text string, sections array<struct<start:int,end:int>>")
    got = {(r["doc_id"], r["section"]): r["tokens"] for r in tokens.section_counts(d).collect()}
    assert got == {(1, 0): 3, (1, 2): 1, (1, 4): 0, (3, 0): 0}
    assert tokens.section_counts(d.limit(0)).count() == 0
    with pytest.raises(ValueError):
        tokens.section_counts(d, "last")


def test_cuts_are_whole_and_fit():
    for params in (packing.Params(), packing.Params(capacity=64, exact_classes=4)):
        for n in range(1, 3 * params.capacity):
            at = 0
            for start, length, k in packing.cuts(n, params):
                assert start == at and length >= 1 and length * k <= params.capacity
                at += length
            assert at == n


def check_packed(rows, texts, own, capacity):
    ids = {d: np.array(own.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for d, t in texts}
    pieces, sequences = {}, {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, x in ids.items():
        assert sorted(i for s, n in pieces[d] for i in range(s, s + n)) == list(range(len(x)))
    for x in sequences.values():
        at = 0
        for o, n in sorted(x):
            assert o == at
            at += n
        assert at <= capacity
    return sum(len(x) for x in ids.values()) / (len(sequences) * capacity)


def test_packing(spark, own):
    texts = [(i, " ".join(words(i, 1 + i * i % 900))) for i in range(200)] + [(500, None), (501, ""), (502, HARD[3])]
    d = docs(spark, texts)
    got = packing.pack(d, with_ids=True).collect()
    assert check_packed(got, texts, own, 4096) > 0.9
    assert all(len(r["ids"]) == r["length"] for r in got)
    small = packing.pack(d.repartition(7), packing.Params(capacity=128, exact_classes=8)).collect()
    assert check_packed(small, texts, own, 128) > 0.9


def test_packing_awkward_and_empty(spark):
    d = docs(spark, awkward())
    got = packing.pack(d)
    assert got.filter("start = 0").count() == len(awkward())
    assert packing.pack(d.limit(0)).count() == 0
