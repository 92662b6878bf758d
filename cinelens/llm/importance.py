"""Importance resampling towards a target corpus, on hashed n-gram buckets.

*Features.* A-Z are lower-cased; words are runs of digits, letters a-z and
characters beyond ASCII; features are all runs of 1 to ``max_words`` words
joined by one space, repeats counted. A feature's bucket is the CRC-32 of its
UTF-8 bytes modulo ``buckets``.

*Dictionary.* The corpus's distinct words are counted by Spark, and the most
frequent ones (up to ``dictionary_words``, of at most ``word_bytes`` bytes each,
so the broadcast has a fixed bound) enter an Aho-Corasick automaton, each between
two delimiters; its payload is the word's CRC and length. A task puts a text's
words between single delimiters and scans it once. Neighbouring matches share
a delimiter, so a gap between two matches holds exactly the words that the
dictionary lacks; these get their payload on the spot. The dictionary decides
speed alone, never a result.

*Composition.* The CRC of a run is composed from the payloads of its words:
appending n bytes to a string changes its CRC by a linear map over GF(2) that
depends on n only, so ``crc(a + b) = map_n(crc(a)) ^ crc(b)``. No run of words
is ever built as a string.

*Counting and scoring.* One scan counts the buckets of the corpus (a task sends
at most ``buckets`` rows), one those of the target; the gains, one for each
bucket, are broadcast for the scan that scores. The draw is a Gumbel top-k by a
hash of the id: rows are put in score order by a range partitioning, so ranks
need no single task.

A null or empty text has no features and weight 0. A row with a null doc_id has
a weight but a null score and is never drawn or counted. Rows that repeat a
doc_id are documents of their own with the same noise. With an empty table the
result is empty; with an empty target every target count is 0.
"""

from __future__ import annotations

import math
import uuid
import zlib
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import prepare, slices
from cinelens.operators.ordering import numbered
from cinelens.session import release, stored


@dataclass(frozen=True)
class Params:
    max_words: int = 1
    buckets: int = 10000
    #: Documents of fewer words are not drawn.
    least_words: int = 20
    #: Share drawn, in percent of the documents long enough.
    percent: int = 10
    seed: int = 2024
    dictionary_words: int = 100_000
    word_bytes: int = 64


UPPER, LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))
#: What stands between words, as Java's regular expressions write it.
DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Each byte of a lower-cased word stays, A-Z becomes a-z, the rest a space.
_BYTES = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))

#: Matches handled together; words outside the dictionary a worker keeps, and
#: their bytes at most.
MATCHES, CACHE_WORDS, CACHE_BYTES = 1 << 16, 200_000, 64


# ------------------------------------------------------- CRC of joined strings


def _zero_byte() -> np.ndarray:
    """Table (4, 256) of the linear map that one appended byte makes of a CRC."""
    tail = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        tail = (tail >> np.uint32(1)) ^ np.where(tail & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    low = np.arange(256, dtype=np.uint32)
    return np.stack([tail, low, low << np.uint32(8), low << np.uint32(16)])


def _mapped(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    byte = lambda k: (crc >> np.uint32(8 * k)) & np.uint32(255)
    return table[0][byte(0)] ^ table[1][byte(1)] ^ table[2][byte(2)] ^ table[3][byte(3)]


class Composer:
    """CRCs of joined strings from the CRCs and lengths of their parts."""

    def __init__(self):
        self.tables = [_zero_byte()]

    def join(self, left: np.ndarray, right: np.ndarray, right_length: np.ndarray) -> np.ndarray:
        """``crc(a + b)`` from ``crc(a)``, ``crc(b)`` and the length of b."""
        rest, j = right_length.copy(), 0
        while len(rest) and rest.any():
            if j == len(self.tables):
                # A map done twice appends twice as many bytes.
                self.tables.append(_mapped(self.tables[-1], self.tables[-1].reshape(-1)).reshape(4, 256))
            odd = (rest & 1).astype(bool)
            left = np.where(odd, _mapped(self.tables[j], left), left)
            rest, j = rest >> 1, j + 1
        return left ^ right

    def runs(self, crc: np.ndarray, length: np.ndarray, most: int) -> np.ndarray:
        """CRCs of all runs of 1 to ``most`` neighbouring words."""
        space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
        spaced = self.join(space, crc, length)
        out, run = [crc], crc
        for n in range(2, min(most, len(crc)) + 1):
            run = self.join(run[:-1], spaced[n - 1 :], length[n - 1 :] + 1)
            out.append(run)
        return np.concatenate(out)


# ------------------------------------------------------------------ scanning


class _Payloads(dict):
    """Words outside the dictionary to (CRC, length)."""

    def __missing__(self, word: str) -> tuple[int, int]:
        out = zlib.crc32(word.encode("latin-1")), len(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= CACHE_BYTES:
            self[word] = out
        return out


def delimited(text: str | None) -> str:
    """The words of a text between single spaces, one character for each
    byte; empty without words."""
    words = text.encode("utf-8", "surrogatepass").translate(_BYTES).split() if text else ()
    return f" {b' '.join(words).decode('latin-1')} " if words else ""


class Scanner:
    """An automaton over delimited words, whose matches emit payloads."""

    def __init__(self, words: list[bytes]):
        import ahocorasick

        self.automaton, self.others, self.composer = ahocorasick.Automaton(ahocorasick.STORE_INTS), _Payloads(), Composer()
        for i, w in enumerate(words):
            self.automaton.add_word(f" {w.decode('latin-1')} ", i)
        self.automaton.make_automaton()
        self.crc = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.length = np.array([len(w) for w in words], np.int64)

    def _matches(self, text: str):
        """(end, word) of the matches, as arrays of bounded length."""
        if not len(self.crc):
            return
        matches = self.automaton.iter(text)
        while len(found := np.fromiter(chain.from_iterable(islice(matches, MATCHES)), np.int64)):
            yield found[::2], found[1::2]

    def payloads(self, text: str):
        """(CRCs, lengths) of the words of a delimited text, in order, as
        arrays of bounded length."""
        end = 0
        for ends, word in self._matches(text):
            crc, length = self.crc[word], self.length[word]
            starts, before = ends - length - 1, np.concatenate([[end], ends[:-1]])
            gaps = np.flatnonzero(starts > before)
            if len(gaps):
                lost = [[self.others[w] for w in text[a + 1 : b].split(" ")] for a, b in zip(before[gaps].tolist(), starts[gaps].tolist())]
                at = np.repeat(gaps, [len(x) for x in lost])
                c, n = np.array([p for x in lost for p in x], np.int64).T
                crc, length = np.insert(crc, at, c.astype(np.uint32)), np.insert(length, at, n)
            end = int(ends[-1])
            yield crc, length
        rest = iter(text[end + 1 : -1].split(" ") if end < len(text) - 1 else ())
        while part := [self.others[w] for w in islice(rest, MATCHES)]:
            c, n = np.array(part, np.int64).T
            yield c.astype(np.uint32), n

    def features(self, text: str | None, most: int):
        """CRCs of the features of a text, as arrays of bounded length."""
        kept = np.empty(0, np.uint32), np.empty(0, np.int64)
        for crc, length in self.payloads(delimited(text)):
            if most == 1:
                yield crc
                continue
            # Runs that began in the part before: its last words go along,
            # and the runs that lie in them alone are left out.
            both = np.concatenate([kept[0], crc]), np.concatenate([kept[1], length])
            old, at = len(kept[0]), 0
            every = self.composer.runs(*both, most)
            for n in range(1, min(most, len(both[0])) + 1):
                runs = len(both[0]) - n + 1
                yield every[at + max(old - n + 1, 0) : at + runs]
                at += runs
            kept = both[0][-(most - 1) :], both[1][-(most - 1) :]


_SCANNERS: dict[str, Scanner] = {}


def scanner(shared) -> Scanner:
    """One scanner for each worker and dictionary (a broadcast key and words)."""
    key, words = shared.value
    if key not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[key] = Scanner(words)
    return _SCANNERS[key]


# ---------------------------------------------------------------- Spark jobs


def dictionary(docs: DataFrame, params: Params) -> list[bytes]:
    """The most frequent distinct words of all texts, as bytes.

    How many words there are of each frequency, in steps of a sixteenth power
    of two, tells from which step on all fit; so only the words chosen leave
    the tasks. Words that occur once gain nothing by being known.
    """
    word = F.explode(F.split(F.translate("text", UPPER, LOWER), DELIMITERS))
    counts = docs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    step = F.floor(F.log2(F.col("n")) * 16).cast("int")
    fit = stored(counts.filter((F.col("word") != "") & (F.octet_length("word") <= params.word_bytes)).select(F.col("word").cast("binary").alias("word"), step.alias("step")))
    least, total = None, 0
    for r in fit.groupBy("step").count().orderBy(F.desc("step")).collect():  # 1,024 steps at most
        total += r["count"]
        if total > params.dictionary_words:
            break
        least = r["step"]
    words = [] if least is None else [bytes(r[0]) for r in fit.filter(F.col("step") >= least).select("word").collect()]
    release(fit)
    return words


def bucket_counts(docs: DataFrame, shared, params: Params) -> np.ndarray:
    """Features of all texts in each bucket."""

    def run(batches):
        import pyarrow as pa

        scan, total = scanner(shared), np.zeros(params.buckets, np.int64)
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                for crc in scan.features(text, params.max_words):
                    total += np.bincount(crc % np.uint32(params.buckets), minlength=params.buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": held, "n": total[held]})

    rows = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(params.buckets, np.int64)
    for r in rows.collect():  # one row for each bucket at most
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln)`` of the smoothed ratio of each bucket's shares."""
    k, total, aimed = len(source), float(source.sum()), float(target.sum())
    ratio = ((t + 1.0) * (total + k) / ((s + 1.0) * (aimed + k)) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weights(docs: DataFrame, shared, gain, params: Params) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each row."""

    def run(batches):
        import pyarrow as pa

        scan, value = scanner(shared), gain.value
        for batch in slices(batches):
            words, sizes, sums = [], [], []
            for text in batch.column("text").to_pylist():
                size = total = 0
                for crc in scan.features(text, params.max_words):
                    size += len(crc)
                    total += int(value[crc % np.uint32(params.buckets)].sum())
                words.append(delimited(text).count(" ") - 1 if params.max_words > 1 and size else size)
                sizes.append(size)
                sums.append(total)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (words, sizes, sums))], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of each row of
    ``docs(doc_id, text)``; ``target(text)`` is the corpus to draw towards.

    ``score`` is the weight and Gumbel noise from the id; ``rank`` counts the
    drawn documents from 1 by falling score, ties by doc_id, and is null for
    the others.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, dictionary(docs, params)))
    source = bucket_counts(docs, shared, params)
    gain = spark.sparkContext.broadcast(gains(source, bucket_counts(target, shared, params)))
    ticket = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{params.seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((ticket + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = stored(weights(docs, shared, gain, params).withColumn("score", F.col("weight") + noise))
    fit = F.col("doc_id").isNotNull() & (F.col("n_words") >= params.least_words)
    drawn = params.percent * scored.filter(fit).count() // 100
    placed = numbered(scored.filter(fit), F.desc("score"), "doc_id", name="place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    out = placed.withColumn("rank", rank).drop("place").unionByName(scored.filter(~fit).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
