"""Harmonic packing of documents into token sequences.

*Classes.* With capacity C, class k holds pieces of at most ``C // k`` tokens,
and a bin of class k holds k of them. A document is cut into whole sequences
(class 1) and then, while at least ``C // exact_classes`` tokens are left, into
the longest piece of exactly ``C // k`` tokens; the rest is one piece of class
``C // length``. So exact classes lose at most k - 1 tokens a bin, and only
the short rests lose up to a share of 1 / (k + 1).

*Filling.* Workers cut and number their own pieces by class, without talking
to each other. Class k's piece of global number n goes to bin ``n // k``; the
global number is the worker's number plus the class's count in the partitions
before it, from a table of one row for each partition and class. No token
moves between workers. What does not fill a bin (under k pieces of a class,
so under ``C * (1 + ln C)`` pieces in all) is packed by first fit decreasing.

Null text counts as empty. Each document ends with ``end_id``. Every id lies
in exactly one piece.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelens.llm import tokens
from cinelens.llm.common import prepare, slices
from cinelens.operators.joins import broadcast_if_small
from cinelens.session import stored


@dataclass(frozen=True)
class Params:
    capacity: int = 4096
    end_id: int = 2
    #: Classes whose pieces are cut to their exact length.
    exact_classes: int = 16


def cuts(n: int, params: Params) -> list[tuple[int, int, int]]:
    """(start, length, class) of the pieces of a document of ``n`` tokens."""
    c, out, at = params.capacity, [], 0
    least = c // params.exact_classes
    while n - at >= c:
        out.append((at, c, 1))
        at += c
    while n - at >= max(least, 1):
        k = c // (n - at + 1) + 1
        out.append((at, c // k, k))
        at += c // k
    if n > at:
        out.append((at, n - at, c // (n - at)))
    return out


def cut_documents(docs: DataFrame, params: Params, tokenizer: str | None, with_ids: bool) -> DataFrame:
    """One row for each piece, numbered by class within its partition."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokens.read(tokenizer or tokens.default_path()))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        enc, part = tokens.encoder(shared.value), TaskContext.get().partitionId()
        end, numbers = np.array([params.end_id], "<u4").tobytes(), {}
        for batch in slices(batches):
            rows, blobs = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                raw = enc.ids(text) + end
                n = len(raw) // 4
                for start, length, k in cuts(n, params):
                    piece = raw[4 * start : 4 * (start + length)]
                    numbers[k] = number = numbers.get(k, -1) + 1
                    rows.append((i, start, length, zlib.crc32(piece), n, k, number))
                    if with_ids:
                        blobs.append(np.frombuffer(piece, "<u4").astype(np.int32))
            if rows:
                at, *cols = np.array(rows, np.int64).T
                arrays = [batch.column("doc_id").take(pa.array(at)), *map(pa.array, cols), pa.array(np.full(len(at), part))]
                if with_ids:
                    arrays.append(pa.array(blobs, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "number", "part"] + ["ids"] * with_ids
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"`{n}` long" for n in names[1:8]) + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def first_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece, longest first into the first bin with room."""
    room, out = np.empty(0, np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        fits = np.flatnonzero(room >= lengths[i])
        if not len(fits):
            room = np.append(room, capacity)
            fits = [len(room) - 1]
        room[fits[0]] -= lengths[i]
        out[i] = fits[0]
    return out


def pack(docs: DataFrame, params: Params = Params(), tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``
    of each piece of ``docs(doc_id, text)``; ``with_ids`` adds its ids.

    ``offset`` is the piece's place in its sequence, without gaps from 0.
    Rows that repeat a doc_id are packed as documents of their own.
    """
    spark = docs.sparkSession
    prepare(spark)
    pieces = stored(cut_documents(docs, params, tokenizer, with_ids))
    counts = pieces.groupBy("class", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = stored(counts.withColumn("before", before).select("class", "part", "before"))
    # One row for each class, of which there are at most 2 * sqrt(capacity).
    totals = sorted((r["class"], r["n"]) for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect())
    bins, base = [], 0
    for k, n in totals:
        bins.append((k, n // k * k, base))
        base += n // k
    classes = spark.createDataFrame(bins, "class long, filled long, base long")
    placed = pieces.join(broadcast_if_small(offsets, offsets.count(), 32), ["class", "part"]).join(F.broadcast(classes), "class").withColumn("rank", F.col("before") + F.col("number"))
    full = placed.filter("rank < filled").withColumn("sequence_id", F.col("base") + F.floor(F.col("rank") / F.col("class")))
    rest = placed.filter("rank >= filled").select("class", "rank", "length").toPandas().sort_values(["class", "rank"])
    rest["sequence_id"] = first_fit(rest["length"].to_numpy(), params.capacity) + base
    fitted = spark.createDataFrame([tuple(map(int, r)) for r in rest[["class", "rank", "sequence_id"]].itertuples(index=False)], "class long, rank long, sequence_id long")
    late = placed.filter("rank >= filled").join(F.broadcast(fitted), ["class", "rank"])
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "class", "rank"] + ["ids"] * with_ids
    order = Window.partitionBy("sequence_id").orderBy("class", "rank").rowsBetween(Window.unboundedPreceding, -1)
    out = full.select(*keep).unionByName(late.select(*keep))
    return out.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids)
