"""Mixing sources to target weights as a time-varying curriculum.

*Targets.* Sources share the mix by weight; none takes more than
``max_repeats`` times its own size, and what is over is reshared by weight.
The fixed point is one level L with ``target = min(max_repeats * size,
L * weight)``, found from running sums over the sources in order of
``max_repeats * size / weight`` (one row for each source).

*Positions.* A source has a weight schedule over training time [0, 1]:
knots (time, weight), linear between them. Its demand up to time t is its
target times the integral of the schedule to t over the whole integral. A
source's documents are laid end to end in hash order, as often as its target
needs; the copy that begins at word c is trained at the time when demand
reaches c (the integral inverted, a quadratic within a knot interval). The
copy that crosses the target is cut there, so that a source gives exactly its
target, rounded down.

The running count of words within a source is made of two sums: over hash
buckets of (source, bucket), then over the documents of one bucket, so a
source with most of the rows is spread over all tasks. ``arrange`` range-sorts
the copies by position; ties are split by hash.

A null text has size 0; documents of size 0 are never taken. A null source is
a source of its own, after all others. Rows that repeat a doc_id are
documents of their own. Nothing is drawn at random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelens.operators.joins import broadcast_if_small

WEIGHTS = (5.0, 2.0, 1.0)
#: Knots (time, weight) for each place in ``WEIGHTS``: heavy sources lead,
#: light ones come late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
MAX_REPEATS = 3
#: Hash buckets of a source (three hexadecimal digits).
BUCKET_DIGITS = 3


def words(text: str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def segments(knots) -> list[tuple[float, float, float, float, float]]:
    """(share from, share to, time, weight, slope / 2) of each interval, the
    integral scaled to 1."""
    pairs = list(zip(knots, knots[1:]))
    total = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in pairs)
    if total <= 0 or any(w < 0 for _, w in knots):
        raise ValueError("a schedule needs weights of at least 0 that are not all 0")
    out, share = [], 0.0
    for (t0, w0), (t1, w1) in pairs:
        part = (t1 - t0) * (w0 + w1) / 2 / total
        if part > 0:
            out.append((share, share + part, t0, w0 / total, (w1 - w0) / (t1 - t0) / total / 2))
            share += part
    return out


def position(share: Column, knots) -> Column:
    """Training time at which a schedule has asked for ``share`` of its words."""
    out = F.lit(float(knots[-1][0]))
    for lo, hi, t, w, a in reversed(segments(knots)):
        u = share - F.lit(lo)
        step = u / F.lit(w) if a == 0 else 2 * u / (F.lit(w) + F.sqrt(F.lit(w * w) + F.lit(4 * a) * u))
        out = F.when(share < F.lit(hi), F.lit(t) + step).otherwise(out)
    return out


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, kind, source_size, target`` of ``sized(source, size)``:
    weights are dealt by code point order, null last, repeating."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sizes.withColumn("kind", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("kind") + 1)
    capped = ranked.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    free = capped.withColumn("level", level).withColumn("ratio", F.col("cap") / F.col("weight"))
    # The first source that stays under its cap has the level of all that do
    # (of equal ratios the first has the highest).
    chosen = -F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", (-F.col("level")).alias("fall")))).over(whole)["fall"]
    return free.withColumn("chosen", F.coalesce(chosen, F.lit(0.0))).select(
        "source", "kind", "source_size", F.least("cap", F.col("chosen") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, max_repeats: int = MAX_REPEATS, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of ``docs(doc_id, text, source)``: ``doc_id,
    size, source_size, target, taken, copies`` and the ``keep`` columns.
    ``copies`` holds (number, position, words) of each copy taken."""
    ticket = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    extra = [c for c in keep if c not in ("doc_id", "source")]
    sized = docs.select("doc_id", "source", *extra, words("text").alias("size"), ticket.alias("_ticket"), F.xxhash64("text").alias("_text_hash"))
    sized = sized.withColumn("_bucket", F.substring("_ticket", 1, BUCKET_DIGITS))
    parts = sized.groupBy("source", "_bucket").agg(F.sum("size").alias("size"))
    targets = source_targets(parts, weights, max_repeats)
    ahead = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("_start", F.coalesce(F.sum("size").over(ahead), F.lit(0))).select("source", "_bucket", "_start")
    within = Window.partitionBy("source", "_bucket").orderBy("_ticket", "doc_id", "size", "_text_hash").rowsBetween(Window.unboundedPreceding, -1)
    laid = sized.withColumn("_inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    same = lambda a, b, c: a[c].eqNullSafe(b[c])
    targets = targets.withColumnRenamed("source", "_s")
    starts = starts.withColumnRenamed("source", "_s2").withColumnRenamed("_bucket", "_b2")
    out = laid.join(starts, laid["source"].eqNullSafe(starts["_s2"]) & (laid["_bucket"] == starts["_b2"])).drop("_s2", "_b2")
    out = out.join(broadcast_if_small(targets, targets.count(), 64), out["source"].eqNullSafe(targets["_s"])).drop("_s")
    begin = F.col("_start") + F.col("_inner")
    whole = F.floor("target")
    copies = []
    for r in range(max_repeats):
        at = begin + F.lit(r) * F.col("source_size")
        got = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), whole - at))
        share = F.try_divide(at, F.col("target"))
        time = F.lit(None).cast("double")
        for kind, knots in enumerate(schedules):
            time = F.when(F.col("kind") == kind, position(share, knots)).otherwise(time)
        copies.append(F.when(got > 0, F.struct(F.lit(r).alias("number"), time.alias("position"), got.alias("words"))))
    out = out.withColumn("copies", F.filter(F.array(*copies), lambda c: c.isNotNull()))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return out.withColumn("taken", taken).select("doc_id", *[c for c in keep if c != "doc_id"], "size", "source_size", "target", "taken", "copies", "_ticket")


def in_order(rows: DataFrame) -> DataFrame:
    """``rows(position, _ticket, ..)`` range-sorted by position."""
    keys = [F.col("position").asc_nulls_last(), F.col("_ticket")]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def arrange(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the columns of ``docs`` once for each copy taken, in
    training order; the copy cut at a source's target keeps its first words,
    with the white space between them."""
    columns = docs.columns
    # The row travels as one column, so that its names cannot meet the mix's own.
    whole = docs.select("doc_id", "text", "source", F.struct(*[docs[c] for c in columns]).alias("_row"))
    mixed = mix(whole, keep=("_row",), **settings).withColumn("_copy", F.explode("copies"))
    words_and_gaps = F.regexp_extract_all(F.col("_row.text"), F.lit("[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*"), F.lit(0))
    lead = F.array_join(F.slice(words_and_gaps, 1, F.col("_copy.words").cast("int")), "")
    cut = F.when(F.col("_copy.words") < F.col("size"), lead).otherwise(F.col("_row.text"))
    row = F.col("_row").withField("text", cut)
    rows = mixed.select(row.alias("_row"), F.col("_copy.position").alias("position"), "_ticket")
    return in_order(rows).select(*[F.col("_row").getField(c).alias(c) for c in columns])
