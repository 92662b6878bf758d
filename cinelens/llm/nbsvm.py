"""Linear classifier on n-gram indicators scaled by naive Bayes log-count
ratios (NBSVM), for the quality and toxicity operators.

1. *Counts.* For every labelled training row, the document frequency of each
   hashed n-gram in either class: a Spark job over all training rows whose
   tasks add up dense arrays and send the non-zero sums. The ratio of an
   n-gram is ``r = ln((p + a_p) / |p|) - ln((q + a_q) / |q|)``.
2. *Fit.* Rows are the indicators times ``r``, divided by their length. A
   linear hinge-loss model is fitted by dual coordinate descent, in one
   task, on a bounded sample: about ``fit_rows`` rows of each class, chosen
   by a hash of the id. Counts have no bound.
3. *Score.* One pass over all documents; the weights (two float arrays of
   ``2**bits`` entries) are broadcast. The margin becomes a probability by a
   logistic curve fitted on the sample's cross-fitted margins (each half is
   judged by a model of the other half).

Texts are used whole. A null text is scored as an empty one. A document that
repeats, or that several rows label, counts once for each pair of such rows; a
null doc_id has no label. Without rows of both classes every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm import kernels
from cinelens.llm.common import prepare, slices, unit_hash
from cinelens.operators.joins import broadcast_if_small
from cinelens.session import release, stored


@dataclass(frozen=True)
class Params:
    #: "char": n-grams of the characters of the lower-cased text; "word": words and outlines.
    grams: str = "char"
    orders: tuple[int, ...] = (5, 6, 7)
    bits: int = 19
    #: Rows of each class in the fit, about (chosen by hash).
    fit_rows: int = 3000
    smoothing: float = 30.0
    cost: float = 1.0
    epochs: int = 12


@dataclass
class Model:
    params: Params
    weight: np.ndarray  # of an indicator: ratio times fitted weight
    square: np.ndarray  # square of the ratio, for the length of a row
    bias: float
    slope: float
    shift: float


class Features:
    """Distinct hashed n-grams of a text."""

    def __init__(self, params: Params):
        self.params, self.distinct = params, kernels.Distinct(1 << params.bits)

    def __call__(self, text: str | None) -> np.ndarray:
        p = self.params
        if not text:
            return np.empty(0, np.uint32)
        grams = kernels.char_ngrams(text, p.orders, p.bits) if p.grams == "char" else kernels.word_and_shape_ngrams(text, p.bits)
        return self.distinct(grams)


def count_task(params: Params):
    def run(batches):
        import pyarrow as pa

        features = Features(params)
        counts = np.zeros((2, 1 << params.bits), np.int64)
        rows = [0, 0]
        for batch in slices(batches):
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                counts[label][features(text)] += 1
                rows[label] += 1
        idx = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_pydict({
            "gram": np.append(idx, -1).astype(np.int64),
            "neg": np.append(counts[0][idx], rows[0]), "pos": np.append(counts[1][idx], rows[1])})

    return run


def packed(batches):
    """Columns ``gram, r`` as bytes, a row for each batch: half a million rows
    would be as many Python objects on the driver."""
    import pyarrow as pa

    for batch in batches:
        parts = batch.column("gram").to_numpy().astype("<i4"), batch.column("r").to_numpy().astype("<f4")
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts], names=["gram", "r"])


def ratio(neg, pos, neg_total: float, pos_total: float, a: float):
    """Log-count ratio of an n-gram, as an expression. The smoothing ``a`` is
    dealt to the classes by their share of all counts, so that an n-gram seen
    as often as its class's size foretells has ratio 0, however unequal the
    classes."""
    share = pos_total / (pos_total + neg_total)
    return F.log((pos + F.lit(2 * a * share)) / F.lit(share)) - F.log((neg + F.lit(2 * a * (1 - share))) / F.lit(1 - share))


def descend(rows: list[np.ndarray], labels: np.ndarray, r: np.ndarray, params: Params) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L1 hinge loss; the classes weigh the
    same. Row ``i`` holds ``r`` at its n-grams, over the row's length, and a
    constant 1."""
    n = len(rows)
    y = np.where(labels > 0, 1.0, -1.0)
    share = {s: n / (2.0 * max((y == s).sum(), 1)) for s in (1.0, -1.0)}
    scale = [1.0 / max(np.sqrt((r[x] ** 2).sum()), 1e-12) for x in rows]
    w, b, alpha = np.zeros(len(r)), 0.0, np.zeros(n)
    rng = np.random.default_rng(7)
    for _ in range(params.epochs):
        largest = 0.0
        for i in rng.permutation(n):
            x, s = rows[i], y[i]
            v = r[x] * scale[i]
            top = params.cost * share[s]
            new = min(max(alpha[i] - (s * (w[x] @ v + b) - 1.0) / (1.0 + (len(x) > 0)), 0.0), top)
            step = new - alpha[i]
            if step:
                w[x] += step * s * v
                b += step * s
                alpha[i] = new
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return w, b


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve from margin to probability, by Newton
    steps with a small ridge; the classes weigh the same."""
    y = (labels > 0).astype(float)
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    target = np.where(y > 0, 0.99, 0.01)
    a, c = 1.0, 0.0
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a * margins + c, -30, 30)))
        g = np.array([(share * (p - target) * margins).sum() + 1e-4 * a, (share * (p - target)).sum()])
        h = share * p * (1 - p)
        m = np.array([[(h * margins * margins).sum() + 1e-4, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m, g)
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-3), float(c)


def margin_of(rows: list[np.ndarray], wr: np.ndarray, b: float, r: np.ndarray) -> np.ndarray:
    return np.array([wr[x].sum() / max(np.sqrt((r[x] ** 2).sum()), 1e-12) + b for x in rows])


def fit_task(params: Params, r_shared):
    def run(batches):
        import pyarrow as pa

        features = Features(params)
        rows = []
        for batch in slices(batches):
            for key, label, text in zip(*(batch.column(c).to_pylist() for c in ("key", "label", "text"))):
                x = features(text)
                x.sort()
                rows.append((key, label, x))
        rows.sort(key=lambda t: (t[0], t[1], len(t[2])))
        labels = np.array([t[1] for t in rows])
        if len(set(labels.tolist())) < 2:
            return
        r = r_shared.value.astype(np.float64)
        rows = [t[2] for t in rows]
        # The curve is fitted on margins of rows that their own model has not seen.
        halves = np.arange(len(rows)) % 2
        margins = np.zeros(len(rows))
        for h in (0, 1):
            seen = np.flatnonzero(halves == h)
            if len(set(labels[seen].tolist())) == 2:
                w, b = descend([rows[i] for i in seen], labels[seen], r, params)
                rest = np.flatnonzero(halves != h)
                margins[rest] = margin_of([rows[i] for i in rest], w * r, b, r)
        w, b = descend(rows, labels, r, params)
        wr = w * r
        if not margins.any():
            margins = margin_of(rows, wr, b, r)
        slope, shift = logistic(margins, labels)
        yield pa.RecordBatch.from_pydict({"weight": [wr.astype(np.float32).tobytes()], "bias": [b], "slope": [slope], "shift": [shift]})

    return run


def fit(docs: DataFrame, labels: DataFrame, params: Params) -> Model:
    """``docs(doc_id, text)`` that may be learned from, ``labels(doc_id,
    label)`` with 0 or 1; rows with another or no label are left out."""
    spark = docs.sparkSession
    prepare(spark)
    size = 1 << params.bits
    labels = labels.select("doc_id", F.col("label").cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)")
    known = broadcast_if_small(labels, labels.count(), 16)
    train = docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", "label", "text")
    counted = stored(train.mapInArrow(count_task(params), "gram long, neg long, pos long").groupBy("gram").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")))
    sums = {r["rows"]: r for r in counted.groupBy((F.col("gram") < 0).alias("rows")).agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).collect()}
    flat = Model(params, np.zeros(size, np.float32), np.zeros(size, np.float32), 0.0, 1.0, 0.0)
    if not {True, False} <= sums.keys() or not all(sums[k][c] for k in sums for c in ("neg", "pos")):
        release(counted)
        return flat
    neg_rows, pos_rows = sums[True]["neg"], sums[True]["pos"]
    ratios = counted.filter("gram >= 0").select(F.col("gram").cast("int").alias("gram"), ratio(F.col("neg"), F.col("pos"), sums[False]["neg"], sums[False]["pos"], params.smoothing).cast("float").alias("r"))
    r = np.zeros(size, np.float32)
    for gram, values in ratios.mapInArrow(packed, "gram binary, r binary").collect():
        r[np.frombuffer(gram, "<i4")] = np.frombuffer(values, "<f4")
    release(counted)
    shared = spark.sparkContext.broadcast(r)
    part = lambda n: F.lit(min(1.0, params.fit_rows / n))
    key = F.xxhash64("doc_id")
    sample = train.filter(unit_hash("doc_id", F.lit(11)) < F.when(F.col("label") == 1, part(pos_rows)).otherwise(part(neg_rows)))
    done = sample.select(key.alias("key"), "label", "text").repartition(1).mapInArrow(fit_task(params, shared), "weight binary, bias double, slope double, shift double").collect()
    if not done:
        return flat
    d = done[0]
    return Model(params, np.frombuffer(d["weight"], np.float32), r * r, d["bias"], d["slope"], d["shift"])


class Scorer:
    """Probability of label 1 for one text."""

    def __init__(self, model: Model):
        self.model, self.features = model, Features(model.params)

    def __call__(self, text: str | None) -> float:
        m, x = self.model, self.features(text)
        z = m.bias
        if len(x):
            z += m.weight[x].sum(dtype=np.float64) / max(np.sqrt(m.square[x].sum(dtype=np.float64)), 1e-12)
        return float(1 / (1 + np.exp(-np.clip(m.slope * z + m.shift, -30, 30))))


def score_task(shared):
    def run(batches):
        import pyarrow as pa

        scorer = Scorer(shared.value)
        for batch in slices(batches, 2000):
            scores = pa.array([scorer(t.as_py()) for t in batch.column("text")], pa.float64())
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [scores], names=[*names, "score"])

    return run


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of each row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "text")
    return kept.mapInArrow(score_task(shared), f"{schema}, score double")
