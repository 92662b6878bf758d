"""Toxicity: a linear classifier on character n-grams.

Indicators of 5- to 7-grams of the characters of the lower-cased text, scaled by
naive Bayes log-count ratios and fitted on labelled text; see
:mod:`cinelens.llm.nbsvm`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cinelens.llm import nbsvm
from cinelens.llm.common import prepare, slices

PARAMS = nbsvm.Params(grams="char", orders=(5, 6, 7), bits=19, fit_rows=3000)


def fit(docs: DataFrame, labels: DataFrame, params: nbsvm.Params = PARAMS) -> nbsvm.Model:
    """``labels(doc_id, toxic)``."""
    return nbsvm.fit(docs, labels.select("doc_id", F.col("toxic").alias("label")), params)


def score(docs: DataFrame, model: nbsvm.Model, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score``: how likely the text is toxic."""
    return nbsvm.score(docs, model, keep)


def remove(docs: DataFrame, model: nbsvm.Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` scored under ``threshold``, with their columns;
    rows with a null or empty text stay."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        scorer = nbsvm.Scorer(shared.value)
        for batch in slices(batches, 2000):
            keep = [not t or scorer(t) < threshold for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, StructType([StructField(f.name, f.dataType) for f in docs.schema.fields]))
