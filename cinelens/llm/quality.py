"""Quality classifier: naive Bayes support vectors over word n-grams.

Indicators of word uni- and bigrams, and of uni- to trigrams of word
outlines (case, length class, closing marks, repeat of the word before),
scaled by log-count ratios; see :mod:`cinelens.llm.nbsvm`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm import nbsvm

PARAMS = nbsvm.Params(grams="word", bits=18, fit_rows=3000, smoothing=5.0)


def fit(docs: DataFrame, labels: DataFrame, params: nbsvm.Params = PARAMS) -> nbsvm.Model:
    """``labels(doc_id, quality)``."""
    return nbsvm.fit(docs, labels.select("doc_id", F.col("quality").alias("label")), params)


def score(docs: DataFrame, model: nbsvm.Model, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score``: how likely the text is of label 1."""
    return nbsvm.score(docs, model, keep)
