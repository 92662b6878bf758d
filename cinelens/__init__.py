"""cinelens: content-based recommendation as Spark DataFrame jobs.

Stages (each a module of DataFrame -> DataFrame functions):

- ``sources``    tables, schemas, CSV scan, model store, test-table mapping
- ``functions``  column expressions (text cleaning, tokenizer, vector math)
- ``operators``  validation, preparation, TF-IDF, SVD, profiles, scoring,
                 recommendation, evaluation, profiling
- ``plans``      the fitted model, the end-to-end pipeline, named queries
- ``streaming``  micro-batch serving of recommendation requests
"""

from cinelens.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
