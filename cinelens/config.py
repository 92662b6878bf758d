"""Default parameters.

Fixed values that must equal the reference's defaults for equal results:
TF-IDF min_df 1 (a document count), max_df 0.95 (a share of documents),
n-gram range (1, 2), l2 norm, idf on, smooth idf on, sublinear tf on;
SVD 100 components, seed 42; liked threshold 4.0; top-k 10;
evaluation: at least 5 liked movies, at most 300 users, seed 42;
validation: at least 2 ratings per user, ratings between 0.0 and 5.0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values (see module docstring).
TFIDF_MIN_DF = 1
TFIDF_MAX_DF = 0.95
TFIDF_NGRAM_RANGE = (1, 2)
SVD_COMPONENTS = 100
SVD_SEED = 42
RATING_THRESHOLD = 4.0
TOP_K = 10
EVAL_MIN_LIKED = 5
EVAL_MAX_USERS = 300
EVAL_SEED = 42
MIN_RATINGS_PER_USER = 2
MIN_RATING = 0.0
MAX_RATING = 5.0
NO_GENRES = "(no genres listed)"


@dataclass(frozen=True)
class TfidfParams:
    """TF-IDF settings. ``min_df``/``max_df``: an int is a document count,
    a float a share of documents."""

    min_df: float = TFIDF_MIN_DF
    max_df: float = TFIDF_MAX_DF
    ngram_range: tuple = TFIDF_NGRAM_RANGE
    norm: str | None = "l2"
    use_idf: bool = True
    smooth_idf: bool = True
    sublinear_tf: bool = True


@dataclass(frozen=True)
class ModelParams:
    """Recommender settings. ``n_components=None`` keeps the exact TF-IDF
    space (no SVD), as sparse rows over a vocabulary of any size."""

    tfidf: TfidfParams = field(default_factory=TfidfParams)
    rating_threshold: float = RATING_THRESHOLD
    n_components: int | None = SVD_COMPONENTS
    seed: int = SVD_SEED
    svd_oversample: int = 10
    svd_power_iters: int = 5
