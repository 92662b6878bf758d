"""The fitted recommender (R6) as a bundle of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.config import ModelParams
from cinelens.operators import factorize, features, profiles, recommend


@dataclass
class ContentModel:
    """Item vectors, user profiles and what produced them.

    ``movies``: featurized catalogue (metadata for outputs); ``ratings``:
    the ratings seen sets come from; ``items(movieId, vec)``;
    ``profiles(userId, vec)``; ``vocab(term, df, idf)``, with the term's
    position ``idx`` in the exact mode, whose vectors are sparse rows;
    ``term_basis`` (SVD only) projects new TF-IDF rows.
    """

    params: ModelParams
    movies: DataFrame
    ratings: DataFrame | None
    items: DataFrame
    profiles: DataFrame
    vocab: DataFrame
    dims: int
    term_basis: DataFrame | None = None
    singular_values: np.ndarray | None = field(default=None, repr=False)
    #: ``(userId, movieId)`` pairs from the store, where ratings are not given.
    seen: DataFrame | None = None

    def recommend(self, users: DataFrame, n: int = 10, dedupe_top_up: bool = False,
                  movies: DataFrame | None = None, ratings: DataFrame | None = None) -> DataFrame:
        """R2/R3/R7 for all users of ``users(userId)``; ``movies`` and
        ``ratings`` replace the model's metadata and seen sets (R10)."""
        seen = next((x for x in (ratings, self.ratings, self.seen) if x is not None), None)
        if seen is None:
            # Without ratings only users without a profile can be answered:
            # their list needs none.
            if not users.select("userId").join(self.profiles.select("userId"), "userId", "left_semi").isEmpty():
                raise RuntimeError("no ratings to take seen items from; pass ratings=")
            seen = users.sparkSession.createDataFrame([], "userId long, movieId long")
        return recommend.recommend_users(
            users,
            self.profiles,
            self.items,
            seen,
            movies if movies is not None else self.movies,
            n,
            self.dims,
            dedupe_top_up=dedupe_top_up,
            n_movies=None if movies is not None else self.n_catalogue(),
        )

    def lookup(self, user_id: int) -> tuple[DataFrame, DataFrame]:
        """``(profile, seen)`` rows of one user, filtered by a literal, so that
        bucketed tables read the one bucket that can hold them."""
        seen = next((x for x in (self.seen, self.ratings) if x is not None), None)
        if seen is None:
            raise RuntimeError("no ratings to take seen items from")
        mine = F.col("userId") == F.lit(int(user_id))
        return self.profiles.filter(mine), seen.select("userId", "movieId").filter(mine)

    def recommend_one(self, user_id: int, n: int = 10, dedupe_top_up: bool = False) -> DataFrame:
        """R2/R3/R7 for one user, from that user's rows alone."""
        profile, seen = self.lookup(user_id)
        user = profile.sparkSession.createDataFrame([(int(user_id),)], "userId long")
        return recommend.recommend_users(user, profile, self.items, seen, self.movies, n, self.dims, dedupe_top_up=dedupe_top_up, n_movies=self.n_catalogue())

    def top_up(self, users: DataFrame, n: int, dedupe: bool = False) -> DataFrame:
        """R3 alone, with metadata: the rows added to lists shorter than
        ``n``, of the users of ``users(userId)`` with a profile. A short list
        holds every unseen item of the catalogue, so ``dedupe`` leaves only
        rows of other items."""
        from cinelens.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(users.sparkSession)
        warm = self.profiles.select("userId").join(users.select("userId").distinct(), "userId", "left_semi")
        size = self.n_catalogue()
        pop = self.popular(n)
        if dedupe:
            # A rule of the item alone, so it holds before users meet items.
            pop = pop.join(self.items.select("movieId"), "movieId", "left_anti")
        rows = recommend.top_up(warm, self.items, self.ratings, int(n), size, pop)
        return recommend.with_metadata(rows, self.movies, size)

    def n_catalogue(self) -> int:
        """Rows of the model's catalogue: one item vector per movie, read
        from the checkpointed vectors instead of re-running featurization."""
        return self.items.count()

    def liked(self, ratings: DataFrame | None = None, movies: DataFrame | None = None) -> DataFrame:
        """R5 for every user."""
        return recommend.liked_movies(
            ratings if ratings is not None else self.ratings,
            movies if movies is not None else self.movies,
            self.params.rating_threshold,
            n_movies=None if movies is not None else self.n_catalogue(),
        )

    def popular(self, n: int = 10) -> DataFrame:
        """R4."""
        return recommend.popular(self.items, n, self.dims)


def fit_items(movies: DataFrame, params: ModelParams = ModelParams()):
    """F10 + F2-F7: ``(items, vocab, dims, term_basis, singular_values)``."""
    if "movie_text" not in movies.columns or movies.isEmpty():
        raise ValueError("The movies table must contain a non-empty 'movie_text' column.")
    weights, vocab = features.tfidf(movies, params.tfidf)
    if params.n_components is None:
        items, vocab, dims = factorize.exact_vectors(weights, vocab, movies)
        return items, vocab, dims, None, None
    items, basis, values = factorize.randomized_svd(
        weights,
        movies,
        params.n_components,
        seed=params.seed,
        oversample=params.svd_oversample,
        power_iters=params.svd_power_iters,
    )
    return items, vocab, int(params.n_components), basis, values


def fit(movies: DataFrame, ratings: DataFrame, params: ModelParams = ModelParams()) -> ContentModel:
    """Item vectors, then profiles. Raises ``ValueError`` on a missing
    ``movie_text``, an empty catalogue (F10) or empty ratings (F11).

    Item vectors and profiles are checkpointed to the shared checkpoint
    folder: they feed scoring, the centroid and evaluation, and a lost
    executor must not send Spark back through the whole TF-IDF lineage.
    """
    from cinelens.session import ensure_checkpoint_dir

    if ratings is None or ratings.isEmpty():
        raise ValueError("Ratings data must be provided and not be empty.")
    items, vocab, dims, basis, values = fit_items(movies, params)
    ensure_checkpoint_dir(items.sparkSession)
    items = items.checkpoint(eager=True)
    prof = profiles.build_profiles(
        ratings, items, params.rating_threshold, n_items=items.count(), dims=dims
    ).checkpoint(eager=True)
    return ContentModel(params, movies, ratings, items, prof, vocab, dims, basis, values)


def project(model: ContentModel, weights: DataFrame) -> DataFrame:
    """Vectors for new TF-IDF rows ``(movieId, term, weight)`` in the SVD
    space: ``sum(weight * basis[term])`` (terms outside the basis drop)."""
    if model.term_basis is None:
        raise RuntimeError("the model has no SVD basis (fitted with n_components=None)")
    from cinelens.functions.vectors import vec_sum

    return (
        weights.join(model.term_basis, "term")
        .groupBy("movieId")
        .agg(vec_sum(F.transform("vec", lambda v: v * F.col("weight"))).alias("vec"))
    )


class ContentRecommender:
    """Object API with the reference's method names over the Spark model.

    ``ContentRecommender(movies, **params).fit(ratings)``, then
    ``recommend(user_id | users_df, rec_n)``, ``get_actual_liked_movies``,
    ``save_model`` / ``load_model``. Calls before ``fit`` raise
    ``RuntimeError`` (R2, E9). A single id is a one-row users table; the
    same job serves any number of users.
    """

    def __init__(self, movies: DataFrame, params: ModelParams = ModelParams()):
        self.movies_df = movies
        self.params = params
        self.model: ContentModel | None = None

    @property
    def fitted(self) -> bool:
        return self.model is not None

    def _require(self) -> ContentModel:
        if self.model is None:
            raise RuntimeError("Recommender has not been fitted. Please run fit() first.")
        return self.model

    def fit(self, ratings: DataFrame) -> "ContentRecommender":
        self.model = fit(self.movies_df, ratings, self.params)
        return self

    def _users(self, users) -> DataFrame:
        if isinstance(users, DataFrame):
            return users
        spark = self.movies_df.sparkSession
        ids = [users] if isinstance(users, int) else list(users)
        return spark.createDataFrame([(int(u),) for u in ids], "userId long")

    def recommend(self, users, rec_n: int = 10, dedupe_top_up: bool = False) -> DataFrame:
        if isinstance(users, int) and self._require().seen is not None:
            return self._require().recommend_one(users, rec_n, dedupe_top_up)
        return self._require().recommend(self._users(users), rec_n, dedupe_top_up=dedupe_top_up)

    def get_actual_liked_movies(self, users=None) -> DataFrame:
        liked = self._require().liked()
        return liked if users is None else liked.join(self._users(users), "userId", "left_semi")

    def popular_movies(self, top_n: int = 10) -> DataFrame:
        return self._require().popular(top_n)

    def save_model(self, path: str, user_buckets: int | None = None) -> None:
        from cinelens.sources import store

        if self.model is None:
            raise RuntimeError("Cannot save an unfitted model.")
        store.save_model(self.model, path, user_buckets)

    @classmethod
    def load_model(cls, path: str, movies: DataFrame, ratings: DataFrame | None = None) -> "ContentRecommender":
        from cinelens.sources import store

        model = store.load_model(movies.sparkSession, path, movies, ratings)
        rec = cls(movies, model.params)
        rec.model = model
        return rec

    def evaluate_leave_one_out(self, ratings: DataFrame, **kwargs):
        """E1-E9 over ``ratings`` with this model's item vectors."""
        from cinelens.operators import evaluate

        m = self._require()
        return evaluate.evaluate_leave_one_out(m.items, ratings, m.dims, **kwargs)
