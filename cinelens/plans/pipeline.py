"""End-to-end batch job: validate, prepare, featurize, fit, save, evaluate,
recommend. The Spark form of the reference's training entry point.

Every stage stays a lazy DataFrame until an action needs it: validation
runs one small report per table, fitting checkpoints the item vectors,
and the outputs are written as tables, not collected.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cinelens.config import (
    EVAL_MAX_USERS,
    EVAL_MIN_LIKED,
    MAX_RATING,
    MIN_RATING,
    MIN_RATINGS_PER_USER,
    TOP_K,
    ModelParams,
)
from cinelens.operators import evaluate, features, prepare, validate
from cinelens.plans.model import ContentModel, fit
from cinelens.session import ensure_checkpoint_dir
from cinelens.sources import store

log = logging.getLogger(__name__)


@dataclass
class PipelineResult:
    model: ContentModel
    movies: DataFrame
    ratings: DataFrame
    tags: DataFrame
    evaluation: DataFrame
    eval_lists: DataFrame
    recommendations: DataFrame


def run(
    spark: SparkSession,
    movies: DataFrame,
    ratings: DataFrame,
    tags: DataFrame,
    params: ModelParams = ModelParams(),
    users: DataFrame | None = None,
    model_path: str | None = None,
    output_path: str | None = None,
    strict_validation: bool = True,
) -> PipelineResult:
    """Run every stage over whole tables.

    ``users`` defaults to every user in ``ratings``. With ``model_path``
    the model is saved and evaluated after reloading (as the reference
    does); with ``output_path`` recommendations and the evaluation row are
    written as Parquet. ``strict_validation=False`` logs failed checks
    instead of raising.
    """
    try:
        validate.validate_movies(movies)
        validate.validate_ratings(ratings, movies, MIN_RATINGS_PER_USER, MIN_RATING, MAX_RATING)
        validate.validate_tags(tags, movies)
    except ValueError as exc:
        if strict_validation:
            raise
        log.warning("validation: %s", exc)

    movies_p, tags_p, ratings_p = prepare.run_data_preparation(movies, ratings, tags)
    # Both feed several jobs (fit, profiles, seen sets, evaluation, lookups):
    # written once to the checkpoint folder instead of recomputed per use.
    ensure_checkpoint_dir(spark)
    featurized = features.assemble_movie_text(movies_p, tags_p).checkpoint(eager=True)
    ratings_p = ratings_p.checkpoint(eager=True)
    model = fit(featurized, ratings_p, params)
    if model_path:
        store.save_model(model, model_path)
        model = store.load_model(spark, model_path, featurized, ratings_p)

    evaluation = evaluate.evaluate_leave_one_out(
        model.items, ratings_p, model.dims, params.rating_threshold, EVAL_MIN_LIKED, TOP_K, EVAL_MAX_USERS
    )
    result, lists = evaluate.record(evaluation), evaluation.lists
    who = users if users is not None else ratings.select("userId").distinct()
    recs = model.recommend(who, TOP_K)
    if output_path:
        out = output_path.rstrip("/")
        recs.write.mode("overwrite").parquet(f"{out}/recommendations")
        result.write.mode("overwrite").parquet(f"{out}/evaluation")
    return PipelineResult(model, movies_p, ratings_p, tags_p, result, lists, recs)


def main(argv: list[str] | None = None) -> int:
    """Command line: ``python -m cinelens.plans.pipeline <csv folder> <out>
    [--model PATH] [--components K]``. As in the reference's entry point,
    a failure is logged and the process ends normally (exit code 1)."""
    import argparse

    from cinelens.session import build_session
    from cinelens.sources import read_movielens

    ap = argparse.ArgumentParser(prog="cinelens")
    ap.add_argument("input", help="folder with movies.csv, ratings.csv, tags.csv")
    ap.add_argument("output", help="folder for recommendations/ and evaluation/")
    ap.add_argument("--model", default=None, help="folder to save the model to")
    ap.add_argument("--components", type=int, default=ModelParams().n_components)
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session()
    try:
        movies, ratings, tags = read_movielens(spark, args.input)
        run(spark, movies, ratings, tags, ModelParams(n_components=args.components),
                  model_path=args.model, output_path=args.output)
        r = spark.read.parquet(f"{args.output.rstrip('/')}/evaluation").first()
        log.info("HitRate@%s: %.3f (evaluated on %s users)", r.k, r.hit_rate_at_k, r.n_users)
        log.info("Coverage@%s: %.3f", r.k, r.coverage_at_k)
        return 0
    except Exception:  # noqa: BLE001 - logged, like the reference's main
        log.exception("pipeline failed")
        return 1


if __name__ == "__main__":
    raise SystemExit(main())
