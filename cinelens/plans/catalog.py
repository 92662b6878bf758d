"""Named queries: one per operator (or tight group) of the inventory.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs on the driver's tables
through the fixed mapping in :mod:`cinelens.sources.testdata`;
``ORACLE[name]`` is the DuckDB SQL computing the same result. Names without
an oracle are checked by row count only (SVD with fewer components than
the rank, the schema listing, the store round trip).

Stages shared by many queries (prepared tables, fitted models) are built
once per session and table folder.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelens.config import ModelParams
from cinelens.operators import evaluate, features, prepare, profiling, validate
from cinelens.plans import model as model_mod
from cinelens.plans.oracle_sql import EVAL, PREP, SCORES, TFIDF, recommend_sql, with_stages
from cinelens.sources import testdata


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded to ``digits``, whole numbers as bigint."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


@dataclass
class Stages:
    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def _get(self, key, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    @property
    def raw(self):
        """(movies, ratings, tags) as mapped from the driver's tables.

        Ratings and tags come from one join of lineitem and orders; it is
        written once to the checkpoint folder, as a job reads its inputs
        once, instead of being re-joined by every query.
        """

        def build():
            from cinelens.session import ensure_checkpoint_dir

            ensure_checkpoint_dir(self.spark)
            return testdata.load_materialized(self.spark, self.sf_dir)

        return self._get("raw", build)

    @property
    def prepared(self):
        """(movies, tags, ratings) after the preparation stage."""
        return self._get("prepared", lambda: prepare.run_data_preparation(*self.raw))

    @property
    def featurized(self) -> DataFrame:
        def build():
            movies, tags, _ = self.prepared
            return features.assemble_movie_text(movies, tags).checkpoint(eager=True)

        return self._get("featurized", build)

    @property
    def ratings_prep(self) -> DataFrame:
        return self.prepared[2]

    def model(self, n_components=None) -> model_mod.ContentModel:
        def build():
            from cinelens.session import ensure_checkpoint_dir

            ensure_checkpoint_dir(self.spark)
            ratings = self.ratings_prep.checkpoint(eager=True)
            return model_mod.fit(self.featurized, ratings, ModelParams(n_components=n_components))

        return self._get(("model", n_components), build)

    @property
    def users(self) -> DataFrame:
        return self.raw[1].select("userId").distinct()

    @property
    def evaluation(self):
        """Leave-one-out run with default settings."""

        def build():
            m = self.model(None)
            return evaluate.evaluate_leave_one_out(m.items, m.ratings, m.dims)

        return self._get("eval", build)

    @property
    def recommendations(self) -> DataFrame:
        return self._get("recs", lambda: self.model().recommend(self.users, 10))


_STAGES: dict = {}


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGES:
        _STAGES[key] = Stages(spark, sf_dir)
    return _STAGES[key]


QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(stages(spark, sf_dir)))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


PREP_SQL = with_stages(PREP)
TFIDF_SQL = with_stages(PREP, TFIDF)
SCORES_SQL = with_stages(PREP, TFIDF, SCORES)


# ---------------------------------------------------------------- sources


@query("s1_csv_scan", with_stages() + """
SELECT 'movies' AS "table", movieId, 0::BIGINT AS userId, title AS a, genres AS b, 0.0::DOUBLE AS rating, 0::BIGINT AS ts FROM movies
UNION ALL SELECT 'ratings', movieId, userId, NULL, NULL, rating, timestamp FROM ratings
UNION ALL SELECT 'tags', movieId, userId, tag, NULL, 0.0, timestamp FROM tags
UNION ALL SELECT 'movies', -movieId, 0, 'A "' || title || '", The', nullif(split_part(genres, '|', 2), ''), 0.0, 0 FROM movies WHERE movieId % 50 = 0
""")
def _s1(s: Stages):
    """The three tables written as CSV (header, RFC 4180 quoting) and
    scanned back with the declared schemas; some titles hold quotes and
    commas, some fields are empty."""
    import uuid

    from cinelens.session import ensure_checkpoint_dir
    from cinelens.sources.tables import read_movielens

    folder = f"{ensure_checkpoint_dir(s.spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    movies, ratings, tags = s.raw
    odd = movies.filter("movieId % 50 = 0").select(
        (-F.col("movieId")).alias("movieId"), F.concat(F.lit('A "'), "title", F.lit('", The')).alias("title"),
        F.nullif(F.split_part("genres", F.lit("|"), F.lit(2)), F.lit("")).alias("genres"))
    for name, df in (("movies", movies.unionByName(odd)), ("ratings", ratings), ("tags", tags)):
        df.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}.csv")
    m, r, t = read_movielens(s.spark, folder)
    none = lambda kind: F.lit(None).cast(kind)
    return m.select(F.lit("movies").alias("table"), "movieId", F.lit(0).cast("long").alias("userId"), F.col("title").alias("a"),
                    F.col("genres").alias("b"), F.lit(0.0).alias("rating"), F.lit(0).cast("long").alias("ts")).union(
        r.select(F.lit("ratings"), "movieId", "userId", none("string"), none("string"), "rating", "timestamp")).union(
        t.select(F.lit("tags"), "movieId", "userId", "tag", none("string"), F.lit(0.0), "timestamp"))


@query("s1_csv_quarantine", with_stages() + """
SELECT kind, count(*) AS n, CAST(sum(userId) AS BIGINT) AS users, CAST(sum(movieId) AS BIGINT) AS movies FROM (
  SELECT CASE WHEN movieId % 37 = 0 OR movieId % 41 = 0 OR movieId % 43 = 0 OR movieId % 47 = 0 THEN 'broken' ELSE 'tags' END AS kind, userId, movieId FROM tags) GROUP BY kind
""")
def _s1_quarantine(s: Stages):
    """S1 over lines of which some are short, long, hold a word for a number
    or an unclosed quote: every line is a row or lies in quarantine."""
    import uuid

    from cinelens.session import ensure_checkpoint_dir
    from cinelens.sources.tables import read_checked

    m = F.col("movieId")
    fields = F.concat_ws(",", F.col("userId"), m, "tag", "timestamp")
    line = (F.when(m % 37 == 0, F.concat_ws(",", F.col("userId"), m, "tag"))
            .when(m % 41 == 0, F.concat(fields, F.lit(",more")))
            .when(m % 43 == 0, F.concat_ws(",", F.col("userId"), m, "tag", F.lit("yesterday")))
            .when(m % 47 == 0, F.concat_ws(",", F.col("userId"), m, F.concat(F.lit('"'), "tag"), "timestamp"))
            .otherwise(fields))
    path = f"{ensure_checkpoint_dir(s.spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    s.raw[2].select(line.alias("value")).write.text(path)
    rows, broken = read_checked(s.spark, path, "tags", header=False)
    parts = F.split("line", ",")
    both = rows.select(F.lit("tags").alias("kind"), "userId", "movieId").unionByName(
        broken.select(F.lit("broken").alias("kind"), parts[0].cast("long").alias("userId"), parts[1].cast("long").alias("movieId")))
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("userId").alias("users"), F.sum("movieId").alias("movies"))


# ------------------------------------------------------------- validation


@query("v1_nulls", with_stages() + """
SELECT 'movies' AS "table", CAST((SELECT count(*) FROM movies WHERE movieId IS NULL)
  + (SELECT count(*) FROM movies WHERE title IS NULL) + (SELECT count(*) FROM movies WHERE genres IS NULL) AS BIGINT) AS n_nulls
UNION ALL SELECT 'ratings', CAST((SELECT count(*) FROM ratings WHERE userId IS NULL)
  + (SELECT count(*) FROM ratings WHERE movieId IS NULL) + (SELECT count(*) FROM ratings WHERE rating IS NULL)
  + (SELECT count(*) FROM ratings WHERE timestamp IS NULL) AS BIGINT)
UNION ALL SELECT 'tags', CAST((SELECT count(*) FROM tags WHERE userId IS NULL)
  + (SELECT count(*) FROM tags WHERE movieId IS NULL) + (SELECT count(*) FROM tags WHERE tag IS NULL)
  + (SELECT count(*) FROM tags WHERE timestamp IS NULL) AS BIGINT)
""")
def _v1(s: Stages):
    movies, ratings, tags = s.raw
    parts = [validate.null_count(df).select(F.lit(n).alias("table"), "n_nulls")
             for n, df in (("movies", movies), ("ratings", ratings), ("tags", tags))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("v2_dup_ids", with_stages() + "SELECT count(*) - count(DISTINCT movieId) AS n_dup FROM movies")
def _v2(s: Stages):
    return validate.duplicate_count(s.raw[0], "movieId")


@query("v3_dup_titles", with_stages() + "SELECT count(*) - count(DISTINCT title) AS n_dup FROM movies")
def _v3(s: Stages):
    return validate.duplicate_count(s.raw[0], "title")


@query("v4_rating_orphans", with_stages() + """
SELECT count(*) AS n_orphans FROM ratings r WHERE NOT EXISTS (SELECT 1 FROM movies m WHERE m.movieId = r.movieId)
""")
def _v4(s: Stages):
    return validate.orphan_count(s.raw[1], s.raw[0])


@query("v5_range", with_stages() + """
SELECT min(rating) AS min_rating, max(rating) AS max_rating,
       (min(rating) < 0.0 OR max(rating) > 5.0) AS out_of_range FROM ratings
""")
def _v5(s: Stages):
    return validate.rating_range(s.raw[1])


@query("v6_activity", with_stages() + """
SELECT count(*) FILTER (WHERE n < 2) AS n_low FROM (SELECT userId, count(*) AS n FROM ratings GROUP BY userId)
""")
def _v6(s: Stages):
    return validate.low_activity_users(s.raw[1], 2)


@query("v7_tag_orphans", with_stages() + """
SELECT count(*) AS n_orphans FROM tags t WHERE NOT EXISTS (SELECT 1 FROM movies m WHERE m.movieId = t.movieId)
""")
def _v7(s: Stages):
    return validate.orphan_count(s.raw[2], s.raw[0])


@query("v8_report", with_stages() + """
SELECT * FROM (VALUES
  ('movies', 'nulls', (SELECT count(*) FILTER (WHERE movieId IS NULL) + count(*) FILTER (WHERE title IS NULL)
                       + count(*) FILTER (WHERE genres IS NULL) FROM movies), true,
   'Validation failed: Null movieId found'),
  ('movies', 'duplicate_ids', (SELECT count(*) - count(DISTINCT movieId) FROM movies), true,
   'Validation failed: Duplicate movieId found'),
  ('movies', 'duplicate_titles', (SELECT count(*) - count(DISTINCT title) FROM movies), false,
   'duplicate titles (warning)'),
  ('ratings', 'nulls', (SELECT count(*) FILTER (WHERE userId IS NULL) + count(*) FILTER (WHERE movieId IS NULL)
                        + count(*) FILTER (WHERE rating IS NULL) + count(*) FILTER (WHERE timestamp IS NULL)
                        FROM ratings), true, 'Validation failed: Null ratings found'),
  ('ratings', 'unknown_movies', (SELECT count(*) FROM ratings r WHERE r.movieId NOT IN (SELECT movieId FROM movies)),
   true, 'Validation failed: Ratings dataset contains unknown movieIds'),
  ('ratings', 'rating_range', (SELECT CASE WHEN min(rating) < 0.0 OR max(rating) > 5.0 OR min(rating) IS NULL
                               THEN 1 ELSE 0 END FROM ratings), true,
   'Validation failed: Rating column contains invalid values'),
  ('ratings', 'user_activity', (SELECT count(*) FROM (SELECT userId FROM ratings GROUP BY userId HAVING count(*) < 2)),
   true, 'Validation failed: Not every user has more than 2 ratings.'),
  ('tags', 'nulls', (SELECT count(*) FILTER (WHERE userId IS NULL) + count(*) FILTER (WHERE movieId IS NULL)
                     + count(*) FILTER (WHERE tag IS NULL) + count(*) FILTER (WHERE timestamp IS NULL)
                     FROM tags), true, 'Validation failed: Null values found in tags'),
  ('tags', 'unknown_movies', (SELECT count(*) FROM tags t WHERE t.movieId NOT IN (SELECT movieId FROM movies)), true,
   'Validation failed: Tags table contains '
   || (SELECT count(*) FROM tags t WHERE t.movieId NOT IN (SELECT movieId FROM movies)) || ' unknown movieIds')
) AS v("table", "check", n_bad, fatal, message)
""")
def _v8(s: Stages):
    return validate.validation_report(*s.raw)


DAMAGED = """
bad_movies AS (
  SELECT movieId, CASE WHEN movieId % 13 = 0 THEN NULL ELSE title END AS title, CASE WHEN movieId % 5 = 0 THEN 'Drama|Comedy' ELSE genres END AS genres FROM movies
  UNION ALL SELECT movieId, title, genres FROM movies WHERE movieId % 17 = 0
  UNION ALL SELECT -movieId, title, '  ' FROM movies WHERE movieId % 19 = 0),
bad_ratings AS (
  SELECT CASE WHEN userId % 23 = 0 THEN -(userId * 100000 + movieId) ELSE userId END AS userId,
         CASE WHEN movieId % 11 = 0 THEN movieId + 100000000 ELSE movieId END AS movieId,
         CASE WHEN userId % 7 = 0 THEN rating + 3 ELSE rating END AS rating,
         CASE WHEN userId % 29 = 0 THEN NULL ELSE timestamp END AS timestamp FROM ratings
  UNION ALL SELECT userId, movieId, rating, timestamp FROM ratings WHERE movieId % 31 = 0),
bad_tags AS (
  SELECT userId, CASE WHEN movieId % 11 = 0 THEN movieId + 100000000 ELSE movieId END AS movieId,
         CASE WHEN userId % 7 = 0 THEN NULL WHEN userId % 3 = 0 THEN '  ' ELSE tag END AS tag, timestamp FROM tags)
"""
DAMAGED_SQL = with_stages(DAMAGED)


def _damaged(s: Stages):
    """Copies of the three tables with faults in them, so that every check
    has something to find: null, repeated and unknown ids, ratings out of
    range, users with one rating, blank and null fields."""

    def build():
        movies, ratings, tags = s.raw
        when = lambda test, yes, no: F.when(F.expr(test), yes).otherwise(no)
        unknown = when("movieId % 11 = 0", F.col("movieId") + 100000000, F.col("movieId")).alias("movieId")
        m = movies.select("movieId", when("movieId % 13 = 0", F.lit(None), F.col("title")).alias("title"),
                          when("movieId % 5 = 0", F.lit("Drama|Comedy"), F.col("genres")).alias("genres"))
        m = m.unionByName(movies.filter("movieId % 17 = 0")).unionByName(
            movies.filter("movieId % 19 = 0").select((-F.col("movieId")).alias("movieId"), "title", F.lit("  ").alias("genres")))
        r = ratings.select(when("userId % 23 = 0", -(F.col("userId") * 100000 + F.col("movieId")), F.col("userId")).alias("userId"), unknown,
                           when("userId % 7 = 0", F.col("rating") + 3, F.col("rating")).alias("rating"),
                           when("userId % 29 = 0", F.lit(None), F.col("timestamp")).alias("timestamp"))
        r = r.unionByName(ratings.filter("movieId % 31 = 0"))
        t = tags.select("userId", unknown, when("userId % 7 = 0", F.lit(None), when("userId % 3 = 0", F.lit("  "), F.col("tag"))).alias("tag"), "timestamp")
        return m, r, t

    return s._get("damaged", build)


V8_DAMAGED_SQL = DAMAGED_SQL + """
SELECT "table", "check", n_bad, fatal FROM (VALUES
  ('movies', 'nulls', (SELECT count(*) FILTER (WHERE movieId IS NULL) + count(*) FILTER (WHERE title IS NULL)
                       + count(*) FILTER (WHERE genres IS NULL) FROM bad_movies), true),
  ('movies', 'duplicate_ids', (SELECT count(*) - count(DISTINCT movieId) FROM bad_movies), true),
  ('movies', 'duplicate_titles', (SELECT count(*) - count(DISTINCT title) FROM bad_movies), false),
  ('ratings', 'nulls', (SELECT count(*) FILTER (WHERE userId IS NULL) + count(*) FILTER (WHERE movieId IS NULL)
                        + count(*) FILTER (WHERE rating IS NULL) + count(*) FILTER (WHERE timestamp IS NULL) FROM bad_ratings), true),
  ('ratings', 'unknown_movies', (SELECT count(*) FROM bad_ratings r WHERE r.movieId NOT IN (SELECT movieId FROM bad_movies)), true),
  ('ratings', 'rating_range', (SELECT CASE WHEN min(rating) < 0.0 OR max(rating) > 5.0 THEN 1 ELSE 0 END FROM bad_ratings), true),
  ('ratings', 'user_activity', (SELECT count(*) FROM (SELECT userId FROM bad_ratings GROUP BY userId HAVING count(*) < 2)), true),
  ('tags', 'nulls', (SELECT count(*) FILTER (WHERE userId IS NULL) + count(*) FILTER (WHERE movieId IS NULL)
                     + count(*) FILTER (WHERE tag IS NULL) + count(*) FILTER (WHERE timestamp IS NULL) FROM bad_tags), true),
  ('tags', 'unknown_movies', (SELECT count(*) FROM bad_tags t WHERE t.movieId NOT IN (SELECT movieId FROM bad_movies)), true)
) AS v("table", "check", n_bad, fatal)
"""


@query("v8_report_damaged", V8_DAMAGED_SQL)
def _v8d(s: Stages):
    return validate.validation_report(*_damaged(s)).select("table", "check", "n_bad", "fatal")


@query("v8_report_on_write", V8_DAMAGED_SQL)
def _v8w(s: Stages):
    """V1-V8 while the (damaged) tables are written: nulls and ranges are
    metrics of the writes."""
    import uuid

    from cinelens.session import ensure_checkpoint_dir

    folder = f"{ensure_checkpoint_dir(s.spark).rstrip('/')}/raw-{uuid.uuid4().hex}"
    return validate.report_on_write(*_damaged(s), folder).select("table", "check", "n_bad", "fatal")


@query("v_raising_forms", DAMAGED_SQL + """
SELECT * FROM (VALUES ('movies', true), ('ratings', true), ('tags', true), ('movies_as_given', false), ('tags_as_given', false)) AS v("table", raised)
""")
def _raising(s: Stages):
    """V1-V7 in their raising form: on the damaged tables each raises."""
    movies, ratings, tags = _damaged(s)
    cases = {"movies": lambda: validate.validate_movies(movies), "ratings": lambda: validate.validate_ratings(ratings, movies),
             "tags": lambda: validate.validate_tags(tags, movies), "movies_as_given": lambda: validate.validate_movies(s.raw[0]),
             "tags_as_given": lambda: validate.validate_tags(s.raw[2], s.raw[0])}
    rows = []
    for name, call in cases.items():
        try:
            call()
            rows.append((name, False))
        except ValueError:
            rows.append((name, True))
    return s.spark.createDataFrame(rows, "table string, raised boolean")


@query("d5_dup_ids_damaged", DAMAGED_SQL + """
SELECT movieId, title, genres FROM bad_movies WHERE movieId IN (SELECT movieId FROM bad_movies GROUP BY movieId HAVING count(*) > 1)
""")
def _d5d(s: Stages):
    return profiling.duplicated_rows(_damaged(s)[0], "movieId").select("movieId", "title", "genres")


@query("d6_genres_damaged", DAMAGED_SQL + """
SELECT movieId, genres FROM bad_movies WHERE NOT regexp_full_match(genres, '(Drama[|]Comedy|[(]no genres listed[)])')
""")
def _d6d(s: Stages):
    """D6 where the format accepts a fifth of the rows."""
    return profiling.malformed_genres(_damaged(s)[0]).select("movieId", "genres")


@query("d7_orphans_damaged", DAMAGED_SQL + """
SELECT * FROM (VALUES
  ('ratings', (SELECT count(*) FROM bad_ratings r WHERE NOT EXISTS (SELECT 1 FROM bad_movies m WHERE m.movieId = r.movieId))),
  ('tags', (SELECT count(*) FROM bad_tags t WHERE NOT EXISTS (SELECT 1 FROM bad_movies m WHERE m.movieId = t.movieId)))) AS v("table", n_orphans)
""")
def _d7d(s: Stages):
    movies, ratings, tags = _damaged(s)
    parts = [validate.orphan_count(df, movies).select(F.lit(n).alias("table"), "n_orphans") for n, df in (("ratings", ratings), ("tags", tags))]
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------- preparation


@query("p1_drop_no_genres", with_stages() + "SELECT * FROM movies WHERE genres <> '(no genres listed)'")
def _p1(s: Stages):
    return prepare.drop_no_genres(s.raw[0])


@query("a1_rating_counts", with_stages() + "SELECT movieId, count(*) AS rating_count FROM ratings GROUP BY movieId")
def _a1(s: Stages):
    return prepare.rating_counts(s.raw[1])


@query("a2_merge_titles", PREP_SQL + "\nSELECT title, movieId, genres FROM merged")
def _a2(s: Stages):
    movies, ratings, _ = s.raw
    return prepare.merge_duplicate_titles(prepare.drop_no_genres(movies), ratings)[0]


@query("n1_genres", PREP_SQL + "\nSELECT title, movieId, genres FROM movies_prep")
def _n1(s: Stages):
    return s.prepared[0]


@query("p2_valid_ids", PREP_SQL + "\nSELECT userId, movieId, rating, timestamp FROM ratings_valid")
def _p2(s: Stages):
    movies, ratings, _ = s.raw
    _, valid = prepare.merge_duplicate_titles(prepare.drop_no_genres(movies), ratings)
    return prepare.filter_on_valid_id(ratings, valid)


@query("n2_tags", PREP_SQL + "\nSELECT userId, movieId, tag, timestamp FROM tags_clean")
def _n2(s: Stages):
    movies, ratings, tags = s.raw
    _, valid = prepare.merge_duplicate_titles(prepare.drop_no_genres(movies), ratings)
    return prepare.normalize_tag_values(prepare.filter_on_valid_id(tags, valid))


@query("a3_tags_joined", PREP_SQL + "\nSELECT movieId, tag FROM tags_prep")
def _a3(s: Stages):
    return s.prepared[1]


@query("n3_timestamp", with_stages() + """
SELECT userId, movieId, rating, make_timestamp(timestamp * 1000000) AS timestamp FROM ratings
""")
def _n3(s: Stages):
    return prepare.convert_timestamp(s.raw[1])


@query("a4_last_rating", PREP_SQL + "\nSELECT userId, movieId, rating, timestamp, is_last_rating FROM ratings_prep")
def _a4(s: Stages):
    return s.ratings_prep


@query("p9_display", with_stages() + """
SELECT movieId, title, replace(replace(genres, '|', ', '), ',', ', ') AS genres FROM movies
""")
def _p9(s: Stages):
    from cinelens.functions.text import display_genres

    return s.raw[0].select("movieId", "title", display_genres("genres").alias("genres"))


# -------------------------------------------------------- featurization


@query("f1_movie_text", PREP_SQL + "\nSELECT title, movieId, genres, tag, movie_text FROM featurized")
def _f1(s: Stages):
    return s.featurized


def _sorted_folder(s: Stages, df: DataFrame, *keys: str) -> str:
    import uuid

    from cinelens.session import ensure_checkpoint_dir
    from cinelens.sources.sorted import write_sorted

    path = f"{ensure_checkpoint_dir(s.spark).rstrip('/')}/sorted-{uuid.uuid4().hex}"
    write_sorted(df, path, *keys)
    return path


@query("t1_sorted_text", PREP_SQL + """
SELECT CAST(row_number() OVER (ORDER BY movieId) - 1 AS BIGINT) AS position, movieId, movie_text, 0 AS out_of_order FROM featurized
""")
def _t1(s: Stages):
    """The featurized catalogue written in movieId order; each row's place
    in the files, and the number of rows and borders that are out of order."""
    from cinelens.sources.sorted import out_of_order, read_in_order

    movies, tags, _ = s.prepared
    path = _sorted_folder(s, features.assemble_movie_text(movies, tags), "movieId")
    bad = out_of_order(s.spark, path, "movieId").select(F.col("inside") + F.col("borders")).scalar()
    return read_in_order(s.spark, path).select("position", "movieId", "movie_text", bad.alias("out_of_order"))


@query("t8_sorted_tags", with_stages() + """
SELECT CAST(row_number() OVER (ORDER BY tag) - 1 AS BIGINT) AS position, tag, 0 AS out_of_order FROM (SELECT DISTINCT tag FROM tags)
""")
def _t8(s: Stages):
    """The distinct tags written in byte order, with their places."""
    from cinelens.sources.sorted import out_of_order, read_in_order

    path = _sorted_folder(s, s.raw[2].select("tag").distinct(), "tag")
    bad = out_of_order(s.spark, path, "tag").select(F.col("inside") + F.col("borders")).scalar()
    return read_in_order(s.spark, path).select("position", "tag", bad.alias("out_of_order"))


@query("f2_tokens", TFIDF_SQL + """
SELECT movieId, CAST(pos AS BIGINT) AS pos, token FROM (
  SELECT movieId, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS token FROM toks)
""")
def _f2(s: Stages):
    from cinelens.functions.text import tokens

    return s.featurized.select("movieId", F.posexplode(tokens("movie_text")).alias("pos", "token"))


@query("f3_ngrams", TFIDF_SQL + "\nSELECT movieId, term, tf FROM doc_terms")
def _f3(s: Stages):
    return features.doc_terms(s.featurized)


def _tfidf(s: Stages):
    return s._get("tfidf", lambda: features.tfidf(s.featurized))


@query("f4_df_idf", TFIDF_SQL + "\nSELECT term, df, round(idf, 6) AS idf FROM vocab")
def _f4(s: Stages):
    return _tfidf(s)[1]


@query("f5_vocab", TFIDF_SQL + """
SELECT d.term, d.df, d.term IN (SELECT term FROM vocab) AS kept FROM dfs d
""")
def _f5(s: Stages):
    terms = features.doc_terms(s.featurized)
    dfs = features.document_frequencies(terms)
    kept = _tfidf(s)[1].select("term", F.lit(True).alias("kept"))
    return dfs.join(kept, "term", "left").select("term", "df", F.coalesce("kept", F.lit(False)).alias("kept"))


@query("f6_tfidf", TFIDF_SQL + "\nSELECT movieId, term, round(weight, 6) AS weight FROM weights")
def _f6(s: Stages):
    return _tfidf(s)[0]


DOC_TFIDF = r"""
WITH toks AS (SELECT doc_id AS movieId, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS t FROM documents),
grams AS (
  SELECT movieId, unnest(t) AS term FROM toks
  UNION ALL SELECT movieId, a || ' ' || b FROM (SELECT movieId, unnest(t[1:len(t) - 1]) AS a, unnest(t[2:]) AS b FROM toks WHERE len(t) > 1)),
doc_terms AS (SELECT movieId, term, count(*) AS tf FROM grams GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM doc_terms GROUP BY term),
n AS (SELECT count(*) AS n FROM documents),
vocab AS (SELECT term, df, ln((1 + n) / (1 + df)) + 1 AS idf FROM dfs, n WHERE df >= 3 AND df <= 0.5 * n),
raw AS (SELECT d.movieId, d.term, (1 + ln(d.tf)) * v.idf AS w FROM doc_terms d JOIN vocab v ON v.term = d.term),
weights AS (SELECT movieId, term, w / sqrt(sum(w * w) OVER (PARTITION BY movieId)) AS weight FROM raw)
"""


def _documents(s: Stages):
    docs = s.spark.read.parquet(f"{s.sf_dir.rstrip('/')}/documents.parquet")
    return docs.select(F.col("doc_id").alias("movieId"), F.col("text").alias("movie_text"))


def _doc_vocab(s: Stages):
    from cinelens.config import TfidfParams

    return s._get("doc_vocab", lambda: features.fit_vocabulary(_documents(s), TfidfParams(min_df=3, max_df=0.5)))


def _doc_tfidf(s: Stages):
    from cinelens.config import TfidfParams

    return s._get("doc_tfidf", lambda: features.tfidf(_documents(s), TfidfParams(min_df=3, max_df=0.5), _doc_vocab(s)))


@query("f3_ngrams_documents", DOC_TFIDF + "SELECT movieId, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS n_grams, max(term) AS last_term FROM doc_terms GROUP BY movieId")
def _f3_docs(s: Stages):
    """F2 + F3 over the long texts of ``documents``: the terms of each."""
    grams = F.aggregate("tfs", F.lit(0).cast("long"), lambda a, x: a + x)
    lists = features.doc_terms(_documents(s), lists=True).select("movieId", F.size("terms").alias("n"), grams.alias("grams"), F.array_max("terms").alias("last"))
    return lists.groupBy("movieId").agg(F.sum("n").alias("n_terms"), F.sum("grams").alias("n_grams"), F.max("last").alias("last_term"))


@query("f5_vocab_documents", DOC_TFIDF + "SELECT term, df, round(idf, 6) AS idf FROM vocab")
def _f5_docs(s: Stages):
    """F4 + F5 where pruning acts: terms in 3 documents at least and in half
    of them at most."""
    return _doc_vocab(s)


@query("f6_tfidf_documents", DOC_TFIDF + "SELECT movieId, term, round(weight, 6) AS weight FROM weights")
def _f6_docs(s: Stages):
    return _doc_tfidf(s)[0]


@query("f9_row_index_lines", """
SELECT CAST(row_number() OVER (ORDER BY movieId) - 1 AS BIGINT) AS idx, movieId, title
FROM (SELECT l_orderkey * 8 + l_linenumber AS movieId, CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS title FROM lineitem)
""")
def _f9_lines(s: Stages):
    """F9 over every line item."""
    lines = s.spark.read.parquet(f"{s.sf_dir.rstrip('/')}/lineitem.parquet")
    key = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long")
    return features.row_index(lines.select(key.alias("movieId"), key.cast("string").alias("title")))


@query("f9_row_index", PREP_SQL + """
SELECT CAST(row_number() OVER (ORDER BY movieId) - 1 AS BIGINT) AS idx, movieId, title FROM featurized
""")
def _f9(s: Stages):
    return features.row_index(s.featurized)


# ------------------------------------------------------------ profiles


@query("r1_profiles", SCORES_SQL + "\nSELECT userId, term, round(pw, 6) AS weight FROM prof WHERE pw <> 0")
def _r1(s: Stages):
    from cinelens.functions.vectors import entries

    m = s.model(None)
    held = m.profiles.select("userId", F.explode(entries("vec")).alias("e")).select("userId", "e.idx", F.col("e.val").alias("weight"))
    return held.filter("weight <> 0").join(m.vocab.select("idx", "term"), "idx").select("userId", "term", "weight")


@query("a8_plain_means", SCORES_SQL + """
SELECT l.userId, w.term, round(CASE WHEN l.userId % 3 = 0 THEN sum(w.weight) / max(c.n) ELSE sum(l.rating * w.weight) / max(c.ws) END, 6) AS weight
FROM liked_known l JOIN weights w ON w.movieId = l.movieId
JOIN (SELECT userId, count(*) AS n, sum(rating) AS ws FROM liked_known GROUP BY userId) c ON c.userId = l.userId
GROUP BY l.userId, w.term
""")
def _a8(s: Stages):
    """A7 and A8 side by side: the weights of every third user are 0, so
    their profiles are plain means."""
    from cinelens.functions.vectors import entries
    from cinelens.operators.profiles import liked, weighted_profiles

    m = s.model(None)
    weight = F.when(F.col("userId") % 3 == 0, F.lit(0.0)).otherwise(F.col("rating"))
    rows = liked(m.ratings, 4.0).withColumn("w", weight).join(m.items, "movieId").select("userId", "vec", "w")
    held = weighted_profiles(rows, "w").select("userId", F.explode(entries("vec")).alias("e")).select("userId", "e.idx", F.col("e.val").alias("weight"))
    return held.join(m.vocab.select("idx", "term"), "idx").select("userId", "term", "weight")


GUARDS = [("F10 no movie_text", "ValueError"), ("F10 no movies", "ValueError"), ("F11 no ratings", "ValueError"), ("R2 not fitted", "RuntimeError"),
          ("E9 not fitted", "RuntimeError"), ("S3 not fitted", "RuntimeError"), ("S4 no model", "FileNotFoundError"), ("fitted", "none")]


@query("f10_f11_e9_guards", PREP_SQL + "SELECT v.c AS \"case\", v.e AS raised, (SELECT count(*) FROM featurized) AS n_movies, (SELECT count(*) FROM ratings_prep) AS n_ratings FROM (VALUES "
       + ", ".join(f"('{c}', '{e}')" for c, e in GUARDS) + ") AS v(c, e)")
def _guards(s: Stages):
    """F10, F11, E9 and the other guards: what each call raises on tables that
    lack a column or every row, or before the fit; the fit itself raises
    nothing on the whole tables."""
    from cinelens.session import ensure_checkpoint_dir
    from cinelens.sources import store

    movies, ratings, exact = s.featurized, s.ratings_prep, ModelParams(n_components=None)
    unfitted = model_mod.ContentRecommender(movies, exact)
    nowhere = f"{ensure_checkpoint_dir(s.spark).rstrip('/')}/no-model"
    calls = [lambda: model_mod.fit(movies.drop("movie_text"), ratings, exact), lambda: model_mod.fit(movies.filter("movieId is null"), ratings, exact),
             lambda: model_mod.fit(movies, ratings.filter("userId is null"), exact), lambda: unfitted.recommend(s.users),
             lambda: unfitted.evaluate_leave_one_out(ratings), lambda: unfitted.save_model(nowhere),
             lambda: store.load_model(s.spark, nowhere, movies, ratings), lambda: s.model(None)]
    found = []
    for (case, _), call in zip(GUARDS, calls):
        try:
            call()
            found.append((case, "none"))
        except Exception as e:  # noqa: BLE001
            found.append((case, type(e).__name__))
    return s.spark.createDataFrame(found, "case string, raised string").select(
        "case", "raised", F.lit(movies.count()).alias("n_movies"), F.lit(ratings.count()).alias("n_ratings"))


# ------------------------------------------------------- recommendation


RELATED_SQL = DOC_TFIDF + """,
dots AS (SELECT a.movieId AS userId, b.movieId, sum(a.weight * b.weight) AS dot FROM weights a JOIN weights b ON b.term = a.term WHERE a.movieId <> b.movieId GROUP BY ALL),
ranked AS (
  SELECT u.doc_id AS userId, i.doc_id AS movieId, coalesce(d.dot, 0.0) AS similarity,
    row_number() OVER (PARTITION BY u.doc_id ORDER BY round(coalesce(d.dot, 0.0), 9) DESC, i.doc_id) AS rank
  FROM documents u JOIN documents i ON i.doc_id <> u.doc_id LEFT JOIN dots d ON d.userId = u.doc_id AND d.movieId = i.doc_id)
SELECT userId, CAST(rank AS BIGINT) AS rank, movieId, round(similarity, 6) AS similarity FROM ranked WHERE rank <= 10
"""


@query("r2_recommend_documents", RELATED_SQL)
def _r2_documents(s: Stages):
    """R1 + R2 in the exact mode over a real vocabulary (tens of thousands of
    terms): every document is an item, and a user who liked it alone; the ten
    nearest others are recommended."""
    from cinelens.config import TfidfParams

    docs = _documents(s).withColumns({"title": F.col("movieId").cast("string"), "genres": F.lit("")}).checkpoint(eager=True)
    ratings = docs.select(F.col("movieId").alias("userId"), "movieId", F.lit(5.0).alias("rating"))
    m = model_mod.fit(docs, ratings, ModelParams(tfidf=TfidfParams(min_df=3, max_df=0.5), n_components=None))
    return m.recommend(ratings.select("userId"), 10).filter("source = 'profile'").select("userId", "rank", "movieId", "similarity")


@query("r2_recommend", SCORES_SQL + ",\n" + recommend_sql())
def _r2(s: Stages):
    return s.recommendations


@query("r4_popular", SCORES_SQL + """
SELECT movieId, pop_rank, CAST(row_number() OVER (ORDER BY movieId) AS BIGINT) AS cat_rank,
       round(similarity, 6) AS similarity
FROM pop WHERE pop_rank <= 10
""")
def _r4(s: Stages):
    return s.model(None).popular(10)


@query("r7_cold", SCORES_SQL + ",\n" + recommend_sql().replace(
    "FROM recs r LEFT JOIN", "FROM (SELECT * FROM recs WHERE source = 'popular') r LEFT JOIN"))
def _r7(s: Stages):
    return s.recommendations.filter(F.col("source") == "popular")


_N_ALL = "(SELECT count(*) FROM featurized)"


@query("r3_top_up", SCORES_SQL + ",\n" + recommend_sql(n=_N_ALL).replace(
    "FROM recs r LEFT JOIN", "FROM (SELECT * FROM recs WHERE source = 'top_up') r LEFT JOIN"))
def _r3(s: Stages):
    """Lists as long as the catalogue: every warm list is short by the
    user's seen count and gets topped up (Q2 parity: repeats allowed). The
    lengths come from counts; no list is ranked."""
    m = s.model(None)
    return m.top_up(s.users, m.n_catalogue())


@query("r3_top_up_dedupe", SCORES_SQL + ",\n" + recommend_sql(n=_N_ALL, dedupe=True).replace(
    "FROM recs r LEFT JOIN", "FROM (SELECT * FROM recs WHERE source = 'top_up') r LEFT JOIN"))
def _r3d(s: Stages):
    """R3 with the ``dedupe_top_up`` switch: top-up rows skip items already
    in the ranked list (the parity form, r3_top_up, may repeat them)."""
    m = s.model(None)
    return m.top_up(s.users, m.n_catalogue(), dedupe=True)


@query("r5_liked", PREP_SQL + """
SELECT DISTINCT r.userId, f.movieId, f.title, f.genres
FROM ratings_prep r JOIN featurized f ON f.movieId = r.movieId WHERE r.rating >= 4.0
""")
def _r5(s: Stages):
    return s.model(None).liked()


@query("r8_service_recommend", SCORES_SQL + ",\n" + recommend_sql(meta="movies"))
def _r8(s: Stages):
    """R8 + R10: the service's answer for every user: the fitted model with
    the raw catalogue as metadata (genres keep their pipes) and raw ratings
    as seen sets (Q11)."""
    movies, ratings, _ = s.raw
    return s.model(None).recommend(s.users, 10, movies=movies, ratings=ratings)


@query("r8_answer_requests", SCORES_SQL + """,
asked AS (SELECT 'q' || userId AS request_id, userId, [3, 10, 25][CAST(abs(userId) % 3 AS INT) + 1] AS k FROM (SELECT DISTINCT userId FROM ratings UNION ALL SELECT DISTINCT -userId FROM ratings WHERE userId > 0)),
lists AS (
  SELECT a.request_id, a.userId, r.rank, r.movieId FROM asked a JOIN ranked_all r ON r.userId = a.userId AND r.rank <= a.k
  UNION ALL
  SELECT a.request_id, a.userId, row_number() OVER (PARTITION BY a.request_id ORDER BY p.movieId), p.movieId
  FROM asked a JOIN pop p ON p.pop_rank <= a.k WHERE a.userId NOT IN (SELECT userId FROM wsum))
SELECT l.request_id, l.userId, CAST(l.rank AS BIGINT) AS rank, l.movieId, f.title, f.genres FROM lists l JOIN featurized f ON f.movieId = l.movieId
""")
def _r8_requests(s: Stages):
    """R8 as requests: every user and as many unknown ones, each with its own
    k (3, none, which means 10, or 25)."""
    from cinelens.streaming.serve import answer_requests

    both = s.users.select("userId").union(s.users.filter("userId > 0").select(-F.col("userId")))
    k = F.element_at(F.array(F.lit(3), F.lit(None).cast("int"), F.lit(25)), (F.abs("userId") % 3 + 1).cast("int"))
    return answer_requests(s.model(None), both.select(F.concat(F.lit("q"), F.col("userId").cast("string")).alias("request_id"), "userId", k.alias("k")))


@query("r9_service_liked", with_stages() + """
SELECT DISTINCT r.userId, m.movieId, m.title, m.genres
FROM ratings r JOIN movies m ON m.movieId = r.movieId WHERE r.rating >= 4.0
""")
def _r9(s: Stages):
    """R9 + R10: liked movies from raw ratings and the raw catalogue, so
    merged-away and no-genre movies show up too (Q11)."""
    movies, ratings, _ = s.raw
    return s.model(None).liked(ratings=ratings, movies=movies)


@query("s3_store_roundtrip", SCORES_SQL + ",\n" + recommend_sql())
def _s3(s: Stages):
    """S3 + S4: the default-configuration model is saved, the exact model is
    saved over it, loaded back, and recommends."""
    import uuid

    from cinelens.session import ensure_checkpoint_dir
    from cinelens.sources import store

    m = s.model(None)
    path = f"{ensure_checkpoint_dir(s.spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    store.save_model(s.model(100), path)
    store.save_model(m, path)
    loaded = store.load_model(s.spark, path, m.movies, m.ratings)
    if loaded.term_basis is not None:
        raise AssertionError("a part of the earlier model was loaded")
    return loaded.recommend(s.users, 10)


@query("s4_lookups", SCORES_SQL + ",\n" + recommend_sql(users="SELECT unnest([(SELECT min(userId) FROM ratings), (SELECT max(userId) FROM ratings), -5])"))
def _s4(s: Stages):
    """S3 + S4 + R8 as point lookups: the model is stored in buckets by user,
    loaded without ratings, and asked for the first user, the last one and an
    unknown one; each lookup reads one bucket of a table."""
    import uuid
    from functools import reduce

    from cinelens.session import ensure_checkpoint_dir
    from cinelens.sources import store

    m = s.model(None)
    path = f"{ensure_checkpoint_dir(s.spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    store.save_model(m, path, user_buckets=16)
    loaded = store.load_model(s.spark, path, m.movies)
    ends = s.raw[1].agg(F.min("userId"), F.max("userId")).first()
    for df in loaded.lookup(ends[0]):
        if store.buckets_read(df) != [(1, 16)]:
            raise AssertionError("a lookup reads more than one bucket")
    return reduce(DataFrame.unionByName, [loaded.recommend_one(u, 10) for u in (*ends, -5)])


@query("r7_cold_without_ratings", SCORES_SQL + """
SELECT -1 - u.userId AS userId, CAST(row_number() OVER (PARTITION BY u.userId ORDER BY p.movieId) AS BIGINT) AS rank, p.movieId
FROM (SELECT DISTINCT userId FROM ratings) u, pop p WHERE p.pop_rank <= 10
""")
def _r7_bare(s: Stages):
    """A model without ratings answers users that have no profile."""
    from dataclasses import replace

    bare = replace(s.model(None), ratings=None)
    return bare.recommend(s.users.select((-1 - F.col("userId")).alias("userId")), 10).select("userId", "rank", "movieId")


# ----------------------------------------------------------- evaluation

EVAL_SQL = with_stages(PREP, TFIDF, EVAL)


@query("e1_eligible", PREP_SQL + """
SELECT userId, count(*) AS n_liked FROM ratings_prep WHERE rating >= 4.0 GROUP BY userId HAVING count(*) >= 5
""")
def _e1(s: Stages):
    return evaluate.eligible_users(s.ratings_prep)


@query("e2_sample", EVAL_SQL + "\nSELECT userId FROM sampled")
def _e2(s: Stages):
    return evaluate.sample_users(evaluate.eligible_users(s.ratings_prep))


@query("e3_holdout", EVAL_SQL + "\nSELECT userId, held_movieId, held_rating, held_epoch FROM held")
def _e3(s: Stages):
    users = evaluate.sample_users(evaluate.eligible_users(s.ratings_prep))
    return evaluate.holdout(evaluate.liked_rows(s.ratings_prep, users, 4.0, 42))


@query("e5_eval_lists", EVAL_SQL + """
SELECT e.userId, CAST(e.rank AS BIGINT) AS rank, e.movieId, round(e.similarity, 6) AS similarity, h.held_movieId
FROM elists e JOIN held h ON h.userId = e.userId
""")
def _e5(s: Stages):
    return s.evaluation[1]


@query("e6_hitrate", EVAL_SQL + """
SELECT round(hit_rate_at_k, 6) AS hit_rate_at_k, round(hit_rate_at_k_unmasked, 6) AS hit_rate_at_k_unmasked, n_users
FROM eval_result
""")
def _e6(s: Stages):
    return s.evaluation[0].select("hit_rate_at_k", "hit_rate_at_k_unmasked", "n_users")


@query("e7_coverage", EVAL_SQL + "\nSELECT round(coverage_at_k, 6) AS coverage_at_k, k FROM eval_result")
def _e7(s: Stages):
    return s.evaluation[0].select("coverage_at_k", "k")


@query("e8_result", EVAL_SQL + """
SELECT round(hit_rate_at_k, 6) AS hit_rate_at_k, n_users, k, round(coverage_at_k, 6) AS coverage_at_k,
       users_evaluated, round(hit_rate_at_k_unmasked, 6) AS hit_rate_at_k_unmasked
FROM eval_result
""")
def _e8(s: Stages):
    return evaluate.record(s.evaluation)


EVAL_ALL_SQL = EVAL_SQL.replace("userId LIMIT 300)", "userId)")


@query("e8_all_users", EVAL_ALL_SQL + """
SELECT round(hit_rate_at_k, 6) AS hit_rate_at_k, n_users, k, round(coverage_at_k, 6) AS coverage_at_k,
       round(hit_rate_at_k_unmasked, 6) AS hit_rate_at_k_unmasked
FROM eval_result
""")
def _e8_all(s: Stages):
    """E1-E8 over every eligible user (no sample)."""
    m = s.model(None)
    return evaluate.evaluate_leave_one_out(m.items, m.ratings, m.dims, max_users=None).result


# ------------------------------------------------------------ profiling


@query("d2_nulls", with_stages() + """
SELECT * FROM (VALUES
 ('movies', 'movieId', (SELECT count(*) FROM movies WHERE movieId IS NULL)),
 ('movies', 'title', (SELECT count(*) FROM movies WHERE title IS NULL)),
 ('movies', 'genres', (SELECT count(*) FROM movies WHERE genres IS NULL)),
 ('ratings', 'userId', (SELECT count(*) FROM ratings WHERE userId IS NULL)),
 ('ratings', 'movieId', (SELECT count(*) FROM ratings WHERE movieId IS NULL)),
 ('ratings', 'rating', (SELECT count(*) FROM ratings WHERE rating IS NULL)),
 ('ratings', 'timestamp', (SELECT count(*) FROM ratings WHERE timestamp IS NULL)),
 ('tags', 'userId', (SELECT count(*) FROM tags WHERE userId IS NULL)),
 ('tags', 'movieId', (SELECT count(*) FROM tags WHERE movieId IS NULL)),
 ('tags', 'tag', (SELECT count(*) FROM tags WHERE tag IS NULL)),
 ('tags', 'timestamp', (SELECT count(*) FROM tags WHERE timestamp IS NULL))
) AS v("table", "column", n_nulls)
""")
def _d2(s: Stages):
    movies, ratings, tags = s.raw
    return profiling.null_counts({"movies": movies, "ratings": ratings, "tags": tags})


@query("d3_blank", with_stages() + r"""
SELECT * FROM (VALUES
 ('tag', (SELECT count(*) FROM tags WHERE regexp_replace(tag, '^\s+|\s+$', '', 'g') = '')),
 ('genres', (SELECT count(*) FROM movies WHERE regexp_replace(genres, '^\s+|\s+$', '', 'g') = '')),
 ('title', (SELECT count(*) FROM movies WHERE regexp_replace(title, '^\s+|\s+$', '', 'g') = ''))
) AS v("column", n_blank)
""")
def _d3(s: Stages):
    return profiling.blank_counts(s.raw[0], s.raw[2])


@query("d4_no_genres", with_stages() + """
SELECT (SELECT count(*) FROM movies WHERE genres = '(no genres listed)') AS n_no_genres,
       (SELECT count(DISTINCT m.movieId) FROM movies m JOIN tags t ON m.movieId = t.movieId
        WHERE m.genres = '(no genres listed)') AS n_with_tags
""")
def _d4(s: Stages):
    return profiling.no_genre_movies(s.raw[0], s.raw[2])


@query("a17_dup_mask", with_stages() + """
SELECT * FROM movies WHERE title IN (SELECT title FROM movies GROUP BY title HAVING count(*) > 1)
""")
def _a17(s: Stages):
    return profiling.duplicated_rows(s.raw[0], "title")


_GENRE_ALT = "|".join(g.replace("-", "\\-") for g in profiling.VALID_GENRES)


@query("d6_bad_genres", with_stages() + rf"""
SELECT * FROM movies
WHERE NOT regexp_full_match(genres, '(?i)(?:\(no genres listed\)|(?:{_GENRE_ALT})(?:\|(?:{_GENRE_ALT}))*)')
""")
def _d6(s: Stages):
    return profiling.malformed_genres(s.raw[0])


@query("d8_dup_pairs", with_stages() + """
SELECT userId, movieId, count(*) AS duplicates FROM ratings GROUP BY userId, movieId HAVING count(*) > 1
""")
def _d8(s: Stages):
    return profiling.duplicate_pairs(s.raw[1])


@query("d9_ranges", with_stages() + """
SELECT min(rating) AS min_rating, max(rating) AS max_rating, min(timestamp) AS min_rating_ts,
       max(timestamp) AS max_rating_ts, (SELECT min(timestamp) FROM tags) AS min_tag_ts,
       (SELECT max(timestamp) FROM tags) AS max_tag_ts
FROM ratings
""")
def _d9(s: Stages):
    return profiling.ranges(s.raw[1], s.raw[2])


@query("d10_tags", with_stages() + "SELECT DISTINCT tag FROM tags")
def _d10(s: Stages):
    return profiling.distinct_tags(s.raw[2])


def _describe_sql(table: str, col: str) -> str:
    """Moments, plus nearest-rank quartiles: the value at 0-based rank
    round(q * (n - 1)) of the sorted non-null values."""
    x = f"CAST({col} AS DOUBLE)"
    return f"""
SELECT '{table}' AS "table", '{col}' AS "column", statistic,
       CASE WHEN value = 0 OR value IS NULL THEN value
            ELSE round(value / pow(10, floor(log10(abs(value)))), 9) * pow(10, floor(log10(abs(value)))) END
         AS value FROM (
  SELECT unnest(['count','null_count','mean','std','min','max']) AS statistic,
         unnest([CAST(count({x}) AS DOUBLE), CAST(count(*) FILTER (WHERE {col} IS NULL) AS DOUBLE),
                 avg({x}), stddev_samp({x}), min({x}), max({x})]) AS value
  FROM {table}
  UNION ALL
  SELECT q.name, s.v FROM (VALUES ('25%', 0.25), ('50%', 0.5), ('75%', 0.75)) q(name, p)
  JOIN (SELECT {x} AS v, row_number() OVER (ORDER BY {x}) - 1 AS pos FROM {table} WHERE {col} IS NOT NULL) s
    ON s.pos = round(q.p * ((SELECT count({x}) FROM {table}) - 1)))"""


_DESCRIBED = [("movies", ["movieId"]), ("ratings", ["userId", "movieId", "rating", "timestamp"]),
              ("tags", ["userId", "movieId", "timestamp"])]


@query("d11_describe", with_stages() + "\nUNION ALL".join(
    _describe_sql(t, c) for t, cols in _DESCRIBED for c in cols))
def _d11(s: Stages):
    frames = dict(zip(("movies", "ratings", "tags"), s.raw))
    parts = [profiling.describe(frames[t], cols).select(F.lit(t).alias("table"), "*") for t, cols in _DESCRIBED]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    # Moments of values near 1e9 differ between engines past the 15th
    # significant digit (summation order): compare 10 significant digits.
    v = F.col("value")
    scale = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(v))))
    return out.withColumn("value", F.when((v == 0) | v.isNull(), v).otherwise(F.round(v / scale, 9) * scale))


@query("d12_counts", with_stages() + """
SELECT array_to_string(string_split(genres, '|'), '|') AS genre_list, count(*) AS count
FROM movies GROUP BY genres ORDER BY count DESC, genre_list LIMIT 5
""")
def _d12(s: Stages):
    out = profiling.genre_list_counts(s.raw[0], 5)
    return out.select(F.array_join("genre_list", "|").alias("genre_list"), "count")


@query("a18_hist", with_stages() + """
SELECT b AS bin, round(lo + w * b, 6) AS lo, round(lo + w * (b + 1), 6) AS hi, coalesce(c, 0) AS count FROM (
  SELECT CAST(b.range AS BIGINT) AS b, x.lo, x.w, c.c
  FROM range(30) b
  CROSS JOIN (SELECT min(rating) AS lo, (max(rating) - min(rating)) / 30 AS w FROM ratings) x
  LEFT JOIN (
    SELECT CAST(CASE WHEN w > 0 THEN least(floor((rating - lo) / w), 29) ELSE 0 END AS BIGINT) AS bin, count(*) AS c
    FROM ratings, (SELECT min(rating) AS lo, (max(rating) - min(rating)) / 30 AS w FROM ratings) GROUP BY 1
  ) c ON c.bin = b.range)
""")
def _a18(s: Stages):
    return profiling.histogram(s.raw[1], "rating", 30)


@query("d14_top10", with_stages() + """
SELECT t.movieId, t.rating_count, m.title, m.genres FROM (
  SELECT movieId, count(rating) AS rating_count FROM ratings GROUP BY movieId
  ORDER BY rating_count DESC, movieId LIMIT 10) t LEFT JOIN movies m ON m.movieId = t.movieId
""")
def _d14(s: Stages):
    return profiling.top_rated(s.raw[1], s.raw[0], 10)


@query("d15_activity", with_stages() + """
SELECT userId, count(rating) AS rating_count FROM ratings GROUP BY userId
""")
def _d15(s: Stages):
    return profiling.user_activity(s.raw[1])


@query("d5_dup_ids", with_stages() + """
SELECT * FROM movies WHERE movieId IN (SELECT movieId FROM movies GROUP BY movieId HAVING count(*) > 1)
""")
def _d5(s: Stages):
    return profiling.duplicated_rows(s.raw[0], "movieId")


@query("d7_orphans", with_stages() + """
SELECT 'ratings' AS "table", count(*) AS n_orphans FROM ratings r
WHERE NOT EXISTS (SELECT 1 FROM movies m WHERE m.movieId = r.movieId)
UNION ALL
SELECT 'tags', count(*) FROM tags t WHERE NOT EXISTS (SELECT 1 FROM movies m WHERE m.movieId = t.movieId)
""")
def _d7(s: Stages):
    movies, ratings, tags = s.raw
    return (validate.orphan_count(ratings, movies).select(F.lit("ratings").alias("table"), "n_orphans")
            .unionByName(validate.orphan_count(tags, movies).select(F.lit("tags").alias("table"), "n_orphans")))


@query("d12_tag_counts", with_stages() + "SELECT tag AS value, count(*) AS count FROM tags GROUP BY tag")
def _d12t(s: Stages):
    return profiling.value_counts(s.raw[2], "tag")


@query("d12_genres_counts", with_stages() + "SELECT genres AS value, count(*) AS count FROM movies GROUP BY genres")
def _d12g(s: Stages):
    return profiling.value_counts(s.raw[0], "genres")


@query("d12_genre_counts", with_stages() + """
SELECT genre, count(*) AS count FROM (SELECT unnest(string_split(genres, '|')) AS genre FROM movies) GROUP BY genre
""")
def _d12s(s: Stages):
    return profiling.single_genre_counts(s.raw[0])


@query("d15_activity_hist", with_stages() + """
SELECT b AS bin, round(lo + w * b, 6) AS lo, round(lo + w * (b + 1), 6) AS hi, coalesce(c, 0) AS count FROM (
  SELECT CAST(b.range AS BIGINT) AS b, x.lo, x.w, c.c
  FROM range(30) b
  CROSS JOIN (SELECT CAST(min(n) AS DOUBLE) AS lo, CAST(max(n) - min(n) AS DOUBLE) / 30 AS w
              FROM (SELECT count(rating) AS n FROM ratings GROUP BY userId)) x
  LEFT JOIN (
    SELECT CAST(CASE WHEN w > 0 THEN least(floor((n - lo) / w), 29) ELSE 0 END AS BIGINT) AS bin, count(*) AS c
    FROM (SELECT count(rating) AS n FROM ratings GROUP BY userId),
         (SELECT CAST(min(n) AS DOUBLE) AS lo, CAST(max(n) - min(n) AS DOUBLE) / 30 AS w
          FROM (SELECT count(rating) AS n FROM ratings GROUP BY userId))
    GROUP BY 1
  ) c ON c.bin = b.range)
""")
def _d15h(s: Stages):
    return profiling.activity_histogram(s.raw[1], 30)


@query("t7_preview", with_stages() + "SELECT * FROM movies ORDER BY movieId LIMIT 5")
def _t7(s: Stages):
    return profiling.preview(s.raw[0], 5, "movieId")


@query("f7_svd_full", SCORES_SQL + ",\n" + recommend_sql())
def _f7_full(s: Stages):
    """F7 checked by SQL: with as many components as terms (at least the
    rank), SVD vectors keep every inner product of the TF-IDF rows, so
    recommendations through the SVD path equal the exact ones."""
    n_terms = _tfidf(s)[1].count()
    m = s.model(int(n_terms))
    return m.recommend(s.users, 10)


@query("f7_svd_gram", SCORES_SQL + """
SELECT i.movieId, round(i.inorm * i.inorm, 6) AS sq_norm, round(coalesce(d.dot, 0.0), 6) AS centroid_dot
FROM item_norm i LEFT JOIN (
  SELECT w.movieId, sum(c.c * w.weight) AS dot FROM centroid c JOIN weights w ON c.term = w.term GROUP BY w.movieId
) d ON d.movieId = i.movieId
""")
def _f7_gram(s: Stages):
    """F7 numerically against SQL: at full rank the SVD keeps inner
    products, so each item's squared norm and its inner product with the
    catalogue centroid equal those of its TF-IDF row."""
    from cinelens.functions.vectors import dot, vec_mean

    n_terms = _tfidf(s)[1].count()
    items = s.model(int(n_terms)).items
    # Centroid as k rows (d, c_d); v . c is an equi-join on the dimension.
    center = items.agg(vec_mean("vec").alias("c")).select(F.posexplode("c").alias("d", "c_d"))
    parts = items.select("movieId", F.posexplode("vec").alias("d", "v_d"))
    cdot = parts.join(F.broadcast(center), "d").groupBy("movieId").agg(F.sum(F.col("v_d") * F.col("c_d")).alias("centroid_dot"))
    return items.select("movieId", dot("vec", "vec").alias("sq_norm")).join(cdot, "movieId", "left").select(
        "movieId", "sq_norm", F.coalesce("centroid_dot", F.lit(0.0)).alias("centroid_dot")
    )


# Row-count only (no oracle).


@query("d1_schema", with_stages() + """
SELECT v."table", v."column", v.dtype, v.position, t.n_rows, t.n_cols FROM (VALUES
  ('movies', 'movieId', 'bigint', 0), ('movies', 'title', 'string', 1), ('movies', 'genres', 'string', 2),
  ('ratings', 'userId', 'bigint', 0), ('ratings', 'movieId', 'bigint', 1), ('ratings', 'rating', 'double', 2), ('ratings', 'timestamp', 'bigint', 3),
  ('tags', 'userId', 'bigint', 0), ('tags', 'movieId', 'bigint', 1), ('tags', 'tag', 'string', 2), ('tags', 'timestamp', 'bigint', 3)
) AS v("table", "column", dtype, position)
JOIN (VALUES ('movies', (SELECT count(*) FROM movies), 3), ('ratings', (SELECT count(*) FROM ratings), 4), ('tags', (SELECT count(*) FROM tags), 4)
) AS t("table", n_rows, n_cols) ON t."table" = v."table"
""")
def _d1(s: Stages):
    movies, ratings, tags = s.raw
    parts = [profiling.schema_table(df, n) for n, df in (("movies", movies), ("ratings", ratings), ("tags", tags))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("f7_svd")
def _f7(s: Stages):
    """Item vectors of the default model (100 components): one row per
    catalogue movie; values depend on the solver's basis."""
    m = s.model(100)
    return m.items.select("movieId", F.size("vec").alias("dims"), F.sqrt(F.aggregate(
        "vec", F.lit(0.0), lambda acc, v: acc + v * v)).alias("norm"))


SVD_CHECKS = ["basis_orthonormal", "items_are_a_times_basis", "items_orthogonal_by_component", "singular_values_fall",
              "leading_vectors_satisfy_ata", "kept_and_residual_norms_add_up"]


@query("f7_svd_invariants", "SELECT * FROM (VALUES " + ", ".join(f"('{c}', true)" for c in SVD_CHECKS) + ') AS v("check", ok)')
def _f7_invariants(s: Stages):
    """F7 of the default model (100 components, 5 power iterations) by what
    must hold of any basis, to 1e-6 of the largest singular value; the vectors
    that lead (a tenth) satisfy A'A v = sigma^2 v, and their items A v, to 1e-4
    of it (a randomized basis leaves out a little of the trailing ones)."""
    import numpy as np

    from cinelens.functions.vectors import vec_sum
    from cinelens.operators.factorize import gram

    m, (weights, _) = s.model(100), _tfidf(s)
    k, sigma = m.dims, np.asarray(m.singular_values)
    scaled = F.transform("vec", lambda v: v * F.col("weight"))
    product = weights.join(m.term_basis, "term").groupBy("movieId").agg(vec_sum(scaled).alias("vec"))
    lead = max(1, k // 10)
    gap = F.aggregate(F.slice(F.zip_with("vec", "other", lambda x, y: F.abs(x - y)), 1, lead), F.lit(0.0), lambda a, x: F.greatest(a, x))
    worst = m.items.join(product.select("movieId", F.col("vec").alias("other")), "movieId").agg(F.max(gap)).first()[0]
    back = weights.join(m.items, "movieId").groupBy("term").agg(vec_sum(scaled).alias("vec"))
    squares = F.array(*[F.lit(float(x * x)) for x in sigma])
    off = F.aggregate(F.slice(F.zip_with("vec", F.zip_with("basis", squares, lambda v, q: v * q), lambda x, y: F.abs(x - y)), 1, lead), F.lit(0.0), lambda a, x: F.greatest(a, x))
    far = back.join(m.term_basis.select("term", F.col("vec").alias("basis")), "term").agg(F.max(off)).first()[0]
    total = weights.agg(F.sum(F.col("weight") * F.col("weight"))).first()[0]
    basis, items = gram(m.term_basis, "vec", k), gram(m.items, "vec", k)
    tol = 1e-6 * sigma[0]
    some = sigma > tol
    # Residual of each row: its norm minus that of its item vector.
    rows = weights.groupBy("movieId").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).join(
        m.items.select("movieId", F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v).alias("kept")), "movieId")
    residual, low = rows.agg(F.sum(F.col("n") - F.col("kept")), F.min(F.col("n") - F.col("kept"))).first()
    ok = [np.abs(basis - np.diag(some.astype(float))).max() < 1e-6, worst < 1e-4 * sigma[0], np.abs(items - np.diag(sigma**2)).max() < tol * sigma[0],
          bool((np.diff(sigma) <= tol).all()), far < 1e-4 * sigma[0] ** 2, low > -tol and abs(float((sigma**2).sum()) + residual - total) < tol * sigma[0]]
    return s.spark.createDataFrame([(c, bool(x)) for c, x in zip(SVD_CHECKS, ok)], "check string, ok boolean")


LIST_CHECKS = ["ten_ranks_each", "none_seen", "similarity_is_cosine", "sorted"]


@query("r2_recommend_svd_checks", PREP_SQL + "SELECT v.c AS \"check\", v.n AS n_bad, u.n AS n_users FROM (VALUES " + ", ".join(f"('{c}', 0)" for c in LIST_CHECKS) + """) AS v(c, n),
(SELECT count(DISTINCT userId) AS n FROM ratings_prep WHERE rating >= 4.0) u
""")
def _r2_svd_checks(s: Stages):
    """Lists of the default model: of every user with a profile, rows that
    break what any basis must give."""
    from cinelens.functions.vectors import cosine

    m = s.model(100)
    lists = m.recommend(m.profiles.select("userId"), 10).checkpoint()
    n_users = m.profiles.count()
    per = lists.groupBy("userId").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("rank")).alias("ranks"))
    bad_ranks = per.filter(F.col("ranks") != F.array(*[F.lit(i) for i in range(1, 11)])).count() + n_users - per.count()
    seen = lists.join(m.ratings.select("userId", "movieId"), ["userId", "movieId"], "left_semi").count()
    both = lists.join(m.items, "movieId").join(m.profiles.select("userId", F.col("vec").alias("p")), "userId")
    off = both.filter(F.abs(cosine("vec", "p") - F.col("similarity")) > 1e-9).count()
    order = Window.partitionBy("userId").orderBy("rank")
    rises = lists.withColumn("before", F.lag(F.round("similarity", 9)).over(order)).filter(F.round("similarity", 9) > F.col("before")).count()
    return s.spark.createDataFrame([(c, n, n_users) for c, n in zip(LIST_CHECKS, (bad_ranks, seen, off, rises))], "check string, n_bad long, n_users long")


@query("e8_result_svd_checks", EVAL_SQL + """
SELECT n_users, k, users_evaluated, 0.0 AS hit_rate_at_k, true AS in_range FROM eval_result
""")
def _e8_svd_checks(s: Stages):
    """Evaluation of the default model: who is evaluated does not depend on
    the basis, the masked hit rate is 0, the other ratios lie in [0, 1]."""
    r = _e8_svd(s)
    fine = F.col("coverage_at_k").between(0.0, 1.0) & (F.col("coverage_at_k") > 0) & F.col("hit_rate_at_k_unmasked").between(0.0, 1.0)
    return r.select("n_users", "k", "users_evaluated", "hit_rate_at_k", fine.alias("in_range"))


@query("r2_recommend_svd")
def _r2_svd(s: Stages):
    """The reference's default configuration: 100 SVD components. Values
    depend on the basis (rows-only); one list of 10 per user."""
    return s.model(100).recommend(s.users, 10)


@query("e8_result_svd")
def _e8_svd(s: Stages):
    """Leave-one-out evaluation of the default (100-component) model."""
    m = s.model(100)
    return evaluate.record(evaluate.evaluate_leave_one_out(m.items, m.ratings, m.dims))


def queries() -> dict:
    return dict(QUERIES)


def oracle() -> dict:
    return dict(ORACLE)
