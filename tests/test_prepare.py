import datetime as dt

import pytest

from cinelens.operators import prepare
from conftest import rows

MOVIES = [
    (1, "Title A", "(no genres listed)"),
    (2, "Title B", "Drama|Romance"),
    (3, "Title B", "Drama"),
    (4, "Title C", "Thriller|Action|Mystery"),
    (5, "Title D", "Action|Adventure"),
    (6, "Title E", "Animation"),
    (7, "Title F", "Animation|Children"),
    (8, "Title D", "Action|Adventure|Children"),
    (9, "Title G", "Sci-Fi"),
    (10, "Title H", "Musical|Romance"),
]
RATINGS = [(11, 2, 4.0, 0), (12, 3, 5.0, 0), (13, 3, 3.0, 0), (14, 5, 4.0, 0), (15, 5, 4.0, 0),
           (16, 8, 2.0, 0), (17, 8, 5.0, 0), (18, 8, 3.0, 0), (19, 1, 5.0, 0), (20, 10, 4.0, 0)]
M_SCHEMA = "movieId long, title string, genres string"
R_SCHEMA = "userId long, movieId long, rating double, timestamp long"
T_SCHEMA = "userId long, movieId long, tag string, timestamp long"


def test_drop_no_genres(spark):
    out = prepare.drop_no_genres(spark.createDataFrame(MOVIES, M_SCHEMA))
    assert sorted(r.movieId for r in out.collect()) == [2, 3, 4, 5, 6, 7, 8, 9, 10]


def test_drop_no_genres_edge_cases(spark):
    plain = spark.createDataFrame(MOVIES[1:4], M_SCHEMA)
    assert prepare.drop_no_genres(plain).count() == 3
    empty = spark.createDataFrame([], M_SCHEMA)
    out = prepare.drop_no_genres(empty)
    assert out.count() == 0 and out.columns == ["movieId", "title", "genres"]


def test_merge_duplicate_titles(spark):
    movies = spark.createDataFrame(MOVIES, M_SCHEMA)
    ratings = spark.createDataFrame(RATINGS, R_SCHEMA)
    merged, valid = prepare.merge_duplicate_titles(movies, ratings)
    assert merged.columns == ["title", "movieId", "genres"]
    assert sorted(r.movieId for r in valid.collect()) == [1, 3, 4, 6, 7, 8, 9, 10]
    got = {r.title: (r.movieId, r.genres) for r in merged.collect()}
    # Q6: id and genres may come from different rows.
    assert got["Title B"] == (3, "Drama|Romance")
    assert got["Title D"] == (8, "Action|Adventure|Children")


def test_merge_ties_go_to_first_row(spark):
    movies = spark.createDataFrame([(5, "T", "a|b"), (2, "T", "c|d"), (9, "U", "x")], M_SCHEMA)
    ratings = spark.createDataFrame([], R_SCHEMA)
    merged, _ = prepare.merge_duplicate_titles(movies, ratings)
    got = {r.title: (r.movieId, r.genres) for r in merged.collect()}
    assert got["T"] == (2, "c|d")


@pytest.mark.parametrize(
    "raw,expected",
    [("  DRAMA|Romance ", "drama romance"), ("Action | AdveNTure ", "action adventure"),
     ("Drama ", "drama"), ("Comedy |Drama ", "comedy drama")],  # Q21: no-break space
)
def test_normalize_genres(spark, raw, expected):
    df = spark.createDataFrame([(1, "t", raw)], M_SCHEMA)
    assert prepare.normalize_genres(df).first().genres == expected


def test_normalize_tags(spark):
    tags = spark.createDataFrame(
        [(1, 1, "gangster.", 0), (2, 2, "doctors", 0), (3, 2, "doctors", 0), (2, 1, "mafia! ", 0),
         (5, 3, "Al Pacino", 0)], T_SCHEMA)
    out = prepare.normalize_tag_column(tags)
    assert rows(out, "movieId", "tag") == [(1, "gangster mafia"), (2, "doctors"), (3, "al_pacino")]


def test_tag_quirks(spark):
    # Q8: characters are dropped after strip and collapse.
    tags = spark.createDataFrame(
        [(1, 1, "! mafia", 0), (1, 2, "sci - fi", 0), (1, 3, "sci-fi", 0), (1, 4, "!!!", 0)], T_SCHEMA)
    got = dict(rows(prepare.normalize_tag_values(tags), "movieId", "tag"))
    assert got == {1: "_mafia", 2: "sci__fi", 3: "scifi", 4: ""}


def test_last_rating_flag(spark):
    times = [dt.datetime(2025, 1, 5, 10), dt.datetime(2025, 1, 6, 10), dt.datetime(2025, 3, 5, 15),
             dt.datetime(2025, 2, 5, 10), dt.datetime(2025, 3, 10, 10)]
    users = [1, 1, 3, 4, 3]
    epoch = dt.datetime(1970, 1, 1)
    data = [(u, i, 4.0, int((t - epoch).total_seconds())) for i, (u, t) in enumerate(zip(users, times))]
    out = prepare.mark_last_rating_per_user(spark.createDataFrame(data, R_SCHEMA))
    flags = {}
    for r in out.collect():
        flags.setdefault(r.userId, []).append(r.is_last_rating)
    assert all(sum(v) == 1 for v in flags.values())


def test_last_rating_ties_flag_all(spark):
    # Q7: equal latest timestamps flag every such row.
    df = spark.createDataFrame([(1, 1, 4.0, 10), (1, 2, 3.0, 10), (1, 3, 2.0, 5)], R_SCHEMA)
    got = dict(rows(prepare.mark_last_rating_per_user(df), "movieId", "is_last_rating"))
    assert got == {1: True, 2: True, 3: False}


def test_filter_and_timestamp(spark):
    tags = spark.createDataFrame([(1, i, f"t{i}", 964980868) for i in range(1, 7)], T_SCHEMA)
    valid = spark.createDataFrame([(1,), (3,), (6,)], "movieId long")
    assert sorted(r.movieId for r in prepare.filter_on_valid_id(tags, valid).collect()) == [1, 3, 6]
    none = spark.createDataFrame([(23,), (44,), (66,)], "movieId long")
    assert prepare.filter_on_valid_id(tags, none).count() == 0
    conv = prepare.convert_timestamp(tags)
    assert dict(conv.dtypes)["timestamp"] == "timestamp_ntz"
    assert conv.first().timestamp == dt.datetime(2000, 7, 30, 18, 14, 28)


def test_whole_stage(spark):
    movies = spark.createDataFrame(
        [(1, "Title_A", "Animation|Comedy"), (2, "Title_B", "(no genres listed)"),
         (3, "Title_B", "Adventure|Fantasy"), (4, "Title_C", "Comedy|Crime"), (5, "Title_D", "Action|Thriller")],
        M_SCHEMA)
    ratings = spark.createDataFrame(
        [(1, 1, 5.0, 964982703), (2, 2, 4.0, 964982704), (3, 3, 3.0, 964982705), (1, 1, 4.0, 964982706),
         (4, 4, 5.0, 964982707), (5, 99, 2.0, 964982708)], R_SCHEMA)
    tags = spark.createDataFrame(
        [(1, 1, "funny", 0), (2, 3, "action thriller", 0), (3, 4, "classic", 0), (4, 99, "not valid tag", 0)],
        T_SCHEMA)
    m, t, r = prepare.run_data_preparation(movies, ratings, tags)
    assert m.columns == ["title", "movieId", "genres"]
    assert rows(m, "title", "movieId", "genres") == [
        ("Title_A", 1, "animation comedy"), ("Title_B", 3, "adventure fantasy"),
        ("Title_C", 4, "comedy crime"), ("Title_D", 5, "action thriller")]
    assert rows(t, "movieId", "tag") == [(1, "funny"), (3, "action_thriller"), (4, "classic")]
    got = rows(r, "userId", "movieId", "rating", "is_last_rating")
    assert got == [(1, 1, 4.0, True), (1, 1, 5.0, False), (3, 3, 3.0, True), (4, 4, 5.0, True)]


def test_cleaning_rules_on_random_text(spark):
    """N1 and N2 on 300 random strings against the rules written in plain
    Python: lower case, Unicode whitespace, strip, drop outside [a-z0-9 ],
    spaces to underscores (tags); pipes with spaces to one space (genres)."""
    import random
    import re

    alphabet = list("aBc Z9_-|!.é") + [" ", "\t", "\n", " ", " | ", "ß"]
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 20))) for _ in range(300)]
    df = spark.createDataFrame([(i, i, t, 0) for i, t in enumerate(texts)], T_SCHEMA)
    tags = {r.userId: r.tag for r in prepare.normalize_tag_values(df).collect()}
    genres = {r.movieId: r.genres for r in prepare.normalize_genres(
        spark.createDataFrame([(i, "t", t) for i, t in enumerate(texts)], M_SCHEMA)).collect()}
    for i, t in enumerate(texts):
        tag = re.sub(r"\s+", " ", t.lower()).strip()
        tag = re.sub(r"[^a-z0-9 ]", "", tag).replace(" ", "_")
        assert tags[i] == tag, repr(t)
        assert genres[i] == re.sub(r"\s*\|\s*", " ", t.lower()).strip(), repr(t)
