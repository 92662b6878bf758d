import math

from cinelens.config import TfidfParams
from cinelens.functions import text
from cinelens.operators import features
from conftest import rows

FEAT_SCHEMA = "title string, movieId long, genres string"


def test_movie_text_fx8(spark):
    movies = spark.createDataFrame(
        [("Title_A", 1, "animation"), ("Title_B", 2, " comedy romance"), ("Title_C", 4, "thriller action"),
         ("Title_D", 3, "action")], FEAT_SCHEMA)
    tags = spark.createDataFrame(
        [(1, " miyazaki  japan"), (2, "romance couple"), (4, "al_pacino mafia")], "movieId long, tag string")
    out = features.assemble_movie_text(movies, tags, sort=True)
    assert out.columns == ["title", "movieId", "genres", "tag", "movie_text"]
    got = [(r.movieId, r.movie_text, r.tag) for r in out.collect()]
    assert [g[0] for g in got] == [1, 2, 3, 4]  # sorted by movieId
    texts = {g[0]: g[1] for g in got}
    assert texts[1] == "animation japan miyazaki"
    assert texts[2] == "comedy couple romance"
    assert texts[3] == "action" and got[2][2] is None  # null tag kept as null
    assert texts[4] == "action al_pacino mafia thriller"


def test_row_index(spark):
    df = spark.createDataFrame([("c", 3), ("a", 1), ("b", 2), ("z", 10)], "title string, movieId long")
    idx = features.row_index(df)
    assert rows(idx, "idx", "movieId") == [(0, 1), (1, 2), (2, 3), (3, 10)]


def test_tokenizer(spark):
    df = spark.createDataFrame([("Amélie al_pacino a film-noir",)], "movie_text string")
    assert df.select(text.tokens("movie_text").alias("t")).first().t == ["amélie", "al_pacino", "film", "noir"]


def test_ngrams(spark):
    df = spark.createDataFrame([("a bb cc dd",), ("x",), ("ab",)], "movie_text string")
    got = [r.g for r in df.select(text.ngrams(text.tokens("movie_text")).alias("g")).collect()]
    assert got == [["bb", "cc", "dd", "bb cc", "cc dd"], [], ["ab"]]


def _hand_tfidf(docs):
    """TF-IDF by the published formulas: sublinear tf, smooth idf + 1, l2."""
    import re

    n = len(docs)
    grams = []
    for d in docs:
        t = re.findall(r"(?u)\b\w\w+\b", d.lower())
        grams.append(t + [f"{a} {b}" for a, b in zip(t, t[1:])])
    df = {}
    for g in grams:
        for term in set(g):
            df[term] = df.get(term, 0) + 1
    vocab = {t for t, c in df.items() if c <= 0.95 * n}
    out = []
    for g in grams:
        w = {}
        for term in set(g) & vocab:
            tf = g.count(term)
            w[term] = (1 + math.log(tf)) * (math.log((1 + n) / (1 + df[term])) + 1)
        norm = math.sqrt(sum(v * v for v in w.values()))
        out.append({t: v / norm for t, v in w.items()} if norm else {})
    return out


def test_tfidf_matches_formulas(spark):
    docs = ["adventure animation disney", "adventure", "al_pacino crime thriller", "comedy romance", "comedy",
            "film film-noir noir"]
    movies = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "movieId long, movie_text string")
    weights, vocab = features.tfidf(movies, TfidfParams())
    got = {}
    for r in weights.collect():
        got.setdefault(r.movieId, {})[r.term] = r.weight
    want = _hand_tfidf(docs)
    for i, w in enumerate(want):
        g = got.get(i, {})
        assert set(g) == set(w)
        for t in w:
            assert abs(g[t] - w[t]) < 1e-12


def test_max_df_prunes_common_terms(spark):
    movies = spark.createDataFrame([(1, "aa bb"), (2, "aa cc")], "movieId long, movie_text string")
    _, vocab = features.tfidf(movies, TfidfParams())
    assert "aa" not in {r.term for r in vocab.collect()}  # df 2 > 0.95 * 2


def test_tokenizer_agrees_with_word_regex_on_random_text(spark):
    """F2 on 400 random strings mixing scripts, digits, marks and symbols:
    the JVM pattern gives the same tokens as the documented word pattern
    (runs of two or more word characters)."""
    import random
    import re

    alphabet = list("abcXYZ019_ -!.,'éüßñçøÅ") + ["²", "٣", "中", "ж", " ", "\t", "́", "ǅ", "ʰ"]
    rnd = random.Random(11)
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, movie_text string")
    got = {r.i: r.t for r in df.select("i", text.tokens("movie_text").alias("t")).collect()}
    word = re.compile(r"(?u)\b\w\w+\b")
    for i, t in enumerate(texts):
        assert got[i] == word.findall(t.lower()), repr(t)


def test_terms_of_movies_with_several_rows_or_no_id(spark):
    """Texts are counted where they are read; rows of one movieId (null too)
    count as one movie, in every form of the terms."""
    from collections import Counter

    from pyspark.sql import functions as F

    docs = [(1, "aa bb aa"), (2, "aa cc"), (2, "cc aa cc"), (None, "dd"), (None, "dd aa"), (3, ""), (4, None), (5, "x y"), (6, "aa")]
    movies = spark.createDataFrame(docs, "movieId long, movie_text string").repartition(3)
    want = Counter()
    for i, t in docs:
        words = [w for w in (t or "").split() if len(w) > 1]
        want.update((i, g) for g in words + [" ".join(p) for p in zip(words, words[1:])])
    got = features.doc_terms(movies).collect()
    assert {(r.movieId, r.term): r.tf for r in got} == want and len(got) == len(want)
    lists = features.doc_terms(movies, lists=True).select("movieId", F.explode(F.arrays_zip("terms", "tfs")).alias("e")).select("movieId", "e.*").collect()
    assert {(r.movieId, r.terms): r.tfs for r in lists} == want and len(lists) == len(want)
    held = features.postings(movies)
    by_term = held.select("term", F.explode(F.arrays_zip("ids", "tfs")).alias("e")).select("term", "e.*").collect()
    assert {(r.ids, r.term): r.tfs for r in by_term} == want and len(by_term) == len(want)
    dfs = {r.term: r.df for r in features.document_frequencies(held).collect()}
    assert dfs == Counter(term for _, term in want)


def test_vocabulary_is_fitted_without_weights(spark, monkeypatch):
    movies = spark.createDataFrame([(1, "aa bb"), (2, "aa cc"), (3, "bb")], "movieId long, movie_text string")
    monkeypatch.setattr(features, "stored", None)
    vocab = features.fit_vocabulary(movies, TfidfParams(min_df=2))
    assert {r.term: r.df for r in vocab.collect()} == {"aa": 2, "bb": 2}


def test_batches_are_cut_by_tokens(spark, monkeypatch):
    """N-grams of up to three words, in cuts of two tokens, long texts whole."""
    import pyarrow as pa

    monkeypatch.setattr(features, "BATCH_TOKENS", 2)
    batch = pa.RecordBatch.from_arrays([pa.array([7, None, 8, 9]), pa.array(["aa bb aa bb", "cc", None, "dd ee"])], names=["movieId", "_tok"])
    got = {}
    for out in features._lists_task((2, 3))([batch]):
        for r in out.to_pylist():
            got.setdefault(r["movieId"], {}).update(zip(r["terms"], r["tfs"]))
    assert got == {7: {"aa bb": 2, "bb aa": 1, "aa bb aa": 1, "bb aa bb": 1}, 9: {"dd ee": 1}}
