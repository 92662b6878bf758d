"""Featurization: F1 (movie text), F9 (row index) and TF-IDF F2-F6.

TF-IDF is kept as a long table ``(movieId, term, weight)``: exploding the
n-grams and grouping by ``(movieId, term)`` gives term frequencies, a
grouping by ``term`` gives document frequencies. No vocabulary or matrix is
built on the driver; the document count enters as a scalar subquery.

A text is one row, so its n-grams are counted in the task that reads it, in
Arrow batches; only the texts of a ``movieId`` that has several rows meet in a
shuffle. What the vocabulary is joined with are postings: a row for each term
and batch, with the movies that hold it.
"""

from __future__ import annotations

from numbers import Integral

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.config import TfidfParams
from cinelens.functions import text
from cinelens.operators.joins import ID_ROW_BYTES, ID_SET_LIMIT_BYTES, TERM_ROW_BYTES, broadcast_if_small
from cinelens.operators.ordering import numbered
from cinelens.session import ensure_checkpoint_dir, ship_package, stored


def assemble_movie_text(movies: DataFrame, tags: DataFrame, sort: bool = False) -> DataFrame:
    """F1 (+ J2): ``movies ⟕ tags`` and ``movie_text``.

    ``movie_text`` = genres, a space and the tag string (null tag as empty),
    whitespace collapsed, stripped, split on a space, de-duplicated, sorted
    and joined. A null genres value gives a null text. Columns:
    ``title, movieId, genres, tag, movie_text`` (the input order plus two).
    ``sort=True`` orders by movieId (T1); leave it off inside a pipeline,
    where order carries no meaning and a global sort costs a shuffle.
    """
    joined = movies.join(tags.select("tag", "movieId"), "movieId", "left")
    raw = F.concat(F.col("genres"), F.lit(" "), F.coalesce(F.col("tag"), F.lit("")))
    out = joined.select(
        *movies.columns,
        "tag",
        text.sorted_unique_words(text.collapse_ws(raw)).alias("movie_text"),
    )
    return out.orderBy("movieId") if sort else out


def row_index(movies: DataFrame, order_col: str = "movieId") -> DataFrame:
    """0-based position of each row in ``order_col`` order, with title
    (see :func:`cinelens.operators.ordering.numbered`)."""
    return numbered(movies.select(order_col, "title"), order_col, name="idx").select("idx", order_col, "title")


def run_featurization(movies: DataFrame, tags: DataFrame, sort: bool = False) -> tuple[DataFrame, DataFrame]:
    """Stage: ``(featurized movies, row index table)``."""
    final = assemble_movie_text(movies, tags, sort=sort)
    return final, row_index(final)


# ---------------------------------------------------------------- TF-IDF


# Tokens of a batch counted together.
BATCH_TOKENS = 1 << 20


def _token_slices(batches):
    """``(ids, tokens)`` of the texts with tokens, at most ``BATCH_TOKENS``
    together or one text. Tokens hold no space and come joined by one."""
    import pyarrow.compute as pc

    for batch in batches:
        batch = batch.filter(pc.greater(pc.fill_null(pc.binary_length(batch.column(1)), 0), 0))
        ends = np.cumsum(pc.add(pc.count_substring(batch.column(1), " "), 1).to_numpy())
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH_TOKENS, "right")))
            part = batch.slice(at, to - at)
            yield part.column(0), pc.split_pattern(part.column(1), " ")
            at = to


def _gram_counts(tokens, ngram_range: tuple):
    """``(row, place in names, count, names)`` of the n-grams of rows of tokens,
    for each n: an (n+1)-gram is an n-gram and the token after it, as numbers;
    text is made once for each different n-gram."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lo, hi = ngram_range
    row = np.repeat(np.arange(len(tokens)), pc.list_value_length(tokens).to_numpy())
    coded = tokens.flatten().dictionary_encode()
    words, word = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    names, gram, last = words, word, np.arange(len(word))  # last: a gram's last token
    for n in range(1, hi + 1):
        if n > 1:
            longer = np.flatnonzero(last + 1 < len(word))
            longer = longer[row[last[longer] + 1] == row[last[longer]]]
            last = last[longer] + 1
            pairs = pa.array(gram[longer] * max(len(words), 1) + word[last]).dictionary_encode()
            gram, pair = pairs.indices.to_numpy().astype(np.int64), pairs.dictionary.to_numpy()
            names = pc.binary_join_element_wise(names.take(pa.array(pair // max(len(words), 1))), words.take(pa.array(pair % max(len(words), 1))), " ")
        if n >= lo and len(gram):
            key, count = np.unique(gram * len(tokens) + row[last], return_counts=True)
            yield key % len(tokens), key // len(tokens), count, names


def _lists_task(ngram_range: tuple):
    def run(batches):
        import pyarrow as pa

        for ids, tokens in _token_slices(batches):
            for row, gram, count, names in _gram_counts(tokens, ngram_range):
                by = np.argsort(row, kind="stable")
                held, first = np.unique(row[by], return_index=True)
                ends = pa.array(np.append(first, len(by)).astype(np.int32))
                columns = [ids.take(pa.array(held)), pa.ListArray.from_arrays(ends, names.take(pa.array(gram[by])).cast(pa.string())),
                           pa.ListArray.from_arrays(ends, pa.array(count[by].astype(np.int64)))]
                yield pa.RecordBatch.from_arrays(columns, names=["movieId", "terms", "tfs"])

    return run


def _terms_task(ngram_range: tuple):
    def run(batches):
        import pyarrow as pa

        for ids, tokens in _token_slices(batches):
            for row, gram, count, names in _gram_counts(tokens, ngram_range):
                columns = [ids.take(pa.array(row)), names.take(pa.array(gram)).cast(pa.string()), pa.array(count.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["movieId", "term", "tf"])

    return run


def _postings_task(ngram_range: tuple):
    def run(batches):
        import pyarrow as pa

        for ids, tokens in _token_slices(batches):
            for row, gram, count, names in _gram_counts(tokens, ngram_range):
                held, first = np.unique(gram, return_index=True)
                ends = pa.array(np.append(first, len(gram)).astype(np.int32))
                columns = [names.take(pa.array(held)).cast(pa.string()), pa.ListArray.from_arrays(ends, ids.take(pa.array(row))),
                           pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays(columns, names=["term", "ids", "tfs"])

    return run


def _single_and_repeated(movies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tokenized rows ``(movieId, _tok)`` whose movieId stands in one row, and
    the others (a null movieId is a value). The tokens are a column of their
    own, so a text is tokenized once."""
    spark = movies.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    texts = movies.select("movieId", "movie_text")
    several = texts.groupBy("movieId").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    several = several.select(F.col("movieId").alias("_id")).checkpoint(eager=True)
    several = broadcast_if_small(several, several.count(), ID_ROW_BYTES)
    same = F.col("movieId").eqNullSafe(F.col("_id"))
    single, repeated = texts.join(several, same, "left_anti"), texts.join(several, same, "left_semi")
    tokenized = [x.select("movieId", text.tokens("movie_text").alias("_tok")) for x in (single, repeated)]
    return tuple(x.select("movieId", F.array_join("_tok", " ").alias("_tok")) for x in tokenized)


def _merged(repeated: DataFrame, kind: str, ngram_range: tuple) -> DataFrame:
    """``(movieId, term, tf)`` of movies with several texts."""
    counted = repeated.mapInArrow(_terms_task(ngram_range), f"movieId {kind}, term string, tf long")
    return counted.groupBy("movieId", "term").agg(F.sum("tf").alias("tf"))


def doc_terms(movies: DataFrame, params: TfidfParams = TfidfParams(), lists: bool = False) -> DataFrame:
    """F2 + F3 + raw tf: ``(movieId, term, tf)``. With ``lists`` rows are
    ``(movieId, terms, tfs)``: a movie's terms in any number of rows, each term
    in one of them."""
    single, repeated = _single_and_repeated(movies)
    kind = movies.schema["movieId"].dataType.simpleString()
    counted = single.mapInArrow(_lists_task(params.ngram_range), f"movieId {kind}, terms array<string>, tfs array<long>")
    rest = _merged(repeated, kind, params.ngram_range)
    if lists:
        return counted.unionByName(rest.select("movieId", F.array("term").alias("terms"), F.array("tf").alias("tfs")))
    each = counted.select("movieId", F.explode(F.arrays_zip("terms", "tfs")).alias("_e"))
    return each.select("movieId", F.col("_e.terms").alias("term"), F.col("_e.tfs").alias("tf")).unionByName(rest)


def postings(movies: DataFrame, params: TfidfParams = TfidfParams()) -> DataFrame:
    """F2 + F3 + raw tf by term: ``(term, ids, tfs)``, the movies of a batch
    that hold the term (each movie in one row of a term) and its counts there."""
    single, repeated = _single_and_repeated(movies)
    kind = movies.schema["movieId"].dataType.simpleString()
    counted = single.mapInArrow(_postings_task(params.ngram_range), f"term string, ids array<{kind}>, tfs array<int>")
    rest = _merged(repeated, kind, params.ngram_range)
    return counted.unionByName(rest.select("term", F.array("movieId").alias("ids"), F.array(F.col("tf").cast("int")).alias("tfs")))


def document_frequencies(terms: DataFrame) -> DataFrame:
    """F4 (df): ``(term, df)``: number of documents holding the term, of
    :func:`doc_terms` or of :func:`postings`."""
    if "ids" in terms.columns:
        return terms.groupBy("term").agg(F.sum(F.size("ids")).alias("df"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def _bound(value, n_docs):
    """An int is a document count, a float a share of ``n_docs``."""
    if isinstance(value, Integral) and not isinstance(value, bool):
        return F.lit(int(value))
    return F.lit(float(value)) * n_docs


def vocabulary(terms: DataFrame, n_docs, params: TfidfParams = TfidfParams()) -> DataFrame:
    """F5 + F4 (idf): kept terms ``(term, df, idf)``.

    Kept: ``min_df <= df <= max_df``. Smooth idf is
    ``ln((1 + n) / (1 + df)) + 1``, plain idf ``ln(n / df) + 1``
    (Spark ML's IDF has no ``+ 1``, so it is not used).
    """
    dfs = document_frequencies(terms)
    df = F.col("df")
    kept = dfs.filter((df >= _bound(params.min_df, n_docs)) & (df <= _bound(params.max_df, n_docs)))
    if not params.use_idf:
        idf = F.lit(1.0)
    elif params.smooth_idf:
        idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + F.lit(1.0)
    else:
        idf = F.log(n_docs / df) + F.lit(1.0)
    return kept.select("term", "df", idf.alias("idf"))


def fit_vocabulary(movies: DataFrame, params: TfidfParams = TfidfParams()) -> DataFrame:
    """F2-F5 + F4 (idf): the kept terms of the movies' texts, checkpointed."""
    ensure_checkpoint_dir(movies.sparkSession)
    n_docs = movies.agg(F.count(F.lit(1)).cast("double")).scalar()
    return vocabulary(postings(movies, params), n_docs, params).checkpoint(eager=True)


def tfidf(movies: DataFrame, params: TfidfParams = TfidfParams(), vocab: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(weights[movieId, term, weight], vocab[term, df, idf])``.

    weight = tf' * idf, tf' = 1 + ln(tf) when sublinear, then each movie's
    row is divided by its L2 norm (l1: sum of absolute values); a row with
    no kept term has no entries, i.e. a zero vector. ``vocab`` is what
    :func:`fit_vocabulary` gave, when known.
    """
    # Texts are read twice, which costs less than writing all their terms.
    vocab = fit_vocabulary(movies, params) if vocab is None else vocab
    terms = postings(movies, params)
    tf = F.col("tf").cast("double")
    tfw = (F.lit(1.0) + F.log(tf)) if params.sublinear_tf else tf
    kept = broadcast_if_small(vocab.select("term", "idf"), vocab.count(), TERM_ROW_BYTES)
    # Written once, as lists by term: the norms and the weights read it.
    held = stored(terms.join(kept, "term"))
    raw = held.select("term", "idf", F.explode(F.arrays_zip("ids", "tfs")).alias("_e")).select(
        F.col("_e.ids").alias("movieId"), "term", F.col("_e.tfs").alias("tf"), "idf"
    ).select("movieId", "term", (tfw * F.col("idf")).alias("weight"))
    if params.norm is None:
        return raw, vocab
    if params.norm == "l2":
        norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")))
    elif params.norm == "l1":
        norm = F.sum(F.abs("weight"))
    else:
        raise ValueError(f"unknown norm {params.norm!r}")
    norms = raw.groupBy("movieId").agg(norm.alias("_norm")).withColumnRenamed("movieId", "_id").checkpoint(eager=True)
    norms = broadcast_if_small(norms, norms.count(), ID_ROW_BYTES, ID_SET_LIMIT_BYTES)
    weights = raw.join(norms, F.col("movieId").eqNullSafe(F.col("_id"))).select(
        "movieId",
        "term",
        F.when(F.col("_norm") > 0, F.col("weight") / F.col("_norm")).otherwise(F.lit(0.0)).alias("weight"),
    )
    return weights, vocab
