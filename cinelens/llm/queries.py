"""Registered queries of the operators over the driver's tables.

``QUERIES[name](spark, sf_dir)`` applies an operator with production
parameters to its whole table. ``ORACLE`` holds DuckDB SQL where SQL can
express the operator; the others are tested against brute force in
``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cinelens.llm import bestfit, bisector, importance, jaccard, langid, linededup, mixing, packing, quality, tokens, topk, toxicity, vptree
from cinelens.llm.common import fold, table

QUERIES: dict = {}
ORACLE: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def classified(scored):
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).select("doc_id", "held_out", "score", "predicted")


@query
def op1_language_id(spark, sf_dir):
    """``lang_pred`` of every document; learned outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    dictionaries = langid.learn(docs.filter(fold("doc_id", 5) != 0).select("text", "lang"))
    out = langid.identify(docs, dictionaries)
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(True))
    return out.select("doc_id", held.alias("held_out"), F.col("lang_best").alias("lang_pred"), "score", "margin", (F.col("lang") == langid.UND).alias("rejected"))


@query
def op2_source_mix(spark, sf_dir):
    """The mix of all documents by source, in training order."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    first = mixed.withColumn("position", F.round(F.array_min(F.transform("copies", lambda c: c["position"])), 6))
    return mixing.in_order(first).select("doc_id", "size", "source_size", "target", "taken", "position")


ORACLE["op2_source_mix"] = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS ticket
  FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1]::DOUBLE AS weight FROM s),
l AS (
  SELECT *, (3 * source_size) / weight AS ratio,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, weight, CAST(source_size AS BIGINT) AS source_size,
    least(3.0::DOUBLE * source_size, weight * coalesce((SELECT max(level) FROM l WHERE ratio = (SELECT min(ratio) FROM l WHERE ratio > level)), 0)) AS target
  FROM l),
c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.weight,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ticket, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (
  SELECT *, greatest(0, least(size, floor(target) - ahead)) + greatest(0, least(size, floor(target) - ahead - source_size))
          + greatest(0, least(size, floor(target) - ahead - 2 * source_size)) AS taken, ahead / target AS share FROM c)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(taken AS BIGINT) AS taken,
  CASE WHEN taken > 0 THEN round(CASE weight
    WHEN 5 THEN 2 * share / (1.5 + sqrt(2.25 - 2 * share))
    WHEN 2 THEN share
    ELSE 2 * share / (0.5 + sqrt(0.25 + 2 * share)) END, 6) END AS position
FROM k
"""


@query
def op3_token_counts(spark, sf_dir):
    """Tokens of every document by page of 1,000 characters; a token that
    crosses a page's end counts where it begins."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", tokens.pages(F.col("text"), 1000).alias("sections"))
    out = tokens.section_counts(docs, "first")
    return out.select("doc_id", F.col("section").alias("page"), F.col("start").alias("char_start"), F.col("end").alias("char_end"),
                      F.col("tokens").cast("long").alias("n_tokens"), "doc_tokens")


@query
def op4_ngram_jaccard(spark, sf_dir):
    """Components, classes and link counts of near copies among all documents
    (4 words, 0.85)."""
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


ORACLE["op4_ngram_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM w),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT c.a, c.b, c.n = x.n AND c.n = y.n AS same FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
reach AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
classes AS (SELECT d.doc_id, least(d.doc_id, coalesce(min(l.b), d.doc_id)) AS class_id FROM documents d LEFT JOIN links l ON l.a = d.doc_id AND l.same GROUP BY d.doc_id),
counts AS (SELECT l.a, count(DISTINCT c.class_id) AS n FROM links l JOIN classes c ON c.doc_id = l.b WHERE NOT l.same GROUP BY l.a)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, r.component_id, c.class_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links
FROM sizes s JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) r ON r.node = s.doc_id
JOIN classes c ON c.doc_id = s.doc_id LEFT JOIN counts k ON k.a = s.doc_id
"""


@query
def op5_quality(spark, sf_dir):
    """Quality score of every document; learned outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs.filter(fold("doc_id", 3) != 1), table(spark, sf_dir, "labels"))
    held = F.coalesce(fold("doc_id", 3) == 1, F.lit(True))
    return classified(quality.score(docs, model).withColumn("held_out", held))


@query
def op6_line_dedup(spark, sf_dir):
    """Every line of all documents: whether it is kept, and its keeper."""
    return linededup.lines(table(spark, sf_dir, "documents")).select("doc_id", "line_no", "kept", "keeper_doc_id", "keeper_line_no")


@query
def op7_packing(spark, sf_dir):
    """Token sequences of all documents, one row for each piece."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_topk(spark, sf_dir):
    """The 20 best inner products of every 20th vector, exactly."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE["op8_topk"] = """
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op9_vptree(spark, sf_dir):
    """The 10 nearest vectors found for every 100th vector."""
    return vptree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op10_toxicity(spark, sf_dir):
    """Toxicity score of every document; learned outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs.filter(fold("doc_id", 5) != 0), table(spark, sf_dir, "labels"))
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(True))
    return classified(toxicity.score(docs, model).withColumn("held_out", held))


@query
def op11_importance(spark, sf_dir):
    """Every document's weight towards the benchmark texts, its noisy score,
    and its rank if drawn."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op11_importance"] = r"""
WITH tab AS (
  SELECT list(x ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS x FROM range(256) r(b))),
texts AS (
  SELECT 'd' AS side, doc_id, text, row_number() OVER () AS rid FROM documents
  UNION ALL SELECT 'b', NULL, text, NULL FROM benchmark),
grams AS (
  SELECT side, doc_id, rid, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM texts),
bytes AS (
  SELECT word, [CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT) FOR i IN range(1, len(h) // 2 + 1)] AS b
  FROM (SELECT DISTINCT word, hex(encode(word)) AS h FROM grams)),
buckets AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, tab),
counts AS (
  SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 'b') AS t
  FROM grams JOIN buckets USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain FROM counts),
weights AS (
  SELECT rid, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM grams JOIN buckets USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY rid),
scored AS (
  SELECT x.doc_id, x.rid, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || x.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM texts x LEFT JOIN weights USING (rid) WHERE x.side = 'd'),
ranked AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20 AND doc_id IS NOT NULL)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, CAST(score AS BIGINT) AS score, CASE WHEN place <= 10 * n // 100 THEN CAST(place AS BIGINT) END AS rank
FROM scored LEFT JOIN ranked USING (rid)
"""


@query
def op12_best_fit(spark, sf_dir):
    """Token sequences of all documents by best fit, one row for each piece."""
    return bestfit.pack(table(spark, sf_dir, "documents"))


@query
def op13_centroids(spark, sf_dir):
    """Every usable vector's cluster after 5 rounds with 40 centroids."""
    return bisector.cluster(table(spark, sf_dir, "embeddings"))


def _rounds_sql(rounds: int, k: int) -> str:
    """Exact integer rounds of assignment and floored means, as plain SQL."""
    nearest = """a{r} AS (
  SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT rid, c, list_sum(list_transform(list_zip(vs.v, c{r}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM vs, c{r}) GROUP BY rid)"""
    means = """m{r} AS (
  SELECT c, list((s - (s % n + n) % n) // n ORDER BY i) AS v FROM (
    SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
      SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r} JOIN vs USING (rid)) GROUP BY c, i) GROUP BY c),
c{next} AS (SELECT c{r}.c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} ON m{r}.c = c{r}.c)"""
    steps = [f"{nearest.format(r=r)},\n{means.format(r=r, next=r + 1)}" for r in range(rounds)]
    return f"""
WITH vs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = 64
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
    SELECT sha256('2:' || vec_id) AS h, v FROM vs ORDER BY h, v LIMIT {k})),
{", ".join(steps)},
{nearest.format(r=rounds)}
SELECT vec_id, CAST(a.c AS INT) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(z.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN vs USING (rid) JOIN c{rounds} z ON z.c = a.c
"""


ORACLE["op13_centroids"] = _rounds_sql(5, 40)
