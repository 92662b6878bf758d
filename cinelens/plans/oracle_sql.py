"""DuckDB SQL for the oracle check of every named query.

Each query text is ``WITH <views>, <stages...> SELECT ...``: the test-table
mapping, then the pipeline stages written independently of the Spark code
(sparse TF-IDF with joins, where Spark uses dense vectors and a blocked
kernel). Doubles are rounded to 6 digits and whole numbers are BIGINT in
both engines, so results compare by value.
"""

from __future__ import annotations

from cinelens.sources.testdata import VIEWS_SQL

# Preparation: P1, A1, A2, N1, P2, N2, A3, N3, A4, F1.
PREP = r"""
no_genre AS (SELECT * FROM movies WHERE genres <> '(no genres listed)'),
rating_counts AS (SELECT movieId, count(*) AS rating_count FROM ratings GROUP BY movieId),
counted AS (
  SELECT m.movieId, m.title, m.genres, coalesce(rc.rating_count, 0) AS rating_count
  FROM no_genre m LEFT JOIN rating_counts rc ON m.movieId = rc.movieId),
pick_id AS (
  SELECT title, movieId FROM (
    SELECT title, movieId,
           row_number() OVER (PARTITION BY title ORDER BY rating_count DESC, movieId) AS rn
    FROM counted) WHERE rn = 1),
pick_genres AS (
  SELECT title, genres FROM (
    SELECT title, genres,
           row_number() OVER (PARTITION BY title ORDER BY length(genres) DESC, movieId) AS rn
    FROM counted) WHERE rn = 1),
merged AS (SELECT i.title, i.movieId, g.genres FROM pick_id i JOIN pick_genres g ON i.title = g.title),
movies_prep AS (
  SELECT title, movieId,
         regexp_replace(regexp_replace(lower(CAST(genres AS VARCHAR)), '\s*\|\s*', ' ', 'g'),
                        '^\s+|\s+$', '', 'g') AS genres
  FROM merged),
tags_valid AS (SELECT * FROM tags WHERE movieId IN (SELECT movieId FROM merged)),
tags_clean AS (
  SELECT userId, movieId,
         replace(regexp_replace(regexp_replace(regexp_replace(lower(CAST(tag AS VARCHAR)),
                 '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g'), '[^a-z0-9 ]', '', 'g'), ' ', '_') AS tag,
         timestamp
  FROM tags_valid),
tags_prep AS (
  SELECT movieId, array_to_string(list_sort(list_distinct(list(tag))), ' ') AS tag
  FROM tags_clean GROUP BY movieId),
ratings_valid AS (SELECT * FROM ratings WHERE movieId IN (SELECT movieId FROM merged)),
ratings_prep AS (
  SELECT userId, movieId, rating, make_timestamp(timestamp * 1000000) AS timestamp,
         timestamp = max(timestamp) OVER (PARTITION BY userId) AS is_last_rating
  FROM ratings_valid),
featurized AS (
  SELECT m.title, m.movieId, m.genres, t.tag,
         array_to_string(list_sort(list_distinct(string_split(
           regexp_replace(regexp_replace(m.genres || ' ' || coalesce(t.tag, ''), '\s+', ' ', 'g'),
                          '^\s+|\s+$', '', 'g'), ' '))), ' ') AS movie_text
  FROM movies_prep m LEFT JOIN tags_prep t ON m.movieId = t.movieId)
"""

# TF-IDF: F2-F6 as a sparse long table.
TFIDF = r"""
toks AS (SELECT movieId, regexp_extract_all(lower(movie_text), '[\p{L}\p{N}_]{2,}') AS t FROM featurized),
grams AS (
  SELECT movieId,
         list_concat(t, CASE WHEN len(t) >= 2
                             THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])
                             ELSE CAST([] AS VARCHAR[]) END) AS g
  FROM toks),
doc_terms AS (
  SELECT movieId, term, count(*) AS tf FROM (SELECT movieId, unnest(g) AS term FROM grams)
  GROUP BY movieId, term),
n_docs AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM featurized),
dfs AS (SELECT term, count(*) AS df FROM doc_terms GROUP BY term),
vocab AS (
  SELECT term, df, ln((1 + (SELECT n FROM n_docs)) / (1 + df)) + 1 AS idf
  FROM dfs WHERE df >= 1 AND df <= 0.95 * (SELECT n FROM n_docs)),
raw_w AS (
  SELECT d.movieId, d.term, (1 + ln(d.tf)) * v.idf AS w
  FROM doc_terms d JOIN vocab v ON d.term = v.term),
weights AS (
  SELECT movieId, term,
         CASE WHEN sum(w * w) OVER (PARTITION BY movieId) > 0
              THEN w / sqrt(sum(w * w) OVER (PARTITION BY movieId)) ELSE 0.0 END AS weight
  FROM raw_w),
item_norm AS (
  SELECT f.movieId, coalesce(sqrt(sum(w.weight * w.weight)), 0.0) AS inorm
  FROM featurized f LEFT JOIN weights w ON f.movieId = w.movieId GROUP BY f.movieId)
"""

# Profiles (R1) and exact cosine scores of every warm user with every item.
SCORES = r"""
liked_known AS (
  SELECT userId, movieId, rating FROM ratings_prep
  WHERE rating >= 4.0 AND movieId IN (SELECT movieId FROM featurized)),
wsum AS (SELECT userId, sum(rating) AS ws FROM liked_known GROUP BY userId),
prof AS (
  SELECT l.userId, w.term, sum(l.rating * w.weight) / max(s.ws) AS pw
  FROM liked_known l JOIN weights w ON l.movieId = w.movieId JOIN wsum s ON s.userId = l.userId
  GROUP BY l.userId, w.term),
prof_norm AS (SELECT userId, sqrt(sum(pw * pw)) AS pn FROM prof GROUP BY userId),
dots AS (
  SELECT p.userId, w.movieId, sum(p.pw * w.weight) AS dot
  FROM prof p JOIN weights w ON p.term = w.term GROUP BY p.userId, w.movieId),
scores AS (
  SELECT u.userId, i.movieId,
         CASE WHEN coalesce(pn.pn, 0) > 0 AND i.inorm > 0
              THEN coalesce(d.dot, 0.0) / (pn.pn * i.inorm) ELSE 0.0 END AS similarity
  FROM wsum u CROSS JOIN item_norm i
  LEFT JOIN prof_norm pn ON pn.userId = u.userId
  LEFT JOIN dots d ON d.userId = u.userId AND d.movieId = i.movieId),
seen AS (SELECT DISTINCT userId, movieId FROM ratings_prep),
ranked_all AS (
  SELECT s.userId, s.movieId, s.similarity,
         row_number() OVER (PARTITION BY s.userId ORDER BY round(s.similarity, 9) DESC, s.movieId) AS rank
  FROM scores s
  WHERE NOT EXISTS (SELECT 1 FROM seen x WHERE x.userId = s.userId AND x.movieId = s.movieId)),
centroid AS (
  SELECT term, sum(weight) / (SELECT count(*) FROM featurized) AS c FROM weights GROUP BY term),
cnorm AS (SELECT sqrt(sum(c * c)) AS cn FROM centroid),
pop AS (
  SELECT movieId, similarity,
         row_number() OVER (ORDER BY round(similarity, 9) DESC, movieId) AS pop_rank
  FROM (
    SELECT i.movieId,
           CASE WHEN (SELECT cn FROM cnorm) > 0 AND i.inorm > 0
                THEN coalesce(d.dot, 0.0) / ((SELECT cn FROM cnorm) * i.inorm) ELSE 0.0 END AS similarity
    FROM item_norm i LEFT JOIN (
      SELECT w.movieId, sum(c.c * w.weight) AS dot
      FROM centroid c JOIN weights w ON c.term = w.term GROUP BY w.movieId) d
    ON d.movieId = i.movieId))
"""


def recommend_sql(n: str = "10", users: str = "SELECT DISTINCT userId FROM ratings",
                  seen: str = "seen", meta: str = "featurized", dedupe: bool = False) -> str:
    """R2 + R3 + R7 + J4 for ``users``; ``n`` is SQL text (a number or a
    scalar subquery)."""
    return rf"""
users AS ({users}),
top AS (
  SELECT r.userId, r.rank, r.movieId, r.similarity, 'profile' AS source
  FROM ranked_all r WHERE r.rank <= {n} AND r.userId IN (SELECT userId FROM users)),
lens AS (
  SELECT u.userId, coalesce(c.L, 0) AS L
  FROM wsum u JOIN users us ON us.userId = u.userId
  LEFT JOIN (SELECT userId, count(*) AS L FROM top GROUP BY userId) c ON c.userId = u.userId),
fill AS (
  SELECT l.userId, l.L, p.movieId FROM lens l JOIN pop p ON p.pop_rank <= {n} - l.L
  WHERE l.L < {n}
    AND NOT EXISTS (SELECT 1 FROM {seen} x WHERE x.userId = l.userId AND x.movieId = p.movieId)
    {"AND NOT EXISTS (SELECT 1 FROM top t WHERE t.userId = l.userId AND t.movieId = p.movieId)" if dedupe else ""}),
topped AS (
  SELECT userId, L + row_number() OVER (PARTITION BY userId ORDER BY movieId) AS rank, movieId,
         0.0 AS similarity, 'top_up' AS source
  FROM fill),
pop_top AS (
  SELECT movieId, row_number() OVER (ORDER BY movieId) AS cat_rank FROM pop WHERE pop_rank <= {n}),
cold AS (
  SELECT u.userId, p.cat_rank AS rank, p.movieId, 0.0 AS similarity, 'popular' AS source
  FROM users u CROSS JOIN pop_top p WHERE u.userId NOT IN (SELECT userId FROM wsum)),
recs AS (SELECT * FROM top UNION ALL SELECT * FROM topped UNION ALL SELECT * FROM cold)
SELECT r.userId, CAST(r.rank AS BIGINT) AS rank, r.movieId, f.title, f.genres,
       round(r.similarity, 6) AS similarity, r.source
FROM recs r LEFT JOIN {meta} f ON f.movieId = r.movieId
"""


def with_stages(*stages: str) -> str:
    return "WITH " + ",\n".join(s.strip().rstrip(",") for s in (VIEWS_SQL, *stages))


# Leave-one-out evaluation E1-E8 (seed 42, threshold 4.0, min 5 liked,
# 300 users, k 10), exact sparse scoring.
EVAL = r"""
elig AS (SELECT userId, count(*) AS n_liked FROM ratings_prep WHERE rating >= 4.0 GROUP BY userId HAVING count(*) >= 5),
sampled AS (SELECT userId FROM elig ORDER BY md5('42:' || CAST(userId AS VARCHAR)), userId LIMIT 300),
lrows AS (
  SELECT userId, movieId, rating, CAST(epoch(timestamp) AS BIGINT) AS ep, count(*) AS copies
  FROM ratings_prep WHERE rating >= 4.0 AND userId IN (SELECT userId FROM sampled)
  GROUP BY userId, movieId, rating, ep),
lrows_h AS (
  SELECT *, md5('42:' || CAST(userId AS VARCHAR) || ':' || CAST(movieId AS VARCHAR) || ':' || CAST(ep AS VARCHAR)
                || ':' || printf('%.6f', rating)) AS h
  FROM lrows),
held AS (
  SELECT userId, movieId AS held_movieId, rating AS held_rating, ep AS held_epoch FROM (
    SELECT *, row_number() OVER (PARTITION BY userId ORDER BY h) AS rn FROM lrows_h) WHERE rn = 1),
remaining AS (
  SELECT l.userId, l.movieId, l.rating, l.ep,
         l.copies - CASE WHEN l.movieId = h.held_movieId AND l.rating = h.held_rating AND l.ep = h.held_epoch
                         THEN 1 ELSE 0 END AS n
  FROM lrows l JOIN held h ON h.userId = l.userId),
last_r AS (
  SELECT userId, movieId, rating AS last_rating FROM (
    SELECT *, row_number() OVER (PARTITION BY userId, movieId ORDER BY ep DESC, rating DESC) AS rn
    FROM remaining WHERE n > 0)
  WHERE rn = 1),
train AS (
  SELECT r.userId, r.movieId, r.n * lr.last_rating AS w
  FROM (SELECT userId, movieId, sum(n) AS n FROM remaining WHERE n > 0 GROUP BY userId, movieId) r
  JOIN last_r lr ON lr.userId = r.userId AND lr.movieId = r.movieId
  WHERE r.movieId IN (SELECT movieId FROM featurized)),
twsum AS (SELECT userId, sum(w) AS ws FROM train GROUP BY userId),
tprof AS (
  SELECT t.userId, wt.term, sum(t.w * wt.weight) / max(s.ws) AS pw
  FROM train t JOIN weights wt ON t.movieId = wt.movieId JOIN twsum s ON s.userId = t.userId
  GROUP BY t.userId, wt.term),
tnorm AS (SELECT userId, sqrt(sum(pw * pw)) AS pn FROM tprof GROUP BY userId),
tdots AS (
  SELECT p.userId, w.movieId, sum(p.pw * w.weight) AS dot
  FROM tprof p JOIN weights w ON p.term = w.term GROUP BY p.userId, w.movieId),
tscores AS (
  SELECT u.userId, i.movieId,
         CASE WHEN coalesce(pn.pn, 0) > 0 AND i.inorm > 0
              THEN coalesce(d.dot, 0.0) / (pn.pn * i.inorm) ELSE 0.0 END AS similarity
  FROM twsum u CROSS JOIN item_norm i
  LEFT JOIN tnorm pn ON pn.userId = u.userId
  LEFT JOIN tdots d ON d.userId = u.userId AND d.movieId = i.movieId),
eseen AS (SELECT DISTINCT userId, movieId FROM ratings_prep WHERE userId IN (SELECT userId FROM twsum)),
elists AS (
  SELECT * FROM (
    SELECT s.userId, s.movieId, s.similarity,
           row_number() OVER (PARTITION BY s.userId ORDER BY round(s.similarity, 9) DESC, s.movieId) AS rank
    FROM tscores s
    WHERE NOT EXISTS (SELECT 1 FROM eseen x WHERE x.userId = s.userId AND x.movieId = s.movieId))
  WHERE rank <= 10),
ulists AS (
  SELECT * FROM (
    SELECT s.userId, s.movieId,
           row_number() OVER (PARTITION BY s.userId ORDER BY round(s.similarity, 9) DESC, s.movieId) AS rank
    FROM tscores s JOIN held h ON h.userId = s.userId
    WHERE s.movieId = h.held_movieId
       OR NOT EXISTS (SELECT 1 FROM eseen x WHERE x.userId = s.userId AND x.movieId = s.movieId))
  WHERE rank <= 10),
eval_users AS (
  SELECT u.userId,
         CASE WHEN EXISTS (SELECT 1 FROM elists e JOIN held h ON h.userId = e.userId
                           WHERE e.userId = u.userId AND e.movieId = h.held_movieId) THEN 1 ELSE 0 END AS hit,
         CASE WHEN EXISTS (SELECT 1 FROM ulists e JOIN held h ON h.userId = e.userId
                           WHERE e.userId = u.userId AND e.movieId = h.held_movieId) THEN 1 ELSE 0 END AS hit_u
  FROM twsum u),
eval_result AS (
  SELECT CASE WHEN count(*) > 0 THEN sum(hit) / count(*) ELSE 0.0 END AS hit_rate_at_k,
         count(*) AS n_users, CAST(10 AS BIGINT) AS k,
         (SELECT CASE WHEN count(*) > 0 THEN count(DISTINCT movieId) / count(*) ELSE 0.0 END FROM elists)
           AS coverage_at_k,
         list_sort(list(userId)) AS users_evaluated,
         CASE WHEN count(*) > 0 THEN sum(hit_u) / count(*) ELSE 0.0 END AS hit_rate_at_k_unmasked
  FROM eval_users)
"""
