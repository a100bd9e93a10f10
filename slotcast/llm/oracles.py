"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, text,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source),
leveled AS (
  SELECT *, ((SELECT sum(source_size) FROM totals)
             - coalesce(sum(3 * source_size) OVER (filling ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (filling ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM totals WINDOW filling AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
fixed AS (SELECT max(level) FILTER (WHERE level * weight <= 3 * source_size) AS low, max(level) AS high FROM leveled),
targets AS (
  SELECT source, source_size,
         least(coalesce(low, high) * weight, 3.0 * source_size)::DOUBLE AS target
  FROM leveled, fixed),
planned AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('17|' || coalesce(s.doc_id::VARCHAR, '~') || '|' || md5(coalesce(s.text, ''))
           || '|' || row_number() OVER (PARTITION BY s.doc_id, coalesce(s.text, ''))), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + (u < rate - floor(rate))::BIGINT))::BIGINT AS taken
FROM planned
"""

JACCARD = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '{WORD}') AS w
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM worded WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 90 * (x.n + y.n - common)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT DISTINCT a AS doc_id, a AS r FROM edges
  UNION SELECT e.b, reach.r FROM reach JOIN edges e ON e.a = reach.doc_id),
roots AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(r, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN roots ON roots.doc_id = d.doc_id
"""

SUBSTRINGS = rf"""
WITH worded AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM worded WHERE len(w) >= 35)),
hits AS (SELECT doc_id, i FROM windows WHERE s IN (SELECT s FROM windows GROUP BY s HAVING count(*) > 1)),
covered AS MATERIALIZED (SELECT DISTINCT doc_id, i + unnest(range(0, 35)) AS p FROM hits),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM worded),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM placed ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM worded d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

VECTORS = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
    AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT DISTINCT a AS vec_id, a AS r FROM links
  UNION SELECT links.b, reach.r FROM reach JOIN links ON links.a = reach.vec_id),
roots AS (SELECT vec_id, min(r) AS r FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(r, e.vec_id) AS component_id,
       coalesce(r, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN roots ON roots.vec_id = e.vec_id LEFT JOIN counts ON counts.vec_id = e.vec_id
"""

def centroids_sql(clusters: int = 8, rounds: int = 10) -> str:
    """Every round assigns all vectors to all centroids and takes exact floors of the means."""

    def assigned(r: int) -> str:
        return f"""
a{r} AS MATERIALIZED (
  SELECT n, vec_id, v, k, d FROM (
    SELECT x.n, x.vec_id, x.v, c.k, list_sum(list_transform(list_zip(x.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM kept x, c{r} c)
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, k) = 1)"""

    def centred(r: int) -> str:
        return f"""
c{r + 1} AS MATERIALIZED (
  SELECT o.k, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
      SELECT k, i, sum(x)::BIGINT AS s, count(*)::BIGINT AS n
      FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY k, i)
    GROUP BY k) m USING (k))"""

    steps = ["""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND list_count(embedding) = 64
    AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = 64)""", f"""
c0 AS MATERIALIZED (
  SELECT k - 1 AS k, v AS c FROM (
    SELECT v, row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, n) AS k FROM kept)
  WHERE k <= {clusters})"""]
    for r in range(rounds):
        steps += [assigned(r), centred(r)]
    steps.append(assigned(rounds))
    return f"""
WITH {",".join(steps)}
SELECT a.vec_id, a.k::INTEGER AS cluster, a.d AS distance,
       (sum(a.d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.k = c.k
"""


NEGATIVES = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = len(embedding)),
scored AS MATERIALIZED (
  SELECT a.n AS a, a.vec_id AS anchor_id, o.n, o.vec_id, a.label = o.label AS same,
         list_sum(list_transform(list_zip(a.v, o.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM kept a JOIN kept o ON a.n <> o.n AND a.vec_id % 100 = 0 AND len(a.v) = len(o.v)),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, n) <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, x.vec_id AS negative_id,
         p.score AS positive_score, x.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.n ORDER BY x.score DESC, x.vec_id, x.n) AS rank
  FROM positives p JOIN scored x ON p.a = x.a AND NOT x.same
   AND 80 * p.score <= 100 * x.score AND 100 * x.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5
"""

ORACLES: dict[str, str] = {
    "op4_jaccard_join": JACCARD,
    "op6_mixing": MIXING,
    "op7_substring_dedup": SUBSTRINGS,
    "op9_near_vectors": VECTORS,
    "op12_centroids": centroids_sql(),
    "op13_hard_negatives": NEGATIVES,
}
