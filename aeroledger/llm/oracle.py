"""DuckDB SQL for the queries whose results SQL can express, stated without their methods."""

from __future__ import annotations

#: Shrinkage as in the model; a host passes if its good rate is below one half with a chance of at most 5 %, integrated on the logit scale.
URL_REPUTATION = r"""
WITH parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
shown AS (
  SELECT page_id, try_cast(regexp_extract(path, '/(\d{1,18})(?:\.html|/)?$', 1) AS BIGINT) AS doc_id FROM parsed),
outcomes AS (
  SELECT page_id, count(good) AS n, coalesce(sum(good), 0) AS good
  FROM (SELECT page_id, CAST(quality = 1 AND toxic = 0 AS INTEGER) AS good FROM shown JOIN labels USING (doc_id)) GROUP BY page_id),
hosts AS (
  SELECT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix,
         CAST(coalesce(sum(n), 0) AS DOUBLE) AS n, CAST(coalesce(sum(good), 0) AS DOUBLE) AS good
  FROM parsed LEFT JOIN outcomes USING (page_id) GROUP BY host),
total AS (SELECT (sum(good) + 1) / (sum(n) + 2) AS m FROM hosts),
suffixes AS (SELECT suffix, sum(n) AS n, sum(good) AS good, any_value(m) AS m FROM hosts, total GROUP BY suffix),
suffix_strength AS (
  SELECT 1 / least(greatest(coalesce((sum((good - n * m) ** 2) - sum(n * m * (1 - m))) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.1),
                            1e-4), 0.5) - 1 AS k FROM suffixes),
domains AS (
  SELECT domain, sum(h.n) AS n, sum(h.good) AS good, any_value((k * s.m + s.good) / (k + s.n)) AS m
  FROM hosts h JOIN suffixes s USING (suffix), suffix_strength GROUP BY domain),
domain_strength AS (
  SELECT 1 / least(greatest(coalesce((sum((good - n * m) ** 2) - sum(n * m * (1 - m))) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.1),
                            1e-4), 0.5) - 1 AS k FROM domains),
priors AS (
  SELECT host, h.n, h.good, (k * d.m + d.good) / (k + d.n) AS m FROM hosts h JOIN domains d USING (domain), domain_strength),
host_strength AS (
  SELECT 1 / least(greatest(coalesce((sum((good - n * m) ** 2) - sum(n * m * (1 - m))) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.1),
                            1e-4), 0.5) - 1 AS k FROM priors),
posterior AS (SELECT host, k * m + good AS a, k * (1 - m) + n - good AS b FROM priors, host_strength),
density AS (
  SELECT host, u, a * u - (a + b) * ln(1 + exp(u)) - (a * ln(a / b) - (a + b) * ln(1 + a / b)) AS log_density
  FROM (SELECT host, a, b, ln(a / b) + sqrt(1 / a + 1 / b + 1 / (a * a) + 1 / (b * b)) * (i - 4000) / 4000.0 * 12 AS u
        FROM posterior, range(8001) t(i))),
judged AS (SELECT host, sum(CASE WHEN u < 0 THEN exp(log_density) ELSE 0 END) / sum(exp(log_density)) <= 0.05 AS good_enough
           FROM density GROUP BY host),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM parsed)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN good_enough THEN 'allow' ELSE 'block' END AS verdict
FROM ruled JOIN judged USING (host)"""

LATTICE_DEDUP = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS row, vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ok AS (
  SELECT row, vec_id, label, x FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(x) > 0
    AND len(list_filter(x, lambda y: y IS NULL OR isnan(y) OR isinf(y))) = 0 AND len(list_filter(x, lambda y: y <> 0)) > 0),
links AS (
  SELECT a.row AS a, b.row AS b, b.vec_id FROM ok a JOIN ok b ON a.label = b.label AND a.row <> b.row AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
reached AS (
  SELECT row AS a, row AS b FROM v WHERE row IN (SELECT a FROM links)
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
smallest AS (SELECT r.a AS row, min(v.vec_id) AS component_id FROM reached r JOIN v ON v.row = r.b GROUP BY r.a)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.row) AS n_links,
  coalesce(s.component_id, v.vec_id) AS component_id, v.vec_id = coalesce(s.component_id, v.vec_id) AS kept
FROM v LEFT JOIN smallest s USING (row)"""

#: Texts as hexadecimal digits, so that places are bytes.
SUFFIX_DEDUP = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS MATERIALIZED (
  SELECT row, i, hash(substr(h, CAST(2 * i + 1 AS BIGINT), 400)) AS s
  FROM (SELECT row, h, unnest(range(len(h) // 2 - 199)) AS i FROM d WHERE len(h) >= 400)),
again AS (SELECT row, i FROM strings WHERE s IN (SELECT s FROM strings GROUP BY s HAVING count(*) > 1)),
marked AS (SELECT row, i, coalesce(i > lag(i) OVER (PARTITION BY row ORDER BY i) + 200, TRUE) AS fresh FROM again),
numbered AS (SELECT row, i, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY row ORDER BY i) AS run FROM marked),
runs AS MATERIALIZED (SELECT row, min(i) AS lo, max(i) + 200 AS hi FROM numbered GROUP BY row, run),
kept AS (
  SELECT row, lo, coalesce(lag(hi) OVER (PARTITION BY row ORDER BY lo), 0) AS start, hi FROM runs
  UNION ALL SELECT d.row, len(h) // 2, coalesce(max(hi), 0), NULL FROM d LEFT JOIN runs USING (row) GROUP BY d.row, h),
texts AS (
  SELECT row, string_agg(substr(h, CAST(2 * start + 1 AS BIGINT), CAST(2 * (lo - start) AS BIGINT)), '' ORDER BY lo, start) AS h
  FROM kept JOIN d USING (row) GROUP BY row)
SELECT doc_id, len(d.h) // 2 AS n_bytes, (len(d.h) - len(t.h)) // 2 AS n_removed,
  (SELECT count(*) FROM runs r WHERE r.row = d.row) AS n_spans, sha256(unhex(t.h)) AS kept_sha256
FROM d JOIN texts t USING (row)"""

LINE_DEDUP = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT row, i, lines[i] AS line, translate(trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT row, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
shared AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row) >= 10),
marked AS (SELECT row, i, line, key IN (SELECT key FROM shared) AS gone FROM l)
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked JOIN d USING (row) GROUP BY row, doc_id"""


def centroid_clusters(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """Lloyd's rounds, one pair of statements after another, with every distance computed."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT row, any_value(v.x) AS x, any_value(vec_id) AS vec_id, min({{'d': list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'c': c.c}}) AS best
  FROM v, c{r} c GROUP BY row)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(any_value(n.x), any_value(c.x)) AS x FROM c{r} c LEFT JOIN (
    SELECT c, list(floor(s / n)::BIGINT ORDER BY i) AS x FROM (
      SELECT best.c AS c, i, sum(x[i])::DOUBLE AS s, count(*) AS n FROM a{r}, range(1, {dims} + 1) t(i) GROUP BY best.c, i) GROUP BY c) n
  ON n.c = c.c GROUP BY c.c)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor({scale} * x)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda y: y IS NULL OR isnan(y) OR isinf(y))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), x) - 1 AS c, x FROM v ORDER BY sha256('{seed}:' || vec_id), x LIMIT {k}),
{",".join(steps).strip()},
digests AS (SELECT c, sha256(array_to_string(x, ',')) AS centroid_sha256 FROM c{rounds})
SELECT vec_id, best.c::INTEGER AS cluster, best.d::BIGINT AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
  (sum(best.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN digests ON digests.c = best.c"""
