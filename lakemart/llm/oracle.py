"""SQL that gives the same rows as the queries, where SQL can express them."""

SQL: dict[str, str] = {}

SQL["op7_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, text, md5('mix:' || doc_id) AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM w
  WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM l),
p AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
         least(CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END, 3)::BIGINT AS epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size::BIGINT AS size, source_size, target,
       size * epochs + CASE WHEN epochs < 3
         THEN greatest(least(round(target)::BIGINT - epochs * source_size - before, size), 0) ELSE 0 END AS taken
FROM p
"""

SQL["op5_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
g AS (
  SELECT doc_id, source, text, w,
         [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] AS grams,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
spots AS (SELECT doc_id, unnest(grams) AS gram, unnest(range(len(grams))) AS spot FROM g),
twice AS (SELECT doc_id, spot FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM spots) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT spot + k)::BIGINT AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (
  SELECT g.doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum([len(x) for x in w]), 0)::BIGINT AS word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM g LEFT JOIN covered ON g.doc_id = covered.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS docs, sum(base_failed::INT) AS failed FROM b GROUP BY source),
q AS (SELECT avg(failed / docs) AS m, var_pop(failed / docs) AS v FROM h),
r AS (
  SELECT source, CASE WHEN v > 0
    THEN (failed + m * greatest(m * (1 - m) / v - 1, 0)) / (docs + greatest(m * (1 - m) / v - 1, 0)) ELSE m END <= 0.5 AS ok
  FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept
FROM b JOIN r ON b.source IS NOT DISTINCT FROM r.source
"""

SQL["op8_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31) + 1, 1)
         for i in range(32)], 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

SQL["op9_ngram_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS grams
  FROM d),
s AS (SELECT doc_id, unnest(grams) AS gram FROM g),
n AS (SELECT doc_id, len(grams)::BIGINT AS n_shingles FROM g),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
      WHERE 100 * c >= 75 * (a.n_shingles + b.n_shingles - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x)
SELECT n.doc_id, n_shingles, min(b)::BIGINT AS component_id FROM n JOIN r ON n.doc_id = r.a GROUP BY ALL
"""

SQL["op12_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
e AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
         + 4 * (100 * len(regexp_extract_all(d.text, '[A-Z]')) > 5 * length(d.text))::INT
         + 8 * regexp_matches(d.text, '[#$%&*|]')::INT + 16 * coalesce(least < d.doc_id, false)::INT AS failed
  FROM d JOIN e ON d.text = e.text LEFT JOIN l ON d.doc_id = l.doc_id),
c AS (SELECT part, failed, good, toxic, count(*) AS n FROM m GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
t AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN failed & (own | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN failed & own <> 0 AND failed & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN failed & own <> 0 AND failed & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN failed = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN failed & own <> 0 AND failed & before = 0 THEN n * good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN failed & own <> 0 AND failed & before = 0 THEN n * toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c, steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM t
"""


def _centroid_sql(k: int = 8, rounds: int = 10) -> str:
    """Plain rounds of full scans, one pair of steps per round."""
    steps = [f"""WITH v AS (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, embedding) AS r, vec_id,
         [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS vec
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
u AS MATERIALIZED (SELECT r, unnest(vec) AS x, unnest(range(64)) AS i FROM v),
c0 AS (SELECT r - 1 AS c, i, x FROM u WHERE r <= {k})"""]
    for t in range(rounds + 1):
        steps.append(f"""d{t} AS (
  SELECT r, c, sum((u.x - c{t}.x) * (u.x - c{t}.x))::BIGINT AS distance FROM u JOIN c{t} USING (i) GROUP BY r, c),
a{t} AS MATERIALIZED (
  SELECT r, c, distance FROM d{t} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c) = 1)""")
        if t < rounds:
            steps.append(f"""m{t} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{t} JOIN u USING (r) GROUP BY c, i),
c{t + 1} AS MATERIALIZED (
  SELECT c, i, CASE WHEN n IS NULL THEN x ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS x
  FROM c{t} LEFT JOIN m{t} USING (c, i))""")
    return ",\n".join(steps) + f""",
h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, c::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN h USING (c)"""


SQL["op13_centroid_clustering"] = _centroid_sql()
