"""SQL for the queries that SQL can express, on the same tables."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(pattern: str) -> str:
    return f"regexp_extract_all({LOWER}, '{pattern}')"


ALNUM = words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = words(r"[^\x20\x09-\x0D]+")

NEAR = f"""
WITH RECURSIVE d AS (SELECT doc_id, {SPACED} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
  WHERE 100 * common >= 80 * (x.n + y.n - common)
),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN n USING (doc_id) GROUP BY doc_id"""

LEAKS = f"""
WITH d AS (SELECT doc_id, {ALNUM} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {ALNUM} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS piece, len(w[i:i + 9]) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes),
hits AS (
  SELECT doc_id, i, n, item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS piece FROM starts) JOIN windows USING (piece, n)
),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM hits GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)"""

REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
strings AS (SELECT doc_id, i, md5(substring(h, 2 * i + 1, 200)) AS piece
            FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM d WHERE n >= 100)),
later AS (SELECT doc_id, i FROM strings
          QUALIFY row_number() OVER (PARTITION BY piece ORDER BY doc_id, i) > 1),
runs AS (
  SELECT doc_id, min(i) AS start, max(i) + 100 AS stop
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run
        FROM (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS fresh FROM later))
  GROUP BY doc_id, run
),
ends AS (
  SELECT doc_id, start, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS kept_from FROM runs
  UNION ALL
  SELECT doc_id, n, coalesce((SELECT max(stop) FROM runs r WHERE r.doc_id = d.doc_id), 0) FROM d
),
kept AS (
  SELECT doc_id, string_agg(substring(h, 2 * kept_from + 1, 2 * (start - kept_from)), '' ORDER BY kept_from, start) AS h
  FROM ends JOIN d USING (doc_id) GROUP BY doc_id
),
gone AS (SELECT doc_id, CAST(sum(stop - start) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY 1)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)"""

AUDIT = f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY 1
),
failing AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN min(d.doc_id) OVER (PARTITION BY t) < d.doc_id THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN marks ON d.doc_id = marks.doc_id
),
hist AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
met AS (
  SELECT *, coalesce(list_min(list_transform(string_split(nullif(fails, ''), ''), lambda x: instr(filter_order, x))), 9) AS gone
  FROM hist, orders
),
steps AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
    sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone < step AND contains(fails, substr(filter_order, step, 1)) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = substr(filter_order, step, 1) THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM met, (SELECT unnest([1, 2, 3, 4, 5]) AS step) GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM steps"""

WHOLE = """SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"""

NEAREST = f"""
WITH vectors AS ({WHOLE}),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 10"""


def vector_codes(rounds: int = 4) -> str:
    """Each round assigns all parts by comparing all entries, then moves the entries."""
    steps = [f"""vectors AS MATERIALIZED ({WHOLE}),
parts AS MATERIALIZED (
  SELECT vec_id, label, p, CAST(list_slice(v, p * len(v) // 4 + 1, (p + 1) * len(v) // 4) AS DOUBLE[]) AS x
  FROM vectors, (SELECT unnest([0, 1, 2, 3]) AS p)
),
book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS c FROM parts QUALIFY k < 256
)"""]
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT vec_id, label, parts.p, any_value(x) AS x, min({{'d': CAST(list_sum(list_transform(list_zip(x, c), lambda y: (y[1] - y[2]) * (y[1] - y[2]))) AS BIGINT), 'k': k}}) AS best
  FROM parts JOIN book{i} USING (p) GROUP BY 1, 2, 3
)""")
        if i < rounds:
            steps.append(f"""book{i + 1} AS MATERIALIZED (
  SELECT p, k, coalesce(m, c) AS c FROM book{i} LEFT JOIN (
    SELECT p, k, list(floor(s / n) ORDER BY i) AS m FROM (
      SELECT p, best.k AS k, i, sum(x[i]) AS s, count(*) AS n FROM near{i}, (SELECT unnest(range(1, 17)) AS i) GROUP BY 1, 2, 3
    ) GROUP BY 1, 2
  ) USING (p, k)
)""")
    return f"""WITH {", ".join(steps)},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', best.k), '' ORDER BY p) AS code, sum(best.d) AS error FROM near{rounds} GROUP BY 1, 2
)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(CAST(c AS BIGINT[]), ','), ',' ORDER BY p, k)) FROM book{rounds}) AS codebooks_sha256
FROM coded"""


ORACLES: dict[str, str] = {
    "op3_minhash": NEAR,
    "op6_decontaminate": LEAKS,
    "op10_suffix_array": REPEATS,
    "op11_filter_audit": AUDIT,
    "op12_kd_top_k": NEAREST,
    "op13_dual_tree_codes": vector_codes(),
}
