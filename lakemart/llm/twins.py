"""SQL for the queries that it can express."""

from __future__ import annotations


def manifest_sql() -> str:
    """Merkle trees, proofs and folded roots with recursive tables.

    DuckDB has no CRC-32; it is folded bit by bit over the digits of the id.
    """

    def field(name: str, value: str | None = None) -> str:
        text = f"CAST({value or name} AS VARCHAR)"
        return f"coalesce(strlen({text}) || ':' || {text}, '-')"

    def digest(text: str = "text") -> str:
        return f"sha256({' || '.join([field('doc_id'), field('source'), field('lang'), field('n_chars'), field('text', text)])})"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE
checked AS (
  SELECT *, xor(list_reduce(
      list_concat([4294967295], flatten(list_transform(range(1, length(s) + 1), lambda i: [ascii(s[i]) + 1, 0, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, o: CASE WHEN o > 0 THEN xor(c, o - 1) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295) AS crc
  FROM (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents)
),
hashed AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {digest()} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND crc % 3 = 0 THEN {digest(lower)} ELSE {digest()} END AS shown
  FROM checked
),
leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS id, *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
  FROM hashed
),
low(tree, up, idx, h, n) AS (
  SELECT tree, 0, idx, leaf, n FROM leaves
  UNION ALL
  SELECT tree, up + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 7) // 8 FROM low WHERE n > 1 GROUP BY tree, up, idx // 8
),
subroots AS MATERIALIZED (
  SELECT tree, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1
),
high(up, idx, h, n) AS (
  SELECT 0, idx, h, n FROM subroots
  UNION ALL
  SELECT up + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 7) // 8 FROM high WHERE n > 1 GROUP BY up, idx // 8
),
runs AS MATERIALIZED (
  SELECT tree, up, idx // 8 AS run, list(h ORDER BY idx) AS hs FROM low WHERE n > 1 GROUP BY tree, up, idx // 8
  UNION ALL
  SELECT '', up, idx // 8, list(h ORDER BY idx) FROM high WHERE n > 1 GROUP BY up, idx // 8
),
way AS MATERIALIZED (
  SELECT id, row_number() OVER (PARTITION BY id ORDER BY part, up) AS step, place, hs FROM (
    SELECT l.id, 0 AS part, r.up, (l.idx // CAST(pow(8, r.up) AS BIGINT)) % 8 AS place, r.hs
    FROM leaves l JOIN runs r ON r.tree = l.tree AND r.run = l.idx // CAST(pow(8, r.up + 1) AS BIGINT)
    UNION ALL
    SELECT l.id, 1, r.up, (s.idx // CAST(pow(8, r.up) AS BIGINT)) % 8, r.hs
    FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN runs r ON r.tree = '' AND r.run = s.idx // CAST(pow(8, r.up + 1) AS BIGINT))
),
folded(id, step, h) AS (
  SELECT id, 0, shown FROM leaves
  UNION ALL
  SELECT f.id, f.step + 1, sha256(array_to_string(list_concat(list_concat(w.hs[1:w.place], [f.h]), w.hs[w.place + 2:]), ''))
  FROM folded f JOIN way w ON w.id = f.id AND w.step = f.step + 1
),
ends AS (SELECT id, arg_max(h, step) AS h FROM folded GROUP BY id),
proofs AS (
  SELECT id, string_agg(array_to_string(list_concat(hs[1:place], hs[place + 2:]), ''), '' ORDER BY step) AS siblings FROM way GROUP BY id
)
SELECT l.doc_id, l.leaf, s.h AS subroot, t.h AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
FROM leaves l JOIN subroots s ON s.tree = l.tree CROSS JOIN (SELECT h FROM high WHERE n = 1) t
JOIN ends e ON e.id = l.id LEFT JOIN proofs p ON p.id = l.id
"""


def near_vectors_sql() -> str:
    """All pairs of a label, and what they reach."""
    return """
WITH RECURSIVE
usable AS (
  SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
measured AS MATERIALIZED (SELECT *, sqrt(list_inner_product(v, v)) AS size FROM usable),
links AS MATERIALIZED (
  SELECT a.id AS a, b.id AS b, a.vec_id AS va, b.vec_id AS vb
  FROM measured a JOIN measured b ON a.label = b.label AND len(a.v) = len(b.v) AND a.id <> b.id
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.93 END
),
reach(id, other, low) AS (
  SELECT a, b, vb FROM links
  UNION
  SELECT r.id, l.b, l.vb FROM reach r JOIN links l ON l.a = r.other
),
lowest AS (SELECT id, min(low) AS low FROM reach GROUP BY id),
counted AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a),
judged AS (
  SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id
  FROM usable LEFT JOIN lowest USING (id) LEFT JOIN counted USING (id)
  UNION ALL
  SELECT vec_id, 0, vec_id FROM embeddings
  WHERE NOT coalesce(vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false)
)
SELECT vec_id, n_links, component_id, coalesce(vec_id = component_id, false) AS kept FROM judged
"""


def centroids_sql(k: int = 8, rounds: int = 10, dim: int = 64) -> str:
    """Every vector against every centroid, one table for each round."""
    assign = """SELECT v.id, any_value(v.vec_id) AS vec_id, any_value(v.p) AS p, min(struct_pack(d := CAST(list_sum(list_transform(range(1, {dim} + 1), lambda i: (v.p[i] - c.c[i]) * (v.p[i] - c.c[i]))) AS BIGINT), k := c.k)) AS best
  FROM kept v CROSS JOIN c{r} c GROUP BY v.id"""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(CAST(x AS DOUBLE)) < 131072)) = {dim}
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), p) - 1 AS k, p AS c FROM kept WHERE vec_id IS NOT NULL
  QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id), p) <= {k}
)""",
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({assign.format(r=r, dim=dim)})")
        parts.append(
            f"""c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
      SELECT best.k AS k, i, sum(p[i]) AS s, count(*) AS n FROM (SELECT best, p, unnest(range(1, {dim} + 1)) AS i FROM a{r}) GROUP BY best.k, i) GROUP BY k
  ) m ON m.k = c.k
)"""
        )
    parts.append(f"last AS MATERIALIZED ({assign.format(r=rounds, dim=dim)})")
    with_all = ",\n".join(parts)
    return f"""WITH {with_all}
SELECT l.vec_id, CAST(l.best.k AS INTEGER) AS cluster, l.best.d AS distance, CAST(sum(l.best.d) OVER (PARTITION BY l.best.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(l.best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM last l JOIN c{rounds} c ON c.k = l.best.k
"""
