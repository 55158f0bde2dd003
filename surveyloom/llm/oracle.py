"""DuckDB SQL for the operators over training text that SQL can express."""

from __future__ import annotations


def clusters(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024) -> str:
    """``op11``: every vector against every centroid, round by round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, vec_id, w, min(list_sum(list_transform(list_zip(w, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT * {k} + cluster) AS best
  FROM v CROSS JOIN c{r} GROUP BY rid, vec_id, w)""")
        if r < rounds:
            steps.append(f"""m{r} AS MATERIALIZED (
  SELECT cluster, list(mean ORDER BY d) AS c FROM (
    SELECT cluster, d, (s - ((s % n) + n) % n) // n AS mean FROM (
      SELECT (best % {k})::INT AS cluster, d, sum(w[d])::HUGEINT AS s, count(*)::HUGEINT AS n
      FROM a{r}, range(1, {dims + 1}) AS g(d) GROUP BY ALL)) GROUP BY cluster),
c{r + 1} AS MATERIALIZED (SELECT o.cluster, coalesce(m{r}.c::BIGINT[], o.c) AS c FROM c{r} o LEFT JOIN m{r} ON o.cluster = m{r}.cluster)""")
    rest = ",\n".join(steps)
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS w
  FROM embeddings
  WHERE len(embedding) = {dims} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x) < 131072))),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY start NULLS LAST, w) - 1)::INT AS cluster, w AS c
  FROM (SELECT sha256('3:' || vec_id::VARCHAR) AS start, w FROM v ORDER BY start NULLS LAST, w LIMIT {k})),
{rest},
f AS (SELECT vec_id, (best % {k})::INT AS cluster, (best // {k})::BIGINT AS distance FROM a{rounds}),
i AS (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM f GROUP BY cluster)
SELECT vec_id, f.cluster, distance, cluster_inertia, (SELECT sum(distance)::BIGINT FROM f) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM f JOIN i ON f.cluster = i.cluster JOIN c{rounds} c ON f.cluster = c.cluster"""


def manifest(fanout: int = 8, levels: int = 8, top_levels: int = 4) -> str:
    """``op13``: level by level, for up to ``fanout ** levels`` documents of a language."""
    spelled = " || ".join(
        f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars")
    )
    text = "coalesce(strlen({0}) || ':' || {0}, '-')"
    crc = (
        "xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), "
        "lambda a, b: list_reduce([xor(a, b)] || range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), "
        "4294967295::BIGINT)"
    )
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def tree(prefix: str, depth: int) -> list[str]:
        """Node tables n0, n1, ... and leaf tables l0, l1, ... of one forest: (g, i, h) and (leaf columns, cur, proof)."""
        out = []
        for n in range(depth):
            out.append(f"""{prefix}r{n} AS MATERIALIZED (
  SELECT g, i // {fanout} AS i, list(h ORDER BY i) AS hs, any_value(cnt) AS cnt
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS cnt FROM {prefix}n{n}) GROUP BY g, i // {fanout}),
{prefix}n{n + 1} AS MATERIALIZED (
  SELECT g, i, CASE WHEN cnt > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {prefix}r{n}),
{prefix}l{n + 1} AS MATERIALIZED (
  SELECT l.g, l.ident, l.leaf, l.i // {fanout} AS i,
    CASE WHEN cnt > 1 THEN sha256(array_to_string(hs[1:l.i % {fanout}], '') || cur || array_to_string(hs[l.i % {fanout} + 2:], '')) ELSE cur END AS cur,
    CASE WHEN cnt > 1 THEN proof || array_to_string(hs[1:l.i % {fanout}], '') || array_to_string(hs[l.i % {fanout} + 2:], '') ELSE proof END AS proof
  FROM {prefix}l{n} l JOIN {prefix}r{n} r ON l.g = r.g AND l.i // {fanout} = r.i)""")
        return out

    # The tree over subroots folds nothing but carries its proofs; a document's fold goes on from its own subroot.
    docs = ",\n".join(tree("d", levels))
    tops = ",\n".join(tree("t", top_levels))
    folds = ",\n".join(
        f"""f{n + 1} AS MATERIALIZED (
  SELECT f.ident, f.g, f.leaf, f.subroot, f.i // {fanout} AS i,
    CASE WHEN cnt > 1 THEN sha256(array_to_string(hs[1:f.i % {fanout}], '') || cur || array_to_string(hs[f.i % {fanout} + 2:], '')) ELSE cur END AS cur,
    CASE WHEN cnt > 1 THEN proof || array_to_string(hs[1:f.i % {fanout}], '') || array_to_string(hs[f.i % {fanout} + 2:], '') ELSE proof END AS proof
  FROM f{n} f JOIN tr{n} r ON f.i // {fanout} = r.i)"""
        for n in range(top_levels)
    )
    return f"""
WITH hashed AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '-') AS g, sha256({spelled} || {text.format("text")}) AS leaf,
    sha256({spelled} || {text.format("changed")}) AS now
  FROM (SELECT *, CASE WHEN {crc} % 3 = 0 THEN {lower} ELSE text END AS changed FROM documents)),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, now) - 1 AS i FROM hashed),
dn0 AS MATERIALIZED (SELECT g, i, leaf AS h FROM leaves),
dl0 AS MATERIALIZED (SELECT g, doc_id AS ident, leaf, i, now AS cur, '' AS proof FROM leaves),
{docs},
s AS MATERIALIZED (SELECT '' AS g, g AS name, row_number() OVER (ORDER BY g) - 1 AS i, h FROM dn{levels}),
tn0 AS MATERIALIZED (SELECT g, i, h FROM s),
tl0 AS MATERIALIZED (SELECT g, name AS ident, h AS leaf, i, h AS cur, '' AS proof FROM s),
{tops},
f0 AS MATERIALIZED (
  SELECT l.ident, l.g, l.leaf, s.h AS subroot, s.i, l.cur, l.proof FROM dl{levels} l JOIN s ON l.g = s.name),
{folds},
top AS (SELECT h AS root FROM tn{top_levels})
SELECT ident AS doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM f{top_levels} CROSS JOIN top"""
