"""SQL that gives the rows of the manifest, the clusters and the personal data."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Levels written out for the trees of rows and for the tree of groups; a finished tree passes through the rest.
ROW_LEVELS, GROUP_LEVELS = 8, 4


def _sized(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _crc32(value: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({value}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {step}), 4294967295)"


def _tree(name: str, leaves: str, levels: int) -> str:
    """CTEs `{name}0` ... of `tree, i, digest, size`, and `{name}_side0` ... with the siblings before and after each node."""
    parts = [f"{name}0 AS ({leaves})"]
    for level in range(levels):
        own = f"{name}{level}"
        parts.append(f"""{name}_side{level} AS (
  SELECT a.tree, a.i, any_value(a.size) AS size, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS after
  FROM {own} a JOIN {own} b ON a.tree = b.tree AND a.i // 8 = b.i // 8 GROUP BY a.tree, a.i
)""")
        parts.append(f"""{name}{level + 1} AS (
  SELECT tree, i // 8 AS i, CASE WHEN any_value(size) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY i)) END AS digest,
    (any_value(size) + 7) // 8 AS size
  FROM {own} GROUP BY tree, i // 8
)""")
    return ", ".join(parts)


def _climb(name: str, start: str, levels: int, tree: str, index: str) -> str:
    """CTEs that carry `proof` and `folded` up through the levels of a tree."""
    parts, before = [], start
    for level in range(levels):
        parts.append(f"""climb_{name}{level} AS (
  SELECT p.* REPLACE (p.proof || s.before || s.after AS proof, CASE WHEN s.size = 1 THEN p.folded ELSE sha256(s.before || p.folded || s.after) END AS folded)
  FROM {before} p JOIN {name}_side{level} s ON s.tree = {tree} AND s.i = {index} // {8**level}
)""")
        before = f"climb_{name}{level}"
    return ", ".join(parts)


MANIFEST_SQL = f"""
WITH rows_in AS (
  SELECT doc_id, lang, {" || ".join(map(_sized, ("doc_id", "source", "lang", "n_chars")))} AS head, text,
    coalesce({_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0, false) AND text IS NOT NULL AS tampered
  FROM documents
), hashed AS (
  SELECT doc_id, lang, sha256(head || {_sized("text")}) AS leaf,
    CASE WHEN tampered THEN sha256(head || {_sized(f"translate(text, '{_UPPER}', '{_LOWER}')")}) END AS other
  FROM rows_in
), leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM hashed
), {_tree("low", "SELECT tree, i, leaf AS digest, count(*) OVER (PARTITION BY tree) AS size FROM leaves", ROW_LEVELS)},
{_tree("top", f"SELECT 0 AS tree, tree AS i, digest, count(*) OVER () AS size FROM low{ROW_LEVELS}", GROUP_LEVELS)},
started AS (SELECT *, '' AS proof, coalesce(other, leaf) AS folded FROM leaves),
{_climb("low", "started", ROW_LEVELS, "p.tree", "p.i")},
{_climb("top", f"climb_low{ROW_LEVELS - 1}", GROUP_LEVELS, "0", "p.tree")}
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(p.proof) AS proof_sha256, p.folded AS folded_root, p.folded = r.digest AS verified
FROM climb_top{GROUP_LEVELS - 1} p JOIN low{ROW_LEVELS} s ON s.tree = p.tree CROSS JOIN top{GROUP_LEVELS} r
"""


def clusters_sql(k: int = 40, rounds: int = 5, seed: int = 2, dims: int = 64, scale: int = 256) -> str:
    parts = [f"""vectors AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
), centroids0 AS (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS c, v FROM vectors ORDER BY sha256('{seed}:' || vec_id), v LIMIT {k}
)"""]
    for n in range(rounds + 1):
        parts.append(f"""assigned{n} AS (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min(d) AS d, arg_min(c, d * {k} + c) AS c FROM (
    SELECT r, vec_id, x.v, c, CAST(list_sum(list_transform(list_zip(x.v, y.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM vectors x CROSS JOIN centroids{n} y
  ) GROUP BY r
)""")
        if n < rounds:
            parts.append(f"""sums{n} AS (
  SELECT c, place, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range({dims})) AS place FROM assigned{n}) GROUP BY c, place
), centroids{n + 1} AS (
  SELECT o.c, coalesce(m.v, o.v) AS v FROM centroids{n} o
  LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS v FROM sums{n} GROUP BY c) m ON o.c = m.c
)""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(o.v, ',')) AS centroid_sha256
FROM assigned{rounds} a JOIN centroids{rounds} o ON a.c = o.c
"""


CLUSTERS_SQL = clusters_sql()
