"""SQL answers of the vector and conversation operators."""

from __future__ import annotations

VECTOR_DEDUP = r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0
), linked AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
   AND list_inner_product(a.x, b.x) / (sqrt(list_inner_product(a.x, a.x)) * sqrt(list_inner_product(b.x, b.x))) >= 0.95
), reach AS (
  SELECT a, b FROM linked
  UNION
  SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a
), least AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM linked GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, least(e.vec_id, l.m) AS component_id, e.vec_id = least(e.vec_id, l.m) AS kept
FROM embeddings e LEFT JOIN degree d ON e.vec_id = d.a LEFT JOIN least l ON e.vec_id = l.a
"""


def _round(r: int) -> str:
    """Assignment to the centroids of round ``r``, and the centroids of the next one."""
    return f"""
a{r} AS (
  SELECT i.rid, any_value(i.vec_id) AS vec_id, any_value(i.v) AS v, min(struct_pack(
    d := list_sum(list_transform(range(1, 65), lambda j: (i.v[j] - k.v[j]) * (i.v[j] - k.v[j]))), c := k.c)) AS best
  FROM ints i CROSS JOIN c{r} k GROUP BY i.rid
), c{r + 1} AS (
  SELECT k.c, coalesce(m.v, k.v) AS v FROM c{r} k LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM (
      SELECT best.c AS c, j, sum(v[j]) AS s, count(*) AS n FROM a{r} CROSS JOIN range(1, 65) AS g(j) GROUP BY 1, 2) GROUP BY c) m
  ON k.c = m.c
)"""


CENTROIDS = f"""
WITH ints AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM ints ORDER BY h, v LIMIT 16)
), {",".join(_round(r) for r in range(4))}
SELECT a.vec_id, CAST(a.best.c AS INTEGER) AS cluster, CAST(a.best.d AS BIGINT) AS distance,
       CAST(sum(a.best.d) OVER (PARTITION BY a.best.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(k.v, ',')) AS centroid_sha256
FROM a3 a JOIN c3 k ON a.best.c = k.c
"""


def _plus(state: str, cost: str, letters: str) -> str:
    return f"struct_pack(c := {state}.c + {cost}, p := {state}.p || '{letters}')"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _if(condition: str, option: str) -> str:
    return f"CASE WHEN {condition} THEN {option} END"


_BEFORE_USER = ("t0", "t1", "t3")
_NONE = "struct_pack(c := 1000000000, p := '')"
CONVERSATIONS = f"""
WITH RECURSIVE damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, hit, copy
  FROM (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
             lambda ch: CAST(ascii(ch) AS BIGINT)),
             lambda crc, byte: list_reduce(range(8), lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END, xor(crc, byte)),
             CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 20 AS hit
    FROM conversations) CROSS JOIN (VALUES (1), (2)) AS g(copy)
  WHERE hit <> 0 AND (copy = 1 OR hit = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged
), marked AS (
  SELECT *, left(role, 1) AS r,
         CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM placed
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM marked GROUP BY conv_id
), walk AS (
  SELECT conv_id, 0 AS i, struct_pack(c := 0, p := '') AS s0, {_NONE} AS s1, {_NONE} AS s2, {_NONE} AS s3 FROM counted
  UNION ALL
  SELECT conv_id, i, {_plus("t0", "4", "D")} AS s0,
         {_least(_plus("t1", "4", "D"), _if("k AND r = 's'", _plus("t0", "e", "K")))} AS s1,
         {_least(_plus("t2", "4", "D"), *[_if("k AND r = 'u'", _plus(t, "e", "K")) for t in _BEFORE_USER], *[_if("k", _plus(t, "3 + e", "R")) for t in _BEFORE_USER])} AS s2,
         {_least(_plus("t3", "4", "D"), _if("k AND r = 'a'", _plus("t2", "e", "K")), _if("k", _plus("t2", "3 + e", "R")))} AS s3
  FROM (
    SELECT m.conv_id, m.i, m.r, m.fault IN ('', 'truncated') AS k, CASE m.fault WHEN 'truncated' THEN 3 ELSE 0 END AS e,
           s0 AS t0, s1 AS t1, {_least("s2", *[_plus(s, "3", "I") for s in ("s0", "s1", "s3")])} AS t2,
           {_least("s3", _plus("s2", "3", "I"), *[_plus(s, "6", "II") for s in ("s0", "s1")])} AS t3
    FROM walk w JOIN marked m ON w.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = w.i + 1)
), chosen AS (
  SELECT c.*, {_least("s0", "s3", _plus("s2", "3", "I"), _plus("s1", "6", "II"))} AS best
  FROM counted c JOIN walk w ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i
), letters AS (
  SELECT conv_id, unnest(string_split(best.p, '')) AS letter, unnest(range(len(best.p))) AS pos FROM chosen WHERE best.p <> ''
), rowed AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS m
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
), written AS (
  SELECT l.conv_id, l.pos, l.letter, l.m, k.role, CASE WHEN l.letter = 'I' THEN '' ELSE k.text END AS text,
         max(CASE WHEN l.m = 1 AND l.letter = 'K' AND k.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS opened
  FROM rowed l LEFT JOIN marked k ON l.conv_id IS NOT DISTINCT FROM k.conv_id AND l.i = k.i
), repaired AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (m - opened) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos) AS t
  FROM written WHERE letter <> 'D' GROUP BY conv_id
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT d.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(coalesce(c.best.c, 0) AS BIGINT) AS cost,
       coalesce(c.best.p, '') AS audit, sha256(coalesce(r.t, '')) AS repaired_sha256
FROM ids d LEFT JOIN chosen c ON d.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired r ON d.conv_id IS NOT DISTINCT FROM r.conv_id
"""
