"""SQL of the numbered queries that SQL can express."""

SQL: dict[str, str] = {}

SQL["op1_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split
), keyed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS stripped FROM lines
), lowered AS (
  SELECT *, translate(stripped, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM keyed
), shared AS (
  SELECT k, max(doc_id) AS keeper FROM lowered WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.doc_id, l.pos, l.line, s.k IS NOT NULL AND l.doc_id IS DISTINCT FROM s.keeper AS dropped
  FROM lowered l LEFT JOIN shared s ON l.k = s.k
)
SELECT doc_id, count(*) AS n_lines, count(CASE WHEN dropped THEN 1 END) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN NOT dropped THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SQL["op2_mixing"] = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS place
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM sizes GROUP BY source
), levels AS (
  SELECT *, 3 * source_size / weight AS ratio,
         ((SELECT sum(source_size) FROM totals) - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM totals
), targets AS (
  SELECT source, source_size,
         CAST(CASE WHEN ratio >= level THEN (SELECT max(level) FROM levels WHERE ratio >= level) * weight ELSE 3 * source_size END AS DOUBLE) AS target
  FROM levels
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS words,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sizes d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE size * (words // source_size) + greatest(0, least(size, words % source_size - start)) END AS BIGINT) AS taken
FROM placed
"""

# crc32 has no function there: a byte at a time, eight shifts a byte.
_CRC32 = (
    "xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), "
    "lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"
)


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _digest(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


SQL["op11_manifest"] = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {_digest("n_chars")} AS leaf,
         CASE WHEN {_CRC32} % 7 = 0 THEN {_digest("n_chars + 1")} END AS altered
  FROM documents
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM hashed
), nodes AS (
  SELECT lang, 0 AS level, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2, n
), tops AS MATERIALIZED (
  SELECT lang, max(level) AS levels, arg_max(digest, level) AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM nodes GROUP BY lang
), upper_nodes AS (
  SELECT 0 AS level, place AS pos, n, subroot AS digest FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 2, n
), top AS (
  SELECT max(level) AS levels, arg_max(digest, level) AS root FROM upper_nodes
), everything AS MATERIALIZED (
  SELECT t.place, e.level, e.pos, e.digest FROM nodes e JOIN tops t ON e.lang IS NOT DISTINCT FROM t.lang WHERE e.level < t.levels
  UNION ALL
  SELECT t.place, t.levels + u.level, u.pos, u.digest FROM upper_nodes u, tops t, top WHERE u.level < top.levels
), folded AS (
  SELECT l.doc_id, l.leaf, t.place, t.levels, t.subroot, top.root, top.levels AS upper_levels, 0 AS level, l.pos, coalesce(l.altered, l.leaf) AS digest, '' AS beside
  FROM leaves l JOIN tops t ON l.lang IS NOT DISTINCT FROM t.lang, top
  UNION ALL
  SELECT doc_id, leaf, place, levels, subroot, root, upper_levels, level + 1, here // 2,
         sha256(CASE WHEN here % 2 = 1 THEN coalesce(sibling, '') || digest ELSE digest || coalesce(sibling, '') END), beside || coalesce(sibling, '')
  FROM (
    SELECT f.*, CASE WHEN f.level = f.levels THEN f.place ELSE f.pos END AS here, e.digest AS sibling
    FROM folded f LEFT JOIN everything e
      ON e.place = f.place AND e.level = f.level AND e.pos = xor(CASE WHEN f.level = f.levels THEN f.place ELSE f.pos END, 1)
    WHERE f.level < f.levels + f.upper_levels
  )
)
SELECT doc_id, leaf, subroot, root, sha256(beside) AS proof_sha256, digest AS folded_root, digest = root AS verified
FROM folded WHERE level = levels + upper_levels
"""

SQL["op13_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
         CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 5
"""
