"""SQL that the queries must agree with, where SQL can express them."""

OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
     d AS (SELECT page_id, n, sha1(html) AS digest FROM p),
     o AS (SELECT digest, max(page_id) AS original FROM d WHERE n >= 1000 GROUP BY digest)
SELECT d.page_id, d.n AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN o.original <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN o.original <> d.page_id THEN o.original END AS refers_to
FROM d LEFT JOIN o ON d.n >= 1000 AND d.digest = o.digest
"""

OP8 = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS n FROM docs GROUP BY source
), w AS (
  SELECT source, source_size, n, ([5, 2, 1])[(n % 3 + 1)::INT]::BIGINT AS w, 3 * source_size AS cap FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::DOUBLE AS level
  FROM w WINDOW before AS (ORDER BY cap::DOUBLE / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * w) AS target FROM l
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS e,
         ('0x' || substr(md5('mix' || coalesce(source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
  FROM t
), r AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.e, e.u,
         row_number() OVER (
           PARTITION BY d.source
           ORDER BY greatest(length(bin(d.size)) - 5, 0) * 32 + (d.size >> greatest(length(bin(d.size)) - 5, 0)),
                    md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id, d.size) AS r
  FROM docs d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target, (floor(e * r + u) - floor(e * (r - 1) + u))::BIGINT * size AS taken FROM r
"""

OP11 = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
WHERE rank <= 20
"""

# crc32 of the decimal id, as DuckDB has none: one table step per byte, bits first to last.
_CRC = """list_reduce(
      list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i::INT + 1, 1))::BIGINT),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, (r & 1) * 3988292384)),
      4294967295::BIGINT)"""

_LEAF = """sha256(concat(
    coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id::VARCHAR, '-'), coalesce(octet_length(encode(source)) || ':' || source, '-'),
    coalesce(octet_length(encode(lang)) || ':' || lang, '-'), coalesce(octet_length(encode({n}::VARCHAR)) || ':' || {n}::VARCHAR, '-'),
    coalesce(octet_length(encode(text)) || ':' || text, '-')))"""

OP12 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_LEAF.format(n="n_chars")} AS leaf,
         CASE WHEN xor({_CRC}, 4294967295) % 7 = 0 THEN {_LEAF.format(n="(n_chars + 1)")} END AS changed
  FROM documents
), r AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d
), g AS (
  SELECT tree, 0 AS level, pos, n, leaf AS h FROM r
  UNION ALL
  SELECT tree, level + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY pos)) FROM g WHERE n > 1 GROUP BY tree, level, pos // 2
), s AS (
  SELECT tree, h AS subroot, level AS height, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM g WHERE n = 1
), u AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM s
  UNION ALL
  SELECT level + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY level, pos // 2
), low AS (
  SELECT r.tree, r.pos AS leaf_pos, g.level AS step, g.pos % 2 = 0 AS l, o.h
  FROM r JOIN g ON g.tree = r.tree AND g.pos = r.pos // (1 << g.level)::BIGINT AND g.n > 1
  LEFT JOIN g o ON o.tree = g.tree AND o.level = g.level AND o.pos = xor(g.pos, 1)
), high AS (
  SELECT s.tree, u.level AS step, u.pos % 2 = 0 AS l, o.h
  FROM s JOIN u ON u.pos = s.pos // (1 << u.level)::BIGINT AND u.n > 1 LEFT JOIN u o ON o.level = u.level AND o.pos = xor(u.pos, 1)
), every AS (
  SELECT * FROM low
  UNION ALL
  SELECT r.tree, r.pos, s.height + high.step, high.l, high.h FROM r JOIN s USING (tree) JOIN high USING (tree)
), p AS (
  SELECT tree, leaf_pos, list(CASE WHEN l THEN 'R' ELSE 'L' END || coalesce(h, '') ORDER BY step) AS path FROM every GROUP BY tree, leaf_pos
), f AS (
  SELECT r.doc_id, r.leaf, s.subroot, (SELECT h FROM u WHERE n = 1) AS root,
         sha256(array_to_string(list_transform(coalesce(path, []), lambda x: substr(x, 2)), '')) AS proof_sha256,
         list_reduce(coalesce(path, []), lambda node, x: sha256(CASE WHEN x[1] = 'L' THEN substr(x, 2) || node ELSE node || substr(x, 2) END),
                     coalesce(r.changed, r.leaf)) AS folded_root
  FROM r JOIN s USING (tree) LEFT JOIN p ON p.tree = r.tree AND p.leaf_pos = r.pos
)
SELECT *, folded_root = root AS verified FROM f
"""

OP13 = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT text, min(doc_id) AS low FROM w GROUP BY text
), d AS (
  SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
          100 * (length(w.text) - length(regexp_replace(w.text, '[A-Z]', '', 'g'))) > 3 * length(w.text),
          regexp_matches(w.text, '[#$%&*|]'), coalesce(w.doc_id > m.low, false)] AS fails
  FROM w JOIN m USING (text) LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY part, fails
), x AS (SELECT unnest(range(1, 6)) AS f),
o AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS fs FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), t AS (
  SELECT array_to_string(list_transform(fs, lambda f: chr(64 + f::INT)), '') AS filter_order, s.f AS step, fs[s.f] AS f, fs[1:s.f - 1] AS before FROM o, x s
), k AS (
  SELECT part, filter_order, step, f, sum(n * (NOT gone AND NOT own)::INT) AS kept, sum(n * (own AND NOT gone)::INT) AS removed,
         sum(n * (own AND gone)::INT) AS redundant, sum(n * (own AND only_one)::INT) AS unique_fails,
         sum(good * (own AND NOT gone)::INT) AS good_lost, sum(toxic * (own AND NOT gone)::INT) AS toxic_lost
  FROM (SELECT c.*, t.*, fails[t.f] AS own, len(list_filter(before, lambda b: fails[b])) > 0 AS gone, len(list_filter(fails, lambda y: y)) = 1 AS only_one FROM c, t)
  GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM k
"""

EXPECTED = {
    "op2_warc_revisits": OP2,
    "op8_mix_sources": OP8,
    "op11_block_search": OP11,
    "op12_merkle_manifest": OP12,
    "op13_filter_audit": OP13,
}
