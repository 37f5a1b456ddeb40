"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from lakelayers.llm import feistel, mixing, vector_codes

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS draw
  FROM documents
), held AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size)::BIGINT * {mixing.MAX_EPOCHS} AS cap,
         [{", ".join(map(str, mixing.WEIGHTS))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1)::INT]::BIGINT AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, row_number() OVER fill AS place,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::BIGINT AS rest,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS open
  FROM held
  WINDOW fill AS (ORDER BY cap / weight, source NULLS LAST),
         before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT rest, open FROM filled WHERE cap * open >= weight * rest ORDER BY place LIMIT 1
), plan AS (
  SELECT f.source, f.source_size, least(f.cap::DOUBLE, (f.weight * l.rest)::DOUBLE / l.open) AS target
  FROM filled f, level l
), placed AS (
  SELECT s.*, p.source_size, p.target, round(p.target)::BIGINT AS wanted,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0
             ELSE wanted // source_size + CASE WHEN before * 2 + size < (wanted % source_size) * 2 THEN 1 ELSE 0 END END * size)::BIGINT AS taken
FROM placed
"""

DIGEST = rf"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '{BLANK}', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, row_number() OVER w AS place
  FROM rows
  WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""


def _rounds(left: str, right: str, half: str) -> str:
    """One pass of the Feistel network as nested expressions would repeat themselves;
    each round is a struct made of the last."""
    state = f"{{'l': {left}, 'r': {right}}}"
    keys = ", ".join(map(str, feistel.round_keys(feistel.SEED)))
    mixed = "(xor(s.r, k) * 1640531513) % 4294967296"
    again = f"(xor({mixed}, ({mixed}) >> 15) * 1640531513) % 4294967296"
    return (
        f"list_reduce(list_transform([{keys}], lambda k: {{'l': k::BIGINT, 'r': 0::BIGINT}}), "
        f"lambda s, q: {{'l': s.r, 'r': xor(s.l, xor({again.replace(', k)', ', q.l)')}, ({again.replace(', k)', ', q.l)')}) >> 13) & ((1::BIGINT << {half}) - 1))}}, {state})"
    )


SHARD = f"""
WITH RECURSIVE table_of AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab
), hexed AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), summed AS (
  SELECT doc_id, (length(h) // 2 + 1)::BIGINT AS size,
         xor(4294967295, list_reduce(list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))::BIGINT AS text_crc32
  FROM hexed, table_of
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS n, count(*) OVER () AS total,
         greatest(1, (ceil(log2(greatest(count(*) OVER (), 2)))::INT + 1) // 2) AS half
  FROM summed
), walk AS (
  SELECT doc_id, size, text_crc32, total, half, n AS p, 0 AS steps FROM numbered
  UNION ALL
  SELECT doc_id, size, text_crc32, total, half, (s.l << half) | s.r, steps + 1
  FROM (SELECT *, {_rounds("(p >> half)::BIGINT", "(p & ((1::BIGINT << half) - 1))::BIGINT", "half")} AS s
        FROM walk WHERE steps = 0 OR p >= total)
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (p % {feistel.SHARDS})::INT AS shard, (p // {feistel.SHARDS})::BIGINT AS slot,
       NULL::INT AS grown_shard
FROM walk WHERE steps > 0 AND p < total
"""

NEAR = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM split
), sized AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM pair JOIN sized p ON p.doc_id = x JOIN sized q ON q.doc_id = y WHERE 100 * common >= 85 * (p.n + q.n - common)
), edge AS (
  SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.y FROM reach r JOIN edge e ON r.other = e.x
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least USING (doc_id) LEFT JOIN sized USING (doc_id)
"""

VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, e.y FROM reach r JOIN link e ON r.other = e.x
), least AS (
  SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
), counted AS (
  SELECT x AS vec_id, count(*) AS n FROM link GROUP BY x
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least USING (vec_id) LEFT JOIN counted USING (vec_id)
"""

_KEPT_CODES = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS (
  SELECT vec_id, label, p, v[p * (len(v) // {vector_codes.PARTS}) + 1 : (p + 1) * (len(v) // {vector_codes.PARTS})] AS part
  FROM kept, range({vector_codes.PARTS}) t(p)
), parts AS MATERIALIZED (
  SELECT p, part, count(*) AS n FROM cut GROUP BY p, part
), book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part AS entry FROM cut
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {vector_codes.ENTRIES}
)"""


def _nearest(n: int) -> str:
    """Each distinct part's nearest entry of the codebook of round ``n``, and the entries' next places."""
    apart = "list_sum(list_transform(range(1, len(part) + 1), lambda i: (part[i] - entry[i]) * (part[i] - entry[i])))"
    return f""", near{n} AS MATERIALIZED (
  SELECT p, part, any_value(n) AS n, min(struct_pack(d := apart, e := e)) AS best
  FROM (SELECT p, part, n, e, {apart} AS apart FROM parts JOIN book{n} USING (p)) GROUP BY p, part
)"""


def _round(n: int) -> str:
    return f"""{_nearest(n)}, mean{n} AS (
  SELECT p, e, i, sum(n * x) AS s, sum(n) AS c
  FROM (SELECT p, best.e AS e, n, unnest(part) AS x, unnest(range(1, len(part) + 1)) AS i FROM near{n}) GROUP BY p, e, i
), book{n + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(moved, entry) AS entry FROM book{n} LEFT JOIN (
    SELECT p, e, list(((s - ((s % c) + c) % c) // c)::BIGINT ORDER BY i) AS moved FROM mean{n} GROUP BY p, e
  ) USING (p, e)
)"""


CODES = f"""{_KEPT_CODES}{"".join(_round(n) for n in range(vector_codes.ROUNDS))}{_nearest(vector_codes.ROUNDS)}, coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
  FROM cut JOIN near{vector_codes.ROUNDS} USING (p, part) GROUP BY vec_id, label
), told AS (
  SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{vector_codes.ROUNDS}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, told
"""

ORACLE: dict[str, str] = {
    "op3_water_filling": MIX,
    "op4_digest_index": DIGEST,
    "op5_pigeonhole": VECTORS,
    "op9_minhash_bayes": NEAR,
    "op10_feistel_shards": SHARD,
    "op12_trie_codes": CODES,
}
