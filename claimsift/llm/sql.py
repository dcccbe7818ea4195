"""DuckDB SQL for the queries that SQL can express."""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

OP3 = f"""
WITH RECURSIVE split AS (SELECT doc_id, {WORDS.format(LOWER)} AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM split, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY ALL),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * c >= 75 * (p.n + q.n - c)
),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
    SELECT doc_id, doc_id AS r FROM documents
    UNION
    SELECT edges.x, reached.r FROM edges JOIN reached ON reached.doc_id = edges.y
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY ALL) c ON c.doc_id = d.doc_id
"""

OP7 = f"""
WITH split AS (SELECT doc_id, {WORDS.format("text")} AS w FROM documents),
windows AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS r
    FROM split, unnest(range(1, len(w) - 18)) AS t(i)
),
gone AS (SELECT DISTINCT doc_id, p FROM windows, unnest(range(i, i + 20)) AS t(p) WHERE r > 1),
lost AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM gone GROUP BY ALL),
kept AS (
    SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM split SEMI JOIN lost USING (doc_id)) AS each
    ANTI JOIN gone ON gone.doc_id = each.doc_id AND p = i GROUP BY ALL
)
SELECT s.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0) AS n_removed,
    sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE coalesce(k, '') END) AS kept_sha256
FROM split s LEFT JOIN lost l ON l.doc_id = s.doc_id LEFT JOIN kept ON kept.doc_id = s.doc_id
"""

OP1 = f"""
WITH sized AS (
    SELECT doc_id, source, len({WORDS.format("text")})::BIGINT AS size, md5('7:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
        row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM sized GROUP BY source
),
levels AS (
    SELECT *, 2.0::DOUBLE * source_size AS most,
        coalesce(sum(2.0::DOUBLE * source_size) OVER b, 0) AS filled, coalesce(sum(weight) OVER b, 0) AS used
    FROM sources
    WINDOW b AS (ORDER BY 2.0::DOUBLE * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (
    SELECT max((1.5::DOUBLE * (SELECT sum(source_size) FROM sources) - filled)
        / ((SELECT sum(weight) FROM sources) - used)::DOUBLE) AS v
    FROM levels
),
queued AS (
    SELECT doc_id, size, source_size, weight, place, h,
        least(most, (SELECT v FROM level) * weight) AS target,
        row_number() OVER (ORDER BY place, h, doc_id, size) AS position,
        sum(size) OVER (PARTITION BY place ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS so_far
    FROM sized JOIN levels ON sized.source IS NOT DISTINCT FROM levels.source
),
copies AS (
    SELECT position, size, sum(size) OVER (
        ORDER BY (so_far + (c - 1) * source_size)::DOUBLE / weight, place, position, c ROWS UNBOUNDED PRECEDING) AS total
    FROM queued, unnest([1, 2]) AS t(c)
),
mixed AS (
    SELECT position, sum(size)::BIGINT AS taken FROM copies
    WHERE total <= 1.5::DOUBLE * (SELECT sum(source_size) FROM sources) GROUP BY ALL
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM queued LEFT JOIN mixed USING (position)
"""

#: Each row walks through its jumps; a step never leaves 128 bits.
OP6 = """
WITH RECURSIVE keyed AS (
    SELECT row_number() OVER () AS r, doc_id, (octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS size,
        coalesce(text, '') AS t, ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:16])::UBIGINT::HUGEINT AS key
    FROM documents
),
walk AS (
    SELECT r, n, key AS state, 0::BIGINT AS shard, 0::BIGINT AS after FROM keyed, unnest([8, 9]) AS t(n)
    UNION ALL
    SELECT r, n, s, after,
        floor((after + 1) * (2147483648::DOUBLE / (((s >> 33)::DOUBLE) + 1)))::BIGINT
    FROM (SELECT r, n, after, (state * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS s
          FROM walk WHERE after < n)
),
found AS (SELECT r, n, max(shard)::INTEGER AS shard FROM walk GROUP BY ALL),
bits AS (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
    FROM range(256) AS t(i)
),
bytes AS (
    SELECT r, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda b: ('0x' || b)::BIGINT) AS b FROM keyed
),
summed AS (
    SELECT r, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b),
        lambda x, y: xor(x >> 8, c[(xor(x, y) & 255) + 1]))) AS text_crc32
    FROM bytes, (SELECT list(v ORDER BY i) AS c FROM bits)
)
SELECT doc_id, size, 'key' AS law, text_crc32, a.shard, b.shard AS grown_shard,
    row_number() OVER (PARTITION BY a.shard ORDER BY doc_id) - 1 AS slot
FROM keyed JOIN summed USING (r) JOIN found a ON a.r = keyed.r AND a.n = 8 JOIN found b ON b.r = keyed.r AND b.n = 9
"""

OP5 = """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e,
        embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
    FROM embeddings
),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.ok AND b.ok AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.9
),
reached AS (
    SELECT vec_id, vec_id AS r FROM v
    UNION
    SELECT links.x, reached.r FROM links JOIN reached ON reached.vec_id = links.y
)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) ON x = v.vec_id
JOIN (SELECT vec_id, min(r) AS component_id FROM reached GROUP BY ALL) c ON c.vec_id = v.vec_id
"""

#: Checksums of bytes by table, with ``bits`` and a list of bytes.
BITS = """bits AS (
    SELECT list(v ORDER BY i) AS c FROM (
        SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
            lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
        FROM range(256) AS t(i))
)"""
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(regexp_extract_all(hex(encode({0})), '..'), lambda b: ('0x' || b)::BIGINT)),
    lambda x, y: xor(x >> 8, c[(xor(x, y) & 255) + 1])))"""

OP12 = f"""
WITH {BITS},
split AS (
    SELECT 0 AS side, row_number() OVER () AS r, doc_id, text FROM documents
    UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
),
words AS (
    SELECT side, r, unnest(regexp_extract_all(coalesce({LOWER}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM split
),
hashed AS (SELECT w, {CRC32.format("w")} % 10000 AS b FROM (SELECT DISTINCT w FROM words), bits),
features AS (SELECT side, r, b FROM words JOIN hashed USING (w)),
counted AS (
    SELECT b, count(*) FILTER (WHERE side = 0) AS s, count(*) FILTER (WHERE side = 1) AS t FROM features GROUP BY b
),
gains AS (
    SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counted
),
weighed AS (
    SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM features JOIN gains USING (b) WHERE side = 0 GROUP BY r
),
scored AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT
            + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
    FROM split LEFT JOIN weighed USING (r) WHERE side = 0
),
placed AS (
    SELECT *, n_features >= 20 AS enough, count(*) FILTER (WHERE n_features >= 20) OVER () AS n,
        row_number() OVER (ORDER BY n_features >= 20 DESC, score DESC, doc_id NULLS LAST, n_features) AS place
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN enough AND place <= 10 * n // 100 THEN place END AS rank FROM placed
"""

OP13 = f"""
WITH {BITS},
told AS (
    SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL
),
digests AS (
    SELECT c, turn, octet_length(encode(t)) AS bytes,
        sha256(octet_length(encode(r))::VARCHAR || ':' || r || t)[1:32] AS g FROM told
),
own AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, g) AS p FROM digests),
sizes AS (SELECT c, count(*) AS m FROM own GROUP BY c),
heads AS (
    SELECT s.c, s.c - s.c % 5 AS base, h, least(h, coalesce(b.m, 0)) AS taken
    FROM (SELECT c AS who, {CRC32.format("who::VARCHAR").replace("c[", "table_[")} % 9 AS h FROM sizes, (SELECT c AS table_ FROM bits)) x
    JOIN sizes s ON s.c = x.who LEFT JOIN sizes b ON b.c = s.c - s.c % 5
),
rebuilt AS (
    SELECT heads.c, p, g, bytes FROM heads JOIN own ON own.c = base AND p <= h
    UNION ALL
    SELECT heads.c, p - h + taken, g, bytes FROM heads JOIN own ON own.c = heads.c AND p > h
),
prefixes AS (
    SELECT c, p AS d, bytes, md5(string_agg(g, ',') OVER (PARTITION BY c ORDER BY p)) AS k FROM rebuilt
    UNION ALL SELECT c, 0, 0, '' FROM heads
),
nodes AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM prefixes GROUP BY d, k),
parents AS (
    SELECT n.d, n.k, p.k AS pk, q.conv_id AS parent_conv_id FROM nodes n
    JOIN prefixes p ON p.c = n.conv_id AND p.d = n.d - 1 JOIN nodes q ON q.d = p.d AND q.k = p.k
),
children AS (SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM parents GROUP BY ALL),
subtrees AS (
    SELECT a.d, a.k, sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved_tokens,
        count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
    FROM nodes n LEFT JOIN children USING (d, k) JOIN prefixes a ON a.c = n.conv_id AND a.d <= n.d GROUP BY ALL
),
ends AS (
    SELECT d, k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS h
    FROM (SELECT c, d, k FROM prefixes QUALIFY d = max(d) OVER (PARTITION BY c)) GROUP BY d, k
)
SELECT conv_id, n.d::BIGINT AS depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
    coalesce(h, sha256('')) AS ends_sha256
FROM nodes n JOIN subtrees USING (d, k) LEFT JOIN parents USING (d, k) LEFT JOIN children USING (d, k) LEFT JOIN ends USING (d, k)
"""
