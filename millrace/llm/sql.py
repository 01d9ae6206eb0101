"""DuckDB SQL of the corpus queries; it compares texts and pairs in full."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SHARDING = r"""
WITH c AS (
    SELECT list_transform(range(256), lambda n: list_reduce([n, 1, 1, 1, 1, 1, 1, 1, 1],
        lambda c, b: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
), b AS (
    SELECT doc_id, source, coalesce(strlen(text), 0) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents
), crc AS (
    SELECT doc_id, source, n + 1 AS size, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(1, n + 1), lambda i: CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT))),
        lambda c, x: xor(c >> 8, t[xor(c, x) & 255 + 0 * x + 1]))) AS text_crc32
    FROM b, c
), r AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('mix:' || doc_id)) - 1 AS rank,
        count(*) OVER (PARTITION BY source) AS size_of, count(*) OVER () AS total FROM crc
), p AS (
    SELECT *, row_number() OVER (ORDER BY (rank + 0.5::DOUBLE) / size_of::DOUBLE, source, rank) - 1 AS pos FROM r
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
    CAST(pos * 16 // total AS INTEGER) AS shard,
    CAST(pos - ((pos * 16 // total) * total + 15) // 16 AS BIGINT) AS slot,
    CAST(NULL AS INTEGER) AS grown_shard, source
FROM p
""".replace("xor(c, x) & 255 + 0 * x + 1", "(xor(c, x) & 255) + 1")

SUBSTRING = r"""
WITH w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM documents
), win AS (
    SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM w WHERE len(ws) >= 50
), h AS (
    SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS s FROM win
), late AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS lo FROM h) WHERE lo < doc_id
), cut AS (
    SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(i, i + 50)) AS j FROM late) GROUP BY doc_id
), cutset AS (
    SELECT doc_id, unnest(js) AS j FROM cut
), toks AS (
    SELECT doc_id, unnest(ws) AS wd, unnest(range(1, len(ws) + 1)) AS j FROM w
), kept AS (
    SELECT t.doc_id, string_agg(t.wd, ' ' ORDER BY t.j) AS k
    FROM toks t LEFT JOIN cutset c ON t.doc_id = c.doc_id AND t.j = c.j WHERE c.j IS NULL GROUP BY t.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
    sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

LINES = r"""
WITH ln AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL
), w AS (
    SELECT doc_id, pos, list_filter(regexp_split_to_array(
        regexp_replace(line, '[^ \t\r\x0B\f]*[0-9][^ \t\r\x0B\f]*', '<*>', 'g'), '[ \t\r\x0B\f]+'), lambda x: x <> '') AS ws
    FROM ln
), e AS (
    SELECT doc_id, pos, ws, len(ws) AS size, len(ws) || ' ' || array_to_string(ws[1:3], ' ') AS leaf FROM w WHERE len(ws) > 0
), often AS (
    SELECT leaf FROM e GROUP BY leaf HAVING count(DISTINCT doc_id) >= 3
), t AS (
    SELECT doc_id, pos, size, leaf, unnest(ws) AS word, unnest(range(size)) AS place FROM e WHERE leaf IN (FROM often)
), own AS (
    SELECT leaf, ws, count(DISTINCT doc_id) AS n FROM e WHERE leaf IN (FROM often) GROUP BY ALL
), common AS (
    SELECT leaf, place, word FROM (SELECT leaf, n, unnest(ws) AS word, unnest(range(len(ws))) AS place FROM own)
    GROUP BY ALL HAVING sum(n) >= 3
), tpl AS (
    SELECT doc_id, pos, leaf || '|' || string_agg(place || '=' || word, ' ' ORDER BY place) AS template
    FROM t JOIN common USING (leaf, place, word) GROUP BY doc_id, pos, leaf, size HAVING count(*) >= 0.6 * size
), rec AS (
    SELECT template FROM tpl GROUP BY template HAVING count(DISTINCT doc_id) >= 3
), gone AS (
    SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY template ORDER BY doc_id, pos) AS k
        FROM tpl WHERE template IN (FROM rec)) WHERE k > 1
), kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS k FROM ln ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
), n AS (SELECT doc_id, count(*) AS c FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS BIGINT) AS n_lines,
    CAST(coalesce(n.c, 0) AS BIGINT) AS n_dropped, sha256(coalesce(k, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

_COMPONENTS = r"""
, links AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair)
, reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
, least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
"""

VECTORS = (
    r"""
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pair AS (
    SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id < q.vec_id AND len(p.x) = len(q.x)
    WHERE list_cosine_similarity(p.x, q.x) >= 0.9
)"""
    + _COMPONENTS
    + r"""
, n AS (SELECT a, count(*) AS c FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.c, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(t.b, e.vec_id)) AS component_id,
    e.vec_id = least(e.vec_id, coalesce(t.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN least t ON t.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
)

DECONTAMINATE = (
    r"""
WITH dw AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'UPPER', 'LOWER'), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws
    FROM documents WHERE text IS NOT NULL
), iw AS (
    SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'UPPER', 'LOWER'), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws
    FROM benchmark WHERE text IS NOT NULL
), ds AS (
    SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(SHINGLES) AS sh FROM dw)
), s AS (
    SELECT DISTINCT item_id, sh FROM (SELECT item_id, unnest(SHINGLES) AS sh FROM iw)
), n AS (SELECT item_id, count(*) AS n_item FROM s GROUP BY item_id)
SELECT doc_id, item_id, CAST(n_item AS BIGINT) AS n_item, count(*) AS n_shared, count(*)::DOUBLE / n_item::DOUBLE AS containment
FROM ds JOIN s USING (sh) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_item HAVING count(*) >= 0.75 * n_item
"""
)

JACCARD = (
    r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'UPPER', 'LOWER'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(SHINGLES) AS sh FROM w)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)
, met AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL
), pair AS (
    SELECT met.a, met.b FROM met JOIN n p ON p.doc_id = met.a JOIN n q ON q.doc_id = met.b WHERE 100 * i >= 75 * (p.n + q.n - i)
)"""
    + _COMPONENTS
    + r"""
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(t.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least t ON t.a = d.doc_id
"""
)

_SHINGLES = (
    "CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) "
    "WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE CAST([] AS VARCHAR[]) END"
)
DECONTAMINATE, JACCARD = (
    q.replace("SHINGLES", _SHINGLES).replace("UPPER", _UPPER).replace("LOWER", _LOWER) for q in (DECONTAMINATE, JACCARD)
)

NEGATIVES = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
