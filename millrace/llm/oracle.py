"""DuckDB SQL for the registered queries that SQL can express."""

OP4 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w WHERE len(w) >= 20),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM p),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM r WHERE nth > 1),
e AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
k AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS kept FROM e ANTI JOIN c USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

OP5 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
bk AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM bw),
dw AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bk) WHERE len(w) >= k),
h AS (SELECT doc_id, i, dk.k, item_id FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM dw) dk JOIN bk USING (k, s)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP12 = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS f
      FROM s, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
t AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 100),
u AS (SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS cut FROM c),
x AS (SELECT u.lang, u.phrase, u.k, u.a, l.f AS l, r.f AS r, n, cut, (1000 * u.a * n) // (l.f * r.f) AS score
      FROM u JOIN f l ON l.lang = u.lang AND l.phrase = array_to_string(w[1:cut], ' ')
      JOIN f r ON r.lang = u.lang AND r.phrase = array_to_string(w[cut + 1:u.k], ' ') JOIN t ON t.lang = u.lang),
m AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
v AS (SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = m.lang AND c.k > m.k AND 100 * c.a >= 100 * m.a
      AND contains(' ' || c.phrase || ' ', ' ' || m.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l,
       r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM v QUALIFY rank <= 2000
"""


def _crc_table() -> str:
    """The 256 steps of the reflected polynomial EDB88320, as an SQL list."""
    table = list(range(256))
    for _ in range(8):
        table = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in table]
    return "[" + ", ".join(f"{c}::UINTEGER" for c in table) + "]"


def crc32(octets: str) -> str:
    """SQL for the unsigned crc32 of bytes that a column has in hexadecimal."""
    numbers = f"list_transform(range(0, len({octets}) // 2), lambda i: ('0x' || {octets}[2 * i + 1:2 * i + 2])::UINTEGER)"
    steps = f"list_reduce(list_prepend(4294967295::UINTEGER, {numbers}), lambda c, x: xor(c >> 8, ({_crc_table()})[(xor(c, x) & 255) + 1]))"
    return f"xor({steps}, 4294967295::UINTEGER)::BIGINT"


OP13 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) || md5(coalesce(doc_id::VARCHAR, '')) AS key, strlen(coalesce(text, ''))::BIGINT + 8 AS size FROM documents),
b AS (SELECT key, sum(size) AS bytes FROM d GROUP BY key UNION ALL SELECT '~', 0),
c AS (SELECT key, coalesce(sum(bytes) OVER (ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM b),
s AS (SELECT i, key AS splitter FROM c, (SELECT unnest(range(1, 24)) AS i), (SELECT sum(size) AS total FROM d)
      QUALIFY row_number() OVER (PARTITION BY i ORDER BY abs(24 * below - i * total), below) = 1),
p AS (SELECT doc_id, hex(encode(text)) AS octets, key, size, (SELECT count(*) FROM s WHERE s.splitter <= d.key)::INTEGER AS shard FROM d)
SELECT doc_id, size, {crc32("octets")} AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY key) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM p
"""

SQL: dict[str, str] = {
    "op4_substring_dedup": OP4,
    "op5_benchmark_decontamination": OP5,
    "op12_phrase_collocations": OP12,
    "op13_sharding": OP13,
}
