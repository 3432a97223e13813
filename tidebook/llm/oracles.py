"""SQL for DuckDB that returns the rows of the queries that SQL can express."""

from __future__ import annotations

from tidebook.llm.sharding import SHARDS, SLOTS, lookup_table

# CRC-32 in SQL: the 256 remainders, then one step for each byte of a list.
CRC_TABLE = """crc AS (
    SELECT list(c ORDER BY b) AS steps FROM (
        SELECT b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c
        FROM range(256) t(b)))"""


def crc32(codes: str) -> str:
    """CRC-32 of a list of bytes; ``crc`` must be in FROM."""
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b:"
        " xor(c >> 8, crc.steps[(xor(c, b) & 255) + 1])), 4294967295)"
    )


def ascii_codes(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"


def utf8_codes(text: str) -> str:
    digits = "'0123456789ABCDEF'"
    pair = f"16 * (instr({digits}, substr(hex(encode({text})), 2 * i - 1, 1)) - 1)"
    pair += f" + instr({digits}, substr(hex(encode({text})), 2 * i, 1)) - 1"
    return f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: ({pair})::BIGINT)"


SHARDING = f"""
WITH {CRC_TABLE},
placed AS (
    SELECT doc_id, {crc32(ascii_codes("CAST(doc_id AS VARCHAR)"))} % {SLOTS} AS slot
    FROM documents, crc)
SELECT doc_id, slot,
    string_split('{" ".join(SHARDS)}', ' ')[
        string_split('{" ".join(map(str, lookup_table(SHARDS)))}', ' ')[slot + 1]::INT + 1] AS shard
FROM placed
"""

DECONTAMINATE = r"""
WITH RECURSIVE doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes WHERE len(w) >= n)),
found AS (SELECT p.doc_id, p.n, p.i, x.item_id FROM places p JOIN windows x USING (n, phrase)),
hits AS (SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc_words d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) AS phrase
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM doc_words WHERE len(w) >= 35)),
repeated AS (SELECT phrase FROM windows GROUP BY phrase HAVING count(*) > 1),
gone AS (
    SELECT doc_id, list(DISTINCT word) AS words
    FROM (SELECT doc_id, unnest(range(i, i + 35)) AS word FROM windows SEMI JOIN repeated USING (phrase))
    GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(words), 0) AS BIGINT) AS n_removed,
    sha256(array_to_string(list_filter(w, lambda x, i: words IS NULL OR NOT list_contains(words, i)), ' ')) AS kept_sha256
FROM doc_words LEFT JOIN gone USING (doc_id)
"""

QUALITY_RULES = rf"""
WITH {CRC_TABLE},
docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs),
hashed AS (SELECT word, {crc32(utf8_codes("word"))} AS h FROM (SELECT DISTINCT word FROM places), crc),
grams AS (
    SELECT r, h % 1048576 AS b FROM places JOIN hashed USING (word)
    UNION ALL
    SELECT a.r, (x.h * 31 + y.h) % 1048576
    FROM places a JOIN places c ON c.r = a.r AND c.i = a.i + 1
    JOIN hashed x ON x.word = a.word JOIN hashed y ON y.word = c.word),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND toxic = 0),
counts AS (
    SELECT b, count(*) AS n_all, count(*) FILTER (g.doc_id IS NOT NULL) AS n_good
    FROM grams JOIN docs USING (r) LEFT JOIN good g ON g.doc_id = docs.doc_id GROUP BY b),
totals AS (SELECT sum(n_all)::DOUBLE AS a, sum(n_good)::BIGINT AS g FROM counts),
weights AS (
    SELECT b, CAST(round(ln((n_good + 1.0::DOUBLE) / (n_all * g / a + 1.0::DOUBLE)) * 1000000) AS BIGINT) AS weight
    FROM counts, totals),
scores AS (
    SELECT r, count(*) AS n_grams, sum(weight)::BIGINT AS total, sum(least(weight + 2000000, 0))::BIGINT AS below
    FROM grams JOIN weights USING (b) GROUP BY r),
windows AS (SELECT r, i, w[i : i + 2] AS t FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) > 2)),
twice AS (SELECT r, t FROM windows GROUP BY r, t HAVING count(*) > 1),
repeats AS (
    SELECT r, count(DISTINCT p) AS n FROM (
        SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows SEMI JOIN twice USING (r, t)) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM docs),
base AS (
    SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
    FROM docs JOIN lines USING (r) LEFT JOIN repeats USING (r)),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    coalesce(n_grams, 0) AS n_grams,
    CASE WHEN n_grams > 0 THEN total / (n_grams * 1000000.0::DOUBLE) ELSE 0.0::DOUBLE END AS score,
    CASE WHEN n_grams > 0 THEN below / (n_grams * 1000000.0::DOUBLE) ELSE 0.0::DOUBLE END AS "foreign",
    NOT base_failed AND coalesce(total >= -380000 * n_grams AND below >= -12000 * n_grams, true) AS kept
FROM judged LEFT JOIN scores USING (r)
"""

# All pairs: the query finds its pairs by hashing, and all of them on the given tables.
EMBEDDING_DEDUP = """
WITH RECURSIVE rows AS (
    SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS (
    SELECT * FROM rows WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.r <> b.r AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (
    SELECT r AS a, r AS b FROM rows
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b),
groups AS (SELECT a, min(vec_id) AS component_id FROM reached JOIN rows ON r = b GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = rows.r) AS n_links, component_id,
    vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows JOIN groups ON groups.a = rows.r
"""

RESAMPLING = rf"""
WITH {CRC_TABLE},
texts AS (
    SELECT row_number() OVER () AS r, true AS corpus, doc_id, text FROM documents
    UNION ALL SELECT -row_number() OVER (), false, NULL, text FROM benchmark),
cut AS (
    SELECT r, corpus, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (
    SELECT r, corpus, array_to_string(w[i : i + n - 1], ' ') AS run
    FROM (SELECT r, corpus, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM cut, range(1, 4) t(n) WHERE len(w) >= n)),
hashed AS (SELECT run, {crc32(utf8_codes("run"))} % 10000 AS b FROM (SELECT DISTINCT run FROM runs), crc),
features AS (SELECT r, corpus, b, count(*) AS n FROM runs JOIN hashed USING (run) GROUP BY r, corpus, b),
counts AS (
    SELECT b, (sum(n) FILTER (corpus))::DOUBLE AS s, coalesce(sum(n) FILTER (NOT corpus), 0)::DOUBLE AS t
    FROM features GROUP BY b),
totals AS (SELECT coalesce(sum(s), 0) AS big_s, coalesce(sum(t), 0) AS big_t FROM counts),
gains AS (
    SELECT b, CAST(floor(1000::DOUBLE * ln(((t + 1) * (big_s + 10000)) / ((s + 1) * (big_t + 10000)))) AS BIGINT) AS gain
    FROM counts, totals WHERE s IS NOT NULL),
weights AS (
    SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
    FROM features JOIN gains USING (b) WHERE corpus GROUP BY r),
scored AS (
    SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000::DOUBLE * ln(-ln((CAST('0x' || substr(
            sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)))
            AS BIGINT) AS score
    FROM cut LEFT JOIN weights USING (r) WHERE corpus),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS p,
        count(*) OVER (PARTITION BY n_words >= 20) AS many
    FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND p <= 5 * many // 100 THEN p END AS rank FROM ranked
"""

ORACLES: dict[str, str] = {
    "op1_quality_rules": QUALITY_RULES,
    "op3_decontaminate": DECONTAMINATE,
    "op8_sharding": SHARDING,
    "op9_substring_dedup": SUBSTRING_DEDUP,
    "op11_embedding_dedup": EMBEDDING_DEDUP,
    "op12_resampling": RESAMPLING,
}
