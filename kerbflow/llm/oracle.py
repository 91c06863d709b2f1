"""SQL of the queries that DuckDB can express, written from what they mean, not from how they run."""

from __future__ import annotations

# --- op2 ------------------------------------------------------------------------------------------


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(kind: str, rank: int, pattern: str, keep: str) -> str:
    p = _quoted(pattern)
    return f"""
    SELECT rid, {rank} AS rank, '{kind}' AS kind, match, s AS start, s + length(match) AS "end"
    FROM (
        SELECT rid, m[i] AS match,
            coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)
            + list_sum(list_transform(g[1:i], lambda x: length(x))) AS s
        FROM (
            SELECT *, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT rid, regexp_extract_all(text, {p}) AS m, string_split_regex(text, {p}) AS g FROM texts)
        )
    ) WHERE {keep}"""


UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
SAME_KEY = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
FILLERS = "^((example|sample|placeholder|your|my|api|access|secret|key|token|here|x{4,}|0{4,})[-_=/+]?)+$"
PATH_WORD = "([A-Z]?[a-z]+[0-9]{0,4}|[A-Z]+|[0-9]{1,8})"
PATH = f"^/?{PATH_WORD}([_=-]+{PATH_WORD})*(/{PATH_WORD}([_=-]+{PATH_WORD})*){{2,}}/?$"


def _entropy(kind: str, rank: int, letters: str, window: int, bits: float) -> str:
    """Runs with a letter and a digit, not allowed as a whole, and with a window of so many bits a character.

    A window's entropy is log2(window) less the mean of log2 of each character's count; sums are in whole millionths.
    """
    held = f"string_split(substr(match, i, {window}), '')"
    weight = "CAST(round(n * log2(n) * 1000000) AS BIGINT)"
    sums = f"""list_transform(range(1, length(match) - {window} + 2), lambda i: list_sum(list_transform(list_distinct({held}),
        lambda x: list_transform([len(list_filter({held}, lambda y: y = x))], lambda n: {weight})[1])))"""
    most = f"CAST(round((log2({window}) - {bits}) * {window} * 1000000) AS BIGINT)"
    allowed = f"""regexp_matches(match, {_quoted(UUID)}) OR match = {_quoted(SAME_KEY)} OR regexp_matches(lower(match), {_quoted(FILLERS)})
        OR regexp_matches(match, {_quoted(PATH)})"""
    keep = f"regexp_matches(match, '[0-9]') AND regexp_matches(match, '[A-Za-z]') AND NOT ({allowed}) AND list_min({sums}) <= {most}"
    return _matches(kind, rank, f"[{letters}]{{{window},}}", keep)


# The base patterns of the contract.
ASSIGN = """(?i)(password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def _secrets() -> str:
    kinds = [
        _matches("assign", 0, ASSIGN, f"length(regexp_extract(match, {_quoted(ASSIGN)}, 2)) >= 8"),
        _matches("access", 1, "AKIA[A-Z0-9]+", "length(match) >= 16"),
        _matches("hex", 2, "[0-9a-f]+", "length(match) >= 32"),
        _entropy("entropy_hex", 3, "0-9a-fA-F", 32, 3.0),
        _entropy("entropy_base64", 4, "A-Za-z0-9+/_=-", 24, 4.0),
    ]
    return f"""
    WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    spans AS ({" UNION ALL ".join(kinds)}),
    found AS (
        SELECT rid,
            count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
            string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
            string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) AS spans
        FROM spans GROUP BY rid
    )
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts LEFT JOIN found USING (rid)"""


# --- op3 ------------------------------------------------------------------------------------------

WARC = """
WITH rows AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
hashed AS (SELECT *, unhex(sha1(body))::BIT::VARCHAR AS bits, max(page_id) OVER (PARTITION BY body) AS newest FROM rows)
SELECT page_id, strlen(body) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(
        list_transform(range(0, 5), lambda j: CASE WHEN substr(bits, i * 5 + j + 1, 1) = '1' THEN 1 << (4 - j) ELSE 0 END))::INT, 1)), '')
        AS payload_digest,
    CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < newest THEN newest END AS refers_to
FROM hashed
"""

# --- op4 ------------------------------------------------------------------------------------------

VECTORS = """
WITH RECURSIVE good AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
classes AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN classes ON vec_id = classes.a LEFT JOIN counts ON vec_id = counts.a
"""

# --- op9 ------------------------------------------------------------------------------------------

MINHASH = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM documents
),
runs AS (
    SELECT doc_id, unnest(list_distinct(
        CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS run
    FROM words
),
numbered AS (SELECT doc_id, hash(run) AS run FROM runs),
sizes AS (SELECT doc_id, count(*) AS n FROM numbered GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM numbered a JOIN numbered b ON a.run = b.run AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT a, b FROM shared JOIN sizes s ON a = s.doc_id JOIN sizes t ON b = t.doc_id WHERE shared.n >= 0.8 * (s.n + t.n - shared.n)
),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
classes AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size, doc_id = class_id AS kept FROM classes
"""

# The same over counts of runs: the smaller counts of a pair against the larger ones.
MINHASH_OF_COUNTS = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM documents
),
runs AS (
    SELECT doc_id, unnest(
        CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS run
    FROM words
),
counted AS (SELECT doc_id, hash(run) AS run, count(*) AS times FROM runs GROUP BY ALL),
sizes AS (SELECT doc_id, sum(times) AS n FROM counted GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.times, b.times)) AS n
    FROM counted a JOIN counted b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT a, b FROM shared JOIN sizes s ON a = s.doc_id JOIN sizes t ON b = t.doc_id WHERE shared.n >= 0.8 * (s.n + t.n - shared.n)
),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
classes AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size, doc_id = class_id AS kept FROM classes
"""

# --- op10 -----------------------------------------------------------------------------------------

CHAT = """
WITH RECURSIVE turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')
),
sized AS (
    SELECT *, len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^\\s\\x0bA-Za-z0-9_]')) + 3 AS tokens,
        length(replace(replace(replace(text, '\\', '\\b'), '#', '\\h'), '<', '\\l')) + length(role) + 15 AS chars,
        row_number() OVER o AS nth, first_value(role) OVER o AS first_role
    FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)
),
summed AS (
    SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p,
        CASE WHEN first_role = 'system' THEN first_value(tokens) OVER (PARTITION BY conv_id ORDER BY nth) ELSE 0 END AS system_tokens,
        CASE WHEN first_role = 'system' THEN first_value(chars) OVER (PARTITION BY conv_id ORDER BY nth) ELSE 0 END AS system_chars
    FROM sized
),
roomy AS (SELECT *, greatest(1, 384 - system_tokens) AS room, p // (32 * greatest(1, 384 - system_tokens)) AS segment FROM summed),
placed AS (SELECT *, max(nth) OVER (PARTITION BY conv_id, segment) AS last_nth FROM roomy),
hops AS (
    SELECT s.conv_id, s.nth, s.p, s.system_chars, least(s.last_nth + 1, greatest(s.nth + 1, coalesce(t.nth, s.last_nth + 1))) AS next_nth
    FROM placed s ASOF LEFT JOIN placed t
        ON s.conv_id = t.conv_id AND s.p + CASE WHEN s.nth = 1 THEN 512 ELSE s.room END < t.p + t.tokens
),
starts AS (
    SELECT * FROM hops WHERE nth = 1
    UNION ALL SELECT h.* FROM starts w JOIN hops h ON h.conv_id = w.conv_id AND h.nth = w.next_nth
),
history AS (
    SELECT conv_id, sum(chars) AS chars
    FROM (
        SELECT s.conv_id, t.chars FROM starts s JOIN placed t ON s.conv_id = t.conv_id AND t.nth < s.nth
            AND s.p - t.p <= 128 AND NOT (t.nth = 1 AND t.first_role = 'system')
        UNION ALL SELECT conv_id, system_chars FROM starts WHERE nth > 1
    ) GROUP BY conv_id
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (sum(placed.chars) + coalesce(any_value(history.chars), 0))::BIGINT AS formatted_chars
FROM placed LEFT JOIN history USING (conv_id) GROUP BY conv_id
"""

# --- op11 -----------------------------------------------------------------------------------------

# The CRC of each distinct feature is computed from its bytes, bit by bit.
RESAMPLING = """
WITH bytes AS (
    SELECT list_transform(range(0, 256), lambda b: list_reduce(range(0, 8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, b)) AS crc
),
texts AS (
    SELECT row_number() OVER () AS rid, true AS target, NULL AS doc_id, text FROM benchmark
    UNION ALL SELECT -row_number() OVER (), false, doc_id, text FROM documents
),
split AS (
    SELECT rid, target, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
    FROM texts
),
features AS (
    SELECT rid, target, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
        || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS feature
    FROM split
),
counted AS (SELECT rid, target, feature, count(*) AS n FROM features GROUP BY ALL),
hashed AS (
    SELECT feature, xor(4294967295, list_reduce(list_transform(range(0, strlen(feature)),
            lambda i: ('0x' || substr(hex(encode(feature)), 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)]), 4294967295::BIGINT)) % 10000 AS bucket
    FROM (SELECT DISTINCT feature FROM counted), bytes
),
totals AS (SELECT bucket, sum(n) FILTER (NOT target) AS s, sum(n) FILTER (target) AS t FROM counted JOIN hashed USING (feature) GROUP BY bucket),
gains AS (
    SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM totals) + 10000)::DOUBLE)
        / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM totals) + 10000)::DOUBLE))) AS gain
    FROM totals
),
weights AS (SELECT rid, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM counted JOIN hashed USING (feature) JOIN gains USING (bucket) GROUP BY rid),
scored AS (
    SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
            / 4294967296::DOUBLE)))::BIGINT AS score
    FROM split LEFT JOIN weights USING (rid) WHERE NOT target
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
        5 * count(*) OVER (PARTITION BY n_words >= 20) // 100 AS drawn
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM ranked
"""

# --- op12 -----------------------------------------------------------------------------------------

LINES = """
WITH split AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT rid, doc_id, ls[i] AS line, i FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM split)),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
),
marked AS (SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM keyed)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid
"""

SQL = {
    "op2_secret_scan": _secrets(),
    "op3_warc": WARC,
    "op4_embedding_dedup": VECTORS,
    "op9_minhash_dedup": MINHASH,
    "minhash_dedup_by_counts": MINHASH_OF_COUNTS,
    "op10_chat_format": CHAT,
    "op11_importance_resampling": RESAMPLING,
    "op12_line_dedup": LINES,
}
