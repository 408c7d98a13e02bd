"""DuckDB SQL for the operators that SQL can express."""

SQL: dict[str, str] = {}

#: words of every document in order, and the base measures of the quality rules
_QUALITY = r"""
WITH words AS (
  SELECT doc_id, source, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {docs})
), triples AS (
  SELECT doc_id, i, word || ' ' || lead(word, 1) OVER d || ' ' || lead(word, 2) OVER d AS w3
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w3) AS n FROM triples WHERE w3 IS NOT NULL) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM {docs})
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line
), dup AS (SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines FROM lines GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars FROM words GROUP BY doc_id),
measures AS (
  SELECT d.doc_id, d.source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM {docs} d LEFT JOIN counts USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)
), failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         10 * n_symbols > n_words OR 10 * n_dup_lines > n_words OR word_chars < 3 * n_words OR word_chars > 12 * n_words AS soft_failed
  FROM measures
), hosts AS (
  SELECT source, count(*) AS docs, sum((base_failed OR soft_failed)::INT)::BIGINT AS failures FROM failed GROUP BY source
), moments AS (SELECT avg(failures / docs) AS mean, var_pop(failures / docs) AS var FROM hosts
), prior AS (SELECT mean, CASE WHEN var > 0 THEN greatest(1.0, mean * (1 - mean) / var - 1) ELSE 1.0 END AS weight FROM moments
), bad AS (SELECT source, (failures + mean * weight) / (docs + weight) >= 0.5 AS bad FROM hosts, prior)
"""

SQL["op3_host_quality"] = _QUALITY.format(docs="documents") + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (bad AND soft_failed) AS kept
FROM failed f JOIN bad b ON f.source IS NOT DISTINCT FROM b.source
"""

SQL["op5_decontaminate"] = r"""
WITH words AS (
  SELECT kind, id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM (
    SELECT kind, id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark))
), patterns AS (
  SELECT DISTINCT id AS item, least(n, 10) AS k, string_agg(word, ' ') OVER (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS p, i, n
  FROM words WHERE kind = 'b'
), whole AS (SELECT DISTINCT item, k, p FROM patterns WHERE i <= n - k + 1
), sizes AS (SELECT DISTINCT k FROM whole
), tens AS (
  SELECT id, i, n, list(word) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS w FROM words WHERE kind = 'd'
), found AS (
  SELECT t.id, t.i, s.k, item FROM tens t JOIN sizes s ON t.i <= t.n - s.k + 1
  JOIN whole x ON x.k = s.k AND x.p = array_to_string(t.w[1:s.k], ' ')
), hits AS (
  SELECT id, count(DISTINCT i + o) AS n_hit FROM (SELECT DISTINCT id, i, k FROM found) f, (SELECT unnest(range(10)) AS o) r WHERE o < k GROUP BY id
), items AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT id, item::VARCHAR AS item FROM found) GROUP BY id
), counts AS (SELECT id, count(*) AS n_words FROM words WHERE kind = 'd' GROUP BY id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN counts c ON c.id = d.doc_id LEFT JOIN hits h ON h.id = d.doc_id LEFT JOIN items t ON t.id = d.doc_id
"""

SQL["op2_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages
), g AS (
  SELECT payload, max(page_id) AS response FROM p WHERE payload_bytes >= 1000 GROUP BY payload HAVING count(*) > 1
)
SELECT page_id, payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN response IS NULL OR response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM p LEFT JOIN g ON p.payload = g.payload
"""

SQL["op9_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT rid, i, array_to_string(w[i:i + 34], ' ') AS k FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY k) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT rid, i + o AS i FROM twice, (SELECT unnest(range(35)) AS o)
), words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (
  SELECT w.rid, string_agg(word, ' ' ORDER BY w.i) AS text, count(*) AS n FROM words w ANTI JOIN gone g ON w.rid = g.rid AND w.i = g.i GROUP BY w.rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (rid)
"""

SQL["op7_near_dup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT p.a, p.b FROM pairs p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 75 * (x.n + y.n - c)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.id, e.b FROM reach r JOIN edges e ON r.other = e.a
), component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN component ON id = d.doc_id
"""


def _secrets_sql() -> str:
    """Matches of each pattern with their places, base spans, and windows of candidates."""
    from quillstream.llm import secrets as S

    quote = lambda text: "'" + text.replace("'", "''") + "'"
    # RE2 has no look-around or back references: whole alphanumeric runs, and each character eight times
    eight = "|".join(f"[{c}]{{8}}" if c != "-" else "-{8}" for c in S.CLASSES[0].alphabet)
    allow = [quote(eight if a == r"(.)\1{7}" else a) for a in S.ALLOW]
    patterns = {"assign": S.ASSIGN, "access": S.ACCESS, "hex": S.HEX, S.CLASSES[0].name: S.CLASSES[0].candidate, S.CLASSES[1].name: r"[0-9A-Za-z]{20,}"}
    found = " UNION ALL ".join(
        f"SELECT doc_id, {quote(kind)} AS kind, unnest(m) AS match, unnest(g[1:len(m)]) AS gap, generate_subscripts(m, 1) AS i "
        f"FROM (SELECT doc_id, regexp_extract_all(t, {quote(p)}) AS m, string_split_regex(t, {quote(p)}) AS g FROM d) WHERE len(m) > 0"
        for kind, p in patterns.items())
    classes = ", ".join(f"({quote(c.name)}, {n + 3}, {c.window}, {c.bits})" for n, c in enumerate(S.CLASSES))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
placed AS (
  SELECT doc_id, kind, match, sum(length(gap) + length(match)) OVER (PARTITION BY doc_id, kind ORDER BY i)::BIGINT AS stop FROM found
), base AS (
  SELECT doc_id, kind, list_position(['assign', 'access', 'hex'], kind) - 1 AS o, stop - length(match) AS start, stop FROM placed
  WHERE kind IN ('access', 'hex') OR kind = 'assign' AND length(regexp_extract(match, {quote(S.ASSIGN)}, 2)) >= {S.ASSIGN_MIN}
), candidates AS (
  SELECT doc_id, kind, o, size, bits, match, stop - length(match) AS start
  FROM placed JOIN (VALUES {classes}) AS c(name, o, size, bits) ON kind = name
  WHERE NOT ({" OR ".join(f"regexp_matches(match, {a})" for a in allow)}) AND (kind <> 'upper_hex' OR regexp_full_match(match, '[0-9A-F]+'))
), windows AS (
  SELECT *, unnest(range(1, length(match) - size + 2)) AS i FROM candidates
), counts AS (
  SELECT doc_id, kind, o, start, i, size, bits, ch, count(*) AS n
  FROM (SELECT doc_id, kind, o, start, i, size, bits, unnest(string_split(substr(match, i, size), '')) AS ch FROM windows) GROUP BY ALL
), hits AS (
  SELECT doc_id, kind, o, start, start + i - 1 AS low, start + i - 1 + size AS high FROM counts
  GROUP BY doc_id, kind, o, start, i, size, bits HAVING -sum(n / size * log2(n / size)) >= bits - 1e-9
), runs AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id, kind, start ORDER BY low) AS run FROM (
    SELECT *, CASE WHEN low <= lag(high) OVER (PARTITION BY doc_id, kind, start ORDER BY low) THEN 0 ELSE 1 END AS new FROM hits)
), added AS (
  SELECT doc_id, 'entropy_' || kind AS kind, o, min(low) AS start, max(high) AS stop FROM runs GROUP BY doc_id, kind, o, start, run
), spans AS (
  SELECT doc_id, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o, stop) AS spans
  FROM (SELECT doc_id, kind, o, start, stop FROM base UNION ALL SELECT doc_id, kind, o, start, stop FROM added) GROUP BY doc_id
), base_spans AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o, stop) AS b
  FROM base GROUP BY doc_id
), n_added AS (SELECT doc_id, count(*) AS n_entropy FROM added GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
FROM d LEFT JOIN base_spans USING (doc_id) LEFT JOIN spans USING (doc_id) LEFT JOIN n_added USING (doc_id)
"""


SQL["op1_secrets"] = _secrets_sql()

#: crc32 by its table, which is built from the polynomial
SQL["op13_resampling"] = r"""
WITH tab AS MATERIALIZED (
  SELECT list(c ORDER BY b) AS k FROM (
    SELECT b, list_reduce([b] || range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(b))
), texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), words AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), grams AS (
  SELECT kind, id, g, count(*) AS n FROM (
    SELECT kind, id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                            || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM words) GROUP BY ALL
), buckets AS (
  SELECT g, xor(list_reduce([4294967295] || list_transform(range(1, strlen(g) + 1), lambda i: ('0x' || substr(hex(encode(g)), 2 * i - 1, 2))::BIGINT),
                            lambda c, b: xor(c >> 8, k[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT g FROM grams), tab
), features AS (SELECT kind, id, bucket, sum(n)::BIGINT AS n FROM grams JOIN buckets USING (g) GROUP BY ALL),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE kind = 'b'), 0) AS t FROM features GROUP BY bucket
), totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain FROM sums, totals
), weights AS (SELECT id, sum(n * gain)::BIGINT AS weight FROM features JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id),
scores AS (
  SELECT w.id AS doc_id, len(w) AS n, (len(w) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0))::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || w.id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words w LEFT JOIN weights x ON x.id = w.id WHERE kind = 'd'
), ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS eligible FROM scores WHERE n >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= 5 * eligible // 100 THEN rank END AS rank FROM scores s LEFT JOIN ranked r ON r.doc_id = s.doc_id
"""
