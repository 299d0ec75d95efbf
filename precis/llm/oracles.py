"""DuckDB statements of the queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"


def _words(text: str) -> str:
    """Words of a text with A-Z lowered."""
    low = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({low}, '{WORD}')"


DECONTAMINATION = f"""
WITH items AS (SELECT item_id, {_words("text")} AS words FROM benchmark),
sized AS (SELECT *, len(words) AS n, least(5, len(words)) AS k FROM items WHERE len(words) > 0),
item_parts AS (
    SELECT item_id, n, k, s, count(*) AS ci FROM (
        SELECT item_id, n, k, array_to_string(words[p:p + k - 1], ' ') AS s
        FROM (SELECT *, unnest(range(1, n - k + 2)) AS p FROM sized)
    ) GROUP BY ALL
),
docs AS (SELECT doc_id, words, len(words) AS nd FROM (SELECT doc_id, {_words("text")} AS words FROM documents)),
doc_parts AS (
    SELECT doc_id, nd, k, p, array_to_string(words[p:p + k - 1], ' ') AS s
    FROM (SELECT *, unnest(range(1, nd - k + 2)) AS p FROM docs, (SELECT DISTINCT k FROM sized))
),
hits AS (
    SELECT doc_id, item_id, nd, least(n, nd) AS size, n, k, p, s, ci FROM doc_parts JOIN item_parts USING (k, s)
),
windows AS (
    SELECT DISTINCT doc_id, item_id, size, n, k,
        unnest(range(greatest(1, p + k - size), least(p, nd - size + 1) + 1)) AS start
    FROM hits
),
shared AS (
    SELECT doc_id, item_id, w.start, w.size, w.n, w.k, s, least(count(*), any_value(ci)) AS both_
    FROM windows w JOIN hits h USING (doc_id, item_id)
    WHERE h.p BETWEEN w.start AND w.start + w.size - w.k
    GROUP BY doc_id, item_id, w.start, w.size, w.n, w.k, s
),
scored AS (
    SELECT doc_id, item_id, start, sum(both_) / ((size - k + 1) + (n - k + 1) - sum(both_)) AS similarity
    FROM shared GROUP BY doc_id, item_id, start, size, n, k
)
SELECT doc_id, item_id, start - 1 AS start, similarity::DOUBLE AS similarity
FROM scored WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""

REPEATED_SPANS = f"""
WITH cut AS (
    SELECT doc_id, string_split(regexp_replace(coalesce(text, ''),
        '([.!?][\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]*\\n[\\x20\\x09-\\x0D]*)', '\\1' || chr(1), 'g'), chr(1)) AS parts
    FROM documents
),
parts AS (
    SELECT doc_id, place, part, {_words("part")} AS words FROM (
        SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM cut
    )
),
sent AS (
    SELECT *, row_number() OVER doc - 1 AS i, sum(len(words)) OVER doc AS until,
        sum(len(words)) OVER doc - len(words) AS since
    FROM parts WHERE len(words) > 0
    WINDOW doc AS (PARTITION BY doc_id ORDER BY place)
),
docs AS (SELECT doc_id, flatten(list(words ORDER BY place)) AS words FROM parts GROUP BY doc_id),
runs AS (
    SELECT doc_id, i AS first, i AS last, since, until FROM sent WHERE len(words) >= 50
    UNION
    SELECT a.doc_id, a.i, min(b.i), a.since, min(b.until)
    FROM sent a JOIN sent b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i + 1 AND a.i + 20 AND b.until - a.since >= 20
    WHERE len(a.words) < 50 GROUP BY a.doc_id, a.i, a.since
    UNION
    SELECT a.doc_id, max(b.i), a.i, max(b.since), a.until
    FROM sent a JOIN sent b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i - 20 AND a.i - 1 AND a.until - b.since >= 20
    WHERE len(a.words) < 50 GROUP BY a.doc_id, a.i, a.until
),
named AS (SELECT doc_id, first, last, array_to_string(words[since + 1:until], ' ') AS run FROM runs JOIN docs USING (doc_id)),
repeats AS (
    SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, first) > 1
),
gone AS (
    SELECT DISTINCT doc_id, place FROM repeats JOIN sent USING (doc_id) WHERE i BETWEEN first AND last
)
SELECT doc_id,
    CASE WHEN any_value(d.text) IS NULL THEN NULL
        ELSE string_agg(CASE WHEN gone.place IS NULL THEN part ELSE '' END, '' ORDER BY parts.place) END AS text,
    (count(*) FILTER (WHERE len(words) > 0))::INTEGER AS n_sentences, count(gone.place)::INTEGER AS n_removed
FROM parts JOIN documents d USING (doc_id) LEFT JOIN gone USING (doc_id, place)
GROUP BY doc_id
"""


def url_filter(sites, words) -> str:
    """Statement of the URL query for its rules."""
    listed = ", ".join(f"('{v}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{r}')" for v, r in sites)
    spam = " OR ".join(f"contains(host, '{w}')" for w in words)
    return f"""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
),
rules(verdict, site, start, rule) AS (VALUES {listed}),
fits AS (
    SELECT page_id, r.verdict, r.rule FROM parts JOIN rules r
    ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, start)
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(r.rule) DESC) = 1
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN {spam} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""


QUOTATION_LINKING = f"""
WITH RECURSIVE msgs AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST) - 1 AS pos
    FROM conversations
),
raw AS (
    SELECT conv_id, pos, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM msgs
),
led AS (SELECT *, regexp_extract(line, '^[ \\t]*>[> \\t]*') AS lead_ FROM raw),
lines AS (
    SELECT conv_id, pos, i, line, length(lead_) - length(replace(lead_, '>', '')) AS level,
        {_words("substr(line, length(lead_) + 1)")} AS words
    FROM led
),
grouped AS (SELECT *, i - row_number() OVER (PARTITION BY conv_id, pos, level ORDER BY i) AS passage FROM lines),
units AS (
    SELECT conv_id, pos, level, true AS whole, array_to_string(flatten(list(words ORDER BY i)), ' ') AS s
    FROM grouped GROUP BY conv_id, pos, level, CASE WHEN level > 0 THEN passage END
    HAVING len(flatten(list(words))) > 0
    UNION ALL
    SELECT conv_id, pos, level, false, array_to_string(words, ' ') FROM lines WHERE len(words) >= 3
),
found AS (
    SELECT q.conv_id, q.pos, q.level, q.whole, max(o.pos) AS linked
    FROM (SELECT *, row_number() OVER () AS unit FROM units WHERE level > 0) q
    JOIN units o ON o.conv_id = q.conv_id AND o.level = 0 AND o.s = q.s AND o.pos < q.pos
    GROUP BY q.conv_id, q.pos, q.level, q.whole, q.unit
),
links AS (
    SELECT conv_id, pos, linked FROM (
        SELECT conv_id, pos, level, whole, linked, count(*) AS n FROM found GROUP BY ALL
    )
    QUALIFY row_number() OVER (PARTITION BY conv_id, pos ORDER BY level, whole DESC, n DESC, linked DESC) = 1
),
nodes AS (
    SELECT m.conv_id, m.pos, coalesce(linked, CASE WHEN m.pos > 0 THEN m.pos - 1 END) AS parent
    FROM msgs m LEFT JOIN links l ON m.conv_id = l.conv_id AND m.pos = l.pos
),
paths AS (
    SELECT conv_id, pos, parent, [pos] AS path FROM nodes WHERE parent IS NULL
    UNION ALL
    SELECT n.conv_id, n.pos, n.parent, list_append(p.path, n.pos)
    FROM nodes n JOIN paths p ON n.conv_id = p.conv_id AND n.parent = p.pos
),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY path) - 1 AS position FROM paths),
bodies AS (
    SELECT conv_id, pos, max(level) > 0 AS quotes,
        coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE level = 0), '') AS body
    FROM lines GROUP BY conv_id, pos
),
counts AS (SELECT conv_id, pos, count(*) AS n FROM units WHERE level > 0 GROUP BY conv_id, pos)
SELECT m.conv_id, m.turn, m.role, a.position, b.position AS reply_to, coalesce(c.n, 0)::INTEGER AS n_quotes,
    '<|' || coalesce(m.role, 'unknown') || '|>' || chr(10) || replace(
        CASE WHEN quotes THEN regexp_replace(body, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') ELSE body END,
        '<|', '< |') || '<|end|>' || chr(10) AS text
FROM msgs m
JOIN placed a ON a.conv_id = m.conv_id AND a.pos = m.pos
LEFT JOIN placed b ON b.conv_id = a.conv_id AND b.pos = a.parent
JOIN bodies t ON t.conv_id = m.conv_id AND t.pos = m.pos
LEFT JOIN counts c ON c.conv_id = m.conv_id AND c.pos = m.pos
"""


# crc32's table by its polynomial (a fixed value), as a list.
_CRC_TABLE = """crc AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(
            list_prepend(i, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
        ) AS v FROM range(256) r(i)
    )
)"""


def _crc32(x: str) -> str:
    """Unsigned crc32 of a text's bytes; ``t`` is the list above."""
    code = f"('0x' || substr(hex(encode({x})), 2 * i + 1, 2))::BIGINT"
    steps = f"list_prepend(4294967295, list_transform(range(octet_length(encode({x}))), lambda i: {code}))"
    return f"xor(4294967295, list_reduce({steps}, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)))"


def _folded(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# Words of one edit share what is left of them without one place, or one of them is that.
SPELLING_VARIANTS = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
    SELECT doc_id, w, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all({_folded("text")}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents
    ) GROUP BY ALL
),
hashed AS (SELECT w, n, {_crc32("doc_id::VARCHAR || ':' || w")} AS h FROM runs, crc),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % 199 = 0
            THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word
        FROM hashed
    ) GROUP BY word HAVING length(word) >= 6 AND sum(n) >= 5
),
less AS (
    SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words)
),
pairs AS (
    SELECT x.word, y.word AS other FROM less x JOIN less y USING (rest, p) WHERE x.word <> y.word
    UNION SELECT x.word, y.word FROM less x JOIN words y ON x.rest = y.word
    UNION SELECT y.word, x.word FROM less x JOIN words y ON x.rest = y.word
),
best AS (
    SELECT p.word, count(*) AS n_near, first(p.other ORDER BY o.n DESC, p.other) AS other, max(o.n) AS other_n
    FROM pairs p JOIN words o ON p.other = o.word GROUP BY p.word
),
forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)
),
walk AS (
    SELECT word, word AS root FROM forms
    UNION SELECT k.word, f.form FROM walk k JOIN forms f ON k.root = f.word WHERE f.form IS NOT NULL
),
ends AS (SELECT k.word, k.root FROM walk k JOIN forms f ON k.root = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""

IMPORTANCE_RESAMPLING = f"""
WITH {_CRC_TABLE},
found AS (
    SELECT 0 AS kind, doc_id AS key, {_folded("text")} AS low FROM documents
    UNION ALL SELECT 1, item_id, {_folded("text")} FROM benchmark
),
words AS (
    SELECT kind, key, w, count(*) AS n FROM (
        SELECT kind, key, unnest(regexp_extract_all(low, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM found
    ) GROUP BY ALL
),
buckets AS (SELECT w, {_crc32("w")} % 10000 AS bucket FROM (SELECT DISTINCT w FROM words), crc),
placed AS (SELECT kind, key, bucket, n FROM words JOIN buckets USING (w)),
totals AS (
    SELECT bucket, coalesce(sum(n) FILTER (kind = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 1), 0)::DOUBLE AS t
    FROM placed GROUP BY bucket
),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM totals) + 10000)
        / ((s + 1) * ((SELECT sum(t) FROM totals) + 10000)))) AS gain FROM totals
),
weighed AS (
    SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight
    FROM documents LEFT JOIN (
        SELECT key AS doc_id, sum(n) AS n_features, floor(sum(n * gain) / sum(n)) AS weight
        FROM placed JOIN gains USING (bucket) WHERE kind = 0 GROUP BY key
    ) USING (doc_id)
),
scored AS (
    SELECT *, weight + floor(-1000 * ln(-ln((
        ('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM weighed
),
able AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n * 10 // 100 THEN rank END AS rank
FROM scored LEFT JOIN able USING (doc_id)
"""
