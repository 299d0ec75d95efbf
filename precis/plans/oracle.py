"""DuckDB statements that give the same rows as the registered queries."""

from __future__ import annotations

from precis.functions.text import SENTENCE_END, TOKEN, WORD_GAP
from precis.operators.rouge import POISSON_EDGES
from precis.operators.summarize import (
    BEAMS,
    DAMPING,
    FLOW_ONE,
    MAX_WORDS,
    MIN_CHARS,
    MIN_COUNT,
    NO_REPEAT,
    PENALTY,
    RANK_BASE,
    RANK_ONE,
    ROUNDS,
    WEIGHT_ONE,
)


# The characters of SPACES as a regular expression class.
SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _split(number: str) -> str:
    return (
        f"CASE WHEN {number} % 20 < 18 THEN 'train' WHEN {number} % 20 = 18 "
        "THEN 'validation' ELSE 'test' END"
    )


TURNS = """
turns AS (
  SELECT conv_id, turn, role, text, max(turn) OVER (PARTITION BY conv_id) AS last_turn
  FROM conversations
)"""

PAIRS = f"""{TURNS},
talk AS (
  SELECT conv_id,
         string_agg(role || ': ' || text, chr(10) ORDER BY turn) FILTER (WHERE turn < last_turn) AS dialogue,
         max(text) FILTER (WHERE turn = last_turn) AS summary,
         max(role) FILTER (WHERE turn = last_turn) AS last_role
  FROM turns GROUP BY conv_id
),
pairs AS MATERIALIZED (
  SELECT 'doc-' || doc_id AS id, substr(text, strpos(text, chr(10)) + 1) AS dialogue,
         substr(text, 1, strpos(text, chr(10)) - 1) AS summary, {_split('doc_id')} AS split
  FROM documents WHERE strpos(text, chr(10)) > 0
  UNION ALL
  SELECT 'conv-' || conv_id, dialogue, summary, {_split('conv_id')}
  FROM talk WHERE last_role = 'assistant' AND dialogue IS NOT NULL
)"""


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{SPACE}+|{SPACE}+\z', '', 'g')"


def toks(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{TOKEN}')"


def sents(x: str) -> str:
    broken = rf"regexp_replace({x}, '{SENTENCE_END}', '\1' || chr(10), 'g')"
    return (
        f"list_filter(list_transform(string_split({broken}, chr(10)), lambda s: {strip('s')}),"
        " lambda s: s <> '')"
    )


def words(x: str) -> str:
    return f"string_split_regex({x}, '{WORD_GAP}')"


def cut(x: str, n: int | str = MAX_WORDS) -> str:
    return (
        f"CASE WHEN len({words(x)}) > {n} THEN array_to_string(list_slice({words(x)}, 1, {n}), ' ')"
        f" ELSE {x} END"
    )


def grams(t: str, n: int) -> str:
    if n == 1:
        return t
    return (
        f"CASE WHEN len({t}) >= {n} THEN list_transform(range(1, len({t}) - {n} + 2),"
        f" lambda i: array_to_string(list_slice({t}, i, i + {n - 1}), ' ')) ELSE []::VARCHAR[] END"
    )


LEAD = f"""
lead AS MATERIALIZED (
  SELECT id, split, summary, {cut('first_three')} AS prediction
  FROM (SELECT id, split, summary, array_to_string(list_slice({sents('dialogue')}, 1, 3), ' ') AS first_three FROM pairs)
)"""

SENTENCES = f"""
sents AS MATERIALIZED (
  SELECT id, unnest(range(0, len(ss))) AS sent, unnest(ss) AS sentence
  FROM (SELECT id, {sents('dialogue')} AS ss FROM pairs)
),
words AS MATERIALIZED (SELECT id, sent, unnest({toks('sentence')}) AS word FROM sents),
word_counts AS MATERIALIZED (SELECT id, word, count(*) AS n FROM words GROUP BY ALL),
sent_words AS MATERIALIZED (SELECT DISTINCT id, sent, word FROM words)"""

FREQUENCY = f"""
frequency_scores AS (
  SELECT w.id, w.sent, sum(c.n) AS score FROM sent_words w JOIN word_counts c USING (id, word)
  WHERE length(word) >= {MIN_CHARS} AND n >= {MIN_COUNT} GROUP BY ALL
)"""

TFIDF = f"""
idf AS MATERIALIZED (
  SELECT word, CAST(round(1000 * ln((1.0 + (SELECT count(*) FROM pairs WHERE split = 'train')) / (1.0 + count(*)))) AS BIGINT) AS idf
  FROM (SELECT DISTINCT id, word FROM (SELECT id, unnest({toks('dialogue')}) AS word FROM pairs WHERE split = 'train'))
  GROUP BY word
),
tfidf_sums AS (
  SELECT w.id, w.sent, sum(c.n * i.idf) AS total
  FROM sent_words w JOIN word_counts c USING (id, word) JOIN idf i USING (word) GROUP BY ALL
),
tfidf_scores AS (
  SELECT id, sent, CAST(floor(total / len({words('sentence')})) AS BIGINT) AS score
  FROM tfidf_sums JOIN sents USING (id, sent)
)"""


def textrank() -> str:
    base = RANK_BASE
    steps = [
        f"""
r_base AS (
  SELECT *, CAST(floor({WEIGHT_ONE}.0::DOUBLE / sqrt(n_words)) AS BIGINT) AS a
  FROM (SELECT id, sent, word, count(*) OVER (PARTITION BY id, sent) AS n_words FROM sent_words)
),
r_word AS (SELECT *, sum(a) OVER (PARTITION BY id, word) AS word_a FROM r_base),
r0 AS MATERIALIZED (
  SELECT id, sent, word, a, {RANK_ONE}::BIGINT AS score,
         (a * sum(word_a - a) OVER (PARTITION BY id, sent))::BIGINT AS degree
  FROM r_word
)"""
    ]
    for i in range(ROUNDS):
        steps.append(
            f"""
f{i} AS (SELECT *, CASE WHEN degree > 0 THEN (score * a * {FLOW_ONE}) // degree ELSE 0 END AS flow FROM r{i}),
g{i} AS (SELECT *, sum(flow) OVER (PARTITION BY id, word) AS word_flow FROM f{i}),
r{i + 1} AS MATERIALIZED (
  SELECT id, sent, word, a, degree,
         ({base} + ({DAMPING} * ((a * sum(word_flow - flow) OVER (PARTITION BY id, sent)) // {FLOW_ONE})) // 100)::BIGINT AS score
  FROM g{i}
)"""
        )
    steps.append(f"\ntextrank_scores AS (SELECT id, sent, max(score) AS score FROM r{ROUNDS} GROUP BY ALL)")
    return ",".join(steps)


def chosen(name: str, default: str = "0") -> str:
    """Greedy choice by ``<name>_scores``, as table ``<name>``."""
    return f"""
{name}_ranked AS MATERIALIZED (
  SELECT id, sent, text, n, score, {grams('t', NO_REPEAT)} AS grams,
         row_number() OVER (PARTITION BY id ORDER BY score DESC, sent) AS rk
  FROM (
    SELECT s.id, s.sent, {cut('s.sentence')} AS text, least(len({words('s.sentence')}), {MAX_WORDS}) AS n,
           {toks('(' + cut('s.sentence') + ')')} AS t, coalesce(x.score, {default}) AS score
    FROM sents s LEFT JOIN {name}_scores x USING (id, sent)
  )
),
{name}_walk AS (
  SELECT id, 0::BIGINT AS rk, 0::BIGINT AS n, []::STRUCT(sent BIGINT, text VARCHAR)[] AS kept, []::VARCHAR[] AS grams
  FROM pairs
  UNION ALL
  SELECT id, rk, CASE WHEN ok THEN n + dn ELSE n END,
         CASE WHEN ok THEN list_append(kept, {{'sent': sent, 'text': text}}) ELSE kept END,
         CASE WHEN ok THEN list_concat(grams, dgrams) ELSE grams END
  FROM (
    SELECT w.id, r.rk, w.n, w.kept, w.grams, r.n AS dn, r.sent, r.text, r.grams AS dgrams,
           w.n + r.n <= {MAX_WORDS} AND NOT list_has_any(w.grams, r.grams) AS ok
    FROM {name}_walk w JOIN {name}_ranked r ON r.id = w.id AND r.rk = w.rk + 1
  )
),
{name} AS MATERIALIZED (
  SELECT p.id, p.split, p.summary,
         array_to_string(list_transform(list_sort(k.kept), lambda x: x.text), ' ') AS prediction
  FROM pairs p JOIN (SELECT id, arg_max(kept, rk) AS kept FROM {name}_walk GROUP BY id) k USING (id)
)"""


def beam(name: str, width: int = BEAMS, penalty: float = PENALTY) -> str:
    """The choice of a beam search among ``<name>_ranked``, as table ``beam``; choices held are rows."""
    return f"""
beam_walk AS (
  SELECT id, 0::BIGINT AS rk, 0::BIGINT AS n, 0::HUGEINT AS total, []::STRUCT(sent BIGINT, text VARCHAR)[] AS kept,
         []::VARCHAR[] AS grams, '' AS path, true AS greedy
  FROM pairs
  UNION ALL
  SELECT id, rk, n, total, kept, grams, path, greedy
  FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY total DESC, path DESC) AS place
    FROM (
      SELECT id, rk, CASE WHEN take THEN n + dn ELSE n END AS n, CASE WHEN take THEN total + score ELSE total END AS total,
             CASE WHEN take THEN list_append(kept, {{'sent': sent, 'text': text}}) ELSE kept END AS kept,
             CASE WHEN take THEN list_concat(grams, dgrams) ELSE grams END AS grams,
             path || CASE WHEN take THEN '1' ELSE '0' END AS path, greedy AND take = ok AS greedy
      FROM (
        SELECT w.id, r.rk, w.n, w.total, w.kept, w.grams, w.path, w.greedy, r.n AS dn, r.score, r.sent, r.text, r.grams AS dgrams,
               w.n + r.n <= {MAX_WORDS} AND NOT list_has_any(w.grams, r.grams) AS ok
        FROM beam_walk w JOIN {name}_ranked r ON r.id = w.id AND r.rk = w.rk + 1
      ), (SELECT unnest([true, false]) AS take) WHERE ok OR NOT take
    )
  ) WHERE place <= {width} OR greedy
),
beam AS MATERIALIZED (
  SELECT p.id, p.split, array_to_string(list_transform(list_sort(k.kept), lambda x: x.text), ' ') AS prediction
  FROM pairs p JOIN (
    SELECT id, kept FROM (SELECT *, max(rk) OVER (PARTITION BY id) AS last FROM beam_walk) WHERE rk = last
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(total::DOUBLE / pow(greatest(n, 1), {penalty}), 6) DESC, path DESC) = 1
  ) k USING (id)
)"""


def ngram_scores(source: str, n: int, name: str, key: str = "id") -> str:
    """ROUGE-n rows of ``source(key, split, prediction, summary)``, as table ``name``."""
    return f"""
{name}_t AS MATERIALIZED (
  SELECT {key}, split, {toks('prediction')} AS p, {toks('summary')} AS r FROM {source}
),
{name}_p AS (SELECT {key}, g, count(*) AS c FROM (SELECT {key}, unnest({grams('p', n)}) AS g FROM {name}_t) GROUP BY ALL),
{name}_r AS (SELECT {key}, g, count(*) AS c FROM (SELECT {key}, unnest({grams('r', n)}) AS g FROM {name}_t) GROUP BY ALL),
{name}_h AS (
  SELECT {key}, sum(least({name}_p.c, {name}_r.c)) AS hits FROM {name}_p JOIN {name}_r USING ({key}, g) GROUP BY ALL
),
{name} AS MATERIALIZED (
  SELECT {key}, split, 'rouge{n}' AS metric, hits, n_pred, n_ref, {PRF}
  FROM (
    SELECT {key}, split, coalesce(hits, 0)::BIGINT AS hits,
           greatest(len(p) - {n - 1}, 0) AS n_pred, greatest(len(r) - {n - 1}, 0) AS n_ref
    FROM {name}_t LEFT JOIN {name}_h USING ({key})
  )
)"""


PRF = """
         round(CASE WHEN n_pred > 0 THEN hits / n_pred ELSE 0 END, 6) AS precision,
         round(CASE WHEN n_ref > 0 THEN hits / n_ref ELSE 0 END, 6) AS recall,
         round(CASE WHEN hits > 0 THEN 2.0::DOUBLE * hits / (n_pred + n_ref) ELSE 0 END, 6) AS f1"""


def lcs_scores(source: str, name: str, metric: str = "rougeL") -> str:
    """ROUGE-L rows: one row of the LCS table per step, over all pairs at once."""
    return f"""
{name}_t AS MATERIALIZED (
  SELECT id, split, {toks('prediction')} AS p, {toks('summary')} AS r FROM {source}
),
{name}_cells AS (
  SELECT id, 0::BIGINT AS i, k, 0::BIGINT AS v FROM (SELECT id, unnest(range(1, len(r) + 1)) AS k FROM {name}_t)
  UNION ALL
  SELECT id, i, k, max(cell) OVER (PARTITION BY id ORDER BY k ROWS UNBOUNDED PRECEDING)
  FROM (
    SELECT id, i + 1 AS i, k,
           greatest(v, CASE WHEN p[i + 1] = r[k] THEN 1 + lag(v, 1, 0) OVER (PARTITION BY id ORDER BY k) ELSE 0 END) AS cell
    FROM {name}_cells JOIN {name}_t USING (id) WHERE i < len(p)
  )
),
{name} AS (
  SELECT id, split, '{metric}' AS metric, hits, n_pred, n_ref, {PRF}
  FROM (
    SELECT id, split, coalesce(hits, 0)::BIGINT AS hits, len(p) AS n_pred, len(r) AS n_ref
    FROM {name}_t LEFT JOIN (SELECT id, max(v) AS hits FROM {name}_cells GROUP BY id) USING (id)
  )
)"""


def union_lcs_scores(source: str, name: str) -> str:
    """ROUGE-Lsum rows for predictions of one line: LCS tables per reference line, then walked back."""
    return f"""
{name}_t AS MATERIALIZED (
  SELECT id, split, {toks('prediction')} AS p, {toks('summary')} AS r,
         list_filter(string_split(summary, chr(10)), lambda x: x <> '') AS ls FROM {source}
),
{name}_l AS MATERIALIZED (
  SELECT id, line, p, {toks('text')} AS r
  FROM (SELECT id, p, unnest(range(0, len(ls))) AS line, unnest(ls) AS text FROM {name}_t)
),
{name}_cells AS (
  SELECT id, line, 0::BIGINT AS i, k, 0::BIGINT AS v FROM (SELECT id, line, unnest(range(1, len(r) + 1)) AS k FROM {name}_l)
  UNION ALL
  SELECT id, line, i, k, max(cell) OVER (PARTITION BY id, line ORDER BY k ROWS UNBOUNDED PRECEDING)
  FROM (
    SELECT id, line, i + 1 AS i, k,
           greatest(v, CASE WHEN p[i + 1] = r[k] THEN 1 + lag(v, 1, 0) OVER (PARTITION BY id, line ORDER BY k) ELSE 0 END) AS cell
    FROM {name}_cells JOIN {name}_l USING (id, line) WHERE i < len(p)
  )
),
{name}_rows AS (SELECT id, line, i, list(v ORDER BY k) AS row FROM {name}_cells WHERE i > 0 GROUP BY ALL),
{name}_table AS MATERIALIZED (
  SELECT id, line, p, r, t FROM {name}_l JOIN (SELECT id, line, list(row ORDER BY i) AS t FROM {name}_rows GROUP BY ALL) USING (id, line)
),
{name}_walk AS (
  SELECT id, line, len(r) AS a, len(p) AS b, NULL::VARCHAR AS found FROM {name}_table
  UNION ALL
  SELECT id, line, CASE WHEN same OR NOT along_p THEN a - 1 ELSE a END, CASE WHEN same OR along_p THEN b - 1 ELSE b END,
         CASE WHEN same THEN token END
  FROM (
    SELECT w.id, w.line, a, b, r[a] AS token, r[a] = p[b] AS same,
           (CASE WHEN b > 1 THEN t[b - 1][a] ELSE 0 END) > (CASE WHEN a > 1 THEN t[b][a - 1] ELSE 0 END) AS along_p
    FROM {name}_walk w JOIN {name}_table x ON x.id = w.id AND x.line = w.line WHERE a > 0 AND b > 0
  )
),
{name}_found AS (SELECT id, found AS token, count(*) AS n FROM {name}_walk WHERE found IS NOT NULL GROUP BY ALL),
{name}_p AS (SELECT id, token, count(*) AS n FROM (SELECT id, unnest(p) AS token FROM {name}_t) GROUP BY ALL),
{name}_r AS (SELECT id, token, count(*) AS n FROM (SELECT id, unnest(r) AS token FROM {name}_t) GROUP BY ALL),
{name}_h AS (
  SELECT id, sum(least(f.n, p.n, r.n)) AS hits FROM {name}_found f JOIN {name}_p p USING (id, token) JOIN {name}_r r USING (id, token) GROUP BY id
),
{name} AS (
  SELECT id, split, 'rougeLsum' AS metric, hits, n_pred, n_ref, {PRF}
  FROM (
    SELECT id, split, coalesce(hits, 0)::BIGINT AS hits, len(p) AS n_pred, len(r) AS n_ref FROM {name}_t LEFT JOIN {name}_h USING (id)
  )
)"""


def corpus(source: str, by: str, digits: int = 6) -> str:
    means = ", ".join(
        f"round(sum(CAST(round({c} * 1000000) AS BIGINT)) / (count(*) * 1000000.0::DOUBLE), {digits}) AS {c}"
        for c in ("precision", "recall", "f1")
    )
    return f"SELECT {by}, count(*) AS n_pairs, {means} FROM {source} GROUP BY ALL"


VOCAB = f"""
vocab AS MATERIALIZED (
  SELECT token, n, row_number() OVER (ORDER BY n DESC, token) + 3 AS token_id
  FROM (
    SELECT token, count(*) AS n
    FROM (
      SELECT unnest({toks('dialogue')}) AS token FROM pairs WHERE split = 'train'
      UNION ALL SELECT unnest({toks('summary')}) FROM pairs WHERE split = 'train'
    ) GROUP BY token
  )
)"""


def encoded(source: str, column: str, n: int, name: str) -> str:
    """``(id, ids LIST)`` framed and truncated but not padded, as table ``name``."""
    return f"""
{name}_t AS (SELECT id, list_slice({toks(column)}, 1, {n - 2}) AS t FROM {source}),
{name} AS MATERIALIZED (
  SELECT s.id, list_concat([0], coalesce(x.ids, []), [2]) AS ids
  FROM {source} s LEFT JOIN (
    SELECT id, list(coalesce(token_id, 3) ORDER BY k) AS ids
    FROM (SELECT id, unnest(range(1, len(t) + 1)) AS k, unnest(t) AS token FROM {name}_t)
    LEFT JOIN vocab USING (token) GROUP BY id
  ) x USING (id)
)"""


def decoded(source: str, name: str) -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT s.id, coalesce(x.text, '') AS text FROM {source} s LEFT JOIN (
    SELECT id, string_agg(token, ' ' ORDER BY k) AS text
    FROM (SELECT id, unnest(range(1, len(ids) + 1)) AS k, unnest(ids) AS token_id FROM {source})
    JOIN vocab USING (token_id) GROUP BY id
  ) x USING (id)
)"""


def fill(ids: str, n: str, pad: int = 1) -> str:
    return f"list_concat({ids}, list_transform(range(0, {n} - len({ids})), lambda i: {pad}))"


def with_(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(parts) + "\n"


STATUS = "CASE WHEN text IS NULL THEN 'missing' WHEN {n} < 10 THEN 'too_short' ELSE 'ok' END"

PROFILE = f"""
profile AS (
  SELECT split, c.column, count(*) AS n_rows,
         count(*) FILTER (WHERE value IS NULL OR regexp_full_match(value, '{SPACE}*')) AS n_blank,
         count(value) AS n_values, sum(length(value))::BIGINT AS n_chars
  FROM (
    SELECT split, unnest([{{'column': 'dialogue', 'value': dialogue}}, {{'column': 'summary', 'value': summary}}], recursive := true) FROM pairs
  ) c GROUP BY ALL
)"""

# The splits that the validation queries look at: those of the pairs, an empty one, and
# one whose summaries are numbers. Types come from the catalogue and the values.
CHECKED = """
required AS (SELECT unnest(['train', 'test', 'validation', 'empty', 'numbers', 'absent']) AS split),
registry AS (SELECT unnest(['train', 'test', 'validation', 'empty', 'numbers']) AS split),
wanted AS (SELECT unnest(['id', 'dialogue', 'summary', 'speaker']) AS col),
columns AS (
  SELECT split, column_name AS col, lower(data_type) AS kind
  FROM registry, (SELECT * FROM (DESCRIBE SELECT id, dialogue, summary FROM pairs) d(column_name, data_type, a, b, c, e))
  WHERE split <> 'numbers'
  UNION ALL
  SELECT 'numbers', CASE column_name WHEN 'doc_id' THEN 'id' WHEN 'text' THEN 'dialogue' ELSE 'summary' END,
         CASE column_name WHEN 'doc_id' THEN 'varchar' ELSE lower(data_type) END
  FROM information_schema.columns WHERE table_name = 'documents' AND column_name IN ('doc_id', 'text', 'n_chars')
),
typed AS (SELECT split, col, CASE kind WHEN 'varchar' THEN 'string' ELSE kind END AS kind FROM columns),
all_rows AS (
  SELECT split, dialogue, summary FROM pairs
  UNION ALL SELECT 'numbers', text, n_chars::VARCHAR FROM documents
),
split_sizes AS (SELECT g.split, count(r.split) AS n_rows FROM registry g LEFT JOIN all_rows r ON r.split = g.split GROUP BY g.split),
exists_checks AS (
  SELECT 'split_' || split || '_exists' AS check_key, split IN (SELECT split FROM pairs UNION ALL SELECT unnest(['empty', 'numbers'])) AS passed, NULL::VARCHAR AS detail FROM required
),
column_checks AS (
  SELECT 'split_' || g.split || '_col_' || w.col AS check_key, c.col IS NOT NULL AS passed, NULL::VARCHAR AS detail
  FROM registry g CROSS JOIN wanted w LEFT JOIN typed c ON c.split = g.split AND c.col = w.col
),
type_checks AS (
  SELECT 'split_' || split || '_' || col || '_type' AS check_key, kind = 'string' AS passed, kind || ', expected string' AS detail FROM typed
),
non_empty_checks AS (SELECT 'split_' || split || '_non_empty' AS check_key, n_rows > 0 AS passed, n_rows || ' rows' AS detail FROM split_sizes)"""


def blank_checks(source: str, splits: str) -> str:
    """No-blank checks of ``source(split, dialogue, summary)`` for the splits of a table."""
    blank = f"(value IS NULL OR regexp_full_match(value, '{SPACE}*'))"
    return f"""
  SELECT 'split_' || split || '_' || col || '_no_nulls' AS check_key, n = 0 AS passed, n || ' blank' AS detail
  FROM (
    SELECT g.split, col, count(*) FILTER (WHERE v.split IS NOT NULL AND {blank}) AS n
    FROM {splits} g CROSS JOIN (SELECT unnest(['dialogue', 'summary']) AS col) c
    LEFT JOIN (
      SELECT split, 'dialogue' AS name, dialogue AS value FROM {source} UNION ALL SELECT split, 'summary', summary FROM {source}
    ) v ON v.split = g.split AND v.name = c.col GROUP BY ALL
  )"""


REPORT = f"""{CHECKED},
checks AS (
  SELECT * FROM exists_checks UNION ALL SELECT * FROM column_checks UNION ALL SELECT * FROM type_checks
  UNION ALL SELECT * FROM non_empty_checks UNION ALL {blank_checks("all_rows", "registry")}
),
own AS (SELECT unnest(['train', 'test', 'validation']) AS split),
plain_checks AS (
  SELECT check_key, passed FROM exists_checks WHERE split_part(check_key, '_', 2) IN (SELECT split FROM own)
  UNION ALL
  SELECT check_key, passed FROM column_checks
  WHERE split_part(check_key, '_', 2) IN (SELECT split FROM own) AND NOT ends_with(check_key, 'speaker')
  UNION ALL
  SELECT 'split_' || split || '_non_empty', (SELECT count(*) FROM pairs p WHERE p.split = own.split) > 0 FROM own
  UNION ALL SELECT check_key, passed FROM ({blank_checks("pairs", "own")})
)"""

BATCHES = """
texts AS (
  SELECT batch, turn AS position, text, count(*) OVER (PARTITION BY batch) AS n
  FROM (SELECT CASE WHEN conv_id % 11 <> 0 THEN conv_id // 2 END AS batch, turn, text FROM conversations)
),
checked AS (
  SELECT batch, position, text,
         CASE WHEN batch IS NULL THEN 'missing' WHEN n NOT BETWEEN 1 AND 10 THEN 'batch_size' WHEN text IS NULL THEN 'missing'
              WHEN length(text) < 10 THEN 'too_short' ELSE 'ok' END AS status
  FROM texts
)"""


PLACES = """(
  SELECT id, split, row_number() OVER (PARTITION BY split ORDER BY id) - 1 AS pos
  FROM (SELECT id, CASE WHEN split <> 'test' THEN split END AS split FROM pairs)
)"""
# Very many rows under each of two ids, and those of the test split without one.
SHARED_ID = "CASE WHEN split <> 'test' THEN split_part(id, '-', 1) END AS id"


def lead_text(x: str, n: int | str = MAX_WORDS) -> str:
    return cut(f"array_to_string(list_slice({sents(x)}, 1, 3), ' ')", n)


def budget(number: str) -> str:
    """A request's own number of words."""
    return f"CASE WHEN {number} % 7 <> 0 THEN ({number} % 31)::INT END"


def _size(b: str) -> str:
    def unit(power: int, name: str) -> str:
        return f"printf('%.1f {name}', {b} / {1024**power}.0::DOUBLE)"

    return (
        f"CASE WHEN {b} < 1024 THEN {b} || ' B' WHEN {b} < {1024**2} THEN {unit(1, 'KB')}"
        f" WHEN {b} < {1024**3} THEN {unit(2, 'MB')} ELSE {unit(3, 'GB')} END"
    )


def bootstrap() -> str:
    weight = f"CASE WHEN draw < '{POISSON_EDGES[0]}' THEN 0"
    for k, edge in enumerate(POISSON_EDGES[1:], 1):
        weight += f" WHEN draw < '{edge}' THEN {k}"
    weight += f" ELSE {len(POISSON_EDGES)} END"
    return (
        with_(
            PAIRS, LEAD, ngram_scores("lead", 1, "s1"), ngram_scores("lead", 2, "s2"), lcs_scores("lead", "sl"),
            union_lcs_scores("lead", "su"), recursive=True,
        )
        + f""",
draws AS (
  SELECT id, four * 4 + place AS replicate, substr(digest, 8 * place + 1, 8) AS draw
  FROM (SELECT id, four, md5(id || ':' || four) AS digest FROM pairs, range(0, 250) AS f(four)), range(0, 4) AS q(place)
),
weights AS (SELECT id, replicate, {weight} AS w FROM draws),
means AS (
  SELECT split, metric, replicate, sum(w * CAST(round(f1 * 1000000) AS BIGINT)) / (sum(w) * 1000000.0::DOUBLE) AS mean
  FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM sl UNION ALL SELECT * FROM su) JOIN weights USING (id) WHERE w > 0 GROUP BY ALL
)
SELECT split, metric, round(quantile_cont(mean, 0.025), 6) AS low, round(quantile_cont(mean, 0.5), 6) AS mid,
       round(quantile_cont(mean, 0.975), 6) AS high
FROM means GROUP BY ALL"""
    )


def compared() -> str:
    """Mean scores of all methods, as table ``scores(model, split, metric, n_pairs, precision, recall, f1)``."""
    methods = ("lead", "frequency", "tfidf", "textrank")
    union = " UNION ALL ".join(f"SELECT '{m}/' || id AS id, split, prediction, summary FROM {m}" for m in methods)
    scored = " UNION ALL ".join(f"SELECT split_part(id, '/', 1) AS model, * FROM {t}" for t in ("s1", "s2", "sl", "su"))
    return (
        with_(
            PAIRS, LEAD, SENTENCES, FREQUENCY, chosen("frequency"), TFIDF, chosen("tfidf"),
            textrank(), chosen("textrank", str(RANK_BASE)),
            f"\npredicted AS MATERIALIZED ({union})",
            ngram_scores("predicted", 1, "s1"), ngram_scores("predicted", 2, "s2"),
            lcs_scores("predicted", "sl"), union_lcs_scores("predicted", "su"),
            recursive=True,
        )
        + f",\nscores AS ({corpus(f'({scored})', 'model, split, metric')})\n"
    )


def wide(columns: str = "model, split") -> str:
    kinds = ", ".join(f"max(f1) FILTER (WHERE metric = '{m}') AS {m}" for m in ("rouge1", "rouge2", "rougeL", "rougeLsum"))
    return f"SELECT {columns}, {kinds} FROM scores GROUP BY ALL"


def compute_metrics() -> str:
    texts = """
texts AS MATERIALIZED (SELECT p.id, 'all' AS split, p.text AS prediction, r.text AS summary FROM pt p JOIN rt r USING (id))"""
    scores = "(SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM sl UNION ALL SELECT * REPLACE ('rougeLsum' AS metric) FROM sl)"
    return (
        with_(
            PAIRS, LEAD, VOCAB,
            encoded("lead", "prediction", 128, "pe"), encoded("lead", "summary", 128, "re"),
            decoded("pe", "pt"), decoded("re", "rt"), texts,
            ngram_scores("texts", 1, "s1"), ngram_scores("texts", 2, "s2"), lcs_scores("texts", "sl"),
            recursive=True,
        )
        + corpus(scores, "metric", 4)
    )


# The greedy choice of sentences: words and pairs of the reference are numbered, every
# sentence has their counts in a row of that order, and each step takes the best one more.
GREEDY = f"""
ref_t AS MATERIALIZED (SELECT id, {toks('summary')} AS t FROM pairs),
sent_t AS MATERIALIZED (SELECT id, sent, {toks('sentence')} AS t FROM sents),
ref_g AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY n, g) AS k FROM (
    SELECT id, n, g, count(*) AS c FROM (
      SELECT id, 1 AS n, unnest(t) AS g FROM ref_t UNION ALL SELECT id, 2, unnest({grams('t', 2)}) FROM ref_t
    ) GROUP BY ALL
  )
),
wanted AS MATERIALIZED (
  SELECT id, list(c ORDER BY k) AS want, count(*) FILTER (n = 1) AS m, sum(c) FILTER (n = 1) AS r1, coalesce(sum(c) FILTER (n = 2), 0) AS r2
  FROM ref_g GROUP BY id
),
sent_g AS MATERIALIZED (
  SELECT id, sent, k, count(*) AS c FROM (
    SELECT id, sent, 1 AS n, unnest(t) AS g FROM sent_t UNION ALL SELECT id, sent, 2, unnest({grams('t', 2)}) FROM sent_t
  ) JOIN ref_g r USING (id, n, g) GROUP BY ALL
),
rows_g AS MATERIALIZED (
  SELECT x.id, x.sent, len(x.t) AS n1, greatest(len(x.t) - 1, 0) AS n2, list(coalesce(c.c, 0) ORDER BY r.k) AS have
  FROM sent_t x JOIN ref_g r ON r.id = x.id LEFT JOIN sent_g c ON c.id = x.id AND c.sent = x.sent AND c.k = r.k
  GROUP BY x.id, x.sent, x.t
),
greedy_walk AS (
  SELECT id, 0 AS pick, -1::BIGINT AS sent, 0::HUGEINT AS score, []::BIGINT[] AS chosen, want AS rest, 0::HUGEINT AS h1, 0::HUGEINT AS h2, 0::HUGEINT AS p1, 0::HUGEINT AS p2
  FROM wanted
  UNION ALL
  SELECT id, pick + 1, sent, total, list_append(chosen, sent), list_transform(range(1, len(rest) + 1), lambda i: rest[i] - more[i]), h1, h2, p1, p2
  FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY total DESC, sent) AS place
    FROM (
      SELECT *, (2000000 * h1) // greatest(p1 + r1, 1) + (2000000 * h2) // greatest(p2 + r2, 1) AS total
      FROM (
        SELECT w.id, w.pick, w.score, w.chosen, w.rest, x.sent, x.more, g.r1, g.r2, w.p1 + x.n1 AS p1, w.p2 + x.n2 AS p2,
               w.h1 + list_sum(list_slice(x.more, 1, g.m)) AS h1, w.h2 + coalesce(list_sum(list_slice(x.more, g.m + 1, len(x.more))), 0) AS h2
        FROM greedy_walk w JOIN wanted g ON g.id = w.id JOIN LATERAL (
          SELECT y.id, y.sent, y.n1, y.n2, list_transform(range(1, len(y.have) + 1), lambda i: least(y.have[i], w.rest[i])) AS more
          FROM rows_g y WHERE y.id = w.id AND NOT list_contains(w.chosen, y.sent)
        ) x ON true
      )
    )
  ) WHERE place = 1 AND total > score
),
greedy AS MATERIALIZED (SELECT id, pick, sent, score::BIGINT AS score FROM greedy_walk WHERE pick > 0)"""


def features() -> str:
    return (
        with_(PAIRS, SENTENCES, GREEDY, recursive=True)
        + f""",
ref AS MATERIALIZED (SELECT DISTINCT id, word FROM (SELECT id, unnest({toks('summary')}) AS word FROM pairs)),
ref_n AS (SELECT id, count(*) AS n_ref FROM ref GROUP BY id),
per_sent AS (
  SELECT s.id, s.sent, count(w.word) AS n_distinct, count(r.word) AS shared,
         coalesce(sum(CASE WHEN length(w.word) >= {MIN_CHARS} AND c.n >= {MIN_COUNT} THEN c.n ELSE 0 END), 0)::DOUBLE AS frequency
  FROM sents s LEFT JOIN sent_words w USING (id, sent) LEFT JOIN word_counts c ON c.id = s.id AND c.word = w.word
  LEFT JOIN ref r ON r.id = s.id AND r.word = w.word GROUP BY ALL
),
sized AS (
  SELECT p.*, len({toks('s.sentence')})::DOUBLE AS n_words,
         CASE WHEN n_distinct + coalesce(n_ref, 0) > 0
              THEN round(2.0::DOUBLE * shared / (n_distinct + coalesce(n_ref, 0)), 6) ELSE 0 END AS overlap
  FROM per_sent p JOIN sents s USING (id, sent) LEFT JOIN ref_n USING (id)
)
SELECT id, split, sent::INT AS sent, n_words, frequency, overlap, CASE WHEN g.pick IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS label
FROM sized JOIN pairs USING (id) LEFT JOIN greedy g USING (id, sent)"""
    )


# Every tenth run has no name.
LOSSES = """
losses AS (
  SELECT CASE WHEN user_id % 10 <> 0 THEN user_id END AS run, event_id AS step, value AS loss FROM events WHERE value IS NOT NULL
)"""


def early_stop() -> str:
    return f"""WITH {LOSSES},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY step) AS pos,
         min(loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lowest
  FROM losses
),
marked AS (
  SELECT *, max(CASE WHEN lowest IS NULL OR loss < lowest THEN pos END) OVER (PARTITION BY run ORDER BY pos) AS best_pos FROM numbered
),
stops AS (
  SELECT run, min(pos) FILTER (WHERE pos - best_pos >= 3) AS stop_pos, max(best_pos) AS final_pos FROM marked GROUP BY run
)
SELECT s.run, e.step AS stop_step, b.step AS best_step, b.loss AS best_loss
FROM stops s LEFT JOIN marked e ON e.run IS NOT DISTINCT FROM s.run AND e.pos = s.stop_pos
JOIN marked b ON b.run IS NOT DISTINCT FROM s.run AND b.pos = coalesce(s.stop_pos - 3, s.final_pos)"""


def oracle_sql() -> dict[str, str]:
    pairs, lead = with_(PAIRS), with_(PAIRS, LEAD)
    vocab = with_(PAIRS, VOCAB)
    inputs = with_(PAIRS, VOCAB, encoded("pairs", "dialogue", 1024, "e"))
    labels = with_(PAIRS, VOCAB, encoded("pairs", "summary", 128, "e"))
    text = "array_to_string"
    bare = r"regexp_replace(url, '(\.html)?/?([?#].*)?\z', '')"
    out = {
        "load_splits": pairs + "SELECT id, split, dialogue, summary FROM pairs",
        "load_renamed": "SELECT doc_id AS id, text AS dialogue, 'train' AS split FROM documents"
        " UNION ALL SELECT item_id, text, 'test' FROM benchmark",
        "dialogue_from_turns": "SELECT 'conv-' || conv_id AS id, count(*)::INT AS n_turns,"
        " string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS dialogue FROM conversations GROUP BY conv_id",
        "save_splits": pairs
        + "SELECT split, count(*) AS n_rows, sum(length(dialogue) + length(summary))::BIGINT AS n_chars FROM pairs GROUP BY split"
        " UNION ALL SELECT 'holdout', 0, 0",
        "ingest_idempotent": pairs
        + "SELECT split, count(*) FILTER (NOT ends_with(id, '7')) AS n_rows, count(*) AS n_before,"
        " 'written' AS first, 'kept' AS again, 'refused' AS changed, 'replaced' AS by_choice FROM pairs GROUP BY split",
        "json_roundtrip": "SELECT doc_id, lang, source, n_chars, text FROM documents",
        "size_units": f"SELECT doc_id, strlen(text)::INT AS length, {_size('strlen(text)')} AS size FROM documents",
        "latest_artifact": f"""
WITH found AS (
  SELECT url, regexp_extract({bare}, '/([a-z]{{2}})/[0-9]+\\z', 1) AS family,
         TRY_CAST(regexp_extract({bare}, '([0-9]+)\\z', 1) AS BIGINT) AS version FROM pages
)
SELECT family, count(*) AS n_versions, max(version) AS version, arg_max(url, (version, url)) AS path
FROM found WHERE version IS NOT NULL GROUP BY family""",
        "set_difference_check": """
SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE 'unexpected' END AS problem
FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id
WHERE d.doc_id IS NULL OR l.doc_id IS NULL""",
        "preview": pairs
        + "SELECT split, count(*) AS n_rows, min(id) AS first_id, substr(arg_min(dialogue, id), 1, 200) AS head FROM pairs GROUP BY split",
        "project_columns": pairs + "SELECT id, dialogue FROM pairs",
        "head_k": pairs
        + "SELECT split, id, summary FROM pairs QUALIFY row_number() OVER (PARTITION BY split ORDER BY id) <= 10",
        "row_at": pairs
        + "SELECT split, id, dialogue FROM pairs QUALIFY row_number() OVER (PARTITION BY split ORDER BY id) = 2",
        "batch_chunks": pairs
        + f"SELECT id, split, pos, pos // 8 AS chunk FROM {PLACES}",
        "split_exists_check": with_(PAIRS, CHECKED) + "SELECT check_key, passed FROM exists_checks",
        "column_check": with_(PAIRS, CHECKED) + "SELECT check_key, passed FROM column_checks",
        "type_check": with_(PAIRS, CHECKED) + "SELECT * FROM type_checks",
        "non_empty_check": with_(PAIRS, CHECKED) + "SELECT * FROM non_empty_checks",
        "split_counts": with_(PAIRS, CHECKED) + "SELECT split, n_rows FROM split_sizes",
        "blank_check": with_(PAIRS, PROFILE) + "SELECT split, n_rows, p.column, n_blank, n_values, n_chars FROM profile p",
        "length_stats": with_(PAIRS, PROFILE)
        + "SELECT split, p.column, n_rows, round(n_chars / n_values, 6) AS mean_chars,"
        " round_even(n_chars / n_values, 0)::BIGINT AS mean_chars_shown FROM profile p",
        "validation_report": with_(PAIRS, REPORT) + "SELECT * FROM checks",
        "validation_status": with_(PAIRS, REPORT)
        + "SELECT contract, bool_and(passed) AS validation_status, count(*) AS n_checks, count(*) FILTER (WHERE NOT passed) AS n_failed"
        " FROM (SELECT 'strict' AS contract, passed FROM checks UNION ALL SELECT 'plain', passed FROM plain_checks) GROUP BY contract",
        "tokens": f"SELECT doc_id, len(t)::INT AS n_tokens, array_to_string(t, ' ') AS tokens FROM (SELECT doc_id, {toks('text')} AS t FROM documents)",
        "sentences": f"SELECT doc_id, unnest(range(0, len(ss)))::INT AS sent, unnest(ss) AS sentence FROM (SELECT doc_id, {sents('text')} AS ss FROM documents)",
        "ngrams": f"SELECT gram, count(*) AS n FROM (SELECT unnest({grams('t', 2)}) AS gram FROM (SELECT {toks('text')} AS t FROM documents)) GROUP BY gram",
        "clean_summary": "SELECT doc_id, regexp_replace(replace(regexp_replace("
        + strip("text")
        + r""", ' ([.,!?])', '\1', 'g'), ' '' ', ''''), ' (n''t|''m|''s|''ve|''re)', '\1', 'g') AS cleaned FROM documents""",
        "repeated_ngrams": pairs
        + f"""SELECT id, len(g)::INT AS n_grams, len(list_distinct(g))::INT AS n_distinct, len(g) <> len(list_distinct(g)) AS repeats
FROM (SELECT id, {grams('t', NO_REPEAT)} AS g FROM (SELECT id, {toks('dialogue')} AS t FROM pairs))""",
        "vocab": vocab + "SELECT * FROM vocab",
        "encode_inputs": inputs
        + f"SELECT id, {text}({fill('ids', '1024')}, ' ') AS dialogue_ids,"
        f" {text}({fill('list_transform(ids, lambda x: 1)', '1024', 0)}, ' ') AS dialogue_mask FROM e",
        "encode_labels": labels + f"SELECT id, {text}({fill('ids', '128')}, ' ') AS summary_ids FROM e",
        "dynamic_pad": inputs
        + f""", placed AS (
  SELECT id, split, (row_number() OVER (PARTITION BY split ORDER BY id) - 1) // 8 AS chunk FROM pairs
), sized AS (SELECT *, max(len(ids)) OVER (PARTITION BY split, chunk) AS n FROM placed JOIN e USING (id))
SELECT id, split, chunk, n::INT AS n_ids, {text}({fill('ids', 'n')}, ' ') AS dialogue_ids FROM sized""",
        "decode_ids": labels + "," + decoded("e", "t") + " SELECT id, text AS summary_ids_text FROM t",
        "label_unmask": labels
        + f"SELECT id, (128 - len(ids))::INT AS n_ignored, {text}({fill('ids', '128')}, ' ') AS labels FROM e",
        "compute_metrics": compute_metrics(),
        "summarize_lead": lead + "SELECT id, split, prediction FROM lead",
        "summarize_frequency": with_(PAIRS, SENTENCES, FREQUENCY, chosen("frequency"), recursive=True)
        + "SELECT id, split, prediction FROM frequency",
        "summarize_beam": with_(PAIRS, SENTENCES, FREQUENCY, chosen("frequency"), beam("frequency"), recursive=True)
        + "SELECT id, split, prediction FROM beam",
        "summarize_tfidf": with_(PAIRS, SENTENCES, TFIDF, chosen("tfidf"), recursive=True)
        + f"SELECT {SHARED_ID}, split, prediction FROM tfidf",
        "summarize_textrank": with_(PAIRS, SENTENCES, textrank(), chosen("textrank", str(RANK_BASE)), recursive=True)
        + "SELECT id, split, prediction FROM textrank",
        "oracle_labels": with_(PAIRS, SENTENCES, GREEDY, recursive=True)
        + "SELECT id, split, pick::INT AS pick, sent::INT AS sent, score FROM greedy JOIN pairs USING (id)",
        "saved_tfidf_model": with_(PAIRS, SENTENCES, TFIDF, chosen("tfidf"), recursive=True)
        + "SELECT id, split, prediction AS summary, length(prediction)::INT AS summary_length, NULL::VARCHAR AS error FROM tfidf",
        "sentence_features": features(),
        "training_sizes": f"SELECT split, count(*) AS n_sentences, sum(label)::BIGINT AS n_chosen FROM ({features()}) GROUP BY split",
        "pair_predictions": lead + "SELECT id, split, prediction, summary FROM lead",
        "rouge1": with_(PAIRS, LEAD, ngram_scores("lead", 1, "s")) + f"SELECT * REPLACE ({SHARED_ID}) FROM s",
        "rouge2": with_(PAIRS, LEAD, ngram_scores("lead", 2, "s")) + f"SELECT * REPLACE ({SHARED_ID}) FROM s",
        "rougeL": with_(PAIRS, LEAD, lcs_scores("lead", "s"), recursive=True) + f"SELECT * REPLACE ({SHARED_ID}) FROM s",
        "rougeLsum": with_(PAIRS, LEAD, union_lcs_scores("lead", "s"), recursive=True) + f"SELECT * REPLACE ({SHARED_ID}) FROM s",
        "rouge_corpus": compared() + "SELECT * FROM scores",
        "rouge_bootstrap": bootstrap(),
        "metric_batches": with_(
            PAIRS, LEAD, ngram_scores("lead", 1, "s1"), ngram_scores("lead", 2, "s2"), lcs_scores("lead", "sl"),
            union_lcs_scores("lead", "su"), recursive=True,
        )
        + corpus("(SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM sl UNION ALL SELECT * FROM su)", "split, metric"),
        "metrics_rounded": compared() + "SELECT model, split, metric, round(f1, 4) AS f1 FROM scores",
        "metrics_wide": compared()
        + f"SELECT * FROM ({wide()}) CROSS JOIN (SELECT unnest(['csv', 'json']) AS file)",
        "evaluate_models": compared() + wide(),
        "batch_progress": pairs
        + "SELECT split, group_no, count(*) AS n_rows, max(pos) + 1 AS done FROM (SELECT split, pos, pos // 8 // 50 AS group_no"
        f" FROM {PLACES}) GROUP BY ALL",
        "request_validation": f"SELECT doc_id, length(text)::INT AS n_chars, {STATUS.format(n='length(text)')} AS status FROM documents",
        "request_validation_trimmed": f"SELECT doc_id, length({strip('text')})::INT AS n_chars,"
        f" {STATUS.format(n='length(' + strip('text') + ')')} AS status FROM documents",
        "batch_validation": with_(BATCHES) + "SELECT batch, position, status FROM checked",
        "predict_batch": with_(BATCHES)
        + f"""SELECT batch, (count(*) OVER (PARTITION BY batch))::INT AS count, position, text AS input_text, {lead_text('text', 'n')} AS summary,
       length(text)::INT AS input_length, length({lead_text('text', 'n')})::INT AS summary_length, NULL::VARCHAR AS error
FROM (SELECT *, coalesce({budget('position')}, {MAX_WORDS}) AS n FROM checked) WHERE status = 'ok' AND n BETWEEN 1 AND 512""",
        "compression": pairs
        + f"""SELECT id, split, length(dialogue)::INT AS input_length, n::INT AS summary_length,
       round((1 - n / length(dialogue)) * 100, 1) AS compression
FROM (SELECT *, length({lead_text('dialogue')}) AS n FROM pairs)""",
        "scoring_log": f"""
SELECT status, count(*) AS n_texts, sum(length(text))::BIGINT AS chars_in, sum(n)::BIGINT AS chars_out, round(sum(n) / count(*), 6) AS mean_summary_chars
FROM (SELECT text, {STATUS.format(n='length(text)')} AS status, CASE WHEN length(text) >= 10 THEN length({lead_text('text')}) END AS n FROM documents)
GROUP BY status""",
        "stream_predict": f"""
SELECT doc_id, status, CASE WHEN status = 'ok' THEN s END AS summary, CASE WHEN status = 'ok' THEN length(s)::INT END AS summary_length,
       NULL::VARCHAR AS error
FROM (
  SELECT doc_id, CASE WHEN own = 'ok' AND n NOT BETWEEN 1 AND 512 THEN 'max_length' ELSE own END AS status, {lead_text('text', 'n')} AS s
  FROM (SELECT *, {STATUS.format(n='length(text)')} AS own, coalesce({budget('doc_id')}, {MAX_WORDS}) AS n FROM documents)
)""",
        "stream_predict_once": f"""
SELECT doc_id, status, CASE WHEN status = 'ok' THEN s END AS summary, CASE WHEN status = 'ok' THEN length(s)::INT END AS summary_length,
       NULL::VARCHAR AS error
FROM (SELECT doc_id, {STATUS.format(n='length(text)')} AS status, {lead_text('text')} AS s FROM documents)""",
        "stream_window_totals": """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n_rows,
       sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS cents, max(value) AS highest FROM events WHERE ts IS NOT NULL GROUP BY ALL""",
        "stream_blank_check": f"""
SELECT role, 'text' AS column, count(*) AS n_rows, count(*) FILTER (WHERE text IS NULL OR regexp_full_match(text, '{SPACE}*')) AS n_blank,
       count(text) AS n_values, sum(length(text))::BIGINT AS n_chars FROM conversations GROUP BY role""",
        "best_step": with_(LOSSES)
        + "SELECT run, count(*) AS n_steps, arg_min(step, (loss, step)) AS best_step, min(loss) AS best_loss FROM losses GROUP BY run",
        "early_stop": early_stop(),
    }
    return out
