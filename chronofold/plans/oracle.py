"""DuckDB equivalents of the registered queries, for the correctness check."""

from __future__ import annotations

from chronofold.functions.classify import (
    BUCKET_DEFAULT,
    CATEGORY_DEFAULT,
    CATEGORY_RULES,
    bucket_rules,
)
from chronofold.plans import adapters as ad
from chronofold.plans.catalog import MAX_LENGTH, N_SHARDS, SHARD_BUDGET, TAIL


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def bucket_sql(subject: str, seed: str) -> str:
    return f"('0x' || substr(md5('{seed}|' || {subject}), 1, 8))::BIGINT"


def split_sql(subject: str) -> str:
    b = bucket_sql(subject, "split") + " % 1000"
    return f"CASE WHEN {b} < 800 THEN 'train' WHEN {b} < 900 THEN 'tuning' ELSE 'held_out' END"


def minutes_sql(start: str, end: str) -> str:
    cut = "epoch(date_trunc('second', {}))"
    return f"CAST(round_even(({cut.format(end)} - {cut.format(start)}) / 60.0, 0) AS INTEGER)"


def second_text_sql(time: str) -> str:
    return f"strftime({time}, '%Y-%m-%d %H:%M:%S')"


SEQ_SQL = (
    "(l_orderkey * 8 + l_linenumber) * 4194304"
    " + (l_partkey * 64 + l_suppkey * 8191 + CAST(l_quantity AS BIGINT)) % 4194304"
)

STREAM = """ev AS (
  SELECT user_id AS subject_id, ts AS time, event_type AS code, value AS numeric_value, props, event_id AS seq
  FROM events)"""
STREAM_CLEAN = STREAM + f""",
clean AS (SELECT * FROM ev WHERE code <> '{ad.STREAM_BIRTH}'),
lab AS (
  SELECT subject_id, prediction_time, label, CAST(count(*) AS INTEGER) AS copies FROM (
    SELECT DISTINCT user_id AS subject_id, ts AS prediction_time, CAST(value > 100 AS INTEGER) AS label, event_id
    FROM events WHERE event_type = 'purchase' AND value IS NOT NULL)
  GROUP BY ALL)"""
ORDERS = f"""clean AS (
  SELECT o_custkey AS subject_id, o_orderdate AS time,
         'LAB//' || CASE l_linenumber WHEN 5 THEN '0' || l_suppkey WHEN 6 THEN '00' || l_partkey ELSE l_partkey::VARCHAR END
         || '//' || l_returnflag AS code, l_quantity AS numeric_value, {SEQ_SQL} AS seq
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
lab AS (
  SELECT subject_id, prediction_time, label, CAST(count(*) AS INTEGER) AS copies FROM (
    SELECT DISTINCT o_custkey AS subject_id, o_orderdate AS prediction_time,
           CAST(o_orderstatus = 'F' AS INTEGER) AS label, o_orderkey FROM orders)
  GROUP BY ALL)"""
HEADERS = """pairs AS (
  SELECT l.subject_id, prediction_time, label, copies, min(time) AS first_time, count(*) AS base_events
  FROM lab l JOIN clean e ON e.subject_id = l.subject_id AND e.time <= l.prediction_time
  GROUP BY ALL),
headers AS (
  SELECT subject_id || '_' || sample_no AS sample_id, * FROM (
    SELECT *, base_events * copies AS n_events,
           row_number() OVER (PARTITION BY subject_id ORDER BY prediction_time, label) AS sample_no
    FROM pairs))"""
MEMBERS = f"""members AS (
  SELECT h.*, e.seq, e.time, {minutes_sql('h.first_time', 'e.time')} AS minute,
         CAST(unnest(range(1, copies + 1)) AS INTEGER) AS copy_no
  FROM headers h JOIN clean e ON e.subject_id = h.subject_id AND e.time <= h.prediction_time),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY time, copy_no, seq) AS pos FROM members)"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


STREAM_SAMPLES = with_(STREAM_CLEAN, HEADERS, MEMBERS)
ORDER_SAMPLES = with_(ORDERS, HEADERS, MEMBERS)

ASSIGNED = f"""dealt AS (
  SELECT sample_id, n_events, {split_sql('subject_id')} AS split, subject_id, sample_no FROM headers),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY subject_id, sample_no) AS rn FROM dealt),
packed AS (
  SELECT split, rn, sample_id, n_events, 0 AS shard_seq, n_events AS fill FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.split, r.rn, r.sample_id, r.n_events,
         CASE WHEN p.fill + r.n_events > {SHARD_BUDGET} OR p.fill >= {SHARD_BUDGET} THEN p.shard_seq + 1 ELSE p.shard_seq END,
         CASE WHEN p.fill + r.n_events > {SHARD_BUDGET} OR p.fill >= {SHARD_BUDGET} THEN r.n_events ELSE p.fill + r.n_events END
  FROM packed p JOIN ranked r ON r.split = p.split AND r.rn = p.rn + 1),
assigned AS (
  SELECT sample_id, split, shard_seq, printf('shard-%04d', shard_seq) AS shard, n_events, fill FROM packed)"""
STREAM_ASSIGNED = with_(STREAM_CLEAN, HEADERS, ASSIGNED)

STREAM_CODE_ROWS = ", ".join(f"({quoted(c)}, {quoted(t)})" for c, t in ad.STREAM_CODES)
STREAM_CODES = f"codes(code, description) AS (VALUES {STREAM_CODE_ROWS})"
CODE_TEXT = f"coalesce(nullif(description, ''), e.code)"

ORDER_CODES = f"""used AS (SELECT code, count(*) AS n_rows FROM clean GROUP BY code),
parts AS (
  SELECT *, string_split(code, '//') AS segs,
         list_position(list_transform(string_split(code, '//'), lambda s: regexp_full_match(s, '[0-9]+')), true) AS ix
  FROM used),
resolved AS (
  SELECT code, n_rows,
         CASE WHEN p_name IS NOT NULL OR s_name IS NOT NULL THEN
           array_to_string(list_transform(segs, lambda s, i: CASE WHEN i = ix THEN coalesce(p_name, s_name) ELSE s END), '//')
         ELSE code END AS code_text,
         CASE WHEN p_name IS NOT NULL THEN 'items' WHEN s_name IS NOT NULL THEN 'lab_items'
              WHEN ix > 0 THEN 'none' ELSE 'plain' END AS resolution
  FROM parts
  LEFT JOIN part ON p_partkey::VARCHAR = segs[ix]
  LEFT JOIN supplier ON '0' || s_suppkey = segs[ix])"""


def strip_zeros(text: str) -> str:
    return rf"regexp_replace({text}, '(\.\d+?)0+$', '\1')"


def round_piece_sql(piece: str) -> str:
    return strip_zeros(f"printf('%.4f', {piece}::DOUBLE)")


def rounded_sql(text: str) -> str:
    gaps = rf"regexp_split_to_array({text}, '\d*\.\d+')"
    pieces = rf"regexp_extract_all({text}, '\d*\.\d+')"
    return (
        f"array_to_string(list_transform({gaps}, lambda g, i: g || coalesce("
        f"{round_piece_sql(f'{pieces}[i]')}, '')), '')"
    )


def float_sql(x: str) -> str:
    text = f"({x})::VARCHAR"
    mantissa = f"regexp_extract({text}, '^-?([0-9.]+)e', 1)"
    return (
        f"CASE WHEN abs({x}) >= 1e12 AND abs({x}) < 1e16 THEN {text} WHEN {x} = 0 OR (abs({x}) >= 1e-4 AND abs({x}) < 1e16) THEN {round_piece_sql(x)} "
        f"ELSE CASE WHEN {x} < 0 THEN '-' ELSE '' END || "
        f"CASE WHEN contains({mantissa}, '.') THEN {round_piece_sql(mantissa)} ELSE {mantissa} END || "
        f"regexp_extract({text}, 'e.*$') END"
    )


def spaced_sql(text: str) -> str:
    return rf"regexp_replace({text}, '([0-9.])', ' \1 ', 'g')"


RUNS = r"[0-9]+(?:[.][0-9]*)?|[.]+"


def places_sql(text: str) -> str:
    return (
        f"flatten(list_transform(regexp_extract_all({text}, '{RUNS}'), lambda t: "
        "list_transform(range(0, length(t)), lambda i: CASE length(t) - length(replace(t, '.', '')) "
        "WHEN 0 THEN length(t) + 5 - i WHEN 1 THEN strpos(t, '.') + 4 - i ELSE 0 END)))"
    )


CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
LINE_TEXTS = f"""lines AS (
  SELECT {SEQ_SQL} AS seq,
         'qty ' || {CENTS} % 1000 || '.' || {CENTS} * 37 % 1000003 || ' v' || l_linenumber || '.' || {CENTS} % 97
         || '.' || {CENTS} % 89 || ' at .' || {CENTS} % 99991 || '... no ' || l_suppkey AS raw,
         CASE l_linenumber WHEN 6 THEN (l_extendedprice * l_discount / 7 - l_tax * 100) * 1e15
                           WHEN 7 THEN (l_extendedprice * l_discount / 7 - l_tax * 100) * 1e-9
                           ELSE l_extendedprice * l_discount / 7 - l_tax * 100 END AS x
  FROM lineitem)"""


def vocab_sql() -> str:
    fixed = ad.VOCAB_SPECIAL + [(w, ad.VOCAB_FIRST_WORD + i) for i, w in enumerate(ad.VOCAB_WORDS)]
    rows = ", ".join(f"({quoted(t)}, {i})" for t, i in fixed)
    return f"""vocab AS (
  SELECT col0 AS token, col1 AS id FROM (VALUES {rows})
  UNION ALL SELECT chr(CAST(33 + i AS INTEGER)), {ad.VOCAB_FIRST_CHAR} + i FROM range(94) t(i)
  UNION ALL SELECT '##' || chr(CAST(33 + i AS INTEGER)), {ad.VOCAB_FIRST_CONTINUATION} + i FROM range(94) t(i)),
heads AS (
  SELECT id, token LIKE '##_%' AS inner_piece, CASE WHEN token LIKE '##_%' THEN substr(token, 3) ELSE token END AS piece
  FROM vocab)"""


WORD = r"[!-/:-@\[-`{-~\p{P}]|[^\s\p{Z}!-/:-@\[-`{-~\p{P}]+"


def encoded_sql(base: str, fields: list[tuple[str, str]], length: int) -> str:
    """``base`` is a table with seq; fields are (name, text expression), the code first."""
    segments, n = [], 0
    for name, text in fields:
        is_code = name == "code"
        segments.append(f"SELECT seq, {n} AS field, 0 AS part, '{name}' AS text, 'name' AS kind FROM {base} WHERE {text} IS NOT NULL")
        if is_code:
            segments.append(f"SELECT seq, {n}, 1, {text}, 'text' FROM {base} WHERE {text} IS NOT NULL")
        else:
            pieces = f"regexp_extract_all({text}, '{RUNS}|[^0-9.]+')"
            segments.append(
                f"SELECT seq, {n}, unnest(range(1, len({pieces}) + 1)), unnest({pieces}), 'value' FROM {base} WHERE {text} IS NOT NULL"
            )
        n += 1
    return f"""segs AS ({' UNION ALL '.join(segments)}),
bits AS (
  SELECT seq, field, part, kind, kind = 'value' AND regexp_matches(text, '^[0-9.]') AS is_run,
         CASE WHEN kind = 'value' AND regexp_matches(text, '^[0-9.]') THEN string_split(text, '')
              ELSE regexp_extract_all(text, '{WORD.replace("'", "''")}') END AS ws
  FROM segs),
words AS (
  SELECT seq, field, part, kind, is_run, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS wno FROM bits),
vocab_words AS (SELECT DISTINCT word FROM words),
starts AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS p FROM vocab_words WHERE length(word) <= 100),
best AS (
  SELECT word, p, max_by(id, k) AS id, max(k) AS size FROM starts
  CROSS JOIN (SELECT DISTINCT length(piece) AS k FROM heads) sizes
  JOIN heads ON inner_piece = (p > 1) AND piece = substr(word, p, k) AND length(piece) = k
  GROUP BY word, p),
moves AS (
  SELECT word, list(id ORDER BY p) AS ids, list(size ORDER BY p) AS sizes
  FROM starts LEFT JOIN best USING (word, p) GROUP BY word),
walk AS (
  SELECT word, 1 AS step, CAST(1 AS BIGINT) AS p, CAST(0 AS BIGINT) AS id, ids, sizes FROM moves
  UNION ALL
  SELECT word, step + 1, p + sizes[p], ids[p], ids, sizes FROM walk WHERE sizes[p] IS NOT NULL),
whole AS (SELECT word FROM walk GROUP BY word HAVING max(p) = length(word) + 1),
pieces AS (
  SELECT word, step, id FROM walk SEMI JOIN whole USING (word) WHERE step > 1
  UNION ALL
  SELECT word, 1, 100 FROM vocab_words ANTI JOIN whole USING (word)),
tokens AS (
  SELECT seq, field, part, kind, is_run, w.word, id,
         row_number() OVER (PARTITION BY seq ORDER BY field, part, wno, step) AS tok
  FROM words w JOIN pieces USING (word)),
kept AS (
  SELECT *, row_number() OVER run - 1 AS i, count(*) OVER whole_run AS n,
         sum(CAST(word = '.' AS INTEGER)) OVER whole_run AS dots
  FROM tokens WHERE tok <= {length} - 2
  WINDOW run AS (PARTITION BY seq, field, part ORDER BY tok), whole_run AS (PARTITION BY seq, field, part)),
marked AS (
  SELECT *, max(CASE WHEN word = '.' THEN i END) OVER (PARTITION BY seq, field, part) AS dot_at FROM kept),
placed_tokens AS (
  SELECT seq, tok, id, CASE WHEN kind = 'name' THEN 2 ELSE 3 END AS type_id,
         CASE WHEN NOT is_run THEN 0 WHEN dots = 0 THEN n + 5 - i WHEN dots = 1 THEN dot_at + 5 - i ELSE 0 END AS place
  FROM marked),
lists AS (
  SELECT seq, count(*) AS k, list(id ORDER BY tok) AS ids, list(type_id ORDER BY tok) AS types, list(place ORDER BY tok) AS places
  FROM placed_tokens GROUP BY seq),
encoded AS (
  SELECT seq, CAST(k + 2 AS INTEGER) AS n_tokens,
         '101,' || array_to_string(ids, ',') || ',102' || repeat(',0', CAST({length} - 2 - k AS INTEGER)) AS input_ids,
         '5,' || array_to_string(types, ',') || ',6' || repeat(',0', CAST({length} - 2 - k AS INTEGER)) AS type_ids,
         '0,' || array_to_string(places, ',') || ',0' || repeat(',0', CAST({length} - 2 - k AS INTEGER)) AS place_ids
  FROM lists)"""


def encoded_parts_sql(base: str, fields: list[tuple[str, str]], length: int) -> str:
    """As ``encoded_sql``, but ids beyond the length go on in further parts."""
    whole = encoded_sql(base, fields, length).replace(f" WHERE tok <= {length} - 2", "")
    whole = whole.replace("SELECT seq, count(*) AS k,", f"SELECT seq, (tok - 1) // {length - 2} AS part, count(*) AS k,")
    whole = whole.replace("FROM placed_tokens GROUP BY seq)", "FROM placed_tokens GROUP BY ALL)")
    return whole.replace("SELECT seq, CAST(k + 2", "SELECT seq, CAST(part AS INTEGER) AS part, CAST(k + 2")


STREAM_DESCRIBED = f"""described AS (
  SELECT e.*, {CODE_TEXT} AS code_text FROM clean e LEFT JOIN codes c ON c.code = e.code)"""
STREAM_FIELDS = [
    ("code", "code_text"),
    ("numeric_value", round_piece_sql("numeric_value")),
    ("props", "props"),
]
STREAM_ENCODED = [
    STREAM_CLEAN,
    STREAM_CODES,
    STREAM_DESCRIBED,
    vocab_sql(),
    encoded_sql("described", STREAM_FIELDS, MAX_LENGTH),
]
ORDER_DESCRIBED = "described AS (SELECT e.*, code_text FROM clean e JOIN resolved r USING (code))"


def result_values_sql() -> str:
    n = len(ad.RESULT_TEXTS)
    texts = "[" + ", ".join(quoted(t) for t in ad.RESULT_TEXTS) + "]"
    pick = f"(l_orderkey * 7 + l_linenumber) % {n + 4}"
    q = "CAST(l_quantity AS INTEGER)"
    cents = "CAST(round(l_extendedprice * 100) AS BIGINT)"
    return f"""vals AS (
  SELECT CASE WHEN {pick} < {n} THEN {texts}[{pick} + 1] WHEN {pick} = {n} THEN '>' || {cents}
              WHEN {pick} = {n + 1} THEN {q} || '%' WHEN {pick} = {n + 2} THEN '<=' || {q} || '.5'
              ELSE {cents} || ' mg/dL' END AS raw,
         l_returnflag || '/' || l_linestatus AS meta
  FROM lineitem),
counts AS (SELECT raw, count(*) AS count FROM vals GROUP BY raw),
meta_counts AS (SELECT raw, meta, count(*) AS count FROM vals GROUP BY raw, meta)"""


def first_rule_sql(value: str, rules: list[tuple[str, str]], default: str) -> str:
    whens = " ".join(
        f"WHEN regexp_matches(lower(trim({value})), {quoted(p)}) THEN '{n}'" for n, p in rules
    )
    return f"CASE {whens} ELSE '{default}' END"


CATEGORY = first_rule_sql("raw", CATEGORY_RULES, CATEGORY_DEFAULT)
BUCKET = first_rule_sql("raw", bucket_rules(), BUCKET_DEFAULT)
CLASSED = with_(
    result_values_sql(),
    f"classed AS (SELECT *, {CATEGORY} AS category FROM counts)",
    "examples AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY count DESC, raw) AS rank FROM classed)",
)
BUCKETED = with_(
    result_values_sql(),
    f"bucketed AS (SELECT *, {BUCKET} AS bucket FROM meta_counts)",
    "examples AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY count DESC, raw, meta) AS rank FROM bucketed)",
)

LISTED = """listed AS (
  SELECT *, (row_number() OVER (PARTITION BY subject_id ORDER BY prediction_time, label) - 1) AS place FROM lab)"""

ORDER_SUBJECTS = "subjects AS (SELECT DISTINCT subject_id FROM clean)"
ORDER_SPLITS = f"splits AS (SELECT subject_id, {split_sql('subject_id')} AS split FROM subjects)"

ORACLE_SQL: dict[str, str] = {
    "sample_events": STREAM_SAMPLES
    + "SELECT sample_id, seq, time AS event_time, minute, copy_no FROM members",
    "sample_events_orders": ORDER_SAMPLES
    + "SELECT sample_id, seq, time AS event_time, minute, copy_no FROM members",
    "sample_headers": with_(STREAM_CLEAN, HEADERS)
    + f"SELECT sample_id, subject_id, sample_no, prediction_time, label, n_events, {split_sql('subject_id')} AS split FROM headers",
    "sample_headers_orders": with_(ORDERS, HEADERS)
    + "SELECT sample_id, subject_id, sample_no, prediction_time, label, copies, first_time, n_events FROM headers",
    "sample_manifest": STREAM_ASSIGNED + "SELECT sample_id, n_events, split, shard FROM assigned",
    "sample_positions": STREAM_SAMPLES + "SELECT sample_id, seq, pos, minute FROM placed",
    "sample_positions_orders": ORDER_SAMPLES + "SELECT sample_id, seq, copy_no, pos, minute FROM placed",
    "sample_sequences": STREAM_SAMPLES
    + """SELECT sample_id, (pos - 1) // 32 AS part,
  array_to_string(list(minute ORDER BY pos), ',') AS minutes, array_to_string(list(seq ORDER BY pos), ',') AS event_keys
FROM placed GROUP BY sample_id, (pos - 1) // 32""",
    "sample_tail": STREAM_SAMPLES
    + f"""SELECT sample_id, pos, seq, copy_no, {minutes_sql('tail_start', 'time')} AS minute FROM (
  SELECT *, min(time) OVER (PARTITION BY sample_id) AS tail_start FROM placed WHERE pos > n_events - {TAIL})""",
    "sample_tail_orders": ORDER_SAMPLES
    + f"""SELECT sample_id, pos, seq, copy_no, {minutes_sql('tail_start', 'time')} AS minute FROM (
  SELECT *, min(time) OVER (PARTITION BY sample_id) AS tail_start FROM placed WHERE pos > n_events - {TAIL})""",
    "event_clean": with_(STREAM_CLEAN)
    + "SELECT * FROM clean WHERE subject_id IS NOT NULL AND time IS NOT NULL",
    "event_nulled": with_(STREAM)
    + f"SELECT seq, CASE WHEN code = '{ad.STREAM_BIRTH}' THEN NULL ELSE time END AS time FROM ev",
    "event_groups": with_(ORDERS)
    + f"""SELECT subject_id, time, (ix - 1) // 10 AS part, group_size,
  array_to_string(list(code ORDER BY ix), ',') AS codes,
  array_to_string(list({second_text_sql('time')}), ',') AS times
FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, time ORDER BY seq) AS ix,
             count(*) OVER (PARTITION BY subject_id, time) AS group_size FROM clean)
GROUP BY ALL""",
    "event_numbers": with_(STREAM_CLEAN)
    + """SELECT seq, rank() OVER (PARTITION BY subject_id ORDER BY time) - 1 AS group_start,
  count(*) OVER (PARTITION BY subject_id, time) AS group_size,
  row_number() OVER (PARTITION BY subject_id ORDER BY time, seq) AS event_no FROM clean""",
    "group_offsets": with_(ORDERS)
    + """SELECT subject_id, time, n_events,
  CAST(coalesce(sum(n_events) OVER (PARTITION BY subject_id ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS group_start
FROM (SELECT subject_id, time, count(*) AS n_events FROM clean GROUP BY ALL)""",
    "prefix_groups": with_(ORDERS)
    + """SELECT subject_id, time, count(*) AS n_events FROM clean c
WHERE EXISTS (SELECT 1 FROM lab l WHERE l.subject_id = c.subject_id AND l.prediction_time >= c.time)
GROUP BY ALL ORDER BY subject_id, time LIMIT 5000""",
    "subjects_semi": with_(STREAM_CLEAN)
    + """SELECT subject_id, seq, code FROM clean
WHERE subject_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 100)""",
    "subject_counts": with_(ORDERS)
    + "SELECT count(DISTINCT subject_id) AS subjects, count(*) AS n_rows FROM clean",
    "label_clean": with_(ORDERS) + "SELECT * FROM lab",
    "label_clean_dedupe": with_(ORDERS)
    + "SELECT subject_id, prediction_time, label, 1 AS copies FROM lab",
    "label_aligned": f"""SELECT * FROM (
  SELECT user_id AS subject_id, ts AS prediction_time, value > 100 AS boolean_value, event_id, {split_sql('user_id')} AS split
  FROM events WHERE event_type = 'purchase') WHERE event_id % 7 <> 0
  AND subject_id IN (SELECT user_id FROM events WHERE event_type <> 'signup')""",
    "subject_label_lists": with_(ORDERS, LISTED)
    + f"""SELECT subject_id, place // 8 AS part,
  array_to_string(list({second_text_sql('prediction_time')} ORDER BY place), ',') AS cohort_end,
  array_to_string(list(label ORDER BY place), ',') AS cohort_label
FROM listed GROUP BY subject_id, place // 8""",
    "parallel_explode": with_(ORDERS)
    + "SELECT subject_id, prediction_time AS cohort_end, label AS cohort_label FROM lab",
    "extract_events": """SELECT user_id AS subject_id, ts AS time, event_type AS code, value AS numeric_value, props AS note FROM events
UNION ALL SELECT o_custkey, o_orderdate, 'ORDER//' || o_orderpriority, o_totalprice, NULL FROM orders
UNION ALL SELECT o_custkey, o_orderdate, 'STATUS//' || o_orderstatus, NULL, NULL FROM orders
UNION ALL SELECT c_custkey, NULL, 'SEGMENT//' || c_mktsegment, NULL, NULL FROM customer""",
    "merge_cohort": with_(STREAM, ORDERS)
    + f"""SELECT split, shard, code, count(*) AS n_rows, count(DISTINCT subject_id) AS subjects FROM (
  SELECT *, {split_sql('subject_id')} AS split,
         CAST({bucket_sql('subject_id', 'shard')} % {N_SHARDS} AS INTEGER) AS shard FROM (
    SELECT subject_id, time, code, CAST(numeric_value AS FLOAT) AS v, props FROM ev
    UNION SELECT subject_id, time, code, CAST(numeric_value AS FLOAT), NULL FROM ev WHERE code = 'click'
    UNION SELECT subject_id, time, code, CAST(numeric_value AS FLOAT), NULL FROM clean))
GROUP BY ALL""",
    "finalize_events": with_(STREAM)
    + "SELECT subject_id, time, code, CAST(CAST(numeric_value AS FLOAT) AS DOUBLE) AS numeric_value, seq FROM ev",
    "union_diagonal": with_(STREAM, ORDERS)
    + """SELECT subject_id, code, props, CAST(NULL AS DOUBLE) AS numeric_value FROM ev
UNION ALL SELECT subject_id, code, NULL, numeric_value FROM clean""",
    "code_table": with_(ORDERS) + "SELECT code, count(*) AS n_rows FROM clean GROUP BY code",
    "code_metadata": with_(STREAM, STREAM_CODES)
    + "SELECT u.code, description FROM (SELECT DISTINCT code FROM ev) u LEFT JOIN codes c ON c.code = u.code",
    "subject_splits": with_(ORDERS, ORDER_SUBJECTS, ORDER_SPLITS) + "SELECT * FROM splits",
    "subject_shards": with_(ORDERS, ORDER_SUBJECTS, ORDER_SPLITS)
    + f"SELECT subject_id, split, CAST({bucket_sql('subject_id', 'shard')} % {N_SHARDS} AS INTEGER) AS shard FROM splits",
    "split_sizes": with_(ORDERS, ORDER_SUBJECTS, ORDER_SPLITS)
    + "SELECT split, count(*) AS subjects FROM splits GROUP BY split",
    "split_preview": with_(ORDERS, ORDER_SUBJECTS, ORDER_SPLITS)
    + """SELECT * FROM (SELECT subject_id, split,
  CAST(row_number() OVER (PARTITION BY split ORDER BY subject_id) AS INTEGER) AS place FROM splits) WHERE place <= 3""",
    "split_filter": with_(ORDERS)
    + f"SELECT subject_id, seq, 'tuning' AS split FROM clean WHERE {split_sql('subject_id')} = 'tuning'",
    "code_describe": with_(STREAM, STREAM_CODES)
    + f"""SELECT seq, {CODE_TEXT} AS code_text,
  CASE WHEN nullif(description, '') IS NOT NULL THEN 'description' ELSE 'plain' END AS resolution
FROM ev e LEFT JOIN codes c ON c.code = e.code""",
    "code_fallback": with_(ORDERS, ORDER_CODES) + "SELECT code, code_text, resolution FROM resolved",
    "code_unresolved": with_(ORDERS, ORDER_CODES)
    + "SELECT code, n_rows FROM resolved WHERE resolution = 'none'",
    "code_unresolved_bare": with_(ORDERS) + "SELECT code, count(*) AS n_rows FROM clean GROUP BY code",
    "event_text": with_(STREAM_CLEAN, STREAM_CODES, STREAM_DESCRIBED)
    + f"""SELECT seq, 'code ' || code_text || ' numeric_value ' || {spaced_sql(round_piece_sql('numeric_value'))}
  || ' props ' || {spaced_sql('props')} AS event_text FROM described""",
    "text_rounded": with_(LINE_TEXTS) + f"SELECT seq, {rounded_sql('raw')} AS rounded FROM lines",
    "number_text": with_(LINE_TEXTS) + f"SELECT seq, {float_sql('x')} AS text FROM lines",
    "digit_spaced": with_(LINE_TEXTS) + f"SELECT seq, {spaced_sql('raw')} AS spaced FROM lines",
    "digit_runs": with_(LINE_TEXTS)
    + f"SELECT seq, array_to_string(regexp_extract_all(raw, '{RUNS}'), '|') AS runs FROM lines",
    "place_ids": with_(LINE_TEXTS)
    + f"SELECT seq, array_to_string({places_sql('raw')}, ',') AS places FROM lines",
    "document_numbers": f"""SELECT doc_id, CAST(len(regexp_extract_all(text, '{RUNS}')) AS INTEGER) AS n_runs,
  CAST(coalesce(list_sum({places_sql('text')}), 0) AS INTEGER) AS place_sum FROM documents""",
    "encoded_events": with_(*STREAM_ENCODED)
    + "SELECT seq, n_tokens, input_ids, type_ids, place_ids FROM encoded",
    "encoded_events_orders": with_(
        ORDERS,
        ORDER_CODES,
        ORDER_DESCRIBED,
        vocab_sql(),
        encoded_sql(
            "described", [("code", "code_text"), ("numeric_value", round_piece_sql("numeric_value"))], MAX_LENGTH
        ),
    )
    + "SELECT seq, n_tokens, input_ids, type_ids, place_ids FROM encoded",
    "encoded_documents": with_(
        "docs AS (SELECT doc_id AS seq, lang AS code_text, text FROM documents)",
        f"rounded AS (SELECT seq, code_text, CASE WHEN regexp_matches(text, '\\.\\d') THEN {rounded_sql('text')} ELSE text END AS text FROM docs)",
        vocab_sql(),
        encoded_parts_sql("rounded", [("code", "code_text"), ("text", "text")], 128),
    )
    + "SELECT seq, part, n_tokens, input_ids, place_ids FROM encoded",
    "token_counts": with_(*STREAM_ENCODED)
    + "SELECT n_tokens, count(*) AS n_rows FROM encoded GROUP BY n_tokens",
    "sample_encoded": with_(
        STREAM_CLEAN, HEADERS, MEMBERS, *STREAM_ENCODED[1:]
    )
    + "SELECT sample_id, seq, minute, input_ids FROM members JOIN encoded USING (seq)",
    "sample_nested": with_(STREAM_CLEAN, HEADERS, MEMBERS, *STREAM_ENCODED[1:])
    + """SELECT sample_id, (pos - 1) // 64 AS part, CAST(count(*) AS INTEGER) AS n_events,
  string_agg(input_ids || '|' || type_ids || '|' || place_ids, ';' ORDER BY pos) AS hi,
  string_agg(minute::VARCHAR, ',' ORDER BY pos) AS time
FROM placed JOIN encoded USING (seq) GROUP BY ALL""",
    "value_top50": with_(result_values_sql())
    + "SELECT raw, count FROM counts ORDER BY count DESC, raw LIMIT 50",
    "value_top_words": r"""SELECT word, count(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '[\x20\x09-\x0d]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word ORDER BY count DESC, word LIMIT 50""",
    "value_classes": CLASSED + "SELECT raw, count, category FROM classed",
    "value_summary": CLASSED
    + """SELECT c.category, CAST(sum(c.count) AS BIGINT) AS total_rows, count(*) AS unique_values,
  any_value(j.examples_joined) AS examples_joined
FROM classed c JOIN (SELECT category, array_to_string(list(raw ORDER BY rank), ' | ') AS examples_joined
                     FROM examples WHERE rank <= 10 GROUP BY category) j USING (category)
GROUP BY c.category""",
    "value_examples": CLASSED
    + "SELECT category, raw AS example, CAST(rank AS INTEGER) AS rank FROM examples WHERE rank <= 10",
    "value_buckets": BUCKETED + "SELECT raw, meta, count, bucket FROM bucketed",
    "value_bucket_summary": BUCKETED
    + """SELECT c.bucket, CAST(sum(c.count) AS BIGINT) AS total_rows, count(DISTINCT raw) AS unique_values,
  any_value(j.examples_joined) AS examples_joined
FROM bucketed c JOIN (SELECT bucket, array_to_string(list(raw ORDER BY rank), ' | ') AS examples_joined
                      FROM examples WHERE rank <= 10 GROUP BY bucket) j USING (bucket)
GROUP BY c.bucket""",
    "value_bucket_examples": BUCKETED
    + "SELECT bucket, raw AS example, CAST(rank AS INTEGER) AS rank FROM examples WHERE rank <= 10",
    "value_bucket_top50": with_(result_values_sql())
    + f"SELECT raw AS raw_value_exact, {BUCKET} AS bucket, count FROM counts ORDER BY count DESC, raw LIMIT 50",
    "shard_assign": STREAM_ASSIGNED + "SELECT sample_id, split, shard_seq, shard, n_events FROM assigned",
    "shard_running": STREAM_ASSIGNED
    + "SELECT split, shard, sample_id, n_events, fill - n_events AS shard_offset, fill AS running_events FROM assigned",
    "shard_balance": STREAM_ASSIGNED
    + f"""SELECT split, shard, count(*) AS samples, CAST(sum(n_events) AS BIGINT) AS events, CAST(sum(n_events) AS DOUBLE) / {SHARD_BUDGET} AS fill
FROM assigned GROUP BY split, shard""",
    "audit_rows": "\nUNION ALL ".join(
        f"SELECT '{t}' AS file, count(*) AS n_rows FROM {t}"
        for t in ("events", "orders", "lineitem", "customer", "part", "supplier")
    ),
    "file_rows": "\nUNION ALL ".join(
        f"SELECT '{s}' AS folder, 'parquet' AS format, count(*) AS n_rows, true AS readable FROM orders WHERE o_orderstatus = '{s}'"
        for s in ("F", "O", "P", "none")
    )
    + "\nUNION ALL SELECT 'lines', 'csv', count(*), true FROM orders",
    "audit_units": "SELECT 'scalar' AS layout, count(event_type) AS n FROM events UNION ALL SELECT 'list', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "audit_output": STREAM_ASSIGNED
    + """SELECT split, shard, count(*) AS samples, CAST(sum(n_events) AS BIGINT) AS events,
  count(*) AS manifest_samples, CAST(sum(n_events) AS BIGINT) AS manifest_events, true AS ok
FROM assigned GROUP BY split, shard""",
    "audit_splits": STREAM_ASSIGNED
    + """SELECT split, count(DISTINCT shard) AS shards, count(*) AS samples,
  CAST(sum(n_events) AS BIGINT) AS events, true AS ok FROM assigned GROUP BY split""",
    "file_preview_rows": "\nUNION ALL ".join(
        f"SELECT '{t}' AS file, {k} AS row_no, {k} AS key FROM {t} WHERE {k} < 6"
        for t, k in (("events", "event_id"), ("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey"))
    ),
    "output_names": "SELECT 'events' AS name, count(*) AS n_rows FROM events",
}
ORACLE_SQL["sample_store"] = ORACLE_SQL["sample_nested"]
