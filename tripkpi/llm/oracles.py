"""SQL for the queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

from tripkpi.llm import dialogue, infilling, minhash, mixing, quality_lines, suffixes

_WORD = "[^\\x20\\x09-\\x0D]+"
_WORDS = f"regexp_extract_all(coalesce(text, ''), '{_WORD}')"

NEAREST = """WITH v AS (
  SELECT row_number() OVER () AS k, vec_id, embedding AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.k, q.vec_id AS query_id, c.vec_id AS vec_id,
    sqrt(list_reduce(list_transform(range(1, len(q.e) + 1), lambda i:
      (CAST(q.e[i] AS DOUBLE) - CAST(c.e[i] AS DOUBLE))
      * (CAST(q.e[i] AS DOUBLE) - CAST(c.e[i] AS DOUBLE))), lambda x, y: x + y)) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.k <> c.k AND len(q.e) = len(c.e)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY k ORDER BY score, vec_id) AS INT) AS rank
  FROM pairs
) SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

QUALITY = f"""WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
), w AS (
  SELECT k, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS a, unnest(words[2:] || ['']) AS b,
    unnest(words[3:] || ['', '']) AS c, len(words) AS n FROM d WHERE len(words) >= 3
), again AS (
  SELECT k, a, b, c FROM w WHERE i <= n - 2 GROUP BY ALL HAVING count(*) > 1
), covered AS (
  SELECT k, count(DISTINCT i + j) AS n FROM w JOIN again USING (k, a, b, c), range(3) AS t(j)
  WHERE i <= n - 2 GROUP BY k
), l AS (
  SELECT k, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d
), lines AS (
  SELECT *, regexp_extract_all(line, '{_WORD}') AS ws,
    row_number() OVER (PARTITION BY k, line ORDER BY i) > 1 AS again,
    regexp_split_to_array(line, '[|>»·•]') AS parts
  FROM l WHERE len(regexp_extract_all(line, '{_WORD}')) > 0
), judged AS (
  SELECT k, length(line) AS n, again, (again AND length(line) < {quality_lines.SHORT_LINE})
    OR len(regexp_extract_all(array_to_string(ws, ''), '[^\\pL\\pN]'))
      > {quality_lines.ODD_SHARE} * length(array_to_string(ws, ''))
    OR (len(ws) >= 3 AND 2 * len(list_filter(ws, lambda x:
      regexp_matches(x, '[!?*#$%&]{{2,}}[.,;:]?$'))) >= len(ws))
    OR (len(parts) >= 3 AND list_max(list_transform(parts, lambda x:
      length(regexp_replace(x, '^\\s+|\\s+$', '', 'g')))) <= {quality_lines.SHORT_PART})
    OR (length(line) < {quality_lines.SHORT_LINE}
      AND regexp_matches(line, '(?i){quality_lines.BOILERPLATE.pattern}')) AS fails
  FROM lines
), sums AS (
  SELECT k, count_if(again) AS dup, count_if(fails) AS removed, sum(n) AS chars,
    coalesce(sum(n) FILTER (NOT fails), 0) AS kept_chars FROM judged GROUP BY k
), figures AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '{quality_lines.SYMBOLS}')) AS n_symbols,
    CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    coalesce(removed, 0) AS n_removed_lines, coalesce(chars, 0) AS n_line_chars,
    coalesce(kept_chars, 0) AS n_kept_chars
  FROM d LEFT JOIN sums USING (k) LEFT JOIN covered USING (k)
), based AS (
  SELECT *, n_words < {quality_lines.LEAST_WORDS}
    OR 100 * n_repeat_words > {quality_lines.MOST_REPEATED} * n_words AS base_failed FROM figures
) SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CAST(n_removed_lines AS BIGINT) AS n_removed_lines, CAST(n_line_chars AS BIGINT) AS n_line_chars,
  CAST(n_kept_chars AS BIGINT) AS n_kept_chars,
  NOT base_failed AND n_kept_chars >= {quality_lines.KEEP_SHARE} * n_line_chars AS kept
FROM based"""

_L = suffixes.LENGTH
REPEATS = f"""WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), s AS (
  SELECT doc_id, unnest(range(0, n - {_L} + 1)) AS i, h FROM d WHERE n >= {_L}
), strings AS (SELECT doc_id, i, substr(h, 2 * i + 1, {2 * _L}) AS x FROM s
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS r FROM strings)
  WHERE r > 1
), marked AS (
  SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) + {_L} AS new
  FROM later
), runs AS (
  SELECT doc_id, min(i) AS a, max(i) + {_L} AS b FROM (
    SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked)
  GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS after FROM runs
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a)
    || substr(any_value(h), 2 * max(b) + 1) AS h, sum(b - a) AS n_removed, count(*) AS n_spans
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
) SELECT doc_id, d.n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
NEAR_DUPLICATES = f"""WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {minhash.SHINGLE} - 1], ' ') AS x
  FROM d, range(1, greatest(len(w) - {minhash.SHINGLE} + 2, 2)) AS t(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT u, v FROM common JOIN sizes a ON u = a.doc_id JOIN sizes b ON v = b.doc_id
  WHERE 100 * c >= {minhash.PER_CENT} * (a.n + b.n - c)
), reach AS (
  SELECT doc_id AS u, doc_id AS v FROM d UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), components AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u
) SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)"""


def _rounds(table: str, x: str, n: str, key: str, name: str) -> tuple[str, str]:
    """CTEs that take column ``x`` of ``table`` through a permutation, and the last one's name."""
    ctes, before = [], table
    for r, (start, step, factor) in enumerate(mixing.round_numbers(name)):
        now = f"{table}_{name}_{r}"
        one = mixing.round_sql(x, n, key, str(r), f"{start}::BIGINT", str(step), str(factor))
        ctes.append(f"{now} AS MATERIALIZED (SELECT * REPLACE ({one} AS {x}) FROM {before})")
        before = now
    return ", ".join(ctes), before


def mixing_sql() -> str:
    size, most, share = mixing.BLOCK_WORDS, mixing.MOST, mixing.SHARE
    blocks, blocked = _rounds("slots", "block", "n_blocks", "key", "block")
    places, placed = _rounds(blocked, "position", "n_all_slots", "0", "slot")
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return f"""WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS ordinal FROM d GROUP BY source
), weighed AS (
  SELECT *, [{weights}][ordinal % {len(mixing.WEIGHTS)} + 1] AS weight FROM per
), roomy AS (SELECT *, {most} * source_size / weight AS room FROM weighed
), levels AS (
  SELECT *, ({share} * CAST(sum(source_size) OVER () AS DOUBLE)
      - CAST(coalesce(sum({most} * source_size) OVER (ORDER BY room, ordinal
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / CAST(sum(weight) OVER (ORDER BY room, ordinal
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM roomy
), level AS (SELECT max(level) AS level FROM levels WHERE level <= room
), aimed AS (
  SELECT source, ordinal, source_size,
    CASE WHEN level.level * weight >= {most} * source_size
      THEN CAST({most} * source_size AS DOUBLE) ELSE level.level * weight END AS target,
    (source_size + {size - 1}) // {size} AS n_blocks FROM roomy, level
), counted AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0
    ELSE CAST(round(target * n_blocks / source_size) AS BIGINT) END AS n_slots FROM aimed
), sources AS (
  SELECT *, CAST(sum(n_slots) OVER () AS BIGINT) AS n_all_slots,
    CAST(coalesce(sum(n_slots) OVER (ORDER BY ordinal
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_slot FROM counted
), numbered AS (
  SELECT ordinal, n_blocks, n_all_slots, first_slot, unnest(range(0, n_slots)) AS slot FROM sources
), slots AS (
  SELECT ordinal, n_blocks, n_all_slots, slot % n_blocks AS block, first_slot + slot AS position,
    ordinal * 64 + slot // n_blocks AS key FROM numbered
), {blocks}, {places}, takes AS (
  SELECT ordinal, block, count(*) AS times, min(position // {mixing.SHARD_BLOCKS}) AS shard
  FROM {placed} GROUP BY ALL
), packed AS (
  SELECT d.*, ordinal, source_size, target, CAST(coalesce(sum(size) OVER (PARTITION BY ordinal
    ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM d JOIN sources ON d.source IS NOT DISTINCT FROM sources.source
), pieces AS (
  SELECT doc_id, ordinal, start, size,
    unnest(range(start // {size}, (start + size - 1) // {size} + 1)) AS block
  FROM packed WHERE size > 0
), taken AS (
  SELECT doc_id, sum(times * (least((block + 1) * {size}, start + size)
    - greatest(block * {size}, start))) AS taken, min(shard) AS first_shard
  FROM pieces JOIN takes USING (ordinal, block) GROUP BY doc_id
) SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, first_shard
FROM packed LEFT JOIN taken USING (doc_id)"""


_P, _S, _M = infilling.PREFIX, infilling.SUFFIX, infilling.MIDDLE
INFILLING = f"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda i:
    CAST('0x' || substr(h, i, 8) AS BIGINT)) AS h FROM d
), cut AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR regexp_matches(t, '{_P}|{_S}|{_M}') OR h[3] % 100 >= {infilling.PLAIN_FROM}
      THEN 'plain' WHEN h[4] % 100 < {infilling.SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, array_to_string(u[:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
    array_to_string(u[b + 1:], '') AS s FROM cut
) SELECT doc_id, n, form,
  CAST(CASE WHEN form <> 'plain' THEN length(p) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN length(m) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{_P}' || p || '{_S}' || s || '{_M}' || m
    ELSE '{_S}' || s || '{_P}' || p || '{_M}' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _way(cost: str, letter: str, lines: str, rest: str) -> str:
    """An edit in front of the best way from a state: cost, audit and lines."""
    return f"{{'c': {cost} + {rest}.c, 'a': '{letter}' || {rest}.a, 'o': {lines} || {rest}.o}}"


def _insert(role: str, rest: str) -> str:
    return _way(str(dialogue.COSTS[dialogue.INSERT]), "I", f"chr(10) || '{role}:'", rest)


def repair_sql() -> str:
    """The table of least ways, whole audits and lines with it, from the last row backwards."""
    never = 10**9
    cut = f"{dialogue.CUT} * CAST(fault = 'truncated' AS INT)"
    barred = f"{never} * CAST(fault IN ('blank', 'duplicate') AS INT)"
    line = "chr(10) || role || ':' || text"
    due = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    keeps = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    best = []
    for q in range(4):
        ways = [_way(str(dialogue.COSTS[dialogue.DELETE]), "D", "''", f"s{q}")]
        for initial, to in keeps[q].items():
            wrong = f"{never} * CAST(left(role, 1) <> '{initial}' AS INT)"
            ways.append(_way(f"{cut} + {barred} + {wrong}", "K", line, f"s{to}"))
        role, to = due[q]
        ways.append(_way(f"1 + {cut} + {barred}", "R", f"chr(10) || '{role}:' || text", f"s{to}"))
        best.append(f"{_least(*ways)} AS b{q}")
    bits = "list_reduce([c] || [0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    crc = (
        "xor(4294967295, list_reduce([4294967295] || list_transform(string_split(key, ''), lambda x:"
        " CAST(ascii(x) AS BIGINT)), lambda r, x: {step}))"
    ).format(step=bits.replace("[c]", "[xor(r, x)]"))
    order = "turn NULLS FIRST, role, md5(length(role) || ':' || role || text)"
    chars = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), drawn AS (SELECT *, {crc} % 20 AS damage FROM named
), damaged AS (
  SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE damage WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM drawn WHERE damage <> 0
), numbered AS (
  SELECT conv_id, turn, role, text, rtrim(text, {chars}) AS seen,
    row_number() OVER (PARTITION BY conv_id ORDER BY {order}) AS i FROM damaged
), judged AS (
  SELECT *, CASE WHEN seen = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM numbered
), ids AS (SELECT DISTINCT conv_id FROM conversations
), figures AS (
  SELECT ids.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
    count(i) AS n
  FROM ids LEFT JOIN judged ON ids.conv_id IS NOT DISTINCT FROM judged.conv_id GROUP BY ids.conv_id
), ends AS (SELECT {{'c': 0, 'a': '', 'o': ''}} AS e
), ways AS (
  SELECT conv_id, n AS i, e AS s0, {_insert('user', _insert('assistant', 'e'))} AS s1,
    {_insert('assistant', 'e')} AS s2, e AS s3 FROM figures, ends
  UNION ALL
  SELECT conv_id, i - 1, {_least('b0', _insert('user', 'u'))}, {_least('b1', _insert('user', 'u'))}, u, a
  FROM (
    SELECT *, {_least('b2', _insert('assistant', 'b3'))} AS u, {_least('b3', _insert('user', 'b2'))} AS a
    FROM (
      SELECT ways.conv_id, ways.i, {', '.join(best)}
      FROM ways JOIN judged ON ways.conv_id IS NOT DISTINCT FROM judged.conv_id AND ways.i = judged.i))
) SELECT f.conv_id, gaps, blank, duplicate, truncated, illegal, CAST(s0.c AS BIGINT) AS cost,
  s0.a AS audit, sha256(substr(s0.o, 2)) AS repaired_sha256
FROM figures f JOIN ways ON f.conv_id IS NOT DISTINCT FROM ways.conv_id AND ways.i = 0"""


def oracle_sql() -> dict[str, str]:
    return {
        "op12_fill_in_middle": INFILLING,
        "op13_conversation_repair": repair_sql(),
        "op3_quality_rules": QUALITY,
        "op4_suffix_dedup": REPEATS,
        "op5_minhash": NEAR_DUPLICATES,
        "op6_nearest_neighbours": NEAREST,
        "op9_mixing": mixing_sql(),
    }
