"""DuckDB equivalents of the registered queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = "[^\\x20\\x09-\\x0D]+"
_LETTERS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


SQL: dict[str, str] = {}

SQL["op2_minhash_tensor"] = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_words("text", _SPACED)} AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), grams AS (
  SELECT doc_id, unnest(s) AS g FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * common >= 75 * (len(x.s) + len(y.s) - common)
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a
), least AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least ON doc_id = a
"""

SQL["op4_fair_mix"] = f"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{_SPACED}')) AS BIGINT) AS size
  FROM documents
), alike AS (
  SELECT *, size * copies AS words FROM (SELECT *, count(*) AS copies FROM sized GROUP BY ALL)
), sources AS (
  SELECT source, CAST(sum(words) AS BIGINT) AS source_size FROM alike GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sources
), weighed AS (
  SELECT *, CAST([5, 2, 1][place % 3 + 1] AS DOUBLE) AS weight, source_size * 2e0 AS cap FROM placed
), levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5e0 - coalesce(sum(cap) OVER before, 0e0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0e0)) AS level,
         sum(source_size) OVER () * 1.5e0 AS budget
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), opened AS (
  SELECT arg_min(level, cap / weight) AS open_level FROM levels WHERE cap / weight > level
), goals AS (
  SELECT source, place, source_size, budget,
         CASE WHEN cap / weight <= level THEN cap ELSE least(cap, weight * open_level) END AS target
  FROM levels LEFT JOIN opened ON true
), entries AS (
  SELECT doc_id, digest, place, target, words, budget, turn,
         md5(concat_ws(':', '42', CAST(turn AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), 'null'), digest)) AS shuffled
  FROM alike JOIN goals ON alike.source IS NOT DISTINCT FROM goals.source, (VALUES (0), (1)) AS turns(turn)
  WHERE words > 0
), flow AS (
  SELECT *, sum(words) OVER (PARTITION BY place ORDER BY turn, shuffled, doc_id ROWS UNBOUNDED PRECEDING) / target AS finish FROM entries
), queue AS (
  SELECT *, sum(words) OVER (ORDER BY finish, place, turn, shuffled, doc_id ROWS UNBOUNDED PRECEDING) AS used FROM flow
), times AS (
  SELECT doc_id, digest, place, count(*) AS times FROM queue WHERE used <= budget GROUP BY ALL
)
SELECT s.doc_id, s.size, g.source_size, g.target, CAST(s.size * coalesce(t.times, 0) AS BIGINT) AS taken
FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
LEFT JOIN times t ON s.doc_id IS NOT DISTINCT FROM t.doc_id AND s.digest = t.digest AND g.place = t.place
"""

SQL["op6_winnowing"] = f"""
WITH d AS (
  SELECT doc_id, {_words("text", _LETTERS)} AS w FROM documents
), b AS (
  SELECT item_id, {_words("text", _LETTERS)} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, len(least_w) AS n, array_to_string(least_w, ' ') AS g FROM (
    SELECT item_id, unnest(CASE WHEN len(w) < 10 THEN [w] ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) END) AS least_w
    FROM b WHERE len(w) > 0)
), lengths AS (
  SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lengths WHERE len(w) >= n
), hits AS (
  SELECT doc_id, p, places.n, item_id FROM places JOIN windows
  ON windows.n = places.n AND windows.g = array_to_string(places.w[p:p + places.n - 1], ' ')
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hits GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SQL["op8_warc_index"] = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), r AS (
  SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('{_BASE32}',
         CAST((CAST('0x' || substr(hex, CAST(i // 4 AS INT) * 5 + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM r
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _edit(cell: str, cost: str, letter: str) -> str:
    """A cell, eight digits of cost and then the edits, after one more edit."""
    return f"lpad(CAST(CAST(left({cell}, 8) AS INT) + {cost} AS VARCHAR), 8, '0') || substr({cell}, 9) || '{letter}'"


def _kept(cell: str, initial: str) -> str:
    return f"CASE WHEN initial = '{initial}' AND fault IN ('', 'truncated') THEN {_edit(cell, 'more', 'K')} END"


def _reroled(cell: str) -> str:
    return f"CASE WHEN fault IN ('', 'truncated') THEN {_edit(cell, 'more + 1', 'R')} END"


SQL["op11_conversation_repair"] = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), checked AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(substr(key, i, 1)) AS BIGINT))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS kind
  FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 0 THEN [] WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM checked
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS n FROM damaged
), marked AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, {_BLANKS}) AS bare,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS seen,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) AS step
  FROM placed
), faulty AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM marked
), turns AS (
  SELECT *, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more FROM faulty
), counts AS (
  SELECT conv_id, max(n) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (step NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, '00000000' AS c0, CAST(NULL AS VARCHAR) AS c1, '00000005I' AS c2, '00000010II' AS c3 FROM counts
  UNION ALL
  SELECT conv_id, n, c0, c1, c2, least(c3, {_edit("c2", "5", "I")}) FROM (
    SELECT conv_id, n, c0, c1, least(c2, {_edit("c0", "5", "I")}, {_edit("c1", "5", "I")}, {_edit("c3", "5", "I")}) AS c2, c3 FROM (
      SELECT w.conv_id, r.n, {_edit("c0", "2", "D")} AS c0, least({_edit("c1", "2", "D")}, {_kept("c0", "s")}) AS c1,
             least({_edit("c2", "2", "D")}, {_kept("c0", "u")}, {_kept("c1", "u")}, {_kept("c3", "u")}, {_reroled("c0")}, {_reroled("c1")}, {_reroled("c3")}) AS c2,
             least({_edit("c3", "2", "D")}, {_kept("c2", "a")}, {_reroled("c2")}) AS c3
      FROM walk w JOIN turns r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.n = w.n + 1))
), best AS (
  SELECT w.conv_id, least(c0, c3) AS cell FROM walk w JOIN counts c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.n = c.rows
), letters AS (
  SELECT conv_id, substr(cell, 9) AS audit, unnest(range(1, length(cell) - 7)) AS i FROM best
), edits AS (
  SELECT conv_id, i, substr(audit, i, 1) AS edit, length(replace(left(audit, i), 'I', '')) AS n FROM letters
), met AS (
  SELECT e.conv_id, e.i, e.edit, r.role, coalesce(r.text, '') AS text, coalesce(e.edit = 'K' AND r.initial = 's', false) AS system
  FROM edits e LEFT JOIN turns r ON e.conv_id IS NOT DISTINCT FROM r.conv_id AND e.n = r.n AND e.edit <> 'I'
  WHERE e.edit <> 'D'
), due AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i) - max(CAST(system AS INT)) OVER (PARTITION BY conv_id) AS k FROM met
), written AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN k % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS repaired
  FROM due GROUP BY conv_id
)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(CAST(left(cell, 8) AS BIGINT), 0) AS BIGINT) AS cost, coalesce(substr(cell, 9), '') AS audit,
       sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN written w ON a.conv_id IS NOT DISTINCT FROM w.conv_id
"""

_P = 5
_LOWER_PAIRS = [(i, j) for i in range(_P) for j in range(i + 1)]
_X, _M = [f"x{i}" for i in range(_P)], [f"m{i}" for i in range(_P)]
_L = [f"l{i}{j}" for i, j in _LOWER_PAIRS]
#: Squared floors in units of 1/1024, quantiles of chi-square with five degrees, and consistency factors.
_FLOOR = ["1048576e0", "10485.76e0", "262144e0", "262144e0", "671088.64e0"]
_FLOOR_ROOT = ["1024e0", "102.4e0", "512e0", "512e0", "819.2e0"]
_Q975, _Q9999, _C75, _C975 = "12.832501994030014e0", "25.74483195905633e0", "1.41207106018905e0", "1.0555331100406595e0"


def _factored(source: str, keys: str) -> str:
    """The triangular factor of s, column by column."""
    for j in range(_P):
        before = "".join(f" - l{j}{k} * l{j}{k}" for k in range(j))
        source = f"(SELECT *, sqrt(s{j}{j}{before}) AS l{j}{j} FROM {source})"
        below = [f"(s{i}{j}{''.join(f' - l{i}{k} * l{j}{k}' for k in range(j))}) / l{j}{j} AS l{i}{j}" for i in range(j + 1, _P)]
        if below:
            source = f"(SELECT *, {', '.join(below)} FROM {source})"
    return f"SELECT {keys}, {', '.join(_M + _L)} FROM {source}"


def _far(source: str) -> str:
    """Rows with their squared distance."""
    for i in range(_P):
        before = "".join(f" - l{i}{k} * y{k}" for k in range(i))
        source = f"(SELECT *, (x{i} - m{i}{before}) / l{i}{i} AS y{i} FROM {source})"
    return f"(SELECT *, {' + '.join(f'y{i} * y{i}' for i in range(_P))} AS d2 FROM {source})"


_SUMMED = ", ".join(["count(*) AS n", *(f"CAST(sum(x{i}) AS DOUBLE) AS t{i}" for i in range(_P)),
                     *(f"CAST(sum(x{i} * x{j}) AS DOUBLE) AS t{i}{j}" for i, j in _LOWER_PAIRS)])


def _estimated(source: str, keys: str, factor: str) -> str:
    moments = [f"t{i} / n AS m{i}" for i in range(_P)] + [
        f"{factor} * (t{i}{j} - t{i} * (t{j} / n)) / n + {_FLOOR[i] if i == j else '0e0'} AS s{i}{j}" for i, j in _LOWER_PAIRS
    ]
    return _factored(f"(SELECT {keys}, {', '.join(moments)} FROM (SELECT {keys}, {_SUMMED} FROM {source} GROUP BY {keys}))", keys)


def _step(k: int) -> str:
    """One concentration step: the rows of the nearest bins that reach three quarters."""
    return f"""binned{k} AS MATERIALIZED (
  SELECT *, least(CAST(floor(sqrt(d2) * 64) AS BIGINT), 4095) AS bin FROM {_far(f"(SELECT * FROM fit JOIN params{k} USING (cell))")}
), edges{k} AS (
  SELECT cell, start, max(bin) AS edge FROM (
    SELECT cell, start, bin, sum(n) OVER (PARTITION BY cell, start ORDER BY bin) - n AS before, sum(n) OVER (PARTITION BY cell, start) AS total
    FROM (SELECT cell, start, bin, count(*) AS n FROM binned{k} GROUP BY ALL))
  WHERE before < ceil(total * 0.75e0) GROUP BY ALL
), params{k + 1} AS MATERIALIZED (
  {_estimated(f"binned{k} JOIN edges{k} USING (cell, start) WHERE bin <= edge", "cell, start", _C75)}
)"""


def _middle_of(source: str, value: str) -> str:
    return f"""SELECT cell, i, min(v) AS middle FROM (
    SELECT cell, i, {value} AS v, sum(n) OVER (PARTITION BY cell, i ORDER BY {value}) AS upto, sum(n) OVER (PARTITION BY cell, i) AS total
    FROM {source}) WHERE 2 * upto >= total GROUP BY ALL"""


SQL["op12_robust_quality"] = f"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, row_number() OVER () AS r,
         regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents
), grams AS (
  SELECT r, i, w[i:i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS times FROM grams) WHERE times > 1
), repeats AS (
  SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM twice) GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{_SPACED}') GROUP BY r
), found AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM found
), own AS (
  SELECT lang, source, count(*) AS n FROM judged WHERE NOT base_failed GROUP BY ALL
), small AS (
  SELECT lang, sum(n) AS n_lang FROM own WHERE n < 50 GROUP BY lang
), cells AS (
  SELECT own.lang, own.source, CASE WHEN n >= 50 THEN CAST(to_json([own.lang, own.source]) AS VARCHAR) WHEN n_lang >= 50 THEN CAST(to_json([own.lang]) AS VARCHAR)
    WHEN (SELECT sum(n_lang) FROM small WHERE n_lang < 50) >= 50 THEN '*' END AS cell
  FROM own LEFT JOIN small ON own.lang IS NOT DISTINCT FROM small.lang
), rows AS MATERIALIZED (
  SELECT j.*, cell, CAST(round(ln(1e0 + n_words) * 1024) AS BIGINT) AS x0, CASE WHEN n_words > 0 THEN CAST(round(ln(word_chars * 1e0 / n_words) * 1024) AS BIGINT) END AS x1,
         CASE WHEN n_words > 0 THEN CAST(round(ln(1e0 + 100e0 * n_symbols / n_words) * 1024) AS BIGINT) END AS x2,
         CASE WHEN n_words > 0 THEN CAST(round(ln(1e0 + 100e0 * n_dup_lines / n_words) * 1024) AS BIGINT) END AS x3,
         CASE WHEN n_words > 0 THEN CAST(round(ln(1e0 + 100e0 * n_repeat_words / n_words) * 1024) AS BIGINT) END AS x4
  FROM judged j LEFT JOIN cells c ON j.lang IS NOT DISTINCT FROM c.lang AND j.source IS NOT DISTINCT FROM c.source AND NOT base_failed
), fit AS (
  SELECT cell, {', '.join(_X)} FROM rows WHERE cell IS NOT NULL
), counted AS (
  SELECT cell, i, v, count(*) AS n FROM (SELECT cell, unnest(range(5)) AS i, unnest([{', '.join(_X)}]) AS v FROM fit) GROUP BY ALL
), medians AS (
  {_middle_of("counted", "v")}
), deviations AS (
  {_middle_of("(SELECT cell, i, abs(v - middle) AS off, sum(n) AS n FROM counted JOIN medians USING (cell, i) GROUP BY ALL)", "off")}
), places AS (
  SELECT cell, {', '.join(f"CAST(max(m.middle) FILTER (i = {i}) AS DOUBLE) AS m{i}, greatest(1.4826e0 * max(o.middle) FILTER (i = {i}), {_FLOOR_ROOT[i]}) AS w{i}" for i in range(_P))}
  FROM medians m JOIN deviations o USING (cell, i) GROUP BY cell
), signs AS (
  SELECT cell, count(*) AS n, {', '.join(f"CAST(sum(sign(x{i} - m{i}) * sign(x{j} - m{j})) AS DOUBLE) AS g{i}{j}" for i, j in _LOWER_PAIRS)}
  FROM fit JOIN places USING (cell) GROUP BY cell
), params0 AS MATERIALIZED (
  {_factored(f'''(SELECT *, {', '.join(f"CASE WHEN start = 0 THEN w{i} * w{j} * {float(i == j)}e0 ELSE w{i} * w{j} * (g{i}{j} / n) END + {_FLOOR[i] if i == j else '0e0'} AS s{i}{j}" for i, j in _LOWER_PAIRS)}
    FROM places JOIN signs USING (cell), (VALUES (0), (1)) AS starts(start))''', "cell, start")}
), {", ".join(_step(k) for k in range(6))}, best AS (
  SELECT * FROM params6 QUALIFY row_number() OVER (PARTITION BY cell ORDER BY {' * '.join(f"l{i}{i}" for i in range(_P))}, start) = 1
), final AS MATERIALIZED (
  {_estimated(f"{_far('(SELECT * FROM fit JOIN best USING (cell))')} WHERE d2 <= {_Q975}", "cell", _C975)}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(d2 > {_Q9999}, false) AS kept
FROM {_far("(SELECT * FROM rows LEFT JOIN final USING (cell))")}
"""
