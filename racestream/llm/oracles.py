"""DuckDB SQL for those queries that SQL can express over whole tables."""

from racestream.llm.chat import ASSISTANT, BUDGET, CLOSE, END, HISTORY, OPEN, REFERENCES, SYSTEM
from racestream.llm.fill_in_middle import CUT, MARKS, MIDDLE, PREFIX, SUFFIX, SUFFIX_FIRST
from racestream.llm.host_quality import HOST_LIMIT, HOST_RULES, RULES, STRONGEST, WEAKEST


def _host_quality() -> str:
    sums = ", ".join(f"sum(CAST({RULES[r]} AS INT)) AS {r}" for r in HOST_RULES)
    moments = ", ".join(f"avg({r} / docs) AS {r}_m, var_pop({r} / docs) AS {r}_v" for r in HOST_RULES)
    between = {r: f"greatest({r}_v - {r}_m * (1 - {r}_m) * noise, 0)" for r in HOST_RULES}
    strengths = ", ".join(
        f"CASE WHEN {between[r]} > 0 THEN least(greatest({r}_m * (1 - {r}_m) / {between[r]} - 1, {WEAKEST}), {STRONGEST})"
        f" ELSE {STRONGEST} END AS {r}_s"
        for r in HOST_RULES
    )
    bad = " OR ".join(f"({r} + {r}_m * {r}_s) / (docs + {r}_s) > {HOST_LIMIT}" for r in HOST_RULES)
    own = " OR ".join(f"({rule})" for rule in RULES.values())
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
      FROM (SELECT rid, regexp_extract_all(t, '[^ \\t\\n\\x0B\\f\\r]+') AS ws FROM d)),
tri AS (SELECT rid, i, word, lead(word) OVER p AS w2, lead(word, 2) OVER p AS w3
        FROM w WINDOW p AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, word, w2, w3) AS c FROM tri WHERE w3 IS NOT NULL)
        WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS v(k) GROUP BY rid),
ln AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
       FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^ \\t\\n\\x0B\\f\\r]') GROUP BY rid),
wc AS (SELECT rid, count(*) AS n FROM w GROUP BY rid),
c AS (SELECT doc_id, source, coalesce(wc.n, 0) AS n_words,
        CAST(length(regexp_replace(t, '[ \\t\\n\\x0B\\f\\r]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
      FROM d LEFT JOIN wc USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN ln USING (rid)),
h AS (SELECT source AS host, count(*) AS docs, {sums} FROM c WHERE source IS NOT NULL GROUP BY 1),
m AS (SELECT avg(1 / docs) AS noise, {moments} FROM h),
s AS (SELECT *, {strengths} FROM m),
bad AS (SELECT host FROM h, s WHERE {bad})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({RULES["short"]} OR {RULES["repeats"]}) AS base_failed,
  NOT ({own}) AND bad.host IS NULL AS kept, bad.host IS NOT NULL AS host_failed
FROM c LEFT JOIN bad ON c.source = bad.host"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Everything that each id reaches over links (a, b), both ways.
_REACHED = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(id, other) AS (SELECT id, id FROM ids UNION SELECT r.id, e.b FROM reached r JOIN both_ways e ON e.a = r.other),
component AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)"""


def _near_documents(words: int, percent: int) -> str:
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^ \\t\\n\\x0B\\f\\r]+') AS ws FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {words} + 2, 2))) AS i FROM d WHERE len(ws) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + {words - 1}], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
  GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
ids AS (SELECT doc_id AS id FROM d),{_REACHED}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN component ON component.id = d.doc_id"""


_NEAR_VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id < q.vec_id
  WHERE list_cosine_similarity(p.x, q.x) >= 0.93),
ids AS (SELECT vec_id AS id FROM v),{_REACHED}
SELECT v.vec_id, CAST(count(e.b) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN component ON component.id = v.vec_id LEFT JOIN both_ways e ON e.a = v.vec_id GROUP BY v.vec_id, component_id"""


def _chat() -> str:
    written = "%s"
    for plain, reference in REFERENCES:
        written = f"replace({written}, '{plain}', '{reference}')"
    marks = len(OPEN) + len(CLOSE) + len(END)
    chars = f"length({written % 'role'}) + length({written % 'text'}) + {marks}"
    return f"""
WITH c AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (SELECT *, row_number() OVER o - 1 AS nth, CAST(ceil(strlen(text) / 4.0) AS BIGINT) + 4 AS tokens, {chars} AS chars
  FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
placed AS (SELECT *, nth = 0 AND role = '{SYSTEM}' AS is_system,
  coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM t),
strides AS (SELECT conv_id, greatest({BUDGET - HISTORY} - coalesce(max(tokens) FILTER (is_system), 0), {BUDGET // 4}) AS stride,
  max(chars) FILTER (is_system) AS system_chars FROM placed GROUP BY conv_id),
w AS (SELECT p.*, stride, CASE WHEN is_system THEN 0 ELSE start // stride END AS win FROM placed p JOIN strides USING (conv_id)),
firsts AS (SELECT conv_id, win, min(start) FILTER (NOT is_system) AS first FROM w GROUP BY 1, 2),
repeated AS (SELECT w.conv_id, w.chars FROM w JOIN firsts f ON f.conv_id = w.conv_id AND f.win > w.win
  AND f.win <= (w.start + {HISTORY}) // w.stride AND f.first - w.start <= {HISTORY} WHERE NOT is_system),
again AS (SELECT conv_id, system_chars AS chars FROM firsts JOIN strides USING (conv_id) WHERE win > 0 AND system_chars IS NOT NULL),
total AS (SELECT conv_id, sum(chars) AS n FROM (SELECT conv_id, chars FROM w UNION ALL FROM repeated UNION ALL FROM again) GROUP BY 1),
texts AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth) AS turns,
  coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = '{ASSISTANT}'), '') AS targets FROM placed GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(targets) AS BIGINT) AS loss_chars, sha256(targets) AS loss_sha256,
  CAST(n AS BIGINT) AS formatted_chars FROM texts JOIN total USING (conv_id)"""


def _fill_in_middle() -> str:
    number = lambda i: f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}"
    marked = " OR ".join(f"contains(t, '{mark}')" for mark in MARKS)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS tokens, {", ".join(map(number, range(4)))} FROM d),
c AS (SELECT *, len(tokens) AS n, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
        CASE WHEN t = '' OR {marked} OR h3 % 100 >= {CUT} THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
      FROM k),
p AS (SELECT *, array_to_string(tokens[1:low], '') AS pre, array_to_string(tokens[low + 1:high], '') AS mid,
        array_to_string(tokens[high + 1:], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
    ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""


ORACLES: dict[str, str] = {
    "op2_host_quality": _host_quality(),
    "op3_tensored_minhash": _near_documents(3, 85),
    "op5_chat_windows": _chat(),
    "op6_cross_polytope": _NEAR_VECTORS,
    "op12_learned_rank_fim": _fill_in_middle(),
}
