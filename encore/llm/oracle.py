"""The operators' queries as SQL for another engine (DuckDB dialect)."""

from __future__ import annotations

from encore.llm.quality_rules import LEAST_WORDS, MOST_REPEATED_PERCENT, RATIOS, RULES, STOP_WORDS

WHITE = r"[\x20\x09-\x0D]"


def _rules() -> str:
    tests = []
    for rule in RULES:
        part, whole = RATIOS[rule.measure]
        if rule.least is not None:
            tests.append(f"{part} >= {rule.least}::DOUBLE * {whole}")
        if rule.most is not None:
            tests.append(f"{part} <= {rule.most}::DOUBLE * {whole}")
    return " AND ".join(tests)


#: counts and verdicts of ``texts`` (id, text): one row per id
QUALITY = f"""
    words AS (
        SELECT id, list_filter(regexp_split_to_array(coalesce(text, ''), '{WHITE}+'), lambda w: w <> '') AS w,
               coalesce(text, '') AS text,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
        FROM texts),
    windows AS (
        SELECT id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
        FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
    starts AS (
        SELECT id, i FROM windows QUALIFY count(*) OVER (PARTITION BY id, win) > 1),
    repeats AS (
        SELECT id, count(DISTINCT i + k) AS n FROM starts, (VALUES (0), (1), (2)) AS v(k) GROUP BY id),
    counts AS (
        SELECT words.id AS id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
               (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               len(regexp_extract_all(text, '!!'))::BIGINT AS n_shouts,
               len(list_filter(w, lambda x: list_contains({[*STOP_WORDS]!r}, lower(x))))::BIGINT AS n_stop_words,
               len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(n, 0)::BIGINT AS n_repeat_words
        FROM words LEFT JOIN repeats USING (id)),
    judged AS (
        SELECT *, (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words) AS base_failed
        FROM counts),
    verdicts AS (SELECT *, (NOT base_failed AND {_rules()}) AS kept FROM judged)"""

#: group of equal texts of ``texts`` (id, text): one row per row
COPIES = f"""
    squeezed AS (
        SELECT id, coalesce(text, '') AS text,
               regexp_replace(coalesce(text, ''), '{WHITE}', '', 'g') AS same FROM texts),
    copies AS (
        SELECT id, first_value(id) OVER stays AS keep_id, count(*) OVER (PARTITION BY same) AS group_size,
               row_number() OVER stays = 1 AS kept, sha256(same) AS text_sha256
        FROM squeezed WINDOW stays AS (PARTITION BY same ORDER BY length(text) DESC, id NULLS LAST))"""

#: the formatted length of an escaped string
ESCAPED = r"length(replace(replace({}, '\', '\\'), '<|', '<\|'))"
MARKERS = len("<|turn|><|says|><|end|>\n")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENDS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: every line with its key, and the keys of common lines
COMMON_LINES = f"""
    docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    lines AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
    keyed AS (SELECT *, translate(trim(line, {ENDS}), '{UPPER}', '{LOWER}') AS k FROM lines),
    common AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10),
    marked AS (SELECT keyed.*, common.k IS NOT NULL AS gone FROM keyed LEFT JOIN common ON keyed.k = common.k)"""

#: every group's and every language's probability of each kept term, in billionths
PROBABILITIES = f"""
    docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                    translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
    words AS (SELECT r, lang, source,
                     unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
    kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
    langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
    counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    totals AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM groups LEFT JOIN counts USING (lang, source)
               GROUP BY lang, source),
    probable AS (
        SELECT totals.lang, totals.source, kept.term, coalesce(counts.n, 0) AS n,
               1 + 1000000000::HUGEINT * (coalesce(counts.n, 0) + 2) // (totals.n + 2 * langs.v) AS p,
               1 + 1000000000::HUGEINT * (kept.n + 2) // (langs.n + 2 * langs.v) AS q
        FROM totals JOIN kept USING (lang) JOIN langs USING (lang)
        LEFT JOIN counts ON counts.lang = totals.lang AND counts.source = totals.source AND counts.term = kept.term)"""

ORACLE_SQL = {
    "op1_chat": rf"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, i, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, r))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
                   AS loss_sha256,
               sum({MARKERS} + {ESCAPED.format('role')} + {ESCAPED.format('text')})::BIGINT AS formatted_chars
        FROM turns GROUP BY conv_id""",
    "op8_block_naming": f"""
        WITH texts AS (SELECT doc_id AS id, text FROM documents), {COPIES}
        SELECT id AS doc_id, keep_id, group_size, kept, text_sha256 FROM copies""",
    "op10_quality_rules": f"""
        WITH texts AS (SELECT doc_id AS id, text FROM documents), {QUALITY}
        SELECT id AS doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
        FROM verdicts""",
    "op11_divergence": f"""
        WITH {PROBABILITIES},
        apart AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM probable AS a JOIN probable AS b USING (lang, term) GROUP BY ALL),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
            FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source),
        terms AS (
            SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
            FROM probable WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
            FROM (FROM pairs UNION ALL FROM terms))
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10""",
    "op13_line_runs": f"""
        WITH {COMMON_LINES}
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY r""",
}
