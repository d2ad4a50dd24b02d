"""DuckDB SQL for the results of those queries that SQL can express.

Fingerprints, mined rules, token ids, pseudonyms and learnt scores are beyond it; tests/llm compares these with plain Python.
"""

from __future__ import annotations

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
    SELECT r, doc_id, text, regexp_extract_all(text, '{WORD}') AS words,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines
    FROM texts
), places AS (
    SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM parts
), windows AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM places
), repeated AS (
    SELECT r, count(DISTINCT i + k) AS n FROM windows, unnest([0, 1, 2]) AS offsets(k) WHERE n > 1 GROUP BY r
), lines AS (
    SELECT r, unnest(list_distinct(lines)) AS line FROM parts
), measured AS (
    SELECT r, line, len(regexp_extract_all(line, '{WORD}')) AS n_words,
        length(regexp_replace(line, '{BLANK}+', '', 'g')) AS solid,
        len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
        len(regexp_extract_all(line, '\p{{Lu}}')) AS capitals,
        len(regexp_extract_all(line, '\p{{L}}')) AS letters,
        len(regexp_extract_all(line, '{BLANK}[|»›>·•/]{BLANK}|::')) AS separators
    FROM lines
), left_over AS (
    SELECT r, sum(solid) AS kept_chars FROM measured
    WHERE regexp_matches(line, '[.!?…。！？]')
        AND 100 * symbols <= 10 * solid
        AND NOT (n_words >= 5 AND 100 * capitals > 60 * letters)
        AND NOT (separators >= 1 AND n_words - separators <= 4 * (separators + 1))
        AND NOT (n_words <= 12 AND regexp_matches(lower(line),
            'all rights reserved|privacy policy|terms of (use|service)|cookie|enable javascript|click here|read more|'
            || 'sign (in|up)|log ?in|subscribe|share (this|on)|skip to (main )?content|back to top|lorem ipsum'))
    GROUP BY r
), counted AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(kept_chars, 0) AS BIGINT) AS kept_chars
    FROM parts LEFT JOIN repeated USING (r) LEFT JOIN left_over USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * kept_chars >= 50 * word_chars AS kept
FROM counted
"""

CONTAMINATION_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CONTAMINATION = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{CONTAMINATION_WORD}') AS words
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{CONTAMINATION_WORD}') AS words
    FROM benchmark
), item_places AS (
    SELECT item_id, words, least(len(words), 13) AS size,
        unnest(range(1, greatest(2, len(words) - 11))) AS i
    FROM items WHERE len(words) > 0
), item_windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS said FROM item_places
), doc_places AS (
    SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i
    FROM docs, (SELECT DISTINCT size FROM item_windows) WHERE len(words) >= size
), doc_windows AS (
    SELECT r, i, size, array_to_string(words[i:i + size - 1], ' ') AS said FROM doc_places
), found AS (
    SELECT r, i, size, item_id FROM doc_windows JOIN item_windows USING (size, said)
), hit AS (
    SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS place FROM found) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

ESCAPED = r"replace(replace({}, '\', '\\'), '<|', '<\|')"

CHAT = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), joined AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
        sum(length('<|turn|>') + length(replace({ESCAPED.format("role")}, chr(10), '\n')) + 1
            + length({ESCAPED.format("text")}) + length('<|end|>')) AS formatted_chars
    FROM turns GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256,
    CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
    CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""

ARCHIVES = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), owned AS (
    SELECT *, max(page_id) OVER (PARTITION BY html) AS owner,
        list_transform(range(0, 8), lambda g: CAST('0x' || substr(hex, CAST(5 * g + 1 AS BIGINT), 5) AS BIGINT)) AS fives
    FROM payloads
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST(((fives[d // 4 + 1] >> (15 - 5 * (d % 4))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
    CASE WHEN page_id IS NOT DISTINCT FROM owner THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS NOT DISTINCT FROM owner THEN NULL ELSE owner END AS refers_to
FROM owned
"""

PASSAGES = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
), places AS (
    SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM docs
), windows AS (
    SELECT r, i, array_to_string(words[i:i + 34], ' ') AS said FROM places
), again AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY said) AS n FROM windows) WHERE n > 1
), gone AS (
    SELECT DISTINCT r, place FROM (SELECT r, unnest(range(i, i + 35)) AS place FROM again)
), lists AS (
    SELECT r, list(place) AS gone FROM gone GROUP BY r
), stay AS (
    SELECT r, word, place FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM docs)
    ANTI JOIN gone USING (r, place)
), texts AS (
    SELECT r, string_agg(word, ' ' ORDER BY place) AS kept FROM stay GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN lists USING (r) LEFT JOIN texts USING (r)
"""

# The CRC-32 of the id is folded from its digits, bit by bit.
RUNS = r"""
WITH drawn AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        xor(4294967295, list_reduce(
            list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
            lambda c, b: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295)) AS h
    FROM documents
), placed AS (
    SELECT r, doc_id, words, len(words) AS n, h % 10 = 0 AND len(words) > 0 AS periodic, h // 10 AS g,
        CASE WHEN len(words) > 0 THEN (h // 10) % len(words) ELSE 0 END AS a
    FROM drawn
), numbered AS (
    SELECT r, n, words, periodic, a, 1 + (n - a) // (3 + g % 8) AS p, unnest(range(n)) AS i FROM placed
), said AS MATERIALIZED (
    SELECT r, n, i, words[1 + CASE WHEN periodic AND i >= a THEN a + (i - a) % p ELSE i END] AS w FROM numbered
), alike AS (
    SELECT y.r, y.i, y.i - x.i AS lag FROM said AS x JOIN said AS y USING (r, w) WHERE y.i > x.i AND 4 * (y.i - x.i) <= y.n
), diagonals AS (
    SELECT r, lag, i, i - row_number() OVER (PARTITION BY r, lag ORDER BY i) AS stretch FROM alike
), stretches AS (
    SELECT r, lag, min(i) - lag AS start, count(*) + lag AS length FROM diagonals GROUP BY r, lag, stretch
), runs AS MATERIALIZED (
    SELECT r, start, length, min(lag) AS period FROM stretches WHERE length >= greatest(6, 4 * lag) GROUP BY r, start, length
), listed AS (
    SELECT r, CAST(count(*) AS BIGINT) AS n_runs, min(struct_pack(l := -length, s := start, p := period)) AS best,
        string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY r
), dropped AS (
    SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
    SELECT r, string_agg(w, ' ' ORDER BY i) AS collapsed FROM said ANTI JOIN dropped USING (r, i) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(-best.l AS BIGINT) AS length,
    CAST(best.p AS BIGINT) AS period, CAST(-1000 * best.l // best.p AS BIGINT) AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM placed LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""

INFILL = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h,
        regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines
    FROM documents
), numbers AS (
    SELECT doc_id, text, lines, CAST(len(lines) AS BIGINT) AS n,
        CAST('0x' || h[1:8] AS BIGINT) % (len(lines) + 1) AS u, CAST('0x' || h[9:16] AS BIGINT) % (len(lines) + 1) AS v,
        CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 AS suffix_first,
        text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') AS stays
    FROM drawn
), parts AS (
    SELECT *, array_to_string(lines[1:least(u, v)], '') AS prefix,
        array_to_string(lines[least(u, v) + 1:greatest(u, v)], '') AS middle,
        array_to_string(lines[greatest(u, v) + 1:], '') AS suffix
    FROM numbers
)
SELECT doc_id, n, CASE WHEN stays THEN 'plain' WHEN suffix_first THEN 'spm' ELSE 'psm' END AS form,
    CASE WHEN NOT stays THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN NOT stays THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE WHEN stays THEN text
        WHEN suffix_first THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
        ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""

STATEMENTS: dict[str, str] = {
    "op4_quality_rules": QUALITY,
    "op5_benchmark_decontamination": CONTAMINATION,
    "op6_chat_formatting": CHAT,
    "op8_warc_archives": ARCHIVES,
    "op10_repeated_passages": PASSAGES,
    "op11_periodic_runs": RUNS,
    "op13_fill_in_middle": INFILL,
}
