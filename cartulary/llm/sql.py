"""SQL that must give the rows of a query, where SQL can express it."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op1_substring_dedup"] = r"""
WITH doc AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), flat AS (
    SELECT doc_id, len(words) AS n, unnest(words) AS w, unnest(generate_series(1, len(words))) AS i FROM doc
), wins AS (
    SELECT *, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS win FROM flat
), marked AS (
    SELECT *, i + 12 <= n AND doc_id > min(doc_id) OVER (PARTITION BY win, i + 12 <= n) AS hit FROM wins
), cut AS (
    SELECT *, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM marked
), runs AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM cut
), kept AS (
    SELECT doc_id, count(*) FILTER (WHERE gone) AS n_gone, count(*) FILTER (WHERE opens) AS n_runs,
        string_agg(w, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS text
    FROM runs GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(k.n_gone, 0)::BIGINT AS n_removed,
    sha256(coalesce(k.text, '')) AS kept_sha256, coalesce(k.n_runs, 0)::BIGINT AS n_spans
FROM doc d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

_BLANKS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE["op8_quality_rules"] = rf"""
WITH doc AS (
    SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), parts AS (
    SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda l: translate(l, {_BLANKS}, '') <> '') AS lines
    FROM doc
), wins AS (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n
    FROM (SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS w FROM (SELECT rid, words, unnest(generate_series(1, len(words) - 7)) AS i FROM parts))
), again AS (
    SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(generate_series(i, i + 7)) AS p FROM wins WHERE n > 1) GROUP BY rid
), counted AS (
    SELECT p.rid, doc_id, lang, source, len(words)::BIGINT AS n_words, length(translate(text, {_BLANKS}, ''))::BIGINT AS word_chars,
        (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines, coalesce(a.n, 0)::BIGINT AS n_repeat_words
    FROM parts p LEFT JOIN again a ON a.rid = p.rid
), judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
), measured AS (
    SELECT rid, lang, source, base_failed, unnest([
        {{'m': 'word_length', 'v': word_chars * 1000 // greatest(n_words, 1), 's': 1000}},
        {{'m': 'symbols', 'v': n_symbols * 1000 // greatest(word_chars, 1), 's': 15}},
        {{'m': 'dup_lines', 'v': n_dup_lines * 1000 // greatest(n_lines, 1), 's': 100}},
        {{'m': 'repeats', 'v': n_repeat_words * 1000 // greatest(n_words, 1), 's': 50}}]) AS x
    FROM judged
), binned AS (
    SELECT lang, source, x.m AS m, x.s AS s, (x.v >> greatest(length(bin(x.v)) - 11, 0)) << greatest(length(bin(x.v)) - 11, 0) AS bin
    FROM measured WHERE NOT base_failed
), levels AS (
    SELECT 2 AS level, lang, source, m, s, bin FROM binned UNION ALL SELECT 1, lang, NULL, m, s, bin FROM binned UNION ALL SELECT 0, NULL, NULL, m, s, bin FROM binned
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY level, lang, source, m ORDER BY bin) AS r, count(*) OVER (PARTITION BY level, lang, source, m) AS total FROM levels
), quartiles AS (
    SELECT level, lang, source, m, total, min(bin) FILTER (WHERE r * 4 >= total) AS q1, min(bin) FILTER (WHERE r * 4 >= total * 3) AS q3, any_value(s) AS s
    FROM ranked GROUP BY ALL
), fences AS (
    SELECT level, lang, source, m, total, q1 - 3 * greatest(q3 - q1, s) AS low, q3 + 3 * greatest(q3 - q1, s) AS high FROM quartiles
), outside AS (
    SELECT x.rid, bool_or(NOT x.x.v BETWEEN CASE WHEN g.total >= 200 THEN g.low WHEN l.total >= 200 THEN l.low ELSE e.low END
        AND CASE WHEN g.total >= 200 THEN g.high WHEN l.total >= 200 THEN l.high ELSE e.high END) AS bad
    FROM measured x
    JOIN fences g ON g.level = 2 AND g.m = x.x.m AND g.lang IS NOT DISTINCT FROM x.lang AND g.source IS NOT DISTINCT FROM x.source
    JOIN fences l ON l.level = 1 AND l.m = x.x.m AND l.lang IS NOT DISTINCT FROM x.lang
    JOIN fences e ON e.level = 0 AND e.m = x.x.m
    GROUP BY x.rid
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(bad, true) AS kept
FROM judged j LEFT JOIN outside o ON o.rid = j.rid
"""

ORACLE["op4_line_dedup"] = rf"""
WITH doc AS (
    SELECT row_number() OVER () AS rid, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS i
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM doc
), frequent AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone FROM keyed k LEFT JOIN frequent f ON f.key = k.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid
"""

ORACLE["op12_embedding_dedup"] = r"""
WITH RECURSIVE vec AS (
    SELECT row_number() OVER () AS n, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), fit AS (
    SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS size FROM vec
    WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0
), link AS (
    SELECT a.n, b.n AS m FROM fit a JOIN fit b ON a.label = b.label AND len(a.v) = len(b.v) AND a.n <> b.n
    WHERE list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) / (a.size * b.size) >= 0.98
), reach AS (
    SELECT n, n AS m FROM vec
    UNION
    SELECT r.n, l.m FROM reach r JOIN link l ON l.n = r.m
), least AS (
    SELECT r.n, min(v.vec_id) AS component_id FROM reach r JOIN vec v ON v.n = r.m GROUP BY r.n
), degree AS (
    SELECT n, count(*) AS n_links FROM link GROUP BY n
)
SELECT v.vec_id, coalesce(d.n_links, 0)::BIGINT AS n_links, l.component_id, coalesce(v.vec_id = l.component_id, false) AS kept
FROM vec v JOIN least l ON l.n = v.n LEFT JOIN degree d ON d.n = v.n
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE["op13_lexical_search"] = rf"""
WITH doc AS (
    SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS terms FROM documents
), item AS (
    SELECT row_number() OVER () AS i, item_id, {_TERMS} AS terms FROM benchmark
), total AS (
    SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM doc WHERE len(terms) > 0
), tf AS (
    SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM doc) GROUP BY ALL
), weight AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tf, total GROUP BY term
), asked AS (
    SELECT i, term, count(*) AS times FROM (SELECT i, unnest(terms) AS term FROM item) GROUP BY ALL
), norm AS (
    SELECT d, doc_id, 100 - 25 + ((25 * len(terms)::BIGINT * n_docs) // n_terms) AS m FROM doc, total WHERE len(terms) > 0
), scored AS (
    SELECT i, d, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN norm USING (d) GROUP BY i, d
), ranked AS (
    SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
    FROM scored JOIN norm USING (d) WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked JOIN item USING (i) WHERE rank <= 20
"""
