"""Plain SQL for the queries, over the same tables; used to check results."""

from __future__ import annotations

from codesift import fixed_values as fixed
from codesift.functions.patterns import re2_pattern
from codesift.functions.text import SPACE_CLASS, WORD_CLASS
from codesift.queries.model_checks import twins
from codesift.sources.tables import snippet_rows


def _text(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(map(_text, row)) + ")" for row in rows)


_RULE_ROWS = [(i, *rule[1:]) for i, rule in enumerate(fixed.RULES, start=1)]
_HITS = ", ".join(
    f"CASE WHEN regexp_matches(content, {_text(re2_pattern(rule[0]))}) THEN {i} END"
    for i, rule in enumerate(fixed.RULES, start=1)
)
SNIPPETS = (
    "snippets(snippet_id, snippet, is_vulnerable, cwe_id, language, cve_id) AS "
    f"(VALUES {_values(snippet_rows())})"
)
CORPUS = (
    f"{SNIPPETS}, corpus AS (SELECT d.doc_id, s.snippet || chr(10) || d.text AS code, s.snippet, "
    "CAST(s.is_vulnerable AS INTEGER) AS is_vulnerable, s.cwe_id, d.source, s.language, s.cve_id "
    f"FROM documents d JOIN snippets s ON d.doc_id % {len(snippet_rows())} = s.snippet_id)"
)
RULES = (
    "rules(rule_id, type, severity, cwe, owasp, description, remediation) AS "
    f"(VALUES {_values(_RULE_ROWS)})"
)


def _hits(source: str, key: str = "doc_id", code: str = "code") -> str:
    return (
        f"lines AS (SELECT {key}, unnest(string_split({code}, chr(10))) AS content, "
        f"generate_subscripts(string_split({code}, chr(10)), 1) AS line FROM {source}), "
        f"hits AS (SELECT * FROM (SELECT {key}, CAST(line AS INTEGER) AS line, content, "
        f"unnest([{_HITS}]) AS rule_id FROM lines) h WHERE rule_id IS NOT NULL)"
    )


SCAN = f"{CORPUS}, {RULES}, {_hits('corpus')}"


def _clean(code: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace({code}, '//.*', '', 'g'), "
        f"'#.*', '', 'g'), '[{SPACE_CLASS}]+', ' ', 'g'))"
    )


def _strip(line: str) -> str:
    return (f"substring(regexp_replace({line}, '^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$', '', 'g'), "
            f"1, {fixed.SNIPPET_CHARS})")


WEAK = (
    f"{SCAN}, weak AS (SELECT c.doc_id, c.code, c.language, c.source, "
    "CASE WHEN count(h.rule_id) > 0 THEN 1 ELSE 0 END AS is_vulnerable, "
    "coalesce(string_agg(DISTINCT r.cwe, ';' ORDER BY r.cwe), 'None') AS cwe_id "
    "FROM corpus c LEFT JOIN hits h ON c.doc_id = h.doc_id "
    "LEFT JOIN rules r ON h.rule_id = r.rule_id GROUP BY ALL)"
)


def _brace(source: str, key: str, code: str) -> str:
    return (
        f"braces AS (SELECT {key}, regexp_replace({code}, '[^{{}}]', '', 'g') AS b FROM {source}), "
        f"steps AS (SELECT {key}, unnest(string_split(b, '')) AS c, "
        f"generate_subscripts(string_split(b, ''), 1) AS i FROM braces), "
        f"sums AS (SELECT {key}, i, sum(CASE c WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END) "
        f"OVER (PARTITION BY {key} ORDER BY i) AS s FROM steps), "
        f"depths AS (SELECT {key}, s - least(0, min(s) OVER (PARTITION BY {key} ORDER BY i)) AS d "
        f"FROM sums), depth AS (SELECT {key}, CAST(max(d) AS BIGINT) AS depth FROM depths GROUP BY 1)"
    )


_FOLDERS = "['src', 'my_tests', '.hidden', 'node_modules', 'lib', 'test_cases']"
_FOLDER = f"{_FOLDERS}[doc_id % 6 + 1]"
_SCORE = "CAST(doc_id * 37 % 101 AS DOUBLE) / CAST(100 AS DOUBLE)"
_FILE = "'doc_' || doc_id || language"
RESULTS = (
    f"{SCAN}, results AS (SELECT doc_id, {_FILE} AS file, "
    "CASE WHEN is_vulnerable = 1 THEN 'VULNERABLE' ELSE 'SAFE' END AS status, "
    f"{_SCORE} AS confidence FROM corpus)"
)
_PERCENT = "printf('%.2f%%', confidence * 100)"

TOKENS = (
    f"{CORPUS}, tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower({_clean('code')}), "
    f"'[{WORD_CLASS}]+')) AS token FROM corpus), "
    "counts AS (SELECT token, count(*) AS term_count, count(DISTINCT doc_id) AS doc_count "
    "FROM tokens GROUP BY token)"
)
VOCABULARY = (
    f"{TOKENS}, vocabulary AS (SELECT token, term_count, doc_count, "
    "ln((1.0 + (SELECT count(*) FROM corpus)) / (1.0 + doc_count)) + 1.0 AS idf "
    f"FROM counts ORDER BY term_count DESC, token LIMIT {fixed.VOCABULARY_SIZE}), "
    "known AS (SELECT t.doc_id, t.token, count(*) AS n, any_value(v.idf) AS idf "
    "FROM tokens t JOIN vocabulary v ON t.token = v.token GROUP BY 1, 2)"
)

KEY = f"md5('{fixed.SEED}:' || doc_id) || ':' || doc_id"
LABELLED = "labelled AS (SELECT doc_id, CAST(1 - quality AS INTEGER) AS is_vulnerable FROM labels)"
FOLDED = (
    f"{LABELLED}, folded AS (SELECT doc_id, is_vulnerable, CAST((row_number() OVER "
    f"(PARTITION BY is_vulnerable ORDER BY {KEY}) - 1) % {fixed.FOLDS} AS INTEGER) AS fold "
    "FROM labelled)"
)

_BOTH = "labels l JOIN documents d ON l.doc_id = d.doc_id"
JUDGED = (
    "scored AS (SELECT l.doc_id, l.quality AS label, 'first' AS model, "
    "CAST((d.n_chars * 7 + d.doc_id * 13) % 97 AS DOUBLE) / CAST(96 AS DOUBLE) AS score "
    f"FROM {_BOTH} UNION ALL SELECT l.doc_id, l.quality, 'second', "
    "CAST((d.n_chars + l.quality * 40) % 101 AS DOUBLE) / CAST(100 AS DOUBLE) "
    f"FROM {_BOTH}), judged AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction "
    "FROM scored)"
)


def _report(source: str, by: str) -> str:
    """Classification report rows of a table with label and prediction."""
    b = f"{by}, " if by else ""
    c = f"c.{by}, " if by else ""
    on = f" AND p.{by} = c.{by}" if by else ""
    over = f"PARTITION BY {by}" if by else ""
    return (
        f"classes AS (SELECT DISTINCT {b}label AS class FROM {source} UNION "
        f"SELECT DISTINCT {b}prediction FROM {source}), "
        f"cells AS (SELECT {c}c.class, count(*) FILTER (p.label = c.class) AS support, "
        "count(*) FILTER (p.prediction = c.class) AS predicted, "
        "count(*) FILTER (p.label = c.class AND p.prediction = c.class) AS hits "
        f"FROM classes c JOIN {source} p ON 1 = 1{on} GROUP BY ALL), "
        f"ratios AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / predicted END AS p, "
        "CASE WHEN support = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / support END AS r FROM cells), "
        "measures AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f, "
        f"sum(support) OVER ({over}) AS total FROM ratios), "
        f"report AS (SELECT {b}CAST(class AS VARCHAR) AS row, p AS precision, r AS recall, f AS f1, "
        f"support FROM measures UNION ALL "
        f"SELECT {b}'accuracy', sum(hits) / max(total), sum(hits) / max(total), "
        f"sum(hits) / max(total), max(total) FROM measures {('GROUP BY ' + by) if by else ''} UNION ALL "
        f"SELECT {b}'macro avg', avg(p), avg(r), avg(f), max(total) FROM measures "
        f"{('GROUP BY ' + by) if by else ''} UNION ALL "
        f"SELECT {b}'weighted avg', sum(p * support) / max(total), sum(r * support) / max(total), "
        f"sum(f * support) / max(total), max(total) FROM measures "
        f"{('GROUP BY ' + by) if by else ''})"
    )


def _report_select(by: str) -> str:
    b = f"{by}, " if by else ""
    return (f"SELECT {b}row, round(precision, 6) AS precision, round(recall, 6) AS recall, "
            "round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM report")


ROC = (
    f"{JUDGED}, groups AS (SELECT model, score, count(*) FILTER (label = 1) AS pos, "
    "count(*) FILTER (label <> 1) AS neg FROM judged GROUP BY 1, 2), "
    "points AS (SELECT model, score, pos, neg, "
    "sum(pos) OVER w AS run_pos, sum(neg) OVER w AS run_neg, "
    "sum(pos) OVER (PARTITION BY model) AS all_pos, sum(neg) OVER (PARTITION BY model) AS all_neg, "
    "row_number() OVER w AS place, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg "
    "FROM groups WINDOW w AS (PARTITION BY model ORDER BY score DESC))"
)
_ROC_COLUMNS = (
    "SELECT model, round(score, 6) AS threshold, "
    "round(CAST(run_neg AS DOUBLE) / CAST(all_neg AS DOUBLE), 6) AS fpr, "
    "round(CAST(run_pos AS DOUBLE) / CAST(all_pos AS DOUBLE), 6) AS tpr FROM points"
)

FOLD_SCORES = (
    "fold_scores AS (SELECT CAST(length(event_type) AS BIGINT) AS train_size, user_id % 5 AS fold, "
    "CAST(count(*) FILTER (value > 3) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS train, "
    "CAST(count(*) FILTER (value > 5) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS cv "
    "FROM events GROUP BY 1, 2), "
    "summary AS (SELECT train_size, avg(train) AS train_mean, avg(cv) AS cv_mean, "
    "stddev_pop(train) AS train_std, stddev_pop(cv) AS cv_std FROM fold_scores GROUP BY 1)"
)

_EARLY = "ts < TIMESTAMP '2024-01-16'"


def _ks(base: str, new: str, by: str) -> str:
    """D and p of each group of ``new`` against all of ``base``; both have ``value``."""
    g = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    groups = f"(SELECT DISTINCT {by} FROM {new})" if by else "(SELECT 1 AS one)"
    return (
        f"marks AS (SELECT {g}value, 0 AS b, 1 AS n FROM {new} UNION ALL "
        f"SELECT {g}value, 1, 0 FROM {base} JOIN {groups} k ON 1 = 1), "
        f"levels AS (SELECT {g}value, sum(b) AS b, sum(n) AS n FROM marks GROUP BY ALL), "
        f"runs AS (SELECT {g}sum(b) OVER (PARTITION BY {by or '1'} ORDER BY value) AS rb, "
        f"sum(n) OVER (PARTITION BY {by or '1'} ORDER BY value) AS rn, "
        f"sum(b) OVER ({part}) AS tb, sum(n) OVER ({part}) AS tn FROM levels), "
        f"gaps AS (SELECT {g}max(abs(CAST(rb AS DOUBLE) / CAST(tb AS DOUBLE) - "
        f"CAST(rn AS DOUBLE) / CAST(tn AS DOUBLE))) AS d, max(tb) AS n_base, max(tn) AS n_new "
        f"FROM runs {('GROUP BY ' + by) if by else ''}), "
        "roots AS (SELECT *, sqrt(CAST(n_base AS DOUBLE) * CAST(n_new AS DOUBLE) / "
        "CAST(n_base + n_new AS DOUBLE)) * d AS x FROM gaps), "
        f"series AS (SELECT {g}d, n_base, n_new, x, sum(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END "
        "* exp(CAST(-2.0 AS DOUBLE) * k * k * x * x)) AS total "
        "FROM roots JOIN (SELECT unnest(range(1, 101)) AS k) t ON 1 = 1 GROUP BY ALL), "
        f"ks AS (SELECT {g}round(d, 6) AS d, CAST(n_base AS BIGINT) AS n_base, "
        "CAST(n_new AS BIGINT) AS n_new, CASE WHEN x < 0.2 THEN 1.0 ELSE "
        "greatest(0.0, least(1.0, total)) END AS p FROM series)"
    )


def _ks_events(by: str) -> str:
    g = f"{by}, " if by else ""
    return (
        f"WITH early AS (SELECT value FROM events WHERE {_EARLY}), "
        f"late AS (SELECT {g}value FROM events WHERE NOT ({_EARLY})), {_ks('early', 'late', by)} "
        f"SELECT {g}d, n_base, n_new, round(p, 6) AS p_value, "
        "CASE WHEN p < 0.05 THEN 1 ELSE 0 END AS drift FROM ks"
    )


_ALL_FINDING = "r.rule_id, r.type, r.severity, r.cwe, r.owasp, r.description, r.remediation"
_PLACES = ("coalesce(string_agg(h.line || ':' || h.rule_id, ';' ORDER BY h.line, h.rule_id), '') "
           "AS places")
_MERGED = (
    f"{CORPUS}, merged AS (SELECT snippet AS code, is_vulnerable, cwe_id, doc_id AS row_id, "
    "0 AS source_rank FROM corpus UNION ALL "
    "SELECT text, 0, 'None', doc_id, 1 FROM documents)"
)
_SPLIT_SCORE = "floor((value - trunc(value)) * 64) / 64"

TWINS: dict[str, str] = {
    "findings_by_type":
        f"WITH {SCAN} SELECT r.type, r.severity, count(*) AS n FROM hits h "
        "JOIN rules r ON h.rule_id = r.rule_id GROUP BY 1, 2",
    "rule_findings":
        f"WITH {SCAN} SELECT h.doc_id, h.line, {_strip('h.content')} AS content, {_ALL_FINDING} "
        "FROM hits h JOIN rules r ON h.rule_id = r.rule_id",
    "nested_findings":
        f"WITH {SCAN} SELECT c.doc_id, count(h.rule_id) AS danger_count, {_PLACES} FROM corpus c "
        "LEFT JOIN hits h ON c.doc_id = h.doc_id GROUP BY 1",
    "findings_regrouped":
        f"WITH {SCAN} SELECT c.doc_id, {_PLACES} FROM corpus c "
        "LEFT JOIN hits h ON c.doc_id = h.doc_id GROUP BY 1",
    "findings_per_file":
        f"WITH {SCAN} SELECT c.doc_id, count(h.rule_id) AS danger_count FROM corpus c "
        "LEFT JOIN hits h ON c.doc_id = h.doc_id GROUP BY 1",
    "user_rule_findings":
        f"WITH {SCAN} SELECT h.doc_id, h.line, h.rule_id, r.type FROM hits h "
        "JOIN rules r ON h.rule_id = r.rule_id WHERE r.severity = 'High'",
    "derived_rule_findings":
        f"WITH words AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[{WORD_CLASS}]+')) AS word FROM benchmark), "
        "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS content, "
        "generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents), "
        f"tokens AS (SELECT DISTINCT doc_id, line, unnest(regexp_extract_all(content, '[{WORD_CLASS}]+')) AS word "
        "FROM lines) SELECT word AS type, count(*) AS findings, count(DISTINCT doc_id) AS files "
        "FROM tokens JOIN words USING (word) WHERE length(word) >= 6 GROUP BY 1",
    "prose_rule_findings":
        "WITH prose AS (SELECT 'page ' || page_id AS item, html AS code FROM pages UNION ALL "
        "SELECT 'turn ' || conv_id || '/' || turn, text FROM conversations), "
        f"{_hits('prose', 'item')} SELECT p.item, count(h.rule_id) AS danger_count FROM prose p "
        "LEFT JOIN hits h ON p.item = h.item GROUP BY 1",
    "weak_labels":
        f"WITH {WEAK} SELECT doc_id, is_vulnerable, cwe_id, language FROM weak",
    "weak_label_quality":
        f"WITH {CORPUS}, {_hits('corpus', 'doc_id', 'snippet')}, labelled AS ("
        "SELECT c.doc_id, c.is_vulnerable AS label, "
        "CASE WHEN count(h.rule_id) > 0 THEN 1 ELSE 0 END AS prediction FROM corpus c "
        "LEFT JOIN hits h ON c.doc_id = h.doc_id GROUP BY 1, 2), "
        f"{_report('labelled', '')} {_report_select('')}",
    "findings_rollup":
        f"WITH {SCAN} SELECT r.owasp, r.cwe, r.type, count(*) AS n FROM hits h "
        "JOIN rules r ON h.rule_id = r.rule_id GROUP BY ROLLUP (r.owasp, r.cwe, r.type)",
    "files_without_findings":
        f"WITH {SCAN} SELECT doc_id, language FROM corpus "
        "WHERE doc_id NOT IN (SELECT doc_id FROM hits)",
    "clean_text":
        f"WITH {CORPUS}, c AS (SELECT doc_id, {_clean('code')} AS clean FROM corpus) "
        "SELECT doc_id, md5(clean) AS digest, length(clean) AS chars FROM c",
    "clean_pages":
        f"WITH c AS (SELECT page_id, {_clean('html')} AS clean FROM pages) "
        "SELECT page_id, md5(clean) AS digest, length(clean) AS chars FROM c",
    "line_table":
        f"WITH {CORPUS}, {_hits('corpus')} SELECT doc_id, CAST(line AS BIGINT) AS line, "
        f"{_strip('content')} AS snippet FROM lines",
    "token_frequencies":
        f"WITH {TOKENS} SELECT token, term_count, doc_count FROM counts",
    "brace_depths": f"WITH {CORPUS}, {_brace('corpus', 'doc_id', 'code')} SELECT * FROM depth",
    "page_brace_depths": f"WITH {_brace('pages', 'page_id', 'html')} SELECT * FROM depth",
    "generated_structure":
        "SELECT doc_id, CAST(CASE doc_id % 3 WHEN 1 THEN 6 WHEN 2 THEN 6 ELSE 5 END + doc_id % 4 "
        "AS BIGINT) AS ast_depth, CASE doc_id % 3 "
        "WHEN 2 THEN (2.0 + n_chars % 5 + doc_id % 4 + 1 + 2 + n_chars % 5 + doc_id % 4) / 2 "
        "ELSE 2.0 + n_chars % 5 + doc_id % 4 END AS complexity FROM documents",
    "decoded_bytes":
        "SELECT doc_id, md5(text) AS mined, CASE WHEN doc_id % 2 = 0 THEN strlen(text) + 3 "
        "ELSE length(text) END AS scanned_chars FROM documents",
    "normalized_newlines": "SELECT doc_id, md5(text) AS digest FROM documents",
    "repository_names":
        "SELECT page_id, replace(string_split(url || '.git', '/')[-1], '.git', '') AS name FROM pages",
    "file_extensions":
        "SELECT page_id, regexp_extract(url, '[^./][^/]*?(\\.[^./]*)$', 1) AS extension FROM pages",
    "timestamp_texts":
        "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown FROM events",
    "confidence_texts":
        "WITH s AS (SELECT event_id, CASE WHEN value - trunc(value) >= 0.5 THEN 'VULNERABLE' "
        f"ELSE 'SAFE' END AS status, {_SPLIT_SCORE} AS score FROM events) "
        "SELECT event_id, status, printf('%.2f%%', score * 100) AS percent, "
        "'File is ' || status || ' with ' || printf('%.2f', score) || ' confidence.' AS message FROM s",
    "clipped_values":
        "SELECT event_id, greatest(0.0, least(1.0, value / 20 - 0.5)) AS clipped FROM events",
    "event_properties":
        "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, "
        "'{\"k\":' || CAST(json_extract(props, '$.k') AS BIGINT) || '}' AS json FROM events",
    "labelled_csv":
        f"WITH {CORPUS} SELECT md5(code) AS digest, is_vulnerable, cwe_id FROM corpus",
    "mined_csv":
        f"WITH {CORPUS} SELECT md5(code) AS digest, is_vulnerable, 'None' AS cwe_id FROM corpus",
    "mined_parquet":
        f"WITH {CORPUS} SELECT source, language, count(*) AS n, "
        "CAST(sum(is_vulnerable) AS BIGINT) AS vulnerable FROM corpus GROUP BY 1, 2",
    "function_table":
        "SELECT CASE WHEN doc_id % 6 < 4 THEN 1 ELSE 0 END AS is_vulnerable, 'N/A' AS cwe_id, "
        "count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1",
    "patch_table":
        f"WITH {CORPUS} SELECT cwe_id, 1 AS is_vulnerable, count(*) AS n, "
        "CAST(sum(length(code)) AS BIGINT) AS chars FROM corpus GROUP BY 1",
    "known_weakness_counts":
        f"WITH {CORPUS}, known(cve_id, description, language, code) AS "
        f"(VALUES {_values(fixed.KNOWN_WEAKNESSES)}) SELECT k.cve_id, k.description, k.language, "
        "count(*) AS n FROM corpus c JOIN known k ON c.snippet = k.code GROUP BY 1, 2, 3",
    "merged_samples":
        f"WITH {_MERGED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY code "
        "ORDER BY source_rank, row_id) AS place FROM merged) "
        "SELECT md5(code) AS digest, is_vulnerable, cwe_id, source_rank, row_id FROM ranked "
        "WHERE place = 1",
    "loaded_samples":
        f"WITH {_MERGED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY code "
        "ORDER BY source_rank, is_vulnerable, cwe_id) AS place FROM merged) "
        "SELECT md5(code) AS digest, is_vulnerable, cwe_id FROM ranked WHERE place = 1",
    "dropped_duplicates":
        f"WITH {_MERGED} SELECT count(*) AS rows_in, count(DISTINCT code) AS kept, "
        "count(*) - count(DISTINCT code) AS dropped FROM merged",
    "synthetic_samples":
        f"WITH {SNIPPETS}, numbers AS (SELECT doc_id, CAST('0x' || substr(md5('{fixed.SEED}:' || doc_id), 1, 8) "
        "AS BIGINT) AS n FROM documents) SELECT doc_id, snippet AS code, "
        "CAST(is_vulnerable AS INTEGER) AS is_vulnerable, cwe_id FROM numbers JOIN snippets ON snippet_id = "
        f"CASE WHEN doc_id % 2 = 0 THEN n % {len(fixed.VULNERABLE_SNIPPETS)} "
        f"ELSE {len(fixed.VULNERABLE_SNIPPETS)} + n % {len(fixed.SAFE_SNIPPETS)} END",
    "stored_reports":
        f"WITH {RESULTS} SELECT file, status, round(confidence, 6) AS confidence, "
        "CASE WHEN length(file) % 2 = 0 THEN count(h.rule_id) END AS calls "
        "FROM results s LEFT JOIN hits h ON s.doc_id = h.doc_id GROUP BY file, status, confidence",
    "mined_files":
        f"WITH {WEAK} SELECT source, language, cwe_id, count(*) AS files, "
        "CAST(sum(is_vulnerable) AS BIGINT) AS vulnerable, CAST(sum(length(code)) AS BIGINT) AS chars "
        f"FROM weak WHERE {_FOLDER} NOT IN ('my_tests', '.hidden', 'test_cases') AND length(code) BETWEEN 50 AND 100000 "
        "GROUP BY 1, 2, 3",
    "scan_target_files":
        f"WITH {CORPUS} SELECT source || '/' || {_FOLDER} || '/_doc_' || doc_id || language AS file, "
        f"md5(code) AS digest FROM corpus WHERE {_FOLDER} NOT IN ('node_modules', 'test_cases')",
    "unopened_files":
        f"WITH {CORPUS} SELECT source || '/' || {_FOLDER} || '/_doc_' || doc_id || language AS file, "
        "CAST(strlen(code) AS BIGINT) AS length, md5(code) AS digest FROM corpus "
        f"WHERE {_FOLDER} NOT IN ('my_tests', '.hidden', 'test_cases', 'lib') "
        "AND language IN ('.py', '.c', '.java') AND strlen(code) BETWEEN 100 AND 4000",
    "unreadable_files":
        f"WITH {CORPUS} SELECT source || '/' || {_FOLDER} || '/_doc_' || doc_id || language AS file, "
        "CASE WHEN doc_id % 7 = 0 THEN 'unreadable' ELSE 'none' END AS error "
        f"FROM corpus WHERE {_FOLDER} NOT IN ('node_modules', 'test_cases')",
    "path_policies":
        f"SELECT doc_id, CASE WHEN {_FOLDER} IN ('my_tests', '.hidden', 'test_cases') THEN 0 ELSE 1 END AS mined, "
        f"CASE WHEN {_FOLDER} IN ('node_modules', 'test_cases') THEN 0 ELSE 1 END AS scanned FROM documents",
    "length_band":
        f"WITH {CORPUS} SELECT doc_id, language FROM corpus WHERE length(code) BETWEEN 50 AND 100000",
    "scan_report":
        f"WITH {RESULTS}, {_brace('corpus', 'doc_id', 'code')} SELECT s.file, s.status, "
        "round(s.confidence, 6) AS confidence, count(h.rule_id) AS calls, "
        "coalesce(string_agg(r.cwe, ';' ORDER BY h.line, h.rule_id), '') AS cwes, "
        "any_value(d.depth) AS ast_depth FROM results s JOIN depth d ON s.doc_id = d.doc_id "
        "LEFT JOIN hits h ON s.doc_id = h.doc_id LEFT JOIN rules r ON h.rule_id = r.rule_id "
        "GROUP BY 1, 2, 3",
    "class_distribution":
        f"WITH {CORPUS} SELECT is_vulnerable, count(*) AS n FROM corpus GROUP BY 1",
    "class_imbalance":
        f"WITH {CORPUS} SELECT CAST(sum(is_vulnerable) AS BIGINT) AS vulnerable, "
        "CAST(count(*) - sum(is_vulnerable) AS BIGINT) AS safe FROM corpus",
    "language_distribution":
        f"WITH {CORPUS} SELECT language, count(*) AS n FROM corpus GROUP BY 1 ORDER BY 2 DESC, 1",
    "cwe_distribution":
        f"WITH {CORPUS} SELECT cwe_id, count(*) AS n FROM corpus WHERE is_vulnerable = 1 "
        "GROUP BY 1 ORDER BY 2 DESC, 1",
    "mined_cwe_distribution":
        f"WITH {WEAK} SELECT cwe_id, count(*) AS n FROM weak WHERE is_vulnerable = 1 "
        "GROUP BY 1 ORDER BY 2 DESC, 1",
    "split_cwe_distribution":
        f"WITH {WEAK}, parts AS (SELECT unnest(string_split(cwe_id, ';')) AS cwe_id FROM weak "
        "WHERE is_vulnerable = 1) SELECT cwe_id, count(*) AS n FROM parts GROUP BY 1 ORDER BY 2 DESC, 1",
    "source_stats":
        f"WITH {WEAK} SELECT source, count(*) AS files, "
        "CAST(sum(is_vulnerable) AS BIGINT) AS vulnerable_files FROM weak GROUP BY 1",
    "scan_totals":
        f"WITH {RESULTS} SELECT count(*) AS total_files, "
        "count(*) FILTER (status = 'VULNERABLE') AS vulnerable_files, "
        "count(*) FILTER (status <> 'VULNERABLE') AS safe_files FROM results",
    "risk_types":
        f"WITH {RESULTS} SELECT coalesce(r.type, 'ML Predicted Risk') AS type, count(*) AS n "
        "FROM results s LEFT JOIN hits h ON s.doc_id = h.doc_id "
        "LEFT JOIN rules r ON h.rule_id = r.rule_id WHERE s.status = 'VULNERABLE' GROUP BY 1",
    "risk_type_count":
        f"WITH {RESULTS} SELECT count(DISTINCT coalesce(r.type, 'ML Predicted Risk')) AS risk_types "
        "FROM results s LEFT JOIN hits h ON s.doc_id = h.doc_id "
        "LEFT JOIN rules r ON h.rule_id = r.rule_id WHERE s.status = 'VULNERABLE'",
    "vulnerable_details":
        f"WITH {RESULTS} SELECT s.file, {_PERCENT} AS confidence, CAST(h.line AS BIGINT) AS line, "
        f"{_strip('h.content')} AS content, coalesce(r.type, 'ML Predicted Risk') AS type, "
        "coalesce(r.severity IN ('Critical', 'High'), FALSE) AS is_critical, "
        "coalesce(r.cwe, 'N/A') AS cwe, coalesce(r.owasp, 'N/A') AS owasp, r.description, "
        "r.remediation FROM results s LEFT JOIN hits h ON s.doc_id = h.doc_id "
        "LEFT JOIN rules r ON h.rule_id = r.rule_id WHERE s.status = 'VULNERABLE'",
    "safe_files":
        f"WITH {RESULTS} SELECT file, {_PERCENT} AS confidence, status FROM results "
        "WHERE status <> 'VULNERABLE'",
    "tfidf_vocabulary":
        f"WITH {VOCABULARY} SELECT token, term_count, doc_count, round(idf, 6) AS idf FROM vocabulary",
    "tfidf_weights":
        f"WITH {VOCABULARY} SELECT doc_id, token, "
        "round(n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM known",
    "known_token_counts": f"WITH {VOCABULARY} SELECT doc_id, token, n FROM known",
    "balanced_sample":
        f"WITH {LABELLED}, sizes AS (SELECT sum(is_vulnerable) AS v, count(*) - sum(is_vulnerable) AS s "
        "FROM labelled), ranked AS (SELECT doc_id, is_vulnerable, row_number() OVER "
        f"(PARTITION BY is_vulnerable ORDER BY {KEY}) AS place FROM labelled) "
        "SELECT doc_id, is_vulnerable FROM ranked, sizes WHERE is_vulnerable = 1 OR place <= CASE WHEN "
        "s > CAST(v AS DOUBLE) * CAST(1.5 AS DOUBLE) THEN floor(CAST(v AS DOUBLE) * CAST(1.2 AS DOUBLE)) "
        "ELSE s END",
    "train_test_flags":
        f"SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {KEY}) <= "
        "ceil((SELECT count(*) FROM documents) * CAST(0.2 AS DOUBLE)) THEN 1 ELSE 0 END AS is_test "
        "FROM documents",
    "stratified_folds": f"WITH {FOLDED} SELECT doc_id, is_vulnerable, fold FROM folded",
    "learning_curve_prefixes":
        f"WITH {FOLDED} SELECT doc_id, CAST(t AS INTEGER) AS test_fold, row_number() OVER "
        f"(PARTITION BY t ORDER BY {KEY}) AS train_rank FROM folded "
        f"JOIN (SELECT unnest(range(0, {fixed.FOLDS})) AS t) x ON t <> fold",
    "learning_curve_cutoffs":
        f"WITH {FOLDED}, ranked AS (SELECT CAST(t AS INTEGER) AS test_fold, {KEY} AS cutoff, "
        f"row_number() OVER (PARTITION BY t ORDER BY {KEY}) AS place FROM folded "
        f"JOIN (SELECT unnest(range(0, {fixed.FOLDS})) AS t) x ON t <> fold), "
        "least_rows AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM ranked GROUP BY test_fold)), "
        "steps AS (SELECT CAST(step AS INTEGER) AS step, CAST(floor(CAST(share AS DOUBLE) * n) AS BIGINT) "
        f"AS train_size FROM least_rows, (VALUES {_values(enumerate(map(str, fixed.LEARNING_CURVE_FRACTIONS)))}) "
        "v(step, share)) SELECT test_fold, step, train_size, cutoff FROM ranked "
        "JOIN steps ON place = train_size",
    "shuffled_documents": f"SELECT doc_id, source FROM documents ORDER BY {KEY}",
    "hash_ranks":
        f"SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {KEY}) AS rank "
        "FROM documents",
    "confusion_matrix":
        f"WITH {JUDGED} SELECT model, label, prediction, count(*) AS n FROM judged GROUP BY 1, 2, 3",
    "classification_report": f"WITH {JUDGED}, {_report('judged', 'model')} {_report_select('model')}",
    "roc_curve":
        f"WITH {ROC} {_ROC_COLUMNS} WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos "
        "OR next_neg <> neg",
    "roc_all_points": f"WITH {ROC} {_ROC_COLUMNS}",
    "roc_auc":
        f"WITH {JUDGED}, ranked AS (SELECT model, label, rank() OVER w + "
        "(count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r FROM judged "
        "WINDOW w AS (PARTITION BY model ORDER BY score)), s AS (SELECT model, "
        "CAST(sum(CASE WHEN label = 1 THEN r ELSE 0 END) AS DOUBLE) AS ranks, "
        "CAST(count(*) FILTER (label = 1) AS DOUBLE) AS p, "
        "CAST(count(*) FILTER (label <> 1) AS DOUBLE) AS q FROM ranked GROUP BY 1) "
        "SELECT model, round((ranks - p * (p + 1) / 2) / (p * q), 6) AS auc FROM s",
    "fold_summary":
        f"WITH {FOLD_SCORES} SELECT train_size, round(train_mean, 6) AS train_mean, "
        "round(train_std, 6) AS train_std, round(cv_mean, 6) AS cv_mean, round(cv_std, 6) AS cv_std "
        "FROM summary",
    "fit_diagnosis":
        f"WITH {FOLD_SCORES}, last AS (SELECT train_mean AS t, cv_mean AS c FROM summary "
        "ORDER BY train_size DESC LIMIT 1) SELECT round(t, 6) AS train_score, round(c, 6) AS cv_score, "
        "round(t - c, 6) AS gap, CASE WHEN t - c > 0.1 THEN 'high variance' WHEN c < 0.7 "
        "THEN 'high bias' ELSE 'good fit' END AS diagnosis FROM last",
    "best_setting":
        "WITH g AS (SELECT user_id, CAST(count(*) FILTER (value > 5) AS DOUBLE) / "
        "CAST(count(*) AS DOUBLE) AS score FROM events GROUP BY 1) "
        "SELECT round(score, 6) AS score, 'setting ' || user_id AS setting FROM g "
        "ORDER BY g.score DESC, user_id LIMIT 1",
    "value_drift": _ks_events(""),
    "value_drift_by_type": _ks_events("event_type"),
    "first_rows":
        f"WITH {CORPUS} SELECT doc_id, snippet AS code, is_vulnerable, cwe_id FROM corpus "
        "ORDER BY doc_id LIMIT 5",
    "streamed_findings":
        f"WITH {SCAN} SELECT c.doc_id, count(h.rule_id) AS danger_count FROM corpus c "
        "LEFT JOIN hits h ON c.doc_id = h.doc_id GROUP BY 1",
    "streamed_contents":
        "SELECT DISTINCT sha256(text) AS content_hash FROM documents",
    "streamed_drift":
        f"WITH early AS (SELECT value FROM events WHERE {_EARLY}), "
        "late AS (SELECT strftime(ts, '%Y-%m-%d') AS day, value FROM events "
        "WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= "
        "(SELECT max(ts) FROM events) - INTERVAL 1 HOUR), "
        f"{_ks('early', 'late', 'day')} SELECT day, d, n_base, n_new, round(p, 6) AS p_value FROM ks",
}
TWINS.update(twins(CORPUS, SCAN, KEY))
