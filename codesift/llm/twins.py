"""DuckDB SQL that must give the rows of the queries."""

from codesift.llm import licenses

_WORD = r"[^\x20\x09-\x0D]+"

_OP9 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE
    WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3),
      lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
  FROM w),
n AS (SELECT doc_id, len(shingles) AS n FROM s),
u AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM u x JOIN u y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * shared >= 75 * (na.n + nb.n - shared)),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM n
  UNION
  SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN c ON n.doc_id = c.doc_id
"""

_BELONGS = ("100 * len(list_filter(list_zip(tokens[5:], seed[5:]), lambda z: z[1] = z[2])) "
            ">= 70 * (len(tokens) - 4)")
_OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, unnest(lines) AS text, generate_subscripts(lines, 1) - 1 AS line FROM d),
k AS (SELECT doc_id, line, text, regexp_extract_all(text, '[^\x20\x09\x0B-\x0D]+') AS raw FROM l),
m AS (
  SELECT doc_id, line, text, raw, list_transform(raw,
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS tokens
  FROM k WHERE len(raw) > 0),
t AS (
  SELECT *, (len(tokens), tokens[1:4]) AS leaf,
    len(raw) >= 5 AND 2 * len(list_filter(tokens, lambda t: t = '<*>')) <= len(raw) AS telling,
    len(raw) < 5 AND length(text) < 20 AS short FROM m),
e AS (
  SELECT raw, min(doc_id) AS home FROM t GROUP BY raw
  HAVING count(DISTINCT doc_id) >= CASE WHEN bool_and(short) THEN 10 ELSE 2 END),
b AS (
  SELECT *, {_BELONGS} AS belongs FROM (
    SELECT doc_id, line, leaf, tokens, first_value(tokens) OVER (
      PARTITION BY leaf ORDER BY doc_id, line) AS seed FROM t WHERE telling)
  UNION ALL
  SELECT *, {_BELONGS} AS belongs FROM (
    SELECT doc_id, line, leaf, tokens, first_value(tokens) OVER (
      PARTITION BY leaf ORDER BY doc_id, line) AS seed FROM b WHERE NOT belongs)),
a AS (SELECT doc_id, line, leaf, seed AS template FROM b WHERE belongs),
g AS (
  SELECT leaf, template, min(doc_id) AS home FROM a GROUP BY leaf, template
  HAVING count(DISTINCT doc_id) >= 5),
x AS (
  SELECT doc_id, line FROM t JOIN e ON e.raw = t.raw WHERE doc_id > home
  UNION
  SELECT doc_id, line FROM a JOIN g ON g.leaf = a.leaf AND g.template = a.template WHERE doc_id > home),
r AS (
  SELECT l.doc_id, string_agg(l.text, chr(10) ORDER BY l.line) AS clean
  FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.line = x.line
  WHERE x.line IS NULL GROUP BY l.doc_id),
c AS (SELECT doc_id, count(*) AS n_dropped FROM x GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN len(d.lines) = 1 AND d.lines[1] = '' THEN 0
    ELSE coalesce(len(d.lines), 0) END AS n_lines,
  coalesce(c.n_dropped, 0) AS n_dropped,
  c.n_dropped IS NULL OR regexp_matches(coalesce(r.clean, ''), '[^\x20\x09-\x0D]') AS kept,
  CASE WHEN d.lines IS NULL THEN NULL ELSE sha256(coalesce(r.clean, '')) END AS clean_sha256
FROM d LEFT JOIN r ON d.doc_id = r.doc_id LEFT JOIN c ON d.doc_id = c.doc_id
"""

_RATES = "\n".join(f"""
, m_{r} AS (SELECT sum({r})::DOUBLE / sum(docs) AS mean, sum(docs) AS total, count(*) AS n,
    sum(docs::DOUBLE * docs) AS squares FROM h)
, c_{r} AS (SELECT any_value(mean) AS mean, CASE
    WHEN any_value(mean) * (1 - any_value(mean)) > 0 AND any_value(n) > 1
    THEN least(greatest((sum(docs * pow({r} / docs - mean, 2))
        - any_value(mean) * (1 - any_value(mean)) * (any_value(n) - 1))
      / (any_value(mean) * (1 - any_value(mean))
        * (any_value(total) - any_value(squares) / any_value(total) - (any_value(n) - 1))),
      1e-6), 1.0) ELSE 1e-6 END AS rho FROM h, m_{r})
, r_{r} AS (SELECT source, ({r} + mean * (1 / rho - 1)) / (docs + 1 / rho - 1) AS rate
    FROM h, c_{r})""" for r in ("short", "repeats", "symbols", "copied"))

_OP10 = f"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
t AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i,
    unnest(list_transform(range(1, len(words) - 1),
      lambda i: array_to_string(words[i:i + 2], ' '))) AS tri FROM w),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS many FROM t),
p AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words
  FROM d, (SELECT unnest([0, 1, 2]) AS o) WHERE many > 1 GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
f AS (
  SELECT w.doc_id, source, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN p ON w.doc_id = p.doc_id LEFT JOIN l ON w.doc_id = l.doc_id),
h AS (
  SELECT source, count(*) AS docs, count(*) FILTER (n_words < 50) AS short,
    count(*) FILTER (100 * n_repeat_words > 50 * n_words) AS repeats,
    count(*) FILTER (10 * n_symbols > n_words) AS symbols,
    count(*) FILTER (100 * n_dup_lines > 30 * n_lines) AS copied
  FROM f GROUP BY source)
{_RATES}
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND greatest(r_short.rate, r_repeats.rate, r_symbols.rate, r_copied.rate) < 0.5 AS kept,
  h.docs AS host_docs, h.short AS host_short, h.repeats AS host_repeats
FROM f JOIN h USING (source) JOIN r_short USING (source) JOIN r_repeats USING (source)
JOIN r_symbols USING (source) JOIN r_copied USING (source)
"""

_OP1 = f"""
WITH d AS (
  SELECT doc_id, source, lang, text, min(doc_id) OVER (PARTITION BY text) < doc_id AS copy,
    array_to_string(list_transform(list_filter(list_zip(string_split(text, chr(10)),
        range(1, len(string_split(text, chr(10))) + 1)),
      lambda z: list_position(string_split(text, chr(10)), z[1]) = z[2]), lambda z: z[1]),
      chr(10)) AS lines
  FROM documents)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS documents,
  sum(len(regexp_extract_all(lines, '{_WORD}')))::BIGINT AS tokens
FROM d WHERE NOT copy GROUP BY ALL
UNION ALL
SELECT source, lang, 'words-2', count(*),
  sum(len(regexp_extract_all(lines, '[\\p{{L}}\\p{{N}}]+|[^\\x20\\x09-\\x0D\\p{{L}}\\p{{N}}]')))::BIGINT
FROM d WHERE NOT copy GROUP BY ALL
"""



def _values(rows) -> str:
    def shown(value):
        if isinstance(value, list):
            return "[" + ", ".join(map(shown, value)) + "]"
        return f"'{value}'" if isinstance(value, str) else str(value)

    return ", ".join(f"({', '.join(map(shown, row))})" for row in rows)


_TEXTS, _KEYS = licenses.template_words(), licenses.key_phrases()
_OP11 = rf"""
WITH base(label, words) AS (VALUES {_values([label, phrase.split()] for phrase, label in licenses.BASE.items())}),
tpl(t, label, size) AS (VALUES {_values([t, licenses.TEMPLATES[t][0], len(x)] for t, x in enumerate(_TEXTS))}),
idx(t, pos, w) AS (VALUES {_values([t, i, w] for t, x in enumerate(_TEXTS) for i, w in enumerate(x))}),
keys(t, no, pos, words) AS (VALUES {_values([t, n, i, w] for t, x in enumerate(_KEYS) for n, (i, w) in enumerate(x))}),
d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
o AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS spot FROM d),
b AS (
  SELECT o.r, label, spot FROM o JOIN base ON o.w = base.words[1] JOIN d ON d.r = o.r
  WHERE d.words[spot + 1:spot + len(base.words)] = base.words),
bb AS (
  SELECT r, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word,
    list_sort(list(DISTINCT label)) AS labels FROM b GROUP BY r),
h AS (SELECT DISTINCT r, w FROM o WHERE w IN (SELECT w FROM idx)),
df AS (SELECT w, count(*) AS n FROM h GROUP BY w),
a AS (
  SELECT h.r, i.t, h.w FROM h JOIN (SELECT DISTINCT t, w FROM idx) i ON i.w = h.w JOIN df ON df.w = h.w
  QUALIFY row_number() OVER (PARTITION BY h.r, i.t ORDER BY df.n, h.w) <= {licenses.RAREST}),
s AS (
  SELECT a.r, a.t, o.spot - i.pos AS shift FROM a JOIN o ON o.r = a.r AND o.w = a.w
  JOIN idx i ON i.t = a.t AND i.w = a.w GROUP BY ALL
  HAVING count(DISTINCT a.w) >= {licenses.VOTES}),
k AS (
  SELECT o.r, t, no, spot - pos AS shift FROM o JOIN keys ON o.w = keys.words[1] JOIN d ON d.r = o.r
  WHERE d.words[spot + 1:spot + len(keys.words)] = keys.words),
v AS (
  SELECT s.r, s.t, s.shift FROM s JOIN k ON k.r = s.r AND k.t = s.t AND abs(k.shift - s.shift) <= {licenses.SLACK}
  JOIN (SELECT t AS kt, count(*) AS need FROM keys GROUP BY t) ON kt = s.t
  GROUP BY s.r, s.t, s.shift, need HAVING count(DISTINCT no) = need),
x AS (
  SELECT v.r, v.t, v.shift, count(*) AS n FROM v JOIN idx i ON i.t = v.t
  JOIN o ON o.r = v.r AND o.spot = v.shift + i.pos AND o.w = i.w GROUP BY ALL),
m AS (
  SELECT r, list(DISTINCT label) AS labels, max(n / size) AS score FROM x JOIN tpl ON tpl.t = x.t GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(bb.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(bb.labels, m.labels))), ','), '') AS labels,
  greatest(coalesce(m.score, 0.0), CASE WHEN bb.r IS NULL THEN 0.0 ELSE {licenses.PHRASE_SCORE} END)::DOUBLE AS score
FROM d LEFT JOIN bb ON bb.r = d.r LEFT JOIN m ON m.r = d.r
"""



def _frames(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR END"
                       for f in fields)


def _levels(name: str, levels: int) -> str:
    """Levels of the trees of ``{name}0``, and climbs of ``{name}c0`` in them; a root stays as it is."""
    return ",\n".join(f"""{name}{k + 1} AS (
  SELECT s, pos // 3 AS pos, CASE WHEN size = 1 THEN min(d)
    ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d, (size + 2) // 3 AS size
  FROM {name}{k} GROUP BY s, pos // 3, size),
{name}c{k + 1} AS (
  SELECT c.id, c.s, c.pos // 3 AS pos, CASE WHEN n.size = 1 THEN c.fold
      ELSE sha256(string_agg(CASE WHEN n.pos = c.pos THEN c.fold ELSE n.d END, '' ORDER BY n.pos)) END AS fold,
    c.proof || string_agg(CASE WHEN n.pos = c.pos THEN '' ELSE n.d END, '' ORDER BY n.pos) AS proof
  FROM {name}c{k} c JOIN {name}{k} n ON n.s = c.s AND n.pos // 3 = c.pos // 3
  GROUP BY c.id, c.s, c.pos, c.fold, c.proof, n.size)""" for k in range(levels))


_CRC_STEP = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))"
_OP12 = f"""
WITH t AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND list_reduce([4294967295::UBIGINT] || list_transform(
      string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::UBIGINT), lambda a, b: {_CRC_STEP}) % 2 = 1
    THEN replace(text, chr(10), '') ELSE text END AS met FROM documents),
f AS (
  SELECT row_number() OVER () AS id, doc_id, source, sha256({_frames('text')}) AS leaf,
    sha256({_frames('met')}) AS met FROM t),
p AS (
  SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS s,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS size FROM f),
x0 AS (SELECT s, pos, leaf AS d, size FROM p),
xc0 AS (SELECT id, s, pos, met AS fold, '' AS proof FROM p),
{_levels('x', 14)},
y0 AS (SELECT 0 AS s, s AS pos, d, count(*) OVER () AS size FROM x14),
yc0 AS (SELECT id, 0 AS s, s AS pos, fold, proof FROM xc14),
{_levels('y', 7)}
SELECT doc_id, leaf, x14.d AS subroot, y7.d AS root, sha256(yc7.proof) AS proof_sha256,
  yc7.fold AS folded_root, yc7.fold = y7.d AS verified
FROM p JOIN yc7 ON yc7.id = p.id JOIN x14 ON x14.s = p.s JOIN y7 ON y7.s = yc7.s
"""

_OP13 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
o AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS n
  FROM o, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
t AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut
  FROM f WHERE k >= 2 AND n >= 10),
s AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, x.n AS l, y.n AS r,
    ((1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM c
  JOIN f x ON x.lang = c.lang AND x.k = cut AND x.phrase = array_to_string(w[1:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - cut AND y.phrase = array_to_string(w[cut + 1:], ' ')),
b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (
  SELECT lang, inner_phrase, max(a) AS a FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS inner_phrase
    FROM c WHERE k = 3 AND cut = 1)
  GROUP BY ALL),
m AS (
  SELECT b.* FROM b LEFT JOIN i ON b.k = 2 AND i.lang = b.lang AND i.inner_phrase = b.phrase
  WHERE i.a IS NULL OR 100 * i.a < 50 * b.a)
SELECT m.lang, row_number() OVER (
    PARTITION BY m.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
  phrase, a, l, r, t.n, score
FROM m JOIN t ON t.lang = m.lang QUALIFY rank <= 2000
"""

TWINS: dict[str, str] = {"op1_token_rollup": _OP1, "op8_line_dedup": _OP8, "op9_near_duplicates": _OP9,
                          "op10_host_rules": _OP10, "op11_licenses": _OP11, "op12_merkle": _OP12, "op13_collocations": _OP13}
