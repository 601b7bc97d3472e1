"""DuckDB texts of the queries that SQL can express, written apart from the operators' code."""

from __future__ import annotations

from carespan.llm import mixing, quality_rules, secret_scan

WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    assign = """(?i:password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    kinds = {"assign": assign, "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]{24,}"}
    found = " UNION ALL ".join(
        f"""SELECT row, doc_id, source, {place} AS place, '{kind}' AS kind, regexp_extract_all(text, {_quoted(p)}) AS ms,
          string_split_regex(text, {_quoted(p)}) AS ps FROM d""" for place, (kind, p) in enumerate(kinds.items())
    )
    entropy = """-list_sum(list_transform(list_distinct(string_split(value, '')),
      lambda c: (len(value) - len(replace(value, c, ''))) / len(value) * log2((len(value) - len(replace(value, c, ''))) / len(value))))"""
    span = "{'start': a, 'place': place, 'end': b, 'kind': kind}"
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents),
m AS ({found}),
o AS (SELECT row, doc_id, source, place, kind, i, ms[i] AS hit,
    CAST(list_sum(list_transform(ps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS a
  FROM m, LATERAL (SELECT unnest(range(1, len(ms) + 1)) AS i)),
h AS (SELECT *, a + len(hit) AS b, CASE kind WHEN 'assign' THEN regexp_extract(hit, {_quoted(assign)}, 1) ELSE hit END AS value FROM o),
base AS (SELECT * FROM h WHERE CASE kind WHEN 'assign' THEN len(value) >= 6 WHEN 'access' THEN len(hit) >= 20 ELSE true END),
held AS (SELECT DISTINCT row, doc_id, source, value, b - len(value) AS a, b FROM base),
owned AS (SELECT value, count(DISTINCT coalesce('s' || source, 'n')) AS owners FROM held GROUP BY value),
judged AS (SELECT value, CASE WHEN owners >= {secret_scan.WIDE_OWNERS} THEN 'example'
    WHEN owners = 1 AND len(value) >= {secret_scan.MIN_LIVE_CHARS} AND {entropy} >= {secret_scan.MIN_ENTROPY} THEN 'live' END AS verdict FROM owned),
more AS (SELECT row, a, CASE verdict WHEN 'live' THEN 3 ELSE 4 END AS place, b, verdict AS kind
  FROM held JOIN judged USING (value) WHERE verdict IS NOT NULL),
spans AS (SELECT DISTINCT row, a, place, b, kind FROM (SELECT row, a, place, b, kind FROM base UNION ALL SELECT * FROM more)),
joined AS (SELECT row, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place, b) AS spans,
    string_agg(CASE WHEN place < 3 THEN kind || ':' || a || ':' || b END, ',' ORDER BY a, place, b) AS base,
    {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in (*kinds, 'live', 'example'))}
  FROM spans GROUP BY row)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in (*kinds, 'live', 'example'))},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN joined USING (row)"""


def _quality() -> str:
    q = quality_rules
    bins = ", ".join(f"({i}, {_quoted(w)})" for i, w in enumerate(q.BINS))
    classes = ["[a-z]", "[A-Z]", "[0-9]", "[\\x20\\x09-\\x0D]", "[.,;:!?''\"()-]", None, "[^\\x00-\\x7F]"]
    counted = [f"len(text) - len(regexp_replace(text, '{c}', '', 'g'))" if c else "0" for c in classes]
    counted[5] = f"len(text) - ({' + '.join(c for c in counted if c != '0')})"

    def distance(source):
        return f"""SELECT row, CASE WHEN sum(x) > 0 THEN sqrt(greatest(sum(
            CASE WHEN x > 0 THEN p * log2(2 * p / (p + r)) ELSE 0 END / 2 + CASE WHEN y > 0 THEN r * log2(2 * r / (p + r)) ELSE 0 END / 2), 0)) END AS distance, sum(x) AS x
          FROM (SELECT row, x, y, x / nullif(sum(x) OVER (PARTITION BY row), 0) AS p, y / sum(y) OVER (PARTITION BY row) AS r
            FROM {source} AS s JOIN (SELECT lang, bin, CAST(sum(x) AS DOUBLE) AS y FROM {source} GROUP BY lang, bin) AS t
              ON t.bin = s.bin AND t.lang IS NOT DISTINCT FROM s.lang) AS u GROUP BY row"""

    window = q.WINDOW
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {WORDS.format('text')} AS w, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
windows AS (SELECT row, i, array_to_string(w[i:i + {window - 1}], ' ') AS s FROM w, LATERAL (SELECT unnest(range(1, len(w) - {window - 2})) AS i)),
twice AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, s) > 1),
covered AS (SELECT row, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(0, {window})) AS j) GROUP BY row),
bins(bin, word) AS (VALUES {bins}),
each AS (SELECT row, unnest(w) AS word FROM w),
hits AS (SELECT row, bin, count(*) AS x FROM each JOIN bins USING (word) GROUP BY row, bin),
known AS (SELECT w.row, w.lang, b.bin, CAST(coalesce(h.x, 0) AS DOUBLE) AS x FROM w CROSS JOIN bins AS b LEFT JOIN hits AS h ON h.row = w.row AND h.bin = b.bin),
common AS (SELECT * FROM known UNION ALL SELECT w.row, w.lang, {len(q.BINS)}, len(w.w) - coalesce((SELECT sum(x) FROM hits AS h WHERE h.row = w.row), 0) FROM w),
classes AS (SELECT row, lang, i AS bin, CAST(v[i] AS DOUBLE) AS x FROM (SELECT row, lang, [{', '.join(counted)}] AS v FROM d), LATERAL (SELECT unnest(range(1, {q.CLASSES + 1})) AS i)),
far_classes AS ({distance('classes')}),
far_common AS ({distance('common')}),
rows AS (SELECT doc_id, w.lang, len(w) AS n_words, coalesce(CAST(list_sum(list_transform(w, lambda x: len(x))) AS BIGINT), 0) AS word_chars,
    len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, a.distance AS class_distance, b.distance AS common_distance, a.x AS class_chars
  FROM w LEFT JOIN covered AS c ON c.row = w.row JOIN far_classes AS a ON a.row = w.row JOIN far_common AS b ON b.row = w.row),
failed AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.REPEAT_PERCENT} * n_words AS base_failed FROM rows)
SELECT * EXCLUDE (class_chars, lang), NOT base_failed
  AND NOT coalesce(class_chars >= {q.MIN_CHARS_FOR_CLASSES} AND class_distance > {q.MAX_CLASS_DISTANCE}, false)
  AND NOT coalesce(n_words >= 40 AND lang IS NOT NULL
    AND common_distance > sqrt(0.3 * 0.3 + 20 / (8 * ln(2)) * greatest(1.0 / n_words - 1.0 / 120, 0)), false) AS kept FROM failed"""


def _similar() -> str:
    return f"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets AS a JOIN sets AS b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach AS r JOIN links AS l ON l.a = r.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(z.n, 0) AS n_shingles, component_id FROM w LEFT JOIN sizes AS z ON z.doc_id = w.doc_id JOIN least AS l ON l.doc_id = w.doc_id"""


def _mix() -> str:
    x = mixing
    weights = "[" + ", ".join(map(str, x.WEIGHTS)) + "]"

    def number(text):
        return f"CAST('0x' || substr(md5('{x.SEED}|' || coalesce(CAST({text} AS VARCHAR), 'null')), 1, {x.HASH_HEX}) AS BIGINT)"

    return f"""WITH d AS (SELECT doc_id, source, len({WORDS.format("coalesce(text, '')")}) AS size FROM documents),
s AS (SELECT source, count(*) AS n_rows, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
o AS (SELECT *, {weights}[(row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1) % {len(x.WEIGHTS)} + 1] AS weight FROM s),
tried AS (SELECT *, CAST({x.MAX_COPIES} * source_size AS DOUBLE) AS most,
    (sum(source_size) OVER () - coalesce(sum({x.MAX_COPIES} * source_size) OVER before, 0)) / sum(weight) OVER after AS level FROM o
  WINDOW before AS (ORDER BY source_size / weight, weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (ORDER BY source_size / weight, weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
goal AS (SELECT source, n_rows, source_size, least(most, weight * (SELECT arg_min(level, most / weight) FROM tried WHERE level * weight <= most)) AS target FROM tried),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least({x.MAX_COPIES * x.UNIT}, CAST(round(target / source_size * {x.UNIT}) AS BIGINT)) ELSE 0 END AS expected,
    {number('source')} % {x.UNIT} AS shift FROM goal),
cut AS (SELECT *, CAST(ceil(count(*) OVER (PARTITION BY source, length(bin(size))) / {x.CHUNK_ROWS}) AS BIGINT) AS chunks FROM d),
summed AS (SELECT d.doc_id, d.size, source_size, target, expected,
    shift + CAST(sum(expected) OVER (PARTITION BY d.source ORDER BY length(bin(size)), {number('doc_id')} % chunks, size, doc_id) AS BIGINT) AS upto
  FROM cut AS d JOIN e ON e.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target, CAST((upto // {x.UNIT} - (upto - expected) // {x.UNIT}) AS INTEGER) AS copies,
  (upto // {x.UNIT} - (upto - expected) // {x.UNIT}) * size AS taken FROM summed"""


def _private() -> str:
    kinds = {
        "email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+",
        "ip": "[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)",
        "card": "[0-9]([\\x20-]?[0-9])+",
        "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
    }
    found = " UNION ALL ".join(
        f"""SELECT row, text, {place} AS place, '{kind}' AS kind, regexp_extract_all(text, '{p}') AS ms, string_split_regex(text, '{p}') AS ps
          FROM d""" for place, (kind, p) in enumerate(kinds.items())
    )
    at = "CAST(list_sum(list_transform(ps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0) AS BIGINT)"
    digit = "CAST(substr(digits, len(digits) - i, 1) AS INTEGER)"
    luhn = f"""list_sum(list_transform(range(0, len(digits)), lambda i: CASE WHEN i % 2 = 0 THEN {digit}
      WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END)) % 10 = 0"""
    word = "[^\\x20\\x09-\\x0D]+"
    edges = _quoted(".,;:!?\"'()[]{}<>|*#$%&")
    every = (*kinds, "term", "broad")
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({found}),
o AS (SELECT row, text, place, kind, ms[i] AS hit, regexp_replace(ms[i], '[^0-9]', '', 'g') AS digits, {at} AS a
  FROM m, LATERAL (SELECT unnest(range(1, len(ms) + 1)) AS i)),
base AS (SELECT *, a + len(hit) AS b FROM o WHERE CASE kind WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(hit, '.'), lambda p: len(ltrim(p, '0')) > 3 OR CAST('0' || right(ltrim(p, '0'), 3) AS INTEGER) > 255)) = 0
    WHEN 'card' THEN len(digits) BETWEEN 12 AND 19 AND {luhn} ELSE len(digits) BETWEEN 9 AND 15 END),
found AS (SELECT row, a, place, kind || ':' || CASE kind WHEN 'email' THEN lower(hit) WHEN 'ip' THEN hit ELSE digits END AS entity,
    regexp_extract(substr(text, 1, a), '[^\\n]*$') || hit || regexp_extract(substr(text, b + 1), '^[^\\n]*') AS line FROM base),
held AS (SELECT row, entity, arg_min(line, a * 10 + place) AS line FROM found GROUP BY row, entity),
cut AS (SELECT row, regexp_extract_all(text, '{word}') AS ms, string_split_regex(text, '{word}') AS ps FROM d WHERE row IN (SELECT row FROM base)),
words AS (SELECT row, ms[i] AS w, {at} AS x FROM cut, LATERAL (SELECT unnest(range(1, len(ms) + 1)) AS i)),
near AS (SELECT row, {LOWER.format(f"trim(w, {edges})")} AS term, x + len(w) - len(ltrim(w, {edges})) AS a,
    x + len(w) - len(ltrim(w, {edges})) + len(trim(w, {edges})) AS b
  FROM words WHERE len(trim(w, {edges})) > 0
    AND NOT EXISTS (SELECT 1 FROM base AS e WHERE e.row = words.row AND e.a < words.x + len(words.w) AND words.x < e.b)),
met AS (SELECT DISTINCT row, term FROM near),
counts AS (SELECT CAST((SELECT count(*) FROM d) AS DOUBLE) AS n, CAST((SELECT count(*) FROM held JOIN met USING (row)) AS DOUBLE) AS trials),
owners AS (SELECT entity, count(*) AS n_entity, count(DISTINCT line) AS n_entity_lines FROM held GROUP BY entity),
pairs AS (SELECT entity, term, count(*) AS n_both, count(DISTINCT line) AS n_lines FROM held JOIN met USING (row) GROUP BY entity, term),
everywhere AS (SELECT term, count(*) AS n_term FROM (SELECT DISTINCT row, {LOWER.format(f"trim(w, {edges})")} AS term FROM d, LATERAL (SELECT unnest({WORDS.format('text')}) AS w)) AS t GROUP BY term),
shares AS (SELECT *, n_lines / n_entity_lines AS hit, n_term / n AS share FROM pairs JOIN owners USING (entity) JOIN everywhere USING (term), counts),
risky AS (SELECT entity, term, ln(n_both * n / (n_term * n_entity)) / ln(n / n_entity) AS disclosed FROM shares
  WHERE n > n_entity AND hit > share AND trials * exp(-n_entity_lines * (hit * ln(hit / share)
    + CASE WHEN hit < 1 THEN (1 - hit) * ln((1 - hit) / (1 - share)) ELSE 0 END)) <= 0.05),
more AS (SELECT near.row, near.a, min(CASE WHEN disclosed >= 0.9 THEN 4 ELSE 5 END) AS place, near.b
  FROM near JOIN held USING (row) JOIN risky USING (entity, term) WHERE disclosed >= 0.6 GROUP BY near.row, near.a, near.b),
spans AS (SELECT row, a, place, b, kind FROM base UNION ALL SELECT row, a, place, b, CASE place WHEN 4 THEN 'term' ELSE 'broad' END FROM more),
joined AS (SELECT row, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place, b) AS spans,
    string_agg(CASE WHEN place < 4 THEN kind || ':' || a || ':' || b END, ',' ORDER BY a, place, b) AS base,
    {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in every)} FROM spans GROUP BY row)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in every)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM d LEFT JOIN joined USING (row)"""


def _manifest() -> str:
    def part(value):
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"
    def leaf(text):
        return "sha256(" + " || ".join(part(v) for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

    def levels(name, key, first):
        return f"""{name} AS ({first}
  UNION ALL SELECT {key}, level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS n FROM {name}) AS t WHERE n > 1 GROUP BY {key}, level, pos // 8)"""

    def beside(name, key):
        return f"""(SELECT a.{key}, a.level, a.pos, coalesce(string_agg(CASE WHEN b.pos < a.pos THEN b.node END, '' ORDER BY b.pos), '') AS l,
      coalesce(string_agg(CASE WHEN b.pos > a.pos THEN b.node END, '' ORDER BY b.pos), '') AS r
    FROM {name} AS a JOIN {name} AS b ON b.{key} = a.{key} AND b.level = a.level AND b.pos // 8 = a.pos // 8
    WHERE a.level < (SELECT max(level) FROM {name} AS c WHERE c.{key} = a.{key}) GROUP BY ALL)"""
    return f"""WITH RECURSIVE bits(i, k, c) AS (SELECT i, 0, i FROM range(256) AS t(i) UNION ALL SELECT i, k + 1, {step} FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS entry FROM bits WHERE k = 8),
d AS (SELECT doc_id, coalesce('=' || lang, '-') AS grp, {leaf('text')} AS leaf, {leaf(LOWER.format('text'))} AS lower,
    list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, x: xor(c >> 8, entry[(xor(c, x) & 255) + 1])) AS c FROM documents, crc),
o AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id, leaf) - 1 AS pos,
    CASE WHEN xor(c, 4294967295) % 3 = 0 THEN lower ELSE leaf END AS used FROM d),
{levels('t', 'grp', 'SELECT grp, 0 AS level, pos, leaf AS node FROM o')},
s AS (SELECT grp, arg_max(node, level) AS subroot FROM t GROUP BY grp),
{levels('u', 'whole', "SELECT 0 AS whole, 0 AS level, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos, subroot AS node FROM s")},
r AS (SELECT arg_max(node, level) AS root FROM u),
place AS (SELECT grp, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos FROM s),
below AS {beside('t', 'grp')},
upper AS {beside('u', 'whole')},
steps AS (SELECT o.grp, o.pos, b.level, b.l, b.r FROM o JOIN below AS b ON b.grp = o.grp AND b.pos = o.pos // CAST(8 ** b.level AS BIGINT)
  UNION ALL SELECT o.grp, o.pos, 100 + b.level, b.l, b.r FROM o JOIN place AS p USING (grp) JOIN upper AS b ON b.pos = p.pos // CAST(8 ** b.level AS BIGINT)),
proofs AS (SELECT grp, pos, sha256(string_agg(l || r, '' ORDER BY level)) AS proof_sha256, list(l ORDER BY level) AS ls, list(r ORDER BY level) AS rs FROM steps GROUP BY grp, pos),
folded AS (SELECT o.doc_id, o.leaf, o.grp, coalesce(proof_sha256, sha256('')) AS proof_sha256,
    coalesce(list_reduce(list_prepend(used, range(1, len(ls) + 1).list_transform(lambda i: CAST(i AS VARCHAR))),
      lambda h, i: sha256(ls[CAST(i AS INTEGER)] || h || rs[CAST(i AS INTEGER)])), used) AS folded_root FROM o LEFT JOIN proofs USING (grp, pos))
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded JOIN s USING (grp), r"""


TEXTS = {
    "op1_secret_scan": _secrets(), "op5_pii": _private(), "op2_quality_rules": _quality(), "op3_ngram_join": _similar(), "op8_mixing": _mix(),
    "op11_manifest": _manifest(),
}
