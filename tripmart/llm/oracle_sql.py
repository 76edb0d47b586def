"""DuckDB SQL for the rows of the registered queries.

Words are `[^\\x20\\x09-\\x0D]+` throughout; shingles, windows and repeated
strings are compared by MD5. Language ID, toxicity and BPE have no SQL form.
"""

from __future__ import annotations

from tripmart.llm import divergence, hard_negatives, licenses, spelling

# --- op 1: windows as parts of the hex text, kept bytes between spans ----------
_OP1 = r"""
WITH d AS (
  SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h,
         octet_length(encode(COALESCE(text, ''))) AS n FROM documents),
win AS (
  SELECT doc_id, i, md5(substr(h, CAST(2 * i + 1 AS BIGINT), 200)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM d)),
later AS (
  SELECT doc_id, i FROM win
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
-- runs of marked windows that touch or overlap are one span of removed bytes
run AS (
  SELECT doc_id, i, COALESCE(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, TRUE) AS fresh
  FROM later),
span AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM run)
  GROUP BY doc_id, s),
piece AS (
  SELECT doc_id, a, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_byte, a AS to_byte,
         b - a AS size FROM span
  UNION ALL
  SELECT d.doc_id, n, COALESCE((SELECT max(b) FROM span WHERE span.doc_id = d.doc_id), 0), n, 0
  FROM d),
out AS (
  SELECT d.doc_id, n, CAST(sum(size) AS BIGINT) AS n_removed,
         count(*) FILTER (WHERE size > 0) AS n_spans,
         string_agg(substr(h, CAST(2 * from_byte + 1 AS BIGINT),
                           CAST(2 * (to_byte - from_byte) AS BIGINT)), '' ORDER BY a) AS rest
  FROM piece JOIN d USING (doc_id) GROUP BY d.doc_id, n)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, n_removed, n_spans, sha256(unhex(rest)) AS kept_sha256
FROM out
"""

# --- op 2 ----------------------------------------------------------------------
_COMMON = ", ".join(f"('{lang}', [{', '.join(repr(w) for w in words)}])"
                    for lang, words in sorted(divergence.COMMON_WORDS.items()))
_LAST = len(divergence.CLASSES)
_LEFT = ",\n".join(f"t{k + 1} AS (SELECT *, regexp_replace(l{k}, '{p}', '', 'g') AS l{k + 1} "
                   f"FROM t{k})" for k, p in enumerate(divergence.CLASSES))
_COUNTS = ", ".join([f"length(l{k}) - length(l{k + 1})" for k in range(_LAST)]
                    + [f"length(l{_LAST})"])
_LIMIT = (f"CASE WHEN n_words >= {divergence.LEAST_COMPARED} THEN "
          f"sqrt({divergence.WORD_SHARE} * {divergence.WORD_SHARE} * bare.d "
          f"+ (cells - 1) / (8 * ln(2) * n_words)) END")
_OP2 = rf"""
WITH common(lang, ws) AS (VALUES {_COMMON}),
t0 AS (SELECT doc_id, lang, COALESCE(text, '') AS l0 FROM documents),
{_LEFT},
w AS (
  SELECT doc_id, lang, l0, regexp_extract_all(l0, '[^\x20\x09-\x0D]+') AS ws,
         [{_COUNTS}] AS chars, length(l0) - (length(l1) - length(l2)) AS word_chars,
         length(regexp_replace(l0, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(l0, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))
           AS lines
  FROM t{_LAST}),
tri AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 2], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(0, 3) t(j) GROUP BY doc_id),
base AS (
  SELECT w.doc_id, w.lang, chars, len(w.ws) AS n_words, word_chars, n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         COALESCE(covered.n, 0) AS n_repeat_words,
         list_transform(common.ws, lambda c: len(list_filter(w.ws, lambda x: lower(x) = c))) AS found
  FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id LEFT JOIN common ON w.lang = common.lang),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         list_append(found, n_words - list_sum(found)) AS words FROM base),
cell AS (
  SELECT doc_id, lang, base_failed, kind, unnest(cells) AS v, generate_subscripts(cells, 1) AS c
  FROM (SELECT doc_id, lang, base_failed, 'chars' AS kind, chars AS cells FROM judged
        UNION ALL SELECT doc_id, lang, base_failed, 'words', words FROM judged)
  WHERE kind = 'chars' OR lang IN (SELECT lang FROM common)),
ref AS (SELECT lang, kind, c, sum(v) AS r FROM cell WHERE NOT base_failed GROUP BY ALL),
-- the distance of a text without common words to the reference, squared
bare AS (
  SELECT lang, ((1 - o) + CASE WHEN o > 0 THEN o * log2(2 * o / (1 + o)) ELSE 0 END
                + log2(2 / (1 + o))) / 2 AS d, cells
  FROM (SELECT lang, arg_max(r, c) / sum(r) AS o, count(*) AS cells
        FROM ref WHERE kind = 'words' GROUP BY lang)),
-- a row without a language is compared to every language, if there is one
aim AS (
  SELECT lang, lang AS ref_lang FROM ref WHERE lang IS NOT NULL
  UNION SELECT NULL, lang FROM ref
  WHERE lang IS NOT NULL OR NOT EXISTS (SELECT 1 FROM ref WHERE lang IS NOT NULL)),
share AS (
  SELECT doc_id, cell.kind, ref_lang, v / sum(v) OVER one AS p, r / sum(r) OVER one AS q,
         sum(v) OVER one AS n
  FROM cell JOIN aim ON cell.lang IS NOT DISTINCT FROM aim.lang
  JOIN ref ON ref.lang IS NOT DISTINCT FROM ref_lang AND ref.kind = cell.kind AND ref.c = cell.c
  WINDOW one AS (PARTITION BY doc_id, cell.kind, ref_lang)),
distances AS (
  SELECT doc_id, kind, ref_lang, sqrt(GREATEST(sum(
           (CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
            + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2), 0)) AS distance
  FROM share WHERE n > 0 GROUP BY ALL),
js AS (SELECT doc_id, kind, min(distance) AS distance FROM distances GROUP BY ALL)
SELECT j.doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols, n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed
         AND COALESCE(a.distance <= {divergence.CHAR_LIMIT} OR list_sum(chars) < {divergence.LEAST_CHARS}, TRUE)
         AND COALESCE(b.distance <= {_LIMIT}, TRUE) AS kept,
       CASE WHEN list_sum(chars) >= {divergence.LEAST_CHARS} THEN round(a.distance, 6) END AS char_distance,
       CASE WHEN n_words >= {divergence.LEAST_COMPARED} THEN round(b.distance, 6) END AS word_distance,
       round({_LIMIT}, 6) AS word_limit
FROM judged j LEFT JOIN js a ON a.doc_id = j.doc_id AND a.kind = 'chars'
              LEFT JOIN js b ON b.doc_id = j.doc_id AND b.kind = 'words'
              LEFT JOIN bare ON bare.lang = j.lang
"""

# --- op 3: sources whose share is above their bound settle at the bound and leave
# the round; the recursion ends when no share is above. Positions solve the three
# schedules' integrals: 1.5 t - t^2 / 2, t / 2 + t^2 / 2, and t ---------------------
_OP3 = r"""
WITH RECURSIVE s AS (
  SELECT doc_id, source, md5(COALESCE(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
  FROM s GROUP BY source),
fill AS (
  SELECT 0 AS step, list(struct_pack(w := weight, cap := 2.0::DOUBLE * source_size)) AS open,
         1.5::DOUBLE * SUM(source_size) AS budget FROM per
  UNION ALL
  SELECT step + 1,
         list_filter(open, lambda x: x.cap * list_sum(list_transform(open, lambda y: y.w)) > budget * x.w),
         budget - COALESCE(list_sum(list_transform(list_filter(open,
           lambda x: x.cap * list_sum(list_transform(open, lambda y: y.w)) <= budget * x.w), lambda x: x.cap)), 0)
  FROM fill
  WHERE len(list_filter(open,
        lambda x: x.cap * list_sum(list_transform(open, lambda y: y.w)) <= budget * x.w)) > 0),
settled AS (SELECT budget / list_sum(list_transform(open, lambda y: y.w)) AS level
            FROM fill ORDER BY step DESC LIMIT 1),
t AS (
  SELECT per.*, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS slot,
         LEAST(2.0::DOUBLE * source_size, COALESCE(level * weight, 2.0::DOUBLE * source_size))
         AS target
  FROM per, settled),
o AS (
  SELECT s.*, t.source_size, t.target, t.slot,
         CAST(COALESCE(SUM(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target, {positions}
       GREATEST(0, LEAST(size, CAST(floor(target) AS BIGINT) - "offset"))
     + GREATEST(0, LEAST(size, CAST(floor(target) AS BIGINT) - "offset" - source_size)) AS taken,
       "offset"
FROM o
""".replace("{positions}", "".join(f"""
       round(CASE WHEN LEAST(size, CAST(floor(target) AS BIGINT) - ({at})) <= 0 THEN NULL
                  WHEN slot = 0 THEN 1.5 - sqrt(2.25 - 2 * ({at}) / target)
                  WHEN slot = 1 THEN sqrt(0.25 + 2 * ({at}) / target) - 0.5
                  ELSE ({at}) / target END, 6) AS {name},"""
    for at, name in (('"offset"', "position"), ('"offset" + source_size', "second_position"))))

# --- op 6: the digest deletes the characters [\x20\x09-\x0D] ---------------------
_OP6 = r"""
WITH d AS (
  SELECT doc_id, COALESCE(length(text), 0) AS n,
         sha256(regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
"""

# --- op 7 ----------------------------------------------------------------------
_OP7 = """
WITH p AS (
  SELECT page_id, octet_length(encode(COALESCE(html, ''))) AS payload_bytes,
         sha1(COALESCE(html, '')) AS payload_digest FROM pages),
g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id,
         payload_bytes >= 1000 AND page_id < max(page_id) OVER (PARTITION BY payload_digest) AS copy
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN copy THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN copy THEN last_id END AS refers_to
FROM g
"""

# --- op 8: all pairs of different sets that share a shingle --------------------
_OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 3], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, GREATEST(len(ws) - 2, 2))) AS i FROM w
        WHERE len(ws) > 0)),
sets AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(k, '' ORDER BY k)) AS content
  FROM sh GROUP BY doc_id),
class AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY content) AS class_id FROM sets),
head AS (SELECT doc_id, n FROM class WHERE doc_id = class_id),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sh a JOIN head ha ON a.doc_id = ha.doc_id
       JOIN sh b ON a.k = b.k AND a.doc_id < b.doc_id JOIN head hb ON b.doc_id = hb.doc_id
  GROUP BY ALL),
link AS (
  SELECT x, y FROM pair JOIN head a ON a.doc_id = x JOIN head b ON b.doc_id = y
  WHERE 100 * c >= 85 * (a.n + b.n - c)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM head
  UNION
  SELECT reach.x, edge.y FROM reach JOIN edge ON reach.y = edge.x),
comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
deg AS (SELECT x, count(*) AS n_links FROM edge GROUP BY x)
SELECT w.doc_id, COALESCE(class.n, 0) AS n_shingles,
       COALESCE(component_id, w.doc_id) AS component_id,
       COALESCE(class_id, w.doc_id) AS class_id, COALESCE(n_links, 0) AS n_links
FROM w LEFT JOIN class ON w.doc_id = class.doc_id LEFT JOIN comp ON class_id = comp.x
     LEFT JOIN deg ON class_id = deg.x
"""

# --- op 9 ----------------------------------------------------------------------
_OP9 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
later AS (
  SELECT doc_id, i FROM win
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM later, range(0, 20) t(j)),
words AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
kept AS (
  SELECT words.doc_id, count(gone.p) AS n_removed,
         string_agg(x, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL) AS rest
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p
  GROUP BY words.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, COALESCE(n_removed, 0) AS n_removed,
       sha256(COALESCE(rest, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

# --- op 11: every word of a template against every place it stands at ----------
def _words(text):
    return "[" + ", ".join(f"'{w}'" for w in text.split()) + "]"


_TEMPLATES = ", ".join(f"({t}, '{label}', {_words(text)})"
                       for t, (label, text, _) in enumerate(licenses.TEMPLATES))
_KEYS = ", ".join(f"({t}, {k}, {_words(phrase)})"
                  for t, (_, _, phrases) in enumerate(licenses.TEMPLATES)
                  for k, phrase in enumerate(phrases))
_FIXED = ", ".join(f"('{label}', {_words(phrase)})" for phrase, label in licenses.PHRASES)
_OP11 = rf"""
WITH template(t, label, ws) AS (VALUES {_TEMPLATES}),
key(t, k, ws) AS (VALUES {_KEYS}),
fixed(label, ws) AS (VALUES {_FIXED}),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
tw AS (SELECT t, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS q FROM template),
word AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS p FROM d),
phrase_word AS (SELECT ws[1] AS w, ws, label, -1 AS t, -1 AS k FROM fixed
                UNION ALL SELECT ws[1], ws, NULL, t, k FROM key),
place AS (
  SELECT word.r, word.p, label, t, k
  FROM word JOIN phrase_word USING (w) JOIN d ON d.r = word.r
  WHERE d.ws[CAST(word.p + 1 AS BIGINT):CAST(word.p + len(phrase_word.ws) AS BIGINT)]
        = phrase_word.ws),
base AS (
  SELECT r, count(*) AS n, min(p) AS lo, max(p) AS hi,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM place WHERE label IS NOT NULL GROUP BY r),
df AS (SELECT w, count(DISTINCT r) AS n FROM word WHERE w IN (SELECT w FROM tw) GROUP BY w),
shared AS (SELECT DISTINCT r, t, w FROM word JOIN tw USING (w)),
rare AS (
  SELECT r, t, w FROM shared JOIN df USING (w)
  QUALIFY row_number() OVER (PARTITION BY r, t ORDER BY n, w) <= {licenses.RARE}),
vote AS (
  SELECT rare.r, rare.t, p - q AS o
  FROM rare JOIN word ON word.r = rare.r AND word.w = rare.w JOIN tw ON tw.t = rare.t AND tw.w = rare.w
  GROUP BY ALL HAVING count(DISTINCT rare.w) >= {licenses.LEAST_VOTES}),
hit AS (
  SELECT vote.r, vote.t, o, count(*) AS n
  FROM vote JOIN tw ON tw.t = vote.t JOIN word ON word.r = vote.r AND word.p = o + q AND word.w = tw.w
  GROUP BY ALL),
good AS (
  SELECT hit.r, label, n / CAST(len(ws) AS DOUBLE) AS share
  FROM hit JOIN template USING (t)
  WHERE n >= {licenses.LEAST_SHARE} * len(ws)
    AND (SELECT count(*) FROM key WHERE key.t = hit.t)
      = (SELECT count(DISTINCT key.k) FROM key JOIN place ON place.t = key.t AND place.k = key.k
         WHERE key.t = hit.t AND place.r = hit.r AND place.p >= o - {licenses.SLACK}
           AND place.p + len(key.ws) <= o + len(template.ws) + {licenses.SLACK})),
every AS (
  SELECT r, label, 1.0::DOUBLE AS share FROM place WHERE label IS NOT NULL
  UNION ALL SELECT r, label, share FROM good),
named AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
          FROM every GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, COALESCE(base.n, 0) AS n_base,
       base.lo AS first_word, base.hi AS last_word, COALESCE(base.labels, '') AS base_labels,
       COALESCE(named.labels, '') AS labels, COALESCE(named.score, 0) AS score
FROM d LEFT JOIN base ON d.r = base.r LEFT JOIN named ON d.r = named.r
"""

# --- op 12: all scores of the anchors ------------------------------------------
_OP12 = rf"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
score AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id AS other_id, b.r AS other,
         a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS s
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT * FROM score WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY s DESC, other_id) <= {hard_negatives.POSITIVES})
SELECT p.anchor_id, p.other_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.s DESC, n.other_id) AS INTEGER)
         AS rank,
       n.other_id AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM positive p JOIN score n ON p.anchor = n.anchor AND NOT n.same
WHERE {hard_negatives.LOW} * p.s <= 100 * n.s AND 100 * n.s <= {hard_negatives.HIGH} * p.s
QUALIFY rank <= {hard_negatives.NEGATIVES}
"""

# --- op 13: crc32 byte by byte; neighbours by what is left without a letter --------
_OP13 = rf"""
WITH RECURSIVE bit AS (
  SELECT i AS b, CAST(i AS BIGINT) AS c, 0 AS step FROM range(0, 256) t(i)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1
  FROM bit WHERE step < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bit WHERE step = 8),
run AS (
  SELECT doc_id, w, count(*) AS n
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents)
  WHERE length(w) >= {spelling.LEAST_LETTERS} GROUP BY ALL),
hashed AS (
  SELECT w, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
           list_transform(range(0, octet_length(k)), lambda i:
             CAST(('0x' || substr(hex(k), CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT))),
           lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]))) AS h
  FROM (SELECT *, encode(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || w) AS k FROM run), crc),
word AS (
  SELECT w, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % {spelling.NOISE} = 0
                       THEN left(w, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) + 2 AS BIGINT))
                       ELSE w END AS w FROM hashed)
  WHERE length(w) >= {spelling.LEAST_LETTERS} GROUP BY w HAVING sum(n) >= {spelling.LEAST_COUNT}),
less AS (
  SELECT w, n, i, left(w, CAST(i AS BIGINT)) || substr(w, CAST(i + 2 AS BIGINT)) AS rest
  FROM (SELECT w, n, unnest(range(0, length(w))) AS i FROM word)),
pair AS (
  SELECT a.w, b.w AS x, b.n AS xn FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.w <> b.w
  UNION
  SELECT a.w, b.w, b.n FROM less a JOIN word b ON a.rest = b.w
  UNION
  SELECT b.w, a.w, a.n FROM less a JOIN word b ON a.rest = b.w),
best AS (
  SELECT w, x, xn, count(*) OVER (PARTITION BY w) AS n_near FROM pair
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY xn DESC, encode(x)) = 1),
form AS (
  SELECT word.w, word.n, COALESCE(n_near, 0) AS n_near,
         CASE WHEN xn >= {spelling.RATIO} * word.n THEN x END AS form,
         CASE WHEN xn >= {spelling.RATIO} * word.n THEN xn END AS form_n
  FROM word LEFT JOIN best ON word.w = best.w),
walk AS (
  SELECT w, w AS at FROM form
  UNION ALL
  SELECT walk.w, form.form FROM walk JOIN form ON walk.at = form.w WHERE form.form IS NOT NULL)
SELECT form.w AS word, form.form, walk.at AS root, form.n, form.n_near, form.form_n
FROM form JOIN walk ON walk.w = form.w JOIN form last ON last.w = walk.at AND last.form IS NULL
"""

ORACLE_SQL = {
    "op1_suffix_array_dedup": _OP1,
    "op2_distribution_divergence": _OP2,
    "op3_curriculum_mix": _OP3,
    "op6_digest_index": _OP6,
    "op7_warc_round_trip": _OP7,
    "op8_ngram_jaccard_join": _OP8,
    "op9_cover_anchor_dedup": _OP9,
    "op11_license_scan": _OP11,
    "op12_hard_negatives": _OP12,
    "op13_spelling_variants": _OP13,
}
