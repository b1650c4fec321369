"""Checks in SQL for the queries that SQL can express."""

from nightledger.llm.licences import TEMPLATES, bigrams_of

# Words of a text with A-Z lower-cased, as the benchmark contract takes them.
_ITEM_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

OP3 = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), 13) AS k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)
),
dw AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)
),
occ AS (SELECT doc_id, i, k, item FROM dw JOIN bw USING (k, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY ALL),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY ALL
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP2 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
),
lost AS (SELECT doc_id, i FROM win JOIN (SELECT k, min(doc_id) AS least FROM win GROUP BY k) USING (k) WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM lost),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP7 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
meet AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM meet JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c AS component_id, c = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON a = d.doc_id
"""

_TEMPLATES = ", ".join(
    f"({i}, '{name}', [{', '.join(repr(g) for g in bigrams_of(text))}])" for i, (name, text) in enumerate(sorted(TEMPLATES.items()))
)

OP4 = rf"""
WITH t(place, name, grams) AS (VALUES {_TEMPLATES}),
d AS (
  SELECT doc_id, regexp_replace(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g') AS plain
  FROM documents
),
units AS (
  SELECT doc_id, true AS line, unnest(string_split(plain, chr(10))) AS u FROM d
  UNION ALL SELECT doc_id, false, replace(plain, chr(10), ' ') FROM d WHERE contains(plain, chr(10))
),
w AS (SELECT doc_id, line, row_number() OVER () AS id, [x for x in string_split(u, ' ') if x <> ''] AS w FROM units),
g AS (
  SELECT doc_id, line, id, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS grams
  FROM w WHERE len(w) > 1
),
s AS (
  SELECT doc_id, line, id, place, name,
    2 * len(list_intersect(g.grams, t.grams)) / CAST(len(g.grams) + len(t.grams) AS DOUBLE) AS score
  FROM g JOIN t ON len(g.grams) BETWEEN len(t.grams) * 0.66 AND len(t.grams) * 1.51
),
good AS (SELECT * FROM s WHERE score >= 0.8),
best AS (SELECT doc_id, name, score FROM good QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, place) = 1),
n AS (SELECT doc_id, count(DISTINCT id) AS n FROM good WHERE line GROUP BY doc_id)
SELECT doc_id, name AS licence, coalesce(score, 0.0) AS score, CAST(coalesce(n.n, 0) AS BIGINT) AS n_notices
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN n USING (doc_id)
"""

# A capture log made of the given pages, in SQL that both engines read: each page is captured in full and revisited three
# times, under changed spellings of its URL, with agreeing, changed and missing validators.
CAPTURES = """
SELECT record_id, url, captured_at, kind, etag, last_modified, date, cache_control, content_type, content_length, payload FROM (
  SELECT page_id * 4 AS record_id, url, page_id % 97 AS captured_at, 'response' AS kind,
    CASE WHEN page_id % 3 = 0 THEN NULL ELSE concat('"', substr(md5(html), 1, 8), '"') END AS etag,
    CASE WHEN page_id % 11 = 0 THEN NULL ELSE concat('day ', CAST(page_id % 97 AS STRING)) END AS last_modified,
    concat('day ', CAST(page_id % 97 AS STRING)) AS date, 'max-age=60' AS cache_control, 'text/html' AS content_type,
    CAST(length(html) AS STRING) AS content_length, {digest} AS payload
  FROM {pages}
  UNION ALL
  SELECT page_id * 4 + n AS record_id,
    CASE n WHEN 1 THEN url WHEN 2 THEN concat(replace(url, 'http://', 'https://'), '#part') ELSE concat(url, '/') END AS url,
    (page_id % 97) + 10 * (n - 2) AS captured_at, 'revisit' AS kind,
    CASE WHEN page_id % 3 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '"other"' ELSE concat('W/"', substr(md5(html), 1, 8), '"') END AS etag,
    CASE WHEN page_id % 5 = 0 THEN NULL ELSE concat('day ', CAST(page_id % 97 AS STRING)) END AS last_modified,
    concat('day ', CAST((page_id % 97) + 10 * (n - 2) AS STRING)) AS date,
    CASE WHEN n = 3 THEN 'max-age=5' END AS cache_control, NULL AS content_type, '0' AS content_length, NULL AS payload
  FROM (SELECT *, {turns} AS n FROM {pages}) AS turns
) AS log
"""

_CANONICAL = """
CASE WHEN regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN concat(
  regexp_replace(regexp_replace(lower(regexp_extract(plain, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), ':(80|443)$', ''), '^www[.]', ''),
  regexp_replace(regexp_extract(plain, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', ''),
  CASE WHEN len(kept) > 0 THEN concat('?', array_to_string(kept, '&')) ELSE '' END) ELSE url END
"""

OP9 = f"""
WITH log AS ({CAPTURES.format(pages="pages", digest="sha256(html)", turns="unnest(range(1, 4))")}),
split_ AS (SELECT *, regexp_replace(url, '#.*$', '') AS plain FROM log),
kept AS (
  SELECT *, list_sort([p for p in string_split(regexp_extract(plain, '[?](.*)$', 1), '&')
    if p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|fbclid|gclid|ref)=')]) AS kept FROM split_
),
k AS (SELECT *, {_CANONICAL} AS key FROM kept),
o AS (
  SELECT *, max(CASE WHEN kind = 'response' THEN {{'captured_at': captured_at, 'id': record_id}} END)
    OVER (PARTITION BY key ORDER BY captured_at, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS source FROM k
),
j AS (
  SELECT v.*, r.record_id AS response_id, r.payload AS old_payload, r.content_type AS old_type, r.content_length AS old_length,
    r.etag AS old_etag, r.last_modified AS old_modified, r.cache_control AS old_control,
    CASE WHEN r.record_id IS NULL THEN 'missing' ELSE
      CASE coalesce(regexp_replace(v.etag, '^W/', '') = regexp_replace(r.etag, '^W/', ''), v.last_modified = r.last_modified)
        WHEN true THEN 'resolved' WHEN false THEN 'changed' ELSE 'unchecked' END END AS status
  FROM o v LEFT JOIN o r ON r.kind = 'response' AND r.record_id = v.source.id WHERE v.kind = 'revisit'
),
h AS (
  SELECT *, status = 'resolved' AS ok, CASE WHEN status = 'resolved' THEN coalesce(cache_control, old_control) ELSE cache_control END AS h1,
    CASE WHEN status = 'resolved' THEN old_length ELSE content_length END AS h2,
    CASE WHEN status = 'resolved' THEN old_type ELSE content_type END AS h3,
    CASE WHEN status = 'resolved' THEN coalesce(etag, old_etag) ELSE etag END AS h5,
    CASE WHEN status = 'resolved' THEN coalesce(last_modified, old_modified) ELSE last_modified END AS h6
  FROM j
)
SELECT record_id, key, captured_at, coalesce(response_id, -1) AS response_id, status,
  concat_ws('; ', 'cache-control: ' || h1, 'content-length: ' || h2, 'content-type: ' || h3, 'date: ' || date,
    'etag: ' || h5, 'last-modified: ' || h6) AS headers,
  CASE WHEN ok THEN old_payload END AS payload
FROM h
"""

# crc32 of a text, bit by bit: a byte enters, then eight zeros each shift one bit out.
_CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""

OP11 = rf"""
WITH w0 AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_CRC.format(text="CAST(doc_id AS VARCHAR)")} AS h FROM documents
),
cut AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a FROM w0),
folded AS (SELECT *, 1 + (len(w) - a) // (3 + (h // 10) % 8) AS p FROM cut),
d AS (
  SELECT doc_id, CASE WHEN a < len(w) THEN list_transform(range(0, len(w)), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
    ELSE w END AS w FROM folded
),
win AS (
  SELECT doc_id, i, len(w) AS n, hash(array_to_string(w[i + 1:i + 16], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 15)) AS i FROM d)
),
again AS (  -- a run repeats each of its windows of 16 words one period later
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM win a JOIN win b ON a.doc_id = b.doc_id AND a.k = b.k
  WHERE b.i > a.i AND 3 * (b.i - a.i) <= a.n
),
stretch AS (
  SELECT doc_id, q, min(i) AS start, max(i) - min(i) + 16 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM again) GROUP BY doc_id, q, island
),
run AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretch WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length
),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS r FROM run)
  WHERE r = 1
),
listed AS (
  SELECT doc_id, count(*) AS n, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM run GROUP BY doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(listed.n, 0) AS n_runs, best.start, best.length, best.period, 1000 * best.length // best.period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_TERMS = (
    "translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

OP12 = f"""
WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TERMS} AS term FROM documents) GROUP BY ALL),
size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
whole AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM size),
term AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY term, n_docs
),
item AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {_TERMS} AS term FROM benchmark)),
score AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM item JOIN tf USING (term) JOIN term USING (term) JOIN size USING (doc_id), whole GROUP BY ALL
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLES = {
    "op2_substring_dedup": OP2,
    "op3_decontamination": OP3,
    "op4_licence_scan": OP4,
    "op7_minhash_dedup": OP7,
    "op9_revisits": OP9,
    "op11_periodic_runs": OP11,
    "op12_ranked_search": OP12,
}
