"""DuckDB SQL of the registered queries that SQL can express.

The SQL follows the definitions, not the methods: similarity joins and windows
compare everything, the mix is a recursion over slots.
"""

from __future__ import annotations

from pagelathe.llm.licenses import RULES, SENTENCES

ORACLE: dict[str, str] = {}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLE["op4_heavy_hitter_dedup"] = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h)
"""


def _license_sql() -> str:
    known = ", ".join(f"({_quoted(s)}, {_quoted(i)})" for s, i in SENTENCES.items())
    steps, flags = [], []
    for n, (name, ids) in enumerate(RULES):
        token = _quoted("".join(f",{i}," for i in ids))
        source = f"r{n - 1}" if n else "seq"
        kept = "".join(f", m{i}" for i in range(n))
        steps.append(f"r{n} AS (SELECT doc_id, ids{kept}, contains(rest, {token}) AS m{n}, replace(rest, {token}, ',?,') AS rest FROM {source})")
        flags.append(f"CASE WHEN m{n} THEN {_quoted(name)} END")
    plain = "array_to_string(list_filter(string_split({0}, ','), lambda x: x <> '' AND x <> '?'), ',')"
    return rf"""
WITH known(s, id) AS (VALUES {known}),
unwrapped AS (
  SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '\r?\n[ \t]*([a-z(])', ' \1', 'g'), '([A-Z,;])[ \t]*\r?\n[ \t]*', '\1 ', 'g') AS t
  FROM documents),
cut AS (SELECT doc_id, regexp_split_to_array(t, '[.!?]+[\s)"'']+|[.!?:]*\s*\n\s*') AS parts FROM unwrapped),
sentence AS (
  SELECT doc_id, i, trim(regexp_replace(lower(parts[i]), '[^a-z0-9.]+', ' ', 'g'), ' .') AS s
  FROM cut, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)),
named AS (SELECT doc_id, string_agg(',' || coalesce(id, '?') || ',', '' ORDER BY i) AS x FROM sentence LEFT JOIN known USING (s) GROUP BY doc_id),
seq AS (SELECT doc_id, regexp_replace(x, '(,\?,)+', ',?,', 'g') AS ids, regexp_replace(x, '(,\?,)+', ',?,', 'g') AS rest FROM named),
{", ".join(steps)}
SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter([{", ".join(flags)}], lambda x: x IS NOT NULL))), ',') AS licenses,
  {plain.format("ids")} AS sentences, {plain.format("rest")} AS unmatched
FROM r{len(RULES) - 1}
"""


ORACLE["op3_license_rules"] = _license_sql()

ORACLE["op6_pfair_mixing"] = """
WITH RECURSIVE src AS (SELECT coalesce(source, '') AS source, count(*) AS n FROM documents GROUP BY 1),
w AS (SELECT source, floor(sqrt(n))::BIGINT AS weight FROM src),
slots AS (SELECT source, weight AS a FROM w WHERE weight > 0),
per AS (SELECT sum(a)::BIGINT AS period FROM slots),
ord AS (SELECT list(source ORDER BY source) AS names, list(a ORDER BY source) AS a FROM slots),
run(t, done, pick) AS (
  SELECT -1::BIGINT, list_transform(a, lambda x: 0::BIGINT), 0::BIGINT FROM ord
  UNION ALL
  SELECT t + 1, list_transform(done, lambda d, i: CASE WHEN i = p THEN d + 1 ELSE d END), p
  FROM (
    SELECT t, done, list_min(list_transform(
        list_filter(range(1, len(a) + 1), lambda i: (done[i] * period) // a[i] <= t + 1),
        lambda i: (((done[i] + 1) * period + a[i] - 1) // a[i]) * 100000 + i)) % 100000 AS p
    FROM run, ord, per WHERE t < period - 1)),
turns AS (SELECT t, names[pick] AS source, row_number() OVER (PARTITION BY names[pick] ORDER BY t) - 1 AS turn FROM run, ord WHERE t >= 0),
nth AS (
  SELECT doc_id, coalesce(source, '') AS source, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY md5(doc_id::VARCHAR)) - 1 AS nth
  FROM documents),
placed AS (
  SELECT doc_id, source, nth, nth // 32 AS block_no, ((nth // 32) // a) * period + t AS slot
  FROM per, nth JOIN slots USING (source) JOIN turns USING (source) WHERE turn = (nth // 32) % a)
SELECT doc_id, source, block_no, slot, row_number() OVER (ORDER BY slot, nth) - 1 AS position FROM placed
"""

ORACLE["op10_warc_chunks"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS x, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS winner FROM pages),
bits AS (
  SELECT page_id, winner, strlen(x) AS size,
    array_to_string(list_transform(string_split(sha1(x), ''), lambda c:
      substr('0000000100100011010001010110011110001001101010111100110111101111', (strpos('0123456789abcdef', c) - 1) * 4 + 1, 4)), '') AS b
  FROM p)
SELECT page_id, size AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
    16 * substr(b, i * 5 + 1, 1)::INT + 8 * substr(b, i * 5 + 2, 1)::INT + 4 * substr(b, i * 5 + 3, 1)::INT + 2 * substr(b, i * 5 + 4, 1)::INT + substr(b, i * 5 + 5, 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = winner THEN NULL ELSE winner END AS refers_to
FROM bits
"""

_GRAMS = """
{0}_w AS (SELECT {1}, regexp_extract_all(lower(coalesce(text, '')), '[\\pL\\pN_]+') AS w FROM {2}),
{0} AS (
  SELECT {1}, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS s
  FROM {0}_w, LATERAL (SELECT unnest(range(1, {3})) AS i) WHERE len(w) > 0)"""

ORACLE["op2_minhash_join"] = f"""
WITH RECURSIVE {_GRAMS.format("g", "doc_id", "documents", "greatest(len(w) - 4, 1) + 1")},
sets AS (SELECT DISTINCT doc_id, s FROM g),
size AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y, o = p.n AND o = q.n AS same
  FROM pair JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE o >= 0.8 * (p.n + q.n - o) - 1e-9),
reach(x, y) AS (SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y)
SELECT doc_id, least(doc_id, (SELECT min(y) FROM reach WHERE x = doc_id)) AS class_id,
  least(doc_id, (SELECT min(y) FROM link WHERE x = doc_id AND same)) AS copy_id, (SELECT count(*) FROM link WHERE x = doc_id) AS n_links
FROM documents
"""

ORACLE["op8_simhash_windows"] = f"""
WITH {_GRAMS.format("g", "doc_id", "documents", "len(w) - 4 + 1")},
{_GRAMS.format("q", "item_id", "benchmark", "len(w) - 4 + 1")},
b AS (SELECT item_id, s, count(*) AS c FROM q GROUP BY ALL),
k AS (SELECT item_id, count(*) AS k FROM q GROUP BY ALL),
near AS (SELECT DISTINCT doc_id, pos AS start FROM g WHERE s IN (SELECT s FROM b)),
pair AS (SELECT DISTINCT doc_id, item_id FROM g JOIN b USING (s)),
win AS (SELECT doc_id, item_id, start, k FROM pair JOIN near USING (doc_id) JOIN k USING (item_id)),
held AS (
  SELECT win.doc_id, win.item_id, start, k, g.s, count(*) AS c
  FROM win JOIN g ON g.doc_id = win.doc_id AND g.pos BETWEEN start AND start + k - 1 GROUP BY ALL),
sums AS (
  SELECT doc_id, item_id, start, k, sum(held.c)::BIGINT AS n, sum(least(held.c, coalesce(b.c, 0)))::BIGINT AS o
  FROM held LEFT JOIN b USING (item_id, s) GROUP BY ALL),
sims AS (SELECT doc_id, item_id, start, n, o / (k + n - o) AS similarity FROM sums)
SELECT doc_id, item_id, similarity, start, n AS n_shingles
FROM sims WHERE similarity >= 0.8 - 1e-9
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""

ORACLE["op11_prefix_trie"] = """
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT DISTINCT c, c - c % 100 AS head, xor(4294967295::BIGINT, list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1))), 4294967295::BIGINT)) % 6 AS h
  FROM t),
seq AS (
  SELECT convs.c, 0 AS part, p, said FROM convs JOIN t ON t.c = convs.head WHERE p <= h
  UNION ALL SELECT convs.c, 1, p, said FROM convs JOIN t ON t.c = convs.c WHERE p > h),
whole AS (SELECT convs.c, coalesce(list(said ORDER BY part, p) FILTER (said IS NOT NULL), []) AS path FROM convs LEFT JOIN seq USING (c) GROUP BY convs.c),
member AS (SELECT c, path, d, path[:d] AS node FROM whole, LATERAL (SELECT unnest(range(0, len(path) + 1)) AS d)),
nodes AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(path) = d), '') AS ends
  FROM member GROUP BY node, d),
kids AS (SELECT node[:d - 1] AS node, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1),
valued AS (SELECT nodes.*, coalesce(k, 0) AS k, (n - 1) * CASE WHEN d = 0 THEN 0 ELSE length(node[d].text) END AS saved FROM nodes LEFT JOIN kids USING (node)),
below AS (
  SELECT node[:e] AS node, sum(saved)::BIGINT AS saved, count(*) FILTER (k = 0) AS leaves
  FROM (SELECT node, k, saved, unnest(range(0, d + 1)) AS e FROM valued) GROUP BY 1)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n AS n_convs, v.k AS n_children, leaves AS n_leaves, below.saved AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN below ON below.node = v.node LEFT JOIN nodes u ON v.d > 0 AND u.node = v.node[:v.d - 1]
"""

ORACLE["op13_bbit_minhash"] = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS no, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingle AS (
  SELECT DISTINCT no, CASE WHEN len(words) < 5 THEN md5(array_to_string(words, ' ')) ELSE md5(array_to_string(words[i:i + 4], ' ')) END AS s
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i) WHERE len(words) > 0),
size AS (SELECT no, count(*) AS n FROM shingle GROUP BY no),
shared AS (SELECT a.no AS u, b.no AS v, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.no <> b.no GROUP BY 1, 2),
link AS (SELECT u, v FROM shared JOIN size x ON x.no = u JOIN size y ON y.no = v WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach(a, b) AS (SELECT no, no FROM w UNION SELECT a, v FROM reach JOIN link ON u = b),
part AS (SELECT a AS no, min(doc_id) AS component_id FROM reach JOIN w ON w.no = b GROUP BY a)
SELECT doc_id, coalesce(size.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM w JOIN part USING (no) LEFT JOIN size USING (no)
"""
