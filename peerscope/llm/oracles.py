"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
    + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

WARC = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(5 * (3 - i % 4) AS INT)) & 31), 1)), '')
    AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least(13, len(w)) AS k FROM b WHERE len(w) > 0))
),
ks AS (SELECT DISTINCT k FROM win),
dw AS (
  SELECT u, k, i, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)
),
m AS (SELECT dw.u, dw.i, dw.k, win.item_id FROM dw JOIN win ON dw.k = win.k AND dw.g = win.g),
hits AS (SELECT u, count(DISTINCT p) AS n_hit FROM (SELECT u, unnest(range(i, i + k)) AS p FROM m) GROUP BY u),
its AS (
  SELECT u, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
  FROM (SELECT DISTINCT u, item_id FROM m) GROUP BY u
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (u) LEFT JOIN its USING (u)
"""

_COMPONENTS = """
reach(a, b) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
comp AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)
"""

CAP_LINKS = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS u, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
ok AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
),
pairs AS (
  SELECT p.u AS pu, p.vec_id AS a, q.vec_id AS b FROM ok p JOIN ok q
    ON p.u <> q.u AND len(p.e) = len(q.e) AND list_cosine_similarity(p.e, q.e) >= 0.95
),
links AS (SELECT DISTINCT a, b FROM pairs),
nodes AS (SELECT DISTINCT vec_id AS id FROM v),
{_COMPONENTS},
n AS (SELECT pu, count(*) AS k FROM pairs GROUP BY pu)
SELECT v.vec_id, coalesce(n.k, 0) AS n_links, comp.component_id, v.vec_id = comp.component_id AS kept
FROM v JOIN comp ON v.vec_id = comp.id LEFT JOIN n ON n.pu = v.u
"""

JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS u, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
sets AS (
  SELECT DISTINCT u, CASE WHEN len(w) < 5 THEN w ELSE list_slice(w, i, i + 4) END AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
),
sizes AS (SELECT u, count(*) AS n FROM sets GROUP BY u),
shared AS (SELECT p.u AS a, q.u AS b, count(*) AS k FROM sets p JOIN sets q ON p.g = q.g AND p.u <> q.u GROUP BY ALL),
pairs AS (
  SELECT a, b FROM shared JOIN sizes x ON x.u = a JOIN sizes y ON y.u = b WHERE 100 * k >= 80 * (x.n + y.n - k)
),
links AS (SELECT DISTINCT p.doc_id AS a, q.doc_id AS b FROM pairs JOIN w p ON p.u = pairs.a JOIN w q ON q.u = pairs.b),
nodes AS (SELECT DISTINCT doc_id AS id FROM w),
{_COMPONENTS}
SELECT w.doc_id, coalesce(sizes.n, 0) AS n_shingles, comp.component_id
FROM w JOIN comp ON w.doc_id = comp.id LEFT JOIN sizes USING (u)
"""

REPEATS = """
WITH d AS (SELECT row_number() OVER () AS u, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
t AS (SELECT u, doc_id, h, len(h) // 2 AS n FROM d),
s AS (SELECT u, doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS g FROM (SELECT *, unnest(range(n - 99)) AS p FROM t WHERE n >= 100)),
later AS (
  SELECT u, p FROM (SELECT *, rank() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, p) AS k FROM s) WHERE k > 1
),
marked AS (SELECT u, p, lag(p) OVER (PARTITION BY u ORDER BY p) AS q FROM later),
runs AS (SELECT u, p, sum(CASE WHEN q IS NULL OR p > q + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY u ORDER BY p) AS r FROM marked),
spans AS (SELECT u, r, min(p) AS a, max(p) + 100 AS b FROM runs GROUP BY u, r),
gaps AS (
  SELECT u, b AS a, lead(a) OVER (PARTITION BY u ORDER BY a) AS b FROM spans
  UNION ALL SELECT u, 0, min(a) FROM spans GROUP BY u
),
kept AS (
  SELECT t.u, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS h
  FROM gaps JOIN t ON t.u = gaps.u GROUP BY t.u
),
sums AS (SELECT u, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY u)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept.h, t.h))) AS kept_sha256
FROM t LEFT JOIN sums USING (u) LEFT JOIN kept USING (u)
"""

NEGATIVES = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
a AS (SELECT row_number() OVER () AS q, * FROM r WHERE vec_id % 100 = 0),
s AS (
  SELECT a.q, a.vec_id AS anchor_id, r.vec_id AS id, r.label = a.label AS same,
    CAST(CASE WHEN len(r.v) = 0 THEN 0 ELSE list_inner_product(a.v, r.v) END AS BIGINT) AS score FROM a, r
),
p AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, id) AS k FROM s WHERE same AND id <> anchor_id
  QUALIFY k <= 5
),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.q, p.k ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s ON p.q = s.q AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
  QUALIFY rank <= 10
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n
"""

# The cheapest edits run backwards over the rows: best[i] holds (cost, letters) from state i to the end, first
# without and then with inserts before the row; at most two inserts in a row can pay.
_CHEAP = "list_sort([{}])[1]"
_INSERT = "{{'c': {0}.c + 2, 'a': 'I' || {0}.a}}"


def _after_inserts(src: str) -> str:
    """[start, system, user, assistant] with inserts allowed before what follows."""
    user = _CHEAP.format(f"{src}[3], " + _INSERT.format(f"{src}[4]"))
    assistant = _CHEAP.format(f"{src}[4], " + _INSERT.format(f"{src}[3]"))
    start = _CHEAP.format(f"{src}[1], " + _INSERT.format(f"({user})"))
    system = _CHEAP.format(f"{src}[2], " + _INSERT.format(f"({user})"))
    return f"[{start}, {system}, {user}, {assistant}]"


def _row_options(state: int) -> str:
    """The cheapest of deleting, keeping or reroling row ``f`` from a state, given ``b.best`` behind it."""
    kept = {1: "CASE f.i WHEN 's' THEN b.best[2] WHEN 'u' THEN b.best[3] END", 2: "CASE f.i WHEN 'u' THEN b.best[3] END",
            3: "CASE f.i WHEN 'a' THEN b.best[4] END", 4: "CASE f.i WHEN 'u' THEN b.best[3] END"}[state]
    made = "b.best[4]" if state == 3 else "b.best[3]"
    return _CHEAP.format(
        f"{{'c': b.best[{state}].c + 3, 'a': 'D' || b.best[{state}].a}}, "
        f"CASE WHEN f.must OR ({kept}) IS NULL THEN {{'c': 1000000000, 'a': ''}} "
        f"ELSE {{'c': ({kept}).c + f.extra, 'a': 'K' || ({kept}).a}} END, "
        f"CASE WHEN f.must THEN {{'c': 1000000000, 'a': ''}} ELSE {{'c': {made}.c + 2 + f.extra, 'a': 'R' || {made}.a}} END"
    )


_LAST = "[{'c': 0, 'a': ''}, {'c': 1000000000, 'a': ''}, {'c': 1000000000, 'a': ''}, {'c': 0, 'a': ''}]"

STRUCTURE = rf"""
WITH RECURSIVE entry(n, v) AS (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
  FROM (SELECT unnest(range(256)) AS i)
),
crc AS (SELECT list(v ORDER BY n) AS t FROM entry),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
),
keyed AS (
  SELECT * EXCLUDE (name), xor(list_reduce(list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, x: xor(c >> 8, crc.t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 20 AS k FROM named, crc
),
hurt AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM keyed WHERE k <> 0
),
inorder AS (
  SELECT *, substr(role, 1, 1) AS i, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS o FROM hurt
),
judged AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY o) > 1 AS seen,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut,
    coalesce(lag(i) OVER (PARTITION BY conv_id ORDER BY o) || i NOT IN ('su', 'ua', 'au'), false) AS bad FROM inorder
),
faulted AS (
  SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN seen THEN 'duplicate'
    WHEN substr(cut, -1, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM judged
),
f AS (SELECT g, o, i, fault IN ('blank', 'duplicate') AS must, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS extra FROM faulted),
search(g, o, best) AS (
  SELECT g, max(o), {_after_inserts(_LAST)} FROM f GROUP BY g
  UNION ALL
  SELECT b.g, b.o - 1, {_after_inserts('z.e')}
  FROM search b JOIN f ON f.g = b.g AND f.o = b.o, LATERAL (SELECT [{', '.join(_row_options(s) for s in (1, 2, 3, 4))}] AS e) z
),
answer AS (SELECT g, best[1].c AS cost, best[1].a AS audit FROM search WHERE o = 0),
walk(g, p, o, state, audit, text) AS (
  SELECT g, 1, 0, 'x', audit, '' FROM answer WHERE audit <> ''
  UNION ALL
  SELECT w.g, w.p + 1, w.o + CASE WHEN w.l = 'I' THEN 0 ELSE 1 END,
    CASE w.l WHEN 'D' THEN w.state WHEN 'K' THEN r.i ELSE CASE WHEN w.state = 'u' THEN 'a' ELSE 'u' END END, w.audit,
    w.text || CASE w.l WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || r.role || ':' || r.text
      ELSE chr(10) || CASE WHEN w.state = 'u' THEN 'assistant:' ELSE 'user:' END || CASE WHEN w.l = 'R' THEN r.text ELSE '' END END
  FROM (SELECT *, substr(audit, CAST(p AS BIGINT), 1) AS l FROM walk WHERE p <= length(audit)) w
  LEFT JOIN inorder r ON r.g = w.g AND r.o = w.o + 1
),
repaired AS (SELECT g, substr(text, 2) AS text FROM walk WHERE p > length(audit)),
counts AS (
  SELECT conv_id, g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal FROM faulted GROUP BY conv_id, g
),
names AS (SELECT DISTINCT conv_id FROM conversations)
SELECT n.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(text, '')) AS repaired_sha256
FROM names n LEFT JOIN counts c ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN answer USING (g) LEFT JOIN repaired USING (g)
"""
