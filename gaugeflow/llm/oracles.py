"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {}

ORACLES["op10_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 10) AS n
      FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS p
       FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
       FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i
             FROM d, (SELECT DISTINCT n FROM b))),
hits AS (SELECT doc_id, i, n FROM dw WHERE p IN (SELECT p FROM bw)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n_items,
                string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
         FROM (SELECT DISTINCT doc_id, item_id FROM dw JOIN bw USING (n, p)) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
"""

ORACLES["op3_ngram_jaccard_join"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS p
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM d
            WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (p) GROUP BY ALL),
near AS (SELECT a, b, c = na.n AND c = nb.n AS same FROM pairs
            JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
            WHERE 5 * c >= 4 * (na.n + nb.n - c)),
copies AS (SELECT a AS doc_id, min(b) AS copy_id, count(*) AS n_copies FROM near WHERE same GROUP BY a),
reach AS (SELECT a, b FROM near UNION SELECT r.a, x.b FROM reach r JOIN near x ON r.b = x.a),
class AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
links AS (SELECT a AS doc_id, count(DISTINCT copy_id) AS n_links
          FROM near JOIN copies ON copies.doc_id = b WHERE NOT same GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(copy_id, doc_id) AS copy_id,
       coalesce(n_copies, 1) AS n_copies, coalesce(n_links, 0) AS n_links,
       coalesce(class_id, doc_id) = doc_id AS kept
FROM d LEFT JOIN class USING (doc_id) LEFT JOIN copies USING (doc_id) LEFT JOIN links USING (doc_id)
"""

ORACLES["op7_exact_topk"] = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id, list_inner_product(q.v, e.v)::BIGINT AS score
      FROM e q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLES["op8_warc_chunks"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
f AS (SELECT payload, min(page_id) AS first FROM p WHERE strlen(payload) >= 100 GROUP BY payload)
SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload)
"""

# bytes as hex digits, so that strings can be cut at any byte
ORACLES["op2_suffix_array_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS m
      FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM d WHERE n >= 100)),
f AS (SELECT m, min({'d': doc_id, 'i': i}) AS first FROM w GROUP BY m HAVING count(*) > 1),
dup AS (SELECT doc_id, i FROM w JOIN f USING (m) WHERE doc_id <> first.d OR i <> first.i),
s AS (SELECT doc_id, i, max(i + 100) OVER (PARTITION BY doc_id ORDER BY i
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM dup),
g AS (SELECT doc_id, i, sum(CASE WHEN i <= reached THEN 0 ELSE 1 END)
             OVER (PARTITION BY doc_id ORDER BY i) AS span FROM s),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY doc_id, span),
cuts AS (SELECT doc_id, b AS lo, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS hi
         FROM (SELECT doc_id, a, b FROM spans UNION ALL SELECT doc_id, -1, 0 FROM d)),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * lo + 1, 2 * (coalesce(hi, n) - lo)), '' ORDER BY lo) AS h
         FROM cuts JOIN d USING (doc_id) GROUP BY doc_id),
gone AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

ORACLES["op11_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
           FROM documents),
g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM t JOIN g USING (h)
"""

# CRC-32 of the decimal digits, bit by bit
_CRC = """list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(range(1, len(conv_id::VARCHAR) + 1),
    lambda i: ascii(substr(conv_id::VARCHAR, i::INTEGER, 1))::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
    lambda c, bit: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)))"""

ORACLES["op12_conversation_prefix_trie"] = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, turns, conv_id - conv_id % 100 AS base, xor({_CRC}, 4294967295) % 6 AS h FROM own),
full_rows AS (
  SELECT h.conv_id, list_concat(coalesce(list_slice(b.turns, 1, h), []), list_slice(h.turns, h + 1, len(h.turns))) AS s
  FROM h LEFT JOIN own b ON b.conv_id = h.base),
steps AS (SELECT conv_id, s, unnest(range(len(s) + 1)) AS depth FROM full_rows),
paths AS (
  SELECT conv_id, depth, len(s) AS total, sha256(list_slice(s, 1, depth)::VARCHAR || depth) AS k,
         CASE WHEN depth > 0 THEN sha256(list_slice(s, 1, depth - 1)::VARCHAR || (depth - 1)) END AS pk,
         CASE WHEN depth > 0 THEN length(s[depth].t) ELSE 0 END AS size FROM steps),
nodes AS (
  SELECT k, any_value(pk) AS pk, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
         (count(*) - 1) * any_value(size) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (total = depth), '')) AS ends
  FROM paths GROUP BY k),
kids AS (SELECT pk AS k, count(*) AS n_children FROM nodes GROUP BY pk),
below AS (
  SELECT p.k, sum(n.saved)::BIGINT AS saved_tokens, count(*) FILTER (kids.k IS NULL) AS n_leaves
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN kids ON kids.k = n.k
  GROUP BY p.k)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN below USING (k) LEFT JOIN kids USING (k) LEFT JOIN nodes up ON up.k = n.pk
"""

ORACLES["op13_phrase_collocations"] = rf"""
WITH w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
f AS (
  SELECT lang, k, p, count(*) AS a
  FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) t(k)))
  GROUP BY lang, k, p),
c AS (SELECT lang, k, p, a, string_split(p, ' ') AS v FROM f WHERE k > 1 AND a >= 10),
around AS (
  SELECT lang, unnest([array_to_string(v[1:2], ' '), array_to_string(v[2:3], ' ')]) AS p, a FROM c WHERE k = 3),
dropped AS (SELECT DISTINCT c.lang, c.p FROM c JOIN around USING (lang, p) WHERE c.k = 2 AND 100 * around.a >= 50 * c.a),
cuts AS (
  SELECT lang, p, a, cut, array_to_string(v[1:cut], ' ') AS lp, array_to_string(v[cut + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) ANTI JOIN dropped USING (lang, p)),
scored AS (
  SELECT cuts.lang, cuts.p AS phrase, cuts.a, x.a AS l, y.a AS r, cut,
         (1000000::HUGEINT * cuts.a * cuts.a // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.p = lp JOIN f y ON y.lang = cuts.lang AND y.p = rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
JOIN n USING (lang) WHERE rank <= 2000
"""
