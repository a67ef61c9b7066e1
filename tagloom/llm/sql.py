"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

#: Assigned secrets, access keys and long hex runs; RE2 reads the patterns as Java does.
_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_PEM = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
_WEBTOKEN = r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"


def _spans(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    return f"""
      SELECT row_no, {order} AS ord, '{kind}' AS kind, place, place + length(m) AS stop FROM (
        SELECT row_no, m, g,
          sum(length(p)) OVER (PARTITION BY row_no ORDER BY i) + coalesce(sum(length(m)) OVER (
            PARTITION BY row_no ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
        FROM (SELECT row_no,
            unnest(regexp_split_to_array(body, '{pattern}')[:len(regexp_extract_all(body, '{pattern}'))]) AS p,
            unnest(regexp_extract_all(body, '{pattern}')) AS m,
            unnest(regexp_extract_all(body, '{pattern}', {group})) AS g,
            unnest(range(len(regexp_extract_all(body, '{pattern}')))) AS i
          FROM texts WHERE regexp_matches(body, '{pattern}')))
      WHERE length(g) >= {least}"""


_SECRETS = f"""
WITH texts AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS body FROM documents),
found AS ({" UNION ALL ".join(_spans(*x) for x in (
    ("assign", 0, _ASSIGN, 2, 6), ("access", 1, "AKIA[A-Z0-9]+", 0, 20), ("hex", 2, "[0-9a-f]{24,}", 0, 24),
    ("pem", 3, _PEM, 0, 1), ("webtoken", 4, _WEBTOKEN, 0, 30)))}),
listed AS (
  SELECT row_no, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(kind || ':' || place::BIGINT || ':' || stop::BIGINT, ',' ORDER BY place, ord) FILTER (ord < 3), '') AS base,
    string_agg(kind || ':' || place::BIGINT || ':' || stop::BIGINT, ',' ORDER BY place, ord) AS spans
  FROM found GROUP BY row_no)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (row_no)
"""

#: Jump consistent hash by the published congruential sequence; CRC-32 byte by byte.
_SHARDS = """
WITH RECURSIVE walk(doc_id, state, held, place) AS (
  SELECT DISTINCT doc_id, doc_id::HUGEINT, 0::BIGINT, 0::BIGINT FROM documents
  UNION ALL
  SELECT doc_id, next, place,
    floor((place + 1) * (2147483648.0::DOUBLE / ((next // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM walk WHERE place <= 16)
),
shards AS (
  SELECT doc_id, max(place) FILTER (place < 16)::INT AS shard, max(place) FILTER (place <= 16)::INT AS grown_shard FROM walk GROUP BY doc_id
),
crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM range(256) AS bytes(b)
),
sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
    xor(list_reduce(
      list_transform(range(strlen(coalesce(text, ''))), lambda i: ('0x' || substr(hex(encode(coalesce(text, ''))), 2 * i + 1, 2))::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM documents, crc_table
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id % 256, text_crc32 % 8, doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM sized JOIN shards USING (doc_id)
"""

_TOPK = """
WITH plain AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM plain q JOIN plain c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""

#: Every record goes through an archive in the query; its fields follow from the pages alone.
_WARC = """
WITH paid AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM paid)
SELECT page_id, strlen(body) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM firsts
"""

#: Windows of words as texts; a word is hit if a window that occurs starts at most a window before it.
_CONTAMINATION = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM (
    SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)
),
doc_words AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
starts AS (SELECT row_no, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM (
  SELECT row_no, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM windows))),
found AS (SELECT s.row_no, s.n, s.i, item_id FROM starts s JOIN windows USING (n, phrase)),
hits AS (SELECT row_no, count(DISTINCT p) AS n_hit FROM (SELECT row_no, unnest(range(i, i + n)) AS p FROM found) GROUP BY row_no),
items AS (SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT row_no, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY row_no)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (row_no) LEFT JOIN items USING (row_no)
"""

_PASSAGES = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
starts AS (SELECT row_no, i, md5(array_to_string(w[i:i + 34], ' ')) AS seen
  FROM (SELECT row_no, w, unnest(range(1, len(w) - 33)) AS i FROM doc_words WHERE len(w) >= 35)),
again AS (SELECT row_no, i FROM (SELECT *, count(*) OVER (PARTITION BY seen) AS c FROM starts) WHERE c > 1),
words AS (SELECT row_no, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM doc_words),
judged AS (
  SELECT row_no, i, word, count(again.i) OVER (PARTITION BY row_no ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) > 0 AS gone
  FROM words LEFT JOIN again USING (row_no, i)
),
kept AS (SELECT row_no, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS rest FROM judged GROUP BY row_no)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM doc_words LEFT JOIN kept USING (row_no)
"""

#: All pairs that share a shingle, and all that links lead to.
_COMPONENTS = r"""
WITH RECURSIVE doc_words AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT row_no, array_to_string(w[i:i + 3], ' ') AS shingle
  FROM (SELECT row_no, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM doc_words WHERE len(w) > 0)
),
sizes AS (SELECT row_no, count(*) AS n FROM shingles GROUP BY row_no),
shared AS (
  SELECT a.row_no AS x, b.row_no AS y, count(*) AS common FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.row_no < b.row_no GROUP BY ALL
),
links AS (
  SELECT d.doc_id AS x, e.doc_id AS y FROM shared JOIN sizes p ON p.row_no = x JOIN sizes q ON q.row_no = y
  JOIN doc_words d ON d.row_no = x JOIN doc_words e ON e.row_no = y
  WHERE 100 * common >= 85 * (p.n + q.n - common) AND d.doc_id IS NOT NULL AND e.doc_id IS NOT NULL
),
steps AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reached(x, y) AS (SELECT x, y FROM steps UNION SELECT reached.x, steps.y FROM reached JOIN steps ON reached.y = steps.x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, (SELECT min(y) FROM reached WHERE x = doc_id)) AS component_id
FROM doc_words LEFT JOIN sizes USING (row_no)
"""

#: CRC-32 of the decimal digits of an id, byte by byte.
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM range(256) AS bytes(b)
)"""
_CRC_ID = """CASE WHEN doc_id IS NOT NULL THEN xor(list_reduce(list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) END"""


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


#: Trees level by level; a step of a proof is its siblings with a mark in the node's place.
_MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
  SELECT row_no, doc_id, source, leaf, claim, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, row_no) - 1 AS place
  FROM (SELECT row_number() OVER () AS row_no, doc_id, source, {_leaf("text")} AS leaf,
      {_leaf(f"CASE WHEN ({_CRC_ID}) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS claim FROM documents, crc_table)
),
nodes(source, lvl, pos, digest, n) AS (
  SELECT source, 0, place, leaf, count(*) OVER (PARTITION BY source) FROM leaves
  UNION ALL
  SELECT source, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY source, lvl, pos // 3
),
subroots AS (SELECT source, lvl AS lifts, digest, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1),
upper(lvl, pos, digest, n) AS (
  SELECT 0, pos, digest, count(*) OVER () FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM upper WHERE n > 1 GROUP BY lvl, pos // 3
),
steps AS (
  SELECT source, lvl, pos, list_reduce(list_transform(run, lambda d, i: CASE WHEN i = pos % 3 + 1 THEN '*' ELSE d END), lambda x, y: x || y) AS step
  FROM (SELECT *, list(digest) OVER (PARTITION BY source, lvl, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run FROM nodes WHERE n > 1)
),
upper_steps AS (
  SELECT lvl, pos, list_reduce(list_transform(run, lambda d, i: CASE WHEN i = pos % 3 + 1 THEN '*' ELSE d END), lambda x, y: x || y) AS step
  FROM (SELECT *, list(digest) OVER (PARTITION BY lvl, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run FROM upper WHERE n > 1)
),
own AS (
  SELECT row_no, list(step ORDER BY lvl) AS proof FROM leaves l JOIN steps s
  ON l.source IS NOT DISTINCT FROM s.source AND s.pos = l.place // (3 ** s.lvl)::BIGINT GROUP BY row_no
),
above AS (
  SELECT r.source, list(step ORDER BY lvl) AS proof FROM subroots r JOIN upper_steps s ON s.pos = r.pos // (3 ** s.lvl)::BIGINT GROUP BY r.source
),
proven AS (
  SELECT doc_id, leaf, claim, r.digest AS subroot, (SELECT digest FROM upper WHERE n = 1) AS root,
    coalesce(own.proof, []) || coalesce(above.proof, []) AS proof
  FROM leaves l JOIN subroots r ON l.source IS NOT DISTINCT FROM r.source LEFT JOIN own USING (row_no)
  LEFT JOIN above ON l.source IS NOT DISTINCT FROM above.source
),
done AS (
  SELECT *, list_reduce(proof, lambda d, s: sha256(replace(s, '*', d)), claim) AS folded_root FROM proven
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(proof, ''), '*', '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM done
"""

_COPIES = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

#: Stretches of words equal to those q further on, found where six words are; of two stretches
#: one inside the other, that of the smaller period is the run.
_RUNS = rf"""
WITH {_CRC_TABLE},
given AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w, {_CRC_ID} AS h FROM documents, crc_table
),
placed AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM given),
sized AS (SELECT *, 1 + (len(w) - a) // (3 + (h // 10) % 8) AS p FROM placed),
docs AS (
  SELECT row_no, doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(range(len(w)), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w FROM sized
),
grams AS (
  SELECT row_no, i, array_to_string(w[i + 1:i + 6], ' ') AS gram FROM (SELECT row_no, w, unnest(range(len(w) - 5)) AS i FROM docs WHERE len(w) >= 12)
),
pairs AS (SELECT x.row_no, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.row_no = y.row_no AND x.gram = y.gram AND x.i < y.i),
islands AS (
  SELECT row_no, q, min(i) AS start, count(*) + 5 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY row_no, q ORDER BY i) AS island FROM pairs) GROUP BY row_no, q, island
),
wide AS (SELECT row_no, start, length, q AS period FROM islands WHERE length >= greatest(12, 2 * q)),
runs AS (
  SELECT * FROM wide r WHERE NOT EXISTS (
    SELECT 1 FROM wide s WHERE s.row_no = r.row_no AND s.period < r.period AND s.start <= r.start AND s.start + s.length >= r.start + r.length)
),
listed AS (
  SELECT row_no, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
    list({{'start': start, 'length': length, 'period': period}} ORDER BY length DESC, start, period)[1] AS best
  FROM runs GROUP BY row_no
),
gone AS (SELECT DISTINCT row_no, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT row_no, string_agg(word, ' ' ORDER BY i) AS rest FROM (SELECT row_no, unnest(range(len(w))) AS i, unnest(w) AS word FROM docs) ANTI JOIN gone USING (row_no, i)
  GROUP BY row_no
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
  1000 * best.length // best.period AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (row_no) LEFT JOIN kept USING (row_no)
"""

ORACLES: dict[str, str] = {
    "op3_ngram_jaccard": _COMPONENTS,
    "op5_decontamination": _CONTAMINATION,
    "op8_substring_dedup": _PASSAGES,
    "op2_secret_scan": _SECRETS,
    "op4_jump_shards": _SHARDS,
    "op9_warc": _WARC,
    "op10_topk": _TOPK,
    "op11_merkle_manifest": _MERKLE,
    "op12_stream_dedup": _COPIES,
    "op13_periodic_runs": _RUNS,
}
