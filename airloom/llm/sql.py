"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from collections.abc import Sequence

from airloom.llm.common import LOWER, UPPER

_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _low(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"


def _quoted(value: object) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def _values(rows: Sequence[Sequence[object]]) -> str:
    return ", ".join("(" + ", ".join(map(_quoted, r)) + ")" for r in rows)


def leaks(size: int = 10) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_low('text')}, '{_WORD}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_low('text')}, '{_WORD}') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, {size} AS n, array_to_string(w[i:i + {size - 1}], ' ') AS win FROM b, unnest(range(1, len(w) - {size - 2})) t(i) WHERE len(w) >= {size}
  UNION SELECT item, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND {size - 1}),
g AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM d, (SELECT DISTINCT n FROM win) s, unnest(range(1, len(w) - n + 2)) t(i)),
h AS (SELECT rid, i, n, item FROM g JOIN win USING (n, win)),
words AS (SELECT rid, count(DISTINCT i + k) AS n_hit FROM h, unnest(range(0, n)) t(k) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""


def jaccard(n: int = 5, threshold: float = 0.8) -> str:
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_low('text')}, '{_WORD}') AS w FROM documents),
g AS (SELECT DISTINCT rid, array_to_string(w[i:i + {n - 1}], ' ') AS gram FROM d, unnest(range(1, greatest(2, len(w) - {n - 2}))) t(i) WHERE len(w) > 0),
s AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
both_ AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM g a JOIN g b USING (gram) GROUP BY 1, 2),
near AS (SELECT x, y, c = p.n AND c = q.n AS same FROM both_ JOIN s p ON p.rid = x JOIN s q ON q.rid = y WHERE c >= {threshold} * (p.n + q.n - c) - 1e-9),
reach AS (SELECT x, y FROM near UNION SELECT reach.x, near.y FROM reach JOIN near ON near.x = reach.y),
copies AS (SELECT x AS rid, min(doc_id) AS copy_id, count(*) AS n_copies FROM near JOIN d ON rid = y WHERE same GROUP BY x),
linked AS (SELECT x AS rid, count(*) - 1 AS n_links FROM near GROUP BY x),
class AS (SELECT x AS rid, min(doc_id) AS class_id FROM reach JOIN d ON rid = y GROUP BY x)
SELECT doc_id, CASE WHEN len(w) = 0 THEN doc_id ELSE copy_id END AS copy_id, CASE WHEN len(w) = 0 THEN doc_id ELSE class_id END AS class_id,
  coalesce(n_copies, 1) AS n_copies, coalesce(n_links, 0) AS n_links
FROM d LEFT JOIN copies USING (rid) LEFT JOIN linked USING (rid) LEFT JOIN class USING (rid)"""


def urls(rules: Sequence[Sequence[str]], default: str = "allow") -> str:
    return f"""
WITH r(rule_host, rule_path, rule_verdict) AS (VALUES {_values(rules)}),
cut AS (SELECT row_number() OVER () AS rid, page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT rid, page_id, {_low("regexp_extract(rest, '^[^/?#]*')")} AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
hit AS (
  SELECT rid, rule_host || rule_path AS rule, rule_verdict AS verdict,
    row_number() OVER (PARTITION BY rid ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, '{default}') AS verdict FROM p LEFT JOIN hit ON p.rid = hit.rid AND place = 1"""


def licenses(rules: Sequence[Sequence[object]], phrases: Sequence[Sequence[str]]) -> str:
    """rules: (label, keyword, second keyword, padded pattern, priority, confidence, number); phrases: (label, padded pattern)."""
    spaces = lambda x: f"(length({x}) - length(replace({x}, ' ', '')))"
    places = f"""{spaces("array_to_string(pieces[1:i], '')")} + {spaces("coalesce(array_to_string(matches[1:i - 1], ''), '')")}"""
    return f"""
WITH RECURSIVE rule(label, k1, k2, pattern, priority, confidence, number) AS (VALUES {_values(rules)}),
phrase(label, pattern) AS (VALUES {_values(phrases)}),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_low('text')} AS low FROM documents),
n AS (SELECT rid, doc_id, low, trim(regexp_replace(low, '{_GAPS}', '  ', 'g'), ' ') AS joined FROM d),
t AS (SELECT rid, doc_id, low, CASE WHEN joined = '' THEN '' ELSE ' ' || joined || ' ' END AS norm FROM n),
m AS (SELECT rid, rule.*, string_split_regex(norm, pattern) AS pieces, regexp_extract_all(norm, pattern) AS matches
      FROM t JOIN rule ON contains(low, k1) AND contains(low, k2) WHERE regexp_matches(norm, pattern)),
f AS (SELECT rid, label, priority, confidence, number, ({places}) // 2 AS first, ({places} + {spaces('matches[i]')}) // 2 - 1 AS last
      FROM m, unnest(range(1, len(matches) + 1)) u(i)),
o AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY priority DESC, last - first DESC, first, number) AS turn FROM f),
kept AS (
  SELECT rid, turn, [{{'first': first, 'last': last}}] AS taken, [label] AS labels, confidence FROM o WHERE turn = 1
  UNION ALL
  SELECT o.rid, o.turn,
    CASE WHEN len(list_filter(taken, lambda k: k.first <= o.last AND k.last >= o.first)) > 0 THEN taken ELSE list_append(taken, {{'first': o.first, 'last': o.last}}) END,
    CASE WHEN len(list_filter(taken, lambda k: k.first <= o.last AND k.last >= o.first)) > 0 THEN labels ELSE list_append(labels, o.label) END,
    CASE WHEN len(list_filter(taken, lambda k: k.first <= o.last AND k.last >= o.first)) > 0 THEN kept.confidence ELSE greatest(kept.confidence, o.confidence) END
  FROM kept JOIN o ON o.rid = kept.rid AND o.turn = kept.turn + 1),
found AS (SELECT rid, max_by(labels, turn) AS labels, max_by(confidence, turn) AS confidence FROM kept GROUP BY rid),
bm AS (SELECT rid, label, string_split_regex(norm, pattern) AS pieces, regexp_extract_all(norm, pattern) AS matches FROM t, phrase WHERE regexp_matches(norm, pattern)),
bp AS (SELECT rid, label, ({places}) // 2 AS first FROM bm, unnest(range(1, len(matches) + 1)) u(i)),
base AS (SELECT rid, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word, list(DISTINCT label) AS labels FROM bp GROUP BY rid)
SELECT doc_id, CAST(len(regexp_extract_all(low, '{_WORD}')) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') AS labels,
  CAST(greatest(coalesce(found.confidence, 0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0 END) AS DOUBLE) AS score
FROM t LEFT JOIN base USING (rid) LEFT JOIN found USING (rid)"""


def shards(count: int = 8, seed: int = 20) -> str:
    return f"""
WITH polynomial AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS h, md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
c AS (
  SELECT doc_id, source, digest, CAST(length(h) // 2 + 1 AS BIGINT) AS size,
    CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32
  FROM d, polynomial),
r AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY digest, doc_id, size, text_crc32) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY source) AS part FROM c),
p AS (SELECT *, row_number() OVER (ORDER BY part, digest, source NULLS FIRST, doc_id NULLS FIRST, size, text_crc32) - 1 AS place, count(*) OVER () AS n FROM r),
s AS (SELECT *, place * {count} // n AS shard FROM p)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard, CAST(place - (shard * n + {count - 1}) // {count} AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard FROM s"""


def ranked_documents(k: int = 10) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_low('text')}, '{_WORD}') AS w FROM documents),
q AS (SELECT row_number() OVER () AS qid, item_id, regexp_extract_all({_low('text')}, '{_WORD}') AS w FROM benchmark),
qt AS (SELECT qid, term, count(*) AS times FROM (SELECT qid, unnest(w) AS term FROM q) GROUP BY ALL),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
dt AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM dt, size GROUP BY term, n_docs),
m AS (SELECT rid, doc_id, 100 - 75 + (75 * CAST(len(w) AS BIGINT) * n_docs) // n_terms AS m FROM d, size WHERE len(w) > 0),
scored AS (
  SELECT qid, rid, doc_id, CAST(sum(times * weight.w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM qt JOIN dt USING (term) JOIN weight USING (term) JOIN m USING (rid) GROUP BY qid, rid, doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed JOIN q USING (qid) WHERE place <= {k}"""


def divergence(min_docs: int = 30, ranks: int = 50) -> str:
    chance = "1 + (1000000000::HUGEINT * ({0} + 5)) // ({1} + 5 * size)".format
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_low('text')}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT lang, source, rid, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT rid) >= {min_docs}),
size AS (SELECT lang, count(*) AS size, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
here AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(n) AS total FROM here GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, term, coalesce(n, 0) AS n, {chance('coalesce(n, 0)', 'coalesce(total, 0)')} AS p, {chance('lang_n', 'lang_total')} AS q
  FROM g JOIN kept USING (lang) JOIN size USING (lang) LEFT JOIN here USING (lang, source, term) LEFT JOIN total USING (lang, source)),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b USING (lang, term) GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM placed WHERE part = 'pair' OR rank <= {ranks}"""
