"""DuckDB twins of those text queries that SQL can express."""

from __future__ import annotations

from farelane.llm.common import LOWER, UPPER
from farelane.llm.curriculum import Mix
from farelane.llm.line_dedup import MIN_SITES
from farelane.llm.quality_rules import SYMBOLS, QualityRules
from farelane.llm.topk_search import EVERY, SCALE, K
from farelane.llm.url_filter import LISTED_NAMES, RULES
from farelane.llm.warc_zip import MIN_BYTES

_RULES = QualityRules()
_WHITE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
_NORMAL = f"trim(regexp_replace(translate(line, '{UPPER}', '{LOWER}'), '{_WHITE}', ' ', 'g'), ' ')"
_WORDS = f"list_filter(string_split_regex(%s, '{_WHITE}'), lambda x: x <> '')"

QUALITY = rf"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT row_id, {_WORDS % "text"} AS w FROM docs),
windows AS (
  SELECT row_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
twice AS (SELECT row_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY row_id, k) > 1),
covered AS (SELECT row_id, count(DISTINCT p) AS n FROM (SELECT row_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY row_id),
lines AS (
  SELECT row_id, doc_id, source, text, line, {_NORMAL} AS k, len({_WORDS % "line"}) AS n
  FROM (SELECT row_id, doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '{_WORD}')),
hosts AS (SELECT source AS host, count(DISTINCT text) AS host_docs FROM docs GROUP BY source),
frequent AS (
  SELECT source, k, min(doc_id) AS home FROM lines JOIN hosts ON hosts.host IS NOT DISTINCT FROM lines.source GROUP BY source, k HAVING count(DISTINCT text) > {_RULES.max_line_docs}
    OR (count(DISTINCT text) > {_RULES.min_line_docs} AND 100 * count(DISTINCT text) > {_RULES.max_line_percent} * any_value(host_docs))),
lost AS (
  SELECT row_id, sum(n) AS words, count(*) AS n
  FROM lines JOIN frequent ON lines.source IS NOT DISTINCT FROM frequent.source AND lines.k = frequent.k
  WHERE doc_id IS DISTINCT FROM home GROUP BY row_id),
dups AS (SELECT row_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY row_id),
facts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{_WHITE}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(lost.n, 0) AS BIGINT) AS n_lost_lines, CAST(len(w) - coalesce(lost.words, 0) AS BIGINT) AS n_left_words
  FROM docs JOIN words USING (row_id) LEFT JOIN covered USING (row_id) LEFT JOIN dups USING (row_id) LEFT JOIN lost USING (row_id)),
judged AS (SELECT *, n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.max_repeat_percent} * n_words AS base_failed FROM facts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * n_left_words >= {_RULES.min_kept_percent} * n_words AS kept, n_lost_lines, n_left_words
FROM judged
"""

_FITS = "\n".join(
    f"    WHEN (host = '{rule.split('/', 1)[0]}' OR ends_with(host, '.{rule.split('/', 1)[0]}')) AND starts_with(path, '/{rule.split('/', 1)[1]}') "
    f"THEN '{rule}'"
    for _, rule in sorted(RULES, key=lambda r: -len(r[1]))
)
_VERDICTS = " ".join(f"WHEN '{rule}' THEN '{verdict}'" for verdict, rule in RULES)

URLS = rf"""
WITH parts AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path
  FROM (SELECT page_id, html, coalesce(regexp_extract(url, '^.*?://(.*)$', 1, 's'), '') AS rest FROM pages)),
judged AS (
  SELECT *, CASE
{_FITS}
    END AS rule,
    CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html)?/*$', '') END AS canonical
  FROM parts),
firsts AS (SELECT html, canonical, min(page_id) AS page_id FROM judged WHERE html IS NOT NULL GROUP BY html, canonical),
listed AS (
  SELECT DISTINCT canonical FROM firsts JOIN (SELECT html, min(page_id) AS least FROM firsts GROUP BY html) USING (html)
  WHERE page_id > least AND canonical IS NOT NULL
  UNION SELECT canonical FROM judged WHERE regexp_matches(host, '(^|\.)({"|".join(LISTED_NAMES)})(\.|$)'))
SELECT page_id, host, path, rule,
  CASE rule {_VERDICTS} ELSE CASE WHEN canonical IN (FROM listed) THEN 'block' ELSE 'allow' END END AS verdict, canonical
FROM judged
"""

BOILERPLATE = rf"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, source, text FROM documents),
lines AS (
  SELECT row_id, doc_id, source, line, pos, {_NORMAL} AS k, regexp_matches(line, '{_WORD}') AS has_word
  FROM (SELECT row_id, doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM docs)),
spread AS (
  SELECT k, min(doc_id) AS home FROM lines WHERE has_word GROUP BY k
  HAVING count(DISTINCT coalesce('s' || source, '')) >= {MIN_SITES}),
stays AS (
  SELECT row_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM lines LEFT JOIN spread ON has_word AND lines.k = spread.k
  WHERE spread.k IS NULL OR doc_id IS NOT DISTINCT FROM home GROUP BY row_id),
result AS (
  SELECT docs.row_id, docs.doc_id, CAST(len(string_split(coalesce(docs.text, ''), chr(10))) AS BIGINT) AS n_lines,
    CASE WHEN docs.text IS NOT NULL THEN coalesce(stays.text, '') END AS text
  FROM docs LEFT JOIN stays USING (row_id))
SELECT doc_id, n_lines, CAST(length(text) AS BIGINT) AS n_chars_left, text = '' AS is_empty, md5(text) AS text_md5 FROM result
"""

NEAREST = f"""
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM fine q, fine c WHERE q.vec_id % {EVERY} = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= {K}
"""

ARCHIVED = f"""
WITH held AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM held WHERE payload_bytes >= {MIN_BYTES} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM held LEFT JOIN firsts USING (payload_digest)
"""

_MIX = Mix()


def _time_sql(schedule) -> str:
    """The time at which the share ``done`` of a schedule is reached, as a CASE over its parts."""
    sums = [0.0]
    for (t, v), (u, w) in zip(schedule, schedule[1:]):
        sums.append(sums[-1] + (v + w) / 2 * (u - t))
    number = lambda x: f"CAST({x!r} AS DOUBLE)"
    parts = []
    for (t, v), (u, w), before, after in zip(schedule, schedule[1:], sums, sums[1:]):
        rest = f"(done * {number(sums[-1])} - {number(before)})"
        root = f"sqrt(greatest({number(v * v)} + {number(2 * ((w - v) / (u - t)))} * {rest}, 0))"
        parts.append(f"WHEN done * {number(sums[-1])} < {number(after)} THEN {number(t)} + 2 * {rest} / ({number(v)} + {root})")
    return f"(CASE {' '.join(parts)} ELSE 1 END)"


MIXED = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, CAST(len({_WORDS % "coalesce(text, '')"}) AS BIGINT) AS size,
    CAST('0x' || substr(md5('{_MIX.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS place
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM docs GROUP BY source),
weighted AS (SELECT *, [{", ".join(map(str, _MIX.weights))}][CAST(i % {len(_MIX.weights)} AS INT) + 1] AS w FROM sources),
shared AS (
  SELECT *, sum(s) OVER () AS total, coalesce(sum(s) OVER (ORDER BY s / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone,
    sum(w) OVER (ORDER BY s / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w
  FROM weighted),
fills AS (SELECT *, {100 * _MIX.most} * s * left_w <= w * ({_MIX.share} * total - {100 * _MIX.most} * gone) AS is_full FROM shared),
aims AS (
  SELECT source, s, i, CASE WHEN is_full THEN CAST({_MIX.most} * s AS DOUBLE)
    ELSE CAST(w * ({_MIX.share} * total - {100 * _MIX.most} * coalesce(sum(s) FILTER (is_full) OVER (), 0)) AS DOUBLE)
      / CAST(100 * sum(w) FILTER (NOT is_full) OVER () AS DOUBLE) END AS target
  FROM fills),
starts AS (
  SELECT docs.*, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS c
  FROM docs),
copies AS (
  SELECT row_id, e, least(size, CAST(floor(target) AS BIGINT) - c - e * s) AS taken, i, CAST(c + e * s AS DOUBLE) / target AS done
  FROM starts JOIN aims ON starts.source IS NOT DISTINCT FROM aims.source, range({_MIX.most}) AS t(e)),
timed AS (
  SELECT *, CASE i % {len(_MIX.weights)} {" ".join(f"WHEN {k} THEN {_time_sql(x)}" for k, x in enumerate(_MIX.schedules))} END AS time
  FROM copies WHERE taken > 0),
sums AS (SELECT row_id, CAST(sum(taken) AS BIGINT) AS taken, count(*) AS n, min(time) AS time FROM timed GROUP BY row_id)
SELECT doc_id, size, s AS source_size, target, coalesce(taken, 0) AS taken, coalesce(n, 0) AS n_copies,
  CAST(floor(time * 1000000) AS BIGINT) AS first_millionth
FROM docs JOIN aims ON docs.source IS NOT DISTINCT FROM aims.source LEFT JOIN sums USING (row_id)
"""


ORACLE_SQL = {
    "op2_quality_rules": QUALITY,
    "op4_warc_zip": ARCHIVED,
    "op7_url_filter": URLS,
    "op8_exact_topk": NEAREST,
    "op10_line_dedup": BOILERPLATE,
    "op13_source_curriculum": MIXED,
}
