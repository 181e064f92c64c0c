"""DuckDB equivalents of the queries that SQL can express."""

from __future__ import annotations

from lumenlake.llm import licenses
from lumenlake.llm.mixing import CYCLE, MAX_EPOCHS, SEED, SHARE

_BLANKS = r"[\x20\x09-\x0D]+"
_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS place
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [{', '.join(f'{w}.0' for w in CYCLE)}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(CYCLE)}]::DOUBLE AS weight
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, {MAX_EPOCHS}.0::DOUBLE * source_size AS cap,
         coalesce(sum({MAX_EPOCHS}.0::DOUBLE * source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS clamped,
         sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         {SHARE}::DOUBLE * sum(source_size) OVER () AS amount
  FROM sources
), marked AS (
  SELECT *, weight * (amount - clamped) > cap * rest AS over FROM ordered
), level AS (
  SELECT max(amount) - coalesce(sum(cap) FILTER (over), 0) AS num, sum(weight) FILTER (NOT over) AS den FROM marked
), targets AS (
  SELECT source, source_size, CASE WHEN over THEN cap ELSE weight * num / den END AS target FROM marked, level
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far,
         sum(d.size) OVER (PARTITION BY d.source, d.place) AS here
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN so_far - here / 2.0::DOUBLE < target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

EXACT = f"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_BLANKS}', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM n WINDOW same AS (PARTITION BY t)
"""

LINES = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, trim(translate(line, {_ASCII}), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM lines
), owned AS (
  SELECT *, length(key) < 10 OR doc_id = min(doc_id) OVER (PARTITION BY key) AS stays FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (stays), '')) AS kept_sha256
FROM owned GROUP BY doc_id
"""

WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


def _license_sql() -> str:
    known = licenses.known_sentences()
    names = ", ".join(f"'{name}'" for name in known.values())
    texts = ", ".join(f"'{text}'" for text in known)
    norm = lambda x: f"trim(regexp_replace(translate({x}, {_ASCII}), '[^a-z0-9]+', ' ', 'g'))"
    left = "' ' || list_aggregate(found, 'string_agg', '  ') || ' '"
    for name, run in licenses.RULES:
        left = f"replace({left}, ' {'  '.join(run)} ', ' ={name} ')"
    return f"""
WITH names AS (SELECT map([{texts}], [{names}]) AS m),
cut AS (
  SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '{licenses.SENTENCE_END}', '\\1' || chr(1), 'g'), chr(1)) AS s
  FROM documents
), named AS (
  SELECT doc_id, flatten([CASE WHEN m[{norm('x')}] IS NOT NULL THEN [m[{norm('x')}]]
      ELSE [coalesce(m[{norm('l')}], '|') FOR l IN string_split(x, chr(10)) IF length({norm('l')}) > 2] END FOR x IN s]) AS found
  FROM cut, names
), matched AS (
  SELECT doc_id, len([x FOR x IN found IF x <> '|']) AS n_sentences, coalesce({left}, '  ') AS rest FROM named
)
SELECT doc_id, array_to_string(regexp_extract_all(rest, '=(\\S+)', 1), ',') AS licenses, n_sentences,
       len(regexp_extract_all(rest, '\\s([A-Z]\\w*)\\s', 1)) AS n_unclaimed
FROM matched
"""

_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), {_ASCII}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

SEARCH = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS place, {_TERMS} AS terms FROM documents),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d WHERE len(terms) > 0),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
single AS (SELECT doc_id, place, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM d),
counted AS (
  SELECT doc_id, place, n, term, CAST(count(*) AS BIGINT) AS tf FROM single
  WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, place, n, term
), weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, size GROUP BY term
), scored AS (
  SELECT item_id, place, any_value(doc_id) AS doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // total)))) AS BIGINT) AS score
  FROM counted JOIN weighed USING (term) JOIN wanted USING (term), size GROUP BY item_id, place
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""


ORACLES = {
    "op1_mixing": MIXING, "op5_exact": EXACT, "op6_lines": LINES, "op8_warc": WARC, "op10_licenses": _license_sql(),
    "op13_search": SEARCH,
}
