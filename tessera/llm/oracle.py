"""DuckDB SQL of the operators that SQL can state."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Sizes are word counts; level = the largest water level over the sources in
# the order of cap / weight; the extra copy goes to the documents whose middle,
# in md5 order, lies before the remainder of the target.
ORACLE["op8_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce('=' || source, '~') AS src,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src),
w AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY src) - 1) % 3 + 1]::DOUBLE AS wt,
             source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5
        - (sum(cap) OVER (ORDER BY cap / wt, src ROWS UNBOUNDED PRECEDING) - cap))
        / sum(wt) OVER (ORDER BY cap / wt, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM w),
t AS (SELECT src, source_size, least(cap, max(lv) OVER () * wt) AS target FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
             sum(size) OVER (PARTITION BY src ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
      FROM d JOIN t USING (src))
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN 2 * before + size < 2 * (target - whole * source_size) THEN 1 ELSE 0 END)
            * size AS BIGINT) AS taken
FROM r
"""

_RULES = """
SELECT page_id, host, path,
  CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
       WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
       WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
       WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
FROM (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
                                 ELSE '' END AS rest FROM pages))
"""


def _strength(groups: str) -> str:
    """Prior strength of one level by moments, between 1 and 1000."""
    return f"""
SELECT least(greatest(coalesce(CASE WHEN share > 1e-9 THEN 1 / share - 1 END, 1000.0), 1.0), 1000.0) AS k FROM (
  SELECT (bb - nn * m * m - m * (1 - m) * (g - 1))
         / CASE WHEN m * (1 - m) * (nn - n2 / nn - (g - 1)) > 1e-9
                THEN m * (1 - m) * (nn - n2 / nn - (g - 1)) END AS share
  FROM (SELECT sum(n)::DOUBLE AS nn, sum(bad) / sum(n) AS m, count(*) AS g, sum(n * n)::DOUBLE AS n2,
               sum(bad * bad / n::DOUBLE) AS bb FROM {groups} WHERE n > 0))"""


ORACLE["op7_url_filter"] = f"""
WITH r AS ({_RULES}),
v AS (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
                     WHEN rule IS NOT NULL THEN 'allow' END AS decided FROM r),
h AS (SELECT host, count(decided)::DOUBLE AS n, count(*) FILTER (decided = 'block')::DOUBLE AS bad,
             CASE WHEN two IN ('co.uk', 'com.au', 'co.jp', 'com.br') THEN array_to_string(parts[-3:], '.')
                  ELSE two END AS domain,
             CASE WHEN two IN ('co.uk', 'com.au', 'co.jp', 'com.br') THEN two ELSE parts[-1] END AS suffix
      FROM (SELECT *, string_split(host, '.') AS parts, array_to_string(string_split(host, '.')[-2:], '.') AS two
            FROM v) GROUP BY ALL),
dm AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
sf AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM dm GROUP BY ALL),
al AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1) AS m FROM sf),
kh AS ({_strength('h')}), kd AS ({_strength('dm')}), ks AS ({_strength('sf')}),
sm AS (SELECT suffix, (bad + k * m) / (n + k) AS m FROM sf, ks, al),
dmm AS (SELECT domain, (bad + k * sm.m) / (n + k) AS m FROM dm JOIN sm USING (suffix), kd),
hm AS (SELECT host, (bad + k * dmm.m) / (n + k) AS m, n + k AS size FROM h JOIN dmm USING (domain), kh)
SELECT page_id, host, path, rule,
       coalesce(decided, CASE WHEN m - 1.645 * sqrt(m * (1 - m) / (size + 1)) > 0.5
                              THEN 'block' ELSE 'allow' END) AS verdict
FROM v JOIN hm USING (host)
"""

# crc32 bit by bit over the UTF-8 bytes; near words share the rest after deleting
# one code point at the same place, or one of them is the other's rest.
ORACLE["op13_spelling_variants"] = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
held AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY 1, 2),
coded AS (SELECT run, k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM held),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda y, s: xor(y >> 1, 3988292384 * (y & 1))))) AS h
  FROM coded),
words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k
    FROM hashed) w
  GROUP BY word HAVING length(word) >= 7 AND sum(k) >= 2),
cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words) w),
near AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word),
best AS (
  SELECT p.word, a.n, count(*) AS n_near, max(b.n) AS most, arg_min(p.near, (-b.n, p.near)) AS near
  FROM near p JOIN words a ON p.word = a.word JOIN words b ON p.near = b.word GROUP BY 1, 2),
forms AS (SELECT word, near AS form, most AS form_n FROM best WHERE most >= 10 * n),
chain AS (SELECT word, form, 1 AS step FROM forms
          UNION ALL SELECT c.word, f.form, c.step + 1 FROM chain c JOIN forms f ON c.form = f.word)
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, coalesce(b.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN best b ON w.word = b.word LEFT JOIN forms f ON w.word = f.word
LEFT JOIN (SELECT word, arg_max(form, step) AS root FROM chain GROUP BY 1) r ON w.word = r.word
"""
