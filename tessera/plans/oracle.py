"""DuckDB SQL stating the same result as each registered query.

The SQL is written independently of the DataFrame code, from the
operator semantics; the driver runs both and compares the results.
Shared common-table expressions are composed as text.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def to_int32(s: str) -> str:
    return (f"CASE WHEN regexp_matches({s}, '^[+-]?[0-9]+([.][0-9]*)?$') "
            f"THEN try_cast(trunc(try_cast({s} AS DECIMAL(38,10))) AS INTEGER) END")


def round_half_up(x: str, k: int) -> str:
    return (f"CASE WHEN abs({x}) < 9007199254740992 "
            f"THEN CAST(round(TRY_CAST({x} AS DECIMAL(38,9)), {k}) AS DOUBLE) ELSE {x} END")


def wrap_int32(x: str) -> str:
    return (f"CAST(((({x}) + 2147483648) % 4294967296 + 4294967296) % 4294967296 "
            f"- 2147483648 AS INTEGER)")


# ---------------------------------------------------------------- survey

SALARY_ROWS = """salary_rows AS (
  SELECT o_orderkey AS resp_id, n_name AS Country,
    CASE WHEN o_orderkey = 5 THEN '1E78' WHEN o_orderkey = 6 THEN '1E39'
         WHEN o_orderkey = 10 THEN 'NaN' WHEN o_orderkey = 11 THEN 'Infinity'
         WHEN o_orderkey % 23 = 0 THEN 'NA'
         WHEN o_orderkey % 29 = 0 THEN '0'
         WHEN o_orderkey % 31 = 0 THEN '0.0'
         WHEN o_orderkey % 37 = 0 THEN '240,000,000'
         WHEN o_orderkey % 41 = 0 THEN '99,999,999,999'
         WHEN o_orderkey % 43 = 0 THEN 'abc'
         WHEN o_orderkey % 47 = 0 THEN '1000.50'
         ELSE format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) END AS Salary,
    CASE o_orderkey % 4 WHEN 0 THEN 'Yearly' WHEN 1 THEN 'Monthly'
         WHEN 2 THEN 'Weekly' ELSE 'NA' END AS SalaryType
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey)"""

CLEAN = """clean AS (
  SELECT resp_id, Country, replace(Salary, ',', '') AS Salary, SalaryType
  FROM salary_rows
  WHERE replace(Salary, ',', '') <> 'NA' AND replace(Salary, ',', '') <> '0')"""

ANNUAL = f"""parsed AS (
  SELECT resp_id, Country, SalaryType,
         CAST({to_int32('Salary')} AS BIGINT) AS i,
         CASE WHEN isfinite(try_cast(Salary AS DOUBLE)) THEN try_cast(Salary AS DOUBLE) END AS d
  FROM clean),
annual AS (
  SELECT resp_id, Country, SalaryType,
    CASE WHEN i <> 0 THEN
      CASE SalaryType WHEN 'Monthly' THEN i * 12 WHEN 'Weekly' THEN i * 52 ELSE i END
    END AS salary_int,
    CASE SalaryType WHEN 'Monthly' THEN d * 12.0 WHEN 'Weekly' THEN d * 52.0 ELSE d END AS salary_double
  FROM parsed),
annual2 AS (
  SELECT *, {wrap_int32('salary_int')} AS salary_int32 FROM annual)"""

SURVEY = _with(SALARY_ROWS, CLEAN)
SURVEY_ANNUAL = _with(SALARY_ROWS, CLEAN, ANNUAL)

ORACLE["salary_clean_rows"] = SURVEY + "SELECT * FROM clean"

ORACLE["yearly_salary_rows"] = SURVEY + """
SELECT resp_id, Country, Salary,
       CASE WHEN SalaryType = 'NA' THEN 'Yearly' ELSE SalaryType END AS SalaryType
FROM clean WHERE SalaryType IN ('Yearly', 'NA')"""

ORACLE["salary_annualised"] = SURVEY_ANNUAL + """
SELECT resp_id, Country, SalaryType, salary_int, salary_int32, salary_double FROM annual2"""

ORACLE["country_counts"] = SURVEY + """
SELECT Country, count(*) AS n FROM clean GROUP BY Country"""

ORACLE["country_counts_with_total"] = SURVEY + """
SELECT Country, count(*) AS n FROM clean GROUP BY Country
UNION ALL SELECT 'Total' AS Country, count(*) AS n FROM clean"""

_STATS_COMPAT = f"""
SELECT Country, count(*) AS n,
       min(salary_int32) AS min_salary, max(salary_int32) AS max_salary,
       {round_half_up('avg(coalesce(salary_double, 0.0))', 2)} AS avg_salary
FROM annual2 GROUP BY Country HAVING count(salary_int32) > 0"""

ORACLE["country_salary_summary"] = SURVEY_ANNUAL + _STATS_COMPAT
ORACLE["country_salary_minmax"] = (SURVEY_ANNUAL + "SELECT Country, min_salary, max_salary FROM ("
                                   + _STATS_COMPAT + ") s")
ORACLE["country_salary_avg"] = (SURVEY_ANNUAL + "SELECT Country, avg_salary FROM ("
                                + _STATS_COMPAT + ") s")
ORACLE["country_salary_summary_safe"] = SURVEY_ANNUAL + f"""
SELECT Country, count(*) AS n,
       min(salary_int) AS min_salary, max(salary_int) AS max_salary,
       {round_half_up('avg(salary_double)', 2)} AS avg_salary
FROM annual2 GROUP BY Country"""


# ---------------------------------------------------------------- itemsets

BASKET_ITEMS = """bi AS (
  SELECT DISTINCT doc_id AS basket_id, trim(replace(replace(word, '.', ''), ',', '')) AS item
  FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) w
  WHERE trim(replace(replace(word, '.', ''), ',', '')) <> '')"""

SUPPORT = """sup AS (SELECT count(DISTINCT basket_id) * 40 // 100 AS s FROM bi)"""


def _itemsets_sql(support_expr: str) -> str:
    """All itemsets with support >= support_expr: every subset of a
    basket's frequent items is enumerated recursively and counted."""
    return f"""WITH RECURSIVE {BASKET_ITEMS},
{SUPPORT},
e1 AS (
  SELECT basket_id, item FROM bi
  WHERE item IN (SELECT item FROM bi GROUP BY item
                 HAVING count(*) >= ({support_expr}))),
ext(basket_id, items, last) AS (
  SELECT basket_id, [item], item FROM e1
  UNION ALL
  SELECT x.basket_id, list_append(x.items, e.item), e.item
  FROM ext x JOIN e1 e ON x.basket_id = e.basket_id AND e.item > x.last),
fi AS (
  SELECT CAST(len(items) AS INTEGER) AS size, array_to_string(items, ',') AS items,
         count(*) AS support, items AS key
  FROM ext GROUP BY items HAVING count(*) >= ({support_expr}))
"""


_FI = _itemsets_sql("SELECT s FROM sup")

ORACLE["baskets"] = f"""WITH {BASKET_ITEMS}
SELECT b.basket_id, b.item, c.basket_size
FROM bi b JOIN (SELECT basket_id, count(*) AS basket_size FROM bi GROUP BY basket_id) c
  ON b.basket_id = c.basket_id"""
ORACLE["frequent_items"] = _FI + "SELECT size, items, support FROM fi WHERE size = 1"
ORACLE["frequent_pairs"] = _FI + "SELECT size, items, support FROM fi WHERE size = 2"
ORACLE["frequent_triples"] = _FI + "SELECT size, items, support FROM fi WHERE size = 3"
ORACLE["frequent_itemsets"] = _FI + "SELECT size, items, support FROM fi"
ORACLE["frequent_itemsets_levelwise"] = ORACLE["frequent_itemsets"]
# items of half the support, and the sets all of whose subsets with one item less are frequent
ORACLE["candidate_support"] = _FI + """,
joined AS (
  SELECT list_append(a.key, b.key[b.size]) AS items
  FROM fi a JOIN fi b ON a.size = b.size AND a.key[1:a.size - 1] = b.key[1:b.size - 1] AND a.key[a.size] < b.key[b.size]),
subsets AS (SELECT items, unnest(list_transform(range(1, len(items) + 1), lambda i: items[1:i - 1] || items[i + 1:])) AS sub FROM joined),
cand AS (
  SELECT s.items FROM subsets s JOIN fi ON s.sub = fi.key GROUP BY s.items HAVING count(*) = len(s.items)),
counted AS (SELECT items, count(*) AS n FROM ext GROUP BY items)
SELECT CAST(len(c.items) AS INTEGER) AS size, array_to_string(c.items, ',') AS items, coalesce(k.n, 0) AS support
FROM cand c LEFT JOIN counted k ON c.items = k.items
UNION ALL
SELECT CAST(1 AS INTEGER), item, count(*) FROM bi GROUP BY item HAVING count(*) >= (SELECT s // 2 FROM sup)"""
ORACLE["itemset_report_lines"] = _FI + """
SELECT row_number() OVER (ORDER BY size, key) - 1 AS position, size, '(' || items || ')' AS text FROM fi"""


# ---------------------------------------------------------------- ratings

RATINGS = """ratings AS (
  SELECT o_custkey AS "user", l_partkey AS item,
         max(0.5::DOUBLE + 0.5::DOUBLE * floor((l_quantity - 1) / 5)) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey),
train AS (SELECT * FROM ratings WHERE NOT (("user" * 31 + item) % 5 = 0)),
test AS (SELECT * FROM ratings WHERE ("user" * 31 + item) % 5 = 0)"""

R = _with(RATINGS)

ORACLE["ratings_split"] = R + """
SELECT "user", item, rating, ("user" * 31 + item) % 5 = 0 AS is_test FROM ratings"""

ORACLE["user_ids"] = R + """
SELECT "user", CAST(row_number() OVER (ORDER BY "user") - 1 AS INTEGER) AS user_id
FROM (SELECT DISTINCT "user" FROM ratings) d"""

ORACLE["item_ids"] = R + """
SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INTEGER) AS item_id
FROM (SELECT DISTINCT item FROM ratings) d"""

ORACLE["encoded_ratings"] = R + """
SELECT CAST(dense_rank() OVER (ORDER BY "user") - 1 AS INTEGER) AS user_id,
       CAST(dense_rank() OVER (ORDER BY item) - 1 AS INTEGER) AS item_id,
       rating, ("user" * 31 + item) % 5 = 0 AS is_test
FROM ratings"""

ORACLE["exact_price_sums"] = f"""
SELECT l_returnflag, l_linestatus, n, {round_half_up("s", 2)} AS price_sum, {round_half_up("s / n", 6)} AS price_mean
FROM (SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, fsum(l_extendedprice) AS s
      FROM lineitem GROUP BY 1, 2) t"""

ORACLE["grown_customer_ids"] = """
SELECT o_custkey, CAST(row_number() OVER (ORDER BY period, pos) - 1 AS BIGINT) AS cust_id FROM (
  SELECT o_custkey, min(p) AS period, min(o_orderkey) FILTER (WHERE p = lowest) AS pos FROM (
    SELECT *, min(p) OVER (PARTITION BY o_custkey) AS lowest FROM (
      SELECT o_custkey, o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1995-07-01' THEN 0
                                         WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 1 ELSE 2 END AS p
      FROM orders WHERE o_custkey IS NOT NULL) a) b GROUP BY 1) c"""

ORACLE["user_rating_stats"] = R + """
SELECT "user", count(*) AS n, sum(rating) AS total, avg(rating) AS mean
FROM train GROUP BY 1"""

ORACLE["user_rating_stats_with_test"] = R + """
SELECT "user", count(*) AS n, sum(rating) AS total, avg(rating) AS mean
FROM ratings GROUP BY 1"""

_KNOWN = """ "user" IN (SELECT "user" FROM train) AND item IN (SELECT item FROM train)"""
ORACLE["als_predicted_pairs"] = R + """SELECT "user", item, rating FROM test WHERE""" + _KNOWN
ORACLE["als_unpredicted"] = R + """SELECT "user", item, rating FROM test WHERE NOT (""" + _KNOWN + ")"

# Pearson weights in the two-pass form of the definition: centre each
# user's ratings on the mean over the common items, then correlate.
CF = _with(RATINGS, """co AS (
  SELECT a."user" AS u, b."user" AS v, a.item, a.rating AS r1, b.rating AS r2
  FROM train a JOIN train b ON a.item = b.item AND a."user" <> b."user"
  WHERE a."user" IN (SELECT "user" FROM test)),
means AS (
  SELECT u, v, count(*) AS n, avg(r1) AS mean1, avg(r2) AS mean2 FROM co GROUP BY u, v),
weights AS (
  SELECT c.u, c.v,
    CASE WHEN sum((r1 - mean1) * (r1 - mean1)) = 0 OR sum((r2 - mean2) * (r2 - mean2)) = 0
         THEN 0.0
         ELSE sum((r1 - mean1) * (r2 - mean2))
              / (sqrt(sum((r1 - mean1) * (r1 - mean1))) * sqrt(sum((r2 - mean2) * (r2 - mean2))))
    END AS w
  FROM co c JOIN means m ON c.u = m.u AND c.v = m.v GROUP BY c.u, c.v),
nbrs AS (
  SELECT t."user" AS u, t.item, tr."user" AS v, tr.rating AS r
  FROM test t JOIN train tr ON t.item = tr.item AND t."user" <> tr."user"),
offs AS (
  SELECT n.u AS "user", n.item,
         sum(w.w * (n.r - m.mean2)) AS num, sum(abs(w.w)) AS den
  FROM nbrs n JOIN means m ON n.u = m.u AND n.v = m.v
              JOIN weights w ON n.u = w.u AND n.v = w.v
  GROUP BY n.u, n.item),
umean AS (SELECT "user", avg(rating) AS mean FROM train GROUP BY "user"),
preds AS (
  SELECT o."user", o.item,
         um.mean + CASE WHEN o.den <> 0 THEN o.num / o.den ELSE 0.01 END AS prediction
  FROM offs o JOIN umean um ON o."user" = um."user"),
scored AS (
  SELECT t."user", t.item, t.rating,
    CASE WHEN raw <= 0 THEN 0.2 WHEN raw >= 5 THEN 4.0 ELSE raw - 0.79 END AS prediction
  FROM (SELECT t."user", t.item, t.rating,
               CAST(CAST(coalesce(p.prediction, um.mean,
                        (SELECT sum(rating) / count(*) FROM train)) AS DECIMAL(38,9)) AS DOUBLE) AS raw
        FROM test t LEFT JOIN preds p ON t."user" = p."user" AND t.item = p.item
                    LEFT JOIN umean um ON t."user" = um."user") t)""")

# only pairs that a test row needs: its user and a rater of its item
_NEEDED = " WHERE (u, v) IN (SELECT u, v FROM nbrs)"
ORACLE["corated_pairs"] = CF + "SELECT u, v, n FROM means" + _NEEDED
# all pairs of users with a common item
ORACLE["pair_means"] = R + f"""
SELECT u, v, n, {round_half_up('mean1', 6)} AS mean1, {round_half_up('mean2', 6)} AS mean2
FROM (SELECT a."user" AS u, b."user" AS v, count(*) AS n, avg(a.rating) AS mean1, avg(b.rating) AS mean2
      FROM train a JOIN train b ON a.item = b.item AND a."user" <> b."user" GROUP BY 1, 2) m"""
ORACLE["pearson_weights"] = CF + f"SELECT u, v, {round_half_up('w', 6)} AS w FROM weights" + _NEEDED
ORACLE["cf_neighbours"] = CF + "SELECT u, item, v, r FROM nbrs"
ORACLE["cf_offsets"] = CF + f"""
SELECT "user", item, {round_half_up('num', 6)} AS num, {round_half_up('den', 6)} AS den FROM offs"""
ORACLE["cf_predictions"] = CF + f"""
SELECT "user", item, {round_half_up('prediction', 6)} AS prediction FROM preds"""
ORACLE["cf_unpredicted"] = CF + """
SELECT t."user", t.item, t.rating FROM test t
WHERE NOT EXISTS (SELECT 1 FROM preds p WHERE p."user" = t."user" AND p.item = t.item)"""
ORACLE["cf_predictions_clamped"] = CF + f"""
SELECT "user", item, rating, {round_half_up('prediction', 6)} AS prediction FROM scored"""
ORACLE["cf_rmse"] = CF + f"""
SELECT count(*) AS n, {round_half_up('sqrt(avg((rating - prediction) * (rating - prediction)))', 6)} AS rmse
FROM scored"""
ORACLE["cf_error_histogram"] = CF + """
SELECT b.bucket, b.label, coalesce(c.n, 0) AS n
FROM (VALUES (0, '>=0 and <1'), (1, '>=1 and <2'), (2, '>=2 and <3'),
             (3, '>=3 and <4'), (4, '>=4')) AS b(bucket, label)
LEFT JOIN (SELECT CAST(least(floor(abs(rating - prediction)), 4) AS INTEGER) AS bucket,
                  count(*) AS n
           FROM scored GROUP BY 1) c ON b.bucket = c.bucket"""


ORACLE["cf_metrics_lines"] = f"""SELECT bucket AS pos, label || ': ' || CAST(n AS VARCHAR) AS value
FROM ({ORACLE["cf_error_histogram"]})"""


# ---------------------------------------------------------------- text

TOKENS = """tokens AS (
  SELECT doc_id, token, count(*) AS n
  FROM (SELECT doc_id, unnest(string_split(rtrim(text, ' '), ' ')) AS token FROM documents) t
  WHERE token <> '' GROUP BY doc_id, token),
m AS (SELECT count(*) AS m FROM documents),
dfs AS (SELECT token, count(*) AS df FROM tokens GROUP BY token)"""

T = _with(TOKENS)
ORACLE["doc_tokens"] = T + "SELECT doc_id, token, n FROM tokens"
ORACLE["term_idf"] = T + f"""
SELECT token, df, {round_half_up('ln((m.m + 1.0) / (df + 1.0))', 6)} AS idf FROM dfs, m"""
ORACLE["term_tfidf"] = T + f"""
SELECT t.doc_id, t.token, t.n, {round_half_up('t.n * ln((m.m + 1.0) / (d.df + 1.0))', 6)} AS tfidf
FROM tokens t JOIN dfs d ON t.token = d.token, m"""
ORACLE["term_tfidf_mindf2"] = T + f"""
SELECT t.doc_id, t.token, t.n,
  {round_half_up('CASE WHEN d.df >= 2 THEN t.n * ln((m.m + 1.0) / (d.df + 1.0)) ELSE 0.0 END', 6)} AS tfidf
FROM tokens t JOIN dfs d ON t.token = d.token, m"""

# a blank line has no token, an empty one has one empty token
ORACLE["hashed_tf"] = """
SELECT doc_id, CAST(('0x' || substr(md5(token), 1, 5)) AS INTEGER) AS bucket, count(*) AS n
FROM (SELECT doc_id, unnest(CASE WHEN text <> '' AND rtrim(text, ' ') = '' THEN []
                                 ELSE string_split(rtrim(text, ' '), ' ') END) AS token FROM documents) t
GROUP BY 1, 2"""

# ---------------------------------------------------------------- clustering

def _sqdist(a: str, b: str) -> str:
    return (f"list_reduce(list_transform(range(1, len({a}) + 1), "
            f"lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])), lambda x, y: x + y)")


POINTS = """pts AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
  FROM embeddings),
c0 AS (
  SELECT CAST(array_position([0, 1, 2, 3, 4], id) AS INTEGER) AS cluster_id, v
  FROM pts WHERE id IN (0, 1, 2, 3, 4))"""


def _assign(step: int, cents: str) -> str:
    return f"""a{step} AS MATERIALIZED (
  SELECT id, cluster_id, dist2 FROM (
    SELECT p.id, c.cluster_id, {_sqdist('p.v', 'c.v')} AS dist2,
           row_number() OVER (PARTITION BY p.id
                              ORDER BY {_sqdist('p.v', 'c.v')}, c.cluster_id) AS rn
    FROM pts p, {cents} c) s
  WHERE rn = 1)"""


def _update(step: int, assign: str, prev: str) -> str:
    return f"""c{step} AS MATERIALIZED (
  SELECT cluster_id, list(value ORDER BY dim) AS v FROM (
    SELECT a.cluster_id, u.dim, avg(u.x) AS value
    FROM {assign} a JOIN (SELECT id, unnest(v) AS x, unnest(range(len(v))) AS dim FROM pts) u
      ON a.id = u.id
    GROUP BY a.cluster_id, u.dim) s
  GROUP BY cluster_id
  UNION ALL
  SELECT cluster_id, v FROM {prev} WHERE cluster_id NOT IN (SELECT cluster_id FROM {assign}))"""


def _lloyd_sql(steps: int) -> str:
    ctes = [POINTS]
    for t in range(1, steps + 1):
        ctes.append(_assign(t, f"c{t - 1}"))
        ctes.append(_update(t, f"a{t}", f"c{t - 1}"))
    ctes.append(_assign(steps + 1, f"c{steps}").replace(f"a{steps + 1} AS", "final AS", 1))
    return _with(*ctes)


_SEED = _with(POINTS, _assign(1, "c0"), _update(1, "a1", "c0"))
ORACLE["seed_points"] = _with(POINTS) + """
SELECT CAST(array_position([0, 1, 2, 3, 4], id) AS INTEGER) AS cluster_id, id
FROM pts WHERE id IN (0, 1, 2, 3, 4)"""
ORACLE["nearest_seed_assign"] = _SEED + f"""
SELECT id, cluster_id, {round_half_up('dist2', 6)} AS dist2 FROM a1"""
ORACLE["centroid_update"] = _SEED + f"""
SELECT a.cluster_id, CAST(u.dim AS INTEGER) AS dim, {round_half_up('avg(u.x)', 6)} AS value
FROM a1 a JOIN (SELECT id, unnest(v) AS x, unnest(range(len(v))) AS dim FROM pts) u ON a.id = u.id
GROUP BY a.cluster_id, u.dim"""

_L3 = _lloyd_sql(3)
_K = "(SELECT CAST(range + 1 AS INTEGER) AS cluster_id FROM range(5))"
ORACLE["lloyd_kmeans_3iter"] = _L3 + f"""
SELECT id, cluster_id, {round_half_up('dist2', 6)} AS dist2 FROM final"""
_L20 = _lloyd_sql(20)
ORACLE["cluster_sizes"] = _L20 + f"""
SELECT k.cluster_id, coalesce(s.size, 0) AS size
FROM {_K} k LEFT JOIN (SELECT cluster_id, count(*) AS size FROM final GROUP BY 1) s
  ON k.cluster_id = s.cluster_id"""
ORACLE["cluster_errors"] = _L20 + f"""
SELECT k.cluster_id, {round_half_up('sqrt(coalesce(s.sse, 0.0))', 6)} AS error
FROM {_K} k LEFT JOIN (SELECT cluster_id, sum(dist2) AS sse FROM final GROUP BY 1) s
  ON k.cluster_id = s.cluster_id"""
ORACLE["cluster_wsse"] = _L20 + f"SELECT {round_half_up('sum(dist2)', 6)} AS wsse FROM final"
ORACLE["cluster_report"] = _L20 + f"""
SELECT k.cluster_id, coalesce(s.size, 0) AS size, {round_half_up('sqrt(coalesce(s.sse, 0.0))', 6)} AS error
FROM {_K} k LEFT JOIN (SELECT cluster_id, count(*) AS size, sum(dist2) AS sse FROM final GROUP BY 1) s
  ON k.cluster_id = s.cluster_id"""


# ------------------------------------------------ text K-means (sparse)

def _text_entries_sql(weighting: str) -> str:
    if weighting == "hashed":   # 15,000 features
        return f"""hashed AS ({ORACLE["hashed_tf"]}),
ent AS (SELECT doc_id, bucket % 15000 AS term, CAST(sum(n) AS DOUBLE) AS val FROM hashed GROUP BY 1, 2)"""
    if weighting == "tf":
        return "ent AS (SELECT doc_id, token AS term, CAST(n AS DOUBLE) AS val FROM tokens)"
    return """ent AS (SELECT t.doc_id, t.token AS term, t.n * ln((m.m + 1.0) / (d.df + 1.0)) AS val
           FROM tokens t JOIN dfs d ON t.token = d.token, m)"""


def _sparse_assign_sql(step: int, cents: str) -> str:
    return f"""a{step} AS MATERIALIZED (
  SELECT doc_id, cluster_id, greatest(raw, 0.0) AS dist2 FROM (
    SELECT d.doc_id, k.cluster_id,
           coalesce(x.xx, 0.0) + coalesce(cn.cn, 0.0) - 2 * coalesce(dt.xc, 0.0) AS raw,
           row_number() OVER (PARTITION BY d.doc_id
             ORDER BY coalesce(x.xx, 0.0) + coalesce(cn.cn, 0.0) - 2 * coalesce(dt.xc, 0.0),
                      k.cluster_id) AS rn
    FROM (SELECT doc_id FROM documents) d
    CROSS JOIN (SELECT CAST(range AS INTEGER) AS cluster_id FROM range(1, 6)) k
    LEFT JOIN xx x ON x.doc_id = d.doc_id
    LEFT JOIN (SELECT cluster_id, sum(c * c) AS cn FROM {cents} GROUP BY 1) cn
      ON cn.cluster_id = k.cluster_id
    LEFT JOIN (SELECT e.doc_id, c.cluster_id, sum(e.val * c.c) AS xc
               FROM ent e JOIN {cents} c ON e.term = c.term GROUP BY 1, 2) dt
      ON dt.doc_id = d.doc_id AND dt.cluster_id = k.cluster_id) s
  WHERE rn = 1)"""


def _sparse_update_sql(step: int, assign: str, prev: str) -> str:
    return f"""c{step} AS MATERIALIZED (
  SELECT s.cluster_id, s.term, s.s / z.size AS c
  FROM (SELECT a.cluster_id, e.term, sum(e.val) AS s
        FROM ent e JOIN {assign} a ON e.doc_id = a.doc_id GROUP BY 1, 2) s
  JOIN (SELECT cluster_id, count(*) AS size FROM {assign} GROUP BY 1) z ON s.cluster_id = z.cluster_id
  UNION ALL
  SELECT cluster_id, term, c FROM {prev} WHERE cluster_id NOT IN (SELECT cluster_id FROM {assign}))"""


def _sparse_lloyd_sql(weighting: str, steps: int) -> str:
    ctes = [TOKENS, _text_entries_sql(weighting),
            "xx AS (SELECT doc_id, sum(val * val) AS xx FROM ent GROUP BY 1)",
            """c0 AS (SELECT CAST(array_position([0, 1, 2, 3, 4], doc_id) AS INTEGER) AS cluster_id,
                  term, val AS c FROM ent WHERE doc_id IN (0, 1, 2, 3, 4))"""]
    for t in range(1, steps + 1):
        ctes.append(_sparse_assign_sql(t, f"c{t - 1}"))
        ctes.append(_sparse_update_sql(t, f"a{t}", f"c{t - 1}"))
    ctes.append(_sparse_assign_sql(steps + 1, f"c{steps}").replace(f"a{steps + 1} AS", "final AS", 1))
    return _with(*ctes)


ORACLE["text_seed_assign_tf"] = _sparse_lloyd_sql("tf", 0) + "SELECT doc_id, cluster_id, dist2 FROM final"

ORACLE["text_kmeans_hashed"] = _sparse_lloyd_sql("hashed", 20) + f"""
SELECT doc_id, cluster_id, {round_half_up('dist2', 3)} AS dist2 FROM final"""

_TK = _sparse_lloyd_sql("tfidf", 20)
ORACLE["text_kmeans_tfidf"] = _TK + f"""
SELECT doc_id, cluster_id, {round_half_up('dist2', 3)} AS dist2 FROM final"""
ORACLE["text_cluster_report"] = _TK + f""",
agg AS (SELECT cluster_id, count(*) AS size, sum(dist2) AS sse FROM final GROUP BY 1),
cnt AS (SELECT f.cluster_id, t.token AS term, sum(t.n) AS cnt
        FROM tokens t JOIN final f ON t.doc_id = f.doc_id GROUP BY 1, 2),
top AS (SELECT cluster_id, term, row_number() OVER (PARTITION BY cluster_id ORDER BY cnt DESC, term) AS rank
        FROM cnt)
SELECT k.cluster_id, coalesce(a.size, 0) AS size,
       {round_half_up('sqrt(coalesce(a.sse, 0.0))', 3)} AS error,
       (SELECT string_agg(term, ',' ORDER BY rank) FROM top WHERE top.cluster_id = k.cluster_id AND rank <= 10) AS terms
FROM (SELECT CAST(range AS INTEGER) AS cluster_id FROM range(1, 6)) k
LEFT JOIN agg a ON a.cluster_id = k.cluster_id"""

# ---------------------------------------------- bisecting K-means (sparse)

def _dist2_sql(name: str, members: str, cents: str) -> str:
    """Squared distance of each member ``(doc_id, node)`` to each center
    ``(node, side, term, c)`` of its node."""
    return f"""{name} AS MATERIALIZED (
  SELECT m.doc_id, m.node, cn.side, greatest(coalesce(x.xx, 0.0) + cn.cn - 2 * coalesce(dt.xc, 0.0), 0.0) AS d,
         coalesce(x.xx, 0.0) - 2 * coalesce(dt.xc, 0.0) + cn.cn AS raw, coalesce(x.xx, 0.0) AS xx
  FROM {members} m
  JOIN (SELECT k.node, k.side, coalesce(sum(c * c), 0.0) AS cn
        FROM {cents}_keys k LEFT JOIN {cents} c ON c.node = k.node AND c.side = k.side GROUP BY 1, 2) cn
    ON cn.node = m.node
  LEFT JOIN xx x ON x.doc_id = m.doc_id
  LEFT JOIN (SELECT e.doc_id, c.side, sum(e.val * c.c) AS xc
             FROM ent e JOIN {members} m ON m.doc_id = e.doc_id
             JOIN {cents} c ON c.node = m.node AND c.term = e.term GROUP BY 1, 2) dt
    ON dt.doc_id = m.doc_id AND dt.side = cn.side)"""


def _seed_centers_sql(name: str, seeds: str) -> list[str]:
    """Centers from ``seeds`` (``node, side, doc_id``)."""
    return [f"{name}_keys AS (SELECT node, side FROM {seeds})",
            f"{name} AS MATERIALIZED (SELECT s.node, s.side, e.term, e.val AS c "
            f"FROM {seeds} s JOIN ent e ON e.doc_id = s.doc_id)"]


def _mean_centers_sql(name: str, members: str) -> list[str]:
    """Means of ``members`` (``doc_id, node, side``)."""
    return [f"{name}_keys AS (SELECT DISTINCT node, side FROM {members})",
            f"""{name} AS MATERIALIZED (
  SELECT s.node, s.side, s.term, s.s / z.size AS c
  FROM (SELECT m.node, m.side, e.term, sum(e.val) AS s
        FROM ent e JOIN {members} m ON m.doc_id = e.doc_id GROUP BY 1, 2, 3) s
  JOIN (SELECT node, side, count(*) AS size FROM {members} GROUP BY 1, 2) z
    ON z.node = s.node AND z.side = s.side)"""]


def _bisecting_sql(k: int, steps: int) -> str:
    ctes = [TOKENS, _text_entries_sql("tfidf"), "xx AS (SELECT doc_id, sum(val * val) AS xx FROM ent GROUP BY 1)",
            "n0 AS MATERIALIZED (SELECT doc_id, CAST(1 AS BIGINT) AS node FROM documents)"]
    for v in range(k - 1):       # a level splits one leaf at least, or nothing any more
        ctes.append(f"f{v} AS MATERIALIZED (SELECT node, 0 AS side, min(doc_id) AS doc_id, count(*) AS size "
                    f"FROM n{v} GROUP BY node)")
        ctes += _seed_centers_sql(f"p{v}", f"f{v}")
        ctes.append(_dist2_sql(f"q{v}", f"n{v}", f"p{v}"))
        ctes.append(f"""r{v} AS MATERIALIZED (
  SELECT node, first, far FROM (
    SELECT f.node, f.doc_id AS first, q.doc_id AS far, row_number() OVER (ORDER BY f.size DESC, f.node) AS place
    FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY d DESC, doc_id) AS rn FROM q{v}) q
    JOIN f{v} f ON f.node = q.node JOIN q{v} own ON own.doc_id = f.doc_id
    WHERE q.rn = 1 AND q.d > 1e-9 * (q.xx + own.xx)) s
  WHERE place <= {k} - (SELECT count(*) FROM f{v}))""")
        ctes.append(f"m{v} AS MATERIALIZED (SELECT n.doc_id, n.node FROM n{v} n JOIN r{v} r ON r.node = n.node)")
        ctes.append(f"g{v} AS (SELECT node, 0 AS side, first AS doc_id FROM r{v} "
                    f"UNION ALL SELECT node, 1, far FROM r{v})")
        ctes += _seed_centers_sql(f"c{v}_0", f"g{v}")
        for t in range(steps):
            if t:
                ctes += _mean_centers_sql(f"c{v}_{t}", f"a{v}_{t - 1}")
            ctes.append(_dist2_sql(f"d{v}_{t}", f"m{v}", f"c{v}_{t}"))
            ctes.append(f"""a{v}_{t} AS MATERIALIZED (
  SELECT l.doc_id, l.node, CASE WHEN r.raw < l.raw THEN 1 ELSE 0 END AS side
  FROM d{v}_{t} l JOIN d{v}_{t} r ON r.doc_id = l.doc_id WHERE l.side = 0 AND r.side = 1)""")
        ctes.append(f"""n{v + 1} AS MATERIALIZED (
  SELECT n.doc_id, coalesce(2 * n.node + a.side, n.node) AS node
  FROM n{v} n LEFT JOIN a{v}_{steps - 1} a ON a.doc_id = n.doc_id)""")
    ctes.append(f"z AS MATERIALIZED (SELECT doc_id, node, 0 AS side FROM n{k - 1})")
    ctes += _mean_centers_sql("zc", "z")
    ctes.append(_dist2_sql("zd", "z", "zc"))
    # leaves from left to right: node numbers brought to the length of the longest possible one
    ctes.append(f"""leaf AS (SELECT node, CAST(row_number() OVER (
  ORDER BY node * (1 << ({k} - length(bin(node))))) AS INTEGER) AS cluster_id FROM (SELECT DISTINCT node FROM z) s)""")
    return _with(*ctes)


ORACLE["text_bisecting_tfidf"] = _bisecting_sql(5, 10) + f"""
SELECT zd.doc_id, zd.node, leaf.cluster_id, {round_half_up('zd.d', 3)} AS dist2
FROM zd JOIN leaf ON leaf.node = zd.node"""

_SEED_TERMS = _sparse_lloyd_sql("tf", 0) + """,
counts AS (SELECT f.cluster_id, t.token AS term, sum(t.n) AS cnt
           FROM tokens t JOIN final f ON t.doc_id = f.doc_id GROUP BY 1, 2)
"""
ORACLE["cluster_top_terms"] = _SEED_TERMS + """
SELECT cluster_id, CAST(rank AS INTEGER) AS rank, term, CAST(cnt AS BIGINT) AS cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY cnt DESC, term) AS rank FROM counts)
WHERE rank <= 10"""
ORACLE["cluster_rare_terms"] = _SEED_TERMS + """
SELECT cluster_id, CAST(rank AS INTEGER) AS rank, term, CAST(cnt AS BIGINT) AS cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY cnt ASC, term) AS rank FROM counts)
WHERE rank <= 10"""


# ---------------------------------------------- parallel seeding (sparse)

def _draw_sql(turn: str, col: str) -> str:
    key = f"'42:' || {turn} || ':' || CAST({col} AS VARCHAR)"
    return f"((CAST('0x' || substr(md5({key}), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)"


def _units_sql(name: str, left: str, right: str) -> str:
    """Squared distances in units of every document of ``left`` to every one of ``right``."""
    return f"""{name} AS MATERIALIZED (
  SELECT l.doc_id AS a, r.doc_id AS b,
         CAST(floor(greatest(lx.xx + rx.xx - 2 * coalesce(dt.x, 0.0), 0.0) / (SELECT u FROM unit) + 0.5) AS BIGINT) AS q
  FROM {left} l CROSS JOIN {right} r
  JOIN norms lx ON lx.doc_id = l.doc_id JOIN norms rx ON rx.doc_id = r.doc_id
  LEFT JOIN (SELECT e.doc_id AS a, f.doc_id AS b, sum(e.val * f.val) AS x
             FROM ent e JOIN ent f ON f.term = e.term
             WHERE e.doc_id IN (SELECT doc_id FROM {left}) AND f.doc_id IN (SELECT doc_id FROM {right}) GROUP BY 1, 2) dt
    ON dt.a = l.doc_id AND dt.b = r.doc_id)"""


def _seeded_sql(k: int, rounds: int, factor: int) -> str:
    ctes = [TOKENS, _text_entries_sql("tfidf"),
            "norms AS MATERIALIZED (SELECT d.doc_id, coalesce(sum(val * val), 0.0) AS xx "
            "FROM documents d LEFT JOIN ent e ON e.doc_id = d.doc_id GROUP BY 1)",
            "unit AS (SELECT pow(2.0, ceil(log2(max(xx))) - 36) AS u FROM norms)",
            f"c0 AS MATERIALIZED (SELECT doc_id FROM documents ORDER BY {_draw_sql(chr(39) + '0' + chr(39), 'doc_id')}, doc_id LIMIT 1)"]
    for t in range(rounds + 1):
        ctes.append(_units_sql(f"q{t}", "documents", f"c{t}"))
        # distance, round and id of the nearest candidate
        ctes.append(f"s{t} AS MATERIALIZED (SELECT a AS doc_id, min([q, {t}, b]) AS n FROM q{t} GROUP BY 1)" if t == 0 else
                    f"""s{t} AS MATERIALIZED (SELECT doc_id, min(n) AS n FROM (
  SELECT * FROM s{t - 1} UNION ALL SELECT a, min([q, {t}, b]) FROM q{t} GROUP BY 1) z GROUP BY 1)""")
        if t < rounds:
            ctes.append(f"""c{t + 1} AS MATERIALIZED (SELECT doc_id FROM s{t}
  WHERE {_draw_sql(f"'{t + 1}'", 'doc_id')} * (SELECT CAST(sum(n[1]) AS DOUBLE) FROM s{t}) < {factor * k}.0 * n[1])""")
    ctes.append(f"w AS MATERIALIZED (SELECT n[3] AS doc_id, n[2] AS turn, count(*) AS w FROM s{rounds} GROUP BY 1, 2)")
    ctes.append(_units_sql("pq", "w", "w"))
    for j in range(1, k + 1):
        rate = "w.w" if j == 1 else "w.w * f.q"
        far = "" if j == 1 else (f"JOIN (SELECT a, min(q) AS q FROM pq WHERE b IN ("
                                 + " UNION ALL ".join(f"SELECT doc_id FROM h{i}" for i in range(1, j))
                                 + ") GROUP BY a) f ON f.a = w.doc_id AND f.q > 0")
        draw = _draw_sql(f"'-{j}'", "w.doc_id")
        ctes.append(f"h{j} AS MATERIALIZED (SELECT w.doc_id FROM w {far} "
                    f"ORDER BY -ln({draw}) / ({rate}), w.turn, w.doc_id LIMIT 1)")
    ctes.append("seeds AS MATERIALIZED (" + " UNION ALL ".join(
        f"SELECT doc_id, {j} AS cluster_id FROM h{j}" for j in range(1, k + 1)) + ")")
    ctes.append("""near AS (
  SELECT d.doc_id, s.cluster_id, s.doc_id AS seed_id,
         greatest(dx.xx + sx.xx - 2 * coalesce(dt.x, 0.0), 0.0) AS d, dx.xx + sx.xx - 2 * coalesce(dt.x, 0.0) AS raw
  FROM documents d CROSS JOIN seeds s
  JOIN norms dx ON dx.doc_id = d.doc_id JOIN norms sx ON sx.doc_id = s.doc_id
  LEFT JOIN (SELECT e.doc_id AS a, f.doc_id AS b, sum(e.val * f.val) AS x
             FROM ent e JOIN ent f ON f.term = e.term WHERE f.doc_id IN (SELECT doc_id FROM seeds) GROUP BY 1, 2) dt
    ON dt.a = d.doc_id AND dt.b = s.doc_id)""")
    return _with(*ctes)


ORACLE["text_seeded_tfidf"] = _seeded_sql(5, 3, 2) + f"""
SELECT doc_id, cluster_id, seed_id, {round_half_up("d", 3)} AS dist2
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY raw, cluster_id) AS rn FROM near) z WHERE rn = 1
"""
