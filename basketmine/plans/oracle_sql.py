"""DuckDB SQL for the registered queries: the differential oracle.

The SQL recomputes every result by brute force from the pre-registered views
(``part orders lineitem ...``): nearest seeds by a cross join of baskets with
the k seeds, frequent itemsets by recursion over their sizes until no larger
set is frequent.  Column names and types mirror the Spark queries.
"""

from __future__ import annotations

from basketmine.plans.queries import (CLUSTER_SUPPORT, DIGITS, GLOBAL_SUPPORT, ITERATIONS, K, K_NEXT, MANY,
                                      MIN_CONFIDENCE, N_CUSTOMERS, RATIO_DIGITS, SEED, SELECT_HI, SELECT_LO,
                                      STOP_LO)

NAN = "CAST('nan' AS DOUBLE)"

BASE = f"""
cat AS (
  SELECT product, CAST(level AS INTEGER) AS level, trim(raw) AS category FROM (
    SELECT product, unnest(generate_series(1, len(parts))) AS level, unnest(parts) AS raw
    FROM (SELECT p_partkey AS product,
                 string_split(regexp_replace(concat_ws('/', p_type, p_brand), '[/\\s]+$', ''), '/') AS parts FROM part)
    WHERE parts <> [''])),
pc AS (SELECT DISTINCT product, category FROM cat),
all_items AS (
  SELECT o.o_orderkey AS basket_id, o.o_custkey AS customer_id, o.o_orderstatus AS status,
         l.l_partkey AS item
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey),
enc_all AS (
  SELECT b.basket_id, b.customer_id, any_value(b.status) AS status,
         list_sort(list_distinct(list(pc.category))) AS items
  FROM all_items b LEFT JOIN pc ON pc.product = b.item
  GROUP BY b.basket_id, b.customer_id),
enc AS (SELECT basket_id, customer_id, items FROM enc_all),
trn AS (SELECT basket_id, customer_id, items FROM enc_all WHERE status IS DISTINCT FROM 'O'),
inc AS (SELECT basket_id, customer_id, items FROM enc_all WHERE status = 'O')"""


def dontcare(ones: str, support: str, b: str) -> str:
    m11 = f"len(list_intersect({ones}, {b}))"
    m10 = f"(len({ones}) - {m11})"
    m01 = f"(len({b}) - len(list_intersect({support}, {b})))"
    num, den = f"({m01} + {m10})", f"({m11} + {m01} + {m10})"
    return f"(CASE WHEN {den} = 0 THEN {NAN} ELSE CAST(CAST({num} AS DOUBLE) / {den} AS FLOAT)::DOUBLE END)"


def jaccard(a: str, b: str) -> str:
    return dontcare(a, a, b)


def near_cte(name: str, src: str, seeds: str) -> str:
    d = jaccard("s.items", "e.items")
    return f"""
{name} AS (
  SELECT basket_id, cid AS nearest, d FROM (
    SELECT e.basket_id, s.cid, {d} AS d,
           row_number() OVER (PARTITION BY e.basket_id ORDER BY {d}, s.cid) AS rn
    FROM {src} e CROSS JOIN {seeds} s) WHERE rn = 1)"""


def model_ctes(p: str, k: int, iterations: int = ITERATIONS, seed: int = SEED, src: str = "enc") -> str:
    """The model of the baskets ``src``: CTEs ``{p}_seeds, {p}_near, {p}_flag, {p}_links, {p}_assign, {p}_cent``."""
    w = (f"(CAST((CASE WHEN sc.cid IS NULL THEN 0 ELSE 1 END) + coalesce(s0.s, 0) AS DOUBLE)"
         f" / CAST(coalesce(n0.n, 0) + 1 AS DOUBLE))")
    for _ in range(2, iterations + 1):
        w = f"(({w} + CAST(coalesce(s1.s, 0) AS DOUBLE)) / CAST(coalesce(n1.n, 0) + 1 AS DOUBLE))"
    final = "coalesce(l.cluster_id, f.nearest)" if iterations >= 1 else "coalesce(l.anchor, f.nearest)"
    return f""",
{p}_seeds AS (
  SELECT basket_id, items, CAST(rn - 1 AS INTEGER) AS cid FROM (
    SELECT basket_id, items,
           row_number() OVER (ORDER BY md5('{seed}:' || CAST(basket_id AS VARCHAR)), basket_id) AS rn
    FROM {src}) WHERE rn <= {k}),{near_cte(f"{p}_near", src, f"{p}_seeds")},
{p}_flag AS (
  SELECT e.basket_id, e.customer_id, e.items, s.cid AS seed_cluster, s.cid IS NOT NULL AS is_seed, n.nearest
  FROM {src} e LEFT JOIN {p}_seeds s ON s.basket_id = e.basket_id JOIN {p}_near n ON n.basket_id = e.basket_id),
{p}_links AS (
  SELECT customer_id, anchor, least(anchor, seed_min) AS cluster_id FROM (
    SELECT customer_id, arg_min(nearest, basket_id) FILTER (WHERE NOT is_seed) AS anchor,
           min(seed_cluster) AS seed_min
    FROM {p}_flag WHERE customer_id IS NOT NULL GROUP BY customer_id)),
{p}_assign AS (
  SELECT f.basket_id, f.customer_id, f.items, f.is_seed, f.seed_cluster, f.nearest,
         CASE WHEN f.is_seed THEN f.seed_cluster ELSE coalesce(l.anchor, f.nearest) END AS label_0,
         CASE WHEN f.is_seed THEN f.seed_cluster ELSE {final} END AS cluster_id
  FROM {p}_flag f LEFT JOIN {p}_links l ON l.customer_id = f.customer_id),
{p}_s0 AS (SELECT cid, category, count(*) AS s FROM (
  SELECT label_0 AS cid, unnest(items) AS category FROM {p}_assign WHERE NOT is_seed) GROUP BY ALL),
{p}_n0 AS (SELECT label_0 AS cid, count(*) AS n FROM {p}_assign WHERE NOT is_seed GROUP BY ALL),
{p}_s1 AS (SELECT cid, category, count(*) AS s FROM (
  SELECT cluster_id AS cid, unnest(items) AS category FROM {p}_assign WHERE NOT is_seed) GROUP BY ALL),
{p}_n1 AS (SELECT cluster_id AS cid, count(*) AS n FROM {p}_assign WHERE NOT is_seed GROUP BY ALL),
{p}_sc AS (SELECT cid, unnest(items) AS category FROM {p}_seeds),
{p}_allc AS (SELECT cid, category FROM {p}_sc UNION SELECT cid, category FROM {p}_s0
             UNION SELECT cid, category FROM {p}_s1),
{p}_cent AS (
  SELECT * FROM (
    SELECT a.cid AS cluster_id, a.category, {w if iterations >= 1 else "1.0"} AS weight
    FROM {p}_allc a
    LEFT JOIN {p}_sc sc ON sc.cid = a.cid AND sc.category = a.category
    LEFT JOIN {p}_s0 s0 ON s0.cid = a.cid AND s0.category = a.category
    LEFT JOIN {p}_s1 s1 ON s1.cid = a.cid AND s1.category = a.category
    LEFT JOIN {p}_n0 n0 ON n0.cid = a.cid
    LEFT JOIN {p}_n1 n1 ON n1.cid = a.cid
    {"" if iterations >= 1 else "WHERE sc.cid IS NOT NULL"})
  WHERE weight <> 0)"""


def predict_cte(p: str, name: str, src: str) -> str:
    """Known customer -> link, else nearest seed."""
    return f""",{near_cte(f"{name}_near", src, f"{p}_seeds")},
{name} AS (
  SELECT i.basket_id, i.customer_id, l.cluster_id IS NOT NULL AS known_customer,
         coalesce(l.cluster_id, n.nearest) AS cluster_id
  FROM {src} i JOIN {name}_near n ON n.basket_id = i.basket_id
  LEFT JOIN {p}_links l ON l.customer_id = i.customer_id)"""


def mining_ctes(p: str, tx: str, support: float, confidence: float) -> str:
    """``{p}_sets(grp, items, size, freq)`` and ``{p}_rules(grp, antecedent,
    consequent, confidence, lift, support)`` from ``tx(grp, tid, items)``.

    ``{p}_in`` holds each frequent set (a sorted list) with each transaction that
    contains it; a step appends a later frequent item of the transaction and
    keeps the sets that reach the minimum count."""
    conf = "(CAST(c.freq AS DOUBLE) / a.freq)"
    text = "array_to_string({0}, ',')"
    return f""",
{p}_ntx AS (SELECT grp, count(*) AS n, ceil(CAST({support} AS DOUBLE) * count(*)) AS minc FROM {tx} GROUP BY grp),
{p}_t1 AS (
  SELECT x.grp, x.tid, x.item, t.minc FROM (SELECT grp, tid, unnest(items) AS item FROM {tx}) x JOIN {p}_ntx t ON t.grp = x.grp
  QUALIFY count(*) OVER (PARTITION BY x.grp, x.item) >= t.minc),
{p}_in AS (
  SELECT grp, tid, [item] AS items, item AS last, minc FROM {p}_t1
  UNION ALL
  SELECT grp, tid, items, last, minc FROM (
    SELECT s.grp, s.tid, list_append(s.items, t.item) AS items, t.item AS last, s.minc
    FROM {p}_in s JOIN {p}_t1 t ON t.grp = s.grp AND t.tid = s.tid AND t.item > s.last)
  QUALIFY count(*) OVER (PARTITION BY grp, items) >= minc),
{p}_list AS (SELECT grp, items, count(*) AS freq FROM {p}_in GROUP BY grp, items),
{p}_sets AS (SELECT grp, {text.format("items")} AS items, len(items) AS size, freq FROM {p}_list),
{p}_cand AS (
  SELECT grp, {text.format("list_filter(items, lambda x: x <> cons)")} AS ante, cons, freq
  FROM (SELECT grp, items, freq, unnest(items) AS cons FROM {p}_list WHERE len(items) >= 2)),
{p}_rules AS (
  SELECT c.grp, c.ante AS antecedent, c.cons AS consequent, {conf} AS confidence,
         {conf} / (CAST(s.freq AS DOUBLE) / t.n) AS lift, CAST(c.freq AS DOUBLE) / t.n AS support
  FROM {p}_cand c JOIN {p}_sets a ON a.grp = c.grp AND a.items = c.ante
  JOIN {p}_sets s ON s.grp = c.grp AND s.items = c.cons
  JOIN {p}_ntx t ON t.grp = c.grp
  WHERE {conf} >= {confidence})"""


def pairs(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) * (CAST({x} AS DOUBLE) - 1.0) / 2.0)"


def ari_select(cont: str, compat: bool) -> str:
    """One-row ARI over a contingency table ``cont(la, lb, n)``."""
    cell_filter = "WHERE la = 0" if compat else ""
    return f"""
SELECT n, idx AS "index", sa AS sum_a, sb AS sum_b, round(expected, {RATIO_DIGITS}) AS expected, max_index,
       round(CASE WHEN (max_index - expected) = 0 OR isnan(max_index - expected) THEN {NAN}
                  ELSE (idx - expected) / (max_index - expected) END, {RATIO_DIGITS}) AS ari
FROM (
  SELECT n, idx, sa, sb, CASE WHEN {pairs("n")} = 0 THEN {NAN} ELSE sa * sb / {pairs("n")} END AS expected,
         0.5 * (sa + sb) AS max_index
  FROM (
    SELECT (SELECT CAST(sum(n) AS BIGINT) FROM {cont}) AS n,
           (SELECT coalesce(sum({pairs("n")}), 0.0) FROM {cont} {cell_filter}) AS idx,
           (SELECT sum({pairs("m")}) FROM (SELECT sum(n) AS m FROM {cont} GROUP BY la)) AS sa,
           (SELECT sum({pairs("m")}) FROM (SELECT sum(n) AS m FROM {cont} GROUP BY lb)) AS sb))"""


def two_models(ka: int = K, kb: int = K_NEXT) -> str:
    return (model_ctes("ma", ka) + predict_cte("ma", "pa", "enc") + model_ctes("mb", kb) + predict_cte("mb", "pb", "enc")
            + """,
lab AS (SELECT a.basket_id, a.cluster_id AS la, b.cluster_id AS lb FROM pa a JOIN pb b ON a.basket_id = b.basket_id),
cont AS (SELECT la, lb, count(*) AS n FROM lab GROUP BY ALL)""")


def walk(lo: int, hi: int) -> list[str]:
    """CTEs of the k walk over [lo, hi): ``trials``, ``st2`` (with the stop flag) and ``fs`` (the first stop)."""
    ks = list(range(lo, hi + 1))
    sel = [BASE] + [model_ctes(f"k{k}", k) + predict_cte(f"k{k}", f"p{k}", "enc") for k in ks]
    trials = []
    for k in ks[:-1]:
        sel.append(f""",
cont{k} AS (SELECT a.cluster_id AS la, b.cluster_id AS lb, count(*) AS n
            FROM p{k} a JOIN p{k + 1} b ON a.basket_id = b.basket_id GROUP BY ALL),
ari{k} AS (SELECT ari FROM ({ari_select(f"cont{k}", False)}))""")
        trials.append(f"SELECT {k} AS k, {k + 1} AS k_next, ari FROM ari{k}")
    sel.append(f""",
trials AS ({" UNION ALL ".join(trials)}),
st AS (SELECT k, k_next, ari, lag(ari, 1, 0.0) OVER (ORDER BY k) AS prev FROM trials),
st2 AS (SELECT *, (NOT isnan(ari) AND NOT isnan(prev) AND ari >= 0 AND ari < prev) AS stop FROM st),
fs AS (SELECT min(k) FILTER (WHERE stop) AS first_stop FROM st2)""")
    return sel


def with_(*parts: str) -> str:
    return "WITH RECURSIVE " + "".join(parts)


def _sql() -> dict[str, str]:
    m = model_ctes("m", K)
    split = model_ctes("m", K, src="trn")     # the model of the queries that score the open orders
    q: dict[str, str] = {}
    q["catalog_levels"] = with_(BASE) + "\nSELECT product, level, category FROM cat"
    q["category_summary"] = with_(BASE) + """
SELECT category, count(*) AS n_products, min(product) AS first_product, max(product) AS last_product
FROM pc GROUP BY category"""
    q["basket_items"] = """
SELECT o.o_orderkey AS basket_id, o.o_custkey AS customer_id, l.l_partkey AS item
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey"""
    q["basket_scan"] = """
SELECT o.o_orderkey AS basket_id, CAST(l.l_partkey AS VARCHAR) AS item
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey"""
    q["catalog_scan"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product, concat_ws('/', p_type, p_brand) AS path FROM part"""
    q["incoming_scan"] = """
SELECT o.o_orderkey AS basket_id, o.o_custkey AS customer_id, CAST(l.l_partkey AS VARCHAR) AS item
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'O'"""
    q["dense_index"] = """
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id,
       '(' || CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) || ')' AS line FROM orders"""
    q["unique_ids"] = """
SELECT o_custkey AS customer_id, count(*) AS n_rows, count(*) AS n_ids FROM orders GROUP BY o_custkey"""
    q["match_exact"] = with_(BASE) + """
SELECT b.basket_id, b.item, pc.category FROM all_items b JOIN pc ON pc.product = b.item"""
    q["match_substring"] = with_(BASE) + """,
lists AS (SELECT category, 'CompactBuffer(' || string_agg(p, ', ' ORDER BY p) || ')' AS txt
          FROM (SELECT category, CAST(product AS VARCHAR) AS p FROM pc) GROUP BY category),
items AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS item FROM lineitem)
SELECT DISTINCT i.item, l.category FROM items i JOIN lists l ON contains(l.txt, i.item)"""
    q["basket_encode"] = with_(BASE) + """
SELECT basket_id, customer_id, CAST(len(items) AS INTEGER) AS n_items, array_to_string(items, ',') AS categories
FROM enc_all"""
    q["basket_vectors"] = with_(BASE) + """,
vocab AS (SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS idx
          FROM (SELECT DISTINCT category FROM cat)),
ex AS (SELECT basket_id, unnest(items) AS category FROM enc_all)
SELECT e.basket_id, CAST((SELECT count(*) FROM vocab) AS INTEGER) AS vec_size,
       coalesce(string_agg(CAST(v.idx AS VARCHAR), ',' ORDER BY v.idx), '') AS vec_indices,
       coalesce(string_agg(v.category, ',' ORDER BY v.idx), '') AS decoded
FROM enc_all e LEFT JOIN ex ON ex.basket_id = e.basket_id LEFT JOIN vocab v ON v.category = ex.category
GROUP BY e.basket_id"""
    q["basket_words"] = with_(BASE) + """,
vocab AS (SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT category FROM cat))
SELECT DISTINCT l.l_orderkey AS basket_id, v.idx, v.category
FROM lineitem l JOIN pc ON pc.product = l.l_partkey JOIN vocab v ON v.category = pc.category"""
    q["seed_rows"] = with_(BASE, m) + "\nSELECT basket_id, cid AS cluster_id FROM m_seeds"
    q["seed_distances"] = with_(BASE, m) + f"""
SELECT cluster_id, count(*) AS n, CAST(sum(CASE WHEN isnan(d) THEN 1 ELSE 0 END) AS BIGINT) AS n_nan,
       round(sum(CASE WHEN NOT isnan(d) THEN d END), {DIGITS}) AS distance
FROM (SELECT s.cid AS cluster_id, {jaccard("s.items", "e.items")} AS d FROM enc e CROSS JOIN m_seeds s) GROUP BY cluster_id"""
    q["nearest_seed"] = with_(BASE, m) + "\nSELECT basket_id, nearest AS cluster_id, d AS distance FROM m_near"
    q["nearest_many"] = f"""
WITH sets AS (SELECT o.o_orderkey AS basket_id, list_sort(list_distinct(list(l.l_partkey))) AS items
              FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey),
seeds AS (SELECT CAST(rn - 1 AS INTEGER) AS cid, items FROM (
  SELECT items, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(basket_id AS VARCHAR)), basket_id) AS rn FROM sets) WHERE rn <= {MANY}),
common AS (SELECT e.basket_id, s.cid, count(*) AS m FROM (SELECT basket_id, unnest(items) AS v FROM sets) e
           JOIN (SELECT cid, unnest(items) AS v FROM seeds) s ON s.v = e.v GROUP BY ALL),
each AS (SELECT e.basket_id, s.cid, coalesce(c.m, 0) AS m, len(e.items) AS b, len(s.items) AS c
         FROM sets e CROSS JOIN seeds s LEFT JOIN common c ON c.basket_id = e.basket_id AND c.cid = s.cid),
away AS (SELECT basket_id, cid, CASE WHEN b + c = 0 THEN {NAN} ELSE CAST(CAST(b + c - 2 * m AS DOUBLE) / (b + c - m) AS FLOAT)::DOUBLE END AS d FROM each)
SELECT basket_id, cid AS cluster_id, d AS distance FROM away QUALIFY row_number() OVER (PARTITION BY basket_id ORDER BY d, cid) = 1"""
    q["must_link"] = with_(BASE, m) + "\nSELECT customer_id, anchor, cluster_id FROM m_links"
    q["ckmeans_assign"] = with_(BASE, m) + """
SELECT basket_id, customer_id, is_seed, coalesce(seed_cluster, -1) AS seed_cluster, label_0, cluster_id
FROM m_assign"""
    q["cluster_summary"] = with_(BASE, m) + """,
fin AS (SELECT cluster_id, count(*) AS n_baskets, count(DISTINCT customer_id) AS n_customers
        FROM m_assign GROUP BY cluster_id),
ini AS (SELECT label_0 AS cluster_id, count(DISTINCT customer_id) AS n_listed_customers
        FROM m_assign WHERE customer_id IS NOT NULL GROUP BY label_0)
SELECT coalesce(fin.cluster_id, ini.cluster_id) AS cluster_id, coalesce(n_baskets, 0) AS n_baskets,
       coalesce(n_customers, 0) AS n_customers, coalesce(n_listed_customers, 0) AS n_listed_customers
FROM fin FULL JOIN ini ON fin.cluster_id = ini.cluster_id"""
    q["ckmeans_centroids"] = with_(BASE, m) + f"""
SELECT cluster_id, category, round(weight, {DIGITS}) AS weight FROM m_cent"""
    q["centroid_summarizer"] = with_(BASE, m) + """
SELECT cluster_id, count(*) AS n_cells, CAST(0 AS BIGINT) AS n_differing FROM m_cent GROUP BY cluster_id"""
    q["kmeans_step"] = f"SELECT CAST({K} AS BIGINT) AS n_clusters, CAST(0 AS BIGINT) AS n_off, false AS cost_is_off"
    q["centroid_distances"] = with_(BASE, m) + f""",
cc AS (SELECT cluster_id AS cid, list(category) FILTER (WHERE weight = 1.0) AS ones, list(category) AS support
       FROM m_cent GROUP BY cluster_id),
cen AS (SELECT s.cid, coalesce(cc.ones, []::VARCHAR[]) AS ones, coalesce(cc.support, []::VARCHAR[]) AS support
        FROM m_seeds s LEFT JOIN cc ON cc.cid = s.cid)
SELECT cluster_id, count(*) AS n, CAST(sum(CASE WHEN isnan(d) THEN 1 ELSE 0 END) AS BIGINT) AS n_nan,
       round(sum(CASE WHEN NOT isnan(d) THEN d END), {DIGITS}) AS distance
FROM (SELECT c.cid AS cluster_id, {dontcare("c.ones", "c.support", "e.items")} AS d FROM enc e CROSS JOIN cen c)
GROUP BY cluster_id"""
    q["reference_shaped"] = with_(BASE, m) + """,
vocab AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS idx FROM (SELECT DISTINCT category FROM cat)),
cells AS (
  SELECT basket_id, category, 1.0::DOUBLE AS weight FROM (SELECT basket_id, unnest(items) AS category FROM m_assign WHERE NOT is_seed)
  UNION ALL SELECT a.basket_id, c.category, c.weight FROM m_assign a JOIN m_cent c ON c.cluster_id = a.seed_cluster WHERE a.is_seed),
texts AS (SELECT basket_id, string_agg(v.idx || ':' || CAST(round(weight * 1000000) AS BIGINT), ' ' ORDER BY v.idx) AS weights
          FROM cells JOIN vocab v USING (category) GROUP BY basket_id)
SELECT a.basket_id, a.is_seed, coalesce(a.seed_cluster, -1) AS seed_cluster, a.cluster_id, coalesce(t.weights, '') AS weights
FROM m_assign a LEFT JOIN texts t ON t.basket_id = a.basket_id"""
    q["ckmeans_predict"] = with_(BASE, split, predict_cte("m", "pred", "inc")) + """
SELECT basket_id, customer_id, known_customer, cluster_id FROM pred"""
    q["cluster_members"] = with_(BASE, split, predict_cte("m", "pred", "inc")) + """
SELECT basket_id, cluster_id FROM m_assign
WHERE NOT is_seed AND cluster_id IN (SELECT cluster_id FROM pred)"""
    q["labelings_join"] = """
SELECT CAST(o_custkey % 5 AS INTEGER) AS label_a, CAST(year(o_orderdate) AS INTEGER) AS label_b, count(*) AS n
FROM orders GROUP BY ALL"""
    q["contingency"] = with_(BASE, two_models()) + "\nSELECT la AS label_a, lb AS label_b, n FROM cont"
    q["label_marginals"] = with_(BASE, two_models()) + """
SELECT 'a' AS side, la AS label, CAST(sum(n) AS BIGINT) AS n FROM cont GROUP BY la
UNION ALL SELECT 'b', lb, CAST(sum(n) AS BIGINT) FROM cont GROUP BY lb"""
    q["ari"] = with_(BASE, two_models()) + ari_select("cont", False)
    q["ari_compat"] = with_(BASE, two_models()) + ari_select("cont", True)

    walked = f"""
SELECT CAST(k AS INTEGER) AS k, CAST(k_next AS INTEGER) AS k_next, round(ari, {RATIO_DIGITS}) AS ari,
       CAST(coalesce(fs.first_stop, (SELECT max(k_next) FROM trials)) AS INTEGER) AS best_k
FROM st2, fs WHERE fs.first_stop IS NULL OR k <= fs.first_stop"""
    q["selection_trials"] = with_(*walk(SELECT_LO, SELECT_HI)) + walked
    q["selection_stop"] = with_(*walk(STOP_LO, SELECT_HI)) + walked
    q["append_log"] = with_(*walk(SELECT_LO, SELECT_HI)) + f"""
SELECT CAST(k AS INTEGER) AS k, CAST(k_next AS INTEGER) AS k_next, round(ari, {RATIO_DIGITS}) AS ari
FROM st2, fs WHERE fs.first_stop IS NULL OR k <= fs.first_stop"""

    place = "row_number() OVER (ORDER BY basket_id) - 1 AS line_no"
    q["kv_export"] = with_(BASE, m) + f"""
SELECT {place}, '(' || CAST(basket_id AS VARCHAR) || ',' || CAST(cluster_id AS VARCHAR) || ')' AS line FROM m_assign"""
    q["sorted_export"] = with_(BASE, m) + f"""
SELECT {place}, '(' || CAST(basket_id AS VARCHAR) || ',(' || CAST(customer_id AS VARCHAR) || ','
       || CAST(cluster_id AS VARCHAR) || '))' AS line
FROM m_assign"""

    per = N_CUSTOMERS // K
    q["surrogate_ids"] = with_(BASE, m) + f"""
SELECT basket_id, cluster_id,
       CAST(cluster_id AS BIGINT) * {per} + 1
       + (CAST('0x' || substr(md5('{SEED}:' || CAST(basket_id AS VARCHAR)), 1, 15) AS BIGINT) % {per})
       AS surrogate_id
FROM m_assign"""

    place_in_range = f"CAST('0x' || substr(md5('{SEED}:' || CAST(basket_id AS VARCHAR)), 1, 15) AS BIGINT) % {per}"
    q["kmeans_labels"] = "SELECT o_orderkey AS basket_id, true AS is_cluster, CAST(0 AS INTEGER) AS n_nearer FROM orders"
    q["kmeans_surrogate_ids"] = f"""
SELECT basket_id, {place_in_range} AS place, true AS in_range FROM (SELECT o_orderkey AS basket_id FROM orders)"""
    q["kmeans_selection"] = """
SELECT CAST(o_orderkey % 3 AS INTEGER) AS fixed, count(*) AS n, true AS in_range, true AS by_rule FROM orders GROUP BY ALL"""

    q["freq_itemsets"] = with_(BASE, """,
tx AS (SELECT 0 AS grp, basket_id AS tid, items FROM enc)""", mining_ctes("g", "tx", GLOBAL_SUPPORT, MIN_CONFIDENCE)) + """
SELECT items, CAST(size AS INTEGER) AS size, freq FROM g_sets"""
    q["assoc_rules"] = with_(BASE, """,
tx AS (SELECT 0 AS grp, basket_id AS tid, items FROM enc)""", mining_ctes("g", "tx", GLOBAL_SUPPORT, MIN_CONFIDENCE)) + f"""
SELECT antecedent, consequent, round(confidence, {RATIO_DIGITS}) AS confidence, round(lift, {RATIO_DIGITS}) AS lift,
       round(support, {RATIO_DIGITS}) AS support FROM g_rules"""
    q["promote"] = with_(BASE, split, predict_cte("m", "pred", "inc"), """,
tx AS (SELECT cluster_id AS grp, basket_id AS tid, items FROM m_assign
       WHERE NOT is_seed AND cluster_id IN (SELECT cluster_id FROM pred))""",
                         mining_ctes("c", "tx", CLUSTER_SUPPORT, MIN_CONFIDENCE)) + f"""
SELECT grp AS cluster_id, antecedent, consequent, round(confidence, {RATIO_DIGITS}) AS confidence,
       round(lift, {RATIO_DIGITS}) AS lift, round(support, {RATIO_DIGITS}) AS support FROM c_rules"""
    q["promote_baskets"] = with_(BASE, split, predict_cte("m", "pred", "inc")) + """
SELECT basket_id, customer_id, cluster_id FROM pred"""
    return q


ORACLE_SQL = _sql()
