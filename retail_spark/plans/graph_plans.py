"""Registered graph / recommendation plans (GRF-01..09, JON-05/06, WIN-03).

Oracles are brute force in SQL (explicit self-joins, a recursive CTE, an
unrolled PageRank) on the same tables; the Spark side runs the scalable
operators (blocked pair generation, prefix filtering, checkpointed
iterations)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_spark.operators import graph as GR
from retail_spark.operators import similarity as S
from retail_spark.plans.common import Plan, finalize
from retail_spark.sources.tables import read_table

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
JACCARD_T = 0.4
TOP_K = 5
PAGERANK_ITERS = 10
LABEL_ROUNDS = 5
DAMPING = 0.85


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"]).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), "l_quantity", "l_extendedprice"
    )


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return GR.copurchase_edges(_lines(spark, sf))


def _pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    return GR.copurchase_pairs(_lines(spark, sf))


def _popularity(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).groupBy("product_id").agg(F.sum(F.col("l_quantity").cast("int")).cast("long").alias("units"))


def _products(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "part", ["p_partkey", "p_type", "p_brand"]).select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"), F.col("p_brand").alias("brand")
    )


BASKETS_SQL = """
b AS (SELECT DISTINCT l_orderkey AS order_id, l_partkey AS product_id FROM lineitem WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL),
n AS (SELECT CAST(COUNT(DISTINCT order_id) AS DOUBLE) AS n FROM b),
c AS (SELECT product_id, COUNT(*) AS item_orders FROM b GROUP BY product_id),
p AS (SELECT x.product_id AS product_id_a, y.product_id AS product_id_b, COUNT(*) AS pair_orders
      FROM b x JOIN b y ON x.order_id = y.order_id AND x.product_id < y.product_id GROUP BY 1, 2)"""

POP_SQL = """
pop AS (SELECT p_partkey AS product_id, p_type AS category, p_brand AS brand, COALESCE(CAST(u.units AS DOUBLE), 0.0) AS pop
        FROM part LEFT JOIN (SELECT l_partkey, CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS units FROM lineitem GROUP BY l_partkey) u
        ON p_partkey = u.l_partkey)"""


def q_graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-01: customer -> product purchase edges."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_extendedprice"])
    od = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    ev = li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("graph_customer_id"),
        F.col("l_partkey").alias("graph_product_id"),
        F.lit("purchase").alias("graph_interaction_type"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("event_amount"),
        F.col("o_orderdate").alias("event_ts"),
    )
    return finalize(GR.interaction_edges(ev))


GRAPH_EDGES_SQL = """
SELECT o_custkey AS src, l_partkey AS dst, 'purchase' AS edge_type, COUNT(*) AS interactions,
       MIN(o_orderdate) AS first_ts, MAX(o_orderdate) AS last_ts, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL GROUP BY o_custkey, l_partkey"""


def q_copurchase(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-02 / JON-05: co-purchase pairs with support, confidence, lift."""
    return _pairs(spark, sf)


COPURCHASE_SQL = f"""WITH {BASKETS_SQL}
SELECT p.product_id_a, p.product_id_b, p.pair_orders, ca.item_orders AS orders_a, cb.item_orders AS orders_b,
       CAST(p.pair_orders AS DOUBLE) / n.n AS support,
       CAST(p.pair_orders AS DOUBLE) / CAST(ca.item_orders AS DOUBLE) AS confidence_ab,
       CAST(p.pair_orders AS DOUBLE) / CAST(cb.item_orders AS DOUBLE) AS confidence_ba,
       (CAST(p.pair_orders AS DOUBLE) * n.n) / (CAST(ca.item_orders AS DOUBLE) * CAST(cb.item_orders AS DOUBLE)) AS lift
FROM p JOIN c ca ON p.product_id_a = ca.product_id JOIN c cb ON p.product_id_b = cb.product_id, n"""


def q_copurchase_topk(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-03: top-5 co-purchased partners per product."""
    return GR.top_k_related(_pair_counts(spark, sf), k=TOP_K)


COPURCHASE_TOPK_SQL = f"""WITH {BASKETS_SQL},
both_ AS (SELECT product_id_a AS product_id, product_id_b AS related_id, pair_orders AS score FROM p
          UNION ALL SELECT product_id_b, product_id_a, pair_orders FROM p)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY product_id ORDER BY score DESC, related_id) AS INTEGER) AS rank FROM both_)
WHERE rank <= {TOP_K}"""


def q_recommend_items(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-08: co-purchase partners first, then the category's best sellers."""
    return GR.recommend_items(_pair_counts(spark, sf), _products(spark, sf), _popularity(spark, sf), k=TOP_K)


RECOMMEND_ITEMS_SQL = f"""WITH {BASKETS_SQL}, {POP_SQL},
co AS (SELECT product_id_a AS product_id, product_id_b AS related_id, 0 AS tier, CAST(pair_orders AS DOUBLE) AS score FROM p
       UNION ALL SELECT product_id_b, product_id_a, 0, CAST(pair_orders AS DOUBLE) FROM p),
fb AS (SELECT x.product_id, y.product_id AS related_id, 1 AS tier, y.pop AS score
       FROM pop x JOIN pop y ON x.category = y.category AND x.product_id <> y.product_id),
cands AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_id, related_id ORDER BY tier) AS d
                         FROM (SELECT * FROM co UNION ALL SELECT * FROM fb)) WHERE d = 1)
SELECT product_id, related_id, tier, score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY product_id ORDER BY tier, score DESC, related_id) AS INTEGER) AS rank FROM cands)
WHERE rank <= {TOP_K}"""


def q_attribute_similar(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-09: same-category, then same-brand products, by popularity."""
    return GR.attribute_similar(_products(spark, sf), _popularity(spark, sf), k=TOP_K)


ATTRIBUTE_SIMILAR_SQL = f"""WITH {POP_SQL},
cands AS (SELECT x.product_id, y.product_id AS related_id, CASE WHEN x.category = y.category THEN 0 ELSE 1 END AS tier, y.pop AS score
          FROM pop x JOIN pop y ON (x.category = y.category OR x.brand = y.brand) AND x.product_id <> y.product_id)
SELECT product_id, related_id, tier, score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY product_id ORDER BY tier, score DESC, related_id) AS INTEGER) AS rank FROM cands)
WHERE rank <= {TOP_K}"""


def _interactions(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events", ["user_id", "props"])
    return ev.select(F.col("user_id").alias("customer_id"), F.get_json_object("props", "$.k").cast("int").alias("product_id"))


def q_customer_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-04 / JON-06: customer pairs with Jaccard(products) >= 0.4."""
    return GR.jaccard_similarity(_interactions(spark, sf), threshold=JACCARD_T)


JACCARD_SQL = f"""
s AS (SELECT DISTINCT user_id AS customer_id, {K} AS product_id FROM events WHERE user_id IS NOT NULL AND {K} IS NOT NULL),
sz AS (SELECT customer_id, COUNT(*) AS n FROM s GROUP BY customer_id),
i AS (SELECT a.customer_id AS customer_id_a, b.customer_id AS customer_id_b, COUNT(*) AS intersection
      FROM s a JOIN s b ON a.product_id = b.product_id AND a.customer_id < b.customer_id GROUP BY 1, 2),
jac AS (SELECT customer_id_a, customer_id_b, x.n AS size_a, y.n AS size_b, intersection,
               CAST(intersection AS DOUBLE) / CAST(x.n + y.n - intersection AS DOUBLE) AS jaccard
        FROM i JOIN sz x ON x.customer_id = customer_id_a JOIN sz y ON y.customer_id = customer_id_b
        WHERE CAST(intersection AS DOUBLE) / CAST(x.n + y.n - intersection AS DOUBLE) >= {JACCARD_T} - 1e-12)"""

CUSTOMER_JACCARD_SQL = f"WITH {JACCARD_SQL}\nSELECT * FROM jac"


def q_customer_components(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-05: connected components of the Jaccard >= 0.4 customer graph."""
    edges = GR.jaccard_similarity(_interactions(spark, sf), threshold=JACCARD_T, links_only=True)
    customers = _interactions(spark, sf).select("customer_id").distinct()
    return GR.connected_components(edges, src="customer_id_a", dst="customer_id_b", vertices=customers)


CUSTOMER_COMPONENTS_SQL = f"""WITH RECURSIVE {JACCARD_SQL},
e AS (SELECT customer_id_a AS u, customer_id_b AS v FROM jac UNION SELECT customer_id_b, customer_id_a FROM jac),
r(u, v) AS (SELECT c, c FROM (SELECT DISTINCT customer_id AS c FROM s) UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT u AS vertex, MIN(v) AS label FROM r GROUP BY u"""


def q_product_communities(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-05: label propagation on the co-purchase graph, weighted by orders."""
    return GR.label_propagation(_pair_counts(spark, sf), src="product_id_a", dst="product_id_b", weight="pair_orders", rounds=LABEL_ROUNDS)


def _communities_sql() -> str:
    steps = ["l0 AS (SELECT DISTINCT u AS vertex, u AS label FROM e)"]
    for i in range(1, LABEL_ROUNDS + 1):
        steps.append(
            f"l{i} AS (SELECT vertex, label FROM (SELECT e.u AS vertex, l.label, row_number() OVER (PARTITION BY e.u ORDER BY SUM(e.w) DESC, l.label) AS r "
            f"FROM e JOIN l{i - 1} l ON l.vertex = e.v GROUP BY e.u, l.label) WHERE r = 1)"
        )
    return f"""WITH {BASKETS_SQL},
e AS (SELECT product_id_a AS u, product_id_b AS v, pair_orders AS w FROM p UNION ALL SELECT product_id_b, product_id_a, pair_orders FROM p),
{', '.join(steps)}
SELECT vertex, label FROM l{LABEL_ROUNDS}"""


def q_graph_degree(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-06: degree and weighted degree on the co-purchase graph."""
    return GR.degrees(_pair_counts(spark, sf), src="product_id_a", dst="product_id_b", weight="pair_orders")


GRAPH_DEGREE_SQL = f"""WITH {BASKETS_SQL},
x AS (SELECT product_id_a AS vertex, pair_orders AS w FROM p UNION ALL SELECT product_id_b, pair_orders FROM p)
SELECT vertex, COUNT(*) AS degree, CAST(SUM(w) AS BIGINT) AS weighted_degree FROM x GROUP BY vertex"""


def q_pagerank(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-06: 10 PageRank iterations on the co-purchase graph (rounded to 1e-9)."""
    r = GR.pagerank(_pair_counts(spark, sf), src="product_id_a", dst="product_id_b", iterations=PAGERANK_ITERS, damping=DAMPING)
    return r.select("vertex", F.round("rank", 9).alias("rank"))


def _pagerank_sql() -> str:
    steps = [
        "r0 AS (SELECT vertex, 1.0 / (SELECT cnt FROM nv) AS rank FROM v)",
    ]
    for i in range(1, PAGERANK_ITERS + 1):
        steps.append(
            f"r{i} AS (SELECT v.vertex, {(1 - DAMPING)} / (SELECT cnt FROM nv) + {DAMPING} * COALESCE(s.s, 0.0) AS rank FROM v "
            f"LEFT JOIN (SELECT e.v AS vertex, SUM(r.rank / e.outdeg) AS s FROM e JOIN r{i - 1} r ON e.u = r.vertex GROUP BY e.v) s "
            f"ON v.vertex = s.vertex)"
        )
    return f"""WITH {BASKETS_SQL},
e0 AS (SELECT product_id_a AS u, product_id_b AS v FROM p UNION SELECT product_id_b, product_id_a FROM p),
e AS (SELECT e0.*, d.outdeg FROM e0 JOIN (SELECT u, COUNT(*) AS outdeg FROM e0 GROUP BY u) d ON e0.u = d.u),
v AS (SELECT u AS vertex FROM e UNION SELECT v FROM e),
nv AS (SELECT CAST(COUNT(*) AS DOUBLE) AS cnt FROM v),
{', '.join(steps)}
SELECT vertex, round(rank, 9) AS rank FROM r{PAGERANK_ITERS}"""


def q_frequent_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-03: itemsets of every size bought in at least 2 orders."""
    fi = GR.frequent_itemsets(_lines(spark, sf), min_count=2)
    return fi.select(F.concat_ws(",", F.transform("items", lambda x: x.cast("string"))).alias("items"), "size", "freq")


FREQUENT_ITEMSETS_SQL = """WITH RECURSIVE b AS (
  SELECT DISTINCT l_orderkey AS o, l_partkey AS i FROM lineitem WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL),
subsets(o, items, last, size) AS (
  SELECT o, CAST(i AS VARCHAR), i, 1 FROM b
  UNION ALL SELECT s.o, s.items || ',' || CAST(b.i AS VARCHAR), b.i, s.size + 1 FROM subsets s JOIN b ON s.o = b.o AND b.i > s.last)
SELECT items, size, COUNT(*) AS freq FROM subsets GROUP BY items, size HAVING COUNT(*) >= 2"""


def q_association_rules(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-03: rules a -> b over itemsets seen in at least 2 orders."""
    lines = _lines(spark, sf)
    total = GR.baskets(lines).select(F.count_distinct("order_id")).first()[0]
    return GR.association_rules(GR.frequent_itemsets(lines, min_count=2), total)


ASSOCIATION_RULES_SQL = f"""WITH {BASKETS_SQL},
fp AS (SELECT * FROM p WHERE pair_orders >= 2),
r AS (SELECT product_id_a AS antecedent, product_id_b AS consequent, pair_orders AS freq FROM fp
      UNION ALL SELECT product_id_b, product_id_a, pair_orders FROM fp)
SELECT r.consequent, r.antecedent, r.freq, ca.item_orders AS ante_freq, cc.item_orders AS cons_freq,
       CAST(r.freq AS DOUBLE) / CAST(ca.item_orders AS DOUBLE) AS confidence,
       CAST(r.freq AS DOUBLE) * n.n / (CAST(ca.item_orders AS DOUBLE) * CAST(cc.item_orders AS DOUBLE)) AS lift
FROM r JOIN c ca ON r.antecedent = ca.product_id JOIN c cc ON r.consequent = cc.product_id, n"""


def q_itemset_rules(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-03: rules {a, b, ..} -> c over itemsets of every size seen in at least 2 orders."""
    lines = _lines(spark, sf)
    total = GR.baskets(lines).select(F.count_distinct("order_id")).first()[0]
    rules = GR.itemset_rules(GR.frequent_itemsets(lines, min_count=2), total)
    return rules.withColumn("antecedent", F.concat_ws(",", F.transform("antecedent", lambda x: x.cast("string"))))


ITEMSET_RULES_SQL = """WITH RECURSIVE b AS (
  SELECT DISTINCT l_orderkey AS o, l_partkey AS i FROM lineitem WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL),
subsets(o, items, last) AS (
  SELECT o, [i], i FROM b
  UNION ALL SELECT s.o, list_append(s.items, b.i), b.i FROM subsets s JOIN b ON s.o = b.o AND b.i > s.last),
fi AS (SELECT items, COUNT(*) AS freq FROM subsets GROUP BY items HAVING COUNT(*) >= 2),
e AS (SELECT items, freq, unnest(items) AS consequent FROM fi WHERE len(items) > 1),
r AS (SELECT list_filter(items, lambda x: x <> consequent) AS antecedent, consequent, freq FROM e),
n AS (SELECT CAST(COUNT(DISTINCT o) AS DOUBLE) AS n FROM b)
SELECT r.consequent, array_to_string(r.antecedent, ',') AS antecedent, r.freq, a.freq AS ante_freq, c.freq AS cons_freq,
       CAST(r.freq AS DOUBLE) / CAST(a.freq AS DOUBLE) AS confidence,
       CAST(r.freq AS DOUBLE) * n.n / (CAST(a.freq AS DOUBLE) * CAST(c.freq AS DOUBLE)) AS lift
FROM r JOIN fi a ON a.items = r.antecedent JOIN fi c ON c.items = [r.consequent], n"""


def q_als_factors(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-07: implicit ALS embeddings of customers and products: one row each, with its factors' number."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey"])
    od = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    inter = li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id")
    )
    users, items = GR.als_factors(inter)
    size = F.size("features").alias("n_factors")
    whole = F.forall("features", lambda x: x.isNotNull() & ~F.isnan(x)).alias("is_whole")
    return users.select(F.lit("customer").alias("kind"), F.col("customer_id").alias("id"), size, whole).unionByName(
        items.select(F.lit("product").alias("kind"), F.col("product_id").alias("id"), size, whole)
    )


ALS_SQL = """SELECT DISTINCT 'customer' AS kind, o_custkey AS id, 8 AS n_factors, true AS is_whole FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT DISTINCT 'product', l_partkey, 8, true FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


ALS_MARGIN = 1.5


def q_als_recommend(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-07: five products for every customer by their embeddings; known pairs score 1.5 times the mean pair at least."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey"])
    od = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    inter = li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"))
    found, fit = GR.als_recommend(inter, k=TOP_K)
    in_order = F.array_sort(F.collect_list(F.struct("rank", "score")))
    each = found.groupBy("customer_id").agg(
        F.count_distinct("product_id").alias("products"), F.sum("rank").alias("ranks"), in_order.alias("s"))
    falls = F.forall(F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.element_at("s", i)["score"] >= F.element_at("s", i + 1)["score"])
    return each.join(fit).select("customer_id", "products", "ranks", falls.alias("scores_fall"),
                                 (F.col("known_score") >= ALS_MARGIN * F.col("mean_score")).alias("margin_reached"))


ALS_RECOMMEND_SQL = f"""SELECT DISTINCT o_custkey AS customer_id, CAST({TOP_K} AS BIGINT) AS products, CAST({TOP_K * (TOP_K + 1) // 2} AS BIGINT) AS ranks,
       true AS scores_fall, true AS margin_reached FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


# ------------------------------------------------- similarity by hashing (GRF-04)

LSH_T, LSH_RECALL = 0.5, 0.95


def q_similar_customers(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-04: customers with Jaccard(products) >= 0.5, candidates by banded minimum hashes, verified exactly."""
    pairs, members = S.jaccard_lsh(_interactions(spark, sf), threshold=LSH_T, recall=LSH_RECALL)
    kinds = members.select(F.lit("member").alias("kind"), F.col("representative").alias("a"), F.col("customer_id").alias("b"), F.lit(1.0).alias("jaccard"))
    return kinds.unionByName(pairs.select(F.lit("pair").alias("kind"), F.col("customer_id_a").alias("a"), F.col("customer_id_b").alias("b"), "jaccard"))


def q_similarity_recall(spark: SparkSession, sf: str) -> DataFrame:
    """GRF-04: the hashed pairs against the exact ones: how many there are, how many found ones are wrong, and whether the
    share found is at least 0.9."""
    inter = _interactions(spark, sf)
    pairs, _ = S.jaccard_lsh(inter, threshold=LSH_T, recall=LSH_RECALL)
    exact = GR.jaccard_similarity(inter, threshold=LSH_T)
    key = ["customer_id_a", "customer_id_b"]
    met = exact.select(*key, F.lit(True).alias("is_exact")).join(pairs.select(*key, F.lit(True).alias("is_found")), key, "full")
    n = met.agg(F.count_if("is_exact").alias("exact_pairs"), F.count_if(F.col("is_found") & F.col("is_exact").isNull()).alias("wrong_pairs"),
                F.count_if(F.col("is_exact") & F.col("is_found")).alias("found"))
    return n.select("exact_pairs", "wrong_pairs", (F.col("found") >= 0.9 * F.col("exact_pairs")).alias("recall_reached"))


SIMILARITY_RECALL_SQL = f"""WITH {JACCARD_SQL.replace(str(JACCARD_T), str(LSH_T))}
SELECT COUNT(*) AS exact_pairs, CAST(0 AS BIGINT) AS wrong_pairs, true AS recall_reached FROM jac"""


PLANS = {
    "graph_edges": Plan(q_graph_edges, GRAPH_EDGES_SQL, "GRF-01"),
    "copurchase": Plan(q_copurchase, COPURCHASE_SQL, "GRF-02 JON-05"),
    "copurchase_topk": Plan(q_copurchase_topk, COPURCHASE_TOPK_SQL, "WIN-03"),
    "recommend_items": Plan(q_recommend_items, RECOMMEND_ITEMS_SQL, "GRF-08"),
    "attribute_similar": Plan(q_attribute_similar, ATTRIBUTE_SIMILAR_SQL, "GRF-09"),
    "customer_jaccard": Plan(q_customer_jaccard, CUSTOMER_JACCARD_SQL, "GRF-04 JON-06"),
    "similar_customers": Plan(q_similar_customers, None, "GRF-04 JON-06"),
    "similarity_recall": Plan(q_similarity_recall, SIMILARITY_RECALL_SQL, "GRF-04"),
    "customer_components": Plan(q_customer_components, CUSTOMER_COMPONENTS_SQL, "GRF-05"),
    "product_communities": Plan(q_product_communities, _communities_sql(), "GRF-05"),
    "graph_degree": Plan(q_graph_degree, GRAPH_DEGREE_SQL, "GRF-06"),
    "pagerank": Plan(q_pagerank, _pagerank_sql(), "GRF-06"),
    "frequent_itemsets": Plan(q_frequent_itemsets, FREQUENT_ITEMSETS_SQL, "GRF-03"),
    "association_rules": Plan(q_association_rules, ASSOCIATION_RULES_SQL, "GRF-03"),
    "itemset_rules": Plan(q_itemset_rules, ITEMSET_RULES_SQL, "GRF-03"),
    "als_factors": Plan(q_als_factors, ALS_SQL, "GRF-07"),
    "als_recommend": Plan(q_als_recommend, ALS_RECOMMEND_SQL, "GRF-07 GRF-08"),
}
