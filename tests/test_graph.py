"""Scalable graph operators vs brute force on small fixtures (GRF-02..09)."""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from retail_spark.operators import graph as GR

baskets_strategy = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 11)), min_size=1, max_size=60
)


def brute_pairs(members):
    by = defaultdict(set)
    for g, i in members:
        by[g].add(i)
    out = Counter()
    for items in by.values():
        for a, b in itertools.combinations(sorted(items), 2):
            out[(a, b)] += 1
    return out


@settings(max_examples=10, deadline=None)
@given(baskets_strategy)
def test_block_pairs_matches_brute_force_with_hot_baskets(spark, members):
    df = spark.createDataFrame(sorted(set(members)), "order_id int, product_id int")
    # block=2 forces every basket with >2 items through the split path
    got = Counter(
        (r.product_id_a, r.product_id_b) for r in GR.block_pairs(df, "order_id", "product_id", block=2).collect()
    )
    assert got == brute_pairs(members)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 7)), min_size=2, max_size=50), st.sampled_from([0.3, 0.5, 0.8]))
def test_jaccard_prefix_filter_is_exact(spark, inter, t):
    df = spark.createDataFrame(inter, "customer_id int, product_id int")
    got = {(r.customer_id_a, r.customer_id_b): round(r.jaccard, 12) for r in GR.jaccard_similarity(df, threshold=t, block=2).collect()}
    sets = defaultdict(set)
    for c, p in inter:
        sets[c].add(p)
    want = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        if j >= t - 1e-12:
            want[(a, b)] = round(j, 12)
    assert got == want


def test_connected_components_and_pagerank(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (4, 5), (6, 6)], "src int, dst int")
    comp = {r.vertex: r.label for r in GR.connected_components(edges).collect()}
    assert comp == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    ranks = {r.vertex: r.rank for r in GR.pagerank(edges, iterations=30).collect()}
    assert abs(ranks[2] - max(ranks.values())) < 1e-12 and abs(ranks[1] - ranks[3]) < 1e-12


def test_attribute_similar_matches_brute_force(spark):
    prods = [(i, f"c{i % 3}", f"b{i % 4}") for i in range(14)]
    pop = [(i, (i * 7) % 5) for i in range(14)]
    p_df = spark.createDataFrame(prods, "product_id int, category string, brand string")
    u_df = spark.createDataFrame(pop, "product_id int, units long")
    got = {(r.product_id, r.rank): r.related_id for r in GR.attribute_similar(p_df, u_df, k=3).collect()}
    popd = dict(pop)
    want = {}
    for pid, cat, br in prods:
        cands = [(0 if c == cat else 1, -popd[q], q) for q, c, b in prods if q != pid and (c == cat or b == br)]
        for rank, (_, _, q) in enumerate(sorted(cands)[:3], start=1):
            want[(pid, rank)] = q
    assert got == want


def test_frequent_itemsets_and_rules(spark):
    lines = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (2, 11), (3, 10), (3, 12)], "order_id int, product_id int")
    fi = {(tuple(r["items"]), r["freq"]) for r in GR.frequent_itemsets(lines, min_count=2).collect()}
    assert fi == {((10,), 3), ((11,), 2), ((10, 11), 2)}
    rules = {(r.antecedent, r.consequent): round(r.confidence, 6) for r in GR.association_rules(GR.frequent_itemsets(lines, min_count=2), 3).collect()}
    assert rules == {(10, 11): round(2 / 3, 6), (11, 10): 1.0}


def test_rules_of_several_items(spark):
    lines = spark.createDataFrame([(o, p) for o, ps in enumerate(((1, 2, 3), (1, 2, 3), (1, 2))) for p in ps], "order_id int, product_id int")
    got = {(tuple(r.antecedent), r.consequent): (r.freq, round(r.confidence, 6), round(r.lift, 6))
           for r in GR.itemset_rules(GR.frequent_itemsets(lines, min_count=2), 3).collect()}
    assert len(got) == 9 and got[((1, 2), 3)] == (2, round(2 / 3, 6), 1.0) and got[((2, 3), 1)] == (2, 1.0, 1.0)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 400)), min_size=1, max_size=40, unique=True))
def test_sessionize_two_phase_matches_brute_force(spark, evs):
    from pyspark.sql import functions as F

    from retail_spark.streaming.windows import sessionize

    # minutes offsets; 30-minute gap, 7-minute buckets so sessions span buckets
    df = spark.createDataFrame([(str(i), u, m) for i, (u, m) in enumerate(evs)], "event_id string, customer_id int, m int")
    df = df.withColumn("event_ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("m") * 60))
    got = {r.event_id: (r.session_start.timestamp(), r.step_in_session, r.seconds_since_previous)
           for r in sessionize(df, gap_minutes=30, bucket_minutes=7).collect()}
    want = {}
    by_user = defaultdict(list)
    for i, (u, m) in enumerate(evs):
        by_user[u].append((m, str(i)))
    for u, items in by_user.items():
        items.sort()
        start, step, prev = None, 0, None
        for m, eid in items:
            if prev is None or (m - prev) * 60 > 30 * 60:
                start, step, gap = m, 1, None
            else:
                step, gap = step + 1, float((m - prev) * 60)
            want[eid] = (1_700_000_000 + start * 60, step, gap)
            prev = m
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 300)), min_size=1, max_size=30, unique=True))
def test_session_gaps_two_phase_matches_window(spark, evs):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from retail_spark.streaming.windows import session_gaps

    df = spark.createDataFrame([(str(i), f"s{u}", m) for i, (u, m) in enumerate(evs)], "event_id string, session_id string, m int")
    df = df.withColumn("event_ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("m") * 60))
    got = {r.event_id: (r.step_index, r.gap_seconds) for r in session_gaps(df, bucket_minutes=7).collect()}
    w = Window.partitionBy("session_id").orderBy("event_ts", "event_id")
    ref = df.withColumns({"s": F.row_number().over(w), "g": F.col("event_ts").cast("double") - F.lag("event_ts").over(w).cast("double")})
    want = {r.event_id: (r.s, r.g) for r in ref.collect()}
    assert got == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=40))
def test_connected_components_matches_union_find(spark, pairs):
    df = spark.createDataFrame(pairs, "src int, dst int")
    got = {r.vertex: r.label for r in GR.connected_components(df).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    verts = {x for a, b in pairs if a != b for x in (a, b)}
    comp = defaultdict(list)
    for x in verts:
        comp[find(x)].append(x)
    want = {x: min(members) for members in comp.values() for x in members}
    assert got == want


def test_connected_components_long_chain(spark):
    n = 64
    df = spark.createDataFrame([(i, i + 1) for i in range(n)], "src int, dst int")
    got = {r.vertex: r.label for r in GR.connected_components(df).collect()}
    assert got == {i: 0 for i in range(n + 1)}


def test_label_propagation_against_brute_force(spark):
    pairs = [(1, 2, 3), (2, 3, 3), (1, 3, 3), (3, 4, 1), (4, 5, 2), (5, 6, 2), (4, 6, 2), (2, 1, 1), (7, 7, 9), (8, None, 4)]
    near = defaultdict(Counter)
    for a, b, w in pairs:
        if b is not None and a != b:
            near[a][b] += w
            near[b][a] += w
    label = {v: v for v in near}
    for _ in range(3):
        votes = {v: Counter() for v in near}
        for v, others in near.items():
            for o, w in others.items():
                votes[v][label[o]] += w
        label = {v: min(c, key=lambda x: (-c[x], x)) for v, c in votes.items()}
    edges = spark.createDataFrame(pairs, "src int, dst int, w int")
    out = GR.label_propagation(edges, weight="w", rounds=3).collect()
    assert {r["vertex"]: r["label"] for r in out} == label
    assert GR.label_propagation(edges.limit(0)).count() == 0
