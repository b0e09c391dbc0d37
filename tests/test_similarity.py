"""Banded minimum hashes against all pairs (GRF-04)."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from retail_spark.operators.similarity import band_members, bands_for, item_sets, jaccard_lsh, lsh_candidates


def jaccard(a, b):
    return len(a & b) / len(a | b)


def planted(n, seed):
    """Sparse sets of 30 of 3000 items in groups of 4, a group's members sharing more or less."""
    r, out = random.Random(seed), {}
    for g in range(n):
        base = r.sample(range(3000), 30)
        for m in range(4):
            kept = [x for x in base if r.random() < (1.0, 0.95, 0.8, 0.6)[m]]
            out[g * 4 + m] = set(kept + r.sample(range(3000), 30 - len(kept)))
    return out


def rows_of(spark, sets):
    rows = [(e, i) for e, items in sets.items() for i in items for _ in range(1 + i % 2)]
    return spark.createDataFrame(rows + [(None, 1), (7, None)], "customer_id long, product_id long")


def test_recall_and_exactness_on_sparse_sets(spark):
    sets = planted(60, 1)
    pairs, members = jaccard_lsh(rows_of(spark, sets), threshold=0.5, recall=0.99)
    got = {(r.customer_id_a, r.customer_id_b): r for r in pairs.collect()}
    kept = {r.customer_id for r in members.where("customer_id = representative").collect()}
    want = {(a, b) for a in kept for b in kept if a < b and jaccard(sets[a], sets[b]) >= 0.5}
    assert set(got) <= want and len(got) >= 0.95 * len(want) and len(want) > 60
    for (a, b), r in got.items():
        assert (r.size_a, r.size_b, r.intersection) == (len(sets[a]), len(sets[b]), len(sets[a] & sets[b])) and abs(r.jaccard - jaccard(sets[a], sets[b])) < 1e-12
    found = lsh_candidates(item_sets(rows_of(spark, sets), entity="customer_id", item="product_id"), entity="customer_id", item="product_id", bands=bands_for(0.5, 5, 0.99), rows=5)
    assert found.count() < 0.03 * len(sets) * (len(sets) - 1) / 2  # far from all pairs


def test_copies_are_one_class(spark):
    sets = {k: {1, 2, 3, 4} for k in range(40)} | {100: {1, 2, 3, 4, 5}, 101: {9}}
    pairs, members = jaccard_lsh(rows_of(spark, sets), threshold=0.5, recall=0.999)
    assert [(r.customer_id_a, r.customer_id_b) for r in pairs.collect()] == [(0, 100)]
    assert {r.customer_id: r.representative for r in members.collect()} == {**{k: 0 for k in range(40)}, 100: 100, 101: 101}
    nothing = rows_of(spark, {}).where("false")
    pairs, members = jaccard_lsh(nothing)
    assert pairs.count() == 0 and members.count() == 0


def test_bands(spark):
    assert bands_for(1, 5, 0.9) == 1 and bands_for(0.5, 1, 0.5) == 1
    for t, r, p in ((0.5, 5, 0.95), (0.8, 6, 0.99), (0.3, 3, 0.9)):
        b = bands_for(t, r, p)
        assert 1 - (1 - t ** r) ** b >= p > 1 - (1 - t ** r) ** (b - 1)
    for wrong in ((0, 5, 0.9), (0.5, 0, 0.9), (0.5, 5, 1)):
        with pytest.raises(ValueError):
            bands_for(*wrong)
    sets = item_sets(rows_of(spark, planted(3, 2)), entity="customer_id", item="product_id")
    members = band_members(sets, entity="customer_id", item="product_id", bands=41, rows=5)
    assert members.count() == 41 * 12 and members.groupBy("customer_id").agg(F.count_distinct("bucket").alias("n")).where("n <> 41").count() == 0


def test_factors_recommend_what_the_group_buys(spark):
    """Two groups of customers with their own products: a product left out for a customer is recommended from its group."""
    from retail_spark.operators.graph import als_recommend

    r, rows = random.Random(3), []
    for c in range(40):
        rows += [(f"c{c}", f"p{20 * (c % 2) + i}") for i in r.sample(range(20), 14) for _ in range(2)]
    table = spark.createDataFrame([*rows, (None, "p1"), ("c1", None)], "customer_id string, product_id string")
    found, fit = als_recommend(table, k=5, rank=4)
    got = found.collect()
    assert len(got) == 200 and {(x.customer_id, x.rank) for x in got} == {(f"c{c}", k) for c in range(40) for k in range(1, 6)}
    right = [int(x.product_id[1:]) // 20 == int(x.customer_id[1:]) % 2 for x in got]
    assert sum(right) >= 0.95 * len(right)
    f = fit.first()
    assert f.known_score > 1.5 * f.mean_score > 0
