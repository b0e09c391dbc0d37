"""Graph and recommendation features (GRF-01..09, JON-05/06, WIN-03).

Scale notes
-----------
* Every graph job first reduces events to distinct (group, item) pairs
  (map-side combined), so a raw hot key (one order or product holding a
  third of all events) becomes one row per distinct item.
* Co-occurrence counting needs, per basket, its item pairs - they are the
  output. ``block_pairs`` never gives a whole basket to one task: a basket
  of n items is cut into ceil(n / block) hash blocks and the work is keyed
  by (basket, block_a, block_b), so each join task sees at most
  ``block`` x ``block`` pairs and AQE spreads the keys. Pairs are
  aggregated (partial, then final) straight after.
* Customer similarity is an exact threshold join over blocks of customers:
  every two blocks meet in one task, which gives out only the pairs that
  reach the threshold, so candidates are never written or shuffled.
* Iterative jobs cut lineage each round, with a reliable ``checkpoint()`` or
  files in the shared ``spark.checkpoint.dir``; a step's shuffle files are
  removed when it ends.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_spark.operators import set_pairs as SP
from retail_spark.operators import top_products as TP
from retail_spark.session import discard, ensure_shared_dir, freed_shuffles, shared_path, stash

DEFAULT_BLOCK = 256


def top_n_per_group(
    df: DataFrame,
    group: str | Sequence[str],
    order: Sequence[Column],
    n: int,
    *,
    rank_column: str = "rank",
    salt_buckets: int = 64,
    salt_on: str | None = None,
) -> DataFrame:
    """Exact top-``n`` rows per group (``row_number`` by ``order``).

    Two levels, so no task sorts a whole hot group: rows are first ranked
    within (group, hash bucket of ``salt_on``) keeping ``n`` per bucket, then
    the at most ``n x salt_buckets`` survivors are ranked per group. The
    global top-n is always among the per-bucket top-n, so the result is
    exact. ``order`` must be a total order (end with a unique column).
    """
    groups = [group] if isinstance(group, str) else list(group)
    salt = F.pmod(F.xxhash64(F.col(salt_on) if salt_on else F.struct(*df.columns)), F.lit(salt_buckets))
    w1 = Window.partitionBy(*groups, "__salt").orderBy(*order)
    first = df.withColumn("__salt", salt).withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= n)
    w2 = Window.partitionBy(*groups).orderBy(*order)
    return first.withColumn(rank_column, F.row_number().over(w2)).where(F.col(rank_column) <= n).drop("__salt", "__r1")


def interaction_edges(
    events: DataFrame,
    *,
    src: str = "graph_customer_id",
    dst: str = "graph_product_id",
    edge_type: str = "graph_interaction_type",
    amount: str | None = "event_amount",
    ts: str = "event_ts",
) -> DataFrame:
    """GRF-01: customer -> product edges with count, amount, first/last time."""
    aggs = [F.count(F.lit(1)).alias("interactions"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")]
    if amount:
        aggs.append(F.sum(amount).alias("amount"))
    return (
        events.where(F.col(src).isNotNull() & F.col(dst).isNotNull())
        .groupBy(F.col(src).alias("src"), F.col(dst).alias("dst"), F.col(edge_type).alias("edge_type"))
        .agg(*aggs)
    )


def block_pairs(
    members: DataFrame,
    group: str,
    item: str,
    *,
    block: int = DEFAULT_BLOCK,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Each unordered pair of distinct items sharing a group, exactly once,
    as (group, item_a, item_b) with item_a < item_b (+ ``extra`` columns of
    each side suffixed _a/_b).

    ``members`` must be distinct on (group, item). Baskets bigger than
    ``block`` are split into hash blocks; a row of block i is replicated to
    partner blocks j >= i (left side) / j <= i (right side) and the join key
    is (group, i, j), so no task handles more than ~block^2 pairs.
    """
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("__gsize"))
    m = members.join(sizes, group).withColumn("__k", F.greatest(F.lit(1), F.ceil(F.col("__gsize") / F.lit(block))).cast("int"))
    m = m.withColumn("__b", F.pmod(F.xxhash64(F.col(item)), F.col("__k")).cast("int"))
    left = m.select(
        F.col(group).alias("__g"),
        F.col("__b").alias("__i"),
        F.explode(F.sequence(F.col("__b"), F.col("__k") - 1)).alias("__j"),
        F.col(item).alias("__x"),
        *[F.col(e).alias(f"{e}_a") for e in extra],
    )
    right = m.select(
        F.col(group).alias("__g2"),
        F.explode(F.sequence(F.lit(0), F.col("__b"))).alias("__i2"),
        F.col("__b").alias("__j2"),
        F.col(item).alias("__y"),
        *[F.col(e).alias(f"{e}_b") for e in extra],
    )
    cond = (
        (F.col("__g") == F.col("__g2"))
        & (F.col("__i") == F.col("__i2"))
        & (F.col("__j") == F.col("__j2"))
        & ((F.col("__i") != F.col("__j")) | (F.col("__x") < F.col("__y")))
    )
    joined = left.join(right, cond)
    swap = F.col("__x") > F.col("__y")
    cols = [
        F.col("__g").alias(group),
        F.when(swap, F.col("__y")).otherwise(F.col("__x")).alias(f"{item}_a"),
        F.when(swap, F.col("__x")).otherwise(F.col("__y")).alias(f"{item}_b"),
    ]
    for e in extra:
        cols.append(F.when(swap, F.col(f"{e}_b")).otherwise(F.col(f"{e}_a")).alias(f"{e}_a"))
        cols.append(F.when(swap, F.col(f"{e}_a")).otherwise(F.col(f"{e}_b")).alias(f"{e}_b"))
    return joined.select(*cols)


def baskets(lines: DataFrame, *, basket: str = "order_id", item: str = "product_id") -> DataFrame:
    """Distinct (basket, item) rows."""
    return lines.where(F.col(basket).isNotNull() & F.col(item).isNotNull()).select(basket, item).distinct()


def copurchase_pairs(
    lines: DataFrame,
    *,
    basket: str = "order_id",
    item: str = "product_id",
    min_count: int = 1,
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """JON-05: (item_a < item_b, ``pair_orders``) - baskets holding both.

    Lines are shuffled once, to their baskets. A basket of at most ``block``
    items is paired where it lies; larger ones are spread by ``block_pairs``.
    """
    held = lines.where(F.col(basket).isNotNull() & F.col(item).isNotNull()).groupBy(basket).agg(F.collect_set(item).alias("__items"))
    small = held.where(F.size("__items") <= block).select(F.array_sort("__items").alias("__items"))
    first = small.select("__items", F.posexplode("__items").alias("__at", f"{item}_a"))
    near = first.select(f"{item}_a", F.explode(F.slice("__items", F.col("__at") + 2, F.size("__items"))).alias(f"{item}_b"))
    large = held.where(F.size("__items") > block).select(basket, F.explode("__items").alias(item))
    return (
        near.unionByName(block_pairs(large, basket, item, block=block).drop(basket))
        .groupBy(f"{item}_a", f"{item}_b")
        .agg(F.count(F.lit(1)).alias("pair_orders"))
        .where(F.col("pair_orders") >= min_count)
    )


def copurchase_edges(
    lines: DataFrame,
    *,
    basket: str = "order_id",
    item: str = "product_id",
    min_count: int = 1,
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """GRF-02 / JON-05: product pairs bought in the same basket.

    Columns: item_a < item_b, ``pair_orders``, ``support`` (pair ÷ baskets),
    ``confidence_ab`` / ``confidence_ba`` and ``lift``.
    """
    b = baskets(lines, basket=basket, item=item)
    total = b.select(F.count_distinct(basket).cast("double").alias("baskets"))  # one row
    counts = b.groupBy(item).agg(F.count(F.lit(1)).alias("item_orders"))
    pairs = copurchase_pairs(lines, basket=basket, item=item, min_count=min_count, block=block)
    # per-item counts are derived (aggregated): AQE broadcasts them at
    # runtime when their measured size is small, else they stay shuffled
    ca = counts.select(F.col(item).alias(f"{item}_a"), F.col("item_orders").alias("orders_a"))
    cb = counts.select(F.col(item).alias(f"{item}_b"), F.col("item_orders").alias("orders_b"))
    out = pairs.join(ca, f"{item}_a").join(cb, f"{item}_b").crossJoin(F.broadcast(total))
    n = F.col("baskets")
    pc = F.col("pair_orders").cast("double")
    return out.withColumns(
        {
            "support": F.try_divide(pc, n),
            "confidence_ab": F.try_divide(pc, F.col("orders_a").cast("double")),
            "confidence_ba": F.try_divide(pc, F.col("orders_b").cast("double")),
            "lift": F.try_divide(pc * n, F.col("orders_a").cast("double") * F.col("orders_b").cast("double")),
        }
    ).select(f"{item}_a", f"{item}_b", "pair_orders", "orders_a", "orders_b", "support", "confidence_ab", "confidence_ba", "lift")


def frequent_itemsets(
    lines: DataFrame,
    *,
    min_support: float | None = None,
    min_count: int | None = None,
    basket: str = "order_id",
    item: str = "product_id",
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """GRF-03: frequent itemsets of every size with their basket counts:
    ``items`` (sorted array), ``size``, ``freq``.

    The threshold is ``min_count`` baskets, or ``min_support`` x baskets. Level
    by level (Apriori): sets of n items are extended, within the baskets that
    hold them, by a larger item that is frequent with their last one; levels go
    on until one has no frequent set. Level 2 only pairs items frequent alone.
    """
    b = baskets(lines, basket=basket, item=item)
    if min_count is None:
        if min_support is None:
            raise ValueError("give min_support or min_count")
        total = b.select(F.count_distinct(basket)).first()[0] or 0
        min_count = max(1, math.ceil(min_support * total - 1e-9))
    singles = b.groupBy(item).agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= min_count)
    frequent_b = _checkpoint(b.join(singles.select(item), item, "left_semi"))
    held = block_pairs(frequent_b, basket, item, block=block).select(basket, F.array(f"{item}_a", f"{item}_b").alias("items"))
    found = singles.select(F.array(F.col(item)).alias("items"), F.lit(1).alias("size"), "freq")
    size, links = 2, None
    while True:
        level = _checkpoint(held.groupBy("items").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= min_count))
        if not level.take(1):
            return found
        found = found.unionByName(level.select("items", F.lit(size).alias("size"), "freq"))
        if links is None:  # pairs frequent together: what may follow an item
            links = level.select(F.col("items")[0].alias("__last"), F.col("items")[1].alias("__next"))
        # baskets that hold a frequent set of this size, each set with the items that may follow its last one
        kept = _checkpoint(held.join(level.select("items"), "items", "left_semi"))
        more = kept.withColumn("__last", F.element_at("items", -1)).join(links, "__last")
        nxt = frequent_b.select(F.col(basket).alias("__basket"), F.col(item).alias("__item"))
        held = more.join(nxt, (F.col(basket) == F.col("__basket")) & (F.col("__next") == F.col("__item"))).select(
            basket, F.concat("items", F.array("__next")).alias("items")
        )
        size += 1


def association_rules(itemsets: DataFrame, total_baskets: int) -> DataFrame:
    """GRF-03 rules a -> b from size-2 itemsets: confidence and lift; ``itemset_rules`` has those of every size."""
    singles = itemsets.where(F.col("size") == 1).select(F.col("items")[0].alias("item"), F.col("freq").alias("item_freq"))
    pairs = itemsets.where(F.col("size") == 2)
    both = pairs.select(F.col("items")[0].alias("antecedent"), F.col("items")[1].alias("consequent"), "freq").unionByName(
        pairs.select(F.col("items")[1].alias("antecedent"), F.col("items")[0].alias("consequent"), "freq")
    )
    s = singles
    out = both.join(s.select(F.col("item").alias("antecedent"), F.col("item_freq").alias("ante_freq")), "antecedent").join(
        s.select(F.col("item").alias("consequent"), F.col("item_freq").alias("cons_freq")), "consequent"
    )
    return out.withColumns(
        {
            "confidence": F.col("freq").cast("double") / F.col("ante_freq").cast("double"),
            "lift": F.col("freq").cast("double") * F.lit(float(total_baskets))
            / (F.col("ante_freq").cast("double") * F.col("cons_freq").cast("double")),
        }
    )


def itemset_rules(itemsets: DataFrame, total_baskets: int) -> DataFrame:
    """GRF-03 rules {a, b, ..} -> c from itemsets of every size: each item of a
    set as the consequent of the rest (``antecedent``, a sorted array)."""
    sets = itemsets.where(F.col("size") > 1).select("items", "freq", F.explode("items").alias("consequent"))
    rules = sets.select(F.expr("array_remove(items, consequent)").alias("antecedent"), "consequent", "freq")
    ante = itemsets.select(F.col("items").alias("antecedent"), F.col("freq").alias("ante_freq"))
    cons = itemsets.where(F.col("size") == 1).select(F.col("items")[0].alias("consequent"), F.col("freq").alias("cons_freq"))
    freq, af, cf = (F.col(c).cast("double") for c in ("freq", "ante_freq", "cons_freq"))
    return rules.join(ante, "antecedent").join(cons, "consequent").withColumns(
        {"confidence": freq / af, "lift": freq * F.lit(float(total_baskets)) / (af * cf)}
    )


def jaccard_similarity(
    interactions: DataFrame,
    *,
    entity: str = "customer_id",
    item: str = "product_id",
    threshold: float = 0.5,
    block: int = SP.BLOCK,
    links_only: bool = False,
) -> DataFrame:
    """GRF-04 / JON-06: all entity pairs with Jaccard(items) >= ``threshold``.

    Exact. The sets are cut into hash blocks of about ``block`` entities; every
    two blocks meet in one task, which counts what their sets share and gives out
    only the pairs that reach the threshold (:mod:`set_pairs`). Candidates
    are neither written nor shuffled: the shuffle holds each set once a block, so
    it grows with entities x blocks. An entity's items are one row.

    Output: entity_a < entity_b, sizes, intersection, jaccard. With
    ``links_only``, of each meeting's pairs only as many as connect what they
    all connect: enough for components, and at most the entities of two blocks.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    sets = interactions.where(F.col(entity).isNotNull() & F.col(item).isNotNull()).select(F.lit(0).alias("group"), F.col(entity).alias("entity"), F.col(item).alias("item"))
    sets = _checkpoint(sets.groupBy("group", "entity").agg(F.collect_set("item").alias("items")))
    blocks = max(1, math.ceil(sets.count() / block))
    found = SP.similar_pairs(SP.meetings(sets, blocks=F.lit(blocks)), threshold, links_only=links_only)
    return found.withColumnsRenamed({"entity_a": f"{entity}_a", "entity_b": f"{entity}_b"})


def _checkpoint(df: DataFrame) -> DataFrame:
    ensure_shared_dir(df.sparkSession)
    with freed_shuffles(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


#: Edges of a partition and of a slice of ``label_propagation`` and ``pagerank``.
EDGES, SLICE = 1_000_000, 250_000_000


class _Laid:
    """Edges u -> v in tables by slices of v, each dealt by u into ``parts`` files, so that joins by u leave them where they are."""

    def __init__(self, spark: SparkSession, slices: list[DataFrame], parts: int, top: str):
        self.spark, self.slices, self.parts, self.top, self.steps = spark, slices, parts, top, 0

    def slice_of(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(len(self.slices)))

    def sources(self) -> DataFrame:
        """(vertex, outdeg): every u with its edges of a slice, a row for each such slice."""
        return _union([e.groupBy(F.col("u").alias("vertex")).agg(F.count(F.lit(1)).alias("outdeg")) for e in self.slices])

    def stashed(self, found: list[DataFrame], *, replace: bool = False) -> DataFrame:
        """Each of ``found`` in files, one after another, as one; with ``replace`` the last ones, which they were made from, go."""
        self.steps += 1
        at = f"{self.top}/{self.steps}"
        for n, df in enumerate(found):
            stash(df, f"{at}/{n}")
        if replace:
            discard(self.spark, f"{self.top}/{self.steps - 1}")
        return self.spark.read.schema(found[0].schema).parquet(*[f"{at}/{n}" for n in range(len(found))])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@contextmanager
def _laid(edges: DataFrame, *, both: bool) -> Iterator[_Laid]:
    """``edges`` (u, v, and perhaps a weight w, summed for an edge given more than once) laid for the rounds inside.

    ``both``: in both directions. A round shuffles what a slice's edges carry
    and keeps its result in files before the next slice, so that disk holds
    the edges once and the messages of ``SLICE`` of them. Tables with buckets
    keep the edges: files hold how rows were dealt only there.
    """
    spark, weighted = edges.sparkSession, "w" in edges.columns
    top, tables = shared_path(spark, "edges", unique=True), []
    if both:
        edges = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), *(["w"] if weighted else []))
    edges = stash(edges, f"{top}/given")
    n = edges.count() * (2 if both else 1)
    slices = max(1, math.ceil(n / SLICE))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / slices / EDGES))
    if both:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), *(["w"] if weighted else [])))
    laid = _Laid(spark, [edges] * slices, parts, f"{top}/steps")
    try:
        for k in range(slices):
            mine = (edges.where(laid.slice_of("v") == k) if slices > 1 else edges).repartition(parts, "u")
            mine = mine.groupBy("u", "v").agg(F.sum("w").alias("w")) if weighted else mine.distinct()
            name = f"edges_{uuid.uuid4().hex}"
            with freed_shuffles(spark):
                mine.select("*").write.bucketBy(parts, "u").sortBy("u").option("path", f"{top}/{name}").option("compression", "zstd").saveAsTable(name)
            tables.append(name)
            laid.slices[k] = spark.table(name)
        discard(spark, f"{top}/given")
        yield laid
    finally:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            discard(spark, f"{top}/{name}")


def connected_components(edges: DataFrame, *, src: str = "src", dst: str = "dst", vertices: DataFrame | None = None) -> DataFrame:
    """GRF-05: component label (= smallest vertex id) per vertex.

    Alternating large-star / small-star rounds (Kiveris et al., "Connected
    Components in MapReduce and Beyond", 2014): each round is a grouped
    ``min`` (combinable, so a hub vertex is pre-aggregated) and a join; the
    edge set converges to one star per component, centred on its smallest
    vertex, in O(log^2 n) rounds instead of one round per unit of graph
    diameter. Lineage is cut with a reliable checkpoint every round; rounds go
    on until no edge changes. ``vertices`` (one column) adds vertices without
    an edge, each its own component.
    """
    alone = vertices
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where(F.col("u") != F.col("v"))
    e = _checkpoint(e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    vertices = e.select(F.col("u").alias("vertex")).unionByName(e.select(F.col("v").alias("vertex"))).distinct()

    def large_star(cur: DataFrame) -> DataFrame:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(m, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.where(F.col("u") != F.col("v")).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()

    def small_star(cur: DataFrame) -> DataFrame:
        # orient every edge towards its smaller end: (hi, lo)
        down = cur.select(F.col("v").alias("u"), F.col("u").alias("v"))
        m = down.groupBy("u").agg(F.min("v").alias("m"))
        j = down.join(m, "u")
        out = j.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            m.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        return out.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()

    def mark(cur: DataFrame):
        return cur.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    seen = mark(e)
    while seen[0]:
        e = _checkpoint(small_star(large_star(e)))
        now = mark(e)
        if now == seen:
            break
        seen = now
    # stars: every non-centre vertex has one edge to its centre (the minimum)
    labels = e.groupBy("v").agg(F.min("u").alias("label")).select(F.col("v").alias("vertex"), "label")
    if alone is not None:
        vertices = vertices.unionByName(alone.select(F.col(alone.columns[0]).alias("vertex")).where("vertex IS NOT NULL")).distinct()
    return vertices.join(labels, "vertex", "left").select("vertex", F.coalesce("label", "vertex").alias("label"))


def label_propagation(
    edges: DataFrame, *, src: str = "src", dst: str = "dst", weight: str | None = None, rounds: int = 5
) -> DataFrame:
    """GRF-05: communities by ``rounds`` synchronous rounds of label propagation.

    Every vertex of the undirected graph starts with its own id as label; in
    each round it takes the label with the largest summed weight among its
    neighbours, ties to the smallest label. Edges with a NULL end and loops
    don't count; an edge given more than once weighs the sum. The edges lie
    by neighbour once and for all (:func:`_laid`); a round joins the labels to
    them where they are and sends each edge's vote to its vertex, one shuffle
    of a slice's edges.
    """
    w = F.col(weight) if weight else F.lit(1)
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v"), w.alias("w")).where(F.col("u") != F.col("v"))
    with _laid(e, both=True) as laid:
        labels = laid.stashed([laid.sources().select("vertex", F.col("vertex").alias("label")).distinct()])
        for _ in range(rounds):
            near = labels.select(F.col("vertex").alias("u"), "label").hint("shuffle_hash")
            found = []
            for e in laid.slices:
                votes = e.join(near, "u").select("v", "label", "w").repartition(laid.parts, "v").groupBy("v", "label").agg(F.sum("w").alias("votes"))
                most = votes.groupBy("v").agg(F.min(F.struct(-F.col("votes"), "label")).alias("m"))
                found.append(most.select(F.col("v").alias("vertex"), F.col("m.label").alias("label")))
            labels = laid.stashed(found, replace=True)
    return labels


def degrees(edges: DataFrame, *, src: str = "src", dst: str = "dst", weight: str | None = None) -> DataFrame:
    """GRF-06: degree (and weighted degree) per vertex of an undirected edge list."""
    w = F.col(weight) if weight else F.lit(1)
    both = edges.select(F.col(src).alias("vertex"), w.alias("w")).unionByName(edges.select(F.col(dst).alias("vertex"), w.alias("w")))
    return both.groupBy("vertex").agg(F.count(F.lit(1)).alias("degree"), F.sum("w").alias("weighted_degree"))


def pagerank(
    edges: DataFrame,
    *,
    src: str = "src",
    dst: str = "dst",
    iterations: int = 10,
    damping: float = 0.85,
    undirected: bool = True,
) -> DataFrame:
    """GRF-06: PageRank by fixed iterations of join + grouped sum.

    rank'(v) = (1 - d) / N + d * Σ_{u -> v} rank(u) / outdeg(u). Vertices
    with no out-edges keep only the teleport term (their mass is not
    redistributed). The edges lie by source for all rounds (:func:`_laid`):
    only ranks and sums are shuffled, those of a slice's edges at once.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where(F.col("u") != F.col("v"))
    with _laid(e, both=undirected) as laid:
        ends = laid.sources()
        if not undirected:
            ends = ends.unionByName(_union(laid.slices).select(F.col("v").alias("vertex"), F.lit(0).cast("long").alias("outdeg")).distinct())
        vertices = laid.stashed([ends.groupBy("vertex").agg(F.sum("outdeg").alias("outdeg"))])
        n = max(1, vertices.count())
        ranks = vertices.withColumn("rank", F.lit(1.0 / n))
        for step in range(iterations):
            given = ranks.where("outdeg > 0").select(F.col("vertex").alias("u"), (F.col("rank") / F.col("outdeg")).alias("share")).hint("shuffle_hash")
            found = []
            for k, e in enumerate(laid.slices):
                contrib = e.join(given, "u").groupBy(F.col("v").alias("vertex")).agg(F.sum("share").alias("s"))
                mine = vertices.where(laid.slice_of("vertex") == k).join(contrib, "vertex", "left")
                rank = F.lit((1.0 - damping) / n) + F.lit(damping) * F.coalesce(F.col("s"), F.lit(0.0))
                found.append(mine.select("vertex", "outdeg", rank.alias("rank")))
            ranks = laid.stashed(found, replace=step > 0)
    return ranks.select("vertex", "rank")


def als_factors(
    interactions: DataFrame,
    *,
    user: str = "customer_id",
    item: str = "product_id",
    rank: int = 8,
    max_iter: int = 5,
    reg: float = 0.1,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """GRF-07: implicit-feedback ALS embeddings: (user factors, item factors).

    Ratings are interaction counts per (user, item). ALS needs integer ids:
    ids of any type are numbered from 0 by a distributed count (:func:`dense_ids`)
    and the factors carry the ids as they were. NULL ids take no part.
    """
    model, users, items, _ = _als(interactions, user, item, rank, max_iter, reg, seed)
    return (
        model.userFactors.join(users, F.col("id") == F.col("__u")).select(user, "features"),
        model.itemFactors.join(items, F.col("id") == F.col("__i")).select(item, "features"),
    )


#: Ratings of a block of ALS; a task holds about four copies of a block's while it is built.
RATINGS = 4_000_000


def _als_blocks(ratings: int) -> int:
    """Blocks of users, and of items: Spark's 10, or as many as keep a block at ``RATINGS``."""
    return max(10, math.ceil(ratings / RATINGS))


def _als(interactions: DataFrame, user: str, item: str, rank: int, max_iter: int, reg: float, seed: int):
    """(model, users, items, ratings): users and items with their numbers, ratings by number."""
    from pyspark.ml.recommendation import ALS

    spark = interactions.sparkSession
    ensure_shared_dir(spark)
    top = shared_path(spark, "als", unique=True)
    counts = interactions.where(F.col(user).isNotNull() & F.col(item).isNotNull()).groupBy(user, item).agg(
        F.count(F.lit(1)).cast("float").alias("rating")
    )
    counts = stash(counts, f"{top}/counts")  # both numberings and the ratings start from it
    users, items = (stash(dense_ids(counts, of, name), f"{top}/{name}") for of, name in ((user, "__u"), (item, "__i")))
    ratings = stash(counts.join(users, user).join(items, item).select("__u", "__i", "rating"), f"{top}/ratings")
    discard(spark, f"{top}/counts")
    blocks = _als_blocks(ratings.count())
    model = ALS(
        rank=rank, maxIter=max_iter, regParam=reg, implicitPrefs=True, seed=seed,
        userCol="__u", itemCol="__i", ratingCol="rating", coldStartStrategy="drop",
        numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=1,  # a checkpoint removes the shuffles before it
    ).fit(ratings)
    return model, users, items, ratings


def als_recommend(
    interactions: DataFrame,
    *,
    user: str = "customer_id",
    item: str = "product_id",
    k: int = 5,
    rank: int = 8,
    max_iter: int = 5,
    reg: float = 0.1,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """GRF-07 used: (recommendations, fit) of the embeddings.

    recommendations: user, rank, item, score - the ``k`` largest products of
    factors for each user (:func:`best_products`). fit: one row with
    ``known_score``, the mean product over known pairs, and ``mean_score``, the
    mean over all pairs, which is the product of the mean factors, so no pair
    has to be made for it.
    """
    model, users, items, ratings = _als(interactions, user, item, rank, max_iter, reg, seed)
    found = best_products(model.userFactors, model.itemFactors, k).join(users, F.col("user") == F.col("__u")).join(items, F.col("item") == F.col("__i"))
    found = found.select(users[user], "rank", items[item], "score")
    u, v = (f.select(F.col("id").alias(n), F.col("features").alias(f"{n}f")) for f, n in ((model.userFactors, "__u"), (model.itemFactors, "__i")))
    product = F.aggregate(F.zip_with("__uf", "__if", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, x: a + x)
    known = ratings.join(u, "__u").join(v, "__i").agg(F.avg(product).alias("known_score"))
    mean = lambda f, n: f.agg(*[F.avg(F.col(f"{n}f")[d].cast("double")).alias(f"{n}{d}") for d in range(rank)])
    one = known.join(mean(u, "__u")).join(mean(v, "__i"))  # one row each
    return found, one.select("known_score", sum((F.col(f"__u{d}") * F.col(f"__i{d}") for d in range(rank)), F.lit(0.0)).alias("mean_score"))


#: Most users and items of one block of ``best_products``, and fewest meetings of blocks wanted. A side is copied once for each block of the other.
USERS, ITEMS, MEETINGS = 1 << 18, 1 << 20, 64


def best_blocks(users: int, items: int) -> tuple[int, int]:
    """Blocks of users and of items: no more than their sizes and ``MEETINGS`` ask for, and 1024 users a block at least."""
    items_of = math.ceil(items / ITEMS)
    return min(math.ceil(users / 1024), max(math.ceil(users / USERS), math.ceil(MEETINGS / items_of))), items_of


def best_products(users: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(user, item, score, rank): for each user the ``k`` items with the largest products of factors, ties to the smaller item.

    Both sides are (id, features). Every block of users meets every block of
    items in one task, which goes through the items by falling length of their
    factors and leaves a user alone as soon as no further item can be among its
    best (:mod:`top_products`); a user's best of each block are then ranked.
    """
    n, m = (max(1, f.count()) for f in (users, items))
    users_of, items_of = best_blocks(n, m)
    own = lambda f, parts: f.select("id", "features", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("b"))
    spread = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = own(users, users_of).select("id", "features", F.col("b").alias("ub"), spread(items_of).alias("ib"))
    right = own(items, items_of).select("id", "features", spread(users_of).alias("ub"), F.col("b").alias("ib"))
    each = left.groupBy("ub", "ib").cogroup(right.groupBy("ub", "ib")).applyInArrow(TP.best_of_blocks(k), "user int, best array<struct<score: float, item: int>>")
    best = lambda one, two: F.when(one["score"] != two["score"], F.when(one["score"] > two["score"], -1).otherwise(1)).otherwise(
        F.when(one["item"] < two["item"], -1).otherwise(1))
    ranked = each.groupBy("user").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best")), best), 1, k).alias("best"))
    ranked = ranked.select("user", F.posexplode("best").alias("at", "b"))
    return ranked.select("user", "b.item", F.col("b.score").cast("double").alias("score"), (F.col("at") + 1).alias("rank"))


def dense_ids(df: DataFrame, column: str, name: str, *, buckets: int = 256) -> DataFrame:
    """The distinct values of ``column`` with a number from 0 in ``name``.

    Values are ranked within hash buckets and each bucket starts after the
    values of the buckets before it, so no task sorts them all.
    """
    d = df.select(column).distinct().withColumn("__b", F.pmod(F.xxhash64(column), F.lit(buckets)))
    sizes = d.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # over ``buckets`` rows
    starts = sizes.select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    rank = F.row_number().over(Window.partitionBy("__b").orderBy(column)) - 1
    return d.withColumn("__r", rank).join(starts, "__b").select(column, (F.col("__start") + F.col("__r")).cast("int").alias(name))


def top_k_related(
    pairs: DataFrame,
    *,
    k: int = 5,
    item: str = "product_id",
    score: str = "pair_orders",
) -> DataFrame:
    """WIN-03: top-k partners per item from symmetric pair scores
    (ties broken by partner id)."""
    both = pairs.select(F.col(f"{item}_a").alias(item), F.col(f"{item}_b").alias("related_id"), F.col(score).alias("score")).unionByName(
        pairs.select(F.col(f"{item}_b").alias(item), F.col(f"{item}_a").alias("related_id"), F.col(score).alias("score"))
    )
    return top_n_per_group(both, item, [F.desc("score"), F.asc("related_id")], k, salt_on="related_id")


def recommend_items(
    pairs: DataFrame,
    products: DataFrame,
    popularity: DataFrame,
    *,
    k: int = 5,
    item: str = "product_id",
    category: str = "category",
    score: str = "pair_orders",
) -> DataFrame:
    """GRF-08: k recommendations per product: co-purchase partners first,
    then the category's best sellers (not already chosen, not itself).

    Fallback candidates come from each category's top ``2k + 1`` sellers
    only (enough to fill k slots after removing itself and up to k chosen
    partners), so the fallback is O(products x k), not all pairs of a
    category.
    """
    co = top_k_related(pairs, k=k, item=item, score=score).select(
        item, "related_id", F.lit(0).alias("tier"), F.col("score").cast("double").alias("score")
    )
    pop = products.select(item, category).join(popularity.select(item, F.col("units").cast("double").alias("pop")), item, "left")
    pop = pop.withColumn("pop", F.coalesce("pop", F.lit(0.0)))
    best = top_n_per_group(pop, category, [F.desc("pop"), F.asc(item)], 2 * k + 1, rank_column="__r", salt_on=item).select(
        category, F.col(item).alias("related_id"), F.col("pop").alias("score")
    )
    fallback = (
        products.select(item, category)
        .join(best, category)
        .where(F.col(item) != F.col("related_id"))
        .select(item, "related_id", F.lit(1).alias("tier"), "score")
    )
    cands = co.unionByName(fallback)
    # a partner that is also a category best seller keeps its co-purchase tier
    cands = cands.groupBy(item, "related_id").agg(F.min(F.struct("tier", F.col("score"))).alias("__t")).select(
        item, "related_id", "__t.tier", "__t.score"
    )
    return top_n_per_group(cands, item, [F.asc("tier"), F.desc("score"), F.asc("related_id")], k, salt_on="related_id")


def attribute_similar(
    products: DataFrame,
    popularity: DataFrame,
    *,
    k: int = 5,
    item: str = "product_id",
    category: str = "category",
    brand: str = "brand",
) -> DataFrame:
    """GRF-09: k related products per product - same category first, then
    same brand (other category), each tier by popularity then id.

    Candidates are limited to each category's top k+1 and each brand's top
    2k+2 products: a category with more than k other members fills all k
    slots from its own top k+1; otherwise at most k+1 of the brand's
    products share the category, so its top 2k+2 hold k others. Exact top-k
    without enumerating pairs inside a category or brand.
    """
    p = products.select(item, category, brand).join(
        popularity.select(item, F.col("units").cast("double").alias("pop")), item, "left"
    ).withColumn("pop", F.coalesce("pop", F.lit(0.0)))
    top_cat = top_n_per_group(p, category, [F.desc("pop"), F.asc(item)], k + 1, rank_column="__r", salt_on=item)
    top_brand = top_n_per_group(p, brand, [F.desc("pop"), F.asc(item)], 2 * k + 2, rank_column="__r", salt_on=item)
    base = p.select(item, category, brand)
    c1 = base.join(
        top_cat.select(category, F.col(item).alias("related_id"), F.col("pop").alias("score")), category
    ).select(item, "related_id", F.lit(0).alias("tier"), "score")
    c2 = (
        base.join(
            top_brand.select(brand, F.col(item).alias("related_id"), F.col(category).alias("__rc"), F.col("pop").alias("score")), brand
        )
        .where(~F.col("__rc").eqNullSafe(F.col(category)))
        .select(item, "related_id", F.lit(1).alias("tier"), "score")
    )
    cands = c1.unionByName(c2).where(F.col(item) != F.col("related_id"))
    return top_n_per_group(cands, item, [F.asc("tier"), F.desc("score"), F.asc("related_id")], k, salt_on="related_id")
