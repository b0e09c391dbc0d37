"""Set similarity by locality-sensitive hashing (GRF-04 at scale).

``graph.jaccard_similarity`` is exact, but on dense data its candidates come
near to all pairs. Here entities are banded by minimum hashes of their items:
two entities become candidates if they agree in all ``rows`` hashes of some
band, which happens with probability 1 - (1 - J^rows)^bands. Candidates are
verified exactly, so a pair that is returned is right; ``recall`` is the share of
pairs at the threshold that the bands find (more of those above it).

Entities with the same items are one class and meet others once, through the
smallest of them: copies make no pairs. The sets of a bucket, or of two blocks of
a large one, are compared where they meet (:mod:`set_pairs`): a pair leaves its
task only if it reaches the threshold, once for each bucket that both share.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_spark.operators import set_pairs as SP
from retail_spark.operators.graph import DEFAULT_BLOCK, block_pairs
from retail_spark.session import ensure_shared_dir

#: Hashes that one aggregation computes; Spark compiles up to 100 fields.
HASHES = 90


def bands_for(threshold: float, rows: int, recall: float) -> int:
    """Fewest bands of ``rows`` hashes that find a pair at ``threshold`` with probability ``recall``."""
    if not (0 < threshold <= 1 and 0 < recall < 1 and rows > 0):
        raise ValueError("threshold must be in (0, 1], recall in (0, 1), rows positive")
    if threshold == 1:
        return 1
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def _kept(df: DataFrame) -> DataFrame:
    ensure_shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def item_sets(interactions: DataFrame, *, entity: str, item: str) -> DataFrame:
    """Distinct (entity, item); NULLs take no part."""
    return interactions.where(F.col(entity).isNotNull() & F.col(item).isNotNull()).select(entity, item).distinct()


def classes(sets: DataFrame, *, entity: str, item: str) -> DataFrame:
    """(entity, representative, size): entities with the same items share their smallest one as representative."""
    named = sets.groupBy(entity).agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64(F.lit(1), item)).alias("__h1"), F.bit_xor(F.xxhash64(F.lit(2), item)).alias("__h2"))
    same = ["size", "__h1", "__h2"]
    first = named.groupBy(*same).agg(F.min(entity).alias("representative"))
    return named.join(first, same).select(entity, "representative", "size")


def band_members(sets: DataFrame, *, entity: str, item: str, bands: int, rows: int) -> DataFrame:
    """(bucket, entity) for each band: the hash of the band's minimum hashes."""
    out, at_once = None, max(1, HASHES // rows)
    for start in range(0, bands, at_once):
        mine = range(start, min(bands, start + at_once))
        lows = sets.groupBy(entity).agg(*[F.min(F.xxhash64(F.lit(b * rows + r), F.col(item))).alias(f"m{b}_{r}") for b in mine for r in range(rows)])
        keys = F.array(*[F.xxhash64(F.lit(b), *[F.col(f"m{b}_{r}") for r in range(rows)]) for b in mine])
        part = lows.select(entity, F.explode(keys).alias("bucket"))
        out = part if out is None else out.unionByName(part)
    return out


def lsh_candidates(sets: DataFrame, *, entity: str, item: str, bands: int, rows: int, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Distinct (entity_a < entity_b) that share a bucket of some band."""
    members = band_members(sets, entity=entity, item=item, bands=bands, rows=rows)
    return block_pairs(members, "bucket", entity, block=block).select(f"{entity}_a", f"{entity}_b").distinct()


def jaccard_lsh(
    interactions: DataFrame,
    *,
    entity: str = "customer_id",
    item: str = "product_id",
    threshold: float = 0.5,
    rows: int = 5,
    recall: float = 0.95,
    block: int = SP.BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs of class representatives with Jaccard >= ``threshold``, and each entity's class.

    pairs: entity_a < entity_b, size_a, size_b, intersection, jaccard, exact.
    members: entity, representative, size. Members of one class have the same
    items. An empty input gives empty results.
    """
    sets = _kept(item_sets(interactions, entity=entity, item=item))
    members = _kept(classes(sets, entity=entity, item=item))
    chosen = members.where(F.col(entity) == F.col("representative")).select(entity, "size")
    alone = _kept(sets.join(chosen.select(entity), entity, "left_semi"))
    buckets = _kept(band_members(alone, entity=entity, item=item, bands=bands_for(threshold, rows, recall), rows=rows))
    # a bucket's sets meet in tasks and only pairs at the threshold leave them: no candidate is shuffled
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    whole = alone.groupBy(entity).agg(F.collect_set(item).alias("items"))
    placed = buckets.join(shared, "bucket").join(whole, entity).select(F.col("bucket").alias("group"), F.col(entity).alias("entity"), "items", "n")
    pairs = SP.similar_pairs(SP.meetings(placed, blocks=F.ceil(F.col("n") / F.lit(block))), threshold).distinct()
    return pairs.withColumnsRenamed({"entity_a": f"{entity}_a", "entity_b": f"{entity}_b"}), members
