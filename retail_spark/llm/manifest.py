"""Merkle manifest of a dataset, placed by ranks in bitmaps.

Every row is a leaf; each group's leaves stand in the order of their ids. No
sort finds that order: a group's ids are merged into a bitmap of 64-bit words
(``bit_or`` sums them before and after a shuffle; words without a bit are not
kept, which is its compression), and popcounts of the words, added up over
ranges of 2^16, 2^32 and 2^48 ids, are the directory. The rank of an id, the
number of ids before it, is four numbers of the directory and one popcount.

Ranks are coordinates: rank r stands in slot r mod ``SLOTS`` of the array
(group, r div ``SLOTS``), and an array is reduced by itself to one node. Those
nodes are the leaves of the next round, until each group has one. Then the
rounds are walked from the top: an array with the path of its own node gives
the paths of its slots, and at last each leaf's proof. A task holds one array
at a time.

Results for odd inputs: a null id orders before all ids and is never tampered
with; rows that share an id order by their leaf, rows alike in all five columns
by nothing, for their leaves are equal, and each is a leaf of its own; a null
group orders before the empty one; an empty table gives an empty result;
columns beyond the five are not read. Rows alike are one row with a count until
they get their ranks, so an id or a row that a third of the table repeats makes
no large group; other leaves under one repeated id are ranked by the first
four digits of the leaf, then within those.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from retail_spark.llm.common import stash

#: Levels that one array is reduced by, and its slots.
BITS = 12
SLOTS = 1 << BITS
#: Ranks that one row with a count is unfolded into at once.
UNFOLD = 65_536


def _part(value: Column) -> Column:
    """A value as it enters a leaf: its bytes' number, a colon and its text, or a hyphen."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _leaf(n_chars: Column) -> Column:
    parts = [_part(F.col("doc_id")), _part(F.col("source")), _part(F.col("lang")), _part(n_chars), _part(F.col("text"))]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """(grp, doc_id, leaf, tampered, m): the distinct leaves with their number of rows.

    ``grp`` is ``-`` for a null lang, else ``=`` and the lang, which orders as asked.
    ``tampered`` is the leaf with n_chars one higher where 7 divides the crc32 of the id.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "lang", F.col("n_chars").cast("bigint").alias("n_chars"), "text")
    hit = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    return (rows.select(F.when(F.col("lang").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("lang").cast("string"))).alias("grp"), "doc_id",
                        _leaf(F.col("n_chars")).alias("leaf"), F.when(hit, _leaf(F.col("n_chars") + 1)).alias("tampered"))
            .groupBy("grp", "doc_id", "leaf", "tampered").agg(F.count("*").alias("m")))


#: Bits below each level of the directory, and the value of a null id's top level: below all others.
_LEVELS, _NULL = (48, 32, 16, 6), -(2 ** 15) - 1


#: The id's place in its word.
_LOW = "cast(coalesce(doc_id & 63, 0) as int)"


def _keys() -> list[Column]:
    """The id's prefixes at the directory's levels; the shift keeps the sign, so prefixes order as ids do."""
    return [F.coalesce(F.shiftright("doc_id", bits), F.lit(_NULL << (48 - bits)).cast("bigint")).alias(f"k{bits}") for bits in _LEVELS]


def directory(ids: DataFrame) -> DataFrame:
    """(grp, k6, word, before): each word of the bitmaps and the number of rows of its group whose ids lie before the word.

    ``ids`` has distinct (grp, doc_id, extra), extra being the rows of an id beyond
    its first. Each level adds up the level below within its parent, so a window
    spans at most 2^16 rows.
    """
    words = ids.select("grp", "extra", *_keys(), F.expr(f"shiftleft(1L, {_LOW})").alias("bit")).groupBy("grp", "k48", "k32", "k16", "k6").agg(
        F.bit_or("bit").alias("word"), F.sum("extra").alias("extra"))
    level = stash(words.withColumn("n", F.bit_count("word") + F.col("extra")), "words")
    out = level
    for n, bits in enumerate(_LEVELS):
        above, own = ["grp", *(f"k{b}" for b in _LEVELS[:_LEVELS.index(bits)])], f"k{bits}"
        sums = level.groupBy(*above, own).agg(F.sum("n").alias("n"))
        before = F.sum("n").over(Window.partitionBy(*above).orderBy(own).rowsBetween(Window.unboundedPreceding, -1))
        sums = sums.select(*above, own, F.coalesce(before, F.lit(0)).alias(f"b{n}"))
        out = out.join(sums, [*above, own])
    return out.select("grp", "k6", "word", sum((F.col(f"b{n}") for n in range(1, len(_LEVELS))), F.col("b0")).alias("before"))


def placed(found: DataFrame) -> DataFrame:
    """(grp, pos, doc_id, leaf, tampered): every row of the table at its rank in its group."""
    found = stash(found, "leaves")
    ids = found.groupBy("grp", "doc_id").agg(F.sum("m").alias("n"), F.count("*").alias("kinds"))
    ids = stash(ids.select("grp", "doc_id", (F.col("n") - 1).alias("extra"), "kinds"), "ids")
    ids = ids.withColumn("low", F.expr(_LOW)).withColumn("k6", _keys()[-1])
    # rows that repeat an earlier id of the same word: few or none, at most 64 ids a word
    repeats = ids.filter("extra > 0").groupBy("grp", "k6").agg(F.collect_list(F.struct("low", "extra")).alias("repeats"))
    start = F.expr("before + bit_count(word & ~shiftleft(-1L, low)) + coalesce(aggregate(filter(repeats, x -> x.low < low), 0L, (a, x) -> a + x.extra), 0L)")
    start = ids.join(directory(ids), ["grp", "k6"]).join(repeats, ["grp", "k6"], "left").select("grp", "doc_id", "kinds", start.alias("start"))
    same = F.col("f.grp").eqNullSafe(F.col("s.grp")) & F.col("f.doc_id").eqNullSafe(F.col("s.doc_id"))
    rows = found.alias("f").join(start.alias("s"), same).select("f.*", "kinds", "start")
    one, many = rows.filter("kinds = 1").drop("kinds"), rows.filter("kinds > 1").drop("kinds").withColumn("digits", F.substring("leaf", 1, 2))
    within = F.sum("m").over(Window.partitionBy("grp", "doc_id", "digits").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1))
    sums = many.groupBy("grp", "doc_id", "digits").agg(F.sum("m").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("grp", "doc_id").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col("grp").alias("g"), F.col("doc_id").alias("d"), F.col("digits").alias("x"), F.coalesce(ahead, F.lit(0)).alias("ahead"))
    many = many.join(sums, (F.col("grp") == F.col("g")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("digits") == F.col("x")))
    many = many.withColumn("start", F.col("start") + F.col("ahead") + F.coalesce(within, F.lit(0))).select(*one.columns)
    each = one.union(many)
    # a row with a count becomes as many rows, in two steps
    lot = F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1, F.lit(UNFOLD).cast("bigint"))
    lots = each.filter("m > 1").withColumn("lot", F.explode(lot))
    lots = lots.repartition(F.col("grp"), F.col("start"), F.col("lot")).withColumn(
        "pos", F.explode(F.transform(F.sequence(F.col("lot"), F.least(F.col("lot") + UNFOLD, F.col("m")) - 1), lambda x: x + F.col("start"))))
    columns = ["grp", "doc_id", "leaf", "tampered"]
    return each.filter("m = 1").select(*columns, F.col("start").alias("pos")).union(lots.select(*columns, "pos"))


def _join(nodes: list[str]) -> str:
    """H of a run's digests, in hex."""
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _levels(nodes: list[str], total: int) -> list[list[str]]:
    """An array's nodes level by level; ``total`` nodes of the whole group decide whether a lone node is hashed on."""
    out, left = [nodes], SLOTS
    while total > 1 and left > 1:
        last = out[-1]
        out.append([_join(last[k : k + 2]) for k in range(0, len(last), 2)])
        total, left = (total + 1) // 2, left // 2
    return out


def _path(levels: list[list[str]], slot: int) -> str:
    """From a slot upwards: the sibling's digest after ``<`` if it stands left, ``>`` if right; ``.`` without one."""
    out = []
    for nodes in levels[:-1]:
        other = slot ^ 1
        out.append("." if other >= len(nodes) else ("<" if other < slot else ">") + nodes[other])
        slot >>= 1
    return "".join(out)


def _steps(path: str) -> list[tuple[str, str]]:
    """(side, sibling) of each level of a path."""
    out, at = [], 0
    while at < len(path):
        size = 0 if path[at] == "." else 64
        out.append((path[at], path[at + 1 : at + 1 + size]))
        at += 1 + size
    return out


def folded(node: str, path: str) -> str:
    """The root that a node and its path give."""
    for side, other in _steps(path):
        node = _join([other, node] if side == "<" else [node, other] if side == ">" else [node])
    return node


def _array(table: pa.Table, name: str) -> tuple[list[str], list[int]]:
    """The digests of one array in slot order, and for each row of the table its slot."""
    slots = [p % SLOTS for p in table.column("pos").to_pylist()]
    nodes = [""] * len(slots)
    for slot, node in zip(slots, table.column(name).to_pylist()):
        nodes[slot] = node.hex()
    return nodes, slots


def _reduced(key, table):
    """One array's node."""
    nodes, _ = _array(table, "node")
    top = _levels(nodes, table.column("total")[0].as_py())[-1][0]
    return pa.table({"grp": [key[0].as_py()], "pos": pa.array([key[1].as_py()], pa.int64()), "node": pa.array([bytes.fromhex(top)], pa.binary()),
                     "total": pa.array([-(-table.column("total")[0].as_py() // SLOTS)], pa.int64())})


NODE = "grp string, pos bigint, node binary, total bigint"


def _arrays(rows: DataFrame):
    return rows.groupBy("grp", F.shiftright("pos", BITS).alias("array"))


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """The rounds of (grp, pos, node, total), from ``nodes`` to one node a group; ``total`` is the group's nodes in that round."""
    out = [nodes]
    while (out[-1].agg(F.max("total")).first()[0] or 0) > 1:
        out.append(stash(_arrays(out[-1]).applyInArrow(_reduced, NODE), "nodes"))
    return out


def _paths(key, slots, tops):
    """Of one array: the path of each of its slots, from the slot to the end of its own node's path."""
    nodes, at = _array(slots, "node")
    levels = _levels(nodes, slots.column("total")[0].as_py())
    rest = tops.column("path")[0].as_py()
    return pa.table({"grp": slots.column("grp"), "pos": slots.column("pos"), "node": slots.column("node"), "path": [_path(levels, s) + rest for s in at]})


PATH = "grp string, pos bigint, node binary, path string"


def paths(below: list[DataFrame], top: DataFrame) -> DataFrame:
    """(grp, pos, node, path) of ``below[0]`` up to the roots, whose own paths are ``top`` (grp, pos, path)."""
    for nodes in reversed(below[1:-1]):
        top = stash(_walk(nodes, top, _paths, PATH), "paths")
    return top


def _walk(nodes: DataFrame, top: DataFrame, step, schema: str) -> DataFrame:
    return _arrays(nodes).cogroup(top.groupBy("grp", F.col("pos").alias("array"))).applyInArrow(step, schema)


def _proofs(key, slots, tops):
    """Of one array of leaves: the rows of the result."""
    nodes, at = _array(slots, "node")
    levels = _levels(nodes, slots.column("total")[0].as_py())
    rest, subroot, root = (tops.column(c)[0].as_py() for c in ("path", "subroot", "root"))
    proofs, tops_found = [], []
    for slot, tampered in zip(at, slots.column("tampered").to_pylist()):
        path = _path(levels, slot) + rest
        proofs.append(_join([other for _, other in _steps(path)]))
        tops_found.append(folded(nodes[slot] if tampered is None else tampered.hex(), path))
    n = len(at)
    return pa.table({"doc_id": slots.column("doc_id"), "leaf": [nodes[s] for s in at], "subroot": [subroot] * n, "root": [root] * n,
                     "proof_sha256": proofs, "folded_root": tops_found, "verified": [t == root for t in tops_found]})


RESULT = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs(doc_id, source, lang, n_chars, text)``."""
    rows = placed(leaves(docs)).withColumnRenamed("leaf", "node")
    sizes = rows.groupBy("grp").agg(F.count("*").alias("total"))
    rows = stash(rows.join(sizes, "grp"), "placed")
    of_groups = rounds(rows.select("grp", "pos", "node", "total"))
    # one row a group: the subroots, ordered by group
    ordered = Window.orderBy("grp")
    subroots = stash(of_groups[-1].select(F.col("grp").alias("name"), (F.row_number().over(ordered) - 1).cast("bigint").alias("pos"), "node",
                                          F.count("*").over(Window.partitionBy()).alias("total")), "subroots")
    if not subroots.take(1):
        return docs.sparkSession.createDataFrame([], RESULT)
    of_all = rounds(subroots.select(F.lit("").alias("grp"), "pos", "node", "total"))
    top = of_all[-1].select("grp", "pos", F.lit("").alias("path"))
    if len(of_all) > 1:
        top = _walk(subroots.select(F.lit("").alias("grp"), "pos", "node", "total"), paths(of_all, top), _paths, PATH)
    root = of_all[-1].select(F.lower(F.hex("node"))).first()[0]
    known = stash(subroots.join(top.select("pos", "path"), "pos")
                  .select(F.col("name").alias("grp"), F.lit(0).cast("bigint").alias("pos"), "path", F.lower(F.hex("node")).alias("subroot"), F.lit(root).alias("root")), "known")
    above = paths(of_groups, known.select("grp", "pos", "path"))
    above = above.select("grp", "pos", "path").join(known.select("grp", "subroot", "root"), "grp")
    return _walk(rows, above, _proofs, RESULT)
