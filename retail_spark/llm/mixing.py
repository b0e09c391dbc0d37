"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are put in a keyed random order and their words laid
end to end; the line is cut into blocks of equal size. A source whose target
needs K blocks gets K consecutive integers; all sources' integers together are
0 .. M-1, the cumulative weights. Slot ``i`` of the schedule belongs to the
integer that is ``i`` with its bits reversed (the van der Corput point ``i``,
scaled by the power of two at or above M), so any stretch of the schedule
holds each source in proportion to its weight, and each source has exactly its
K slots. The rank of a slot among its source's slots follows from the bits of
``i`` alone: no sort, no window, no state over the schedule. Slot of rank r
takes block ``r mod blocks`` of its source, in pass ``r div blocks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from retail_spark.llm.common import WORD, free_name, stash

#: The weights that sources get in turn, and the share of all words to take.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST_PASSES = 1.5, 2

#: Words in a block, and documents in one bucket of the shuffled order.
BLOCK, BUCKET = 256, 20_000
#: Slots that one row of the schedule expands to at a time.
STRIDE = 65_536
#: Words in one of the sorted ranges of mixed rows, as long as there are no more ranges than shuffle partitions.
RANGE = 2_000_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, *, weights=WEIGHTS, share: float = SHARE, most: float = MOST_PASSES) -> DataFrame:
    """(source, source_size, weight, target, place) for ``sizes(source, size)``.

    Sources stand in order of code points, null last, and weigh ``weights`` in
    turn. Targets share ``share`` of all words by weight; none exceeds ``most``
    times its source's words, the excess going to the others by weight until
    none is above. The fixed point is found directly: in order of words a unit
    of weight, the sources up to some place are at their limit and the
    rest divide what is left (the level is highest at the first of the rest).
    The windows here are over one row a source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1).cast("int")
    rows = by_source.withColumn("place", turn)
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1))
    rows = rows.withColumn("limit", F.col("source_size") * F.lit(float(most)))
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0))) * F.lit(float(share))
    by_need = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = F.coalesce(F.sum("limit").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("level", (total - before) / after)
    rows = rows.withColumn("open", F.col("limit") > F.col("weight") * F.col("level"))
    level = F.max(F.when(F.col("open"), F.col("level"))).over(Window.partitionBy(F.lit(0)))
    target = F.least(F.col("limit"), F.coalesce(F.col("weight") * level, F.col("limit")))
    return rows.select("source", "source_size", "weight", target.alias("target"), "place")


def _points_below(i: Column, point: Column, x: Column, bits: Column) -> Column:
    """How many of the numbers 0 .. i-1, bits reversed, are below ``x``; ``point`` is i reversed.

    The numbers below i fall into one run for each bit set in i: those that
    agree with i above the bit, have it clear and are free below. Reversed, a
    run is an arithmetic progression: it starts at the low bits of ``point``.
    """
    one = F.lit(1).cast("bigint")

    def run(total: Column, b: Column) -> Column:
        first = point.bitwiseAND(F.call_function("shiftleft", one, bits - 1 - b) - 1)
        step = F.call_function("shiftleft", one, bits - b)
        free = F.call_function("shiftleft", one, b)
        below = F.least(F.greatest(F.lit(0).cast("bigint"), F.floor((x - first + step - 1) / step).cast("bigint")), free)
        bit = F.call_function("shiftright", i, b).bitwiseAND(F.lit(1).cast("bigint"))
        return total + F.when(bit == 1, below).otherwise(F.lit(0).cast("bigint"))

    return F.aggregate(F.sequence(F.lit(0), bits - 1), F.lit(0).cast("bigint"), run)


def _reversed(i: Column, bits: Column) -> Column:
    """The lowest ``bits`` bits of i in reverse order."""
    return F.conv(F.reverse(F.lpad(F.bin(i), bits, F.lit("0"))), 2, 10).cast("bigint")


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(source, slot, rank, pass, block_no, words): the slots of the mix, in order of ``slot``.

    ``words`` is the block's size, less in a source's last block and in the
    last slot that its target needs.
    """
    goal = F.round("target").cast("bigint")
    full = F.col("source_size").cast("bigint")
    rows = (targets.filter("source_size > 0").withColumn("goal", goal).filter("goal > 0")
            .withColumn("blocks", F.ceil(full / F.lit(block)).cast("bigint"))
            .withColumn("passes", F.floor(F.col("goal") / full).cast("bigint"))
            .withColumn("over", F.col("goal") - F.col("passes") * full)
            .withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("over") / F.lit(block)).cast("bigint")))
    upto = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum("slots").over(upto)).withColumn("begin", F.col("end") - F.col("slots"))
    every = F.max("end").over(Window.partitionBy(F.lit(0)))
    rows = rows.withColumn("bits", F.greatest(F.lit(1), F.length(F.bin(every - 1))).cast("int"))
    rows = rows.withColumn("part", F.explode(F.expr(f"sequence(begin, end - 1, {STRIDE}L)")))
    # a fixed number: these few rows become very many, so they must not be merged into one task by their size
    spread = rows.repartition(int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col("part"))
    points = spread.withColumn("point", F.explode(F.expr(f"sequence(part, least(part + {STRIDE - 1}L, end - 1))")))
    points = points.withColumn("slot", _reversed(F.col("point"), F.col("bits")))
    below = [_points_below(F.col("slot"), F.col("point"), F.col(x), F.col("bits")) for x in ("end", "begin")]
    rank = below[0] - below[1]
    points = points.withColumn("rank", rank)
    points = (points.withColumn("pass", F.expr("rank div blocks")).withColumn("block_no", F.expr("rank % blocks")))
    held = F.least(F.lit(block).cast("bigint"), F.col("source_size") - F.col("block_no") * block)
    wanted = F.col("goal") - F.col("pass") * F.col("source_size") - F.col("block_no") * block
    return points.select("source", "slot", "rank", "pass", "block_no", F.least(held, wanted).cast("bigint").alias("words"))


def _laid_out(docs: DataFrame, seed: int) -> DataFrame:
    """The columns of ``docs`` and lo: where each document starts in its source's shuffled line.

    A source is sorted in buckets of its random order, each placed after the
    words of the buckets before it, so no task holds a whole source.
    """
    key = F.xxhash64(F.lit(seed), "doc_id", "row")
    parts = 1 + docs.count() // BUCKET
    placed = docs.withColumn("key", key)
    placed = placed.withColumn("part", F.expr(f"int(floor((key / 18446744073709551616D + 0.5D) * {parts}))"))
    sums = placed.groupBy("source", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "part").orderBy("key", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("in_part", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    return placed.select(*docs.columns, (F.col("base") + F.col("in_part")).cast("bigint").alias("lo"))


def pieces(sized: DataFrame, targets: DataFrame, *, block: int = BLOCK, seed: int = 17) -> DataFrame:
    """The columns of ``sized`` and slot, pass, start, length: the stretches of words that the slots take.

    ``sized`` has doc_id, source, size and row, a number that tells rows apart
    that share a doc_id (or the hash of their text).
    """
    line = _laid_out(sized, seed).filter("size > 0")
    cut = line.withColumn("block_no", F.explode(F.expr(f"sequence(lo div {block}, (lo + size - 1) div {block})")))
    slots = schedule(targets, block).withColumnRenamed("source", "of").withColumnRenamed("block_no", "at")
    # the slots come of a few rows, so Spark would guess them small enough to broadcast
    both = cut.join(slots.hint("merge"), F.col("source").eqNullSafe(F.col("of")) & (F.col("block_no") == F.col("at")))
    start = F.greatest(F.expr("0L"), F.col("block_no") * block - F.col("lo"))
    stop = F.least(F.col("size"), F.col("block_no") * block + F.col("words") - F.col("lo"))
    return (both.withColumn("start", start).withColumn("length", stop - F.col("start")).filter("length > 0")
            .select(*sized.columns, "slot", "pass", "start", "length"))


def sized_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, row): the words of each document; rows alike in all of these are one ``row`` value."""
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
                       F.xxhash64("text").alias("row"))


def mix(docs: DataFrame, *, block: int = BLOCK, seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken, first_slot.

    ``docs`` needs doc_id, text and source. ``size`` counts runs of anything
    but ASCII white space (null and empty texts: 0, taken 0). A null source is
    a source of its own, the last in order. ``first_slot`` is the place in the
    schedule at which the mix first takes words of the row, null if it takes
    none: read in that order, any stretch holds the sources in proportion.
    Rows alike in doc_id, source and
    text are documents of their own. An empty table gives an empty result.
    Reruns take the same words.
    """
    sized, targets, taken = _taken(docs, block, seed)
    taken = taken.groupBy("t_doc_id", "t_source", "t_row").agg(F.sum("length").alias("taken"), F.min("slot").alias("first_slot"))
    out = sized.join(taken, _same_row(), "left")
    per = targets.select(F.col("source").alias("p_source"), "source_size", "target")
    out = out.join(per, F.col("source").eqNullSafe(F.col("p_source")))
    return out.select("doc_id", "source", "size", F.col("source_size").cast("bigint").alias("source_size"), F.col("target"),
                      F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "first_slot")


def _same_row():
    same = [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in ("doc_id", "source", "row")]
    return same[0] & same[1] & same[2]


def _taken(docs: DataFrame, block: int, seed: int, *more: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes with rows told apart, targets, and the words taken of each row in each pass, with the columns ``more`` of the sizes."""
    sized = stash(sized_documents(docs), "sizes")
    targets = stash(source_targets(sized), "targets")
    sized = stash(_told_apart(sized), "sizes")
    taken = (pieces(sized, targets, block=block, seed=seed).groupBy("doc_id", "source", "row", "pass", *more)
             .agg(F.sum("length").alias("length"), F.min("slot").alias("slot")))
    of = [F.col(c).alias(f"t_{c}") for c in ("doc_id", "source", "row", *more)]
    return sized, targets, taken.select(*of, "pass", "length", "slot")


def _told_apart(sized: DataFrame) -> DataFrame:
    """``row`` hashed with a running number among rows alike, whose ``row`` stays as ``alike``."""
    alike = Window.partitionBy("doc_id", "source", "row").orderBy("size")
    return sized.withColumns({"alike": F.col("row"), "row": F.xxhash64("row", F.row_number().over(alike))})


def _in_ranges(slot: Column, ends: list[int]) -> Column:
    """How many of the sorted ``ends`` are not above ``slot``, by halving."""
    def place(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(slot < ends[middle], place(low, middle)).otherwise(place(middle + 1, high))

    return place(0, len(ends))


def mixed_documents(docs: DataFrame, *, block: int = BLOCK, seed: int = 17) -> DataFrame:
    """The mix as rows with the columns of ``docs``: one row for each pass that takes words of a document.

    Rows stand in the order of the schedule: each is placed by the first slot
    that takes its words in the pass, over sorted ranges of slots. A pass that
    takes all words of a document returns its row as it is. The last pass over
    a source can end inside a document; its row then holds the words up to
    there, and ``n_chars``, if there is such a column, their length. Documents
    without words, and those that the mix takes nothing of, go. Other columns
    are kept as they are, whatever their names.
    """
    names = list(docs.columns)
    _, _, taken = _taken(docs, block, seed, "alike", "size")
    taken = stash(taken, "taken")
    ends = _range_ends(taken)
    # names that no column of ``docs`` has, so that what is added can't clash with it
    source, alike, home, nth, takes = (free_name(docs, f"mix_{c}") for c in ("source", "alike", "home", "nth", "takes"))
    takes_of = taken.groupBy("t_doc_id", "t_source", "t_alike", "t_row").agg(F.collect_list(F.struct("length", "slot", "t_size")).alias(takes))
    takes_of = takes_of.select(F.col("t_doc_id").alias("doc_id"), F.col("t_source").alias(source), F.col("t_alike").alias(alike), takes)
    rows = docs.withColumns({source: F.col("source").cast("string"), alike: F.xxhash64("text")})
    # texts and takes go to one place by a hash, where the nth of the rows alike gets the nth takes: a join on the
    # rows told apart would shuffle the texts once more
    of = ["doc_id", source, alike]
    both = rows.unionByName(takes_of, allowMissingColumns=True).withColumn(home, F.xxhash64(*of)).repartition(F.col(home))
    is_takes = F.col(takes).isNotNull()
    both = both.withColumn(nth, F.row_number().over(Window.partitionBy(home, *of, is_takes).orderBy(alike)))
    both = both.withColumn(takes, F.lead(takes).over(Window.partitionBy(home, *of, nth).orderBy(is_takes)))
    both = both.withColumn(takes, F.explode(takes))
    length, slot = F.col(takes)["length"], F.col(takes)["slot"]
    # few texts are cut
    whole = length >= F.col(takes)["t_size"]
    cut = {"text": F.when(whole, F.col("text")).otherwise(_first_words(F.col("text"), length))}
    if "n_chars" in names:
        cut["n_chars"] = F.when(whole, F.col("n_chars")).otherwise(F.char_length(cut["text"]).cast(docs.schema["n_chars"].dataType))
    mixed = both.withColumns(cut).withColumn(takes, slot).select(*names, takes)
    return mixed.repartitionById(len(ends) + 1, _in_ranges(F.col(takes), ends)).sortWithinPartitions(takes).select(*names)


def _range_ends(taken: DataFrame) -> list[int]:
    """The slots that part ``taken`` into ranges of as many rows, found without the texts."""
    most = int(taken.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(most, 1 + (taken.agg(F.sum("length")).first()[0] or 0) // RANGE)
    if ranges == 1:
        return []
    return taken.agg(F.percentile_approx("slot", [k / ranges for k in range(1, ranges)], 10 * most)).first()[0]


def _first_words(text: Column, count: Column) -> Column:
    """``text`` up to the end of its word number ``count``."""
    words = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), count.cast("int")), "")
