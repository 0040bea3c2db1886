"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weeklens.llm.common import WORD, row_key, written

#: Fixed value: the golden ratio's fractional part, whose multiples fill the unit interval evenly.
GOLDEN = 0.6180339887498949
CAP = 3
CELLS = 4096
MOST_SLOTS = 1 << 20
LEAST_BLOCK = 256


@dataclass
class Mix:
    """rows: one per input row, with the words taken; schedule: the slots in the order in which a reader takes them."""

    rows: DataFrame
    schedule: DataFrame
    block: int


def source_targets(sized: DataFrame, cap: int = CAP, period: int = 3) -> DataFrame:
    """(source, ord, source_size, target): weights 1..period by code-point order of the source, null last.

    The shares of all words by weight, where a share over ``cap`` times its source's size stops there and the excess goes
    to the others by weight. Sources fill up in the order of capacity by weight, so the prefix of full ones gives the
    level of the rest without iteration.
    """
    everything = Window.partitionBy(F.lit(0))
    order = everything.orderBy(F.col("source").isNull(), "source")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighed = sizes.withColumn("ord", F.row_number().over(order) - 1).withColumn("w", F.col("ord") % period + 1)
    by_room = everything.orderBy(F.col("source_size") / F.col("w"), "ord")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = weighed.select(
        "*",
        F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0)).alias("full"),
        F.sum("w").over(after).alias("rest"),
        F.sum("source_size").over(everything).alias("total"),
    )
    left = F.col("total") - F.col("full")
    open_ = F.col("source_size") * cap * F.col("rest") > left * F.col("w")
    first_open = F.min(F.when(open_, F.struct(F.col("source_size") / F.col("w"), F.col("ord"), left.alias("left"), F.col("rest"))))
    level = filled.select("*", first_open.over(everything).alias("first"))
    here = F.struct(F.col("source_size") / F.col("w"), F.col("ord"), left.alias("left"), F.col("rest"))
    share = F.col("first.left").cast("double") * F.col("w") / F.col("first.rest")
    target = F.when(F.col("first").isNull() | (here < F.col("first")), (F.col("source_size") * cap).cast("double")).otherwise(share)
    return level.select("source", "ord", "source_size", target.alias("target"))


def _positions(sized: DataFrame) -> DataFrame:
    """Adds ``start``, the row's first word in its source's shuffled stream, and ``pos``, its number in the source.

    Rows are ordered by a hash. The hash's first digits cut each source into ranges that are summed first, so that no
    source, however large, is numbered in one task.
    """
    keyed = sized.withColumn("range", F.substring("h", 1, 3))
    sums = keyed.groupBy("ord", "range").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    earlier = Window.partitionBy("ord").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "ord", "range",
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    within = Window.partitionBy("ord", "range").orderBy("h", "id", "tie")
    own = keyed.select(
        "*",
        (F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("words_here"),
        F.row_number().over(within).alias("row_here"),
    )
    return own.join(offsets, ["ord", "range"]).select(
        "ord", "doc_id", "id", "tie", "size",
        (F.col("words_before") + F.col("words_here")).alias("start"),
        (F.col("rows_before") + F.col("row_here")).alias("pos"),
    )


def _schedule(targets: DataFrame, total: int, block: int) -> DataFrame:
    """(at, ord, rank, epoch, block, take): slot ``rank`` of a source reads ``take`` words of its block.

    Multiples of the golden ratio are mapped through the cumulative shares: shares are cut at the borders of a fixed grid
    of cells, so a point meets its source by an equi-join. A source keeps as many slots as its target needs; those
    that the sequence has not dealt by its end follow at the end.
    """
    spark = targets.sparkSession
    share = F.col("target") / F.sum("target").over(Window.partitionBy(F.lit(0)))
    upto = F.sum("share").over(Window.partitionBy(F.lit(0)).orderBy("ord"))
    spans = targets.withColumn("share", share).withColumn("hi", upto).withColumn("lo", F.col("hi") - F.col("share"))
    last = F.max("ord").over(Window.partitionBy(F.lit(0)))
    spans = spans.withColumn("hi", F.when(F.col("ord") == last, F.lit(1.5)).otherwise(F.col("hi")))
    spans = spans.withColumn("lo", F.coalesce(F.lag("hi").over(Window.partitionBy(F.lit(0)).orderBy("ord")), F.lit(0.0)))
    cell = lambda x: F.least(F.floor(x * CELLS), F.lit(CELLS - 1)).cast("int")
    cells = spans.where("hi > lo").select("ord", "lo", "hi", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))).alias("cell"))
    point = F.col("at") * F.lit(GOLDEN)
    points = spark.range(-(-total // block)).select(F.col("id").alias("at")).withColumn("x", point - F.floor(point))
    dealt = points.withColumn("cell", cell(F.col("x"))).join(cells, "cell").where("x >= lo and x < hi")
    ranked = dealt.select("at", "ord", (F.row_number().over(Window.partitionBy("ord").orderBy("at")) - 1).alias("rank"))
    goal = F.floor(F.col("target") + 0.5).cast("bigint")
    blocks = F.ceil(F.col("source_size") / F.lit(block)).cast("bigint")
    needs = targets.where("source_size > 0").withColumn("goal", goal).withColumn("blocks", blocks)
    whole = F.expr("goal div source_size")
    needs = needs.withColumn("need", whole * F.col("blocks") + F.ceil((F.col("goal") - whole * F.col("source_size")) / F.lit(block)).cast("bigint"))
    have = ranked.groupBy("ord").agg(F.count("*").alias("have"))
    missing = needs.join(have, "ord", "left").withColumn("have", F.coalesce("have", F.lit(0).cast("bigint"))).where("have < need")
    added = missing.select(
        (F.lit(-(-total // block)) + F.col("ord")).cast("bigint").alias("at"), "ord",
        F.explode(F.sequence("have", F.col("need") - 1)).alias("rank"),
    )
    slots = ranked.select("at", "ord", F.col("rank").cast("bigint").alias("rank")).union(added).join(
        needs.select("ord", "need", "blocks", "goal", "source_size"), "ord"
    ).where("rank < need")
    slots = slots.withColumn("epoch", F.expr("rank div blocks")).withColumn("block", F.expr("rank % blocks"))
    first = F.col("block") * block
    left = F.col("goal") - F.col("epoch") * F.col("source_size") - first
    return slots.select("at", "ord", "rank", "epoch", "block", F.least(F.lit(block), F.col("source_size") - first, left).alias("take"))


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("bigint")


def mix(docs: DataFrame, cap: int = CAP, most_slots: int = MOST_SLOTS, least_block: int = LEAST_BLOCK) -> Mix:
    """Takes words of every source up to its target, at most ``cap`` times each word.

    A source's documents are laid end to end in hashed order and cut into blocks of equal words; a document may lie in
    several blocks. The number of slots is at most ``most_slots``, so blocks grow with the input. Null texts have size
    0 and nothing is taken of them; a null source is a source of its own; repeated rows are rows of their own. Column
    names other than doc_id, text and source play no part.
    """
    narrow = row_key(docs).select("row.doc_id", "row.source", "id", "tie", word_count("row.text").alias("size"), F.md5("id").alias("h"))
    sized = written(narrow, "sized")
    targets = written(source_targets(sized, cap), "targets")
    total = int(targets.agg(F.sum("source_size")).first()[0] or 0)
    block = max(least_block, -(-total // most_slots))
    schedule = written(_schedule(targets, total, block), "schedule")
    by_block = schedule.groupBy("ord", "block").agg(
        F.count("*").alias("slots"), F.min("take").alias("part")
    )
    stream = written(
        _positions(sized.join(targets.select("source", "ord"), sized["source"].eqNullSafe(targets["source"])).drop("source")),
        "stream",
    )
    touched = F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))
    pieces = stream.where("size > 0").select("ord", "pos", "start", "size", F.explode(touched).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * block)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    # All slots of a block but its last are whole; the last may stop inside the block.
    partial = F.least(high, F.col("block") * block + F.col("part")) - low
    words = (F.col("slots") - 1) * (high - low) + F.greatest(F.lit(0), partial)
    # Spark takes the pieces of a row for as large as the row, so without the hint it may broadcast them.
    taken = pieces.join(by_block.hint("merge"), ["ord", "block"]).groupBy("ord", "pos").agg(F.sum(words).alias("taken"))
    opened = by_block.select("ord", F.col("block").alias("_block"), F.col("slots"), "part")
    begins = F.col("start") - F.col("_block") * block
    copies = F.coalesce(F.col("slots") - F.when(begins >= F.col("part"), 1).otherwise(0), F.lit(0))
    rows = (
        stream.join(taken.hint("merge"), ["ord", "pos"], "left")
        .withColumn("_block", F.expr(f"start div {block}"))
        .join(opened.hint("merge"), ["ord", "_block"], "left")
        .join(targets.select("ord", "source", "source_size", "target"), "ord")
        .select(
            "doc_id", "id", "tie", "source", "size", "source_size", "target",
            F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), copies.cast("bigint").alias("copies"),
        )
    )
    return Mix(rows, schedule, block)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix reads them: a row is there as often as the mix reads its first word.

    Rows that repeat one another are told apart by a number, in either table. Rows without words are not read, so an
    empty table stays empty. Columns of any name pass through.
    """
    twin = lambda order: F.row_number().over(Window.partitionBy("id", "tie").orderBy(order))
    copies = mix(docs).rows.select("id", "tie", "copies").withColumn("twin", twin(F.desc("copies")))
    keyed = row_key(docs).withColumn("twin", twin("id"))
    joined = keyed.join(copies.where("copies > 0").hint("merge"), ["id", "tie", "twin"])
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
