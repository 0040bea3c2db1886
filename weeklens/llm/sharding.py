"""Sharding by a k-d tree over metadata: splits at weighted medians until the leaves hold the target bytes.

All steps are DataFrame operations. What the driver holds is the tree: one split for each inner node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weeklens.llm.common import text_or_empty, written

SHARDS = 24
OVERHEAD = 8
#: A key is 20 bits of a coordinate and 43 bits of a hash of the text; medians are found 16 bits at a time.
COORDINATE_BITS, HASH_BITS, DIGIT = 20, 43, 16
#: Low bits of a row's hash that come from its number in the written table.
NUMBER_BITS = 20
DIMENSIONS = ("by_lang", "by_source", "by_size")
#: Copies of one text are parted only where they weigh more than this share of a leaf.
GROUP_SHARE = 0.05
NONE, ALL = -1, (1 << 63) - 1


@dataclass
class Node:
    """A leaf of ``leaves`` = 1, or rows below ``key`` on ``dimension`` to the left and those above it to the right.

    Of the rows whose key is ``key`` itself, those with a row hash of at most ``part`` go left.
    """

    leaves: int
    first: int
    dimension: str = ""
    key: int = 0
    part: int = -1
    left: Node | None = None
    right: Node | None = None


def _rank(rows: DataFrame, column: str) -> DataFrame:
    """(column, rank from 0 to 1) of the distinct values in order, null last; one row for each value."""
    values = rows.select(column).distinct()
    order = Window.partitionBy(F.lit(0)).orderBy(F.col(column).isNull(), column)
    most = F.greatest(F.max("r").over(Window.partitionBy(F.lit(0))), F.lit(1))
    ranked = values.withColumn("r", F.row_number().over(order) - 1).withColumn("rank", F.col("r") / most)
    return ranked.select(F.col(column).alias("value"), "rank")


def _spread() -> Column:
    """63 bits that part the copies of a text: a hash of the row and, for rows that repeat one another, of its number."""
    own = F.shiftleft(F.shiftrightunsigned(F.xxhash64("doc_id", "lang", "source", "n_chars"), 1 + NUMBER_BITS), NUMBER_BITS)
    return own.bitwiseOR(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << NUMBER_BITS)))


def points(docs: DataFrame) -> DataFrame:
    """Narrow rows with one sortable key per dimension; copies of a text share all keys.

    A text's language and source are those of its first copy in order, so copies from several sources stay together.
    """
    payload = text_or_empty().cast("binary")
    narrow = docs.select(
        "doc_id", "lang", "source",
        (F.octet_length(text_or_empty()) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(payload).cast("bigint").alias("text_crc32"),
        F.sha2(payload, 256).alias("digest"),
        _spread().alias("spread"),
    )
    narrow = written(narrow, "points")
    shared = narrow.groupBy("digest").agg(F.min("lang").alias("group_lang"), F.min("source").alias("group_source"), F.count("*").alias("copies"))
    grouped = narrow.join(shared.where("copies > 1").drop("copies"), "digest", "left").withColumns(
        {
            "lang": F.coalesce("group_lang", "lang"),
            "source": F.coalesce("group_source", "source"),
        }
    )
    for column in ("lang", "source"):
        ranks = _rank(narrow, column).withColumnRenamed("rank", f"{column}_rank")
        grouped = grouped.join(ranks, grouped[column].eqNullSafe(ranks["value"]), "left").drop("value")
    span = F.log2(F.lit(float(1 << 40)))
    coordinate = {
        "by_lang": F.col("lang_rank"),
        "by_source": F.col("source_rank"),
        "by_size": F.least(F.lit(1.0), F.log2(F.col("size")) / span),
    }
    tail = F.conv(F.substring("digest", 1, 15), 16, 10).cast("bigint").bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    top = (1 << COORDINATE_BITS) - 1
    keys = {name: F.shiftleft(F.floor(c * top).cast("bigint"), HASH_BITS).bitwiseOR(tail) for name, c in coordinate.items()}
    return written(grouped.withColumns(keys).select("doc_id", "size", "text_crc32", "spread", "digest", *DIMENSIONS), "keys")


def shard_of(node: Node) -> Column:
    """The first leaf number of the node that a row lies in, by nested comparisons."""
    if node.left is None:
        return F.lit(node.first)
    key = F.col(node.dimension)
    goes_left = (key < node.key) | ((key == node.key) & (F.col("spread") <= node.part))
    return F.when(goes_left, shard_of(node.left)).otherwise(shard_of(node.right))


def _open(node: Node) -> list[Node]:
    if node.left is None:
        return [node] if node.leaves > 1 else []
    return _open(node.left) + _open(node.right)


def _widest(rows: DataFrame) -> dict[int, tuple[str, int]]:
    """For each node its widest dimension and its bytes."""
    at = lambda d: F.shiftright(F.col(d), HASH_BITS)
    widths = [(F.max(at(d)) - F.min(at(d))).alias(d) for d in DIMENSIONS]
    return {
        r["node"]: (max(DIMENSIONS, key=lambda d: r[d]), r["bytes"])
        for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *widths).collect()
    }


def _medians(rows: DataFrame, goals: dict[int, tuple[str, float]]) -> dict[int, tuple[int, int, int]]:
    """For each node the key at which the running bytes reach the goal, the bytes below it and the bytes at it.

    The keys' digits are settled from the highest down: bytes are summed by the next digit among the keys that begin with
    the digits settled so far, so each pass returns one row for each node and sorts at most 65,536 sums per node.
    """
    node_key = F.coalesce(*[F.when(F.col("node") == n, F.col(d)) for n, (d, _) in goals.items()])
    rows = rows.where(F.col("node").isin([int(n) for n in goals])).select("node", "size", node_key.alias("key"))
    found = {n: (0, 0, 0) for n in goals}
    for low in range(64 - DIGIT, -1, -DIGIT):
        prefix = F.coalesce(*[F.when(F.col("node") == n, F.lit(k)) for n, (k, _, _) in found.items()])
        goal = F.coalesce(*[F.when(F.col("node") == n, F.lit(float(goals[n][1] - below))) for n, (_, below, _) in found.items()])
        digit = F.shiftrightunsigned("key", low)
        same = rows if low + DIGIT == 64 else rows.where(F.shiftrightunsigned("key", low + DIGIT) == prefix)
        sums = same.groupBy("node", digit.alias("digit")).agg(F.sum("size").alias("bytes"))
        order = Window.partitionBy("node").orderBy("digit")
        running = sums.withColumn("upto", F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        last = F.max("digit").over(Window.partitionBy("node"))
        crossing = running.withColumn("last", last).where((F.col("upto") >= goal) | (F.col("digit") == F.col("last")))
        first = crossing.groupBy("node").agg(F.min(F.struct("digit", "upto", "bytes")).alias("x"))
        for r in first.collect():
            digit_, upto, bytes_ = r["x"]
            found[r["node"]] = (digit_, found[r["node"]][1] + upto - bytes_, bytes_)
    return found


def grow(rows: DataFrame, leaves: int, group_share: float = GROUP_SHARE) -> Node:
    """The tree over ``rows`` (points): level by level, all nodes of a level in the same passes."""
    root = Node(leaves, 0)
    total = rows.agg(F.sum("size")).first()[0] or 0
    while nodes := {n.first: n for n in _open(root)}:
        placed = rows.withColumn("node", shard_of(root))
        widest = _widest(placed)
        goals = {k: (widest[k][0], widest[k][1] * (n.leaves // 2) / n.leaves) for k, n in nodes.items() if k in widest}
        medians = _medians(placed, goals) if goals else {}
        heavy: dict[int, tuple[Node, float]] = {}
        for k, n in nodes.items():
            half = n.leaves // 2
            n.left, n.right = Node(half, n.first), Node(n.leaves - half, n.first + half)
            if k not in medians:  # no rows: any split will do
                n.dimension = DIMENSIONS[0]
                continue
            key, below, here = medians[k]
            n.dimension, n.key = goals[k][0], key
            wanted = goals[k][1] - below
            n.part = ALL if 2 * wanted >= here else NONE
            if here > group_share * total / leaves:
                heavy[k] = (n, wanted)
        if heavy:
            at_key = F.lit(False)
            for k, (n, _) in heavy.items():
                at_key = at_key | ((F.col("node") == k) & (F.col(n.dimension) == n.key))
            for k, (part, _, _) in _medians(placed.where(at_key), {k: ("spread", wanted) for k, (_, wanted) in heavy.items()}).items():
                heavy[k][0].part = part
    return root


def sharded(docs: DataFrame, shards: int = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Shards have nearly equal bytes; ``target_bytes`` sets their number instead. Copies of one text lie in one shard unless
    they weigh over ``GROUP_SHARE`` of a shard and a border falls among them, so a shard's bytes stay within about
    that share of their mean. A null text has no bytes of its own; null
    languages and sources come last in their order. Rows that repeat one another stay and get slots of their own. Fewer
    rows than shards leave shards empty.
    """
    rows = points(docs)
    if target_bytes:
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    placed = rows.withColumn("shard", shard_of(grow(rows, shards))).withColumn("range", F.substring("digest", 1, 3))
    # Numbers within a shard: ranges of the text's hash are counted first, so no shard is numbered in one task, and rows
    # of one text, or that repeat one another, are spread further by their own hash.
    placed = placed.withColumn("part", F.col("spread").bitwiseAND(F.lit(127)).cast("int"))
    counts = placed.groupBy("shard", "range", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "range", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "range", "part").orderBy("digest", "spread", "doc_id")
    numbered = placed.withColumn("here", F.row_number().over(within) - 1).join(counts, ["shard", "range", "part"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("before") + F.col("here")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
