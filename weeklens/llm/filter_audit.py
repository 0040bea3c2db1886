"""Filter interaction audit: what every filter removes in every order, with duplicates found by radix tries.

Equal texts meet in compressed tries. Each task inserts its rows into tries of its own first, so a text with very many
copies leaves a task once. What is left is dealt by ranges of text prefixes, whose length adapts: a prefix that too many
bytes share is doubled until it is shared by few. Each prefix gets a trie whose terminals hold the smallest id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from weeklens.llm.common import written

LETTERS = "ABCDE"
DUPLICATE = 1 << LETTERS.index("E")
#: Prefixes have BASE, 2 * BASE, 4 * BASE, ... bytes; one that more than PREFIX_BYTES of text share is doubled. Beyond 8 TB
#: of distinct texts the border grows, so that no more than PREFIXES prefixes of one length lie above it.
BASE, PREFIX_BYTES, PREFIXES = 8, 16 << 20, 500_000
#: A task's own tries are handed on when they hold this much text.
LOCAL_BYTES = 16 << 20
#: A partition of the range deal holds about this much text.
RANGE_BYTES = 64 << 20
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Limits:
    """Thresholds of the filters A to D; E, the duplicate filter, has none."""

    min_words: int = 100
    distinct_percent: int = 80
    upper_percent: int = 10
    symbols: bytes = b"#$%&*|"


def failures(text: bytes, limits: Limits) -> int:
    """Bit i is set if the text fails filter i of A, B, C, D. An empty text fails A alone."""
    words = text.split()
    upper = len(text) - len(text.translate(None, _UPPER))
    fails = (
        len(words) < limits.min_words,
        100 * len(set(words)) < limits.distinct_percent * len(words),
        100 * upper > limits.upper_percent * len(text.decode()),
        len(text.translate(None, limits.symbols)) < len(text),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


class Node:
    """Edge label towards the node, children by first byte, and the terminal's value (None: no text ends here)."""

    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes, value: list | None = None):
        self.label, self.children, self.value = label, {}, value


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """Compressed trie over whole texts; a terminal's value is a list that begins with the smallest id."""

    def __init__(self):
        self.root, self.held = Node(b""), 0

    def insert(self, text: bytes, value: list) -> None:
        """Adds the text, or lowers the smallest id of its terminal; None is larger than any id."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                self.held += len(text) - at
                node.children[text[at]] = Node(text[at:], value)
                return
            if not text.startswith(child.label, at):
                cut = _shared(child.label, text[at : at + len(child.label)])
                upper = Node(child.label[:cut])
                child.label = child.label[cut:]
                upper.children[child.label[0]] = child
                node.children[text[at]] = child = upper
            node, at = child, at + len(child.label)
        if node.value is None:
            node.value = value
        elif value[0] is not None and (node.value[0] is None or value[0] < node.value[0]):
            node.value[0] = value[0]

    def terminals(self) -> Iterator[tuple[bytes, list]]:
        """(text, value) of every terminal."""
        stack = [(self.root, b"")]
        while stack:
            node, before = stack.pop()
            text = before + node.label
            if node.value is not None:
                yield text, node.value
            stack.extend((child, text) for child in node.children.values())


def _marks(text: bytes) -> list[int]:
    """Hashes of the prefixes of BASE, 2 * BASE, ... bytes, up to the first that holds the whole text."""
    out, length = [], BASE
    while True:
        out.append(xxhash.xxh64_intdigest(text[:length]) >> 1)
        if length >= len(text):
            return out
        length *= 2


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def _local(batches: Iterator[pa.RecordBatch], limits: Limits, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row for each distinct text of a task's trie: text, digest, mask of A to D, smallest id, prefix hashes."""

    def rows(trie: Trie) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for text, (least,) in trie.terminals():
            out.append((text, hashlib.sha256(text).digest(), failures(text, limits), least, _marks(text)))
            size += len(text)
            if size >= LOCAL_BYTES // 4:
                yield _batch(out, schema)
                out, size = [], 0
        if out:
            yield _batch(out, schema)

    trie = Trie()
    for batch in batches:
        for text, ident in zip(batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()):
            trie.insert(text, [ident])
            if trie.held >= LOCAL_BYTES:
                yield from rows(trie)
                trie = Trie()
    yield from rows(trie)


def _merge(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One trie for each prefix, in the order of prefixes: digest, mask and smallest id of every distinct text."""
    trie, current = Trie(), None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("prefix", "text", "least", "digest", "mask")]
        for prefix, text, least, digest, mask in zip(*columns):
            if prefix != current:
                yield _batch([(v[1], v[2], v[0]) for _, v in trie.terminals()], schema)
                trie, current = Trie(), prefix
            trie.insert(text, [least, digest, mask])
    yield _batch([(v[1], v[2], v[0]) for _, v in trie.terminals()], schema)


def _payload() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def _prefixes(local: DataFrame, bytes_: int) -> DataFrame:
    """``local`` with ``prefix``: the shortest of a text's prefixes of BASE * 2^i bytes that isn't overfull.

    A prefix is overfull if more than PREFIX_BYTES of text share it; a text that makes all of its prefixes overfull gets
    all its bytes. The hashes of overfull prefixes go to every task: one length has PREFIXES of them at most, and a
    prefix can only be overfull if the shorter ones are.
    """
    border = max(PREFIX_BYTES, bytes_ // PREFIXES)
    marks = local.select(F.octet_length("text").alias("bytes"), F.posexplode("marks").alias("level", "mark"))
    full = marks.groupBy("level", "mark").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") > border)
    overfull = local.sparkSession.sparkContext.broadcast(np.sort(np.array([r["mark"] for r in full.select("mark").toLocalIterator()], np.int64)))

    @F.pandas_udf(T.IntegerType())
    def level(marks: pd.Series) -> pd.Series:
        sizes = marks.str.len().to_numpy()
        flat = np.concatenate(marks.to_list()) if len(marks) else np.zeros(0, np.int64)
        known = overfull.value
        at = np.searchsorted(known, flat)
        there = known[np.minimum(at, len(known) - 1)] == flat if len(known) else np.zeros(len(flat), bool)
        return pd.Series(np.add.reduceat(there, np.cumsum([0, *sizes[:-1]])) if len(sizes) else [], dtype="int32")

    prefix = F.expr(f"substring(text, 1, {BASE} * shiftleft(1, level))")
    return local.withColumn("level", level("marks")).select("digest", "text", "mask", "least", prefix.alias("prefix"))


def distinct_texts(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(digest, mask, least) of every distinct text of ``docs`` (doc_id, text): SHA-256, failures of A to D, smallest id.

    Null texts are empty texts. A null id counts as larger than any other.
    """
    ident = docs.schema["doc_id"].dataType
    merged_type = T.StructType().add("digest", T.BinaryType()).add("mask", T.IntegerType()).add("least", ident)
    local_type = T.StructType([T.StructField("text", T.BinaryType()), *merged_type, T.StructField("marks", T.ArrayType(T.LongType()))])
    local_schema, merged_schema = to_arrow_schema(local_type), to_arrow_schema(merged_type)
    rows = docs.select("doc_id", _payload().alias("text"))
    local = written(rows.mapInArrow(lambda b: _local(b, limits, local_schema), local_type), "local-tries")
    bytes_ = local.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = _prefixes(local, bytes_).repartitionByRange(max(1, -(-bytes_ // RANGE_BYTES)), "prefix").sortWithinPartitions("prefix")
    return written(dealt.mapInArrow(lambda b: _merge(b, merged_schema), merged_type), "distinct-texts")


def flagged(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(doc_id, part, mask) for each row of ``docs`` (doc_id, text, lang, any other columns).

    Bit i of ``mask`` is set where the row fails filter i of A to E; ``part`` is the language, null as empty. A row fails
    E if another row with a smaller id has the same text, so rows that repeat one another, ids included, stay together
    on either side; rows without an id come last. Ids are integers or strings.
    """
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(_payload(), 256)).alias("digest"))
    again = F.col("least").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("least")))
    joined = rows.join(distinct_texts(docs, limits), "digest")
    return joined.select("doc_id", "part", F.col("mask").bitwiseOR(F.when(again, DUPLICATE).otherwise(0)).alias("mask"))


def masks(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, docs, good, toxic): rows by their failures, and how many of them are labelled good or toxic.

    Rows are counted by id before they meet their labels, so an id with very many rows is one row of the join. An id with
    several label rows is good, or toxic, if one of them says so; a null id has no label.
    """
    told = labels.groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"),
    )
    by_id = flags.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("docs"))
    counted = by_id.join(told, "doc_id", "left")
    of = lambda c: F.sum(F.col("docs") * F.coalesce(c, F.lit(0))).cast("bigint").alias(c)
    return counted.groupBy("part", "mask").agg(F.sum("docs").cast("bigint").alias("docs"), of("good"), of("toxic"))


def orders_of(counts: DataFrame) -> DataFrame:
    """What each of the filters does at each step of each order, from ``masks``: at most 32 rows a part."""
    entries = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("entries"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(LETTERS)])
    steps = entries.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
    bit = lambda letter: F.expr(f"shiftleft(1, instr('{LETTERS}', {letter}) - 1)")
    letters = F.split(F.substring("filter_order", 1, F.col("step") - 1), "")
    seen = F.aggregate(letters, F.lit(0), lambda acc, c: acc.bitwiseOR(F.when(c == "", 0).otherwise(F.call_function("shiftleft", F.lit(1), F.instr(F.lit(LETTERS), c) - 1))))
    steps = steps.withColumn("letter", F.expr("substring(filter_order, step, 1)")).withColumns({"before": seen, "own": bit("letter")})

    def total(of: str, wanted) -> Column:
        return F.aggregate(
            "entries", F.lit(0).cast("bigint"),
            lambda acc, e: acc + F.when(wanted(e["mask"]), e[of]).otherwise(F.lit(0).cast("bigint")),
        )

    fails = lambda m: m.bitwiseAND(F.col("own")) != 0
    there = lambda m: m.bitwiseAND(F.col("before")) == 0
    removed = lambda m: there(m) & fails(m)
    return steps.select(
        "part", "filter_order", "step", "letter",
        total("docs", lambda m: there(m) & ~fails(m)).alias("kept"),
        total("docs", removed).alias("removed"),
        total("docs", lambda m: fails(m) & ~there(m)).alias("redundant"),
        total("docs", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
    ).withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))).drop("letter")


def audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per part of ``docs``, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley.

    Null and empty texts fail A, and E where another row with a smaller id is empty too. Texts of any length are read
    whole. A null language is the part '' together with the empty one. An empty table has no parts, hence no rows. Columns
    other than doc_id, text and lang, and doc_id, quality and toxic of ``labels``, play no part.
    """
    return orders_of(written(masks(flagged(docs, limits), labels), "filter-masks"))
