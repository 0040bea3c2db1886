"""SimHash fingerprints and near-duplicate groups by multi-index hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weeklens.llm.common import row_key, written
from weeklens.llm.components import components

BITS = 64
MAX_DISTANCE = 2
SHINGLE = 3
SEED = 42
#: Entries of a segment's table with more fingerprints than this are compared in full keys.
HOT = 64
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BLOCK = 1 << 16


def _fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)))), len(words) - shingle + 1
    ones = np.zeros(BITS, np.int64)
    for start in range(0, n, _BLOCK):  # a block at a time, so a very long text needs no more memory than its words
        count = min(_BLOCK, n - start)
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for _, s in zip(range(count), shingles)), np.uint64, count)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(count, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprint(column: str = "text", shingle: int = SHINGLE) -> Column:
    """64-bit SimHash of each text: a bit is 1 if it is set in over half of the hashes of its word shingles."""

    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(column)


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def segment_balls(value: Column, radius: int = 1) -> Column:
    """The value with at most ``radius`` of its bits flipped, every result once."""
    flips = [_signed(sum(1 << i for i in chosen)) for r in range(radius + 1) for chosen in combinations(range(BITS), r)]
    return F.transform(F.array(*[F.lit(x).cast("bigint") for x in flips]), lambda flip: value.bitwiseXOR(flip))


def _segments(value: Column, max_distance: int) -> list[tuple[int, Column, int]]:
    """(number, value, width) of equal segments, so many that two close values differ in one bit of some segment at most."""
    count = max_distance // 2 + 1
    cuts = [BITS * i // count for i in range(count + 1)]
    widths = [high - low for low, high in zip(cuts, cuts[1:])]
    return [
        (i, F.shiftrightunsigned(value, low).bitwiseAND(F.lit(_signed((1 << width) - 1)).cast("bigint")), width)
        for i, (low, width) in enumerate(zip(cuts, widths))
    ]


def _table(prints: DataFrame, max_distance: int) -> DataFrame:
    """(segment, value, entry): each fingerprint under the value of each of its segments."""
    entries = [F.struct(F.lit(i).alias("segment"), v.alias("value")) for i, v, _ in _segments(F.col("fp"), max_distance)]
    return prints.select(F.col("fp").alias("entry"), F.explode(F.array(*entries)).alias("x")).select("x.segment", "x.value", "entry")


def _probes(prints: DataFrame, max_distance: int) -> DataFrame:
    """(segment, value, fp): the ball of radius 1 around each segment's value, of which only bits that are 0 are flipped.

    Where two segments differ in one bit, the fingerprint that has a 0 there finds the other.
    """
    balls = []
    for i, v, width in _segments(F.col("fp"), max_distance):
        flips = F.array(*[F.lit(_signed(x)).cast("bigint") for x in (0, *(1 << b for b in range(width)))])
        balls.append(_tagged(i, F.array_distinct(F.transform(flips, v.bitwiseOR))))
    return prints.select("fp", F.explode(F.concat(*balls)).alias("x")).select("x.segment", "x.value", "fp")


def _tagged(segment: int, values: Column) -> Column:
    return F.transform(values, lambda value: F.struct(F.lit(segment).alias("segment"), value.alias("value")))


def _in_full_keys(prints: DataFrame, max_distance: int) -> DataFrame:
    """Links (a, b) among ``prints`` (fp), each to the smallest entry it meets; their closure is that of all links.

    Keys are whole fingerprints. Each value enters the keys that differ from it in half the distance at most and probes
    those that differ in the rest of it. Whatever meets an entry in a key is within the distance of it, and so are the
    key's entries of one another, so all of them are linked to the smallest entry and no pairs are listed.
    """
    near = max_distance // 2
    entries = prints.select("fp", F.explode(segment_balls(F.col("fp"), near)).alias("key"))
    if max_distance % 2 == 0:
        met = entries.withColumn("first", F.min("fp").over(Window.partitionBy("key")))
    else:
        first = entries.groupBy("key").agg(F.min("fp").alias("first"))
        met = prints.select("fp", F.explode(segment_balls(F.col("fp"), near + 1)).alias("key")).join(first.hint("merge"), "key")
    return met.where("fp <> first").select(F.col("fp").alias("a"), F.col("first").alias("b"))


def links(prints: DataFrame, max_distance: int = MAX_DISTANCE, hot: int = HOT) -> DataFrame:
    """Verified links (a, b) among the distinct values of column ``fp``; their closure is that of all links.

    Multi-index hashing: a table for each segment holds the fingerprints under the segment's value. Each fingerprint
    looks up a small ball around each of its segments, and what it finds is a link if the complete distance is at most
    ``max_distance``. An entry with more than ``hot`` fingerprints would list the pairs of a large group; the
    fingerprints that own or look up such an entry are compared in full keys instead, which lists none.
    """
    prints = written(prints.select("fp").distinct(), "distinct-prints")
    table = _table(prints, max_distance)
    sizes = table.groupBy("segment", "value").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("segment", "value")
    sizes = written(sizes, "hot-segments")
    cold = table.join(sizes.hint("merge"), ["segment", "value"], "left_anti")
    marks = sizes.select("segment", "value", F.lit(None).cast("bigint").alias("entry"))
    # Spark takes a ball for as large as its fingerprint, so without the hint it would broadcast all probes.
    met = _probes(prints, max_distance).join(cold.union(marks).hint("merge"), ["segment", "value"])
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("entry")))
    found = written(met.where(F.col("entry").isNull() | ((F.col("fp") != F.col("entry")) & (distance <= max_distance))).select(F.col("fp").alias("a"), F.col("entry").alias("b")), "links")
    full = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    return found.where("b is not null").union(_in_full_keys(full, max_distance))


def group_fingerprints(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(fp, group): the smallest fingerprint that is reached from each distinct fingerprint over links."""
    roots = components(links(prints, max_distance)).select(F.col("node").alias("fp"), "root")
    return prints.select("fp").distinct().join(roots.hint("merge"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("group"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs`` (doc_id, text, any other columns).

    A null or blank text has fingerprint zero and is linked like any other. Repeated rows each get a row. A null doc_id
    takes part in links, but names a component only where no other id is in it. Texts are hashed whole. An empty table
    gives no rows.
    """
    prints = written(docs.select("doc_id", fingerprint("text", shingle).alias("fp")), "prints")
    groups = written(
        prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(group_fingerprints(prints, max_distance).hint("merge"), "fp"), "groups"
    )
    # Written, so that both sides of the join are exchanges and a very large group is split by adaptive execution.
    named = written(groups.groupBy("group").agg(F.min("least").alias("component_id")), "named")
    names = groups.join(named.hint("merge"), "group").select("fp", "component_id")
    return prints.join(names.hint("merge"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stand for their group: smallest doc_id (null last), then a hash of the row.

    One row of each group stays, also among repeated rows and rows that share a doc_id; null, blank and empty texts are
    one group. Columns of any name pass through. An empty table stays empty.
    """
    prints = written(
        row_key(docs).select("row.doc_id", "id", "tie", fingerprint("row.text", shingle).alias("fp")), "prints"
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "tie", "id"))
    groups = prints.groupBy("fp").agg(first.alias("first")).join(group_fingerprints(prints, max_distance).hint("merge"), "fp")
    kept = groups.groupBy("group").agg(F.min("first").alias("first")).select("first.id", "first.tie")
    stay = row_key(docs).join(kept.hint("merge"), ["id", "tie"], "left_semi")
    return stay.dropDuplicates(["id", "tie"]).select("row.*")
