"""Benchmark decontamination: suffix arrays over training text, searched for every suffix of the test items."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 13
MAX_TEST_CHARS = 16_000_000
SHARD_WORDS = 1_000_000
#: Fixed value: ASCII digits, ASCII letters (in lower case) and all bytes of non-ASCII characters make words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_SPAN = T.StructType(
    [
        T.StructField("doc_start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("item_start", T.LongType()),
    ]
)
_SPANS = pa.list_(pa.struct([("doc_start", pa.int64()), ("length", pa.int64()), ("item_id", pa.string()), ("item_start", pa.int64())]))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class _Numbers(dict):
    """Word numbers from 1; any other word has number 0."""

    def __missing__(self, word: bytes) -> int:
        return 0


class TestSuffixes:
    """Distinct windows of the test items as word numbers, and where each of them stands in the items.

    A window is what is needed of a suffix: its first ``window`` words, or all words of a shorter item.
    """

    __test__ = False

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.window, self.vocabulary, seen, places = window, _Numbers(), {}, defaultdict(list)
        for item_id, text in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            name = "" if item_id is None else str(item_id)
            for start in range(max(1, len(numbers) - window + 1) if numbers else 0):
                key = tuple(numbers[start : start + window])
                places[seen.setdefault(key, len(seen))].append((name, start))
        self.places = [sorted(set(places[i])) for i in range(len(seen))]
        self.lengths = np.array([len(k) for k in seen], np.int64)
        self.numbers = np.zeros((len(seen), window), np.int64)
        for i, key in enumerate(seen):
            self.numbers[i, : len(key)] = key
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.packed = min(62 // self.bits, window)


def packed_keys(numbers: np.ndarray, bits: int, count: int) -> np.ndarray:
    """For each position the next ``count`` word numbers in one integer; 0 ends a text and all behind it."""
    key, alive = np.zeros(len(numbers), np.int64), np.ones(len(numbers), bool)
    for step in range(count):
        ahead = np.zeros_like(numbers)
        ahead[: len(numbers) - step] = numbers[step:]
        alive &= ahead > 0
        key = (key << bits) | np.where(alive, ahead, 0)
    return key


def suffix_array(numbers: np.ndarray, bits: int, packed: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of words (number > 0) in the order of their next ``depth`` words, and their packed first words.

    Ranks by the first ``packed`` words are doubled until they cover ``depth``. Number 0 stands for the end of a text
    and for every word that no test item has: no match goes past it, so what is behind it may decide between suffixes
    that are alike up to there.
    """
    positions = np.flatnonzero(numbers)
    first = packed_keys(numbers, bits, packed)[positions]
    _, rank = np.unique(first, return_inverse=True)
    covered = packed
    while covered < depth:
        everywhere = np.zeros(len(numbers) + covered, np.int64)
        everywhere[positions] = rank + 1
        _, rank = np.unique(rank * (len(positions) + 1) + everywhere[positions + covered], return_inverse=True)
        covered *= 2
    order = np.argsort(rank, kind="stable")
    return positions[order], first[order]


def find(test: TestSuffixes, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) of every occurrence, by binary search in the suffix array of the shard."""
    none = np.zeros(0, np.int64)
    if not len(test.lengths) or not numbers.any():
        return none, none
    order, first = suffix_array(numbers, test.bits, test.packed, test.window)
    padded = np.concatenate([numbers, np.zeros(test.window, np.int64)])
    head = np.zeros(len(test.lengths), np.int64)
    room = np.zeros(len(test.lengths), np.int64)
    for step in range(test.packed):
        head = (head << test.bits) | test.numbers[:, step]
        room = (room << test.bits) | np.where(step < test.lengths, 0, (1 << test.bits) - 1)
    lo, hi = np.searchsorted(first, head, "left"), np.searchsorted(first, head | room, "right")
    live = np.flatnonzero(lo < hi)
    steps = np.arange(test.window)
    bounds = []
    for upper in (False, True):
        a, b = lo[live].copy(), hi[live].copy()
        while (open_ := a < b).any():
            middle = (a + b) // 2
            got = padded[order[np.minimum(middle, len(order) - 1)][:, None] + steps]
            want = test.numbers[live]
            unequal = (got != want) & (steps < test.lengths[live, None])
            at = unequal.argmax(axis=1)
            rows = np.arange(len(live))
            differ = unequal[rows, at]
            below = np.where(differ, got[rows, at] < want[rows, at], upper)
            a, b = np.where(open_ & below, middle + 1, a), np.where(open_ & ~below, middle, b)
        bounds.append(a)
    count = bounds[1] - bounds[0]
    window = np.repeat(live, count)
    within = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
    return window, order[np.repeat(bounds[0], count) + within]


def _spans(test: TestSuffixes, windows: np.ndarray, starts: np.ndarray) -> list[dict]:
    """Longest matches of one document: windows that follow one another in text and item are one match."""
    lines = defaultdict(list)
    for w, start in zip(windows.tolist(), starts.tolist()):
        for item_id, item_start in test.places[w]:
            lines[item_id, start - item_start].append((start, int(test.lengths[w])))
    out = []
    for (item_id, shift), found in lines.items():
        found.sort()
        begin, end, last = found[0][0], found[0][0] + found[0][1], found[0][0]
        for start, length in found[1:]:
            if start > last + 1:
                out.append((begin, end - begin, item_id, begin - shift))
                begin = start
            last, end = start, start + length
        out.append((begin, end - begin, item_id, begin - shift))
    return [dict(zip(("doc_start", "length", "item_id", "item_start"), x)) for x in sorted(out)]


def _shards(texts: pa.Array, vocabulary: dict, limit: int) -> Iterator[tuple[list[int], np.ndarray]]:
    """Documents in runs of about ``limit`` words: their word counts and all their numbers, a 0 after each document."""
    counts, parts, total = [], [], 0
    number = vocabulary.__getitem__
    for text in texts:
        words = words_of(text.as_py())
        counts.append(len(words))
        parts.append(np.fromiter(map(number, words), np.int64, len(words)))
        parts.append(np.zeros(1, np.int64))
        total += len(words)
        if total >= limit:
            yield counts, np.concatenate(parts)
            counts, parts, total = [], [], 0
    if counts:
        yield counts, np.concatenate(parts)


def _search(batches: Iterator[pa.RecordBatch], test: TestSuffixes, keep_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, spans = [], []
        for sizes, numbers in _shards(batch.column("text"), test.vocabulary, SHARD_WORDS):
            starts = np.cumsum([0, *[n + 1 for n in sizes[:-1]]])
            windows, at = find(test, numbers)
            owner = np.searchsorted(starts, at, "right") - 1
            order = np.argsort(owner, kind="stable")
            windows, at, owner = windows[order], at[order], owner[order]
            cuts = np.searchsorted(owner, np.arange(len(sizes) + 1))
            for i in range(len(sizes)):
                own = slice(cuts[i], cuts[i + 1])
                spans.append(_spans(test, windows[own], at[own] - starts[i]) if cuts[i] < cuts[i + 1] else [])
            counts += sizes
        names = [n for n in batch.schema.names if n not in ("_n_words", "_spans") and (keep_text or n != "text")]
        columns = [batch.column(n) for n in names]
        before = batch.column("_spans").to_pylist() if "_spans" in batch.schema.names else [[]] * len(counts)
        joined = pa.array([a + b for a, b in zip(before, spans)], _SPANS)
        yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), joined], [*names, "_n_words", "_spans"])


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_test_chars: int = MAX_TEST_CHARS, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``_n_words`` and ``_spans``: longest verbatim matches with test items, of ``window`` words or more.

    Each span tells where it stands in the document and in which item, in words. Suffix arrays are built inside the
    tasks over runs of whole documents, so nothing is shuffled. Test items are sent to the tasks in portions of about
    ``max_test_chars`` characters; a larger benchmark takes one pass over the documents per portion.
    """
    spark, docs = docs.sparkSession, docs.drop("_n_words", "_spans")
    chars = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    portions = max(1, -(-chars // max_test_chars))
    items = benchmark.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(portions)).alias("portion"))
    out = docs
    for portion in range(portions):
        rows = [tuple(r) for r in items.where(F.col("portion") == portion).select("item_id", "text").toLocalIterator()]
        test = spark.sparkContext.broadcast(TestSuffixes(rows, window))
        keep = keep_text or portion + 1 < portions
        fields = [f for f in out.schema.fields if f.name not in ("_n_words", "_spans") and (keep or f.name != "text")]
        schema = T.StructType([*fields, T.StructField("_n_words", T.LongType()), T.StructField("_spans", T.ArrayType(_SPAN))])
        out = out.mapInArrow(lambda batches, test=test, keep=keep: _search(batches, test.value, keep), schema)
    return out


def judged(docs: DataFrame, benchmark: DataFrame, keep_text: bool = True, share: int = 20) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated, under names that start with an underscore.

    They, ``_spans`` and ``_items`` replace columns of these names.

    A word is hit if it lies inside a match. A document is contaminated if at least one word in ``share`` is hit. Null
    and empty texts have no words; null and empty items have no window; items with the same id are one item; a null
    item_id counts as the empty name. Rows are judged one by one, so repeated rows stay and extra columns pass through.
    """
    # The last word hit so far and the number of words hit, over the spans in their order.
    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("hit"))

    def take(acc, span):
        end = span["doc_start"] + span["length"]
        new = F.greatest(F.lit(0), end - F.greatest(acc["end"], span["doc_start"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["hit"] + new).alias("hit"))

    found = matches(docs, benchmark, keep_text=keep_text)
    hit = F.aggregate(F.sort_array("_spans"), start, take, lambda acc: acc["hit"])
    items = F.array_sort(F.array_distinct(F.transform("_spans", lambda s: s["item_id"])))
    found = found.withColumns({"_n_hit": hit, "_items": items})
    return found.withColumns(
        {
            "_n_items": F.size("_items").cast("bigint"),
            "_items_sha256": F.sha2(F.array_join("_items", ",").cast("binary"), 256),
            "_contaminated": (F.col("_n_hit") > 0) & (F.col("_n_hit") * share >= F.col("_n_words")),
        }
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with the columns they came with, whatever their names.

    Rows without words are clean; rows that repeat one another go or stay together; an empty table stays empty, and
    without items every row stays.
    """
    packed = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_row"))
    clean = judged(packed, benchmark).where(~F.col("_contaminated"))
    return clean.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])
