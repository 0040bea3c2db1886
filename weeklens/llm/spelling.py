"""Spelling variants: a minimised vocabulary acceptor composed with a one-edit transducer and the acceptor again.

Two words that differ by one edit share what is before it and what is behind it, so the longer one's first half or its
second half is common to both. The composed machine is therefore walked from the states that these halves lead to: the
acceptor's states behind each first half, and those of the reversed words behind each second half. Each such initial
state is a partition of the work with a minimised acceptor of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weeklens.llm.common import written

LEAST_LENGTH, LEAST_COUNT = 5, 3
#: One run in about this many loses a character, chosen by the same checksum.
SLIP = 97
#: Fixed value: ASCII letters (in lower case by then) and U+00C0 to U+00FF make words.
_RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: A task hands its word counts on when it holds this many words.
HELD_WORDS = 500_000
#: A batch of pairs has at most this many.
BATCH_PAIRS = 50_000


def spelled(ident: object, run: str) -> str:
    """The run, without one of its characters where the checksum of id and run says so."""
    h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
    if h % SLIP:
        return run
    return run[: h % len(run)] + run[h % len(run) + 1 :]


def _counts(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for ident, text in zip(batch.column("doc_id").to_pylist(), texts):
            runs = Counter(_RUN.findall((text.as_py() or b"").translate(_LOWER).decode()))
            for run, n in runs.items():
                word = spelled(ident, run)
                if len(word) >= least:
                    held[word] += n
            if len(held) >= HELD_WORDS:
                yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
                held = Counter()
    yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of all texts and how often they occur, counted inside the tasks first."""
    counts = docs.select("doc_id", "text").mapInArrow(lambda b: _counts(b, least_length), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class State:
    """State of an acceptor: arcs by character. Words of one acceptor have one length, so its last state is final."""

    __slots__ = ("arcs",)

    def __init__(self):
        self.arcs: dict[str, State] = {}


def acceptor(words: list[str], register: dict) -> State:
    """Minimised acceptor of sorted words of one length, built word by word; equal states of a register are one object.

    When a word leaves the path of the one before it, the states of that path below the fork can't change any more, and
    each is replaced by the registered state with the same arcs.
    """
    root, path, before = State(), [], ""

    def settle(depth: int) -> None:
        while len(path) > depth:
            parent, c, child = path.pop()
            key = tuple((x, id(s)) for x, s in child.arcs.items())
            parent.arcs[c] = register.setdefault(key, child)

    for word in words:
        fork = 0
        while fork < len(before) and word[fork] == before[fork]:
            fork += 1
        settle(fork)
        state = path[-1][2] if path else root
        for c in word[fork:]:
            child = State()
            state.arcs[c] = child
            path.append((state, c, child))
            state = child
        before = word
    settle(0)
    return root


def both(a: State, b: State) -> Iterator[str]:
    """The strings that are accepted from either state: the transducer's second state copies what it reads."""
    stack = [(a, b, "")]
    while stack:
        a, b, read = stack.pop()
        if not a.arcs and not b.arcs:
            yield read
        for c, after in a.arcs.items():
            if c in b.arcs:
                stack.append((after, b.arcs[c], read + c))


def composed(long: list[str], short: list[str]) -> Iterator[tuple[str, str]]:
    """Pairs of different strings that the composition accepts, the longer first and each pair once.

    ``long`` are sorted strings of one length, ``short`` sorted strings that are one shorter. The transducer's first
    state copies; its arcs to the second state replace a character or delete one. Its insertions accept the deletions'
    pairs the other way round and needn't be walked. The last of several equal characters in a row is the one deleted.
    """
    register: dict = {}
    stack = [(acceptor(long, register), acceptor(short, register) if short else None, "")]
    while stack:
        p, q, read = stack.pop()
        arcs = list(p.arcs.items())
        for i, (x, after_x) in enumerate(arcs):
            for y, after_y in arcs[:i]:
                for rest in both(after_x, after_y):
                    yield read + x + rest, read + y + rest
            if q is not None:
                if not q.arcs:  # the short string ends here
                    yield read + x, read
                for c, after in q.arcs.items():
                    if c != x and c in after_x.arcs:
                        for rest in both(after_x.arcs[c], after):
                            yield read + x + c + rest, read + c + rest
            if len(arcs) > 1 or q is not None:
                stack.append((after_x, q.arcs.get(x) if q is not None else None, read + x))
            else:
                # No fork below this arc until the next state with several arcs.
                run = [read, x]
                while len(after_x.arcs) == 1:
                    (c, after_x), = after_x.arcs.items()
                    run.append(c)
                if after_x.arcs:
                    stack.append((after_x, None, "".join(run)))


def _partition(rows: list[tuple]) -> Iterator[tuple[str, int, str, int]]:
    """(word, n, near, near_n) of one initial state's words; rows are (side, longest, half, rest, n), sorted by rest."""
    side, longest, half = rows[0][:3]
    first = longest // 2
    size = (longest - first) if side == "first" else first  # of the longer words' other half
    counts = {rest: n for *_, rest, n in rows}
    long, short = [r for r in counts if len(r) == size], [r for r in counts if len(r) < size]
    if not long or len(counts) == 1:
        return
    for a, b in composed(long, short):
        word, near = (half + a, half + b) if side == "first" else (a[::-1] + half, b[::-1] + half)
        # Pairs that also share the first half are found from there.
        if side == "first" or word[:first] != near[:first]:
            yield word, counts[a], near, counts[b]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["a", "a_n", "b", "b_n"]

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found) if found else [[]] * 4
        types = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    found: list[tuple] = []
    for _, group in groupby(rows(), key=itemgetter(0, 1, 2)):
        for pair in _partition(list(group)):
            found.append(pair)
            if len(found) >= BATCH_PAIRS:
                yield batch_of(found)
                found = []
    yield batch_of(found)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every pair of ``words`` (word, n) that differ by one edit, once.

    A word takes part in the partitions of its own length and of the length above, with its first and its second half.
    """
    n = F.length("word")
    options = []
    for longest in (n, n + 1):
        first = F.floor(longest / 2).cast("int")
        rest = (longest - first).cast("int")
        options.append(F.struct(F.lit("first").alias("side"), longest.alias("longest"), F.substring("word", F.lit(1), first).alias("half"), F.substring("word", first + 1, n).alias("rest")))
        behind = (n - rest).cast("int")
        options.append(F.struct(F.lit("second").alias("side"), longest.alias("longest"), F.substring("word", behind + 1, n).alias("half"), F.reverse(F.substring("word", F.lit(1), behind)).alias("rest")))
    keyed = words.select("n", F.explode(F.array(*options)).alias("k")).select("k.side", "k.longest", "k.half", "k.rest", "n")
    state = ["side", "longest", "half"]
    return keyed.repartition(*state).sortWithinPartitions(*state, "rest").mapInArrow(_pairs, "a string, a_n bigint, b string, b_n bigint")


def forms(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, n, n_near, form_n) of ``words`` (word, n), written once.

    A word's form is its most frequent near word, ties by code points, if that occurs ``ratio`` times as often.
    """
    words = written(words, "vocabulary")
    two = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    ways = near_pairs(words).select(F.explode(two).alias("x")).select("x.*")
    best = ways.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(best, "word", "left")
    wins = -F.col("best.less") >= ratio * F.col("n")
    return written(
        joined.select(
            "word", F.when(wins, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(wins, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by doubling the step along forms until no word moves on.

    Counts at least double from word to form, so the rounds are at most the logarithm of the count's digits.
    """
    steps = written(found.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return steps


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs`` (doc_id, text, any other columns).

    Null and empty texts have no words; a null id counts as the empty text in the checksum; rows that repeat one another
    are counted each; texts and words of any length are read whole; an empty table has no words.
    """
    found = forms(vocabulary(docs))
    return found.join(roots(found), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
