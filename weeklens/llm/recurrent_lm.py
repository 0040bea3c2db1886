"""Language-model scores: corpus counts, and a gated recurrent network trained in parallel parts whose weights are averaged.

Words fall into three ranks. The most frequent ones have numbers of their own in the network. All others share a few
classes there, by their last byte, and inside a class follow the corpus counts. Of these the counts of the more frequent
are sent to the tasks; the rest meet their counts by a join.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from zlib import crc32

from weeklens.llm import gru
from weeklens.llm.common import fold_of, written

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Stands for the end of a text; no word has a line feed.
END = b"\n"
LN10 = math.log(10)


@dataclass(frozen=True)
class LmConfig:
    """words: with numbers of their own; sent: whose counts go to the tasks, at most; tails: classes of all other words.

    All training documents train the network, each in one of the ``rounds``, at every size; counts are over all of them too.
    A round is dealt to parts of about ``part_tokens`` tokens, so their number follows from the corpus alone.
    A task trains the copies of ``together`` parts side by side.
    """

    words: int = 1008
    tails: int = 24
    sent: int = 200_000
    rounds: int = 2
    part_tokens: int = 2_000_000
    together: int = 4
    width: int = 64
    window: int = 20
    rate: float = 0.2
    group: int = 16
    seed: int = 5
    folds: int = 7
    held_out: int = 2


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case (A to Z only), then the end."""
    return [*(text or "").encode().translate(_LOWER).split(), END]


def _runs(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """The texts in runs of about ``most`` bytes, so that memory follows no batch of long texts."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    run = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
    for start, stop in zip(cuts, cuts[1:]):
        if start < stop:
            yield texts.slice(start, stop - start)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts one after the other, without the ends; how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten().cast(pa.binary())
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    some = np.diff(np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]) > 0
    if some.all():
        return flat, sizes
    # Blanks at a text's border leave an empty word.
    upto, ends = np.concatenate([[0], np.cumsum(some)]), np.concatenate([[0], np.cumsum(sizes)])
    return flat.filter(pa.array(some)), np.diff(upto[ends])


def _count(batches: Iterator[pa.RecordBatch], most: int = 1 << 25) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in _runs(batch.column(0), most):
            counts = pc.value_counts(_words(texts)[0])
            words = pa.concat_arrays([counts.field("values"), pa.array([END], pa.binary())])
            times = pa.concat_arrays([counts.field("counts"), pa.array([len(texts)], pa.int64())])
            yield pa.RecordBatch.from_arrays([words, times], ["word", "n"])


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n, h) over all texts: counted inside the tasks, a bounded number of words at a time, then summed."""
    counted = training.select("text").mapInArrow(_count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.select("word", "n", F.xxhash64("word").alias("h"))


def _tail_class(tails: int):
    return (F.crc32(F.substring("word", -1, 1)) % tails).cast("int")


@dataclass
class Lexicon:
    """What every task knows of the counts. Of each word in ``sent``: its number in the network, log10 of its count plus one."""

    shape: gru.Shape
    sent: pa.Array
    sent_numbers: np.ndarray
    sent_logs: np.ndarray
    total: int
    distinct: int
    class_mass: np.ndarray  # of each tail class: log10 of (tokens + words + 1) over all its words
    numbers: np.ndarray  # tokens by number


def lexicon(counts: DataFrame, config: LmConfig) -> Lexicon:
    """Reads from the counts what is bounded: totals by class, and the words above the count that ``sent`` words reach."""
    spread = counts.groupBy("n").agg(F.count("*").alias("k"))
    rank = Window.partitionBy(F.lit(0)).orderBy(F.desc("n"))
    border = spread.withColumn("upto", F.sum("k").over(rank)).where(F.col("upto") <= config.sent).agg(F.min("n")).first()[0]
    frequent = [] if border is None else counts.where(F.col("n") >= border).select("word", "n").toArrow().to_pylist()
    frequent.sort(key=lambda r: (-r["n"], r["word"]))
    shape = gru.Shape(config.words, config.tails)
    by_class = counts.groupBy(_tail_class(config.tails).alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()
    mass = np.zeros((config.tails, 2), np.int64)
    for r in by_class:
        mass[r["c"]] = r["n"], r["k"]
    total, distinct = mass.sum(axis=0).tolist()
    numbers = np.zeros(shape.numbers, np.int64)
    sent = [bytes(r["word"]) for r in frequent]
    sent_numbers = np.zeros(len(sent), np.int32)
    for i, (word, r) in enumerate(zip(sent, frequent)):
        tail = crc32(word[-1:]) % config.tails
        sent_numbers[i] = i if i < config.words else config.words + tail
        if i < config.words:
            numbers[i] = r["n"]
            mass[tail] -= r["n"], 1
    sent_logs = np.log10(np.array([r["n"] for r in frequent], np.float64) + 1)
    numbers[config.words :] = mass[:, 0]
    return Lexicon(shape, pa.array(sent, pa.binary()), sent_numbers, sent_logs, total, distinct, np.log10(mass.sum(axis=1) + 1.0), numbers)


@dataclass
class _Read:
    """Texts as the network reads them. ``at``: place in ``sent`` of every token, ends included, or -1; ``starts``: of texts."""

    at: np.ndarray
    numbers: np.ndarray
    starts: np.ndarray
    words: pa.Array
    sizes: np.ndarray

    def texts(self) -> list[np.ndarray]:
        return np.split(self.numbers, self.starts[1:])


def _read(lex: Lexicon, texts: pa.Array) -> _Read:
    """Looks every word of the texts up among those sent; the others have the number of their tail class."""
    words, sizes = _words(texts)
    starts = np.cumsum(sizes + 1) - sizes - 1
    is_end = np.zeros(len(words) + len(texts), bool)
    is_end[starts + sizes] = True
    at, last = np.empty(len(is_end), np.int32), np.empty(len(is_end), np.uint8)
    for place, found in ((~is_end, words), (is_end, pa.array([END], pa.binary()))):
        ids = pc.fill_null(pc.index_in(found, value_set=lex.sent), -1).to_numpy(zero_copy_only=False)
        _, offsets, data = found.buffers()
        upto = np.frombuffer(offsets, np.int32)[found.offset : found.offset + len(found) + 1]
        at[place], last[place] = ids, np.frombuffer(data or b"", np.uint8)[upto[1:] - 1]
    tails = np.array([lex.shape.words + crc32(bytes([b])) % lex.shape.tails for b in range(256)], np.int32)
    numbers = tails[last]
    known = at >= 0
    numbers[known] = lex.sent_numbers[at[known]]
    return _Read(at, numbers, starts, words, sizes)


def _numbers(lex: Lexicon, text: str | None) -> np.ndarray:
    return _read(lex, pa.array([text], pa.string())).numbers


def _chunks(lex: Lexicon, texts: pd.Series, least: int = 200_000) -> Iterator[list[np.ndarray]]:
    """The texts as numbers, at least so many tokens at a time."""
    chunk, size = [], 0
    for run in _runs(pa.array(texts, pa.string()), 1 << 22):
        for text in _read(lex, run).texts():
            chunk.append(text)
            size += len(text)
            if size >= least:
                yield chunk
                chunk, size = [], 0
    if chunk:
        yield chunk


def _train_parts(frame: pd.DataFrame, lex: Lexicon, blob: bytes, config: LmConfig) -> pd.DataFrame:
    """A copy of the network for every ``part`` of the frame, trained on the part's texts in the order of ``h``.

    The copies know nothing of one another; they take their steps together because numpy then has larger arrays.
    """
    parts = [(part, _chunks(lex, own["text"])) for part, own in frame.sort_values(["part", "h"]).groupby("part")]
    nets, pasts = [gru.unpacked(blob) for _ in parts], [None] * len(parts)
    seen = np.zeros(len(parts), np.int64)
    for chunks in itertools.zip_longest(*(chunks for _, chunks in parts), fillvalue=()):
        seen += [sum(map(len, chunk)) for chunk in chunks]
        pasts = gru.train_together(nets, lex.shape, list(chunks), config.width, config.window, config.rate, pasts)
    return pd.DataFrame({"part": [part for part, _ in parts], "tokens": seen, "net": [gru.packed(net) for net in nets]})


def _dealt(training: DataFrame) -> DataFrame:
    """(text, h) of every training row: ``h`` is a hash of the row and, among rows that repeat one another, of its number.

    Equal rows are counted before they move, and their copies dealt apart, so neither one task nor the order of the input
    decides where a row trains.
    """
    counted = written(training.groupBy("doc_id", "text").agg(F.count("*").alias("copies")), "training")
    each = counted.select("doc_id", "text", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return each.select("text", F.xxhash64("doc_id", "text", "copy").alias("h"))


def _averaged(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("part")
    total, mean = int(frame["tokens"].sum()), {}
    for tokens_, blob in zip(frame["tokens"], frame["net"]):
        for k, v in gru.unpacked(blob).items():
            mean[k] = mean.get(k, 0) + v.astype(np.float64) * (tokens_ / total)
    return pd.DataFrame({"part": [0], "tokens": [total], "net": [gru.packed({k: v.astype(np.float32) for k, v in mean.items()})]})


_PART = T.StructType([T.StructField("part", T.LongType()), T.StructField("tokens", T.LongType()), T.StructField("net", T.BinaryType())])


def train_network(training: DataFrame, lex: Lexicon, config: LmConfig) -> gru.Net:
    """Rounds of local training: every part trains its own copy on its documents, then the copies are averaged.

    A hash deals every document to one part of one round, so together the rounds are one pass over all of them, and how
    the input lies in partitions plays no part.
    Averages are taken of ``group`` copies at a time, weighted by their tokens, until one group is left; neither a task
    nor the driver holds more copies than that.
    """
    spark = training.sparkSession
    net = gru.fresh(lex.shape, lex.numbers, config.seed)
    each_round = max(1, round(lex.total / config.rounds / config.part_tokens))
    dealt = _dealt(training).withColumn("part", F.pmod("h", F.lit(config.rounds * each_round)))
    for turn in range(config.rounds):
        chosen = dealt.where(F.pmod("part", F.lit(config.rounds)) == turn)
        sent = spark.sparkContext.broadcast((lex, gru.packed(net)))

        def train(frame: pd.DataFrame) -> pd.DataFrame:
            return _train_parts(frame, *sent.value, config)

        tasks = chosen.withColumn("part", F.expr(f"part div {config.rounds}")).groupBy(F.expr(f"part div {config.together}"))
        parts = written(tasks.applyInPandas(train, _PART), "nets")
        copies = parts.count()
        while copies > config.group:
            keyed = parts.withColumn("part", F.expr(f"part div {config.group}"))
            parts = written(keyed.groupBy("part").applyInPandas(lambda key, frame: _averaged(frame).assign(part=key[0]), _PART), "averages")
            copies = parts.count()
        rows = parts.orderBy("part").toPandas()
        if len(rows):
            net = gru.unpacked(_averaged(rows)["net"][0])
        sent.unpersist()
    return net


_SCORED = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("sent_known", T.LongType()),
        T.StructField("sent_log", T.DoubleType()),  # log10(count + 1) over the words whose counts were sent
        T.StructField("net_log", T.DoubleType()),  # log10 of the network's share and of sent counts inside tail classes
        T.StructField("rest", T.ArrayType(T.LongType())),  # hashes of the other words
    ]
)


def _score(frames: Iterator[pd.Series], lex: Lexicon, net: gru.Net) -> Iterator[pd.DataFrame]:
    logs = np.append(lex.sent_logs, 0.0)  # the last is for words that were not sent
    for frame in frames:
        rows = []
        for run in _runs(pa.array(frame, pa.string()), 1 << 23):
            found = _read(lex, run)
            known, sent = found.at >= 0, logs[found.at]
            tail = np.where(found.numbers >= lex.shape.words, sent, 0.0)
            tail -= np.append(np.zeros(lex.shape.words), lex.class_mass)[found.numbers]
            net_log = gru.log_likelihood(net, lex.shape, found.texts()) / LN10 + np.add.reduceat(tail, found.starts)
            n_known = np.add.reduceat(known, found.starts, dtype=np.int64)
            ends = found.starts + found.sizes
            others = np.flatnonzero(~np.delete(known, ends))
            hashes = np.array([xxhash.xxh64_intdigest(w.as_py(), 42) for w in found.words.take(pa.array(others))], np.uint64).view(np.int64)
            # An end that was not sent is among the rest, too.
            end_hash = np.array([xxhash.xxh64_intdigest(END, 42)], np.uint64).view(np.int64)
            rest = np.split(hashes, np.searchsorted(others, np.cumsum(found.sizes)[:-1]))
            rest = [r if k else np.append(r, end_hash) for r, k in zip(rest, known[ends])]
            rows.append(pd.DataFrame(dict(zip(_SCORED.fieldNames(), (found.sizes + 1, n_known, np.add.reduceat(sent, found.starts), net_log, rest)))))
        yield pd.concat(rows, ignore_index=True) if rows else pd.DataFrame(columns=_SCORED.fieldNames())


def scored(docs: DataFrame, config: LmConfig = LmConfig()) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts are one end token. A null doc_id counts as the empty text when folds are dealt. Repeated rows
    are counted in training as often as they come and are scored alike; other columns are not read. Without any
    training token the network is an untrained one and all counts are zero.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", (fold_of("doc_id", config.folds) == config.held_out).alias("held_out"))
    training = docs.where(~F.col("held_out"))
    counts = written(word_counts(training), "counts")
    lex = lexicon(counts, config)
    net = train_network(training, lex, config)
    sent = spark.sparkContext.broadcast((lex, net))

    @F.pandas_udf(_SCORED)
    def score(frames: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _score(frames, *sent.value)

    rows = docs.select("doc_id", "held_out", score("text").alias("s")).select("doc_id", "held_out", "s.*")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "scored")
    rest = rows.select("row", F.explode("rest").alias("h")).groupBy("row", "h").agg(F.count("*").alias("times"))
    # The counts of sent words are not among the rest, so no word here is frequent.
    met = rest.join(counts.select("h", "n"), "h", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rest_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("rest_log"),
    )
    rest_log = F.coalesce("rest_log", F.lit(0.0))
    all_ = math.log10(lex.total + lex.distinct + 1)
    return rows.drop("rest").join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("sent_known") + F.coalesce("rest_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(lex.total).cast("bigint").alias("train_tokens"),
        (F.col("sent_log") + rest_log - F.col("n_tokens") * all_).alias("base_score"),
        (F.col("net_log") + rest_log).alias("score"),
    )
