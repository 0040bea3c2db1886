"""Personal data by bootstrapped contextual extraction.

Checked formats give seed identifiers. The words before a seed induce lexical patterns; patterns and identifiers form a
graph that Spark scores round by round: a pattern is as good as the share of all its places in the corpus that identifiers
fill, an identifier as good as its best trusted pattern. Trusted patterns discover identifiers that no format covers.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weeklens.llm.common import written

#: The kinds in their order, and the formats' borders.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A pattern is trusted if identifiers fill this share of its places, at least so many different ones.
TRUST, SUPPORT = 0.5, 3
#: What may be discovered holds this many digits, or stands for an address.
LEAST_DIGITS = 6
#: The bitmap of induced patterns has this many bits (1 MB), whatever the input.
BITS = 1 << 23
HELD = 500_000
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
_TRIM = "\"'`.,;:!?<>[]{}|#$%&*=~^/\\«»“”„"
_SPELT_AT = re.compile(
    r"[A-Za-z0-9._%+-]{1,64} ?[\[({] ?at ?[\])}] ?[A-Za-z0-9-]{1,63}(?:(?: ?[\[({] ?dot ?[\])}] ?|\.)[A-Za-z0-9-]{1,63}){1,8}", re.I
)
_LOW = str.maketrans({str(d): "0" for d in range(10)} | {chr(c): chr(c + 32) for c in range(65, 91)})
_FOUND = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
     T.StructField("identifier", T.StringType()), T.StructField("patterns", T.ArrayType(T.StringType())), T.StructField("kinds", T.ArrayType(T.StringType()))]
)
_ROW = T.StructType([T.StructField("base", T.ArrayType(_FOUND)), T.StructField("others", T.ArrayType(_FOUND))])


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address begins where the run of its characters before the @ does, but not inside the address before."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers each, from the left, of chains of numbers and dots."""
    for chain in _CHAIN.finditer(text):
        parts, start = chain.group().split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) < 4 and int(p[-3:]) <= 255 for p in four):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    """Whether the digits pass the check: every second one from the right is doubled, and its digits summed."""
    values = [int(c) for c in reversed(digits)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of all matches that pass their checks, by kind and start."""
    out = [(0, *span) for span in _emails(text)] + [(1, *span) for span in _ips(text)]
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 2 * 19 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def _identifier(kind: int, text: str) -> str:
    """Addresses in lower case; what else counts are the digits, for ip with the dots between them."""
    if kind == 0:
        spelt = re.sub(r" ?[\[({] ?at ?[\])}] ?", "@", text, flags=re.I)
        return re.sub(r" ?[\[({] ?dot ?[\])}] ?", ".", spelt, flags=re.I).lower()
    return text if kind == 1 else _digits(text)


def _normal(word: str) -> str:
    """The word as patterns know it: lower case, any digit as 0, without punctuation around it."""
    return word.translate(_LOW).strip(_TRIM)


class _Words:
    """The words of a text, and the patterns before a place in it."""

    def __init__(self, text: str):
        self.text, self.spans = text, [m.span() for m in _WORD.finditer(text)]
        self.starts, self.known = [s for s, _ in self.spans], {}

    def before(self, at: int) -> list[str]:
        """The last word before the place's own word, and the last two, as patterns; fewer where the text begins."""
        own = bisect_right(self.starts, at) - 1
        if own not in self.known:
            words = [_normal(self.text[s:e]) for s, e in self.spans[max(0, own - 2) : max(0, own)]]
            self.known[own] = [f"{n} " + " ".join(words[-n:]) for n in range(1, len(words) + 1)]
        return self.known[own]


def _others(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """(start, end, kinds it may be) of what looks like an identifier and overlaps no base span.

    Words that hold a digit or an @ and stand one space apart are one candidate.
    """
    taken = sorted((s, e) for _, s, e in base)
    spans = [m.span() for m in _SPELT_AT.finditer(text)] if "at" in text.lower() and re.search(r"[\[({] ?at ?[\])}]", text, re.I) else []
    done = 0
    for hit in re.finditer("[0-9@]+", text):
        if hit.end() <= done:
            continue
        start, end = hit.span()
        while start > done and text[start - 1] not in _SPACES:
            start -= 1
        while True:
            after = _WORD.match(text, end)
            end = after.end() if after else end
            following = _WORD.match(text, end + 1) if text[end : end + 1] == " " else None
            if not following or not re.search("[0-9@]", following.group()):
                break
            end = following.end()
        done = end
        shown = text[start:end]
        left = len(shown) - len(shown.lstrip(_TRIM))
        shown = shown.strip(_TRIM)
        spans.append((start + left, start + left + len(shown)))
    i, kept = 0, 0
    for start, end in sorted(spans):
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if start < kept or start >= end or i < len(taken) and taken[i][0] < end:
            continue
        shown = text[start:end]
        n = len(_digits(shown))
        kinds = [0] if "@" in shown or re.search(r"[\[({] ?at ?[\])}]", shown, re.I) else []
        if not kinds and n >= LEAST_DIGITS:
            kinds = [k for k, fits in ((1, shown.count(".") >= 3), (2, 12 <= n <= 19), (3, n <= 15)) if fits]
        if kinds:
            kept = end
            yield start, end, kinds


def _row(words: _Words, start: int, end: int, kinds: list[int]) -> dict:
    return {
        "kind": KINDS[kinds[0]], "start": start, "end": end, "identifier": _identifier(kinds[0], words.text[start:end]),
        "patterns": words.before(start), "kinds": [KINDS[k] for k in kinds],
    }


def _extract(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, others = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            spans = base_spans(text)
            rest = list(_others(text, spans))
            words = _Words(text) if spans or rest else None
            base.append([_row(words, s, e, [k]) for k, s, e in spans])
            others.append([_row(words, s, e, kinds) for s, e, kinds in rest])
        columns = [batch.column("doc_id")] + [pa.array(c, schema.field(n).type) for c, n in ((base, "base"), (others, "others"))]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def extracted(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, others): each text's seed identifiers and its candidates, with the patterns before them."""
    out = T.StructType([docs.schema["doc_id"], *_ROW.fields])
    schema = to_arrow_schema(out)
    rows = docs.select("doc_id", "text").mapInArrow(lambda b: _extract(b, schema), out)
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "identifiers")


def _places(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    """How often the words and pairs of words of a task's texts stand before another word, if the bitmap knows them."""

    def known(pattern: str) -> bool:
        at = xxhash.xxh64_intdigest(pattern, 42) % BITS
        return bool(bitmap[at >> 3] >> (at & 7) & 1)

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["pattern", "places"])

    counts: Counter = Counter()
    words: dict[str, tuple[str, bool, bool]] = {}  # as written: normal form, whether it ends a pattern, and begins one of two
    for batch in batches:
        for text in batch.column("text").to_pylist():
            written_words = _WORD.findall(text or "")[:-1]
            for word, n in Counter(written_words).items():
                if word not in words:
                    form = _normal(word)
                    words[word] = (form, known(f"1 {form}"), known(f"3 {form}"))
                if words[word][1]:
                    counts[f"1 {words[word][0]}"] += n
            told = [words[w] for w in written_words]
            for (a, _, begins), (b, ends, _) in zip(told, told[1:]):
                if ends and begins and known(pattern := f"2 {a} {b}"):
                    counts[pattern] += 1
            if len(counts) >= HELD or len(words) >= HELD:
                yield batch_of(counts)
                counts, words = Counter(), {}
    yield batch_of(counts)


def _bitmap(patterns: DataFrame) -> np.ndarray:
    """One bit for each induced pattern's hash, gathered in 256 pieces of 4 kB."""
    from_one = F.pmod(F.xxhash64("pattern"), F.lit(BITS)) + 1
    pieces = patterns.select(from_one.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("piece"))
    pieces = pieces.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    whole = np.zeros(BITS // 8, np.uint8)
    for r in pieces.collect():
        at = (r["piece"] - 1) * 4096
        whole[at : at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return whole


def pattern_graph(rows: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, patterns): (pattern, identifier, kinds, n) and (pattern, places) of the patterns that may be trusted.

    Only patterns that stand before a seed somewhere are induced. One whose places are filled by seeds and candidates in
    less than the share of ``TRUST`` can't reach it in any round and is left out.
    """
    every = rows.select(F.explode(F.concat("base", "others")).alias("x")).select("x.*")
    edges = written(
        every.select(F.explode("patterns").alias("pattern"), "identifier", F.array_join("kinds", " ").alias("kinds"))
        .groupBy("pattern", "identifier", "kinds").agg(F.count("*").alias("n")),
        "pattern-edges",
    )
    induced = rows.select(F.explode("base").alias("x")).select(F.explode("x.patterns").alias("pattern")).distinct()
    # Pairs of words are looked up only behind words that begin one.
    begins = induced.where("pattern like '2 %'").select(F.concat(F.lit("3 "), F.split("pattern", " ")[1]).alias("pattern"))
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(induced.union(begins)))
    counted = docs.select("text").mapInArrow(lambda b: _places(b, bitmap.value), "pattern string, places bigint")
    places = counted.groupBy("pattern").agg(F.sum("places").alias("places"))
    filled = edges.groupBy("pattern").agg(F.sum("n").alias("filled"))
    patterns = places.join(induced, "pattern", "left_semi").join(filled, "pattern").where(F.col("filled") >= TRUST * F.col("places"))
    patterns = written(patterns.select("pattern", "places"), "patterns")
    return written(edges.join(patterns, "pattern", "left_semi"), "pattern-edges"), patterns


def scored(edges: DataFrame, patterns: DataFrame, seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(identifiers, trusted): (identifier, kind, score) with the seeds' score 1, and (pattern, kind, trust, support).

    Rounds go on until no pattern and no identifier is new. Scores never fall, so there are no more rounds than patterns.
    """
    by_kind = edges.select("pattern", "identifier", "n", F.explode(F.split("kinds", " ")).alias("kind"))
    known = written(seeds.select("identifier", "kind", F.lit(1.0).alias("score")).distinct(), "identifier-scores")
    before = None
    while True:
        filled = by_kind.join(known, ["identifier", "kind"]).groupBy("pattern", "kind").agg(
            F.sum(F.col("n") * F.col("score")).alias("weight"), F.count("*").alias("support")
        )
        trust = F.least(F.lit(1.0), F.col("weight") / F.col("places"))
        trusted = written(
            filled.join(patterns, "pattern").select("pattern", "kind", trust.alias("trust"), "support").where((F.col("trust") >= TRUST) & (F.col("support") >= SUPPORT)),
            "trusted-patterns",
        )
        reached = by_kind.join(trusted, ["pattern", "kind"]).groupBy("identifier", "kind").agg(F.max("trust").alias("score"))
        known = written(
            reached.unionByName(seeds.select("identifier", "kind", F.lit(1.0).alias("score"))).groupBy("identifier", "kind").agg(F.max("score").alias("score")),
            "identifier-scores",
        )
        mark = (trusted.count(), known.count())
        if mark == before:
            return known, trusted
        before = mark


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added) for each row of ``docs`` (doc_id, text, any other columns): spans (kind, start, end).

    Positions are code points of the whole text. Null and empty texts have no spans; rows that repeat one another each
    get a row, and count each as a place of the patterns; a null id stays null; an empty table gives no rows. A candidate
    is added where its digits or address are known as an identifier, as the kind with the best score, ties in the order
    of the kinds.
    """
    rows = extracted(docs)
    seeds = written(rows.select(F.explode("base").alias("x")).select("x.identifier", "x.kind").distinct(), "seeds")
    known, _ = scored(*pattern_graph(rows, docs), seeds)
    others = rows.select("row", F.posexplode("others").alias("place", "x")).select("row", "place", "x.start", "x.end", "x.identifier", F.explode("x.kinds").alias("kind"))
    order = F.struct(-F.col("score"), F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")), "kind", "start", "end")
    best = others.join(known, ["identifier", "kind"]).groupBy("row", "place").agg(F.min(order).alias("best"))
    added = best.groupBy("row").agg(F.collect_list(F.struct("best.kind", "best.start", "best.end")).alias("added"))
    bare = F.transform("base", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return rows.join(added, "row", "left").select("doc_id", bare.alias("base"), F.coalesce("added", none).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, by kind in the order of ``KINDS`` and by start, comma-joined."""
    keyed = F.transform(spans, lambda x: F.struct(F.array_position(F.array(*[F.lit(k) for k in KINDS]), x["kind"]).alias("k"), x["start"], x["end"], x["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(spans: DataFrame) -> DataFrame:
    """Per row of ``found``: counts of the base spans by kind, the hash of their list, and the list of all spans."""
    count_of = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint")
    n = [count_of(k).alias(f"n_{k}") for k in KINDS]
    return spans.select(
        "doc_id", *n, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("bigint").alias("n_added"),
    )
