"""Collocations: phrases of two to five words that occur together more than their parts would,
counted on a prefix-free parse.

A text is a sequence of words with a mark where a piece ends. It is cut into chunks by its
own content: a window of WINDOW tokens whose hash is 0 mod DIVISOR ends a chunk and begins
the next, so both hold the window. Equal passages are cut alike wherever they stand, and the
parse is a dictionary of distinct chunks with how often each occurs. Phrases are counted
inside the chunks of that dictionary, each weighted by its frequency. A phrase belongs to the
chunk in which it begins; one that begins in the window at the end of a chunk is the next
chunk's, which holds it whole, as a phrase has at most WINDOW + 1 words. So each occurrence
counts once.

A phrase can't occur more often than a part of it. So phrases of k words are counted only
where both phrases of k - 1 words in them may be frequent, by a bit map of BITS bits that
has no false "no"; when it fills up, more is counted and the result is the same.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, looked_up, stored, text_of

LONGEST, LEAST, TOP = 5, 100, 2000
WINDOW, DIVISOR = LONGEST - 1, 16
#: Tokens that a chunk owns at most; a longer stretch without a cutting window is cut anyhow.
STRETCH = 1024
#: Bits of the map of frequent phrases that goes to all tasks (8 MB).
BITS = 1 << 26
#: Distinct strings that a task counts before it hands the counts on.
HELD = 400_000
#: Parts of a language that are ranked on their own before the language is.
SHARES = 64
# A-Z in lower case, what ends a piece as a line break, what parts words as a space.
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
#: The token that ends a piece; no word can be it. An empty phrase stands for all words.
STOP, ALL = ord("."), b""
#: Odd factors that mix the hashes of the words of a phrase by their places.
FACTORS = np.array([0x9E3779B97F4A7C15 ^ (i * 0x51ED270) for i in range(LONGEST)], np.uint64)
LOW_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def spans(line: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokens of a line begin and end; single spaces part them."""
    space = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    return np.concatenate([[0], space + 1]), np.append(space, len(line))


def hashes(line: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash for each token by its length and its first and last eight bytes, which is enough
    to choose cuts and to look up what may be frequent."""
    eight = np.ndarray((len(line) + 1,), "<u8", line + bytes(8), strides=(1,))
    n = end - begin
    kept = LOW_BYTES[np.minimum(n, 8)]
    h = (eight[begin] & kept) * FACTORS[0] ^ (eight[np.maximum(end - 8, begin)] & kept) * FACTORS[1]
    h = (h ^ h >> np.uint64(29)) * FACTORS[2] + n.astype(np.uint64)
    return h ^ h >> np.uint64(32)


def mixed(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, by those of the words."""
    return sum(h[i : len(h) - k + 1 + i] * FACTORS[i] for i in range(k))


class Counts(defaultdict):
    """Counts of byte strings by (language, mark), written out as rows when they get many."""

    def __init__(self):
        super().__init__(lambda: defaultdict(int))

    def many(self) -> bool:
        return sum(map(len, self.values())) > HELD

    def rows(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        for (lang, mark), counts in self.items():
            if not counts:
                continue
            columns = [pa.array([lang] * len(counts), pa.string()), pa.array([mark] * len(counts)), pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)
        self.clear()


def cut(line: bytes) -> Iterator[tuple[bytes, bool]]:
    """The chunks of a text, and whether a chunk is its last: that owns all its tokens, the
    others all but the last WINDOW."""
    begin, end = spans(line)
    n, starts = len(begin), [0]
    if n > WINDOW:
        hit = np.flatnonzero((mixed(hashes(line, begin, end), WINDOW) >> np.uint64(40)) % np.uint64(DIVISOR) == 0).tolist()
        for stop in [*hit, n]:
            while stop - starts[-1] > STRETCH and n - starts[-1] > STRETCH + WINDOW:
                starts.append(starts[-1] + STRETCH)
            if starts[-1] < stop < n:
                starts.append(stop)
    at, last = begin[starts].tolist(), end[np.array(starts[1:], int) + WINDOW - 1].tolist()
    for a, b in zip(at, last, strict=False):
        yield line[a:b], False
    yield line[at[-1] :], True


def plain(text: str) -> bytes:
    """The tokens of a text, single spaces between them."""
    return b" ".join(text.encode().translate(PLAIN).replace(b"\n", b" . ").split())


def parse(docs: DataFrame) -> DataFrame:
    """The dictionary: ``lang, whole, chunk, n`` for each distinct chunk of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()
        names = ["lang", "whole", "chunk", "n"]
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own, line = (counts[lang, False], counts[lang, True]), plain(text.as_py())
                for chunk, whole in cut(line) if line else ():
                    own[whole][chunk] += 1
                if counts.many():
                    yield from counts.rows(names)
        yield from counts.rows(names)

    given = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_of().alias("text"))
    return given.mapInArrow(run, "lang string, whole boolean, chunk string, n long").groupBy("lang", "whole", "chunk").agg(F.sum("n").alias("n"))


def salt(lang: str) -> np.uint64:
    return np.uint64(crc32(lang.encode()) * 0x9E3779B1)


def placed(h: np.ndarray, lang: str) -> np.ndarray:
    """Places in the bit map of phrases with hashes ``h``."""
    return ((h + salt(lang)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS.bit_length() + 1)


def likely_starts(h: np.ndarray, owned: np.ndarray, stops: np.ndarray, k: int, lang: str, bits: np.ndarray | None) -> np.ndarray:
    """Where phrases of k words begin that may be frequent: at tokens that their chunk owns,
    without a stop inside. Chunks stand one behind the other with a stop between."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    good = owned[:n].copy()
    for i in range(k):
        good &= ~stops[i : n + i]
    if k > 1:
        p = placed(mixed(h, k - 1), lang)
        known = bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1 == 1
        good &= known[:n] & known[1 : n + 1]
    return np.flatnonzero(good)


def counted(chunks: DataFrame, k: int, likely: np.ndarray | None) -> DataFrame:
    """``lang, phrase, f`` for the phrases of k words; of words also the empty phrase, which
    stands for all of them."""
    shared = chunks.sparkSession.sparkContext.broadcast(likely)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, bits = Counts(), shared.value
        names = ["lang", "k", "phrase", "f"]
        for batch in batches:
            langs, whole, texts, times = (batch.column(i) for i in range(4))
            whole, times = whole.to_numpy(zero_copy_only=False), times.to_numpy()
            texts, rows = texts.cast(pa.binary()).to_pylist(), defaultdict(list)
            for i, lang in enumerate(langs.to_pylist()):
                rows[lang].append(i)
            for lang, at in rows.items():
                line = b" . ".join([texts[i] for i in at]) + b" ."
                begin, end = spans(line)
                sizes = np.array([texts[i].count(b" ") + 2 for i in at])  # with the stop behind
                place = np.arange(len(begin)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                owned = place < np.repeat(np.where(whole[at], sizes, sizes - 1 - WINDOW), sizes)
                stops = (end - begin == 1) & (np.frombuffer(line, np.uint8)[begin] == STOP)
                found = likely_starts(hashes(line, begin, end), owned, stops, k, lang, bits)
                weights = np.repeat(times[at], sizes)[found]
                own = counts[lang, k]
                if k == 1:
                    own[ALL] += int(weights.sum())
                for a, b, n in zip(begin[found].tolist(), end[found + k - 1].tolist(), weights.tolist(), strict=True):
                    own[line[a:b]] += n
                if counts.many():
                    yield from counts.rows(names)
        yield from counts.rows(names)

    found = chunks.select("lang", "whole", "chunk", "n").mapInArrow(run, "lang string, k long, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def bit_map(frequent: DataFrame) -> np.ndarray:
    """A map of BITS bits with those of the phrases set; its size doesn't depend on them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                begin, end = spans(phrase)
                found.append(int(placed(mixed(hashes(phrase, begin, end), len(begin)), lang)[0]))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["p"])

    places = frequent.select("lang", "phrase").mapInArrow(run, "p long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 32).cast("int"))
    words = places.groupBy((F.col("p") / 32).cast("long").alias("i")).agg(F.bit_or(bit).alias("w"))
    out = np.zeros(BITS // 32, "<u4")
    rows = words.toPandas()  # BITS / 32 rows at most
    out[rows["i"].to_numpy(np.int64)] = rows["w"].to_numpy(np.int64).astype("<u4")
    return out.view(np.uint8)


def without_contained(candidates: DataFrame) -> DataFrame:
    """Candidates that no longer one with as many occurrences contains. The one a word longer
    suffices: a phrase between two of equal frequency has it too."""
    space = F.lit(" ")
    longer = candidates.where("k > 2")
    inner = [longer.select("lang", F.call_function("substring_index", F.col("phrase"), space, n.cast("int")).alias("phrase"), "f") for n in (F.col("k") - 1, 1 - F.col("k"))]
    held = inner[0].unionByName(inner[1]).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    out = candidates.join(held.hint("merge"), ["lang", "phrase"], "left")
    return out.where(F.col("most").isNull() | (100 * F.col("most") < 100 * F.col("f"))).drop("most")


def scored(candidates: DataFrame, frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` by the cut of lowest score, of equal ones the first."""
    sized = looked_up(candidates, totals, ["lang"])
    each = sized.select("lang", "phrase", F.col("f").alias("a"), "n", F.col("k").alias("size"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("k") - 1)).alias("k"))
    space = F.lit(" ")
    parts = each.withColumns({"first": F.call_function("substring_index", F.col("phrase"), space, F.col("k").cast("int")), "rest": F.call_function("substring_index", F.col("phrase"), space, (F.col("k") - F.col("size")).cast("int"))})
    known = frequent.select("lang", "phrase", "f")
    cuts = stored(parts, "phrase-cuts")
    left = stored(looked_up(cuts, known.toDF("lang", "first", "l"), ["lang", "first"]), "phrase-left")
    both = looked_up(left, known.toDF("lang", "rest", "r"), ["lang", "rest"])
    score = F.expr("cast((cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as bigint)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    out = both.groupBy("lang", "phrase", "a", "n").agg(best).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    out = stored(out, "phrase-scores")
    for used in (cuts, left):
        discard(used)
    return out


def top(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of each language; parts of a language are cut to their first before."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.crc32(F.col("phrase").cast("binary")) % SHARES
    some = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))).where(F.col("rank") <= n)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= n).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first TOP phrases of each language.

    A null text is empty, a null language is ``und``. Repeated rows count as often as they
    occur. Ties in score fall to the higher count, then to the smaller phrase in UTF-8 order.
    Texts of any length are parsed whole; other columns are ignored; an empty table, or one
    without frequent phrases, gives no rows.
    """
    chunks = stored(parse(docs), "phrase-chunks")
    levels, likely, totals = [], None, None
    for k in range(1, LONGEST + 1):
        level = stored(counted(chunks, k, likely).where(F.col("f") >= LEAST).withColumn("k", F.lit(k)), f"phrases-{k}")
        if k == 1:
            totals = level.where(F.col("phrase") == ALL.decode()).select("lang", F.col("f").alias("n"))
            level = level.where(F.col("phrase") != ALL.decode())
        levels.append(level)
        if k == LONGEST or level.isEmpty():
            break
        likely = bit_map(level)
    discard(chunks)
    frequent = levels[0]
    for level in levels[1:]:
        frequent = frequent.unionByName(level)
    candidates = stored(without_contained(frequent.where("k > 1")), "phrase-candidates")
    return top(scored(candidates, frequent, totals), TOP)
