"""Benchmark decontamination by spaced-seed hashing.

A seed is a hash of the words at the 1-positions of a fixed mask, so a substituted word
under a 0 does not disturb it. Seeds of the test items are laid out as sorted arrays and
joined with the seeds of each document where it lies; around each hit the words of the
item and of the document are compared along the hit's diagonal, and any stretch that is
long enough counts if enough of its words agree.

Test sets go to the executors in blocks of a bounded number of words. A larger set makes
more blocks, each with a pass of its own over the documents, never a larger broadcast.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, row_key, stored, text_of

# The masks, each with six compared words. They hit every stretch of 13 to 25
# words with 80 % equal words, and a longer one has a half that is such a stretch.
MASKS = ("111111", "1111011", "11011011", "101101011", "1101000111")
#: Shortest stretch that counts, unless the item is shorter, and the share of equal words in it.
LEAST, SHARE = 13, 0.8
#: Words of test items that one broadcast block holds, about.
BLOCK_WORDS = 2_000_000

words_of = re.compile(r"\w+").findall


@dataclass
class Block:
    """Test items as word numbers, and their seeds: mask, sorted hashes with item and place."""

    items: list[tuple[int, np.ndarray]]
    vocabulary: dict[str, int]
    seeds: list[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def hashes(codes: np.ndarray, mask: str) -> np.ndarray:
    """The seed at each place where the mask fits."""
    n = len(codes) - len(mask) + 1
    h = np.zeros(max(0, n), np.uint64)
    if n > 0:
        for i, c in enumerate(mask):
            if c == "1":
                h = (h ^ codes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
    return h


SLOTS = 1 << 20
#: Words of alignments that are compared at a time.
CELLS = 1 << 20


def masks(n: int) -> tuple[str, ...]:
    """The masks of an item of ``n`` words. One shorter than a stretch must agree as a whole,
    with m = n // 5 words substituted at most: of m + 2 parts of it, two are left untouched."""
    if n >= LEAST:
        return MASKS
    parts = np.array_split(np.arange(n), n // 5 + 2)
    pairs = (set(np.concatenate(pair).tolist()) for pair in combinations(parts, 2))
    return tuple("".join("01"[i in pair] for i in range(n)) for pair in pairs)


def build(rows: list[tuple[int, str]]) -> Block:
    """A block of ``(item_id, text)``; of items with equal words the smallest id stays."""
    vocabulary: dict[str, int] = {}
    by_words: dict[bytes, tuple[int, np.ndarray]] = {}
    for item, text in sorted(rows):
        codes = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text.lower())], np.uint64)
        if len(codes):
            by_words.setdefault(codes.tobytes(), (item, codes))
    items = list(by_words.values())
    seeds = []
    by_mask: dict[str, list[int]] = {}
    for k, (_, codes) in enumerate(items):
        for mask in masks(len(codes)):
            by_mask.setdefault(mask, []).append(k)
    for mask, owners in by_mask.items():
        found = [(hashes(items[k][1], mask), k) for k in owners]
        h = np.concatenate([x for x, _ in found] or [np.zeros(0, np.uint64)])
        owner = np.concatenate([np.full(len(x), k, np.int64) for x, k in found] or [np.zeros(0, np.int64)])
        place = np.concatenate([np.arange(len(x)) for x, _ in found] or [np.zeros(0, np.int64)])
        order = np.argsort(h, kind="stable")
        slots = np.zeros(SLOTS, bool)
        slots[h >> np.uint64(44)] = True
        seeds.append((mask, h[order], owner[order], place[order], slots))
    return Block(items, vocabulary, seeds)


def best_stretch(equal: np.ndarray, least: int = LEAST) -> tuple[int, int, int]:
    """(begin, end, equal words) of the stretch of at least ``least`` words with the largest
    sum, the longest of several: equal words count for it and others against it so that
    ``SHARE`` of equal ones is 0. (0, 0, 0) if no such stretch reaches that share."""
    if len(equal) < least:
        return 0, 0, 0
    worth = np.where(equal, round(100 * (1 - SHARE)), -round(100 * SHARE))
    total = np.concatenate(([0], np.cumsum(worth)))
    low = np.minimum.accumulate(total[: len(total) - least])  # at the last begin that each end allows
    gain = total[least:] - low
    if gain.max() < 0:
        return 0, 0, 0
    last = int(np.flatnonzero(gain == gain.max())[-1])
    begin = int(np.flatnonzero(total[: last + 1] == low[last])[0])
    return begin, last + least, int(equal[begin : last + least].sum())


def alignments(codes: np.ndarray, block: Block) -> Iterator[np.ndarray]:
    """Item numbers and shifts (rows) at which a seed of the text is one of an item: in several
    arrays, each of distinct alignments; two of them may share some. A shift is the place in
    the text where the item's first word would stand."""
    for mask, sorted_h, owner, place, slots in block.seeds:
        h = hashes(codes, mask)
        at = np.flatnonzero(slots[h >> np.uint64(44)])
        low, high = (np.searchsorted(sorted_h, h[at], side) for side in ("left", "right"))
        at, low, high = at[high > low], low[high > low], high[high > low]
        upto = np.cumsum(high - low)
        begin = 0
        while begin < len(at):
            done = upto[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, done + CELLS, "right")))
            n = high[begin:end] - low[begin:end]
            seed = np.repeat(high[begin:end] - np.cumsum(n), n) + np.arange(n.sum())
            pairs = owner[seed] << 40 | (np.repeat(at[begin:end], n) - place[seed] + (1 << 39))
            pairs = np.unique(pairs)
            yield np.stack((pairs >> 40, (pairs & ((1 << 40) - 1)) - (1 << 39)), axis=1)
            begin = end


def stretches(codes: np.ndarray, block: Block, pairs: np.ndarray) -> np.ndarray:
    """``item number, begin, end, equal words`` of the alignments that have a stretch as
    ``best_stretch`` finds it, by sums that run over CELLS words of many alignments at once."""
    numbers, which = np.unique(pairs[:, 0], return_inverse=True)
    sizes = np.array([len(block.items[k][1]) for k in numbers])
    order = np.argsort(sizes[which], kind="stable")
    padded, out, a = np.append(codes, np.uint64(0)), [np.zeros((0, 4), np.int64)], 0
    while a < len(order):
        width = sizes[which[order[a:]]]
        some = order[a : a + max(1, int((np.arange(1, len(width) + 1) * width <= CELLS).sum()))]
        a += len(some)
        used, row = np.unique(which[some], return_inverse=True)
        wide = int(sizes[used].max())
        words = np.zeros((len(used), wide), np.uint64)
        for i, k in enumerate(used):
            words[i, : sizes[k]] = block.items[numbers[k]][1]
        words, at = words[row], pairs[some, 1][:, None] + np.arange(wide)
        inside = (words > 0) & (at >= 0) & (at < len(codes))
        equal = inside & (words == padded[np.where(inside, at, len(codes))])
        # what lies outside costs more than all else can bring
        worth = np.where(equal, round(100 * (1 - SHARE)), np.where(inside, -round(100 * SHARE), -100 * wide))
        zero = np.zeros((len(some), 1), np.int64)
        total, same = (np.concatenate((zero, np.cumsum(x, axis=1)), axis=1) for x in (worth, equal))
        least = np.minimum(LEAST, sizes[which[some]])
        for n in np.unique(least).tolist():
            i = np.flatnonzero(least == n)
            low = np.minimum.accumulate(total[i, : wide + 1 - n], axis=1)
            gain = total[i, n:] - low
            most = gain.max(axis=1)
            i, low, gain, most = i[most >= 0], low[most >= 0], gain[most >= 0], most[most >= 0]
            last = gain.shape[1] - 1 - np.argmax(gain[:, ::-1] == most[:, None], axis=1)
            begin = np.argmax(total[i, : wide + 1 - n] == np.take_along_axis(low, last[:, None], 1), axis=1)
            end, shift = last + n, pairs[some[i], 1]
            r = np.arange(len(i))
            out.append(np.stack((pairs[some[i], 0], shift + begin, shift + end, same[i][r, end] - same[i][r, begin]), axis=1))
    return np.concatenate(out)


def overlaps(text: str, block: Block, first: bool = False) -> list[tuple[int, int, int, int]]:
    """(item_id, begin, end, equal words) for each item with a stretch in the text; begin
    and end count the text's words. One stretch per item, the one with most equal words, of
    several the first. With ``first`` it is enough to find one item."""
    codes = np.fromiter(map(block.vocabulary.get, words_of(text.lower()), repeat(0)), np.uint64)
    best, tried = np.zeros((0, 4), np.int64), np.zeros((0, 2), np.int64)
    for pairs in alignments(codes, block):
        if len(tried):
            key = lambda x: x[:, 0] << 40 | (x[:, 1] + (1 << 39))
            pairs = pairs[~np.isin(key(pairs), key(tried))]
        tried = np.concatenate((tried, pairs))
        found = np.concatenate((best, stretches(codes, block, pairs)))
        found = found[np.lexsort((found[:, 1], -found[:, 3], found[:, 0]))]
        best = found[np.unique(found[:, 0], return_index=True)[1]]
        if first and len(best):
            break
    return sorted((block.items[k][0], a, b, n) for k, a, b, n in best.tolist())


def word_count():
    """A column function: the number of words of a text, as build() reads them."""

    @F.pandas_udf("long")
    def number(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: len(words_of(text.lower()))).astype("int64")

    return number


def words_hash():
    """A column function: a number that is equal for texts of equal words, as build() reads them."""

    @F.pandas_udf("long")
    def number(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: zlib.crc32(" ".join(words_of(text.lower())).encode())).astype("int64")

    return number


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS, unnamed: bool = False) -> Iterator[list[tuple[int, str]]]:
    """Rows of the test set in blocks of about ``block_words`` words; one pass each. Items of
    equal words come in one block. Null ids are left out, or come as 0 if ``unnamed``."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    rows = rows.withColumn("item_id", F.coalesce("item_id", F.lit(0))) if unnamed else rows.where("item_id is not null")
    total = rows.select(word_count()("text").alias("n")).agg(F.sum("n")).first()[0] or 0
    n = -(-total // block_words) or 1
    for i in range(n):
        yield [tuple(r) for r in (rows if n == 1 else rows.where(F.pmod(words_hash()("text"), F.lit(n)) == i)).collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, item_ids, item_id, begin, end, matched``: a row for each document that
    overlaps a test item, with all such items (of several with equal words the smallest) and the stretch of the one that agrees most
    (ties: the smallest item). Clean documents have no row.

    Null or empty texts and items without words overlap nothing; items with a null id are
    left out. Repeated rows are reported once, two texts under one id once each. Other
    columns are ignored; an empty table of either kind gives an empty result.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", row_key().alias("key"), text_of().alias("text"))
    found = None
    for rows in blocks(benchmark, block_words):
        shared = spark.sparkContext.broadcast(build(rows))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = [(i, o) for i, text in enumerate(batch.column(2)) for o in overlaps(text.as_py(), shared.value)]
                at = pa.array([i for i, _ in hits], pa.int64())
                names = ["doc_id", "key", "item_id", "begin", "end", "matched"]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *(pa.array([o[j] for _, o in hits], pa.int64()) for j in range(4))], names)

        part = keyed.mapInArrow(run, f"doc_id {kind}, key string, item_id long, begin long, end long, matched long")
        found = part if found is None else found.unionByName(part)
    top = F.max(F.struct("matched", (-F.col("item_id")).alias("less"), (-F.col("begin")).alias("first"), "end")).alias("top")
    return (
        found.groupBy("doc_id", "key")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), top)
        .select("doc_id", "item_ids", (-F.col("top.less")).alias("item_id"), (-F.col("top.first")).alias("begin"), "top.end", "top.matched")
    )


def short_items(benchmark: DataFrame, least: int) -> DataFrame:
    """``item_id, text, n_words`` of the items of fewer than ``least`` words, on which
    ``without_contaminated`` removes nothing."""
    return benchmark.select("item_id", "text", word_count()(text_of()).alias("n_words")).where(F.col("n_words") < least)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS, least: int = 1) -> DataFrame:
    """The rows of ``docs`` that overlap no test item of at least ``least`` words, with or
    without an id, with all their columns. They are filtered where they lie, a pass for each
    block. ``short_items`` lists the items that are too short to remove documents for."""
    if least > 1:
        benchmark = benchmark.where(word_count()(text_of()) >= least)
    (mark,) = fresh(docs, "is_clean")
    for i, rows in enumerate(blocks(benchmark, block_words, unnamed=True)):
        if i:  # so that no worker holds more than one block
            docs = stored(docs, "decontaminated")
        shared = docs.sparkSession.sparkContext.broadcast(build(rows))
        docs = docs.withColumn(mark, clean_mark(shared)(text_of())).where(mark).drop(mark)
    return docs


def clean_mark(shared):
    """A column function: whether a text overlaps nothing in a block."""

    @F.pandas_udf("boolean")
    def mark(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: not overlaps(text, shared.value, first=True)).astype(bool)

    return mark
