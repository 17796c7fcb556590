"""Quality selection by importance resampling with hashed n-gram models.

Two bag-of-n-grams models over a fixed number of hash buckets, one of target text and one
of the whole raw corpus, give each document the log ratio of its likelihoods: the sum of
the log ratios of its n-grams. Gumbel noise that is fixed for each row is added, and the k
largest sums are a sample without replacement in proportion to the importance weights. The
k-th largest is found by histograms of a fixed number of buckets, without sorting the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, row_key, stored, text_of

#: Hash buckets of the models, half for single tokens and half for pairs.
BUCKETS = 20_000
#: Labelled ids whose documents the target model is fitted on, at most.
SAMPLE = 20_000
#: Gumbel noise is multiplied by this: 1 samples in proportion to the weights, 0 takes the k best.
TEMPERATURE = 1.0
#: Counts that each bucket of the target gets more; those of the raw model, in proportion to its size.
SMOOTHING = 20.0

tokens_of = re.compile(r"\w+|[^\w\s]+").findall


class Codes(dict):
    """Token to a stable 32-bit hash; forgets all when full."""

    def __missing__(self, token: str) -> int:
        from xxhash import xxh32_intdigest

        if len(self) >= 300_000:
            self.clear()
        self[token] = h = xxh32_intdigest(token.encode("utf-8", "surrogatepass"))
        return h


AGAIN = 0x5BD1E995


def buckets(text: str, codes: Codes) -> np.ndarray:
    """Hash buckets of a text's tokens and pairs of tokens. A token that equals one of the
    two before it counts as one common token, so repetition looks alike in any words."""
    raw = np.fromiter(map(codes.__getitem__, tokens_of(text.lower())), np.uint64)
    c = raw.copy()
    for back in (1, 2):
        c[back:][raw[back:] == raw[:-back]] = AGAIN
    half = BUCKETS // 2
    mixed = (c[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (c[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    return np.concatenate([c % half, half + (mixed >> np.uint64(20)) % half]).astype(np.int64)


def counts(texts: DataFrame) -> np.ndarray:
    """n-gram counts of all rows: each task sums its own, so the driver adds up one row for
    each bucket, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, total = Codes(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(buckets(text.as_py(), codes), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.float64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log of target over raw probability for each bucket, singles and pairs apart."""
    out = np.zeros(BUCKETS)
    for part in (slice(0, BUCKETS // 2), slice(BUCKETS // 2, BUCKETS)):
        t, r = target[part], raw[part]
        t, r = t + SMOOTHING, r + SMOOTHING * max(1.0, r.sum() / max(1.0, t.sum()))
        out[part] = np.log(t / t.sum()) - np.log(r / r.sum())
    return out


def ordered(x: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the doubles, equal for equal ones."""
    bits = (np.asarray(x, np.float64) + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64((1 << 63) - 1))


def weighed(docs_text: Column, ratio, noise: Column) -> Column:
    """``log_weight``, the sum of log ratios over a text's n-grams (0 without tokens), and
    ``level``, an integer in the order of the weight with its noise."""

    @F.pandas_udf("log_weight double, level long")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        codes = Codes()
        for texts, noises in batches:
            weights = np.array([float(ratio.value[buckets(text, codes)].sum()) for text in texts], np.float64)
            yield pd.DataFrame({"log_weight": weights, "level": ordered(weights + noises.to_numpy(np.float64))})

    return score(docs_text, noise)


def gumbel(key: Column) -> Column:
    """Noise that is a function of the row."""
    u = (F.conv(F.substring(key, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(-F.log(u))


#: Levels are 64-bit integers; a histogram looks at so many of their bits at a time.
LEVEL_BITS, LEVELS = 13, 5


def kth_largest(keys: DataFrame, k: int) -> int:
    """The k-th largest of column ``level``, any long, by nested histograms; the least long if
    there are fewer."""
    prefix, above = 0, 0
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        inside = keys.where(F.shiftright("level", shift + LEVEL_BITS) == prefix) if level else keys
        rows = inside.groupBy(F.shiftright("level", shift).alias("b")).count().collect()  # 8,192 rows at most
        for b, n in sorted(((r["b"], r["count"]) for r in rows), reverse=True):
            if above + n >= k:
                prefix = b
                break
            above += n
        else:
            return -(1 << 63)
    return prefix


def select(
    docs: DataFrame, labels: DataFrame, columns: list[str] | None = None, k: int | None = None, fraction: float | None = None,
    sample: int = SAMPLE, temperature: float = TEMPERATURE,
) -> DataFrame:
    """``k`` rows of ``docs``, or the ``fraction`` of them, drawn in proportion to their
    importance weights, with their ``columns`` (all if not given) and ``log_weight``. With
    neither, the fraction is the share of quality 1 among the labels. Each text is read
    twice, for the raw model and for its weight; the columns are written out with the
    weight, as joining them back would shuffle every text.

    The target model is that of labelled documents of quality 1, the raw model that of all
    rows. Without a label of quality 1 there is no target and every row stays. Empty, null
    or token-less texts weigh 0 and pass or fail like any other; weights are compared as the
    doubles they are, however large; rows that tie with the k-th stay too; repeated rows share their noise. A column ``log_weight`` of ``docs`` is
    replaced. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "log_weight"])
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    bounded = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    good, all_known = bounded.agg(F.coalesce(F.sum("y"), F.lit(0)), F.count(F.lit(1))).first()
    target = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(bounded.where("y = 1").select("doc_id")), "doc_id").select("text")
    ratio = spark.sparkContext.broadcast(log_ratio(counts(target), counts(docs.select(text_of().alias("text")))) if good else np.zeros(BUCKETS))

    kept = docs.columns if columns is None else [c for c in columns if c != "log_weight"]
    (level,) = fresh(docs, "level")
    (both,) = fresh(docs, "weighed")
    scored = docs.withColumn(both, weighed(text_of(), ratio, temperature * gumbel(row_key())))
    scored = stored(scored.select(*kept, f"{both}.log_weight", F.col(f"{both}.level").alias(level)), "quality-scores")
    if k is None:
        share = fraction if fraction is not None else good / all_known if good else 1.0
        k = round(share * scored.count())
    least = kth_largest(scored.select(F.col(level).alias("level")), k) if k > 0 else (1 << 63) - 1
    return scored.where(F.col(level) >= least).drop(level)
