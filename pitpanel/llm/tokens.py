"""Token counts by a two-tier lookup of pre-token lengths.

Tier one is a broadcast table of frequent pre-tokens and their token counts. Tier two is
a bounded cache in each Python worker, filled by encoding the misses. No pre-token is
shuffled; documents stay where they were read. Counts never depend on what the table or
the caches hold: both only save encoding the same pre-token again.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

# Fixed value: the pre-token pattern of byte-level vocabularies.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Files and tasks that the table is made from; each task hands the driver one bounded row.
FILES, TASKS = 8, 8

#: Up to here all Unicode versions agree on letters, numbers and space; beyond it the
#: library's own splitter is used, whose Unicode tables may be older.
SETTLED = "ԯ"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def special_strings(path: str) -> list[str]:
    """Strings that the tokenizer of a file takes for one token each wherever they stand.
    Raises unless pre-tokens of such a file are those of PRETOKEN, byte by byte."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    pre = found.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    if not plain or found.get("normalizer") or found.get("model", {}).get("type", "BPE") != "BPE":
        raise ValueError(f"{path} is not a byte-level BPE tokenizer with the pre-tokens known here")
    added = found.get("added_tokens", [])
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
        raise ValueError(f"{path} has added tokens that take in their neighbours")
    return [t["content"] for t in added]


class Lengths(dict):
    """Pre-token to token count. A miss goes to a bounded cache, then to the encoder."""

    def __init__(self, known: dict[str, int], path: str, cache_size: int):
        from tokenizers import Tokenizer

        super().__init__(known)
        self.tokenizer = Tokenizer.from_file(path)
        self.split = regex.compile(PRETOKEN).findall
        special = sorted(special_strings(path), key=len, reverse=True)
        self.parts = regex.compile("|".join(map(regex.escape, special)) or r"(?!)").split
        self.unsettled = regex.compile(f"[^\\x00-{SETTLED}]").search
        self.cache_size, self.new, self.old = cache_size, {}, {}

    def __missing__(self, piece: str) -> int:
        n = self.new.get(piece)
        if n is None:
            n = self.old.get(piece)
            if n is None:
                n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
            if len(piece) <= 64:
                if len(self.new) >= self.cache_size:
                    self.old, self.new = self.new, {}
                self.new[piece] = n
        return n

    def pieces(self, text: str) -> list[str]:
        if self.unsettled(text):
            return [piece for piece, _ in self._library_pieces(text)]
        return self.split(text)

    def _library_pieces(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        return [(text[a:b], (a, b)) for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def count(self, text: str) -> int:
        parts = self.parts(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces(part))) for part in parts if part)


def sample(docs: DataFrame, sample_docs: int) -> DataFrame:
    """``text`` of about ``sample_docs`` rows from a few of the files that ``docs`` reads,
    or from all of it where it reads none. Row counts come from the files' footers."""
    files = sorted(docs.inputFiles(), key=lambda name: hashlib.md5(name.encode()).digest())[:FILES]
    some = docs
    if files and all(name.endswith(".parquet") for name in files):
        read = docs.sparkSession.read.parquet(*files)
        some = read if "text" in read.columns and read.schema["text"].dataType == docs.schema["text"].dataType else docs
    step = max(1, some.count() // max(1, sample_docs))
    return some.select(text_of().alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(step)) == 0)


def frequent_lengths(docs: DataFrame, path: str, sample_docs: int, per_task: int, size: int) -> dict[str, int]:
    """Tier one: at most ``size`` pre-tokens. A few tasks count the pre-tokens of a sample
    where they read it, and each hands over its ``per_task`` most frequent ones as one row,
    so no pre-token is shuffled and the driver merges TASKS bounded rows. The table only
    saves work; counts don't depend on it."""

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = regex.compile(PRETOKEN).findall, Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(piece for piece in split(text.as_py()) if len(piece) <= 64)
            if len(seen) > 40 * per_task:
                seen = Counter(dict(seen.most_common(20 * per_task)))
        best = seen.most_common(per_task)
        lists = [[p for p, _ in best]], [[n for _, n in best]]
        yield pa.RecordBatch.from_arrays([pa.array(lists[0], pa.list_(pa.string())), pa.array(lists[1], pa.list_(pa.int64()))], ["pieces", "counts"])

    merged: Counter = Counter()
    for r in sample(docs, sample_docs).coalesce(TASKS).mapInArrow(top, "pieces array<string>, counts array<long>").collect():
        merged.update(dict(zip(r["pieces"], r["counts"])))
    lengths = Lengths({}, path, 0)
    return {piece: lengths[piece] for piece, _ in sorted(merged.items(), key=lambda x: (-x[1], x[0]))[:size]}


def count_tokens(
    docs: DataFrame,
    path: str | None = None,
    limit: int = 512,
    sample_docs: int = 4_000,
    per_task: int = 8_192,
    table_size: int = 32_768,
    cache_size: int = 150_000,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs``.

    Null or empty text: 0 bytes, 0 tokens. Special strings inside a text count as one
    token each. Other tokenizers than byte-level BPE raise. Repeated rows give repeated results; other columns are ignored; an empty
    table gives an empty result. ``table_size`` bounds what is broadcast.
    """
    path = path or default_tokenizer()
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(frequent_lengths(docs, path, sample_docs, per_task, table_size))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(known.value, path, cache_size)
        for batch in batches:
            n = [lengths.count(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    t = docs.select("doc_id", text_of().alias("text")).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    out = t.mapInArrow(count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
