"""Personal data by bootstrapped contextual extraction.

Fixed forms (addresses, numbers) are the seed entities. The words around them make lexical
patterns; Spark scores the graph of patterns and of the identifier-like strings that they
surround, a few times in turn: a pattern is as sure as the share of its occurrences that
surround a likely entity, a string as sure as its patterns make it. Patterns of high
confidence then mark identifiers that no fixed form covers.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, stored, text_of

# The forms of the seed entities, in the order in which kinds are listed.
KINDS = ("email", "ip", "card", "phone", "context")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # the lookbehind keeps long runs from being tried again
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Distinct strings a pattern needs, confidence from which it extracts, rounds of scoring.
SUPPORT, CONFIDENCE, ROUNDS = 5, 0.8, 3
#: Patterns that one broadcast block holds, about.
BLOCK_PATTERNS = 500_000

token = re.compile(rf"[^{SPACE}]+")
MARKS = "!\"#$%&'()*+,./:;<=>?[\\]^_`{|}~-¿¡«»…“”‘’"


def emails(text: str) -> list[tuple[int, int]]:
    """Each @ ends one run of local characters, so the text is walked once."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start, m = at, DOMAIN.match(text, at + 1)
        if m:
            while start > floor and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                out.append((start, m.end()))
                floor = m.end()
        at = text.find("@", max(at + 1, floor))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def ips(text: str) -> list[tuple[int, int]]:
    fits = lambda part: len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255
    return [m.span() for m in IP.finditer(text) if all(map(fits, m.group().split(".")))]


def cards(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CARD.finditer(text) if 12 <= len(d := digits(m.group())) <= 19 and luhn(d)]


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]


def entities(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, by start, then kind."""
    found = []
    for kind, find in enumerate((emails, ips, cards, phones)):
        found += [(a, kind, b) for a, b in find(text)]
    return sorted(found)


digit = re.compile("[0-9]")


def bare(word: str) -> str:
    return word.strip(MARKS).lower()


def is_identifier(s: str) -> bool:
    """Whether a word without marks at its ends may name someone: 5 to 64 characters, four
    digits or an @ among them."""
    return 5 <= len(s) <= 64 and ("@" in s or sum("0" <= c <= "9" for c in s) >= 4)


def candidates(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, str, bool, str, str]]:
    """(start, end, value, is seed, left pattern, middle pattern) of the entities and of the
    identifier-like words outside them. The patterns are the two whole words before, and the
    word before with the word after and how many words lie between. Words of nothing but
    marks don't count."""
    spans = [(a, b, True) for a, _, b in known]
    ends, starts, words = [], [], []  # of the words that count
    begins, reach = [], []  # of the entities by start, and how far those up to each one reach
    for a, _, b in sorted(known):
        begins.append(a), reach.append(max(b, reach[-1] if reach else b))
    for m in token.finditer(text):
        word = m.group()
        if w := bare(word):
            starts.append(m.start()), ends.append(m.end()), words.append(w)
        if digit.search(word) or "@" in word:
            core = word.strip(MARKS)
            start = m.start() + len(word) - len(word.lstrip(MARKS))
            before = bisect_left(begins, start + len(core))  # entities that begin before the word ends
            if is_identifier(core) and not (before and reach[before - 1] > start):
                spans.append((start, start + len(core), False))
    out = []
    for a, b, seed in sorted(spans):
        i, j = bisect_right(ends, a), bisect_left(starts, b)  # the words i to j lie in or touch it
        left = " ".join(["L", words[i - 2], words[i - 1]]) if i > 1 and j > i else ""
        middle = " ".join([f"M{j - i}", words[i - 1], words[j]]) if i and j > i and j < len(words) else ""
        out.append((a, b, text[a:b].lower(), seed, left, middle))
    return out


CANDIDATE = "array<struct<start:long,end:long,value:string,seed:boolean,left:string,middle:string>>"


def extract(docs: DataFrame) -> DataFrame:
    """``doc_id, base, candidates`` for each row: entities as start, kind, end, and candidates."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    base_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    cand_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("seed", pa.bool_()), ("left", pa.string()), ("middle", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, cands = [], []
            for text in batch.column(1):
                text = text.as_py()
                found = entities(text) if "@" in text or digit.search(text) else []
                base.append([dict(zip(("start", "kind", "end"), x)) for x in found])
                cands.append([dict(zip(("start", "end", "value", "seed", "left", "middle"), x)) for x in candidates(text, found)] if found or digit.search(text) or "@" in text else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, base_type), pa.array(cands, cand_type)], ["doc_id", "base", "candidates"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, base array<struct<start:long,kind:int,end:long>>, candidates {CANDIDATE}")


def occurrences(docs: DataFrame, patterns: DataFrame, block: int = BLOCK_PATTERNS) -> DataFrame:
    """``pattern, total``: how often the words of each pattern occur with words in its gap,
    over all rows, read as ``candidates`` reads them. Patterns go out in blocks of bounded size, each with its own pass."""
    total = patterns.count()
    parts = None
    for i in range(-(-total // block) or 1):
        rows = [r["pattern"] for r in patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(-(-total // block) or 1)) == i).select("pattern").collect()]
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocabulary: dict[str, int] = {}
            split = [p.split(" ") for p in shared.value]
            for _, a, b in split:
                vocabulary.setdefault(a, len(vocabulary) + 1), vocabulary.setdefault(b, len(vocabulary) + 1)
            wanted: dict[str, dict[int, str]] = {}
            for (kind, a, b), p in zip(split, shared.value):
                wanted.setdefault(kind, {})[vocabulary[a] << 32 | vocabulary[b]] = p
            seen: Counter = Counter()
            for batch in batches:
                for text in batch.column(0):
                    words = [w for w in map(bare, token.findall(text.as_py())) if w]
                    codes = np.fromiter(map(vocabulary.get, words, repeat(0)), np.uint64, len(words))
                    # L: two words, then any; Mk: a word, k others, a word
                    for kind, own in wanted.items():
                        gap = 1 if kind == "L" else int(kind[1:]) + 1
                        a, b = codes[: len(codes) - gap - (kind == "L")], codes[gap : len(codes) - (kind == "L")]
                        if not len(b):
                            continue
                        both = np.flatnonzero((a[: len(b)] > 0) & (b > 0))
                        for code in ((a[both] << np.uint64(32)) | b[both]).tolist():
                            if code in own:
                                seen[own[code]] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["pattern", "n"])

        part = docs.select(text_of().alias("text")).mapInArrow(run, "pattern string, n long")
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("pattern").agg(F.sum("n").alias("total"))


def confident(graph: DataFrame, totals: DataFrame) -> DataFrame:
    """``pattern`` of those with high confidence, from ``pattern, value, seed, n`` and the
    patterns' occurrences. Scores of a round are written out before the next."""
    graph = stored(graph.join(totals, "pattern"), "pii-graph")
    scores = graph.groupBy("value").agg(F.max(F.col("seed").cast("double")).alias("score"))
    rated = None
    for _ in range(ROUNDS):
        sums = graph.join(scores, "value").groupBy("pattern").agg(
            F.sum(F.col("n") * F.col("score")).alias("likely"), F.max("total").alias("total"), F.count_if(F.col("score") >= 0.5).alias("support")
        )
        sure = F.when(F.col("support") >= SUPPORT, F.col("likely") / F.greatest("total", "likely")).otherwise(0.0)
        rated = stored(sums.select("pattern", sure.alias("confidence")), "pii-patterns")
        doubt = F.exp(F.sum(F.log(1 - F.least(F.col("confidence"), F.lit(0.999)))))
        scores = stored(
            graph.join(rated, "pattern").groupBy("value").agg(F.greatest(F.max(F.col("seed").cast("double")), 1 - doubt).alias("score")), "pii-scores"
        )
    return rated.where(F.col("confidence") >= CONFIDENCE).select("pattern")


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` and ``n_context`` for
    each row of ``docs``.

    ``spans`` lists kind:start:end by start, then kind; code points, end exclusive.
    ``context`` spans are the method's and never overlap a base span. Null text counts as
    empty, without spans. Repeated rows get equal results and count as often as they occur.
    Other columns are ignored; an empty table gives an empty result.
    """
    found = stored(extract(docs).withColumn("row", F.monotonically_increasing_id()), "pii-rows")
    each = found.select("row", F.explode("candidates").alias("c")).select("row", "c.*")
    placed = each.select("row", "start", "end", "value", "seed", F.explode(F.array("left", "middle")).alias("pattern")).where("pattern <> ''")
    graph = placed.groupBy("pattern", "value").agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n"))
    enough = stored(graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("values")).where(F.col("values") >= SUPPORT).select("pattern"), "pii-candidates")
    sure = confident(graph.join(enough, "pattern", "left_semi"), stored(occurrences(docs, enough), "pii-totals"))
    more = (
        placed.where("not seed").join(sure, "pattern", "left_semi").select("row", "start", "end").distinct()
        .groupBy("row").agg(F.collect_list(F.struct("start", F.lit(4).alias("kind"), "end")).alias("more"))
    )
    rows = found.drop("candidates").join(more, "row", "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    shown = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.element_at(F.lit(list(KINDS)), x["kind"] + 1), x["start"], x["end"])), ","
    )
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    every = F.array_sort(F.concat("base", F.coalesce("more", none)))
    return rows.select(
        "doc_id", *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])),
        F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(every).alias("spans"), F.size(F.coalesce("more", none)).cast("long").alias("n_context"),
    )
