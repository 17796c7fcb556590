"""Secret scans over an incremental blob ledger, with DataFrame functions only.

A text is a blob named by its SHA-256. However many paths, versions or copies carry a
blob, it is scanned once per rule version: the ledger keeps the pairs of blob and rule
version that were scanned and what they gave. Each version of a corpus scans only the
pairs that the ledger lacks, appends them, and joins the findings of the current rule
versions back to all rows that carry the blob. ``StoredLedger`` keeps a ledger in a folder that
later sessions open; ``Ledger`` is one of frames.
Spans come from the pieces between matches: their lengths and those of the matches, summed
in order, are the offsets.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import Conflict, Part, Store
from .common import stored, text_of


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost non-overlapping matches; a match stays if its ``group``
    has at least ``least`` characters. ``hint`` matches wherever the pattern can."""

    name: str
    version: int
    pattern: str
    hint: str
    group: int = 0
    least: int = 1


# The rules. A run of hex digits or capitals is taken whole, so its least
# length can stand in the pattern; the lookbehind keeps long runs from being tried again.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"(?i)(?:pass(?:word|wd)|secret|token|api_?key)[\"']?\x20*[:=]", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", r"AKIA[A-Z0-9]{16}"),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{24,}", r"[0-9a-f]{24}"),
)


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


#: Bits of the map that leaves known texts out of the shuffle; 8 MB, whatever the input.
BITS = 1 << 26


@dataclass(frozen=True)
class Ledger:
    """``pairs``: ``blob, rule, version`` of what was scanned; ``findings``: ``blob, rule,
    version, start, end`` of what that found."""

    pairs: DataFrame
    findings: DataFrame


def unseen(blobs: DataFrame, rules: tuple[Rule, ...], pairs: DataFrame | None) -> DataFrame:
    """The rows of ``blobs`` with ``rules``, the names of the rules whose version has not
    scanned the blob; rows without any are left out."""
    if pairs is None:
        return blobs.withColumn("rules", F.array(*(F.lit(r.name) for r in rules)))
    current = " or ".join(f"rule = '{r.name}' and version = {r.version}" for r in rules)
    done = pairs.where(current).groupBy("blob").agg(F.collect_set("rule").alias("done"))
    left = F.array_except(F.array(*(F.lit(r.name) for r in rules)), F.coalesce("done", F.array().cast("array<string>")))
    return blobs.join(done, "blob", "left").withColumn("rules", left).drop("done").where(F.size("rules") > 0)


def scan(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, rule, start, end`` for each finding in ``blob, text, rules``; code points,
    end exclusive."""
    hit = texts.withColumns(
        {f"hit_{r.name}": F.array_contains("rules", r.name) & F.col("text").rlike(r.hint) for r in rules}
    )
    found = [
        F.when(
            F.col(f"hit_{r.name}"),
            F.struct(
                F.lit(r.name).alias("rule"),
                F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0)).alias("matches"),
                F.split("text", r.pattern, -1).alias("pieces"),
                F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group)).alias("groups"),
            ),
        )
        for r in rules
    ]
    some = hit.where(" or ".join(f"hit_{r.name}" for r in rules)).select("blob", F.explode(F.array_compact(F.array(*found))).alias("f"))
    each = some.select("blob", "f.rule", F.posexplode(F.arrays_zip("f.matches", "f.pieces", "f.groups")).alias("i", "m"))
    measured = each.where(F.col("m.matches").isNotNull()).select(
        "blob", "rule", "i", F.length("m.pieces").cast("long").alias("gap"), F.length("m.matches").cast("long").alias("n"), F.length("m.groups").alias("g")
    )
    # one text's matches of one rule at a time, so a partition is bounded by a text
    upto = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    least = F.coalesce(*(F.when(F.col("rule") == r.name, F.lit(r.least)) for r in rules))
    return measured.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(upto)).where(F.col("g") >= least).select(
        "blob", "rule", (F.col("end") - F.col("n")).alias("start"), "end"
    )


def likely_in(texts: DataFrame, blobs: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose blob is in ``blobs``, and a few others: a bit for a hash of
    each blob goes out in a map of fixed size and is looked up where the text lies. The more
    blobs there are, the more others pass; none of theirs is lost."""
    place = F.pmod(F.xxhash64("blob"), F.lit(BITS))
    numbered = lambda df: df.withColumn("place", place).selectExpr("*", "bitmap_bucket_number(place) as bucket", "bitmap_bit_position(place) as bit")
    maps = stored(numbered(blobs.select("blob")).groupBy("bucket").agg(F.expr("bitmap_construct_agg(bit)").alias("map")), "unseen-bits")
    near = numbered(texts).join(F.broadcast(maps), "bucket")
    is_set = "shiftright(cast(conv(hex(substring(map, cast(bit div 8 as int) + 1, 1)), 16, 10) as int), cast(bit % 8 as int)) % 2 = 1"
    return near.where(is_set).select(*texts.columns)


def scan_new(docs: DataFrame, rules: tuple[Rule, ...] = RULES, pairs: DataFrame | None = None) -> Ledger:
    """What the blobs of ``docs`` add to the scanned ``pairs``. Copies of a text meet
    before the shuffle. Unseen blobs are found by their ids alone; then only texts that may
    be theirs are shuffled."""
    t = docs.select(text_of().alias("text")).select(blob_id(F.col("text")).alias("blob"), "text")
    if pairs is not None:
        t = likely_in(t, unseen(t.select("blob").distinct(), rules, pairs))
    texts = unseen(t.groupBy("blob").agg(F.first("text").alias("text")), rules, pairs)
    version = F.create_map(*(x for r in rules for x in (F.lit(r.name), F.lit(r.version))))[F.col("rule")]
    scanned = texts.select("blob", F.explode("rules").alias("rule")).withColumn("version", version)
    return Ledger(scanned, scan(texts, rules).select("blob", "rule", version.alias("version"), "start", "end"))


PAIRS = "blob binary, rule string, version int"
FINDINGS = f"{PAIRS}, start long, end long"


class StoredLedger(Store):
    """A ledger in the folder ``root``, made of appends. Each writes its pairs and findings aside
    and becomes part of the ledger by one commit, so a write that dies leaves the ledger as it
    was. Of two that append at a time the second scans again what is still unseen, so no pair
    is listed twice. An append adds two small folders; nothing merges them."""

    def opened(self) -> tuple[int, int, Ledger]:
        """The version, the number of appends, and the ledger as it stands."""
        version, parts = self.ledger()

        def frame(bucket: int, schema: str) -> DataFrame:
            paths = [p.path for k, p in sorted(parts.items()) if k[1] == bucket]
            return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

        return version, len(parts) // 2, Ledger(frame(0, PAIRS), frame(1, FINDINGS))

    def update(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> Ledger:
        """Scan what ``docs`` adds, append it, and return the ledger with it."""
        while True:
            version, n, known = self.opened()
            new = scan_new(docs, rules, known.pairs if n else None)
            parts = {}
            for bucket, (name, rows) in enumerate((("pairs", new.pairs), ("findings", new.findings))):
                path = f"{self.root}/data/{uuid.uuid4().hex}-{name}"
                rows.write.parquet(path)
                parts[n, bucket] = Part(n, bucket, path, 0, 0, "0", name)
            if self.spark.read.schema(PAIRS).parquet(parts[n, 0].path).isEmpty():
                return known
            try:
                self.commit(version, parts)
            except Conflict:
                continue
            return self.opened()[2]


def update(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: Ledger | StoredLedger | None = None) -> Ledger:
    """``ledger`` with what ``docs`` adds, which a stored ledger keeps; else it is written to the
    shared folder."""
    if isinstance(ledger, StoredLedger):
        return ledger.update(docs, rules)
    new = scan_new(docs, rules, ledger.pairs if ledger else None)
    new = Ledger(stored(new.pairs, "ledger-pairs"), stored(new.findings, "ledger-findings"))
    return Ledger(ledger.pairs.unionByName(new.pairs), ledger.findings.unionByName(new.findings)) if ledger else new


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: Ledger | StoredLedger | None = None) -> DataFrame:
    """``doc_id, n_<rule>..., base_sha256, spans`` for each row of ``docs``, by the findings
    that ``ledger`` holds and those of the pairs that it lacks.

    Null text counts as empty, without findings: counts 0, empty ``spans``. Repeated rows
    and copies get equal results from one scan. Findings of rule versions other than those
    of ``rules`` are passed over. Other columns are ignored; an empty table gives an empty
    result. ``spans`` lists kind:start:end by start, then in the order of ``rules``.
    """
    current = " or ".join(f"rule = '{r.name}' and version = {r.version}" for r in rules)
    found = update(docs, rules, ledger).findings.where(current)
    place = F.coalesce(*(F.when(F.col("rule") == r.name, F.lit(i)) for i, r in enumerate(rules)))
    per_blob = found.groupBy("blob").agg(
        *(F.count_if(F.col("rule") == r.name).alias(f"n_{r.name}") for r in rules),
        F.sort_array(F.collect_list(F.struct("start", place.alias("place"), "end"))).alias("all"),
    )
    shown = F.array_join(
        F.transform("all", lambda x: F.concat_ws(":", F.element_at(F.array(*(F.lit(r.name) for r in rules)), x["place"] + 1), x["start"], x["end"])), ","
    )
    # written out, so that a blob that many rows carry meets a table, whose join Spark can split
    per_blob = stored(per_blob.withColumn("spans", shown).drop("all"), "blob-findings")
    carried = docs.select("doc_id", blob_id(text_of()).alias("blob")).join(per_blob, "blob", "left")
    spans = F.coalesce("spans", F.lit(""))
    return carried.select(
        "doc_id", *(F.coalesce(f"n_{r.name}", F.lit(0)).cast("long").alias(f"n_{r.name}") for r in rules), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans")
    )
