"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most 3 bits apart share a variant half way between them, so each
distinct fingerprint emits the variants around it, the shuffle brings equal variants
together, and what meets there is linked.

Half of a radius of 3 is one bit on one side and two on the other. Fingerprints an odd
number of bits apart differ in parity, so it is enough that those of even parity emit the
two-bit variants: all emit the 65 variants within one bit, even ones also the variants
with two bits flipped in the same 32-bit half. Of three differing bits two always lie in
one half, so this loses no pair and halves the two-bit variants.

At a variant all members within one bit of it are within 2 bits of each other, and any
member two bits away is within 3 bits of those. So each member links to the first near
one: a group that meets makes as many links as members, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, row_key, stored, text_of

RADIUS, SHINGLE, SEED = 3, 3, 42
#: Fingerprints whose variants (some 560 of 16 bytes each) one task makes and one meets, at most.
TASK_FINGERPRINTS = 50_000
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str) -> int:
    """64-bit SimHash, as a signed integer; 0 without words."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8").translate(LOWER).split()  # splits at space and 0x09 to 0x0D
    if not words:
        return 0
    joined, k = b" ".join(words), min(SHINGLE, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), (ends[k - 1 :] - 1).tolist())]
    h = np.array(hashes, "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keyed: bool = False) -> DataFrame:
    """``doc_id, fp`` for each row, and its ``row_key`` if asked for; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(text.as_py()) for text in batch.column(1)]
            more = [batch.column(2)] if keyed else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), *more], ["doc_id", "fp", "row_key"][: 2 + keyed])

    kind = docs.schema["doc_id"].dataType.simpleString()
    given = docs.select("doc_id", text_of().alias("text"), *([row_key().alias("row_key")] if keyed else []))
    return given.mapInArrow(run, f"doc_id {kind}, fp long" + ", row_key string" * keyed)


def masks() -> tuple[list[int], list[int]]:
    """Signed 64-bit masks: of at most one bit, and of two bits in one half."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    near = [0, *(signed(1 << i) for i in range(64))]
    far = [signed(1 << i | 1 << j) for half in (0, 32) for i in range(half, half + 32) for j in range(i + 1, half + 32)]
    return near, far


def links(fps: DataFrame) -> DataFrame:
    """``u, v``: links between distinct values of ``fp`` at most 3 bits apart, whose
    connected components are those of all such pairs."""
    near, far = masks()
    even = F.bit_count("fp") % 2 == 0
    # a file of fingerprints is small, but each makes hundreds of variants: deal them out first
    tasks = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-fps.count() // TASK_FINGERPRINTS))
    dealt = fps.repartition(tasks, "fp")
    variants = dealt.select("fp", F.explode(F.when(even, F.lit(near + far)).otherwise(F.lit(near))).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant")
    )
    met = variants.repartition(tasks, "variant").withColumn("away", F.bit_count(F.col("fp").bitwiseXOR(F.col("variant"))))
    # a variant's group is bounded by the ball around it, as fingerprints are distinct
    w = Window.partitionBy("variant").orderBy("away", "fp")
    hubs = met.select("fp", F.first("fp").over(w).alias("hub"), F.first("away").over(w).alias("hub_away"))
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("hub")))
    pairs = hubs.where((F.col("hub_away") <= 1) & (F.col("fp") != F.col("hub")) & (apart <= RADIUS))
    return pairs.select(F.greatest("fp", "hub").alias("u"), F.least("fp", "hub").alias("v")).distinct()


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step (Kiveris et al., 2014): a node's larger, or
    smaller, neighbours move to its least neighbour. Minima are summed before the shuffle
    and joined back, so no node's neighbours are gathered in one row."""
    both = edges.select("u", "v")
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.join(least, "u").where(F.col("v") > F.col("u") if large else F.lit(True)).select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``u, v``: the least node of its component. Each
    round is written to the shared folder; the driver sees a count and a checksum."""
    state, edges = None, stored(edges, "links")
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state, before = now, edges
        edges = stored(star(star(edges, True), False), "links")
        discard(before)


def grouped(hashed: DataFrame) -> DataFrame:
    """``fp, first_id, root`` for each distinct ``fp`` of ``hashed``: its smallest id, and the
    fingerprint that names its component, which is never null."""
    distinct = stored(hashed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp")))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that is reachable over links, its own
    included; a null id is passed over, and null if a component has no other. Null, empty
    and wordless texts have fingerprint zero and are linked like any other. Repeated rows
    stay repeated. Other columns are ignored; an empty table gives an empty result.
    """
    hashed = stored(fingerprints(docs), "fingerprints")
    rooted = grouped(hashed)
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_fp = stored(rooted.join(ids, "root").select("fp", "component_id"), "component-ids")
    return hashed.join(per_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def survivors(docs: DataFrame) -> DataFrame:
    """``row_key, n`` of one row for each component: that of the smallest id, null ids last,
    then of the smallest key. ``n`` counts the rows that have this key."""
    hashed = stored(fingerprints(docs, keyed=True), "fingerprints")
    rooted = grouped(hashed).select("fp", "root")
    rows = hashed.groupBy("fp", "row_key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", "n")
    return rows.join(rooted, "fp").groupBy("root").agg(F.min(order).alias("first")).select("first.row_key", "first.n")
