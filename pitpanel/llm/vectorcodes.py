"""Compression of vectors to short codes: a product quantizer whose nearest entries are found
by equal-average search.

The squared distance of two vectors of d components is at least the squared difference of
their component sums over d. So the entries of a codebook lie sorted by sum; a part starts
at its own sum and walks outward, STRIDE entries of the nearer side at a time, until the squared gap
over d strictly exceeds the best distance so far. Equal bounds are still looked at, so the
lowest index wins every tie, and the result is that of a full scan. All arithmetic is exact.

Only codebooks (PARTS x ENTRIES entries) and the first ENTRIES vectors reach the driver. A
round reads the vectors once and shuffles a sum for each entry that a task has used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import looked_up, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components below these, over the dimension of a part, keep every term exact as a double or
#: within 63 bits.
SAFE = 1 << 25, 1 << 30
#: Scaled components from here on could overflow a sum of 38 digits.
TOO_LARGE = 2.0**76
#: Entries that a step outward looks at, and parts that walk together.
STRIDE, TOGETHER = 8, 1 << 11


def integers(values: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` of finite numbers: int64, or Python integers if one needs more."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    most = np.abs(scaled).max(initial=0)
    if most >= TOO_LARGE:
        raise OverflowError(f"a component of {most / SCALE:g} is too large for exact sums")
    if most < 2.0**62:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled.ravel()], object).reshape(scaled.shape)


def exact(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the fastest type that holds every term of a squared distance exactly."""
    kind, d = object, max(1, book.shape[1])
    if parts.dtype != object and book.dtype != object:
        most = max(int(np.abs(parts).max(initial=0)), int(np.abs(book).max(initial=0)))
        kind = np.float64 if most < SAFE[0] // d else np.int64 if most < SAFE[1] // d else object
    return parts.astype(kind), book.astype(kind)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part the lowest index of a nearest entry and the squared distance to it."""
    if len(parts) > TOGETHER:
        found = [nearest(parts[i : i + TOGETHER], book) for i in range(0, len(parts), TOGETHER)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    parts, book = exact(parts, book)
    d, k = book.shape[1], len(book)
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, book = sums[order], book[order]
    code, best = np.full(len(parts), k, np.int64), np.zeros(len(parts), parts.dtype)
    at, own = np.arange(len(parts)), parts.sum(axis=1)
    high = np.searchsorted(sums, own)
    low = high - 1
    while len(at):
        below, above = low >= 0, high < k
        down, up = own - sums[np.maximum(low, 0)], sums[np.minimum(high, k - 1)] - own
        rise = above & (~below | (up <= down))
        gap = np.where(rise, up, down)
        go = (below | above) & ((code[at] == k) | (gap * gap <= best[at] * d))
        if not go.all():
            at, own, low, high, rise = at[go], own[go], low[go], high[go], rise[go]
        # STRIDE entries of the nearer side; those past its end are the last one again
        place = np.clip(np.where(rise, high, low)[:, None] + np.where(rise, 1, -1)[:, None] * np.arange(STRIDE), 0, k - 1)
        apart = parts[at][:, None] - book[place]
        far = np.einsum("nsd,nsd->ns", apart, apart) if apart.dtype != object else (apart * apart).sum(axis=2)
        least = far.min(axis=1)
        entry = np.where(far == least[:, None], order[place], k).min(axis=1) if len(at) else np.zeros(0, np.int64)
        better = (code[at] == k) | (least < best[at]) | ((least == best[at]) & (entry < code[at]))
        code[at[better]], best[at[better]] = entry[better], least[better]
        low, high = np.where(rise, low, low - STRIDE), np.where(rise, high + STRIDE, high)
    return code, best if best.dtype == object else best.astype(np.int64)


def kept(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there with finite components only. ``vec_id, embedding, label``."""
    x = F.col(column)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vectors.select("vec_id", x.alias("embedding"), "label").where(x.isNotNull() & F.coalesce(fine, F.lit(False)))


def cut(rows: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have vectors of ``width`` components, and those as integers (rows, PARTS, width / PARTS)."""
    fits = np.diff(rows.offsets.to_numpy()) == width
    chosen = rows.filter(pa.array(fits)) if not fits.all() else rows
    return fits, integers(chosen.flatten().to_numpy(zero_copy_only=False)).reshape(-1, PARTS, width // PARTS if width else 0)


def first_books(vectors: DataFrame) -> np.ndarray:
    """Integers (PARTS, entries, width / PARTS) of the vectors with the smallest ids, ascending;
    equal ids follow the vector, a null id comes last."""
    ordered = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding")
    width = next((r[0] for r in ordered.select(F.size("embedding")).limit(1).collect()), 0)
    if width % PARTS:
        raise ValueError(f"vectors of {width} components can't be cut into {PARTS} equal parts")
    rows = [r[0] for r in ordered.where(F.size("embedding") == width).select("embedding").limit(ENTRIES).collect()]
    return integers(np.array(rows, np.float64)).reshape(len(rows), PARTS, width // PARTS).transpose(1, 0, 2)


def moved(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks whose entries are the floored means of the parts that are nearest to them."""
    n_parts, k, d = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((PARTS * k, d), np.int64), np.zeros(PARTS * k, np.int64)
        for batch in batches:
            _, parts = cut(batch.column(0), PARTS * d)
            for p in range(PARTS):
                code, _ = nearest(parts[:, p], books[p])
                if parts.dtype == object or total.dtype == object or max(np.abs(total).max(), np.abs(parts).max(initial=0) * len(parts)) >= 1 << 61:
                    total, parts = total.astype(object), parts.astype(object)
                np.add.at(total, p * k + code, parts[:, p])
                count += np.bincount(p * k + code, minlength=PARTS * k)
        used = np.flatnonzero(count)
        columns = [pa.array([Decimal(int(x)) for x in total[used, i]], pa.decimal128(38, 0)) for i in range(d)]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used]), *columns], ["entry", "n", *(f"s{i}" for i in range(d))])

    schema = ", ".join(["entry int", "n long", *(f"s{i} decimal(38,0)" for i in range(d))])
    found = vectors.select("embedding").mapInArrow(sums, schema).groupBy("entry").agg(F.sum("n").alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(d)))
    new = books.reshape(n_parts * k, d).astype(object)
    for r in found.collect():  # a row for each used entry, PARTS x ENTRIES at most
        new[r[0]] = [int(s) // r[1] for s in r[2:]]
    small = all(abs(x) < 1 << 62 for x in new.ravel())
    return (new.astype(np.int64) if small else new).reshape(books.shape)


def trained(vectors: DataFrame) -> np.ndarray:
    """Codebooks after ROUNDS rounds over all vectors."""
    books = first_books(vectors)
    for _ in range(ROUNDS if books.size else 0):
        books = moved(vectors, books)
    return books


def coded(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` for each row."""
    width = books.shape[0] * books.shape[2]
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, parts = cut(batch.column(1), width)
            found = [nearest(parts[:, p], books[p]) for p in range(PARTS)] if books.size else []
            digits = np.stack([f[0] for f in found], axis=1).astype(np.uint8) if found else np.zeros((0, PARTS), np.uint8)
            codes, errors = iter([bytes(c).hex() for c in digits]), iter([sum(int(e) for e in es) for es in zip(*(f[1] for f in found), strict=True)])
            pairs = [(next(codes), next(errors)) if ok else (None, None) for ok in (fits if books.size else np.zeros(len(fits), bool))]
            error = [e if e is not None and e < 1 << 63 else None for _, e in pairs]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([c for c, _ in pairs], pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "embedding", "label").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for each row with a finite vector.

    Rows whose vector is null or holds a null, NaN or infinity are dropped; an empty vector is
    one of width 0. The width is that of the smallest kept id; a row of another width keeps its
    place with a null code and error, which count as nothing in ``label_error``. Fewer than
    ENTRIES vectors make codebooks of as many entries. Repeated rows get equal codes, null
    labels count together, a null id is a row like another. An error or a label's sum of
    errors past 63 bits is null; a component of 2^66 or more raises, as does a width that
    isn't a multiple of PARTS. Other columns are ignored; an empty table gives no rows.
    """
    good = kept(vectors)
    books = trained(good)
    rows = stored(coded(good, books), "vector-codes")
    sums = stored(rows.groupBy("label").agg(F.try_sum(F.coalesce("error", F.lit(0))).alias("label_error")), "label-errors")
    out = looked_up(rows, sums, ["label"])
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
