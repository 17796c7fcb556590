"""Main text of web pages by a recurrent block labeller.

Each leaf block of a page is a vector: the mean of the embeddings of its hashed words, the
sum of those of its hashed tag path, its length, its share of links and how it ends. A
bidirectional LSTM reads all blocks of the page, so each is judged in the context of the
whole document, and a logistic unit says whether it is main text. Everything is numpy.

Trained on pages of the table: on blocks whose own elements (article, nav, footer and the
like) say what they are, and on the same texts laid out anew in forms that other sites use,
where what is main text is known. The model itself is never told which elements those are.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pages import Block, blocks, known, layout

WORDS, PATHS, WIDTH, HIDDEN = 4096, 2048, 16, 24
#: Training takes at most so many pages, those of least hash among pages up to so many characters.
SAMPLE, SAMPLE_CHARS = 256, 40_000
#: New layouts for each page of the sample, passes over all of them, pages a step.
LAYOUTS, EPOCHS, STEP = 3, 10, 16
#: Blocks of one page that a training step reads; longer pages are trained on in such parts.
TRAIN_BLOCKS = 120
#: Padded blocks that are judged together, and ids that are pooled together.
TOGETHER, SPAN = 1 << 14, 1 << 17
ENDS = tuple(".!?…:;\"”»)")


class Hashed(dict):
    """Bucket of a string, computed once."""

    def __init__(self, buckets: int, salt: bytes = b""):
        super().__init__()
        self.buckets, self.salt = buckets, crc32(salt)

    def __missing__(self, key: str) -> int:
        if len(self) > 1 << 18:
            self.clear()
        self[key] = h = crc32(key.encode("utf-8", "surrogatepass"), self.salt) % self.buckets
        return h


class Reader:
    """Blocks as arrays: ids of words and paths with their numbers a block, and plain features."""

    def __init__(self):
        self.words, self.outer, self.inner = Hashed(WORDS), Hashed(PATHS, b"outer"), Hashed(PATHS, b"inner")

    def __call__(self, found: list[Block]) -> tuple[np.ndarray, ...]:
        words, n_words, paths, n_paths, plain = [], [], [], [], []
        for b in found:
            own = b.text.lower().split()
            ids = {self.outer[w] for e in b.path[:-1] for w in e.words} | {self.inner[w] for w in b.path[-1].words}
            words.append(np.fromiter(map(self.words.__getitem__, own), np.int32, len(own)))
            n_words.append(len(own))
            paths.extend(sorted(ids))
            n_paths.append(len(ids))
            plain.append((np.log1p(len(own)) / 3 - 1, b.links * 2 - 0.5, float(b.text.endswith(ENDS)) - 0.5))
        flat = np.concatenate(words) if words else np.zeros(0, np.int32)
        return flat, np.array(n_words, np.int64), np.array(paths, np.int32), np.array(n_paths, np.int64), np.array(plain, np.float32).reshape(-1, 3)


def pooled(table: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the rows that each block names, a span of ids at a time."""
    out = np.zeros((len(sizes), table.shape[1]), np.float32)
    block = np.repeat(np.arange(len(sizes)), sizes)
    for i in range(0, len(ids), SPAN):
        part = block[i : i + SPAN]
        first = np.flatnonzero(np.diff(part, prepend=-1))
        out[part[first]] += np.add.reduceat(table[ids[i : i + SPAN]], first, axis=0)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def turned(lengths: np.ndarray, steps: int) -> np.ndarray:
    """Index (pages, steps) that reverses each sequence and leaves its padding behind."""
    at = np.arange(steps)
    return np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)


class Lstm:
    """One direction. ``run`` keeps what ``back`` needs for the gradient."""

    def __init__(self, rng: np.random.Generator, n_in: int, n: int):
        self.n = n
        self.wx = rng.normal(0, n_in**-0.5, (n_in, 4 * n)).astype(np.float32)
        self.wh = rng.normal(0, n**-0.5, (n, 4 * n)).astype(np.float32)
        self.b = np.zeros(4 * n, np.float32)
        self.b[n : 2 * n] = 1  # remember at first

    def run(self, x: np.ndarray, keep: bool = False) -> np.ndarray:
        pages, steps, _ = x.shape
        n, pre = self.n, x @ self.wx + self.b
        h = c = np.zeros((pages, n), np.float32)
        out, kept = np.empty((pages, steps, n), np.float32), []
        for t in range(steps):
            g = pre[:, t] + h @ self.wh
            ifo, z = sigmoid(g[:, : 3 * n]), np.tanh(g[:, 3 * n :])
            before, c = c, ifo[:, n : 2 * n] * c + ifo[:, :n] * z
            tc = np.tanh(c)
            if keep:
                kept.append((h, before, ifo, z, tc))
            h = ifo[:, 2 * n :] * tc
            out[:, t] = h
        if keep:
            self.x, self.kept = x, kept
        return out

    def back(self, dout: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        pages, steps, n = dout.shape
        dpre = np.empty((pages, steps, 4 * n), np.float32)
        dwh, dh, dc = np.zeros_like(self.wh), 0.0, 0.0
        for t in range(steps - 1, -1, -1):
            h, before, ifo, z, tc = self.kept[t]
            i, f, o = ifo[:, :n], ifo[:, n : 2 * n], ifo[:, 2 * n :]
            dh = dh + dout[:, t]
            dc = dc + dh * o * (1 - tc * tc)
            g = np.concatenate([dc * z * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - z * z)], axis=1)
            dpre[:, t] = g
            dwh += h.T @ g
            dh, dc = g @ self.wh.T, dc * f
        flat = dpre.reshape(-1, 4 * n)
        return dpre @ self.wx.T, [self.x.reshape(len(flat), -1).T @ flat, dwh, flat.sum(axis=0)]


class Labeller:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.words = rng.normal(0, 0.1, (WORDS, WIDTH)).astype(np.float32)
        self.paths = rng.normal(0, 0.1, (PATHS, WIDTH)).astype(np.float32)
        self.ahead, self.behind = (Lstm(rng, 2 * WIDTH + 3, HIDDEN) for _ in range(2))
        self.out = rng.normal(0, 0.1, 2 * HIDDEN + 1).astype(np.float32)

    def vectors(self, page: tuple[np.ndarray, ...]) -> np.ndarray:
        words, n_words, paths, n_paths, plain = page
        return np.concatenate([pooled(self.words, words, n_words) / np.maximum(1, n_words)[:, None], pooled(self.paths, paths, n_paths), plain], axis=1).astype(np.float32)

    def logits(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False) -> np.ndarray:
        turn = turned(lengths, x.shape[1])[:, :, None]
        ahead = self.ahead.run(x, keep)
        behind = np.take_along_axis(self.behind.run(np.take_along_axis(x, turn, 1), keep), turn, 1)
        both = np.concatenate([ahead, behind], axis=2)
        if keep:
            self.both, self.turn = both, turn
        return both @ self.out[:-1] + self.out[-1]

    def judge(self, pages: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
        """For each page which of its blocks are main text. Pages of like length go together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        left = sorted((i for i in range(len(pages)) if len(pages[i][1])), key=lambda i: len(pages[i][1]))
        while left:
            longest = len(pages[left[-1]][1])
            now, left = left[-max(1, TOGETHER // longest) :], left[: -max(1, TOGETHER // longest)]
            lengths = np.array([len(pages[i][1]) for i in now])
            x = np.zeros((len(now), longest, 2 * WIDTH + 3), np.float32)
            for row, i in zip(x, now, strict=True):
                row[: len(pages[i][1])] = self.vectors(pages[i])
            for i, n, logit in zip(now, lengths, self.logits(x, lengths), strict=True):
                out[i] = logit[:n] > 0
        return out

    def gradients(self, pages: list[tuple[np.ndarray, ...]], labels: list[np.ndarray]) -> list[np.ndarray]:
        """Of the mean log loss over labelled blocks, in the order of ``parameters``."""
        lengths = np.array([len(y) for y in labels])
        x, y = np.zeros((len(pages), lengths.max(), 2 * WIDTH + 3), np.float32), np.full((len(pages), lengths.max()), np.nan, np.float32)
        for i, page in enumerate(pages):
            x[i, : lengths[i]], y[i, : lengths[i]] = self.vectors(page), labels[i]
        logits = self.logits(x, lengths, keep=True)
        there = ~np.isnan(y)
        d = np.where(there, sigmoid(logits) - np.nan_to_num(y), 0).astype(np.float32) / max(1, there.sum())
        dout = np.append(np.einsum("ptn,pt->n", self.both, d), d.sum()).astype(np.float32)
        dboth = d[:, :, None] * self.out[:-1]
        dx, ahead = self.ahead.back(dboth[:, :, :HIDDEN])
        dback, behind = self.behind.back(np.take_along_axis(dboth[:, :, HIDDEN:], self.turn, 1))
        dx = dx + np.take_along_axis(dback, self.turn, 1)
        dwords, dpaths = np.zeros_like(self.words), np.zeros_like(self.paths)
        for i, (words, n_words, paths, n_paths, _) in enumerate(pages):
            g = dx[i, : lengths[i]]
            np.add.at(dwords, words, np.repeat(g[:, :WIDTH] / np.maximum(1, n_words)[:, None], n_words, axis=0))
            np.add.at(dpaths, paths, np.repeat(g[:, WIDTH : 2 * WIDTH], n_paths, axis=0))
        return [dwords, dpaths, *ahead, *behind, dout]

    def parameters(self) -> list[np.ndarray]:
        one = lambda d: [d.wx, d.wh, d.b]
        return [self.words, self.paths, *one(self.ahead), *one(self.behind), self.out]

    def fit(self, pages: list[tuple[np.ndarray, ...]], labels: list[np.ndarray], rate: float = 0.01, seed: int = 5) -> None:
        rng, step = np.random.default_rng(seed), 0
        means, squares = ([np.zeros_like(p) for p in self.parameters()] for _ in range(2))
        for epoch in range(EPOCHS):
            order = rng.permutation(len(pages))
            order = [j for k in range(0, len(order), STEP * 8) for j in sorted(order[k : k + STEP * 8], key=lambda i: len(labels[i]))]
            for k in range(0, len(order), STEP):
                some = order[k : k + STEP]
                step += 1
                for p, g, m, v in zip(self.parameters(), self.gradients([pages[i] for i in some], [labels[i] for i in some]), means, squares, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (1 - epoch / EPOCHS) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        self.ahead.kept = self.behind.kept = self.ahead.x = self.behind.x = self.both = self.turn = None


def trained(htmls: list[str], seed: int = 3) -> Labeller:
    """A labeller that has learned from the pages as they are and from new layouts of their texts."""
    rng, reader = np.random.default_rng(seed), Reader()
    found = [blocks(h) for h in htmls]
    texts = [b.text for bs in found for b in bs] or ["text"]
    examples = [(bs, np.array([known(b) for b in bs])) for bs in found]

    def snip(a: int, b: int) -> str:
        words, n = texts[rng.integers(len(texts))].split(" "), rng.integers(a, b + 1)
        start = rng.integers(max(1, len(words) - n))
        return " ".join(words[start : start + n])

    for bs, (_, y) in zip(found, list(examples), strict=True):
        main = [b.text for b, k in zip(bs, y, strict=True) if k == 1] or [snip(1, 60) for _ in range(rng.integers(1, 9))]
        for _ in range(LAYOUTS):
            examples.append(layout(rng, main[: TRAIN_BLOCKS // 2], snip))
    pages, labels = [], []
    for bs, y in examples:
        for i in range(0, len(bs), TRAIN_BLOCKS):
            if not np.isnan(y[i : i + TRAIN_BLOCKS]).all():
                pages.append(reader(bs[i : i + TRAIN_BLOCKS]))
                labels.append(y[i : i + TRAIN_BLOCKS].astype(np.float32))
    model = Labeller()
    if pages:
        model.fit(pages, labels)
    return model


def sample(pages: DataFrame) -> list[str]:
    """Pages to train on: those of least hash, SAMPLE distinct ones at most of SAMPLE_CHARS at
    most. Only hashes are ordered, so no task sends pages that others outdo."""
    short = pages.where(F.length("html").between(1, SAMPLE_CHARS)).select("html", F.xxhash64("html").alias("h"))
    least = [r[0] for r in short.select("h").distinct().orderBy("h").limit(SAMPLE).collect()]
    if not least:
        return []
    chosen = short.where(F.col("h") <= least[-1]).groupBy("h").agg(F.min("html").alias("html"))
    return [r["html"] for r in sorted(chosen.collect(), key=lambda r: r["h"])]


def main_text(found: list[Block], chosen: np.ndarray) -> str:
    return "\n\n".join(b.text for b, ok in zip(found, chosen, strict=True) if ok)


def extracted(pages: DataFrame, model: Labeller) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, reader = shared.value, Reader()
        for batch in batches:
            texts: list[str] = []
            waiting, size = [], 0
            for html in batch.column(2):
                found = blocks(html.as_py())
                waiting.append((found, reader(found)))
                size += len(found)
                if size > TOGETHER:
                    texts += [main_text(f, c) for (f, _), c in zip(waiting, model.judge([p for _, p in waiting]), strict=True)]
                    waiting, size = [], 0
            texts += [main_text(f, c) for (f, _), c in zip(waiting, model.judge([p for _, p in waiting]), strict=True)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    given = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return given.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row: the main text, its blocks in page order
    with an empty line between them, empty if there is none.

    A null or empty html has no text. Repeated rows get equal texts; null ids and addresses
    stay. Pages of any length are read whole, their sequences never cut; only pages that the
    model learns from are bounded (SAMPLE, SAMPLE_CHARS). Other columns are ignored; an empty
    table gives no rows.
    """
    return extracted(pages, trained(sample(pages)))
