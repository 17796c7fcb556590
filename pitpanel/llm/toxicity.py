"""Toxicity by a subsequence string kernel and a support vector machine with Nyström landmarks.

Strings are windows of a sentence: one to WORDS words in a row. The kernel of two windows
sums over all character triples that both contain in order, with gaps, divided by the roots
of their lengths: a triple that spans s characters counts decay**s. It runs over the spaces
too, so an insult may be several words; inserted, doubled or replaced characters only lower
it, so "i.d.i0t" stays near "idiot". Single letters in a row are read as one word.

Labels are those of whole documents, so the machine learns from sentences of which only some
bear out their label: in each round the windows of a toxic document that the last machine
was surest of are its examples, and those of clean documents that it took for insults are
the others. Landmark windows of both kinds span the space that it is trained in.

With landmarks L and weights v the decision is v' K_LL^(-1/2) k(L, w). As the kernel is a
sum over triples, so is the decision: landmarks and weights fold into one number for each
triple, and a window's decision is a difference of running sums over the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of

#: Triples of the kernel span this many characters at most; each one more multiplies by DECAY.
SPAN, DECAY = 6, 0.6
#: Character classes: 1 for white space and ends, 2 to 27 for a to z, and the rest for all
#: others by code point, so that an alphabet's letters in a row stay distinct.
CLASSES = 64
#: Words of a window at most, and the length from which on it counts for the kernel.
WORDS, SHORT = 3, 4
LANDMARKS, ROUNDS, PENALTY = 512, 4, 0.3
#: Labelled documents of each kind that are learned from, the characters of the longest,
#: and the characters of all of them together.
DOCUMENTS, FIT_CHARS, FIT_ALL = 1_500, 200_000, 24_000_000
#: Windows that one toxic or clean document gives in a round, and clean ones that are kept.
TOXIC_WINDOWS, CLEAN_WINDOWS, HARD = 3, 2, 6_000
#: Decisions over which a word counts as a likely, a middling and a sure insult.
LIKELY, MIDDLING, SURE = 0.3, 0.5, 0.7
#: Characters of a text that are decided at a time.
CHUNK = 1 << 20

PAIRS = [(a, b) for a in range(1, SPAN) for b in range(a + 1, SPAN)]
#: Characters before a cut that are searched for a good one.
LOOK = 1 << 16
# White space as the classes have it; a gap stands between words of two letters or more.
spoken = re.compile(r"[^\t-\r\x1c-\x20\x85\xa0]+")
gap = re.compile(r"(?<=\w\w)[\t-\r\x1c-\x20\x85\xa0](?=\w\w)")
single_letters = re.compile(r"(?<!\S)(\w) (?=\w(?!\w))")


def classes() -> np.ndarray:
    """Class of each code point below 0x250: letters a to z apart, the others by a rule."""
    table = np.zeros(0x250, np.int32)
    for c in range(0x250):
        x = chr(c).lower()[0]
        table[c] = 1 if x.isspace() else 2 + ord(x) - 97 if "a" <= x <= "z" else 28 + c % 36
    return table


TABLE = classes()


def encode(text: str) -> np.ndarray:
    """Classes of a text's characters, white space before and behind."""
    text = single_letters.sub(r"\1", text.lower())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.where(points < 0x250, TABLE[np.minimum(points, 0x24F)], 28 + points % 36).astype(np.int32)
    return np.concatenate((np.ones(1, np.int32), row, np.ones(1, np.int32)))


def triples(c: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, float]]:
    """For each pair of gaps the numbers of the triples that start at the first ``n`` places
    of ``c``, and their decay."""
    c = np.concatenate((c[: n + SPAN], np.ones(SPAN, np.int32)))
    first, middle = c[:n] * (CLASSES * CLASSES), c * CLASSES
    for a, b in PAIRS:
        yield first + middle[a : n + a] + c[b : n + b], DECAY ** (b + 1)


def features(c: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct triples that start in a window, and their weights."""
    n = end - begin
    found = list(triples(c[begin : end + SPAN], n))
    numbers, at = np.unique(np.concatenate([i for i, _ in found]), return_inverse=True)
    weight = np.bincount(at, np.repeat([w for _, w in found], n), len(numbers))
    return numbers, weight / max(n, SHORT) ** 0.5


def windows(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Begins and ends of all windows, those of one word first, and how many these are. A
    window begins with the space before it."""
    space = c == 1
    begins, ends = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:]) + 1
    n = len(begins)
    some = range(1, min(WORDS, n) + 1)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *(begins[: n - k + 1] for k in some)]), np.concatenate([none, *(ends[k - 1 :] for k in some)]), n


@dataclass
class Landmarks:
    """Feature rows of the landmark windows over the triples that any of them has: ``place``
    gives each triple's column, -1 for the others."""

    found: np.ndarray
    place: np.ndarray
    rows: np.ndarray

    @staticmethod
    def of(strings: list[tuple[np.ndarray, int, int]]) -> Landmarks:
        each = [features(*x) for x in strings]
        found = np.unique(np.concatenate([i for i, _ in each]))
        place = np.full(CLASSES**3, -1, np.int32)
        place[found] = np.arange(len(found))
        rows = np.zeros((len(each), len(found)))
        for row, (i, w) in zip(rows, each):
            row[place[i]] = w
        return Landmarks(found, place, rows)

    def kernel(self, strings: list[tuple[np.ndarray, int, int]]) -> np.ndarray:
        """Kernel of each window with each landmark."""
        out = np.zeros((len(strings), len(self.rows)))
        for k, x in enumerate(strings):
            i, w = features(*x)
            at = self.place[i]
            out[k] = self.rows[:, at[at >= 0]] @ w[at >= 0]
        return out

    def table(self, weights: np.ndarray) -> np.ndarray:
        """A weighted sum of landmarks as one number for each triple."""
        out = np.zeros(CLASSES**3, np.float32)
        out[self.found] = self.rows.T @ weights
        return out


@dataclass
class Model:
    """``table``: a number for each triple; ``bias``; ``logistic``: weights of ``marks``."""

    table: np.ndarray
    bias: float
    logistic: np.ndarray

    def decisions(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Begins, ends and decisions of all windows, and how many are of one word."""
        own = np.zeros(len(c), np.float32)
        for i, w in triples(c, len(c)):
            own += self.table[i] * np.float32(w)
        total = np.concatenate(([0.0], np.cumsum(own, dtype=np.float64)))
        begin, end, n = windows(c)
        return begin, end, (total[end] - total[begin]) / np.sqrt(np.maximum(end - begin, SHORT)) + self.bias, n

    def marks(self, text: str) -> list[float]:
        """What the logistic function sees of a text: likely and sure insults, the share of
        middling ones, the largest decision and the second largest on a word."""
        words = likely = middling = sure = 0
        top, best = -1.0, [-1.0, -1.0]
        for part, lead, tail in parts(text):
            _, _, d, n = self.decisions(encode(part))
            # each window counts once: where its last word is neither led in nor looked ahead at
            last = np.concatenate([np.arange(k, n) for k in range(min(WORDS, n))]) if n else np.zeros(0, np.int64)
            d, n = d[(last >= lead) & (last < n - tail)], max(0, n - lead - tail)
            if n:
                one = d[:n]
                words, likely, middling, sure = words + n, likely + int((one > LIKELY).sum()), middling + int((one > MIDDLING).sum()), sure + int((one > SURE).sum())
                top, best = max(top, float(d.max())), sorted([*best, *np.partition(one, n - min(2, n))[-2:].tolist()])[-2:]
        share = 1000.0 * middling / max(1, words)
        return [1.0, *np.log1p([likely, sure, share]).tolist(), min(top, 1.5), min(best[0], 1.5)]


def parts(text: str) -> Iterator[tuple[str, int, int]]:
    """A text in stretches of about CHUNK characters, and how many words at the beginning and
    at the end of each are another's: the last WORDS - 1 words of the one before stand
    before a stretch, so that windows over the cut are seen, and some characters behind it, so
    that triples are. Cuts lie at white space between words of several letters, if there is
    any; a word that is longer than a stretch is cut without either."""
    begin = lead_at = 0
    while begin < len(text):
        end, spaced = begin + CHUNK, True
        if end < len(text):
            cuts = [m.start() for m in gap.finditer(text, max(begin, end - LOOK), end)]
            end, spaced = (cuts[-1], True) if cuts else (end, False)
        ahead = text[end : end + 2 * SPAN] if spaced else ""
        yield text[lead_at:end] + ahead, words_in(text[lead_at:begin]), words_in(ahead)
        last = [m.start() for m in spoken.finditer(text, max(lead_at, end - LOOK), end)][1 - WORDS :] if spaced else []
        begin, lead_at = end, last[0] if last else end


def words_in(text: str) -> int:
    return windows(encode(text))[2] if text else 0


def machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = PENALTY, rounds: int = 30) -> np.ndarray:
    """Linear support vector machine with squared hinge loss by Newton steps; the last
    column of ``x`` is the bias. ``y`` is 1 or -1."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        active = y * (x @ w) < 1
        xa = x[active] * weight[active, None]
        new = np.linalg.solve(xa.T @ x[active] + np.diag(ridge), xa.T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def first_table(docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log odds of the labels for each triple by the documents that have it, less for rare ones."""
    have = np.zeros((2, CLASSES**3))
    for c, label in zip(docs, y):
        seen = np.zeros(CLASSES**3, bool)
        for i, _ in triples(c, len(c)):
            seen[i] = True
        have[label] += seen
    clean, toxic = np.bincount(y, minlength=2)
    more = clean / toxic
    odds = np.log((have[1] + 0.5) / (toxic + 1)) - np.log((have[0] + 0.5 * more) / (clean + more))
    return (odds * np.minimum(1.0, have[1] / (0.02 * toxic + 2))).astype(np.float32)


def surest(c: np.ndarray, model: Model, most: int) -> list[tuple[float, int, int]]:
    """Decision, begin and end of the windows with the largest decisions that don't overlap."""
    begin, end, d, _ = model.decisions(c)
    out: list[tuple[float, int, int]] = []
    for k in np.argsort(-d, kind="stable")[:60]:
        if all(end[k] <= a or begin[k] >= b for _, a, b in out):
            out.append((float(d[k]), int(begin[k]), int(end[k])))
            if len(out) == most:
                break
    return out


def train_windows(docs: list[np.ndarray], y: np.ndarray, seed: int = 0) -> Model:
    """Table and bias from encoded documents and their labels, in ROUNDS rounds. Every toxic
    document gives its surest window, and further ones that the last machine took for
    insults; clean ones give their surest so far and some at random."""
    rng = np.random.default_rng(seed)
    model = Model(first_table(docs, y), 0.0, np.zeros(6))
    clean = [c for c, label in zip(docs, y) if label == 0]
    hard: dict[tuple[int, int, int], None] = {}
    for r in range(ROUNDS):
        bad = [(d, c, a, b) for c, label in zip(docs, y) if label == 1 for k, (d, a, b) in enumerate(surest(c, model, TOXIC_WINDOWS)) if k == 0 or (r and d > 0)]
        for i, c in enumerate(clean):
            hard |= {(i, a, b): None for _, a, b in surest(c, model, CLEAN_WINDOWS)}
        good = [(clean[i], a, b) for i, a, b in list(hard)[-HARD:]]
        for i in rng.permutation(len(clean)):
            begin, end, _ = windows(clean[i])
            good += [(clean[i], int(begin[k]), int(end[k])) for k in rng.integers(0, len(begin), min(3, len(begin)))]
        if not bad or not good:
            return Model(np.zeros(CLASSES**3, np.float32), -1.0, np.zeros(6))
        strings = [x[1:] for x in bad] + good
        label = np.array([1.0] * len(bad) + [-1.0] * len(good))
        chosen = [x[1:] for x in sorted(bad, key=lambda x: -x[0])[: LANDMARKS // 2]]
        chosen += [good[k] for k in rng.permutation(len(good))[: LANDMARKS - len(chosen)]]
        base = Landmarks.of(chosen)
        values, vectors = np.linalg.eigh(base.rows @ base.rows.T)
        stay = values > 1e-5 * values.max()
        root = vectors[:, stay] / np.sqrt(values[stay])
        x = np.ones((len(strings), root.shape[1] + 1))
        x[:, :-1] = base.kernel(strings) @ root
        w = machine(x, label, np.where(label > 0, 0.5 / len(bad), 0.5 / len(good)) * len(label))
        model = Model(base.table(root @ w[:-1]), float(w[-1]), np.zeros(6))
    return model


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-2, rounds: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), x.T @ (weight * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, documents: int = DOCUMENTS, longest: int = FIT_CHARS, together: int = FIT_ALL) -> Model:
    """A model from labelled documents whose crc32(doc_id as text) mod 5 is not 0.

    Of each kind at most ``documents`` labelled ids, by hash, are learned from, one text for
    each, none of over ``longest`` characters and no more of them, by hash, than have
    ``together`` characters, so that what reaches the driver is bounded.
    With labels of one kind only every text scores alike.
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pick = lambda y: known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(pick(0).unionByName(pick(1))), "doc_id").where(F.length("text") <= longest)
    rows = stored(rows.groupBy("doc_id", "y").agg(F.min("text").alias("text")), "toxicity-rows")
    kept, total = [], 0
    for r in rows.select("doc_id", F.length("text").alias("n"), F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").collect():  # 2 * documents at most
        total += r["n"]
        if total <= together:
            kept.append(r["doc_id"])
    rows = rows.where(F.col("doc_id").isin(kept)).orderBy("doc_id").collect()
    y = np.array([r["y"] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        flat = 3.0 if y.any() else -3.0
        return Model(np.zeros(CLASSES**3, np.float32), -1.0, np.array([flat, 0.0, 0.0, 0.0, 0.0, 0.0]))
    model = train_windows([encode(r["text"]) for r in rows], y)
    x = np.array([model.marks(r["text"]) for r in rows])
    share = np.array([sizes[k] / (y == k).sum() for k in (0, 1)])  # both kinds weigh as they occur
    model.logistic = logistic(x, y.astype(float), share[y] * len(y) / share[y].sum())
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row. Null, empty and wordless texts
    get the score of a text without insults; repeated rows get equal scores; a null id is
    not held out. Texts of any length are read in stretches that overlap, so windows over a cut
    count as all others; only words of over CHUNK characters are seen in pieces. Other columns are
    ignored; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        model = shared.value
        x = np.array([model.marks(text) for text in texts]).reshape(-1, 6)
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ model.logistic, -30, 30))))

    out = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), rate(text_of()).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
