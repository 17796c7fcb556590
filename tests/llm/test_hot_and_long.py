"""Hot keys, repeated rows and very long texts of the corpus operators."""

import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitpanel.llm import decontam, mixing, pii, quality, toxicity


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")


# 3: mixing near its target among repeated rows


def plain_mix(rows):
    """Words taken by source: keys in order, copies one by one, to the sum nearest the budget."""
    import hashlib

    sizes, by = Counter(), {}
    for i, text, source, _ in rows:
        n = len((text or "").split())
        sizes[source] += n
        by.setdefault(source, []).append((hashlib.md5(f"{'' if i is None else i}:{text or ''}".encode()).hexdigest(), n))
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, rest, free = {}, sum(sizes.values()), set(names)
    while free:
        total = sum(weight[s] for s in free)
        full = {s for s in free if rest * weight[s] / total >= 3 * sizes[s]}
        for s in full or free:
            target[s] = 3.0 * sizes[s] if full else rest * weight[s] / total
        rest -= sum(3 * sizes[s] for s in full)
        free -= full or free
    out = {}
    for s in names:
        times = int(target[s] // sizes[s]) if sizes[s] else 0
        budget, before, more = target[s] - times * sizes[s], 0, 0
        for _, n in sorted(by[s]):
            if before + n <= budget or before + n - budget < budget - before:
                more += n
            before += n
        out[s] = times * sizes[s] + more
    return out, target


def test_mixing_takes_some_of_many_copies(spark):
    rows = [(1, "ten words are in this text of the copies here", "a", "en")] * 30 + [(2, "w " * 100, "b", "en")] + [(1000 + i, "w " * (i % 5), "c", "en") for i in range(300)] + [(None, None, None, None)] * 3
    df = docs_of(spark, rows).repartition(5)
    want, target = plain_mix(rows)
    got, source = Counter(), {1: "a", 2: "b", None: None}
    for r in mixing.mix(df).collect():
        got[source.get(r.doc_id, "c")] += r.taken
    ids = Counter(r.doc_id for r in mixing.mix(df).collect())
    assert ids == Counter(r[0] for r in rows)
    assert got["a"] == want["a"] and abs(got["a"] - target["a"]) <= 5
    taken = mixing.take(df).groupBy("source").agg(F.sum("taken").alias("n")).collect()
    assert {r.source: r.n for r in taken} == {s: n for s, n in want.items() if n}


def test_mixing_reruns_agree_whatever_the_order(spark):
    rng = random.Random(5)
    rows = [(i % 9, f"text {i % 9} " + "w " * (i % 4), rng.choice("ab"), rng.choice(["en", "de", None])) for i in range(200)]
    bags = []
    for _ in range(3):
        rng.shuffle(rows)
        bags.append((Counter(map(tuple, mixing.mix(docs_of(spark, rows).repartition(3)).collect())), Counter(map(tuple, mixing.take(docs_of(spark, rows)).collect()))))
    assert bags[0] == bags[1] == bags[2]


# 4: decontamination


def plain_overlaps(text, block):
    """Every alignment at which a seed agrees, each on its own."""
    codes = np.array([block.vocabulary.get(w, 0) for w in decontam.words_of(text.lower())], np.uint64)
    found = set()
    for mask, sorted_h, owner, place, _ in block.seeds:
        for p, h in enumerate(decontam.hashes(codes, mask)):
            a, b = np.searchsorted(sorted_h, h, "left"), np.searchsorted(sorted_h, h, "right")
            found.update(zip(owner[a:b].tolist(), (p - place[a:b]).tolist()))
    best = {}
    for k, shift in found:
        item, own = block.items[k]
        begin, end = max(0, shift), min(len(codes), shift + len(own))
        a, b, n = decontam.best_stretch(codes[begin:end] == own[begin - shift : end - shift], min(decontam.LEAST, len(own)))
        if b > a:
            best[item] = max(best.get(item, (0, 0, 0)), (n, -begin - a, begin + b))
    return sorted((i, -a, b, n) for i, (n, a, b) in best.items())


@pytest.mark.parametrize("cells", [50, 1000, 1 << 20])
def test_overlaps_of_many_alignments_equal_each_alone(monkeypatch, cells):
    monkeypatch.setattr(decontam, "CELLS", cells)
    rng = random.Random(cells)
    for _ in range(25):
        words = [f"v{i}" for i in range(rng.choice([2, 8, 40]))]
        block = decontam.build([(i, " ".join(rng.choices(words, k=rng.randrange(1, 40)))) for i in range(30)])
        text = " ".join(rng.choices(words, k=rng.randrange(120)))
        got = decontam.overlaps(text, block)
        assert [(i, n) for i, _, _, n in got] == [(i, n) for i, _, _, n in plain_overlaps(text, block)]
        some = decontam.overlaps(text, block, first=True)
        assert bool(some) == bool(got) and {i for i, *_ in some} <= {i for i, *_ in got}


def test_hot_seeds():
    rng = random.Random(1)
    stock = " ".join(f"s{i}" for i in range(12))
    side = lambda: " ".join(f"w{rng.randrange(3000)}" for _ in range(20))
    block = decontam.build([(i, f"{side()} {stock} {side()}") for i in range(5000)])
    began = time.time()
    assert len(decontam.overlaps(" ".join([stock] * 36), block)) == 5000
    assert decontam.overlaps("spam " * 80_000, decontam.build([(1, "spam " * 30)])) == [(1, 0, 30, 30)]
    assert time.time() - began < 15


def test_short_items_remove_nothing_if_told_so(spark):
    df = docs_of(spark, [(1, "the cat", "a", "en"), (2, "all of the words of a longer test item here", "a", "en"), (3, None, "b", None)])
    items = spark.createDataFrame([(1, "the"), (2, "words of a longer test item")], "item_id long, text string")
    assert {r.doc_id for r in decontam.without_contaminated(df, items).collect()} == {3}
    assert {r.doc_id for r in decontam.without_contaminated(df, items, least=5).collect()} == {1, 3}
    assert [(r.item_id, r.n_words) for r in decontam.short_items(items, 5).collect()] == [(1, 1)]


# 5: toxicity


def test_long_texts_score_as_if_read_at_once(monkeypatch):
    rng, words = np.random.default_rng(0), "you are a total idiot and an old fool indeed who reads b o o k s".split()
    model = toxicity.Model(rng.normal(0, 0.2, toxicity.CLASSES**3).astype(np.float32), -0.1, np.zeros(6))
    pick = random.Random(3)
    for _ in range(20):
        text = "".join(pick.choice(words) + pick.choice([" ", " ", " ", "\n", ", "]) for _ in range(300))
        monkeypatch.setattr(toxicity, "CHUNK", 1 << 20)
        whole = model.marks(text)
        monkeypatch.setattr(toxicity, "CHUNK", pick.choice([200, 333, 500]))
        assert len(list(toxicity.parts(text))) > 2 and np.allclose(model.marks(text), whole, atol=1e-5)


def test_training_rows_are_bounded_by_characters(spark, monkeypatch):
    rows = [(i, ("you idiot " if i % 2 else "good day ") * 50, "a", "en") for i in range(60)]
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train_windows", lambda docs, y: seen.append(len(docs)) or toxicity.Model(np.zeros(toxicity.CLASSES**3, np.float32), 0.0, np.zeros(6)))
    toxicity.train(docs_of(spark, rows), labels, together=5_000)
    assert seen and seen[0] * 450 <= 5_000


# 7: quality


def test_levels_keep_the_order_of_all_doubles():
    x = np.array([1e9, -1e9, 0.0, -0.0, 3.5, -2.25, 1e300, -1e300, float("inf"), 5e-324, 4194304.0, 4194305.0])
    level = quality.ordered(x)
    assert (np.argsort(level, kind="stable") == np.argsort(x, kind="stable")).all() and level[2] == level[3]


def test_kth_largest_of_any_longs(spark):
    rng = random.Random(2)
    values = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(300)] + [5] * 40 + [-(1 << 63), (1 << 63) - 1]
    df = spark.createDataFrame([(v,) for v in values], "level long")
    for k in (1, 2, 150, 170, len(values), len(values) + 1):
        assert quality.kth_largest(df, k) == (sorted(values, reverse=True)[k - 1] if k <= len(values) else -(1 << 63))


# 10: personal data


def test_candidates_are_linear_in_entities():
    text = " ".join(f"user{i}@example.com id{i:06d}x" for i in range(100_000))
    began = time.time()
    found = pii.candidates(text, pii.entities(text))
    assert len(found) == 200_000 and time.time() - began < 15


def test_candidates_beside_overlapping_entities():
    rng = random.Random(6)
    for _ in range(200):
        text = " ".join(rng.choice(["ab", "x1234", "me@a.bc", "12345", "q"]) for _ in range(30))
        known = sorted((a := rng.randrange(len(text)), 0, a + rng.randrange(1, 30)) for _ in range(rng.randrange(6)))
        got = {(a, b) for a, b, _, seed, _, _ in pii.candidates(text, known) if not seed}
        every = {(a, b) for a, b, _, seed, _, _ in pii.candidates(text, []) if not seed}
        assert got == {(a, b) for a, b in every if not any(x < b and a < y for x, _, y in known)}


# the pipeline's near-duplicates


def test_near_stage_keeps_the_same_row_in_any_order(spark):
    import corpus_pipeline

    rows = [(1, "the same text of some words here", s, "en") for s in "cab"] + [(2, "another text of other words there", "z", "en")]
    kept = []
    for order in ([0, 1, 2, 3], [2, 1, 0, 3], [3, 1, 2, 0]):
        kept.append(sorted(map(tuple, corpus_pipeline.near_stage(spark, docs_of(spark, [rows[i] for i in order]).repartition(3), "").collect())))
    assert kept[0] == kept[1] == kept[2] == [(1, "the same text of some words here", "a", "en"), rows[3]]
