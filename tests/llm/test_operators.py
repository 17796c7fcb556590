"""The corpus operators against plain brute force on small fixtures, with nulls, empty and
long texts, ties, repeated rows, empty tables and further columns with clashing names."""

import hashlib
import random
import re
import time
import zlib
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pitpanel.llm import blobscan, decontam, linededup, media, mixing, pii, quality, simhash, tokens, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, fp string, score string, taken string, level string, row_key string, `gone` string"
SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    full = [(i, t, "en", s, None if t is None else len(t), 1, "x", "y", "z", "l", "k", "g") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = "lorem ipsum dolor " * 20_000
EDGE = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one", "b"), (5, "one", "b"), (5, "one", "b"), (None, "a null id", "c"), (7, LONG, "c"), (8, "Ünï çödé \U0001f600 tail", "c")]


@pytest.fixture(scope="module")
def edge(spark):
    return frame(spark, EDGE).cache()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


# 1: media


def payload(text):
    data = (text or "").encode()
    return data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))


def plain_feature(data):
    """The feature string from the payload alone and the writer's sizes: 1,024 samples a frame,
    8 frames a block, 8 blocks a cluster. A block of one frame has no lacing, and one whose
    last frame is shorter has sizes of its own."""
    lacing = dict.fromkeys(("none", "xiph", "fixed", "ebml"), 0)
    for i in range(0, len(data), 8192):
        block = data[i : i + 8192]
        lacing["none" if len(block) <= 1024 else "ebml" if len(block) % 1024 else "fixed"] += -(-len(block) // 1024)
    clusters, n = -(-len(data) // 65536), len(data)
    mean, square = sum(data) * 1000 // n, int(1000 * (sum(b * b for b in data) / n) ** 0.5)
    crossings = sum((a < 128) != (b < 128) for a, b in zip(data, data[1:])) * 1000 // n
    return ",".join(map(str, [n // 8, 1, clusters, clusters, -(-n // 1024), *lacing.values(), mean, square, crossings]))


def test_media_round_trip(docs, texts, edge):
    for df, given in ((docs, texts), (edge, [(i, t) for i, t, _ in EDGE])):
        rows = media.features(media.encode(df)).collect()
        assert len(rows) == len(given)
        got = sorted((r["doc_id"] or -1, r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in rows)
        due = [(i or -1, len((t or "").encode()), len(p := payload(t)), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])) for i, t in given]
        assert got == sorted(due)
        assert {r["payload_sha256"]: r["feature"] for r in rows} == {hashlib.sha256(p).hexdigest(): plain_feature(p) for p in (payload(t) for _, t in given)}
    same = [r for r in rows if r["doc_id"] in (4, 5)]
    assert len({(r["media_sha256"], r["feature"]) for r in same}) == 1
    assert media.features(media.encode(edge.limit(0))).count() == 0


def test_media_packets(edge):
    rows = media.packets(media.encode(edge)).where("doc_id = 7").orderBy("packet").collect()
    stored = media.encode(edge).where("doc_id = 7").first()["media"]
    assert b"".join(stored[r["offset"] : r["offset"] + r["size"]] for r in rows) == payload(LONG)
    assert {r["lacing"] for r in rows} == {"fixed", "ebml"} and {r["track"] for r in rows} == {1}
    times = [r["timestamp_ns"] for r in rows]
    assert times == sorted(times) and abs(times[-1] - (len(rows) - 1) * media.FRAME / media.RATE * 1e9) < 2e6
    assert [r["packet"] for r in rows] == list(range(len(rows)))
    frames = media.LACED * media.BLOCKS  # in a cluster, which has the cue of its first frame
    assert [r["cue_ns"] for r in rows] == [times[k // frames * frames] for k in range(len(rows))]
    null = edge.sparkSession.createDataFrame([(1, None), (2, None)], "doc_id int, media binary")
    assert media.packets(null).count() == 0 and media.index(null).count() == 2


@pytest.mark.parametrize("lacing", [0, 1, 2, 3])
def test_lacing(lacing):
    frames = [b"a" * 300, b"b" * 300, b"c" * 300] if lacing == 2 else [b"a" * 700, b"b" * 20, b"c" * 301] if lacing else [b"q" * 9]
    head = media.vint(5) + (7).to_bytes(2, "big", signed=True) + bytes([0x80 | lacing << 1])
    if lacing == 1:
        head += bytes([2]) + b"\xff\xff" + bytes([700 - 510]) + bytes([20])
    elif lacing == 2:
        head += bytes([2])
    elif lacing == 3:
        head += bytes([2]) + media.vint(700) + media.signed_vint(20 - 700)
    data = head + b"".join(frames)
    found = media.read_block(data, 0, len(data), 100, 1000, True, {})
    assert [data[p[4] : p[4] + p[5]] for p in found] == frames and {p[0] for p in found} == {5} and found[0][1] == 107_000


def test_unknown_sizes_and_groups():
    block = media.element(media.BLOCK, media.vint(1) + b"\x00\x02\x00" + b"data")
    cluster = media.CLUSTER.to_bytes(4, "big") + b"\xff" + media.uint(media.TIMESTAMP, 10) + media.element(media.BLOCK_GROUP, block)
    segment = media.SEGMENT.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + cluster + cluster + media.element(media.CUES, b"")
    parsed = media.parse(media.element(media.EBML, b"") + segment)
    assert len(parsed.clusters) == 2 and [p[1] for p in parsed.packets] == [12_000_000] * 2
    with pytest.raises(ValueError, match="cut off"):
        media.parse(media.write(b"x" * 64)[:-3])


def test_files_in_a_row_and_other_top_elements():
    frame = media.element(media.SIMPLE_BLOCK, media.vint(1) + b"\x00\x00\x80" + b"data")
    cluster = media.CLUSTER.to_bytes(4, "big") + b"\xff" + media.uint(media.TIMESTAMP, 3) + frame
    others = b"".join(media.element(x, b"") for x in (media.SEEK_HEAD, media.CHAPTERS, media.TAGS, media.ATTACHMENTS))
    segment = media.SEGMENT.to_bytes(4, "big") + b"\xff" + cluster + others + cluster
    one = media.element(media.EBML, b"") + segment
    parsed = media.parse(one + one)
    at = [k for k in range(2 * len(one)) if (one + one).startswith(media.CLUSTER.to_bytes(4, "big"), k)]
    assert parsed.clusters == at and len(at) == 4 and len(parsed.packets) == 4
    assert all((one + one)[p[4] : p[4] + p[5]] == b"data" and p[6] is None for p in parsed.packets)


def test_uneven_fixed_lacing_raises():
    data = media.vint(1) + b"\x00\x00\x84" + bytes([1]) + b"abc"
    with pytest.raises(ValueError, match="fit its block"):
        media.read_block(data, 0, len(data), 0, 1, True, {})


# 2: SimHash


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """Component of each (id, fingerprint) by all pairs."""
    ids, values = [i for i, _ in fps], np.array([f for _, f in fps], np.uint64)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: least[find(i)] for i, d in enumerate(ids)}


def test_simhash_equals_brute_force(docs, texts):
    rows = simhash.near_duplicates(docs).collect()
    fps = [(i, plain_fingerprint(t)) for i, t in texts]
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in rows} == dict(fps)
    assert {r["doc_id"]: r["component_id"] for r in rows} == plain_components(fps)


def test_simhash_links_lose_no_pair(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = {c for c in centres}
    for c in centres:
        x = c
        for _ in range(12):  # chains of 1 to 3 bits, and balls around the centre
            for b in rng.sample(range(64), rng.randint(1, 3)):
                x ^= 1 << b
            values.add(x)
            values.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    df = spark.createDataFrame(signed, "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    due = plain_components([(s[0], v) for s, v in zip(signed, values)])
    assert {s[0]: roots.get(s[0], s[0]) for s in signed} == due


def test_simhash_edges(edge):
    rows = simhash.near_duplicates(edge).collect()
    assert len(rows) == len(EDGE)
    got = by_id(rows)
    assert got[1]["fingerprint"] == "0" * 16 and got[3]["component_id"] == 1 == got[2]["component_id"]
    assert got[5]["component_id"] == 4 and got[None]["component_id"] is None
    assert simhash.near_duplicates(edge.limit(0)).count() == 0


# 3: mixing


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, rest = {}, sum(sizes.values())
    open_ = set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if rest * weight[s] / total >= 3 * sizes[s]}
        if not full:
            return target | {s: rest * weight[s] / total for s in open_}
        for s in full:
            target[s] = 3.0 * sizes[s]
            rest -= 3 * sizes[s]
        open_ -= full
    return target


@pytest.mark.parametrize("which", ["docs", "edge", "skew"])
def test_mixing(request, spark, docs, edge, which):
    skew = frame(spark, [(i, "w " * (i % 7), "big" if i % 3 else f"s{i % 8}") for i in range(400)] + [(999, "w " * 3, "tiny")])
    df = {"docs": docs, "edge": edge, "skew": skew}[which]
    given = df.select("doc_id", "text", "source").collect()
    rows = mixing.mix(df).collect()
    assert len(rows) == len(given) and sorted(map(str, rows)) == sorted(map(str, mixing.mix(df).collect()))
    sizes, taken = {}, {}
    for r in given:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
    due = plain_targets(sizes)
    source = {r["doc_id"]: r["source"] for r in given}
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - due[s]) < 1e-6 * max(1, due[s]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    largest = {s: max([r["size"] for r in rows if source[r["doc_id"]] == s]) * (2 if which == "edge" else 1) for s in sizes}
    assert all(abs(taken[s] - due[s]) <= largest[s] + 1e-6 for s in sizes)


def test_mixing_take(spark, edge):
    kept = mixing.take(edge)
    assert kept.columns == [c for c in edge.columns if c not in ("size", "taken")] + ["size", "taken"]
    due = sorted((r["doc_id"] or -1, r["taken"]) for r in mixing.mix(edge).where("taken > 0").collect())
    assert sorted((r["doc_id"] or -1, r["taken"]) for r in kept.collect()) == due
    assert mixing.mix(edge.limit(0)).count() == 0 and mixing.take(edge.limit(0)).count() == 0


# 4: decontamination

ITEM = "the quick brown fox jumps over the lazy dog while seven small birds watch from an old oak tree near the river bank"


def test_decontamination(spark):
    w = ITEM.split()
    swapped = w.copy()
    swapped[4], swapped[11], swapped[18] = "leaps", "brave", "pine"
    rows = [
        (1, "intro words here " + ITEM + " and more", "a"), (2, "Before. " + " ".join(swapped).upper() + "!!! after", "a"), (3, " ".join(w[:8]) + " other text entirely", "a"),
        (4, " ".join(reversed(w)), "a"), (5, None, "a"), (6, "", "a"), (7, "x " * 50_000 + ITEM, "a"), (1, "intro words here " + ITEM + " and more", "a"), (None, ITEM, "a"), (9, "tiny item text", "b"),
    ]
    docs = frame(spark, rows)
    bench = spark.createDataFrame([(10, ITEM), (11, ITEM), (12, None), (None, "null id item words"), (13, ""), (14, "some other passage which no document ever has in it at all today")], "item_id long, text string")
    found = decontam.contaminated(docs, bench).collect()
    assert sorted(r["doc_id"] or -1 for r in found) == [-1, 1, 2, 7]
    assert {tuple(r["item_ids"]) for r in found} == {(10,)} and by_id(found)[2]["matched"] == len(w) - 3
    assert by_id(found)[7]["begin"] == 50_000 and by_id(found)[7]["end"] == 50_000 + len(w)
    blocks = decontam.contaminated(docs, bench, block_words=10).collect()
    assert sorted(map(str, blocks)) != [] and sorted(r["doc_id"] or -1 for r in blocks) == [-1, 1, 2, 7]
    for size in (decontam.BLOCK_WORDS, 10):
        kept = decontam.without_contaminated(docs, bench, size)
        assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6, 9]
    assert decontam.contaminated(docs.limit(0), bench).count() == 0 and decontam.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_equals_full_scan(spark, docs, texts):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r["item_id"], decontam.words_of(r["text"].lower())) for r in bench.collect()]
    due = set()
    for i, t in texts:
        w = decontam.words_of((t or "").lower())
        index = {}
        for at, word in enumerate(w):
            index.setdefault(word, []).append(at)
        for _, own in items:
            shifts = {}
            for k, word in enumerate(own):
                for at in index.get(word, ()):
                    shifts[at - k] = shifts.get(at - k, 0) + 1
            if max(shifts.values(), default=0) >= 0.8 * min(len(own), decontam.LEAST):
                for shift in (s for s, n in shifts.items() if n >= 10):
                    lo, hi = max(0, shift), min(len(w), shift + len(own))
                    a, b, n = decontam.best_stretch(np.array([w[x] == own[x - shift] for x in range(lo, hi)]))
                    if b - a >= min(decontam.LEAST, len(own)) and n >= decontam.SHARE * (b - a):
                        due.add(i)
    assert {r["doc_id"] for r in decontam.contaminated(docs, bench).collect()} == due and due


def test_decontamination_finds_every_stretch():
    rng = random.Random(6)
    given = [[j] for j in (2, 3, 11, 12)] + [[3, 7, 11]] + [rng.sample(range(n), k) for n, k in ((15, 2), (15, 3), (20, 4), (27, 5), (38, 7), (40, 10)) for _ in range(60)]
    for k, places in enumerate(given):
        n = 15 if k < 5 else (15, 15, 20, 27, 38, 40)[(k - 5) // 60]
        own = [f"w{j}" for j in range(n)]
        copy = ["other" if j in places else w for j, w in enumerate(own)]
        runs = [(a, b) for a in range(n) for b in range(a + decontam.LEAST, n + 1) if 5 * sum(j not in places for j in range(a, b)) >= 4 * (b - a)]
        found = decontam.overlaps("before it " + " ".join(copy) + " after", decontam.build([(1, " ".join(own))]))
        assert bool(found) == bool(runs), (n, places)
        for _, begin, end, matched in found:
            assert (begin - 2, end - 2) in runs and matched == sum(j + 2 in range(begin, end) for j in range(n) if j not in places)


def test_decontamination_recall_of_the_stated_rule():
    """Random substitutions in items of 1 to 60 words against the rule by plain counting."""
    rng = random.Random(11)
    for n in range(1, 61):
        own = [f"w{n}x{j}" for j in range(n)]
        block = decontam.build([(1, " ".join(own)), (2, " ".join(f"v{j}" for j in range(40)))])
        assert decontam.overlaps("before " + " ".join(own) + " after", block)[0][1:] == (1, n + 1, n)
        for _ in range(25):
            places = {j for j in range(n) if rng.random() < rng.choice((0.1, 0.2, 0.25))}
            copy = ["other" if j in places else w for j, w in enumerate(own)]
            least = min(13, n)
            due = any(5 * sum(j not in places for j in range(a, b)) >= 4 * (b - a) for a in range(n) for b in range(a + least, n + 1))
            assert bool(decontam.overlaps("before " + " ".join(copy) + " after", block)) == due, (n, places)


def test_decontamination_counts_words_of_any_script(spark):
    bench = spark.createDataFrame([(i, "слово ещё одно и другие слова здесь " + "абвгд"[i % 5] * (i + 1)) for i in range(40)], "item_id long, text string")
    assert len(list(decontam.blocks(bench, 40))) == 8 and sum(map(len, decontam.blocks(bench, 40))) == 40


def test_decontamination_finds_short_items():
    for n in range(1, 13):
        own = [f"w{j}" for j in range(n)]
        block = decontam.build([(1, " ".join(own))])
        for k in range(n // 5 + 2):
            for places in combinations(range(n), k):
                copy = ["other" if j in places else w for j, w in enumerate(own)]
                assert bool(decontam.overlaps("before " + " ".join(copy) + " after", block)) == (k <= n // 5), (n, places)


def test_decontamination_items_without_id_or_with_equal_words(spark):
    docs = frame(spark, [(1, "it has " + ITEM, "a"), (2, "it has an unnamed item text here", "a"), (3, "nothing", "a")])
    bench = spark.createDataFrame([(10, ITEM), (11, ITEM.upper() + "!"), (12, "  " + ITEM), (None, "an unnamed item text"), (13, "of no use at all")], "item_id long, text string")
    for size in (decontam.BLOCK_WORDS, 10):
        assert [(r["doc_id"], r["item_ids"]) for r in decontam.contaminated(docs, bench, size).collect()] == [(1, [10])]
        assert [r["doc_id"] for r in decontam.without_contaminated(docs, bench, size).collect()] == [3]


# 5: toxicity


def whole(text):
    c = toxicity.encode(text)
    return c, 0, len(c) - 1


def test_kernel_is_that_of_all_triples():
    def plain(s):
        s, out = f" {s}", {}
        padded = s + " " * toxicity.SPAN
        for i in range(len(s)):
            for j in range(i + 1, i + toxicity.SPAN):
                for k in range(j + 1, i + toxicity.SPAN):
                    t = padded[i] + padded[j] + padded[k]
                    out[t] = out.get(t, 0) + toxicity.DECAY ** (k - i + 1) / max(len(s), toxicity.SHORT) ** 0.5
        return out

    strings = ["idiot", "i.d.i.o.t", "banana", "ab", "mississippi", "you are the worst"]
    got = toxicity.Landmarks.of(list(map(whole, strings))).kernel(list(map(whole, strings)))
    rows = [plain(s) for s in strings]
    due = [[sum(v * b.get(k, 0) for k, v in a.items()) for b in rows] for a in rows]
    assert np.allclose(got, due, atol=1e-9)


def test_decisions_are_those_of_the_folded_landmarks():
    rng = np.random.default_rng(2)
    base, weights = toxicity.Landmarks.of(list(map(whole, ["an idiot", "so what", "the worst one"]))), rng.normal(size=3)
    model = toxicity.Model(base.table(weights), 0.25, np.zeros(6))
    c = toxicity.encode("What an id.iot, the  worst\n of i d i o t s!")
    begin, end, d, n = model.decisions(c)
    assert n == 7 and len(d) == 7 + 6 + 5  # single letters count as one word
    assert np.allclose(d, base.kernel([(c, a, b) for a, b in zip(begin, end)]) @ weights + 0.25, atol=1e-5)


@pytest.mark.parametrize("first, size", [(0x430, 32), (0x3B1, 25), (0x5D0, 27), (0x627, 36), (0x4E00, 2000), (0x10428, 40)])
def test_kernel_tells_words_of_other_scripts_apart(first, size):
    rng = random.Random(7)
    word = lambda n: "".join(chr(first + rng.randrange(size)) for _ in range(n))
    bad, good = [word(6) for _ in range(20)], [word(6) for _ in range(200)]
    own = lambda ws: np.sqrt([toxicity.Landmarks.of([whole(w)]).kernel([whole(w)])[0, 0] for w in ws])
    between = toxicity.Landmarks.of(list(map(whole, bad))).kernel(list(map(whole, good))) / own(good)[:, None] / own(bad)
    assert between.max() < 0.9 and between.mean() < 0.2
    docs = [" ".join(rng.sample(bad if k % 2 else good, 4)) for k in range(600)]
    model = toxicity.train_windows([toxicity.encode(t) for t in docs], np.arange(600) % 2)
    top = lambda w: model.decisions(toxicity.encode(w))[2].max()
    # documents are labelled, not words, so a few words may go unlearned
    assert np.mean([[top(b) > top(g) for g in good] for b in bad]) >= 0.95


def test_toxicity_learns(spark, edge):
    rng = random.Random(5)
    syllables = ["ta", "ro", "lin", "mek", "su", "pol", "da", "ver"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    rows, labels = [], []
    for i in range(400):
        w = [word() for _ in range(40)]
        y = i % 4 == 0
        for _ in range(3 * y):
            w[rng.randrange(40)] = rng.choice(["stupid", "idiot", "moron"])
        rows.append((i, " ".join(w), "a"))
        labels.append((i, 1, int(y)))
    rows += [(1000, "ta ro lin mek you i d i o t su pol", "a"), (1001, "ta ro lin st.up.id mek moorron su", "a"), (1002, None, "a"), (1003, "", "a")]
    docs, lab = frame(spark, rows), spark.createDataFrame([*labels, (1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, lab)
    got = by_id(toxicity.score(docs, model).collect())
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in range(400) if got[i]["held_out"]} == set(held)
    assert np.mean([got[i]["predicted"] == int(i % 4 == 0) for i in held]) >= 0.97
    assert got[1000]["predicted"] == 1 and got[1001]["predicted"] == 1 and got[1002]["score"] == got[1003]["score"] < 0.5
    flipped = lab.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert by_id(toxicity.score(docs, toxicity.train(docs, flipped)).collect()) == got  # held-out labels play no part
    assert toxicity.toxicity(edge, lab).count() == len(EDGE) and toxicity.toxicity(docs.limit(0), lab).count() == 0
    assert {r["predicted"] for r in toxicity.toxicity(docs, lab.where("toxic = 0")).collect()} == {0}
    assert toxicity.toxicity(docs, lab.limit(0)).count() == len(rows)


@pytest.mark.parametrize("sf, recall, alarms, area", [("sf0.01", 0.6, 0.03, 0.9), ("sf0.1", 0.88, 0.02, 0.95)])
def test_toxicity_on_held_out_labels(spark, sf, recall, alarms, area):
    """Recall, false alarms and area under the curve; sf0.01 has 6 toxic rows held out, sf0.1 has 97."""
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    bad, good = [[r for r in rows if r["toxic"] == k] for k in (1, 0)]
    wins = sum((a["score"] > b["score"]) + 0.5 * (a["score"] == b["score"]) for a in bad for b in good) / len(bad) / len(good)
    assert np.mean([r["predicted"] for r in bad]) >= recall and np.mean([r["predicted"] for r in good]) <= alarms and wins >= area


def test_toxicity_of_several_words(spark):
    """An insult whose words are harmless alone."""
    rng = random.Random(12)
    plain = ["ta", "ro", "lin", "mek", "su", "pol", "da", "ver", "waste", "of", "space"]
    rows, labels = [], []
    for i in range(300):
        w = [rng.choice(plain) for _ in range(30)]
        w = " ".join(w).replace("waste of", "waste su").replace("of space", "of da").split()
        if i % 3 == 0:
            w[10:10] = ["waste", "of", "space"]
        rows.append((i, " ".join(w), "a"))
        labels.append((i, 1, int(i % 3 == 0)))
    got = by_id(toxicity.toxicity(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).where("held_out").collect())
    assert np.mean([r["predicted"] == int(i % 3 == 0) for i, r in got.items()]) >= 0.9


# 6: lines


def plain_lines(rows, sites):
    where = {}
    for _, t, s in rows:
        for line in (t or "").split("\n"):
            where.setdefault(line.strip(" \t\r\x0b\x0c"), set()).add(s)
    bad = {b for b, found in where.items() if len(b) >= linededup.LEAST_CHARS and len(found) >= sites}

    def clean(text):
        return "\n".join(x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c") not in bad)

    return sorted((i or -1, None if t is None else clean(t)) for i, t, _ in rows), bad


def test_lines(spark):
    rng = random.Random(2)
    shared = [f"shared boilerplate line number {k}" for k in range(12)]
    rows = [(i, "\n".join(rng.sample(shared, 3) + [f"own line of document {i}", "short", "\t" + shared[0] + " "]), f"s{rng.randrange(14)}" if i % 9 else None) for i in range(60)]
    rows += [(90 + k, "seen on few sites only, but there often", "s1") for k in range(9)] + [(99, None, "x"), (100, "", "x"), (None, shared[1], "x"), (5, rows[5][1], rows[5][2]), (101, shared[0], "s2"), (102, "\n".join(shared[:5]) + "\nand one own line here", "s3")]
    df = frame(spark, rows)
    for sites in (3, 8, 12):
        due, bad = plain_lines(rows, sites)
        out = linededup.without_boilerplate(df, sites)
        assert out.columns == [*df.columns, "n_lines", "n_removed"]
        got = out.collect()
        assert sorted(((r["doc_id"] or -1, r["text"]) for r in got), key=str) == sorted(due, key=str) and (bad or sites == 12)
        assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)
    assert linededup.without_boilerplate(df.limit(0)).count() == 0
    short = [(i, f"{'ab' * 4}\n{'cd' * 9}\nown line of {i}", f"s{i}") for i in range(9)]
    for least, lost in ((8, 2), (16, 1), (19, 0)):
        assert {r["n_removed"] for r in linededup.without_boilerplate(frame(spark, short), least_chars=least).collect()} == {lost}


def test_lines_of_a_long_document(spark):
    """Work grows with the lines, not with lines times removed lines."""
    n = 200_000
    shared = [(i, "a line that every site has\nown", f"s{i}") for i in range(9)]
    long = "\n".join("a line that every site has" if i % 2 else f"line {i}" for i in range(n))
    begin = time.monotonic()
    got = by_id(linededup.without_boilerplate(frame(spark, [*shared, (20, long, "x")])).collect())
    assert got[20]["n_removed"] == n // 2 and got[20]["text"] == "\n".join(f"line {i}" for i in range(0, n, 2))
    assert got[3]["text"] == "own" and time.monotonic() - begin < 60


def test_line_stage_keeps_only_whole_copies(spark):
    import corpus_pipeline as cp

    head, foot = "a header that all sites have", "a footer that all sites have"
    rows = [(k, f"{head}\nbody of page {k} which no other has\n {foot}", f"s{k}") for k in range(9)]
    rows += [(20, f"{head}\n{foot}\nshort", "s1"), (21, f"{head}\n{head}\n{foot}\n{foot}\nthe only own line there", "s2"), (22, head, "s3"), (23, None, "s4")]
    got = by_id(dict(cp.STAGES)["line dedup"](spark, frame(spark, rows), SF).collect())
    assert all(got[k]["text"] == f"body of page {k} which no other has" for k in range(9)) and got[21]["text"] == "the only own line there"
    assert all(got[k]["text"] == rows[k - 11][1] for k in (20, 21, 22, 23) if k != 21) and got[5]["n_chars"] == len(got[5]["text"])


# 7: quality


def plain_weights(texts, target):
    """Log weights from n-grams as tuples, with the operator's buckets, in plain Python."""
    half, h = quality.BUCKETS // 2, lambda w: xxhash.xxh32_intdigest(w.encode())

    def grams(text):
        words = re.findall(r"\w+|[^\w\s]+", (text or "").lower())
        code = [quality.AGAIN if w in words[max(0, i - 2) : i] else h(w) for i, w in enumerate(words)]
        pairs = [(a * 0x9E3779B97F4A7C15 ^ b * 0xC2B2AE3D27D4EB4F) % (1 << 64) for a, b in zip(code, code[1:])]
        return [c % half for c in code], [p // (1 << 20) % half for p in pairs]

    def model(chosen, k, extra):
        n = [extra] * half
        for t in chosen:
            for g in grams(t)[k]:
                n[g] += 1
        return n

    sizes = [[sum(len(grams(t)[k]) for t in chosen) for chosen in (target, texts)] for k in (0, 1)]
    extra = [quality.SMOOTHING * max(1.0, r / max(1, t)) for t, r in sizes]
    models = [(model(target, k, quality.SMOOTHING), model(texts, k, extra[k])) for k in (0, 1)]
    ratio = [[np.log(x / sum(t)) - np.log(y / sum(r)) for x, y in zip(t, r)] for t, r in models]
    return [sum(ratio[k][g] for k in (0, 1) for g in grams(t)[k]) for t in texts]


def test_quality_is_gumbel_top_k_of_the_weights(spark, edge):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    given = docs.select("doc_id", "text").collect()
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    plain = dict(zip([r["doc_id"] for r in given], plain_weights([r["text"] for r in given], [r["text"] for r in given if r["doc_id"] in good])))
    for k, temperature in ((60, 1.0), (60, 0.0), (7, 1.0)):
        got = {r["doc_id"]: r["log_weight"] for r in quality.select(docs, labels, k=k, temperature=temperature).collect()}
        assert len(got) == k and all(abs(got[i] - plain[i]) < 1e-6 for i in got)
        noise = {r["doc_id"]: -np.log(-np.log((int(hashlib.md5(f"{r['doc_id']}:{r['text'] or ''}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48)) for r in given}
        assert set(got) == set(sorted(plain, key=lambda i: plain[i] + temperature * noise[i])[-k:])
    share = quality.select(docs, labels, ["doc_id"], fraction=0.25)
    assert share.columns == ["doc_id", "log_weight"] and share.count() == 50 and quality.select(docs, labels, k=0).count() == 0
    assert quality.select(edge, labels.limit(0)).count() == len(EDGE) == quality.select(edge, labels.where("quality = 0")).count()
    assert quality.select(edge, labels).columns == [*edge.columns, "log_weight"]
    assert quality.select(edge, labels, k=2).count() >= 2 and quality.select(edge.limit(0), labels).count() == 0


def test_quality_on_held_out_labels(spark):
    """The target is fitted on half of the labels; rates are those of the other half. The
    fraction is the share of quality 1 in the table."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    fit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    kept = {r["doc_id"] for r in quality.select(docs, labels.where(fit), ["doc_id"], fraction=0.855).collect()}
    held = {r["doc_id"]: r["quality"] for r in labels.where(~fit).collect()}
    assert np.mean([i in kept for i, q in held.items() if q == 1]) >= 0.95 and np.mean([i in kept for i, q in held.items() if q == 0]) <= 0.15
    codes, texts = quality.Codes(), {r["doc_id"]: r["text"] for r in docs.collect()}
    model = lambda ids: (n := sum(np.bincount(quality.buckets(texts[i] or "", codes), minlength=quality.BUCKETS) for i in ids) + 1.0) / n.sum()
    target, chosen = model(i for i, q in held.items() if q == 1), model(kept)
    plain = model(random.Random(0).sample(sorted(texts), len(kept)))
    away = lambda m: float((target * np.log(target / m)).sum())
    assert away(chosen) < away(plain)  # nearer to the target than a random sample of the same size


def test_kth_largest(spark):
    rng = random.Random(1)
    values = [rng.getrandbits(48) for _ in range(500)] + [7] * 20 + [(1 << 48) - 1]
    df = spark.createDataFrame([(v,) for v in values], "level long").cache()
    for k in (1, 2, 17, 500, 505, 521):
        assert quality.kth_largest(df, k) == sorted(values, reverse=True)[k - 1]


def test_log_ratio_is_that_of_counts(spark):
    df = spark.createDataFrame([("a b a",), ("c !! c !! c",), ("",)], "text string")
    codes = quality.Codes()
    due = sum(np.bincount(quality.buckets(t, codes), minlength=quality.BUCKETS) for t in ("a b a", "c !! c !! c", ""))
    assert np.array_equal(quality.counts(df), due)


# 8: tokens


def test_tokens(spark, docs, texts, edge):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.default_tokenizer())
    odd = [(1, "a<|endoftext|>b <|endoftext|><|endoftext|>", "a"), (2, "it's we'll  x\n\n\ty 123 ½ Ⅷ …!!", "a"), (3, "नमस्ते दुनिया ࢗ࢏ ꟑ 𐵀 \U0001f600‍", "a"), (4, "  \u0085 \x1c\x1f z", "a"), (5, "q" * 5000, "a")]
    for df, given in ((docs, texts), (edge, [(i, t) for i, t, _ in EDGE]), (frame(spark, odd), [(i, t) for i, t, _ in odd])):
        got = sorted(((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.count_tokens(df, table_size=500, cache_size=100).collect()))
        due = [(i or -1, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in given]
        assert got == sorted(due)
    assert tokens.count_tokens(edge.limit(0)).count() == 0


# 9: secrets


def plain_secrets(text):
    text, found = text or "", []
    rules = [("assign", re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]
    for k, (name, rule, group, least) in enumerate(rules):
        found += [(m.start(), k, m.end(), name) for m in rule.finditer(text) if len(m.group(group)) >= least]
    return ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(found))


SECRETS = [
    "password = hunter22 and token:'abc' and API_KEY==\"abcd.efgh-1\"", "\U0001f600 secret: " + "0123456789abcdef" * 3 + " token=short token=longer1", "AKIA" + "A1" * 8 + " AKIA1 AKIAAKIA" + "B" * 20,
    "f" * 23 + " " + "f" * 24 + "G" + "a0" * 500, "password: token: abcdefgh", "secret=token=abcdefgh", "Passwd\"  =  'x' apikey:aaaaaa", "", None, "tokentoken:=password=abcdef",
]


def test_secrets(spark, docs, texts):
    rows = [(i, t, "a") for i, t in enumerate(SECRETS)] + [(0, SECRETS[0], "b"), (77, SECRETS[0], "b"), (None, SECRETS[1], "b"), (78, "x" * 300_000 + " token=abcdefgh", "b")]
    for df, given in ((frame(spark, rows), [(i, t) for i, t, _ in rows]), (docs, texts)):
        got = blobscan.find_secrets(df).collect()
        assert sorted((r["doc_id"] or -1, r["spans"]) for r in got) == sorted((i or -1, plain_secrets(t)) for i, t in given)
        for r in got:
            assert r["base_sha256"] == hashlib.sha256(r["spans"].encode()).hexdigest()
            assert [r["n_assign"], r["n_access"], r["n_hex"]] == [r["spans"].count(f"{k}:") for k in ("assign", "access", "hex")]
    assert blobscan.find_secrets(df.limit(0)).count() == 0


def pairs_of(df):
    return sorted((bytes(r["blob"]).hex(), r["rule"], r["version"]) for r in df.collect())


@pytest.mark.parametrize("bits", [1, 2, 1 << 15, blobscan.BITS])
def test_map_of_unseen_blobs_loses_none(spark, monkeypatch, bits):
    monkeypatch.setattr(blobscan, "BITS", bits)
    blobs = spark.range(4000).select(blobscan.blob_id(F.col("id").cast("string")).alias("blob"), "id")
    passed = {r["id"] for r in blobscan.likely_in(blobs, blobs.where("id % 4 = 0")).collect()}
    assert passed >= set(range(0, 4000, 4)) and (bits <= 1 << 15 or len(passed) < 1010)
    assert blobscan.likely_in(blobs, blobs.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [1, blobscan.BITS])
def test_ledger_scans_only_unseen_pairs(spark, monkeypatch, bits):
    monkeypatch.setattr(blobscan, "BITS", bits)
    first = frame(spark, [(1, SECRETS[0], "a"), (2, "plain", "a")])
    ledger = blobscan.update(first)
    names = [r.name for r in blobscan.RULES]
    sha = lambda *texts: {hashlib.sha256((t or "").encode()).hexdigest() for t in texts}
    assert pairs_of(ledger.pairs) == sorted((b, n, 1) for b in sha(SECRETS[0], "plain") for n in names)
    both = first.unionByName(frame(spark, [(3, SECRETS[1], "a"), (4, SECRETS[0], "b"), (5, None, "b"), (None, "", "b")]))
    new = blobscan.scan_new(both, pairs=ledger.pairs)
    assert pairs_of(new.pairs) == sorted((b, n, 1) for b in sha(SECRETS[1], "") for n in names)  # scanned pairs are the unseen ones
    assert {bytes(r["blob"]).hex() for r in new.findings.collect()} == sha(SECRETS[1])
    whole = sorted(map(str, blobscan.find_secrets(both).collect()))
    assert sorted(map(str, blobscan.find_secrets(both, ledger=ledger).collect())) == whole
    assert blobscan.scan_new(both, pairs=blobscan.update(both, ledger=ledger).pairs).pairs.count() == 0
    # a rule that changes is scanned anew, and findings of its earlier version no longer count
    newer = tuple(blobscan.Rule("hex", 2, r"(?<![0-9a-f])[0-9a-f]{30,}", r.hint) if r.name == "hex" else r for r in blobscan.RULES)
    ledger = blobscan.update(both, ledger=ledger)
    assert {r["rule"] for r in blobscan.scan_new(both, newer, ledger.pairs).pairs.collect()} == {"hex"}
    assert sorted(map(str, blobscan.find_secrets(both, newer, ledger).collect())) == sorted(map(str, blobscan.find_secrets(both, newer).collect()))


def test_stored_ledger_lasts(spark, tmp_path, monkeypatch):
    """Opened by another session, after a write that died, and by two writers at a time."""
    root = str(tmp_path / "ledger")
    first = frame(spark, [(1, SECRETS[0], "a"), (2, "plain", "a")])
    both = first.unionByName(frame(spark, [(3, SECRETS[1], "a"), (4, SECRETS[0], "b"), (5, None, "b")]))
    names = [r.name for r in blobscan.RULES]
    sha = lambda *texts: {hashlib.sha256((t or "").encode()).hexdigest() for t in texts}
    due = lambda *texts: sorted((b, n, 1) for b in sha(*texts) for n in names)
    assert pairs_of(blobscan.StoredLedger(spark, root).opened()[2].pairs) == []
    blobscan.StoredLedger(spark, root).update(first)
    other = spark.newSession()
    assert pairs_of(blobscan.StoredLedger(other, root).opened()[2].pairs) == due(SECRETS[0], "plain")

    again = other.createDataFrame(both.collect(), both.schema)
    dead = blobscan.StoredLedger(other, root)
    monkeypatch.setattr(dead, "commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        dead.update(again)
    assert blobscan.StoredLedger(other, root).opened()[1] == 1

    slow, scanned = blobscan.StoredLedger(other, root), []
    plain_scan, plain_commit = blobscan.scan_new, slow.commit

    def commit(version, parts):
        monkeypatch.setattr(slow, "commit", plain_commit)
        blobscan.StoredLedger(spark, root).update(frame(spark, [(9, SECRETS[1], "c")]))
        return plain_commit(version, parts)

    def scan_new(*args):
        new = plain_scan(*args)
        scanned.append(pairs_of(new.pairs))
        return new

    monkeypatch.setattr(slow, "commit", commit)
    monkeypatch.setattr(blobscan, "scan_new", scan_new)
    whole = slow.update(again)
    assert scanned == [due(SECRETS[1], ""), due(SECRETS[1]), due("")]
    assert pairs_of(whole.pairs) == due(SECRETS[0], "plain", SECRETS[1], "")
    assert whole.findings.count() == whole.findings.distinct().count() > 0
    ledger = blobscan.StoredLedger(spark, root)
    assert sorted(map(str, blobscan.find_secrets(both, ledger=ledger).collect())) == sorted(map(str, blobscan.find_secrets(both).collect()))
    assert ledger.opened()[1] == 3  # nothing new, nothing appended


def test_secrets_query_equals_one_scan(spark):
    from pitpanel.llm import queries

    due = blobscan.find_secrets(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert sorted(map(str, queries.op9_secrets(spark, SF).collect())) == sorted(map(str, due))


# 10: personal data


def plain_entities(text):
    text, found = text or "", []
    rules = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    for k, rule in enumerate(rules):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = (
                True if k == 0 else all(int(p) <= 255 for p in m.group().split(".")) if k == 1 else 9 <= len(digits) <= 15 if k == 3
                else 12 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            )
            if ok:
                found.append((m.start(), k, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


PERSONAL = [
    "mail a.b@c.de, x@y, @z.com, a@b.c%d@e.f a@b.co@d.ef", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.004 1.2.3", "4539 1488 0343 6467 and 4539148803436467 12 4539148803436467", "+1 (555) 010-9999 +123 +1..2 + 44 20 7946 0958 +44 20 7946 0958.",
    None, "", "\U0001f600 a@b.cd", "é@x.yz é.a@x.yz",
]


def test_entities(spark, docs, texts):
    rng = random.Random(4)
    noise = ["".join(rng.choice("ab1.2@+- ()%9") for _ in range(60)) for _ in range(300)]
    for t in PERSONAL + noise:
        assert ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in pii.entities(t or "")) == plain_entities(t)
    for t in ("a" * 200_000, "1" * 200_000, "+1" + " " * 200_000, "1." * 100_000, "a@" * 50_000):
        pii.entities(t)  # linear, not quadratic
    rows = [(i, t, "a") for i, t in enumerate(PERSONAL)] + [(1, PERSONAL[1], "a"), (None, PERSONAL[0], "a")]
    for df, given in ((frame(spark, rows), [(i, t) for i, t, _ in rows]), (docs, texts)):
        got = pii.personal_data(df).collect()
        due = sorted((-1 if i is None else i, hashlib.sha256(plain_entities(t).encode()).hexdigest()) for i, t in given)
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["base_sha256"]) for r in got) == due
    assert pii.personal_data(df.limit(0)).count() == 0


def test_contexts_discover_identifiers(spark):
    rows = [(i, f"filler text {i} please write to user{i}@mail.example.org soon", "a") for i in range(30)]
    rows += [(40, "kindly please write to member-77441 soon or later", "a"), (41, "the part number 99887766 is in stock", "a")]
    got = by_id(pii.personal_data(frame(spark, rows)).collect())
    start = rows[30][1].index("member-77441")
    assert got[40]["spans"] == f"context:{start}:{start + 12}" and got[40]["n_context"] == 1
    assert got[41]["spans"] == "" and got[3]["n_email"] == 1 and got[3]["n_context"] == 0


def test_patterns_and_totals_agree(spark):
    """Totals of patterns by plain counting over whole words, whatever stands between them."""
    rng = random.Random(9)
    words = ["mail", "call", "to", "at", "no-break\u00a0space", "next\u2028line", "-", "x" * 100, "Über", "now.", "user7777@a.bc", "id-12345", "4539", "1488", "0343", "6467", "+1 (555) 010-9999"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["a lonely 77441 number", "77441", ""]
    df = frame(spark, [(i, t, "a") for i, t in enumerate(texts)])
    found = [c for t in texts for c in pii.candidates(t, pii.entities(t))]
    patterns = {p for c in found for p in (c[4], c[5]) if p}
    assert any(p.startswith("M4 ") for p in patterns) and "M1 lonely number" in patterns and "L a lonely" in patterns
    plain = {}
    for t in texts:
        w = [x for x in (x.strip(pii.MARKS).lower() for x in re.findall("[^\x20\x09-\x0d]+", t)) if x]
        for i in range(len(w)):
            if i + 2 < len(w):
                plain[f"L {w[i]} {w[i + 1]}"] = plain.get(f"L {w[i]} {w[i + 1]}", 0) + 1
            for k in range(1, 12):
                if i + k + 1 < len(w):
                    plain[f"M{k} {w[i]} {w[i + k + 1]}"] = plain.get(f"M{k} {w[i]} {w[i + k + 1]}", 0) + 1
    for block in (10**6, 50):
        got = {r["pattern"]: r["total"] for r in pii.occurrences(df, spark.createDataFrame([(p,) for p in sorted(patterns)], "pattern string"), block).collect()}
        assert got == {p: plain[p] for p in patterns}


def test_token_table_and_settings(spark, docs, tmp_path):
    import json

    path = tokens.default_tokenizer()
    table = tokens.frequent_lengths(docs, path, 50, 300, 1000)
    assert 100 < len(table) <= 1000 and max(table, key=len) and set(table.values()) >= {1, 2}
    assert tokens.frequent_lengths(docs.limit(0), path, 50, 300, 1000) == {} and tokens.frequent_lengths(frame(spark, [(None, "a a b", "x")]), path, 50, 3, 10) == {"a": 1, " a": 1, " b": 1}
    assert tokens.special_strings(path) == ["<|endoftext|>"]
    import public_tokenizers

    with pytest.raises(ValueError, match="not a byte-level"):
        tokens.special_strings(public_tokenizers.path("word_bpe_49k.json"))
    changed = json.loads(open(path, encoding="utf-8").read())
    changed["added_tokens"].append(dict(changed["added_tokens"][0], id=50257, content="<|endoftext|><|more|>"))
    (tmp_path / "t.json").write_text(json.dumps(changed))
    given = ["a<|endoftext|><|more|> b<|more|>", "<|endoftext|>", "plain"]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(str(tmp_path / "t.json"))
    got = tokens.count_tokens(frame(spark, [(i, t, "a") for i, t in enumerate(given)]), str(tmp_path / "t.json")).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in got] == [len(library.encode(t, add_special_tokens=False).ids) for t in given]


# pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = [name for name, _ in cp.STAGES]
    assert len(first) == 5
    for k, (_, stage) in enumerate(cp.STAGES):
        before = docs
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or docs.columns == before.columns
        assert docs.join(before, "doc_id", "left_anti").count() == 0
        if k == 2:
            comp = by_id(simhash.near_duplicates(before).collect())
            assert {r["doc_id"] for r in docs.collect()} == {i for i, r in comp.items() if r["component_id"] == i}
        if k == 3:
            found = {r["doc_id"] for r in decontam.contaminated(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before.collect()} - found
    assert {(r["doc_id"], r["taken"]) for r in cp.run(spark, SF).collect()} == {(r["doc_id"], r["taken"]) for r in docs.collect()}


def test_pipeline_edges(spark, edge):
    import corpus_pipeline as cp

    for name, stage in cp.STAGES:
        assert stage(spark, edge.limit(0), SF).count() == 0, name
        out = stage(spark, edge, SF)
        assert name == "mixing" or out.columns == edge.columns
        out.collect()
    kept = sorted(r["doc_id"] or -1 for r in dict(cp.STAGES)["near-dedup"](spark, edge, SF).collect())
    assert kept == [-1, 1, 4, 7, 8]


def test_near_stage_keeps_one_row_of_each_group(spark):
    import corpus_pipeline as cp

    rng = random.Random(8)
    text = ["".join(rng.choice("abcdefghij ") for _ in range(400)) for _ in range(12)]
    rows = [(None, text[k], "a") for k in range(4)] + [(None, text[0], "b"), (1, text[4], "a"), (1, text[5], "a"), (2, text[6], "a"), (2, text[7], "a"), (3, text[7], "a")]
    rows += [(4, text[8], "a"), (4, text[8], "a"), (5, text[8], "a"), (None, text[8], "a"), (0, text[9], "a"), (0, text[10], "a"), (-1, text[10], "a")]
    assert len({plain_fingerprint(t) for t in text}) == 12 == len(set(plain_components([(k, plain_fingerprint(t)) for k, t in enumerate(text)]).values()))
    got = dict(cp.STAGES)["near-dedup"](spark, frame(spark, rows), SF)
    assert got.columns == frame(spark, rows[:1]).columns
    due = [(None, text[k]) for k in range(4)] + [(1, text[4]), (1, text[5]), (2, text[6]), (2, text[7]), (4, text[8]), (0, text[9]), (-1, text[10])]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(due, key=str)
