import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from marketloom.llm import near_dedup
from marketloom.llm.common import joined
from marketloom.llm.components import components
from marketloom.llm.near_dedup import BITS, PARTS, RADIUS, Anchors, fingerprint, linked, near_groups, one_of_each_group, part_of


def plain_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


@pytest.mark.parametrize("text", ["", "one", "A b c", "A É b c", "a b  c\nd e f\x0bg", "x " * 50, "the cat sat on the mat and the cat sat"])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_the_code_covers_every_word_within_its_radius():
    anchors = Anchors(RADIUS)
    assert ((anchors.errors >= 0).sum(axis=1) == 1).all()
    words = np.random.default_rng(0).integers(0, 1 << 23, 500)
    _, near, _ = anchors.of(words)
    assert np.bitwise_count(near ^ words).max() <= RADIUS


def test_linked_prints_always_meet_at_a_home():
    rng = random.Random(1)
    anchors = Anchors(RADIUS + BITS // len(PARTS))
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(5)):
            b ^= 1 << bit
        pair = np.array([a, b], np.uint64).view(np.int64)
        met = False
        for start, width in PARTS:
            which, anchor, home = anchors.of(part_of(pair, start, width))
            seats = Counter(zip(anchor.tolist(), which.tolist(), strict=True))
            met |= any((x, 1 - w) in seats for x, w, h in zip(anchor.tolist(), which.tolist(), home.tolist(), strict=True) if h)
        assert met


@pytest.mark.parametrize("dense", [False, True])
def test_links_at_an_anchor_equal_brute_force(dense):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(3 if dense else 60)]
    prints = set()
    for _ in range(600):
        x = rng.choice(base)
        for bit in rng.sample(range(64), rng.randrange(4)):
            x ^= 1 << bit
        prints.add(x)
    visitors = np.sort(np.array(sorted(prints), np.uint64).view(np.int64))
    label = linked(visitors, visitors)
    groups = brute_groups([int(v) for v in visitors.view(np.uint64)])
    assert len(set(zip(label.tolist(), groups, strict=True))) == len(set(groups)) == len(set(label.tolist()))


@pytest.mark.parametrize("homes", [4096, 5])
def test_groups_equal_brute_force(spark, monkeypatch, homes):
    monkeypatch.setattr(near_dedup, "HOMES_PER_TASK", homes)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 30, 300]))] for _ in range(15)]
    rows = []
    for i in range(120):
        copy = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((i + 5, " ".join(copy)))
    rows += [(3, None), (2, ""), (None, " \n"), (None, rows[0][1]), (7, rows[2][1]), (4, "long " * 30000)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, fp int").repartition(5)
    groups = brute_groups([plain_fingerprint(t) for _, t in rows])
    least = {g: min((d for (d, _), h in zip(rows, groups, strict=True) if h == g and d is not None), default=None) for g in groups}
    wanted = Counter((d, f"{plain_fingerprint(t):016x}", least[g]) for (d, t), g in zip(rows, groups, strict=True))
    assert Counter(map(tuple, near_groups(docs).collect())) == wanted
    kept = one_of_each_group(docs).collect()
    assert Counter(r.doc_id for r in kept) == Counter(least.values()) and kept[0].asDict().keys() == {"doc_id", "text", "fp"}


def test_an_empty_table_gives_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_groups(docs).count() == 0 and one_of_each_group(docs).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 130)] + [(200, 200), (300, 299), (299, 300)]
    rng = random.Random(0)
    rng.shuffle(edges)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 299: 299, 300: 299}


def test_joined_labels():
    label = joined(np.arange(6), np.array([1, 3, 4]), np.array([2, 4, 2]))
    assert label.tolist() == [0, 1, 1, 1, 1, 5]
