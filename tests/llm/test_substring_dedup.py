import random
from collections import defaultdict
from hashlib import sha256

import pytest

from marketloom.llm.substring_dedup import remove_repeats, without_repeats


def brute(rows, window):
    starts = defaultdict(list)
    words = [(t or "").encode().split() for _, t in rows]
    for i, w in enumerate(words):
        for p in range(len(w) - window + 1):
            starts[tuple(w[p : p + window])].append((i, p))
    gone = [set() for _ in rows]
    for places in starts.values():
        if len(places) > 1:
            for i, p in places:
                gone[i].update(range(p, p + window))
    out = []
    for (doc, _), w, g in zip(rows, words, gone, strict=True):
        kept = b" ".join(x for i, x in enumerate(w) if i not in g)
        out.append((doc, len(w), len(g), sha256(kept).hexdigest(), kept.decode()))
    return out


def corpus(seed, size=60):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "é", "a", *[f"w{i}" for i in range(60)]]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(5, 90))] for _ in range(12)]
    rows = []
    for i in range(size):
        words = []
        for _ in range(rng.randrange(0, 7)):
            kind = rng.randrange(4)
            if kind == 0:
                words += [rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))]
            elif kind == 1:
                words += [rng.choice(vocabulary)] * rng.randrange(1, 60)
            else:
                p = list(rng.choice(passages))
                a = rng.randrange(len(p))
                if rng.random() < 0.3:
                    p[a] = rng.choice(vocabulary)
                words += p if rng.random() < 0.6 else p[a:]
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(words)))
    return [*rows, (size, None), (size + 1, ""), (None, rows[0][1]), (None, " \t "), (3, rows[3][1])]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(("window", "k"), [(35, 10), (12, 4)])
def test_equals_brute_force(spark, seed, window, k):
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, "x", 7) for d, t in rows], "doc_id long, text string, pos string, k1 int").repartition(5)
    wanted = brute(rows, window)
    found = remove_repeats(docs, window, k).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str(w[:4]) for w in wanted)
    assert any(w[2] for w in wanted) and any(0 < w[2] < w[1] for w in wanted)


def test_rows_keep_their_columns(spark):
    rows = corpus(1)
    docs = spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, k1 int")
    wanted = [(d, t if not w[2] else w[4], 7) for (d, t), w in zip(rows, brute(rows, 35), strict=True)]
    assert sorted(map(str, map(tuple, without_repeats(docs).collect()))) == sorted(map(str, wanted))


def test_an_empty_table_gives_nothing(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_texts_that_clash_in_a_hash_keep_their_own_words(spark):
    """The two texts share a 64-bit hash and have no id: each keeps its own result."""
    rows = [(None, "the quick brown "), (None, "6Gt|hCNo@3)@hCmW")]
    found = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.n_words, r.kept_sha256) for r in found) == sorted((w[1], w[3]) for w in brute(rows, 35))

