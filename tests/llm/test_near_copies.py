import random
from itertools import combinations

import pyarrow as pa
import pytest

from corpus_pipeline import near_dedup
from marketloom.llm.near_copies import shingle_sets
from marketloom.llm.near_dedup import fingerprint


def plain_set(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def copies(rng, n):
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(n):
        base = [rng.choice(words) for _ in range(rng.choice([4, 60, 250]))]
        texts.append(base)
        for _ in range(rng.randrange(4)):
            copy = list(base)
            for _ in range(rng.randrange(1, max(2, len(base) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
    rng.shuffle(texts)
    return [" ".join(t) for t in texts] + ["", "  "]


def test_shingles():
    texts = ["", "A b", "a B c d e f", "x x x x x x x x"]
    found = shingle_sets(pa.array(texts))
    assert [len(s) for s in found] == [len(plain_set(t)) for t in texts]
    assert shingle_sets(pa.array(["a  b"]))[0].tolist() == found[1].tolist()


@pytest.mark.parametrize("seed", [1, 2])
def test_the_stage_keeps_one_of_all_similar_texts(spark, sample, seed):
    texts = copies(random.Random(seed), 60)
    sets, prints = [plain_set(t) for t in texts], [fingerprint(t) for t in texts]
    label, by_print = list(range(len(texts))), 0
    for i, j in combinations(range(len(texts)), 2):
        similar = len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
        near = (prints[i] ^ prints[j]).bit_count() <= 4
        by_print += similar and not near
        if (similar or near) and label[i] != label[j]:
            low, high = sorted((label[i], label[j]))
            label = [low if x == high else x for x in label]
    assert by_print > 10
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in near_dedup(spark, docs, sample).collect()) == sorted(set(label))


def test_an_empty_table_gives_nothing(spark, sample):
    assert near_dedup(spark, spark.createDataFrame([], "doc_id long, text string"), sample).count() == 0


def test_grids_of_shares_find_what_one_task_finds(spark):
    """All texts under roots of their own in one crowded band: links join the same classes, whatever the shares."""
    from marketloom.llm.near_copies import settled

    rng = random.Random(8)
    texts = sorted({t for t in copies(rng, 30) if t.strip()})
    sets = {t.encode(): shingle_sets(pa.array([t]))[0] for t in texts}
    rooted = spark.createDataFrame([(7, t.encode(), i) for i, t in enumerate(texts)], "key long, node binary, root long")
    shingles = spark.createDataFrame([(t, s.tobytes()) for t, s in sets.items()], "node binary, shingles binary")

    def classes(links):
        label = {t.encode(): i for i, t in enumerate(texts)}
        for a, b in links:
            low, high = sorted((label[a], label[b]))
            label = {t: low if x == high else x for t, x in label.items()}
        return label

    wanted = classes([(a, b) for a, b in combinations(sets, 2) if len(set(sets[a].tolist()) & set(sets[b].tolist())) >= 0.8 * len(set(sets[a].tolist()) | set(sets[b].tolist()))])
    for share_bytes in (1 << 24, 20_000, 3_000):
        found = [(bytes(r.a), bytes(r.b)) for r in settled(rooted, shingles, share_bytes=share_bytes).collect()]
        assert classes(found) == wanted
        assert share_bytes < 1 << 24 or len(found) == len(texts) - len(set(wanted.values()))


def test_a_large_group_gives_few_links(spark, sample):
    """Copies of one text with a word changed each: every text is similar to most others, and one stays."""
    rng = random.Random(2)
    base = [rng.choice([f"w{i}" for i in range(900)]) for _ in range(120)]
    texts = []
    for i in range(300):
        copy = list(base)
        copy[rng.randrange(120)] = f"x{i}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert [r.doc_id for r in near_dedup(spark, docs, sample).collect()] == [0]


# Two texts with one 64-bit hash: an identity by that hash alone would take them for one.
CLASH = ("the quick brown ", "6Gt|hCNo@3)@hCmW")


def test_texts_that_clash_in_a_hash_stay_apart(spark, sample):
    import pyspark.sql.functions as F

    docs = spark.createDataFrame([(None, t) for t in CLASH], "doc_id long, text string")
    assert docs.select(F.xxhash64("text").alias("h")).distinct().count() == 1
    assert {r.text for r in near_dedup(spark, docs, sample).collect()} == set(CLASH)

