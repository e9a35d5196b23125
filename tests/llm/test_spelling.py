import random
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketloom.llm.spelling import near_words, spelling_variants, trie_edges, variant_groups, word_counts


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts):
    out = {}
    for w, n in counts.items():
        near = [t for t in counts if one_apart(w, t)]
        best = min(near, key=lambda t: (-counts[t], t), default=None)
        out[w] = [best if best is not None and counts[best] >= 10 * n else None, n, len(near)]
    rows = set()
    for w, (form, n, n_near) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.add((w, form, root, n, n_near, counts[form] if form else None))
    return rows


def brute_counts(rows):
    import re

    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    return {w: n for w, n in counts.items() if n >= 2}


def dense_words(seed, count, alphabet="abé", low=7, high=11):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(low, high))) for _ in range(count)})


def spells(edges):
    """The words that the edges spell out, from the depth where the tries begin."""
    children = {}
    for node, label, terminal in edges:
        assert label
        children.setdefault(node, {})[label] = terminal
    for labels in children.values():
        assert len({x[0] for x in labels}) == len(labels)
    return {node + label for node, label, terminal in edges if terminal}


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.lists(st.integers(0, 60), max_size=5))
def test_edges_do_not_depend_on_the_ranges(seed, count, cuts):
    words = [">" + w for w in dense_words(seed, count, "ab", 7, 12)]
    cuts = sorted({min(c, len(words)) for c in cuts} | {0, len(words)})
    ranges = [words[a:b] for a, b in zip(cuts[:-1], cuts[1:]) if a < b]
    rows = []
    for i, r in enumerate(ranges):
        before, after = ranges[i - 1][-1] if i else None, ranges[i + 1][0] if i + 1 < len(ranges) else None
        rows.extend((w, before, after, k == 0) for k, w in enumerate(r))
    found = {}
    for node, label, terminal in trie_edges(iter(rows)):
        found[node, label] = found.get((node, label), False) or terminal
    assert spells({(n, x, t) for (n, x), t in found.items()}) == set(words)
    parents = {n for n, _ in found}
    for w in words:  # every depth where a walk may begin is a node
        assert all(w[:d] in parents for d in range(4, min(7, len(w) - 1) + 1))
    for n in parents:  # and every node is reached
        assert len(n) == 4 or any(n[:d] in parents and (n[:d], n[d:]) in found for d in range(4, len(n)))


@pytest.mark.parametrize("alphabet", ["ab", "abé", "abcdefÿ"])
def test_near_words_equal_brute_force(spark, alphabet):
    words = dense_words(3, 250, alphabet) + ["z" * n for n in range(7, 40)] + ["q" * 3000 + "a", "q" * 3000 + "b", "q" * 3001 + "a", "b" + "q" * 3000]
    words = sorted(set(words))
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(5)
    found = [tuple(r) for r in near_words(frame).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in words for b in words if one_apart(a, b)}


def test_forms_ties_and_chains(spark):
    counts = {"aaaaaaa": 5000, "aaaaaab": 500, "aaaaabb": 50, "aaaabbb": 5, "aaabbbb": 4, "zzzzzzz": 30, "zzzzzzzx": 3, "zzzzzzy": 30, "lonely word": 9, "aaaaaaaa": 500}
    found = variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert {tuple(r) for r in found} == brute(counts)
    by_word = {r.word: r for r in found}
    assert by_word["aaaabbb"].root == "aaaaaaa" and by_word["zzzzzzzx"].form == "zzzzzzz"


def test_texts_equal_brute_force(spark):
    rng = random.Random(9)
    words = dense_words(5, 40, "abcÉé") + ["Straßenbahn", "mañana×là", "FAÇADES", "x" * 2500]
    rows = [(i if i % 7 else None, " ".join(rng.choice(words) + rng.choice(["", ".", "-", "1", " "]) for _ in range(60))) for i in range(80)]
    rows += [(1000, None), (1001, ""), (1002, "short"), rows[1], rows[1], (1003, "Long" + "word" * 3000 + " " + "again " * 9)]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    assert {(r.word, r.n) for r in word_counts(frame).collect()} == set(brute_counts(rows).items())
    assert {tuple(r) for r in spelling_variants(frame).collect()} == brute(brute_counts(rows))


def test_an_empty_table(spark):
    assert spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
