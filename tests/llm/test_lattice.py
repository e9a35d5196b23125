import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marketloom.llm.common import mix
from marketloom.llm.lattice import FIRST_PIECE, SPACE, Lattice, Pieces, _units, decode, encode_samples, sample
from marketloom.llm.queries import PIECES, tokenizer_path

TEXTS = [None, "", " ", "a", "the cat", "  two  spaces ", "line\n\tnext", "été ａ 字x 𝄞", "x" * 3000, "word " * 800, "end\n"]


@pytest.fixture(scope="module")
def pieces():
    return Pieces(tokenizer_path(PIECES))


def everything(pieces, text):
    """All segmentations with their probabilities."""
    whole = SPACE + text.replace(" ", SPACE)
    rank = {p: i for i, p in enumerate(pieces.text) if i >= FIRST_PIECE}
    found = {}

    def extend(at, ids, weight):
        if at == len(whole):
            found[tuple(ids)] = weight
            return
        for end in range(at + 1, len(whole) + 1):
            i = rank.get(whole[at:end])
            if i is not None:
                extend(end, [*ids, i], weight + pieces.weight[i])
        if whole[at] not in rank:
            extend(at + 1, [*ids, *(3 + b for b in whole[at].encode())], weight + pieces.unknown)

    extend(0, [], 0.0)
    total = np.logaddexp.reduce(list(found.values()))
    return {ids: w - total for ids, w in found.items()}


def seeds(n, start=0):
    return mix(np.arange(start, start + n).astype(np.uint64))


@pytest.mark.parametrize("text", ["on a", "the\n", "xé 1"])
def test_samples_are_distinct_and_have_their_probabilities(pieces, text):
    chances = everything(pieces, text)
    for found in sample([text] * 50, seeds(50), Lattice(pieces), 4):
        names = [tuple(ids.tolist()) for ids, _, _ in found]
        assert len(set(names)) == len(names) == min(4, len(chances))
        for name, (_, chance, include) in zip(names, found, strict=True):
            assert abs(chances[name] - chance) < 1e-9 and 0 < include <= 1


def test_all_segmentations_come_when_k_is_large(pieces):
    chances = everything(pieces, "an a")
    (found,) = sample(["an a"], seeds(1), Lattice(pieces), len(chances) + 5)
    assert {tuple(ids.tolist()) for ids, _, _ in found} == set(chances) and all(include == 1 for *_, include in found)


def test_draws_follow_the_lattice(pieces):
    text, n = "on a", 6000
    chances = everything(pieces, text)
    drawn = sample([text] * n, seeds(n), Lattice(pieces), 2)
    first = Counter(tuple(f[0][0].tolist()) for f in drawn)
    second = Counter(tuple(f[1][0].tolist()) for f in drawn)
    p = {name: np.exp(c) for name, c in chances.items()}
    for name, chance in sorted(p.items(), key=lambda x: -x[1])[:4]:
        then = sum(p[o] * chance / (1 - p[o]) for o in p if o != name)
        assert abs(first[name] / n - chance) < 0.03 and abs(second[name] / n - then) < 0.03


def test_inclusion_scores_estimate_sums(pieces):
    text, n = "on a", 6000
    length = {name: len(name) for name in everything(pieces, text)}
    mean = sum(np.exp(c) * length[name] for name, c in everything(pieces, text).items())
    estimates = [sum(np.exp(chance) / include * len(ids) for ids, chance, include in found) for found in sample([text] * n, seeds(n, 10**6), Lattice(pieces), 3)]
    assert abs(np.mean(estimates) - mean) < 0.1


def test_round_trip_and_columns(spark, pieces):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "no id", 2), (4, "the cat", 3)], "doc_id long, text string, sample int")
    path = tokenizer_path(PIECES)
    rows = encode_samples(docs.repartition(3), path, k=3)
    found = rows.collect()
    assert all(r.decodes for r in found)
    again = {(r.doc_id, r.sample, tuple(r.ids)) for r in encode_samples(docs.coalesce(1), path, k=3).collect()}
    assert again == {(r.doc_id, r.sample, tuple(r.ids)) for r in found}
    for r in decode(rows, path).collect():
        assert r.text == ("no id" if r.doc_id is None else TEXTS[r.doc_id] or "")
    assert [r.n_pieces for r in found if r.doc_id in (0, 1)] == [0, 0]
    assert encode_samples(docs.limit(0), path).count() == 0


def test_units_are_spaces_and_what_follows():
    texts = [t or "" for t in TEXTS] + ["", "▁", "a▁", "▁▁x▁ ", " a", "字 字"]
    wanted = [re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
    counts, units = _units(pa.array(texts))
    assert counts.tolist() == [len(w) for w in wanted] and units.to_pylist() == [u for w in wanted for u in w]


@pytest.mark.parametrize("most", [0, 10**6])
def test_samples_are_the_same_after_words_were_dropped(pieces, most):
    def plain(found):
        return [(ids.tolist(), round(chance, 9), round(include, 9)) for f in found for ids, chance, include in f]

    texts = ["on a mat", "the cat sat", "a mat", "on the 字 x"] * 3
    wanted = [plain(sample([t], seeds(1, i), Lattice(pieces), 3)) for i, t in enumerate(texts)]
    lattice, found = Lattice(pieces), []
    for i, t in enumerate(texts):
        found.append(plain(sample([t], seeds(1, i), lattice, 3)))
        if i % 5 == 4:
            before = len(lattice.number)
            lattice.forget(most)
            assert len(lattice.number) < before and bool(lattice.number) == (most > 0)
    assert found == wanted
