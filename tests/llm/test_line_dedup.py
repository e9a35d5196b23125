import random
from itertools import combinations

import pyarrow as pa
import pytest

from marketloom.llm import line_dedup
from marketloom.llm.line_dedup import judge_lines, segment_keys, within, without_repeated_lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def edited(rng, line, edits):
    chars = list(line)
    for _ in range(edits):
        at, kind = rng.randrange(len(chars) + 1), rng.randrange(3)
        if kind == 0:
            chars.insert(at, rng.choice("abcé"))
        elif chars and kind == 1:
            del chars[at % len(chars)]
        elif chars:
            chars[at % len(chars)] = rng.choice("abcé")
    return "".join(chars)


def some_lines(rng, n):
    base = ["".join(rng.choice("abc é") for _ in range(rng.choice([3, 12, 19, 20, 21, 22, 40, 41, 75]))) for _ in range(n // 4)]
    return base + [edited(rng, rng.choice(base), rng.randrange(5)) for _ in range(n - len(base))]


@pytest.mark.parametrize("errors", [1, 2, 3])
def test_the_automaton_is_the_edit_distance(errors):
    rng = random.Random(errors)
    pairs = [(x, edited(rng, x, rng.randrange(6))) for x in some_lines(rng, 300)] + [("", ""), ("", "ab"), ("abc", "")]
    found = within(pa.array([a for a, _ in pairs]), pa.array([b for _, b in pairs]), errors)
    assert found.tolist() == [distance(a, b) <= errors for a, b in pairs]


@pytest.mark.parametrize("errors", [1, 2])
def test_near_lines_always_meet(errors):
    rng = random.Random(10 + errors)
    lines = sorted(set(some_lines(rng, 160)))
    line, key, probes = segment_keys(pa.array(lines), errors)
    indexed, probed = {}, {}
    for i, k, p in zip(line.tolist(), key.tolist(), probes.tolist(), strict=True):
        (probed if p else indexed).setdefault(k, set()).add(i)
    meet = {frozenset((i, j)) for k, own in indexed.items() for i in own for j in probed.get(k, ()) if i != j}
    near = {frozenset((i, j)) for i, j in combinations(range(len(lines)), 2) if min(len(lines[i]), len(lines[j])) >= 20 and distance(lines[i], lines[j]) <= errors}
    assert near and near <= meet


def brute(rows, errors=2, min_chars=20):
    lines = {}
    for doc, text in rows:
        for no, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\x0b\x0c\r"):
                lines.setdefault(line, []).append((doc is None, doc or 0, no))
    names = list(lines)
    group = {x: {x} for x in names}
    for a, b in combinations(names, 2):
        if min(len(a), len(b)) >= min_chars and abs(len(a) - len(b)) <= errors and group[a] is not group[b] and distance(a, b) <= errors:
            group[a] |= group[b]
            for x in group[b]:
                group[x] = group[a]
    gone = {}
    for own in {id(g): g for g in group.values()}.values():
        for null, doc, no in sorted({p for x in own for p in lines[x]})[1:]:
            gone.setdefault(None if null else doc, set()).add(no)
    return gone


@pytest.mark.parametrize("group_rows", [4096, 3])
def test_lines_equal_brute_force(spark, monkeypatch, group_rows):
    monkeypatch.setattr(line_dedup, "GROUP_ROWS", group_rows)
    rng = random.Random(5)
    pool = some_lines(rng, 120)
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 8)))) for i in range(40)]
    rows += [(40, None), (41, ""), (42, " \n\t\n"), (None, pool[0] + "\nnull id"), (43, "long " * 5000 + "\n" + pool[1])]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, k1 int, line string").repartition(4)
    found = judge_lines(docs).collect()
    wanted = brute(rows)
    assert {r.doc_id: set(r.removed) for r in found if r.removed} == wanted
    assert len(found) == len(rows) and all(r.n_removed == len(r.removed) for r in found)
    texts = {r.doc_id: r.text for r in without_repeated_lines(docs).collect()}
    for doc, text in rows:
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in wanted.get(doc, ()))
        assert texts[doc] == kept


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one line\none line"), (1, "one line\none line")], "doc_id long, text string")
    assert [r.removed for r in judge_lines(docs).collect()] == [[1], [1]]
    assert judge_lines(docs.limit(0)).count() == 0


def test_lines_that_clash_in_a_hash_are_told_apart(spark):
    from marketloom.llm.common import keyed
    from marketloom.llm.line_dedup import _identified

    first, second = "the quick brown ", "6Gt|hCNo@3)@hCmW"
    docs = spark.createDataFrame([(1, f"{first}\n{second}"), (2, second), (None, first)], "doc_id long, text string")
    found = {r.doc_id: (r.n_lines, r.removed) for r in judge_lines(docs).collect()}
    assert found == {1: (2, []), 2: (1, [0]), None: (1, [0])}
    lines, distinct = _identified(keyed(spark.createDataFrame([(i, f"line {i % 40}") for i in range(80)], "doc_id long, text string")), hash_bits=3)
    assert distinct.count() == distinct.select("id").distinct().count() == 40
    assert lines.count() == 80 and lines.join(distinct, ["id", "line"]).count() == 80

