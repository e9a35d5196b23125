import random
import re
from hashlib import sha256

import pytest

from marketloom.llm.exact_dedup import exact_groups


def brute(rows):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(t, []).append(i)
    out = []
    for i, t in enumerate(texts):
        order = sorted(groups[t], key=lambda j: (rows[j][0] is None, rows[j][0] or 0, j))
        keep = rows[order[0]][0]
        out.append((rows[i][0], keep, len(order), sha256(t.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("block", [3, 7, 4096])
@pytest.mark.parametrize("bits", [64, 3])
def test_equals_brute_force(spark, block, bits):
    rng = random.Random(block)
    base = ["".join(rng.choice("ab é\n") for _ in range(rng.randrange(0, 40))) for _ in range(25)]
    rows = [(i, rng.choice(base)) for i in range(90)] + [(90, None), (91, ""), (None, base[0]), (None, "only"), (92, "a" * 9000), (93, "a" * 9000), (5, base[1]), (5, base[1])]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, row int, name int").repartition(4)
    found = exact_groups(docs, block, bits).collect()
    assert sorted(map(str, ((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found))) == sorted(map(str, brute(rows)))
    assert sum(r.kept for r in found) == len({r.text_sha256 for r in found})
    assert all(r.kept is False or r.doc_id == r.keep_id for r in found)


def test_an_empty_table_gives_nothing(spark):
    assert exact_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
