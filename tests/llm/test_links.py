"""Links inside a group of near-duplicate candidates against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from poolbook.llm import neardup


def parts(n, pairs):
    forest = neardup.Forest(n)
    for a, b in pairs:
        forest.join(a, b)
    return {frozenset(j for j in range(n) if forest.root(j) == forest.root(i)) for i in range(n)}


@pytest.mark.parametrize("two_sides", [False, True])
def test_links_connect_what_all_pairs_connect(two_sides):
    rng, idf = random.Random(1), np.ones(neardup.SLOTS)
    for _ in range(30):
        bases = [[rng.choice("abcdefghijklmnop") for _ in range(40)] for _ in range(rng.choice([1, 1, 3]))]
        texts = []
        for _ in range(rng.randint(2, 14)):
            words = list(rng.choice(bases))
            if rng.random() < 0.6:
                words[rng.choice([0, 20, 39])] = rng.choice("xyz")
            texts.append(" ".join(words))
        column, n = pa.array(texts, pa.large_string()), len(texts)
        x = neardup.Weighted(column, idf)
        samples = (neardup.signatures(x) >> np.uint64(32)).astype("<u4")
        side = np.array([k % 2 * two_sides for k in range(n)])
        got = neardup.links_of(np.arange(n), column, samples, x.total, side, idf)
        want = [(a, b) for a in range(n) for b in range(a + 1, n)
                if (not two_sides or side[a] != side[b]) and neardup.weighted_jaccard(x.of(a), x.of(b)) >= neardup.SIMILARITY]
        assert parts(n, got) == parts(n, want) and len(got) <= n - 1


def test_classes_are_those_of_all_pairs(spark):
    """Groups of two, three and many near copies; buckets of the same texts are looked at once."""
    rng = random.Random(7)
    rows, next_id = [], 0
    for size in (1, 1, 2, 2, 3, 8, 40):
        base = [f"w{rng.randrange(400)}" for _ in range(150)]
        for _ in range(size):
            words = list(base)
            for at in rng.sample(range(150), rng.choice([0, 0, 1, 1, 2, 4])):
                words[at] = f"x{rng.randrange(400)}"
            rows.append((next_id, " ".join(words)))
            next_id += 1
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    x = neardup.Weighted(pa.array([t for _, t in rows], pa.large_string()), neardup.word_idf(docs))
    n = len(rows)
    like = [[neardup.weighted_jaccard(x.of(a), x.of(b)) for b in range(n)] for a in range(n)]
    want = parts(n, [(a, b) for a in range(n) for b in range(a) if like[a][b] >= neardup.SIMILARITY])
    found: dict[int, set[int]] = {}
    for r in neardup.classes(docs).collect():
        found.setdefault(r["class_id"], set()).add(r["doc_id"])
    assert {frozenset(c) for c in found.values()} == want
