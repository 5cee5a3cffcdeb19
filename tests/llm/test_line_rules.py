"""Line labelling: weak labels, training and decoding against plain Python."""

import random

import numpy as np
import pyarrow as pa

from poolbook.llm import line_rules

HEAD, TAIL = ["Home", "About us"], ["Terms of use", "All rights reserved."]


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def corpus(n=160, seed=3):
    """(id, text, good, line labels): good texts with and without head and tail lines,
    bad ones of symbols, some of them with a head."""
    rng, out = random.Random(seed), []
    for i in range(n):
        if i % 4 == 3:
            body = [" ".join(w + "$$$" for w in words(rng, 20).split()) for _ in range(4)]
        else:
            body = [words(rng, rng.randint(15, 40)).capitalize() + "." for _ in range(rng.randint(2, 6))]
        head, tail = (HEAD if i % 3 else []), (TAIL if i % 5 else [])
        out.append((i, "\n".join(head + body + tail), int(i % 4 != 3), [False] * len(head) + [i % 4 != 3] * len(body) + [False] * len(tail)))
    return out


def test_head_and_tail_lines_are_boilerplate(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:120]], "doc_id bigint, quality int")
    field = line_rules.train(docs, labels)
    got = {}
    for r in line_rules.line_labels(docs, field).orderBy("doc_id", "line").collect():
        got.setdefault(r["doc_id"], []).append(r["content"])
    held_out = [r for r in rows if r[0] >= 120]
    pairs = [(a, b) for r in held_out for a, b in zip(got[r[0]], r[3], strict=True)]
    assert {b for _, b in pairs} == {True, False}
    assert np.mean([a == b for a, b in pairs]) > 0.97
    mixed = [r for r in held_out if r[2] and len(set(r[3])) == 2]
    assert mixed and all(len(set(got[r[0]])) == 2 for r in mixed)
    kept = {r["doc_id"]: r["content_share"] >= line_rules.MIN_CONTENT for r in line_rules.judge(docs, field).collect()}
    assert all(kept[r[0]] == bool(r[2]) for r in held_out)


def test_shared_lines_against_brute_force(spark):
    rng = random.Random(8)
    texts = [r[1] for r in corpus(60, 5)] + [None, "", " \n\n", "Home"]
    long = words(rng, 30)
    # near copies of one text share its longest line: their short lines are no boilerplate
    texts += [f"{words(rng, 4)}\n{long}\nonly here" for _ in range(20)] + [f"one more line\n{long}"] * 3
    texts += ["\n".join(rng.choice(["a b", "c", "d d", "e f g h"]) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")

    def hashes(text):
        return line_rules.Lines(pa.array([text], pa.string())).hashes().tolist()

    bodies = {}
    for text in texts:
        own = hashes(text)
        lines = [x for x in (text or "").split("\n") if x.split()]
        for h in set(own):
            longest = min((-len(x.encode()), k) for x, k in zip(lines, own, strict=True))[1]
            bodies.setdefault(h, set()).add((longest, tuple(sorted(own))))
    want = {h for h, held in bodies.items() if len({b for b, _ in held}) >= line_rules.SPREAD and 2 * len({b for b, _ in held}) >= len(held)}
    got = line_rules.shared_lines(docs, np.unique(np.array(list(bodies), np.uint64)))
    assert set(got.tolist()) == want and hashes("Home")[0] in want and hashes("only here")[0] not in want
    assert not len(line_rules.shared_lines(docs.limit(0), got)) and not len(line_rules.shared_lines(docs, got[:0]))


def test_training_sample_is_bounded_by_lines(spark):
    docs = spark.createDataFrame([(1, "x y z\n" * 50), (2, "a b\nc"), (3, "d\ne\nf"), (4, None), (5, "g")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 6)], "doc_id bigint, quality int")
    features, document, good, hashes = line_rules.training_lines(docs, labels, lines=20)
    assert sorted(set(document.tolist())) == [2, 3, 5] and len(features) == len(good) == len(hashes) == 6
    features, document, good, hashes = line_rules.training_lines(docs, labels)
    assert np.bincount(document).tolist() == [0, 50, 2, 3, 0, 1]


def test_weak_labels():
    rng = np.random.default_rng(2)
    x = np.column_stack([np.ones(200), rng.normal(size=200) + np.repeat([2.0, -2.0], 100)])
    good, shared = np.repeat([True, False], 100), np.arange(200) % 10 == 0
    x[150:160, 1] = 3  # lines of bad documents that look like those of good ones
    got = line_rules.weak_labels(x, good, shared)
    assert not got[shared].any() and got[good & ~shared].all()
    assert got[150:160][~shared[150:160]].all() and got[160:].mean() < 0.2
    assert not line_rules.weak_labels(x, good & False, shared).any()


def test_gradient_against_differences():
    rng = np.random.default_rng(6)
    x, row = rng.normal(size=(12, 3)), np.array([0, 0, 0, 0, 2, 5, 5, 5, 5, 7, 7, 9])
    value = line_rules.Field.objective(x, row, rng.random(12) < 0.5)
    theta = rng.normal(size=7)
    _, gradient = value(theta)
    for k in range(7):
        step = np.eye(7)[k] * 1e-5
        assert abs((value(theta + step)[0] - value(theta - step)[0]) / 2e-5 - gradient[k]) < 1e-6


def test_training_climbs_to_the_maximum():
    rng = np.random.default_rng(7)
    x, row = np.column_stack([np.ones(300), rng.normal(size=(300, 2))]), np.repeat(np.arange(60), 5)
    gold = x[:, 1] + rng.normal(size=300) > 0
    field = line_rules.Field.train(x, row, gold)
    value = line_rules.Field.objective(x, row, gold)
    theta = np.concatenate([field.weights, field.moves.ravel()])
    assert np.abs(value(theta)[1]).max() < 1e-3
