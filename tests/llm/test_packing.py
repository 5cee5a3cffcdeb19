"""Packing: ids against the tokenizer itself, plans against plain best fit, edges."""

import functools
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from poolbook.llm import packing as P

TEXTS = [
    "Hello, world!  It's fine—don't they'll we've I'M 42 x2y3 a.b.c 3.14159",
    "", None, "   \t\n ", "é Éclair İstanbul ẛ̣ Straße ΣΣ  nbsp em ls",
    "don''t !'s 's' x'.y '.' a̸< ≮ ≠b", "<|endoftext|> mid<|startoftext|>dle", "<|ENDOFTEXT|>", "< |endoftext|>",
    "你好 world ٠١ 12 \U0001f600ok", "a_b__c--d//e\x00f\x1cg\x7fh", "….… x…y",
]


@functools.cache
def tokenizer(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def reference(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizer():
    path = P.default_vocabulary()
    rng = random.Random(5)
    pool = "abzAZ09 .,'!?-_<|>éÉß́一 \n\t…٠"
    texts = TEXTS + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    plain = [t for t in texts if "<|" not in (t or "")]
    for some in (texts, plain):
        ids, count = P.Encoder(path).ids(pa.array(some, pa.string()))
        at = 0
        for text, n in zip(some, count.tolist()):
            assert ids[at : at + n].tolist() == reference(path, text), text
            at += n


def place(lengths, rows):
    seen, sequences = Counter(), {}
    for x in lengths:
        k = seen[x]
        seen[x] += 1
        _, first, each, sequence, offset = [r for r in rows if r[0] == x and r[1] <= k][-1]
        inner = k - first
        sequences.setdefault(int(sequence + inner // each), []).append((int(offset + inner % each * x), x))
    return sequences


def plain_best_fit(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= x]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - x)
        else:
            rooms.append(capacity - x)
    return len(rooms)


@pytest.mark.parametrize("seed", range(60))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 10, 20, 50, 100])
    hot = rng.randint(1, capacity)
    lengths = [rng.choice([rng.randint(1, capacity), rng.randint(1, capacity), hot]) for _ in range(rng.randint(0, 80))]
    sequences = place(lengths, P.plan(Counter(lengths), capacity))
    assert sum(len(s) for s in sequences.values()) == len(lengths)
    for content in sequences.values():
        at = 0
        for offset, x in sorted(content):
            assert offset == at
            at += x
        assert at <= capacity
    plain = plain_best_fit(lengths, capacity)
    assert len(sequences) <= plain
    assert sum(n for _, n in P.best_fit(Counter(lengths), capacity)) == plain


def least(lengths, capacity):
    """Fewest sequences, by trying everything."""
    best = [len(lengths)]

    def go(rest, rooms):
        if len(rooms) >= best[0]:
            return
        if not rest:
            best[0] = len(rooms)
            return
        for i in sorted({r: i for i, r in enumerate(rooms) if r >= rest[0]}.values()):
            go(rest[1:], rooms[:i] + [rooms[i] - rest[0]] + rooms[i + 1 :])
        go(rest[1:], rooms + [capacity - rest[0]])

    go(sorted(lengths, reverse=True), [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_fixed_sets_keep_an_optimum(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(2, 20) for _ in range(rng.randint(1, 10))]
    fixed, left = P.reduce_counts(Counter(lengths), 20)
    rest = [s for s, n in left.items() for _ in range(n)]
    assert sum(n for _, n in fixed) + least(rest, 20) == least(lengths, 20)


def test_query_rows(spark):
    long = "word " * 5000
    rows = [(1, "a b"), (2, None), (3, ""), (4, long), (5, "a b"), (5, "a b"), (None, "x")]
    docs = spark.createDataFrame([(i, t, "clash", 7) for i, t in rows], "doc_id bigint, text string, id string, length int")
    out = P.pack_documents(docs).toPandas()
    path = P.default_vocabulary()
    expected = []
    for i, t in rows:
        ids = np.array([*reference(path, t), 1], "<u4")
        for p, s in enumerate(range(0, len(ids), 4096)):
            expected.append((-1 if i is None else i, p, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())))
    got = out.fillna({"doc_id": -1})[["doc_id", "piece", "start", "length", "ids_crc32"]].astype("int64")
    assert sorted(got.itertuples(index=False, name=None)) == sorted(expected)
    for _, s in out.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == (s["length"].cumsum() - s["length"]).tolist() and s["length"].sum() <= 4096
    assert P.pack_documents(docs.limit(0)).count() == 0
