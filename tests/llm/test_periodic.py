"""Operator 11 against a brute-force search for runs."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from poolbook.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def brute(words, min_length=6, exponent=4):
    """Every maximal stretch of every period, kept if no smaller period fits."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            smaller = any(all(words[t] == words[t + r] for t in range(i, i + size - r)) for r in range(1, q))
            if j > i and size >= max(min_length, exponent * q) and not smaller:
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_texts(rnd):
    for _ in range(rnd.randrange(1, 5)):
        n, kinds = rnd.randrange(80), rnd.choice([1, 2, 3, 5])
        words = [rnd.randrange(kinds) for _ in range(n)]
        if n and rnd.random() < 0.7:
            a, p = rnd.randrange(n), rnd.randrange(1, 12)
            words = [w if i < a else words[min(a + (i - a) % p, n - 1)] for i, w in enumerate(words)]
        yield words * rnd.choice([1, 1, 2])


@pytest.mark.parametrize("block", [3, 2048])
@pytest.mark.parametrize("limits", [(6, 4), (6, 3), (10, 5), (3, 3)])
def test_runs_of_equals_brute_force(block, limits, monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK", block)
    rnd = random.Random(block + limits[0])
    for _ in range(250):
        texts = list(random_texts(rnd))
        bounds = np.append(0, np.cumsum([len(t) for t in texts]))
        got = periodic.runs_of(np.array(sum(texts, []), np.int64), bounds, *limits)
        want = [(s + at, size, q) for t, at in zip(texts, bounds.tolist()) for s, size, q in brute(t, *limits)]
        assert got.tolist() == [list(r) for r in sorted(want, key=lambda r: (r[0], r[2]))]


def test_few_periods_are_refused():
    with pytest.raises(ValueError):
        periodic.runs_of(np.zeros(20, np.int64), np.array([0, 20]), 6, 2)


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    # stretches by each period in numpy, the smallest period of a stretch wins
    codes, runs, seen = np.array([numbers[w] for w in words], np.int64), [], set()
    for q in range(1, n // 4 + 1):
        same = np.concatenate(([0], (codes[:-q] == codes[q:]).astype(np.int8), [0]))
        begin, stop = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for s, e in zip(begin.tolist(), stop.tolist()):
            size = e - s + q
            if size >= max(6, 4 * q) and (s, size) not in seen:
                seen.add((s, size))
                runs.append((s, size, q))
    runs.sort(key=lambda r: (r[0], r[2]))
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return {
        "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
        "exponent_milli": None if best[0] is None else 1000 * best[1] // best[2],
        "runs_sha256": hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    }


def test_whole_table_against_brute_force(spark):
    got = {r["doc_id"]: r.asDict() for r in queries.op11_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    assert any(r["n_runs"] for r in got.values())
    for doc in docs:
        assert got[doc["doc_id"]] == {"doc_id": doc["doc_id"], **expected(doc["doc_id"], doc["text"])}


def test_edges(spark):
    wide = "a b c " * 8 + "\x0b\x0c\r\n\tz"
    rows = [(None, "x " * 9), (None, None), (7, ""), (7, ""), (8, wide), (9, "k " * 50_000), (10, " \n ")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, runs int")
    out = periodic.digests(periodic.find_runs(periodic.planted(docs))).collect()
    key = lambda r: (r["doc_id"] is not None, r["doc_id"], r["n_runs"])
    want = sorted(({"doc_id": d, **expected(d, t)} for d, t in rows), key=key)
    assert sorted((r.asDict() for r in out), key=key) == want
    found = periodic.find_runs(docs).where("doc_id is null and n_words > 0").first()
    assert found["collapsed"] == "x" and found["runs"][0].asDict() == {"start": 0, "length": 9, "period": 1}
    assert periodic.digests(periodic.find_runs(docs.limit(0))).count() == 0
