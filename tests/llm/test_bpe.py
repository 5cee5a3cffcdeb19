"""Operator 12 against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest

from poolbook.llm import bpe, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def mine():
    return bpe.Vocabulary(bpe.default_vocabulary())


def texts():
    rnd = random.Random(11)
    pool = [chr(c) for c in [*range(0x300), *(rnd.randrange(0x110000) for _ in range(2000))] if not 0xD800 <= c < 0xE000]
    for _ in range(600):
        yield "".join(rnd.choice(pool) if rnd.random() < 0.4 else rnd.choice("  \n\t'strevmld 09ab") for _ in range(rnd.randrange(60)))
    yield from ["", " ", "<|endoftext|>", "<|endoftext|" + "<|endoftext|>" * 2 + "x", "a" * 30_000, " " * 5_000, "don't we'll 'S", "\x1c\x1d a\x85b ", "　 　x"]
    yield "".join(f"a{chr(c)}1{chr(c)}! {chr(c)}" for c in range(0x24F0, 0x3000))
    yield "".join(f"a{chr(c)}1{chr(c)}! {chr(c)}" for c in range(0x323A0, 0x323C0))  # letters newer than the library


def test_encode_and_decode_equal_the_library(mine, library):
    for text in texts():
        ids = np.frombuffer(mine.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:80]
        assert mine.decode(mine.encode(text)) == text


def test_blocks_and_small_caches_change_nothing(mine, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 40)
    monkeypatch.setattr(bpe, "MEMO", 5)
    text = ("one two  three\n\n four, five's <|endoftext|> six \t seven " * 40) + "x" * 200 + " end"
    assert np.frombuffer(mine.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert mine.decode(mine.encode(text)) == text


def test_decode_of_partial_and_unknown_ids(mine, library):
    for ids in ([222, 223, 224, 50256, 135], [60_000, 220, 247], list(range(188, 260))):
        assert mine.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_whole_table(spark, library):
    got = {r["doc_id"]: r for r in queries.op12_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids = library.encode(doc["text"] or "", add_special_tokens=False).ids
        row = got[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_repeats_clashing_columns_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "hi there", None)], "doc_id bigint, text string, ids string")
    out = bpe.decode(bpe.encode(rows)).orderBy("doc_id").collect()
    assert [(r["doc_id"], len(r["ids"]), r["decoded"]) for r in out] == [(None, 8, "hi there"), (1, 0, ""), (1, 0, "")]
    assert bpe.decode(bpe.encode(rows.limit(0))).count() == 0
    digest = bpe.digests(bpe.decode(bpe.encode(rows))).where("doc_id = 1").first()
    assert digest["n_tokens"] == 0 and digest["ids_sha256"] == hashlib.sha256().hexdigest()
