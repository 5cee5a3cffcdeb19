"""MinHash near-duplicates (operator 9): improved consistent weighted sampling.

Shingles are five consecutive words (lower-cased, ``[0-9a-z]`` and non-ASCII; a
text of fewer words is one shingle).  A shingle weighs tf x the mean idf of its
words, idf = 1 + ln((N + 1) / (df + 1)); df counts the documents of every hashed
word (``SLOTS`` slots, so the table has one size at any corpus size) over all
rows.  Word idf keeps the weights of a passage steady that thousands of copies
share; the idf of the shingle itself would make copies look less alike the more
of them there are.

1. Signatures: ``BANDS x ROWS`` samples per document by improved consistent
   weighted sampling.  The random variables of a (shingle, sample) come from a
   table that the shingle's hash picks, so equal shingles get equal draws
   everywhere.
2. Rows with equal word sequences are one text; its smallest id stands for it.
3. Texts that share a band are candidates.  Buckets of the same texts (told by
   their number, least and greatest node and 128 bits of hash) are looked at once.
   A band bucket of up to ``BLOCK`` texts is one task group; larger ones are cut
   into blocks by hash, and each pair of blocks is a group, so no task sees more
   than about two blocks.
4. In a group, pairs whose total weights allow the similarity (an exact bound)
   and that this group has not linked yet are verified by their exact weighted
   Jaccard similarity, those with most equal samples first.
   Verified pairs become links; a pair is left out only if links of the group
   already connect it.  So a group emits fewer links than it has texts, and
   no link between classes is lost.
5. Classes are the connected components of the links (alternating large-star
   and small-star steps on checkpointed edge tables); the class id is the
   smallest document id.

A pair of similarity 0.8 shares no band with a chance of about 1 in 600.  Nothing
is capped or sampled.

Defined results: a text without words (null, empty) is alone in its class;
repeated rows get the same class; rows that share an id but not the text are
classed one by one, each text as a node of its own; null ids stand for themselves as id null.  Further columns
of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from poolbook.llm.common import LOWER, STEP_BYTES, WORD, Words, bytes_of, chunks, mix, stored, word_hash

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 9, 3
#: Slots of the document-frequency table.
SLOTS = 1 << 18
#: Texts in one block of a large bucket.
BLOCK = 512
#: Entries per sample in the table of random variables.
DRAWS = 1 << 14
_SLICES = 64

SIGNATURES = "doc_id bigint, text_hash bigint, text_key binary, total float, signature binary, bands array<bigint>"


class Weighted:
    """The weighted shingles of some texts: row, hash and weight, by row and hash."""

    def __init__(self, texts: pa.Array, idf: np.ndarray):
        data, offsets = bytes_of(texts)
        data = LOWER[data]
        words = Words(data, offsets, WORD)
        self.count = words.count
        n = len(self.count)
        hashes = word_hash(data, words.start, words.end)
        value = idf[(hashes & np.uint64(SLOTS - 1)).astype(np.int64)]
        begin = np.cumsum(self.count) - self.count
        shingles = np.where(self.count > 0, np.maximum(self.count - SHINGLE + 1, 1), 0)
        row = np.repeat(np.arange(n), shingles)
        first = np.repeat(begin - (np.cumsum(shingles) - shingles), shingles) + np.arange(len(row))
        length = np.minimum(self.count, SHINGLE)[row]
        key, weight = np.zeros(len(row), np.uint64), np.zeros(len(row))
        with np.errstate(over="ignore"):
            for k in range(SHINGLE):
                at = np.minimum(first + k, len(hashes) - 1)
                on = k < length
                key = np.where(on, mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[at]) if len(row) else key, key)
                weight += np.where(on, value[at], 0) if len(row) else 0
        weight = weight / np.maximum(length, 1)
        # rows stay in order; within one, equal shingles add up
        order = np.lexsort((key, row))
        row, key, weight = row[order], key[order], weight[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
        at = np.flatnonzero(new)
        self.row, self.key = row[at], key[at]
        self.weight = np.add.reduceat(weight, at) if len(at) else weight
        self.total = np.bincount(self.row, weights=self.weight, minlength=n)
        self.bounds = np.searchsorted(self.row, np.arange(n + 1))
        self.data, self.words = data, words

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.bounds[i], self.bounds[i + 1])
        return self.key[part], self.weight[part]

    def text_keys(self) -> list[bytes]:
        """A digest of every row's word sequence."""
        at, end = 0, 0
        size = self.words.end - self.words.start
        begin = np.concatenate([[0], np.cumsum(size)])
        joined = self.words.text.buffers()[2]
        flat = memoryview(joined) if joined is not None else memoryview(b"")
        out = []
        for n in self.count.tolist():
            end = at + n
            h = hashlib.blake2b(flat[begin[at] : begin[end]], digest_size=16)
            h.update(size[at:end].astype("<u4").tobytes())
            out.append(h.digest())
            at = end
        return out


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two sorted sets of keys with their weights."""
    few, many = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    at = np.searchsorted(many[0], few[0])
    at[at == len(many[0])] = 0
    met = many[0][at] == few[0] if len(many[0]) else np.zeros(len(few[0]), bool)
    both = np.minimum(few[1][met], many[1][at[met]]).sum()
    union = a[1].sum() + b[1].sum() - both
    return float(both / union) if union else 0.0


def draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and beta of improved consistent weighted sampling, per sample."""
    rng = np.random.Generator(np.random.PCG64(20240229))
    shape = (BANDS * ROWS, DRAWS)
    r = rng.gamma(2.0, 1.0, shape).astype(np.float32)
    ln_c = np.log(rng.gamma(2.0, 1.0, shape)).astype(np.float32)
    return r, ln_c, rng.random(shape).astype(np.float32)


_MULTIPLIERS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
_table: list = []


def signatures(x: Weighted) -> np.ndarray:
    """One 64-bit sample per row and draw (0 where a row has no words)."""
    if not _table:
        _table.append(draws())
    r, ln_c, beta = _table[0]
    n = len(x.count)
    out = np.zeros((n, BANDS * ROWS), np.uint64)
    if not len(x.key):
        return out
    ln_w = np.log(x.weight).astype(np.float32)
    starts = x.bounds[:-1][x.bounds[:-1] < x.bounds[1:]]
    size = np.diff(np.append(starts, len(x.key)))
    filled = x.row[starts]
    with np.errstate(over="ignore"):
        for k in range(BANDS * ROWS):
            at = ((x.key * _MULTIPLIERS[k]) >> np.uint64(64 - 14)).astype(np.int64)
            rk, bk = r[k][at], beta[k][at]
            t = np.floor(ln_w / rk + bk)
            value = ln_c[k][at] - rk * (t - bk) - rk
            least = np.minimum.reduceat(value, starts)
            hit = np.flatnonzero(value == np.repeat(least, size))
            # ties share a draw; the smallest key among them is the sample
            sample = mix(x.key[hit] + np.uint64(0x9E3779B97F4A7C15) * (t[hit].astype(np.int64).astype(np.uint64) + np.uint64(k << 32)))
            slot = x.row[hit]
            new = np.ones(len(hit), bool)
            new[1:] = slot[1:] != slot[:-1]
            out[slot[new], k] = sample[new]
    assert len(filled) == len(starts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    with np.errstate(over="ignore"):
        key = np.zeros((len(signature), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
        for k in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, k::ROWS])
    return key.view(np.int64)


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task and how many of them hold each slot's words, in slices."""
    df, rows = np.zeros(SLOTS, np.int64), 0
    for batch in chunks(batches, "text", STEP_BYTES):
        data, offsets = bytes_of(batch.column("text"))
        data = LOWER[data]
        words = Words(data, offsets, WORD)
        slot = (word_hash(data, words.start, words.end) & np.uint64(SLOTS - 1)).astype(np.int64)
        once = pd.unique(words.row * SLOTS + slot)
        df += np.bincount(once % SLOTS, minlength=SLOTS)
        rows += batch.num_rows
    for k, part in enumerate(np.split(df, _SLICES)):
        yield pa.record_batch({"slice": pa.array([k], pa.int32()), "n": pa.array([rows], pa.int64()), "df": pa.array([part.astype("<i8").tobytes()], pa.binary())})


def word_idf(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """idf per slot over all rows.  Tasks count into one table each; the tables
    are added in slices."""

    def add(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sums what it meets; used before and after the shuffle."""
        total: dict[int, list] = {}
        for frame in rows:
            for k, n, part in zip(frame["slice"], frame["n"], frame["df"]):
                part = np.frombuffer(part, "<i8")
                if k in total:
                    total[k][0] += n
                    total[k][1] = total[k][1] + part
                else:
                    total[k] = [n, part]
        yield pd.DataFrame([(k, n, part.astype("<i8").tobytes()) for k, (n, part) in total.items()], columns=["slice", "n", "df"]).astype({"slice": "int32", "n": "int64"})

    kinds = "slice int, n bigint, df binary"
    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(count_words, kinds)
    summed = parts.repartition(_SLICES, "slice").mapInPandas(add, kinds).collect()
    df, n = np.zeros(SLOTS), 0
    for row in summed:
        width = SLOTS // _SLICES
        df[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(row["df"], "<i8")
        n = row["n"]
    return 1 + np.log((n + 1) / (df + 1))


def sign(docs: DataFrame, idf: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Signature of every row (``SIGNATURES``); no bands where there are no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", STEP_BYTES):
            x = Weighted(batch.column("text"), idf)
            samples = signatures(x)
            keys = band_keys(samples)
            yield pa.record_batch({
                "doc_id": batch.column("id"),
                "text_hash": batch.column("hash"),
                "text_key": pa.array(x.text_keys(), pa.binary()),
                "total": pa.array(x.total, pa.float32()),
                "signature": pa.array([s.astype("<u4").tobytes() for s in (samples >> np.uint64(32))], pa.binary()),
                "bands": pa.array([k.tolist() if n else [] for k, n in zip(keys, x.count)], pa.list_(pa.int64())),
            })

    return _slim(docs, id_col, text_col).withColumn("hash", F.xxhash64("text")).mapInArrow(run, SIGNATURES)


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text) with the key of their word sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", STEP_BYTES):
            keys = Weighted(batch.column("text"), np.ones(SLOTS)).text_keys()
            yield pa.record_batch({"id": batch.column("id"), "text": batch.column("text"), "text_key": pa.array(keys, pa.binary())})

    return rows.mapInArrow(run, "id bigint, text string, text_key binary")


class Forest:
    """Union-find over 0 .. n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.root(i)] = self.root(j)


def links_of(ids: np.ndarray, texts: pa.Array, sign_: np.ndarray, total: np.ndarray, side: np.ndarray, idf: np.ndarray) -> list[tuple[int, int]]:
    """Verified links among the texts of a group; between its two sides only,
    unless it has one."""
    n, x, forest, out = len(ids), Weighted(texts, idf), Forest(len(ids)), []
    both = side.min() != side.max()
    mine, other = (np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())) if both else (np.arange(n), np.arange(n))
    found = []
    for i in mine:
        js = other if both else other[i + 1 :]
        js = js[np.minimum(total[i], total[js]) >= SIMILARITY * 0.999 * np.maximum(total[i], total[js])]
        found.append(((sign_[js] == sign_[i]).sum(axis=1), np.full(len(js), i), js))
    agree, i, j = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int),) * 3
    for k in np.argsort(-agree, kind="stable"):
        a, b = int(i[k]), int(j[k])
        if forest.root(a) != forest.root(b) and weighted_jaccard(x.of(a), x.of(b)) >= SIMILARITY:
            forest.join(a, b)
            out.append((int(ids[a]), int(ids[b])))
    return out


def texts_of(docs: DataFrame, wanted: DataFrame, signed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``wanted`` texts (node, rep, text_key, ...) with one of their rows' text.  An id
    that stands on several texts does not tell which is meant: the rows of such ids
    (most often there are none) are told apart by their word sequence."""
    hashed = F.xxhash64("text_key")
    shared = stored(signed.groupBy(F.col("doc_id").alias("shared")).agg(F.min(hashed).alias("a"), F.max(hashed).alias("b"))
                    .filter("a <> b").select("shared"), "shared-ids")
    rows, columns = _slim(docs, id_col, text_col), [c for c in wanted.columns if c not in ("rep", "text_key")]
    if shared.isEmpty():
        return rows.join(wanted, F.col("id") == F.col("rep")).dropDuplicates(["node"]).select(*columns, "text")
    plain = wanted.join(shared, F.col("rep") == F.col("shared"), "left_anti")
    one = rows.join(plain, F.col("id") == F.col("rep")).dropDuplicates(["node"]).select(*columns, "text")
    several = keyed(rows.join(shared, F.col("id") == F.col("shared"), "left_semi")).withColumnRenamed("text_key", "own_key")
    told = several.join(wanted, (F.col("id") == F.col("rep")) & (F.col("own_key") == F.col("text_key")))
    return one.unionByName(told.dropDuplicates(["node"]).select(*columns, "text"))


def links(docs: DataFrame, reps: DataFrame, signed: DataFrame, idf: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified links (a, b) between the nodes of texts.

    reps: node, rep, text_key, total, signature, bands; stored, one row per text."""
    member = reps.select("node", F.explode("bands").alias("bucket"))
    # Buckets of several bands often hold the same texts; one of them does for all.
    mark = lambda k: F.xxhash64("node", F.lit(k))
    size = member.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("node").alias("least"), F.max("node").alias("most"),
        F.bit_xor(mark(1)).alias("mark1"), F.bit_xor(mark(2)).alias("mark2")).filter("n > 1")
    size = size.groupBy("n", "least", "most", "mark1", "mark2").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    blocks = F.ceil(F.col("n") / F.lit(float(BLOCK))).cast("int")
    cell = F.when(blocks <= 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(F.transform(
        F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j"))))
    placed = stored(member.join(size, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
                    .select("node", "bucket", "own", F.explode(cell).alias("cell")), "cells")
    # Texts that share a bucket, each once.
    wanted = placed.select("node").distinct().join(reps.select("node", "rep", "text_key", "total", "signature"), "node")
    rows = placed.join(stored(texts_of(docs, wanted, signed, id_col, text_col), "texts"), "node")

    def group(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        sign_ = np.stack([np.frombuffer(s, "<u4") for s in frame["signature"]])
        i, j = frame["i"].iloc[0], frame["j"].iloc[0]
        side = frame["own"].to_numpy() if i != j else np.zeros(len(frame), int)
        got = links_of(frame["node"].to_numpy(), pa.array(frame["text"], pa.large_string()), sign_, frame["total"].to_numpy(), side, idf)
        return pd.DataFrame(got, columns=["a", "b"]).astype("int64")

    return (rows.select("bucket", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), "own", "node", "total", "signature", "text")
            .groupBy("bucket", "i", "j").applyInPandas(group, "a bigint, b bigint"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's connected component.

    Alternates large-star and small-star steps until the edges are stars.
    Neighbour minima are aggregates, so a node with many edges is no hot key in
    memory; every round is a stored table."""
    def neighbours(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = neighbours(e)
        if not large:
            both = both.filter("v < u")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        linked = both.join(least, "u")
        moved = linked.filter("v > u") if large else linked
        out = moved.select(F.col("m").alias("a"), F.col("v").alias("b"))
        if not large:
            out = out.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
        return out.filter("a <> b").distinct()

    state = lambda e: tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
    now = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before, after = None, state(now)
    while before != after and after[0]:
        now = stored(star(star(now, True), False), "edges")
        before, after = after, state(now)
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _classed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their signature, texts with their class).  A text is a node of its own
    whatever ids it stands on; ``kept`` marks the one text of a class with the smallest
    (id, word sequence)."""
    idf = word_idf(docs, text_col)
    signed = stored(sign(docs, idf, id_col, text_col), "signatures")
    texts = signed.filter(F.size("bands") > 0).groupBy("text_key").agg(
        F.min("doc_id").alias("rep"), F.first("total").alias("total"), F.first("signature").alias("signature"), F.first("bands").alias("bands")
    ).filter("rep IS NOT NULL")
    reps = stored(texts.withColumn("node", F.monotonically_increasing_id()), "texts")
    root = components(links(docs, reps, signed, idf, id_col, text_col))
    linked = stored(reps.select("node", "rep", "text_key").join(root.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left")
                    .select("text_key", "rep", F.coalesce("root", "node").alias("root")), "rooted")
    least = linked.groupBy("root").agg(F.min(F.struct("rep", "text_key")).alias("least"))
    named = linked.join(least, "root").select("text_key", "rep", F.col("least.rep").alias("class"),
                                              (F.col("least.text_key") == F.col("text_key")).alias("kept"))
    return signed, named


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest id of the class),
    text_id (smallest id with the same word sequence)."""
    signed, named = _classed(docs, id_col, text_col)
    return signed.select("doc_id", "text_key", F.size("bands").alias("n")).join(named, "text_key", "left").select(
        "doc_id", F.coalesce(F.when(F.col("n") > 0, F.col("class")), F.col("doc_id")).alias("class_id"),
        F.coalesce(F.when(F.col("n") > 0, F.col("rep")), F.col("doc_id")).alias("text_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every class: that of the smallest id, and of that id the row whose
    text was compared.  Every text without words is a class; rows without an id stay;
    of several rows with equal id and text one stays."""
    signed, named = _classed(docs, id_col, text_col)
    rows = signed.select("doc_id", "text_hash", "text_key", (F.size("bands") > 0).alias("worded")).filter("doc_id IS NOT NULL")
    chosen = rows.filter("worded").join(named.filter("kept"), "text_key").filter("doc_id = rep").groupBy("doc_id", "text_key").agg(
        F.min("text_hash").alias("text_hash")).select("doc_id", "text_hash")
    chosen = chosen.unionByName(rows.filter("NOT worded").select("doc_id", "text_hash")).distinct().toDF("_kept", "_hash")
    mine = docs.filter(F.col(id_col).isNotNull()).withColumn("_own", F.xxhash64(text_col))
    mine = mine.join(chosen, (F.col(id_col) == F.col("_kept")) & (F.col("_own") == F.col("_hash")), "left_semi")
    again = W.partitionBy(id_col, "_own").orderBy(id_col)
    once = mine.withColumn("_again", F.row_number().over(again)).filter("_again = 1").select(*docs.columns)
    return once.unionByName(docs.filter(F.col(id_col).isNull()))
