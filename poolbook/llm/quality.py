"""Quality classifier (operator 1): random indexing, pooling, a small network.

1. Random indexing.  Tokens are runs of letters, of digits and of punctuation.
   Every token type (hashed to ``TYPES`` slots) has a sparse random index vector
   with ``NONZERO`` entries of +-1; its word vector is the sum of the index
   vectors of the tokens up to ``REACH`` places away, over all rows of the
   corpus.  Tasks add up integers in one table each, so the sums do not depend
   on how rows are split.
2. Pooling.  A document is the mean of its tokens' unit word vectors, frequent
   types weighing less, the mean of its index vectors, and five rates of its
   token stream (how often types repeat, length, share of punctuation, of
   upper case, of equal neighbours).  Pooled rows are written once.
3. A two-layer numpy network on standardised rows, fitted to at most ``SAMPLE``
   labelled rows that are not held out (those with the smallest hash of their
   id); a fifth of them only sets the temperature that calibrates the
   probabilities.

Defined results: null or empty text pools to zeros and gets a score like any
other; without labels of both classes every score is 0.5; repeated rows get
equal scores; repeated labels of an id count once (the lowest).  A null id is
not held out.  lang, source, doc_id and further columns are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolbook.llm.common import DARK, Words, bytes_of, chunks, mix, stored, word_hash

TYPES, WIDTH, NONZERO, REACH = 1 << 15, 48, 2, 2
SAMPLE = 20_000
HIDDEN, EPOCHS, RATE, DECAY = 24, 40, 0.01, 1e-4
THRESHOLD = 0.7
_SLICES = 64
RATES = 5

#: letter (also every byte of a longer code point), digit, punctuation
KIND = np.ones(256, np.uint8)
for _b in range(0x80):
    KIND[_b] = 1 if chr(_b).isalpha() else 2 if chr(_b).isdigit() else 3


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of the nonzero entries of every type's index vector."""
    seed = mix(np.arange(1, TYPES * NONZERO + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(TYPES, NONZERO)
    return (seed % np.uint64(WIDTH)).astype(np.int64), np.where(seed >> np.uint64(63), 1, -1).astype(np.int64)


class Tokens:
    """Type, row and kind of every token of a string column."""

    def __init__(self, texts: pa.Array):
        data, offsets = bytes_of(texts)
        words = Words(data, offsets, DARK, KIND)
        self.type = (word_hash(data, words.start, words.end) & np.uint64(TYPES - 1)).astype(np.int64)
        self.row, self.count = words.row, words.count
        self.kind = KIND[data[words.start]]
        self.upper = (data[words.end - 1] >= 0x41) & (data[words.end - 1] <= 0x5A)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """TYPES rows of WIDTH sums and the type's frequency, over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        total = np.zeros(TYPES * WIDTH, np.int64)
        often = np.zeros(TYPES, np.int64)
        for batch in chunks(batches, "text", 4 << 20):
            t = Tokens(batch.column("text"))
            often += np.bincount(t.type, minlength=TYPES)
            for gap in range(1, REACH + 1):
                near = t.row[:-gap] == t.row[gap:] if len(t.row) > gap else np.zeros(0, bool)
                left, right = t.type[: len(near)][near], t.type[gap:][near]
                for a, b in ((left, right), (right, left)):
                    for k in range(NONZERO):
                        total += np.bincount(a * WIDTH + place[b, k], weights=sign[b, k], minlength=len(total)).astype(np.int64)
        table = np.column_stack([total.reshape(TYPES, WIDTH), often])
        for k, part in enumerate(np.split(table, _SLICES)):
            yield pa.record_batch({"slice": pa.array([k], pa.int32()), "sums": pa.array([part.astype("<i8").tobytes()], pa.binary())})

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for frame in frames:
            for k, part in zip(frame["slice"], frame["sums"]):
                part = np.frombuffer(part, "<i8")
                total[k] = total[k] + part if k in total else part
        yield pd.DataFrame([(k, p.tobytes()) for k, p in total.items()], columns=["slice", "sums"]).astype({"slice": "int32"})

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "slice int, sums binary")
    out = np.zeros((_SLICES, TYPES // _SLICES, WIDTH + 1), np.int64)
    for row in parts.repartition(_SLICES, "slice").mapInPandas(add, "slice int, sums binary").toLocalIterator():
        out[row["slice"]] = np.frombuffer(row["sums"], "<i8").reshape(-1, WIDTH + 1)
    return out.reshape(TYPES, WIDTH + 1)


def pool(docs: DataFrame, table: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the pooled row (float32, binary) of every document."""
    sums, often = table[:, :WIDTH].astype(np.float64), table[:, WIDTH]
    unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    share = often / max(often.sum(), 1)
    place, sign = index_vectors()
    own = np.zeros((TYPES, WIDTH))
    for k in range(NONZERO):
        np.add.at(own, (np.arange(TYPES), place[:, k]), sign[:, k])
    both = np.hstack([unit * (1e-3 / (1e-3 + share))[:, None], own]).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1 << 20):
            t = Tokens(batch.column("text"))
            n, size = batch.num_rows, np.maximum(t.count, 1)
            # distinct types of each row with their counts, then a weighted sum
            key, times = np.unique(t.row * TYPES + t.type, return_counts=True)
            row, kind = key // TYPES, key % TYPES
            out = np.zeros((n, 2 * WIDTH + RATES), np.float64)
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            if len(starts):
                out[row[starts], : 2 * WIDTH] = np.add.reduceat(both[kind] * times[:, None].astype(np.float32), starts, axis=0)
            out[:, : 2 * WIDTH] /= size[:, None]
            per = lambda on, at: np.bincount(at, weights=on, minlength=n)
            same = (t.row[1:] == t.row[:-1]) & (t.type[1:] == t.type[:-1])
            out[:, -5] = per(times**2.0, row) / size**2.0
            out[:, -4] = np.log1p(t.count)
            out[:, -3] = per(t.kind == 3, t.row) / size
            out[:, -2] = per(t.upper, t.row) / size
            out[:, -1] = per(same, t.row[1:]) / size
            yield pa.record_batch({"doc_id": batch.column("id"), "pooled": pa.array([r.tobytes() for r in out.astype("<f4")], pa.binary())})

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, pooled binary")


class Network:
    """tanh layer, then one logit; ``temperature`` divides the logit."""

    def __init__(self, centre, scale, w1, b1, w2, b2, temperature):
        self.centre, self.scale, self.w1, self.b1, self.w2, self.b2, self.temperature = centre, scale, w1, b1, w2, b2, temperature

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -35, 35)))

    @classmethod
    def constant(cls, width: int) -> Network:
        return cls(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), 0.0, 1.0)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Network:
        """Adam on the log loss; every fifth row is for the temperature."""
        if len(np.unique(y)) < 2:
            return cls.constant(x.shape[1])
        check = np.arange(len(y)) % 5 == 4
        if len(np.unique(y[~check])) < 2:
            check[:] = False
        rng = np.random.Generator(np.random.PCG64(7))
        net = cls.constant(x.shape[1])
        net.centre, net.scale = x[~check].mean(axis=0), x[~check].std(axis=0) + 1e-6
        net.w1, net.b1 = rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN)
        net.w2, net.b2 = rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0
        z, target = (x[~check] - net.centre) / net.scale, y[~check].astype(float)
        moments = [[0.0, 0.0] for _ in range(4)]
        step = 0
        for _ in range(EPOCHS):
            for part in np.array_split(rng.permutation(len(z)), max(1, len(z) // 128)):
                h = np.tanh(z[part] @ net.w1 + net.b1)
                off = (1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -35, 35))) - target[part]) / len(part)
                back = off[:, None] * net.w2 * (1 - h**2)
                slopes = [z[part].T @ back + DECAY * net.w1, back.sum(axis=0), h.T @ off + DECAY * net.w2, off.sum()]
                step += 1
                for name, m, g in zip(("w1", "b1", "w2", "b2"), moments, slopes):
                    m[0], m[1] = 0.9 * m[0] + 0.1 * g, 0.999 * m[1] + 0.001 * g**2
                    setattr(net, name, getattr(net, name) - RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8))
        if check.any():
            net.temperature = calibrate(net.logits(x[check]), y[check].astype(float))
        return net


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section on its logarithm."""
    loss = lambda u: np.mean(np.logaddexp(0, logits * np.exp(-u)) - y * logits * np.exp(-u))
    low, high, cut = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - cut * (high - low), low + cut * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(pooled: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> Network:
    """Fit to at most ``sample`` labelled rows that are not held out."""
    chosen = (labels.filter(~held_out(id_col)).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("gold")).dropna()
              .groupBy("doc_id").agg(F.min("gold").alias("gold")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = pooled.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").select("pooled", "gold").toPandas()
    if rows.empty:
        return Network.constant(2 * WIDTH + RATES)
    return Network.fit(np.stack([np.frombuffer(p, "<f4") for p in rows["pooled"]]).astype(float), rows["gold"].to_numpy() == 1)


def score(pooled: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack([np.frombuffer(p, "<f4") for p in batch.column("pooled").to_pylist()]).astype(float)
                s = net.scores(x)
                yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(s), "predicted": pa.array((s >= threshold).astype(np.int32))})

    scored = pooled.select("doc_id", "pooled").mapInArrow(run, "doc_id bigint, score double, predicted int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    pooled = stored(pool(docs, word_vectors(docs, text_col), id_col, text_col), "pooled")
    return score(pooled, train(pooled, labels))
