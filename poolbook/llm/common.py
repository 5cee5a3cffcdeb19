"""Helpers shared by the operators: table reader, stored intermediates, and
vectorised word splitting over Arrow string buffers.

The word splitters work on UTF-8 bytes.  Separators are ASCII only, so cutting
at them can never split a code point.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from poolbook.session import checkpoint_dir

#: Bytes of text that one vectorised step inside a task works on.
CHUNK_BYTES = 8 << 20
#: The same where a step holds arrays of several numbers per byte or line (hashes,
#: sums, features): these take up to 40 bytes for every byte of text, in every worker.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``; the Parquet form allows column
    pruning when several later steps read parts of it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_class(keep) -> np.ndarray:
    """Boolean table over the 256 byte values."""
    return np.array([keep(b) for b in range(256)])


#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z.
WORD = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: Bytes of ``[^\x20\x09-\x0D]``.
DARK = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, done + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end
    pa.default_memory_pool().release_unused()  # the worker outlives the task


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(off) or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]], off - off[0]


class Words:
    """The words of a string column: ``text`` (Arrow strings), ``row`` (row of
    each word), ``start``/``end`` (byte span in the chunk) and ``count`` per row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, keep: np.ndarray, kind: np.ndarray | None = None, single: int = -1):
        """keep: the bytes of words.  kind: byte classes; words are also cut
        between two bytes of different classes, or both of class ``single``
        (class 0 never cuts)."""
        n = len(offsets) - 1
        on = keep[data]
        first = on.copy()
        first[1:] &= ~on[:-1]
        if kind is not None and len(data):
            k = kind[data]
            cut = on[1:] & on[:-1] & (k[1:] > 0) & (k[:-1] > 0) & ((k[1:] != k[:-1]) | (k[1:] == single))
            first[1:] |= cut
        rows = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[rows] = on[rows]
        self.start = np.flatnonzero(first)
        last = on.copy()
        last[:-1] &= ~on[1:]
        if kind is not None and len(data):
            last[:-1] |= cut
        ends = rows[1:] - 1
        last[ends] = on[ends]
        self.end = np.flatnonzero(last) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        self.count = np.bincount(self.row, minlength=n)
        size = np.zeros(len(self.start) + 1, np.int64)
        np.cumsum(self.end - self.start, out=size[1:])
        self.text = pa.LargeStringArray.from_buffers(len(self.start), pa.py_buffer(size), pa.py_buffer(data[on]))


def lower_words(texts: pa.Array) -> Words:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    data, offsets = bytes_of(texts)
    return Words(LOWER[data], offsets, WORD)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BASE = 0xA24BAED4963EE407


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.ones(max(n, 1), np.uint64)
    done, step = 1, np.uint64(base)
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step
        done += more
        step = step * step
    return out[:n]


def word_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span: a polynomial in an odd base, so that the
    hash of a span comes from two prefix sums."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data] * _powers(_BASE, len(data)), out=total[1:])
        shift = _powers(pow(_BASE, -1, 1 << 64), len(data))
        return mix((total[end] - total[start]) * shift[start] + (end - start).astype(np.uint64))
