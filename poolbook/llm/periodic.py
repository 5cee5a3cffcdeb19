"""Periodic runs of words (operator 11): maximal pairs from LCP intervals.

A run is a stretch of words that repeats with its smallest period q, holds at
least ``max(MIN_LENGTH, MIN_EXPONENT * q)`` words, and that no neighbouring word
extends.  Its start s and s + q are a maximal pair: the words from both on agree
for exactly length - q words (right-maximal) and the words before them differ
(left-maximal).  Conversely a maximal pair at distance q whose common length is
at least (MIN_EXPONENT - 1) * q is a run from end to end; nothing is extended.

All texts of a chunk are handled together in numpy:

1. Prefix doubling on exact word numbers orders the positions of every text; only
   positions that are still tied are sorted again.  The names of every doubling
   give the common length (LCP) of neighbours.
2. Positions fall into groups that share the shortest prefix a run can have
   (5 words).  A group is left out if its two nearest positions are further apart
   than its largest LCP allows.
3. In the others, LCP intervals are closed bottom-up.  An interval of depth d
   keeps its positions in order, each with its left-word class.  When the child
   lists of an interval are joined (small into large) each new pair of neighbours
   has an LCP of exactly d.  Of the positions that follow one within
   d / (MIN_EXPONENT - 1) words, all belong to one class: they lie in one periodic
   stretch and are preceded by the same word.  So the nearest stands for its whole
   class list: it is compared, farther ones would give multiples of the period.
   Every position is moved O(log n) times.

The work on a text of n words is O(n log^2 n) whatever repeats in it.  Rows are
handled where they lie: no shuffle, no collect; a lost task is run again.  Memory
is that of one chunk of about ``CHUNK`` bytes of text or of one longer text.

Defined results: null and empty texts have no words and no runs and collapse to
the empty text; repeated rows and ids give a row each; an empty table gives no
rows.  Only the two named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolbook.llm.common import DARK, Words, bytes_of, chunks

MIN_LENGTH = 6
MIN_EXPONENT = 4
CHUNK = 4 << 20
#: Positions that one block of an ordered list holds at most.
BLOCK = 2048
#: Regular expression of a word.
WORD = r"[^\x20\x09-\x0D]+"

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def least_depth(min_length: int, min_exponent: int) -> int:
    """The shortest common length that the pair of a run can have."""
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1))


def order_positions(group: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions ordered by the words from them to the end of their text, and the
    names of the stretches of 1, 2, 4, ... words from each position.

    ``group``: a number per (text, word); ``end``: where the position's text ends.
    A name is the place of the first position of that name in the order."""
    n = len(group)
    order = np.argsort(group, kind="stable")
    name = np.empty(n, np.int64)
    new = np.ones(n, bool)
    new[1:] = group[order][1:] != group[order][:-1]
    name[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    names, step = [name.astype(np.int32)], 1
    while True:
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = np.flatnonzero(tied)  # places whose position is not alone yet
        if not len(slots):
            return order, names
        at = order[slots]
        beyond = at + step
        second = np.where(beyond < end[at], name[np.minimum(beyond, n - 1)] + 1, 0)
        key = name[at] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[slots] = at
        fresh = np.ones(len(slots), bool)
        fresh[1:] = key[1:] != key[:-1]
        new[slots] = fresh
        name[at] = slots[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        names.append(name.astype(np.int32))
        step *= 2


def common_lengths(a: np.ndarray, b: np.ndarray, end: np.ndarray, names: list[np.ndarray]) -> np.ndarray:
    """Number of words that agree from positions ``a`` and ``b`` of one text on."""
    a, b = a.copy(), b.copy()
    stop, length, last = end[a], np.zeros(len(a), np.int64), len(end) - 1
    for level in range(len(names) - 1, -1, -1):
        name = names[level]
        same = (a < stop) & (b < stop) & (name[np.minimum(a, last)] == name[np.minimum(b, last)])
        length[same] += 1 << level
        a[same] += 1 << level
        b[same] += 1 << level
    return length


class Places:
    """Ordered positions, in blocks, so that adding one moves few others."""

    __slots__ = ("blocks", "heads", "size")

    def __init__(self, position: int):
        self.blocks, self.heads, self.size = [[position]], [position], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, position: int) -> tuple[int, int]:
        """Add a position; returns its neighbours (-1: none)."""
        b = bisect_left(self.heads, position) - 1
        before = self.blocks[b][-1] if b >= 0 else -1
        block = self.blocks[max(b, 0)]
        i = bisect_left(block, position)
        if i:
            before = block[i - 1]
        if i < len(block):
            after = block[i]
        else:
            after = self.heads[b + 1] if b + 1 < len(self.heads) else -1
        block.insert(i, position)
        if b < 0:
            b = 0
            self.heads[0] = position
        if len(block) > BLOCK:
            half = len(block) // 2
            self.blocks.insert(b + 1, block[half:])
            self.heads.insert(b + 1, block[half])
            del block[half:]
        self.size += 1
        return before, after


def close_intervals(positions: list[int], lcps: list[int], left: np.ndarray, spread: int) -> Iterator[tuple[int, int, int]]:
    """Runs (start, length, period) of one group: its positions in suffix order,
    ``lcps[i]`` the common length of positions i - 1 and i, ``left`` the class of
    the word before a position, ``spread`` = MIN_EXPONENT - 1."""
    found: list[tuple[int, int, int]] = []

    def join(one: Places, other: Places, depth: int) -> Places:
        large, small = (one, other) if one.size >= other.size else (other, one)
        farthest, last, then = depth // spread, -1, -1
        for x in small:
            before, after = large.add(x)
            if before != last:  # else: neighbours from the same child
                if then >= 0 and then - last <= farthest and left[then] != left[last]:
                    found.append((last, depth + then - last, then - last))
                if before >= 0 and x - before <= farthest and left[before] != left[x]:
                    found.append((before, depth + x - before, x - before))
            last, then = x, after
        if then >= 0 and then - last <= farthest and left[then] != left[last]:
            found.append((last, depth + then - last, then - last))
        return large

    open_: list[tuple[int, Places]] = []
    current = Places(positions[0])
    for position, lcp in zip(positions[1:], lcps[1:]):
        while open_ and open_[-1][0] > lcp:
            depth, part = open_.pop()
            current = join(part, current, depth)
        if open_ and open_[-1][0] == lcp:
            current = join(open_.pop()[1], current, lcp)
        open_.append((lcp, current))
        current = Places(position)
    while open_:
        depth, part = open_.pop()
        current = join(part, current, depth)
    return iter(found)


def runs_of(words: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period), sorted by start and period, of all texts of a
    chunk.  ``words``: word numbers; ``bounds``: where each text begins, and the end;
    starts count from the chunk's first word."""
    if min_exponent < 3:
        raise ValueError("runs of fewer than three periods are not maximal pairs of one class")
    n, none = len(words), np.zeros((0, 3), np.int64)
    least = least_depth(min_length, min_exponent)
    if n <= least:
        return none
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    end = bounds[1:][row]
    order, names = order_positions(row * (int(words.max()) + 1) + words, end)
    level = min(least.bit_length() - 1, len(names) - 1)
    tied = names[level][order]
    pair = np.flatnonzero(tied[1:] == tied[:-1])
    lcp = np.zeros(n, np.int64)
    lcp[pair + 1] = common_lengths(order[pair], order[pair + 1], end, names)
    del names
    deep = lcp >= least
    member = deep.copy()
    member[:-1] |= deep[1:]
    slots = np.flatnonzero(member)
    if not len(slots):
        return none
    first = np.flatnonzero(~deep[slots])
    place, depth = order[slots], np.where(deep[slots], lcp[slots], 0)
    size = np.diff(np.append(first, len(slots)))
    group = np.repeat(np.arange(len(first)), size)
    by = np.lexsort((place, group))
    gap = np.full(len(slots), n, np.int64)
    gap[1:][group[1:] == group[:-1]] = np.diff(place[by])[group[1:] == group[:-1]]
    near = np.minimum.reduceat(gap, first) <= np.maximum.reduceat(depth, first) // (min_exponent - 1)
    left = np.full(n, -1, np.int64)
    left[1:] = words[:-1]
    left[bounds[:-1][np.diff(bounds) > 0]] = -1
    out = []
    classes = left.tolist()
    for g in np.flatnonzero(near):
        part = slice(first[g], first[g] + size[g])
        out += [r for r in close_intervals(place[part].tolist(), depth[part].tolist(), classes, min_exponent - 1) if r[1] >= min_length]
    return np.array(sorted(out, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (start, length, period; by start,
    then period) and collapsed: the words left when of every run only the first
    period stays, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK):
            data, offsets = bytes_of(batch.column("text"))
            words = Words(data, offsets, DARK)
            bounds = np.append(0, np.cumsum(words.count))
            numbers = words.text.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            start, length, period = found = runs_of(numbers, bounds, min_length, min_exponent).T
            change = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, start + length, -1)
            keep = np.cumsum(change)[:-1] == 0
            kept = np.append(0, np.cumsum(keep))[bounds]
            left = words.text.filter(pa.array(keep)).cast(pa.string())
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), left), " ")
            row = np.searchsorted(bounds, start, side="right") - 1
            inner = pa.StructArray.from_arrays([pa.array(start - bounds[row]), *(pa.array(x) for x in found[1:])], names=["start", "length", "period"])
            runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(start, bounds), pa.int32()), inner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words.count.astype(np.int64)), runs, texts],
                names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words bigint, runs {RUNS}, collapsed string")


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` in which a tenth of the texts is periodic from some word on: with
    h = crc32 of the id as text and g = h // 10, where h % 10 = 0 and there are
    n > 0 words, word i >= a = g % n becomes word a + (i - a) % p with
    p = 1 + (n - a) // (3 + g % 8).  Other texts, and rows without an id, stay."""
    words = F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0))
    h = F.crc32(F.col(id_col).cast("string"))
    g = F.floor(h / 10).cast("bigint")
    marked = docs.select(F.col(id_col), F.col(text_col), g.alias("_g"), F.coalesce(h % 10 == 0, F.lit(False)).alias("_plant"))
    listed = marked.select(id_col, text_col, "_g", F.when(F.col("_plant"), words).alias("_words"))
    n = F.size("_words").cast("bigint")
    placed = listed.select(id_col, text_col, "_words", F.when(n > 0, F.col("_g") % n).alias("_a"), "_g")
    placed = placed.withColumn("_p", F.lit(1) + F.floor((n - F.col("_a")) / (F.lit(3) + F.col("_g") % 8)).cast("bigint"))
    cyclic = F.transform("_words", lambda word, i: F.when(i < F.col("_a"), word).otherwise(
        F.get("_words", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))))
    return placed.select(id_col, F.when(F.col("_a").isNotNull(), F.array_join(cyclic, " ")).otherwise(F.col(text_col)).alias(text_col))


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and hashes of all runs and of the rest."""
    ordered = F.transform("runs", lambda r: F.struct((-r["length"]).alias("size"), r["start"].alias("start"), r["period"].alias("period")))
    best = found.withColumn("_best", F.array_min(ordered))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("_best.start").alias("start"),
        (-F.col("_best.size")).alias("length"),
        F.col("_best.period").alias("period"),
        F.expr("(-_best.size * 1000) div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
