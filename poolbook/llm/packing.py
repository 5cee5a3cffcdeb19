"""Best-fit packing (operator 10) with Martello-Toth dominance reduction.

Documents become token ids (``word_bpe_49k``, then id 1) and only those longer
than ``CAPACITY`` are cut into pieces of that length.  A packing depends on
nothing but how many pieces have each length, so the plan is made on the
histogram of lengths (at most ``CAPACITY`` numbers, whatever the input):

1. Reduction.  For a length j with room r = capacity - j, one set is fixed for
   good, for as many pieces at a time as the counts allow, if it dominates every
   other set that holds j (any other content of that sequence could take the
   place of the fixed one elsewhere):
   * {j} if nothing else fits;
   * {j, r} if a piece fills the room exactly;
   * {j, k}, k the longest that fits, if no two pieces fit in the room;
   * {j, k} if no three fit and k is at least as long as any two that fit.
   This repeats until no set can be fixed.
2. Best fit of what is left, longest first: a piece goes to the open sequence
   with the least room that is enough.  Sequences with equal content are
   handled as one group, so the work follows the number of lengths.

The plan's rows say which ranks of a length go to which sequences.  Every task
numbers its pieces per length; summed counts turn that into ranks; so pieces are
placed without sorting or gathering them, and a length that a third of all
pieces share is no hot key (its window has one row per task; pieces meet their
task's rank by (length, task)).

Defined results: null text is empty and becomes the single id 1; repeated rows
and repeated ids are packed as documents of their own; an empty table gives no
rows.  Further columns of the input are not read.
"""

from __future__ import annotations

import bisect
import unicodedata
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from poolbook.llm.common import DARK, LOWER, Words, bytes_of, chunks, stored

CAPACITY = 4096
END = 1
#: Units that a worker keeps the ids of, between chunks.
MEMO = 400_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, k bigint"
_workers: dict = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Classes of bytes between which the tokenizer always splits: letter, digit
#: (each alone), punctuation.  The apostrophe (contractions), control bytes and
#: bytes of longer code points are in none.
KIND = np.zeros(256, np.uint8)
for _b in range(0x21, 0x7F):
    KIND[_b] = 1 if chr(_b).isalpha() else 2 if chr(_b).isdigit() else 3 if chr(_b) != "'" else 0


class Encoder:
    """Ids of whole texts by way of their distinct units.

    The tokenizer normalises, lower-cases and splits before its merges, always at
    white space and between ASCII letters, digits and punctuation.  So the ids of
    a text are those of its units, one after the other, and every distinct unit
    is encoded once.  Chunks in which a special token may stand are cut at white
    space only, and keep their case.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 3, bool)  # ids that end a unit of letters
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.memo: dict[str, bytes] = {}  # little-endian uint32

    def learn(self, units: list[str]) -> None:
        """Ids of units; those of letters only are encoded many to a text, which
        the ids that end a unit take apart again."""
        plain = [u for u in units if u.isalpha() and unicodedata.is_normalized("NFC", u) and u.lower().isalpha()]
        for at in range(0, len(plain), 512):
            part = plain[at : at + 512]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part) and cuts[-1] == len(ids):
                flat, at_byte = ids.tobytes(), (4 * cuts).tolist()
                self.memo.update((u, flat[a:b]) for u, a, b in zip(part, [0, *at_byte], at_byte))
        rest = [u for u in units if u not in self.memo]
        for u, e in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False)):
            self.memo[u] = np.array(e.ids, "<u4").tobytes()

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows as uint32, count per row), without the final id."""
        data, offsets = bytes_of(texts)
        special = b"<|" in data.tobytes()
        words = Words(data, offsets, DARK) if special else Words(LOWER[data], offsets, DARK, KIND, 2)
        coded = words.text.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.memo) > MEMO:
            self.memo.clear()
        self.learn([w for w in names if w not in self.memo])
        own = [self.memo[w] for w in names]
        size = np.array([len(x) for x in own], np.int64) // 4
        flat = np.frombuffer(b"".join(own), "<u4")
        begin = np.cumsum(size) - size
        code = coded.indices.to_numpy(zero_copy_only=False)
        n = size[code] if len(code) else np.zeros(0, np.int64)
        index = np.arange(n.sum()) + np.repeat((begin[code] if len(code) else n) - (np.cumsum(n) - n), n)
        per_row = np.bincount(words.row, weights=n, minlength=len(texts)).astype(np.int64)
        return flat[index], per_row


def encoder(path: str) -> Encoder:
    if path not in _workers:
        _workers[path] = Encoder(path)
    return _workers[path]


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the
    piece's number k among those of its length in its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary or default_vocabulary())
        # of all attempts of a task only one's rows are committed
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in chunks(batches, "text", 2 << 20):
            ids, count = encode.ids(batch.column("text"))
            at, out = 0, []
            for doc, n in zip(batch.column("id").to_pylist(), count.tolist()):
                own = np.append(ids[at : at + n], np.uint32(END)).astype("<u4")
                at += n
                for piece, start in enumerate(range(0, n + 1, capacity)):
                    part = own[start : start + capacity]
                    out.append((doc, piece, start, len(part), zlib.crc32(part.tobytes()), task, int(seen[len(part)])))
                    seen[len(part)] += 1
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "k"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


Group = tuple[tuple[tuple[int, int], ...], int]


def reduce_counts(counts: Mapping[int, int], capacity: int) -> tuple[list[Group], dict[int, int]]:
    """Fix dominating sets; returns (fixed groups, counts that are left).  A group
    is (((length, pieces of it), ...), number of sequences)."""
    left = {size: n for size, n in counts.items() if n > 0}
    fixed: list[Group] = []

    def smallest(without: int, n: int) -> list[int]:
        """The n smallest remaining lengths, one piece of ``without`` left out."""
        out: list[int] = []
        for size in order:
            have = left.get(size, 0) - (size == without)
            out += [size] * max(0, min(have, n - len(out)))
            if len(out) == n:
                break
        return out + [capacity + 1] * (n - len(out))

    def fix(j: int, k: int | None) -> None:
        if k is None:
            n, content = left[j], ((j, 1),)
            left[j] = 0
        elif k == j:
            n, content = left[j] // 2, ((j, 2),)
            left[j] -= 2 * n
        else:
            n, content = min(left[j], left[k]), ((j, 1), (k, 1))
            left[j] -= n
            left[k] -= n
        fixed.append((content, n))

    changed = True
    while changed:
        changed = False
        order = sorted(size for size, n in left.items() if n)
        for j in reversed(order):
            while left[j]:
                room = capacity - j
                have = lambda k: left.get(k, 0) - (k == j) > 0
                a, b, c = smallest(j, 3)
                if a > room:
                    fix(j, None)
                elif have(room):
                    fix(j, room)
                else:
                    at = bisect.bisect_right(order, room) - 1
                    while not have(order[at]):
                        at -= 1
                    k = order[at]
                    if a + b <= room and (a + b + c <= room or k < _best_pair(order[: at + 1], left, j, room)):
                        break
                    fix(j, k)
                changed = True
    return fixed, {size: n for size, n in left.items() if n}


def _best_pair(order: list[int], left: Mapping[int, int], j: int, room: int) -> int:
    """The largest sum of two remaining pieces that is at most ``room``."""
    sizes = [(s, left[s] - (s == j)) for s in order if left[s] - (s == j) > 0]
    low, high, best = 0, len(sizes) - 1, 0
    while low <= high:
        total = sizes[low][0] + sizes[high][0]
        if total > room:
            high -= 1
        elif low == high and sizes[low][1] < 2:
            break
        else:
            best = max(best, total)
            low += 1
    return best


def best_fit(counts: Mapping[int, int], capacity: int) -> list[Group]:
    """Best fit, longest first, of pieces given by their counts per length."""
    rooms: list[int] = []  # ascending
    open_: dict[int, list[list]] = {}  # room -> [content, number of sequences]
    closed: list[Group] = []

    def put(content: tuple, n: int, room: int) -> None:
        if not n:
            return
        if not room:
            closed.append((content, n))
            return
        if room not in open_:
            bisect.insort(rooms, room)
            open_[room] = []
        open_[room].append([content, n])

    for size in sorted(counts, reverse=True):
        todo = counts[size]
        while todo:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                content, n, room = (), -(-todo // (capacity // size)), capacity
            else:
                room = rooms[at]
                content, n = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            each = room // size
            full = min(n, todo // each)
            put((*content, (size, each)), full, room - each * size)
            todo -= full * each
            n -= full
            if n and todo:  # less than one sequence takes
                put((*content, (size, todo)), 1, room - todo * size)
                todo, n = 0, n - 1
            if content:
                put(content, n, room)
    return closed + [(content, n) for groups in open_.values() for content, n in groups]


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, pieces per sequence, first sequence, offset),
    sorted by length and rank."""
    fixed, left = reduce_counts(counts, capacity)
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for content, n in fixed + best_fit(left, capacity):
        offset = 0
        for size, each in content:
            rows.append((size, used.get(size, 0), each, sequence, offset))
            used[size] = used.get(size, 0) + n * each
            offset += size * each
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to stored ``pieces``."""
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    per_task = stored(per_task, "counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan(counts, capacity)
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    key = lambda: F.col("task").cast("bigint") * (capacity + 1) + F.col("length")
    base = per_task.select(key().alias("_key"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    # One number a key: a key has the pieces of one length in one task, however many
    # there are of that length.
    ranked = pieces.withColumn("_key", key()).join(base, "_key").select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("k") + F.col("_base")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, first, each, sequence, offset = rows.T
        key = (size << 44) + first
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            inner = rank - first[at]
            yield pa.record_batch(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(sequence[at] + inner // each[at]), pa.array(offset[at] + inner % each[at] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack(stored(tokenize(docs, id_col, text_col, vocabulary, capacity), "pieces"), capacity)
