"""Quality rules (operator 6): a linear-chain CRF over the lines of a document.

Every line with a word gets the label content or boilerplate: the Viterbi path
of a two-state linear-chain conditional random field over line features
(symbol, upper-case, digit and exclamation density, repetition of the line, of
its words and of its three-word windows, length, final punctuation, place at the
head or the end of the text).  A
document stays if at least ``MIN_CONTENT`` of its words are in content lines
and the base rules do not reject it.

The field is trained here, by maximum conditional likelihood (forward-backward
gradients), on line labels from weak supervision, so that a training sequence
can change between content and boilerplate:

* a line is boilerplate if texts of ``SPREAD`` or more different bodies (a body is
  named by its longest line) hold it, and half or more of the texts that hold it
  differ in body; this is counted over all documents.  Copies of one text, near
  ones too, share their body and so do not make its lines boilerplate;
* any other line of a good document is content;
* any other line of a bad document is content if a logistic model of good against
  bad documents' lines, both weighing the same, calls it like those of good ones.

The sample is at most ``SAMPLE`` labelled documents, those with the smallest hash
of their id, that hold at most ``LINES`` lines together (a document that would
exceed them is left out of the sample); everything else works on all rows.  Labels
are read for training only.

Base figures, over words ``[^\\x20\\x09-\\x0D]+`` of the whole text: see
``COLUMNS``.  ``base_failed``: fewer than 50 words, or over half of the words in
three-word windows that the text has twice or more.

Defined results: null text is empty: no words, base_failed.  Without usable
labels (none, or of one class) the field has no weights and every line is
content.  Repeated rows are judged one by one; repeated labels of an id count
once (the lowest); if rows of a labelled id differ in text, its smallest text is
trained on.  Further columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolbook.llm.common import DARK, STEP_BYTES, Words, byte_class, bytes_of, chunks, mix, stored, word_hash

SAMPLE = 4000
#: Lines of all training documents together.
LINES = 60000
#: Different bodies that must hold a line for it to count as boilerplate in training.
SPREAD = 5
MIN_CONTENT = 0.5
MIN_WORDS = 50
STEPS = 150
#: Strength of the quadratic penalty on the weights.
PENALTY = 1.0

COLUMNS = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, content_share double, kept boolean"
FEATURES = ("bias", "symbols", "repeated line", "repeated windows", "repeated words", "short", "upper case", "digits", "exclamations", "ends a sentence", "length", "first", "second", "last", "last but one")
#: Lines that one row of stored training features holds.
_PIECE = 10000

_SYMBOL = byte_class(lambda b: chr(b) in "#*$%&|<>")
_UPPER = byte_class(lambda b: 0x41 <= b <= 0x5A)
_DIGIT = byte_class(lambda b: 0x30 <= b <= 0x39)
_EXCLAIM = byte_class(lambda b: b == 0x21)
_END = byte_class(lambda b: chr(b) in ".!?:;\"')")


def _codes(x: np.ndarray) -> np.ndarray:
    return pd.factorize(x)[0].astype(np.int64)


def _line_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where lines begin: at row starts and after every \n."""
    begin = np.unique(np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], np.flatnonzero(data == 0x0A) + 1]))
    return begin[begin < len(data)]


def _bare(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Line ends without their \n."""
    return end - (data[end - 1] == 0x0A)


class Lines:
    """Base figures per row and features per line of a string column."""

    def __init__(self, texts: pa.Array):
        data, offsets = bytes_of(texts)
        n = len(offsets) - 1
        words = Words(data, offsets, DARK)
        code = words.text.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        kinds = int(code.max()) + 1 if len(code) else 1
        row = words.row
        self.n_words = words.count

        def per(on: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(on)])
            return total[end] - total[begin]

        rows = (offsets[:-1], offsets[1:])
        self.word_chars = per(DARK[data] & ((data & 0xC0) != 0x80), *rows)
        self.n_symbols = per(_SYMBOL[data], *rows)

        # three-word windows that a text has twice or more
        repeat = np.zeros(len(code), bool)
        if len(code) > 2:
            two = _codes(code[:-2] * kinds + code[1:-1])
            three = _codes(two * kinds + code[2:])
            inside = row[:-2] == row[2:]
            own = _codes(three * n + row[:-2])
            often = (np.bincount(own[inside], minlength=len(own) + 1)[own] > 1) & inside
            for k in range(3):
                repeat[k : len(code) - 2 + k] |= often
        self.n_repeat_words = np.bincount(row[repeat], minlength=n)

        begin = _line_starts(data, offsets)
        line_of = np.searchsorted(begin, words.start, side="right") - 1
        used, line = np.unique(line_of, return_inverse=True)
        m = len(used)
        begin_all = np.append(begin, len(data))
        begin, end = begin_all[used], begin_all[used + 1]
        self.row = np.searchsorted(offsets, begin, side="right") - 1
        self.span = data, begin, end
        # the text of each line without its \n
        text = data[data != 0x0A]
        shift = per(data == 0x0A, np.zeros(len(begin_all), np.int64), begin_all)
        line_text = pa.LargeStringArray.from_buffers(len(begin_all) - 1, pa.py_buffer(begin_all - shift), pa.py_buffer(text))
        same = line_text.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[used] if m else np.zeros(0, np.int64)
        dup = pd.Series(same * n + self.row).duplicated().to_numpy()
        self.n_dup_lines = np.bincount(self.row[dup], minlength=n)

        size = np.bincount(line, minlength=m)
        self.size = size
        place = np.arange(m) - np.searchsorted(self.row, self.row)
        left = np.searchsorted(self.row, self.row, side="right") - 1 - np.arange(m)
        share = lambda x: np.minimum(1.0, x / np.maximum(size, 1))
        chars = np.maximum(per(DARK[data], begin, end), 1)
        again = pd.Series(code * max(m, 1) + line).duplicated().to_numpy() if m else np.zeros(0, bool)
        last = words.end[np.append(np.flatnonzero(np.diff(line)), len(line) - 1)] - 1 if m else np.zeros(0, np.int64)
        self.features = np.column_stack([
            np.ones(m),
            share(per(_SYMBOL[data], begin, end)),
            dup,
            share(np.bincount(line[repeat], minlength=m)),
            share(np.bincount(line[again], minlength=m)) * (size >= 10),
            size < 4,
            per(_UPPER[data], begin, end) / chars,
            per(_DIGIT[data], begin, end) / chars,
            share(per(_EXCLAIM[data], begin, end)),
            _END[data[last]] if m else np.zeros(0),
            np.log1p(size) / 5,
            place == 0,
            place == 1,
            left == 0,
            left == 1,
        ]).astype(np.float64)

    def hashes(self) -> np.ndarray:
        """A hash of every line."""
        data, begin, end = self.span
        return word_hash(data, begin, _bare(data, end)) if len(begin) else np.zeros(0, np.uint64)


class Field:
    """A two-state linear chain: state 1 is content.

    score(path) = sum of weights . features over content lines + transitions.
    """

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    @staticmethod
    def _slots(row: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(sequence number, place) of each line; lines of a row are adjacent."""
        new = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
        sequence = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        return sequence, np.arange(len(row)) - begin[sequence] if len(row) else sequence, len(begin)

    def viterbi(self, features: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Best label of every line.  All sequences advance together, longest
        first, so step t touches only those with more than t lines."""
        if not len(row):
            return np.zeros(0, bool)
        emit = features @ self.weights
        sequence, place, count = self._slots(row)
        length = np.bincount(sequence)
        begin = np.cumsum(length) - length
        order = np.argsort(-length, kind="stable")
        active = np.searchsorted(-length[order], -np.arange(length.max()), side="left")  # sequences longer than t
        begin = begin[order]
        score = np.zeros((count, 2))
        back = np.zeros((len(row), 2), np.int8)
        score[:, 1] = emit[begin]
        for t in range(1, length.max()):
            k = active[t]
            at = begin[:k] + t
            options = score[:k, :, None] + self.moves[None]  # from, to
            back[at] = options.argmax(axis=1)
            score[:k] = options.max(axis=1)
            score[:k, 1] += emit[at]
        label = np.zeros(len(row), np.int8)
        state = score.argmax(axis=1).astype(np.int8)
        for t in range(length.max() - 1, -1, -1):
            k = active[t]
            at = begin[:k] + t
            label[at] = state[:k]
            state[:k] = back[at, state[:k]]
        return label == 1

    @classmethod
    def objective(cls, features: np.ndarray, row: np.ndarray, gold: np.ndarray, penalty: float = PENALTY) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
        """theta (weights, then moves) -> penalised conditional log likelihood and
        its gradient, both per sequence."""
        width = features.shape[1]
        sequence, place, count = cls._slots(row)
        length = np.bincount(sequence)
        order = np.argsort(-length, kind="stable")
        rank = np.empty(count, np.int64)
        rank[order] = np.arange(count)
        begin = (np.cumsum(length) - length)[order]
        active = np.searchsorted(-length[order], -np.arange(length.max()), side="left")
        steps_at = [begin[: active[t]] + t for t in range(length.max())]
        gold = gold.astype(np.int64)
        now = np.flatnonzero(place > 0)
        seen = np.zeros((2, 2))
        np.add.at(seen, (gold[now - 1], gold[now]), 1)
        target = np.concatenate([features.T @ gold, seen.ravel()])

        def value(theta: np.ndarray) -> tuple[float, np.ndarray]:
            moves = theta[width:].reshape(2, 2)
            emit = np.zeros((len(row), 2))
            emit[:, 1] = features @ theta[:width]
            forward, backward = np.zeros((len(row), 2)), np.zeros((len(row), 2))
            forward[steps_at[0]] = emit[steps_at[0]]
            for at in steps_at[1:]:
                x = forward[at - 1][:, :, None] + moves[None]
                forward[at] = np.logaddexp(x[:, 0], x[:, 1]) + emit[at]
            for at in reversed(steps_at[1:]):
                x = moves[None] + (emit[at] + backward[at])[:, None, :]
                backward[at - 1] = np.logaddexp(x[:, :, 0], x[:, :, 1])
            each = np.logaddexp(forward[begin, 0] + backward[begin, 0], forward[begin, 1] + backward[begin, 1])
            z = each[rank[sequence]]
            content = np.exp(forward[:, 1] + backward[:, 1] - z)
            pair = np.exp(forward[now - 1][:, :, None] + moves[None] + (emit[now] + backward[now])[:, None, :] - z[now][:, None, None])
            expected = np.concatenate([features.T @ content, pair.sum(axis=0).ravel()])
            gain = target @ theta - each.sum() - penalty / 2 * theta @ theta
            return float(gain / count), (target - expected - penalty * theta) / count

        return value

    @classmethod
    def train(cls, features: np.ndarray, row: np.ndarray, gold: np.ndarray, steps: int = STEPS, penalty: float = PENALTY) -> Field:
        """Maximum penalised conditional likelihood by Adam, full batches, from the
        weights of a logistic model of single lines."""
        width = features.shape[1]
        if not len(gold) or gold.all() or not gold.any():
            return cls(np.zeros(width), np.zeros((2, 2)))
        value = cls.objective(features, row, gold, penalty)
        theta = np.concatenate([logistic(features, gold, penalty), np.zeros(4)])
        first, second = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            _, gradient = value(theta)
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            theta = theta + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        return cls(theta[:width], theta[width:].reshape(2, 2))


def logistic(features: np.ndarray, gold: np.ndarray, penalty: float = PENALTY, steps: int = 25) -> np.ndarray:
    """Weights of a penalised logistic model, by Newton steps."""
    weights = np.zeros(features.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        curve = (features * (p * (1 - p))[:, None]).T @ features + penalty * np.eye(len(weights))
        move = np.linalg.solve(curve, features.T @ (gold - p) - penalty * weights)
        weights = weights + move
        if np.abs(move).max() < 1e-6:
            break
    return weights


def weak_labels(features: np.ndarray, good: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Training label (content) of every line.  good: its document is good;
    shared: documents of different bodies hold it."""
    own = ~shared
    ours, theirs = (own & good).sum(), (own & ~good).sum()
    if not ours or not theirs:
        return own & good
    odds = features @ logistic(features[own], good[own]) - np.log(ours / theirs)
    return own & (good | (odds > 0))


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))


def held_lines(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Which of the ``wanted`` line hashes every text holds, with its body and a hash of
    the whole text."""
    for batch in chunks(batches, "text", STEP_BYTES):
        data, offsets = bytes_of(batch.column("text"))
        begin = _line_starts(data, offsets)
        dark = np.concatenate([[0], np.cumsum(DARK[data])])
        end = np.append(begin[1:], len(data))
        used = dark[end] > dark[begin]
        if not used.any():
            continue
        begin, end = begin[used], _bare(data, end[used])
        row, line = np.searchsorted(offsets, begin, side="right") - 1, word_hash(data, begin, end)
        # a body is named by its longest line, a text by all of them
        order = np.lexsort((line, begin - end, row))
        new = np.concatenate([[True], row[1:] != row[:-1]])
        which = np.cumsum(new) - 1
        body = line[order][new][which]
        with np.errstate(over="ignore"):
            text = np.add.reduceat(mix(line), np.flatnonzero(new))[which]
        hit = wanted[np.minimum(np.searchsorted(wanted, line), len(wanted) - 1)] == line
        got = pd.DataFrame({"line": line[hit].view(np.int64), "body": body[hit].view(np.int64), "whole": text[hit].view(np.int64)})
        yield pa.RecordBatch.from_pandas(got.drop_duplicates(), preserve_index=False)


def shared_lines(docs: DataFrame, wanted: np.ndarray, id_col: str = "doc_id", text_col: str = "text", spread: int = SPREAD) -> np.ndarray:
    """Those of the ``wanted`` line hashes (sorted, at most ``LINES``) that texts of
    ``spread`` or more bodies hold, counted over all rows of ``docs``."""
    if not len(wanted):
        return wanted
    held = _slim(docs, id_col, text_col).select("text").mapInArrow(lambda batches: held_lines(batches, wanted), "line bigint, body bigint, whole bigint").distinct()
    bodies = held.groupBy("line", "body").agg(F.count("*").alias("texts"))
    often = bodies.groupBy("line").agg(F.count("*").alias("bodies"), F.sum("texts").alias("texts")).filter((F.col("bodies") >= spread) & (2 * F.col("bodies") >= F.col("texts")))
    return np.sort(np.array([r["line"] for r in often.select("line").collect()], np.int64).view(np.uint64))


def training_lines(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, lines: int = LINES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, number of the document, its label, hash) of the lines of the sample:
    at most ``sample`` documents and ``lines`` lines."""
    chosen = (labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("gold")).dropna()
              .groupBy("id").agg(F.min("gold").alias("gold")).orderBy(F.xxhash64("id"), "id").limit(sample))
    rows = _slim(docs, id_col, text_col).join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("gold").alias("gold"), F.min("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", STEP_BYTES):
            x = Lines(batch.column("text"))
            bounds, hashes = np.searchsorted(x.row, np.arange(batch.num_rows + 1)), x.hashes()
            for k, (i, gold) in enumerate(zip(batch.column("id").to_pylist(), batch.column("gold").to_pylist())):
                for piece, at in enumerate(range(bounds[k], bounds[k + 1], _PIECE)):
                    end = min(at + _PIECE, bounds[k + 1])
                    yield pa.record_batch({
                        "id": pa.array([i], pa.int64()), "gold": pa.array([gold], pa.int32()), "piece": pa.array([piece], pa.int32()), "n": pa.array([end - at], pa.int32()),
                        "features": pa.array([x.features[at:end].astype("<f8").tobytes()], pa.binary()), "hashes": pa.array([hashes[at:end].astype("<u8").tobytes()], pa.binary()),
                    })

    kept = stored(rows.select("id", "gold", "text").mapInArrow(features, "id bigint, gold int, piece int, n int, features binary, hashes binary"), "training-lines")
    size = kept.groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.xxhash64("id"), "id").collect()
    left_out, total = [], 0
    for r in size:
        if total + r["n"] <= lines:
            total += r["n"]
        else:
            left_out.append(r["id"])
    got = kept.filter(~F.col("id").isin(left_out)).orderBy("id", "piece").collect() if total else []
    n = [r["n"] for r in got]
    if not got:
        return np.zeros((0, len(FEATURES))), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.uint64)
    return (np.concatenate([np.frombuffer(r["features"], "<f8").reshape(-1, len(FEATURES)) for r in got]), np.repeat([r["id"] for r in got], n),
            np.repeat([r["gold"] == 1 for r in got], n), np.concatenate([np.frombuffer(r["hashes"], "<u8") for r in got]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, lines: int = LINES) -> Field:
    """Train on weak line labels of the sampled documents (see above)."""
    features, document, good, hashes = training_lines(docs, labels, id_col, text_col, label_col, sample, lines)
    if not len(good) or good.all() or not good.any():
        return Field(np.zeros(len(FEATURES)), np.zeros((2, 2)))
    shared = np.isin(hashes, shared_lines(docs, np.unique(hashes), id_col, text_col))
    return Field.train(features, document, weak_labels(features, good, shared))


def judge(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", min_content: float = MIN_CONTENT) -> DataFrame:
    """Base figures, content share and verdict of every row (``COLUMNS``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", STEP_BYTES):
            x = Lines(batch.column("text"))
            content = field.viterbi(x.features, x.row)
            inside = np.bincount(x.row, weights=x.size * content, minlength=batch.num_rows)
            share = inside / np.maximum(x.n_words, 1)
            failed = (x.n_words < MIN_WORDS) | (100 * x.n_repeat_words > 50 * x.n_words)
            yield pa.record_batch({
                "doc_id": batch.column("id"),
                **{c: pa.array(getattr(x, c), pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")},
                "base_failed": pa.array(failed), "content_share": pa.array(share), "kept": pa.array(~failed & (share >= min_content)),
            })

    return _slim(docs, id_col, text_col).mapInArrow(run, COLUMNS)


def line_labels(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line with a word: doc_id, line (place among those lines), content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", STEP_BYTES):
            x = Lines(batch.column("text"))
            _, place, _ = Field._slots(x.row)
            yield pa.record_batch({"doc_id": batch.column("id").take(pa.array(x.row)), "line": pa.array(place, pa.int64()), "content": pa.array(field.viterbi(x.features, x.row))})

    return _slim(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, line bigint, content boolean")


def keep(docs: DataFrame, field: Field, text_col: str = "text", min_content: float = MIN_CONTENT) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_col, STEP_BYTES):
            x = Lines(batch.column(text_col))
            content = field.viterbi(x.features, x.row)
            share = np.bincount(x.row, weights=x.size * content, minlength=batch.num_rows) / np.maximum(x.n_words, 1)
            failed = (x.n_words < MIN_WORDS) | (100 * x.n_repeat_words > 50 * x.n_words)
            yield batch.filter(pa.array(~failed & (share >= min_content)))

    return docs.select(*names).mapInArrow(run, docs.schema)
