"""Byte-level BPE encoding and decoding (operator 12).

A text is cut at the vocabulary's added tokens, then into units by the pattern of
the vocabulary's family.  The bytes of a unit are the first symbols of a doubly
linked list; a priority queue holds the rank of every adjacent pair that can be
merged.  The lowest rank (leftmost of equals) is merged, its two new neighbour
pairs are queued, and queue entries whose symbols have changed since are skipped
when they come up.  A unit of n bytes takes O(n log n) steps however long it is.

Decoding concatenates the byte strings of the vocabulary; what is no valid UTF-8
becomes U+FFFD, ids that the vocabulary does not have are left out.

Both are narrow: rows are encoded where they lie, nothing is shuffled, and a lost
task is simply run again.  A worker keeps the ids of at most twice ``MEMO``
distinct units of at most ``SHORT`` characters (a cache, not a limit: others are
merged each time they occur).  A text longer than ``BLOCK`` characters is worked on in blocks
cut between a word and a single space, where no unit can cross, so memory beyond
the row itself stays flat.

Defined results: null texts and null ids are empty; an empty text has no ids;
repeated rows give repeated rows; an empty table gives no rows.  Further columns
of the input stay as they are, except that one named like the new column is
replaced.
"""

from __future__ import annotations

import codecs
import heapq
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the pattern that cuts text into units before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters that a text can be cut by plain character classes with.
LETTERS = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
SPACES = r"\t-\r "
MARKS = r"\u00ab\u00bb\u2010-\u2027"

MEMO = 300_000
SHORT = 64
BLOCK = 1 << 20
#: Characters of text that one output batch is made from.
BATCH = 4 << 20

_workers: dict = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def printable_bytes() -> dict[str, int]:
    """The byte that each character of the vocabulary file stands for: printable
    ones themselves, the others in order from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b and b != 0xAD)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def merge(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Ids after all merges.  ``ranks`` has (rank, id of the whole) for each pair."""
    n = len(symbols)
    if n < 2:
        return symbols
    after = list(range(1, n + 1))  # n: no neighbour
    before = list(range(-1, n - 1))
    queue = []
    for at in range(n - 1):
        found = ranks.get((symbols[at], symbols[at + 1]))
        if found:
            queue.append((found[0], at, found[1]))
    heapq.heapify(queue)
    gone = -1
    while queue:
        rank, at, whole = heapq.heappop(queue)
        right = after[at]
        # stale: merged away, last of the list, or another pair stands here now
        if symbols[at] == gone or right == n or ranks.get((symbols[at], symbols[right])) != (rank, whole):
            continue
        symbols[at], symbols[right] = whole, gone
        far = after[at] = after[right]
        if far < n:
            before[far] = at
            found = ranks.get((whole, symbols[far]))
            if found:
                heapq.heappush(queue, (found[0], at, found[1]))
        near = before[at]
        if near >= 0:
            found = ranks.get((symbols[near], whole))
            if found:
                heapq.heappush(queue, (found[0], near, found[1]))
    return [s for s in symbols if s != gone]


class Units(dict):
    """Packed ids (little-endian, 32 bits each) of units; missing ones are merged.
    When it is full its content becomes the older generation, from which what is
    still in use comes back."""

    def __init__(self, start: list[int], ranks: dict):
        self.start, self.ranks, self.older = start, ranks, {}

    def __missing__(self, unit: str) -> bytes:
        packed = self.older.get(unit)
        if packed is None:
            packed = np.array(merge([self.start[b] for b in unit.encode()], self.ranks), "<u4").tobytes()
        if len(unit) <= SHORT:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[unit] = packed
        return packed


class Vocabulary:
    """A byte-level BPE vocabulary in its JSON form."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = printable_bytes()
        names = spec["model"]["vocab"]
        start = [0] * 256
        for char, byte in byte_of.items():
            start[byte] = names[char]
        ranks = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            ranks[names[left], names[right]] = (rank, names[left + right])
        self.units = Units(start, ranks)
        self.strings = {i: bytes(byte_of[c] for c in name) for name, i in names.items()}
        self.added = {}
        for token in spec.get("added_tokens", []):
            if token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]:
                raise ValueError(f"added token {token['content']!r} needs a rule this encoder does not have")
            self.added[token["content"]] = np.array([token["id"]], "<u4").tobytes()
            self.strings[token["id"]] = token["content"].encode()
        longest = sorted(self.added, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, longest))) if longest else None
        self.common = re.compile(rf"[\x00-\x7f{LETTERS}{MARKS}]*+")
        simple = PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^{SPACES}{LETTERS}0-9]").replace(r"\p{L}", f"[{LETTERS}]")
        simple = simple.replace(r"\p{N}", "[0-9]").replace(r"\S", f"[^{SPACES}]").replace(r"\s", f"[{SPACES}]")
        self.simple = re.compile(simple)
        self.plain = regex.compile(PATTERN)
        self.cut = regex.compile(r"(?<=\S)(?= \S)")
        newer = newer_letters()
        self.newer = self.exact = None
        if newer:
            self.newer = regex.compile(f"[{newer}]")
            exact = PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{newer}])")
            exact = exact.replace(r"?\p{L}+", rf"?(?:(?![{newer}])\p{{L}})+").replace(r"?\p{N}+", rf"?(?:(?![{newer}])\p{{N}})+")
            self.exact = regex.compile(exact)

    def split(self, text: str) -> list[str]:
        """Units of a text without added tokens."""
        if text.isascii() or self.common.fullmatch(text):
            return self.simple.findall(text)
        if self.newer is not None and self.newer.search(text):
            return self.exact.findall(text)
        return self.plain.findall(text)

    def blocks(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > BLOCK:
            found = self.cut.search(text, at + BLOCK)
            if not found:
                break
            yield text[at : found.start()]
            at = found.start()
        yield text[at:] if at else text

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a whole text."""
        if not text:
            return b""
        out, at = [], 0
        unit = self.units.__getitem__
        found = self.specials.finditer(text) if self.specials is not None else ()
        for special in found:
            for block in self.blocks(text[at : special.start()]):
                out.append(b"".join(map(unit, self.split(block))))
            out.append(self.added[special.group()])
            at = special.end()
        for block in self.blocks(text[at:] if at else text):
            out.append(b"".join(map(unit, self.split(block))))
        return b"".join(out) if len(out) > 1 else out[0]

    def decode(self, ids: bytes | None) -> str:
        """The text of packed ids."""
        if not ids:
            return ""
        reader, out = codecs.getincrementaldecoder("utf-8")("replace"), []
        known = self.strings
        for at in range(0, len(ids), 4 * BLOCK):
            part = np.frombuffer(ids[at : at + 4 * BLOCK], "<u4").tolist()
            out.append(reader.decode(b"".join([known.get(i, b"") for i in part])))
        out.append(reader.decode(b"", True))
        return "".join(out)


def newer_letters() -> str:
    """Letters and numbers (as ranges of a character class) that the pattern
    library of this box counts as such and the tokenizers library does not, its
    Unicode tables being older.  Only characters that Python's own, older tables
    lack can differ, so only those are asked about."""
    import unicodedata

    import regex
    from tokenizers import pre_tokenizers

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    known = regex.compile(r"[\p{L}\p{N}]")
    recent = [chr(c) for c in range(0x250, 0x40000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn" and known.match(chr(c))]
    if not recent:
        return ""
    # "!" joins a character that is neither letter nor number, and no other
    asked = " ".join("!" + c for c in recent)
    cuts = {end for _, (_, end) in pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(asked)}
    ranges: list[list[int]] = []
    for i, c in enumerate(recent):
        if 3 * i + 1 in cuts:
            continue
        if ranges and ranges[-1][1] == ord(c) - 1:
            ranges[-1][1] += 1
        else:
            ranges.append([ord(c), ord(c)])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


def vocabulary(path: str | None) -> Vocabulary:
    """The worker's copy of a vocabulary."""
    path = path or default_vocabulary()
    if path not in _workers:
        _workers[path] = Vocabulary(path)
    return _workers[path]


def _add_column(rows: DataFrame, source: str, target: str, kind: T.DataType, make) -> DataFrame:
    """``rows`` with the column ``target`` = make() applied to ``source``."""
    rest = [f for f in rows.schema.fields if f.name.lower() != target.lower()]
    schema = T.StructType([*rest, T.StructField(target, kind)])
    names = [f.name for f in rest]
    arrow = pa.large_binary() if isinstance(kind, T.BinaryType) else pa.large_string()
    small = pa.binary() if isinstance(kind, T.BinaryType) else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            values, size, at = [], 0, 0
            for i, value in enumerate(batch.column(source)):
                new = one(value.as_py())
                values.append(new)
                size += len(new)
                if size > BATCH or i + 1 == batch.num_rows:
                    part = batch.slice(at, i + 1 - at)
                    column = pa.array(values, arrow).cast(small)
                    yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), column], names=[*names, target])
                    values, size, at = [], 0, i + 1

    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``docs`` with ``ids_col``: the ids of each whole text as binary, four
    little-endian bytes an id (``numpy.frombuffer(ids, "<u4")``)."""
    return _add_column(docs, text_col, ids_col, T.BinaryType(), lambda: vocabulary(path).encode)


def decode(rows: DataFrame, ids_col: str = "ids", text_col: str = "decoded", path: str | None = None) -> DataFrame:
    """``rows`` with ``text_col``: the text of the packed ids."""
    return _add_column(rows, ids_col, text_col, T.StringType(), lambda: vocabulary(path).decode)


def digests(coded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of rows with ids and decoded text."""
    return coded.select(
        F.col(id_col),
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
