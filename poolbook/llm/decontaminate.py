"""Benchmark decontamination (operator 4): a stored positional inverted index.

Index.  Tasks split documents into segments of about ``CHUNK_BYTES`` of text.
A segment row holds, for every indexed term, the ascending list of its token
positions (documents follow one another with a gap of one position, so no
phrase can cross a border).  The index is a Parquet table in the shared
checkpoint folder: a lost executor only repeats the reading of a segment.

Search.  Every query item is cut into windows of ``WINDOW`` consecutive words
(an item of fewer words, but not none, is one window).  In each segment the
windows' terms are ordered by their number of postings in the whole index; the list of
the rarest term, shifted by the term's offset, gives the candidate starts, and
the offset-adjusted lists of the other terms are intersected one by one, from
rare to frequent, for all windows at once.  What is left are exact phrase
matches.  Proximity matches: items are also cut into tiles (every
``WINDOW``-th window); a tile is near where all of its distinct terms have a
position at most ``slop`` words away from one occurrence of its rarest term,
inside one document.

Nothing is shuffled: documents never move, and the queries go to them in blocks
of at most ``BLOCK_BYTES`` (an item larger than that is a block of its own), so
the broadcast has a bound.  With one block only the block's terms are indexed;
with more, the index holds all terms and is searched once per block.

Defined results: null or empty texts have no words, no hits; an empty benchmark
or an empty documents table gives rows without hits or no rows; repeated
documents are rows of their own; repeated item ids count as one item; null item
ids are kept out of the ids but their windows still hit.  Further columns of
either input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolbook.llm.common import CHUNK_BYTES, STEP_BYTES, chunks, lower_words, stored

WINDOW = 10
#: Bytes of query text that go to the tasks at once.
BLOCK_BYTES = 4 << 20
#: Candidate starts that one vectorised intersection works on.
STEP = 2_000_000

INDEX = "segment string, doc_id array<bigint>, first array<bigint>, n_words array<bigint>, terms array<string>, sizes array<bigint>, positions binary"
MATCHES = "segment string, ordinal int, doc_id bigint, n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>, near_items array<string>"


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", terms: Sequence[str] | None = None) -> DataFrame:
    """Positional postings of ``docs``; of ``terms`` only, if given."""
    only = None if terms is None else pa.array(sorted(terms), pa.large_string())

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        for batch in chunks(batches, "text"):
            found, counts, words_before, rows_before = [], [], 0, 0
            # words of given terms are looked up piece by piece: the others need not be held
            for part in chunks(iter([batch]), "text", CHUNK_BYTES if only is None else STEP_BYTES):
                words = lower_words(part.column("text"))
                if only is None:
                    coded = words.text.dictionary_encode()
                    code, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
                else:
                    code, names = pc.fill_null(pc.index_in(words.text, only), -1).to_numpy(zero_copy_only=False), only
                at = np.flatnonzero(code >= 0)
                # a gap of one between documents
                found.append((code[at], (at + words.row[at] + words_before + rows_before).astype(np.int32)))
                counts.append(words.count)
                words_before, rows_before = words_before + len(code), rows_before + len(words.count)
            code, position = (np.concatenate(x) for x in zip(*found))
            count = np.concatenate(counts)
            position = position[np.argsort(code, kind="stable")]
            size = np.bincount(code, minlength=len(names))
            first = np.cumsum(count) - count + np.arange(len(count))
            here = np.flatnonzero(size)
            one = lambda values, kind: pa.array([values], pa.list_(kind))
            yield pa.record_batch({
                "segment": [uuid.uuid4().hex],
                "doc_id": one(batch.column("id").to_pylist(), pa.int64()),
                "first": one(first, pa.int64()),
                "n_words": one(count, pa.int64()),
                "terms": one(names.take(pa.array(here)).to_pylist(), pa.string()),
                "sizes": one(size[here], pa.int64()),
                "positions": pa.array([position.tobytes()], pa.binary()),
            })

    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return stored(slim.mapInArrow(segments, INDEX), "postings")


class Block:
    """Windows of some query items over the block's own term numbers.

    windows: one row of ``WINDOW`` term numbers per distinct (item, window), -1
    behind the end; item: the item of each row; tile: rows that proximity uses.
    """

    def __init__(self, items: Sequence[tuple[object, str | None]], window: int):
        words = lower_words(pa.array([t for _, t in items], pa.large_string()))
        coded = words.text.dictionary_encode()
        self.terms = coded.dictionary
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        rows, owner, tiles, at = [], [], [], 0
        for k, n in enumerate(words.count):
            if not n:
                continue
            own = code[at : at + n]
            at += n
            if n < window:
                own = np.concatenate([own, np.full(window - n, -1, np.int32)])
            view = np.lib.stride_tricks.sliding_window_view(own, window)
            rows.append(view)
            owner.append(np.full(len(view), k))
            starts = np.arange(len(view))
            tiles.append((starts % window == 0) | (starts == len(view) - 1))
        self.names = [None if i is None else str(i) for i, _ in items]
        self.windows = np.concatenate(rows) if rows else np.zeros((0, window), np.int32)
        self.item = np.concatenate(owner) if rows else np.zeros(0, np.int64)
        self.tile = np.concatenate(tiles) if rows else np.zeros(0, bool)


def blocks(queries: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple[object, str | None]]]:
    """The query items in blocks of bounded size, streamed through the driver."""
    block, size = [], 0
    for row in queries.select(F.col(id_col), F.col(text_col)).toLocalIterator():
        n = len((row[1] or "").encode())
        if block and size + n > limit:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += n
    if block:
        yield block


def _spread(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices start[i] .. start[i]+size[i]-1 of every i, and that i."""
    owner = np.repeat(np.arange(len(size)), size)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    return start[owner] + inner, owner


def _parts(size: np.ndarray) -> Iterator[slice]:
    """Slices of windows with about STEP candidates each."""
    total, at = np.cumsum(size), 0
    while at < len(size):
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + STEP, side="right")))
        yield slice(at, end)
        at = end


def _search(block: Block, total: np.ndarray, term_size: np.ndarray, positions: np.ndarray, length: int, first: np.ndarray, last: np.ndarray, slop: int):
    """Exact (start, window) and near (document, window) matches in a segment.

    total: occurrences of the block's terms in the whole index, which order the
    terms of a window (ties by place); term_size: those in this segment."""
    offset = np.cumsum(term_size) - term_size
    at = np.full(length, -1, np.int32)  # the term at each position: postings by address
    at[positions] = np.repeat(np.arange(len(term_size), dtype=np.int32), term_size)
    real = block.windows >= 0
    alive = np.flatnonzero(((term_size[block.windows] > 0) | ~real).all(axis=1))
    win = block.windows[alive]
    rank = np.argsort(np.where(real[alive], total[win], np.iinfo(np.int64).max), axis=1, kind="stable")
    rarest = np.take_along_axis(win, rank[:, :1], 1)[:, 0]
    exact, near = [], []
    for part in _parts(term_size[rarest]):
        index, owner = _spread(offset[rarest[part]], term_size[rarest[part]])
        owner += part.start
        start = positions[index].astype(np.int64) - rank[owner, 0]
        keep = start >= 0
        start, owner = start[keep], owner[keep]
        for k in range(1, win.shape[1]):
            if not len(owner):
                break
            o = rank[owner, k]
            term, there = win[owner, o], start + o
            inside = there < length
            good = (term < 0) | (inside & (at[np.where(inside, there, 0)] == term))
            start, owner = start[good], owner[good]
        exact.append((start, alive[owner]))
    tiles = np.flatnonzero(block.tile[alive])
    key = (np.repeat(np.arange(len(term_size), dtype=np.int64), term_size) << 32) | positions
    for part in _parts(term_size[rarest[tiles]]):
        chosen = tiles[part]
        index, local = _spread(offset[rarest[chosen]], term_size[rarest[chosen]])
        centre, owner = positions[index].astype(np.int64), chosen[local]
        doc = np.searchsorted(first, centre, side="right") - 1
        for k in range(1, win.shape[1]):
            if not len(owner):
                break
            term = win[owner, rank[owner, k]]
            low = np.maximum(centre - slop, first[doc])
            high = np.minimum(centre + slop, last[doc])
            base = np.maximum(term, 0).astype(np.int64) << 32
            found = np.searchsorted(key, base | low)
            hit = (found < len(key)) & (key[np.minimum(found, max(len(key) - 1, 0))] <= (base | high))
            good = (term < 0) | hit
            centre, owner, doc = centre[good], owner[good], doc[good]
        near.append((doc, alive[owner]))
    gather = lambda pairs: tuple(np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return gather(exact), gather(near)


def search_index(index: DataFrame, block: Block, slop: int) -> DataFrame:
    """One row per indexed document: merged hit spans (words, end exclusive)
    and the ids of the items with exact and with near matches."""

    names = block.terms.to_pylist()
    # One count per term of the block, however large the index is.
    wanted = index.sparkSession.createDataFrame([(t,) for t in names], "term string")
    counts = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("p")).groupBy(F.col("p.terms").alias("term")).agg(F.sum("p.sizes").alias("n"))
    known = {r["term"]: r["n"] for r in counts.join(F.broadcast(wanted), "term", "left_semi").collect()}
    total = np.array([known.get(t, 0) for t in names], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = block.terms.to_pylist()
        lengths = (block.windows >= 0).sum(axis=1)
        for batch in batches:
            for row in batch.to_pylist():
                first, count = np.array(row["first"], np.int64), np.array(row["n_words"], np.int64)
                length = int(first[-1] + count[-1]) if len(first) else 0
                # the block's terms in the order of its own numbers
                number = {t: i for i, t in enumerate(row["terms"])}
                sizes = np.array([*row["sizes"], 0], np.int64)
                begin = np.cumsum(sizes) - sizes
                where = np.array([number.get(t, len(number)) for t in names], np.int64)
                term_size = sizes[where] if len(where) else np.zeros(0, np.int64)
                take, _ = _spread(begin[where], term_size) if len(where) else (np.zeros(0, np.int64), None)
                positions = np.frombuffer(row["positions"], np.int32)[take]
                (start, win), (near_doc, near_win) = _search(block, total, term_size, positions, length, first, first + count - 1, slop)
                edge = np.zeros(length + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + lengths[win], -1)
                covered = np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]]) if length else np.zeros(2, np.int8)
                step = np.diff(covered)
                span_start, span_end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                span_doc = np.searchsorted(first, span_start, side="right") - 1

                def by_doc(doc, item):
                    out = [set() for _ in first]
                    for d, i in set(zip(doc.tolist(), item.tolist())):
                        if block.names[i] is not None:
                            out[d].add(block.names[i])
                    return pa.array([sorted(x) for x in out], pa.list_(pa.string()))

                bounds = np.concatenate([[0], np.cumsum(np.bincount(span_doc, minlength=len(first)))]).astype(np.int32)
                spans = lambda x: pa.ListArray.from_arrays(pa.array(bounds), pa.array(x - first[span_doc], pa.int64()))
                doc = np.searchsorted(first, start, side="right") - 1
                yield pa.record_batch({
                    "segment": pa.array([row["segment"]] * len(first), pa.string()),
                    "ordinal": pa.array(np.arange(len(first)), pa.int32()),
                    "doc_id": pa.array(row["doc_id"], pa.int64()),
                    "n_words": pa.array(count, pa.int64()),
                    "starts": spans(span_start),
                    "ends": spans(span_end),
                    "items": by_doc(doc, block.item[win]),
                    "near_items": by_doc(near_doc, block.item[near_win]),
                })

    return index.mapInArrow(run, MATCHES)


def _merge(found: DataFrame) -> DataFrame:
    """Union of the matches that several blocks have in a document."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                spans = sorted((a, b) for s, e in zip(r.pop("s"), r.pop("e")) for a, b in zip(s, e))
                out: list[list[int]] = []
                for a, b in spans:
                    if out and a <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], b)
                    else:
                        out.append([a, b])
                rows.append(r | {"starts": [a for a, _ in out], "ends": [b for _, b in out]})
            names = ["segment", "ordinal", "doc_id", "n_words", "starts", "ends", "items", "near_items"]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 2, *[pa.list_(pa.string())] * 2]
            yield pa.record_batch([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)

    grouped = found.groupBy("segment", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.collect_list("starts").alias("s"), F.collect_list("ends").alias("e"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items"))
    return grouped.mapInArrow(pick, MATCHES)


def find_matches(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text: str = "text", window: int = WINDOW, slop: int = 2 * WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: segment, ordinal, doc_id, n_words, starts and
    ends of the merged hit spans, items (exact) and near_items (proximity)."""
    stream = blocks(queries, item_col, item_text, block_bytes)
    ahead = [b for _, b in zip(range(2), stream)]
    parts = [Block(b, window) for b in ahead[:1]] or [Block([], window)]
    index = build_index(docs, id_col, text_col, terms=parts[0].terms.to_pylist() if len(ahead) < 2 else None)
    found = search_index(index, parts[0], slop)
    if len(ahead) < 2:
        return found
    tables = [stored(found, "matches")]
    for items in (b for group in (ahead[1:], stream) for b in group):
        tables.append(stored(search_index(index, Block(items, window), slop), "matches"))
    total = tables[0]
    for t in tables[1:]:
        total = total.unionByName(t)
    return _merge(total)


def digests(matches: DataFrame) -> DataFrame:
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda x, y: x + y)
    return matches.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.size("near_items").cast("bigint").alias("n_near_items"))


def drop_contaminated(docs: DataFrame, queries: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has no hit.  A verdict belongs to the text, so
    rows are told apart by a 64-bit hash of it: null ids, repeated ids and repeated rows
    need no care; a null text has no words and stays."""
    own = F.xxhash64(text_col)
    keyed = docs.select(own.alias("doc_id"), F.col(text_col).alias("text"))
    hit = digests(find_matches(keyed, queries)).filter("contaminated").select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hit, own == F.col("_hit"), "left_anti")


def oracle() -> str:
    """DuckDB SQL of the query; near items by the same definition, per tile."""
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
q AS (SELECT item_id, {words} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, w[i:i + least(len(w), {WINDOW}) - 1] AS g, i, len(w) AS n
  FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - {WINDOW - 1}, 1))) AS i FROM q WHERE len(w) > 0)
),
lens AS (SELECT DISTINCT len(g) AS k FROM win),
heads AS (SELECT DISTINCT g[1] AS head FROM win),
tok AS (SELECT r, w, p, w[p] AS t FROM (SELECT r, w, unnest(generate_series(1, len(w))) AS p FROM d WHERE len(w) > 0)),
gram AS (SELECT r, p, k, w[p:p + k - 1] AS g FROM tok JOIN heads ON t = head CROSS JOIN lens WHERE p + k - 1 <= len(w)),
hit AS (SELECT DISTINCT r, p, k, item_id FROM gram JOIN (SELECT DISTINCT item_id, g FROM win) USING (g)),
n_hit AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + k - 1)) AS x FROM hit) GROUP BY r),
tile AS (SELECT row_number() OVER () AS id, item_id, g FROM win WHERE (i - 1) % {WINDOW} = 0 OR i = greatest(n - {WINDOW - 1}, 1)),
tt AS (SELECT id, item_id, t, min(o) AS o FROM (SELECT id, item_id, unnest(g) AS t, unnest(generate_series(1, len(g))) AS o FROM tile) GROUP BY ALL),
freq AS (SELECT t, count(*) AS c FROM tok GROUP BY t),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(c, 0), o) AS place, count(*) OVER (PARTITION BY id) AS m FROM tt LEFT JOIN freq USING (t)),
near AS (
  SELECT DISTINCT r, item_id FROM (
    SELECT a.id, a.item_id, a.m, k.r, k.p, count(DISTINCT b.t) AS found
    FROM ranked a JOIN tok k ON k.t = a.t JOIN ranked b ON b.id = a.id
    JOIN tok x ON x.r = k.r AND x.t = b.t AND x.p BETWEEN k.p - {2 * WINDOW} AND k.p + {2 * WINDOW}
    WHERE a.place = 1 GROUP BY ALL) WHERE found = m
),
n_near AS (SELECT r, count(*) AS n_near FROM near GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN n_hit USING (r) LEFT JOIN items USING (r) LEFT JOIN n_near USING (r)"""
