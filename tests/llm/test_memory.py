"""What a worker holds at once follows a step's bytes, not the batch's."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from poolbook.llm import decontaminate, line_rules, neardup

MB = 1 << 20


def _batch(rows: int = 4000, lines: int = 40) -> pa.RecordBatch:
    """About 8 MB of text, fewer rows than Spark puts into one Arrow batch."""
    texts = ["\n".join(f"line {k} of text {r % 700} says what others of its kind say" for k in range(lines)) for r in range(rows)]
    return pa.record_batch({"text": pa.array(texts)})


def _hold_lines(batch):
    wanted = np.unique(line_rules.Lines(batch.column("text").slice(0, 100)).hashes())
    return lambda: line_rules.held_lines(iter([batch]), wanted)


def _count_words(batch):
    return lambda: neardup.count_words(iter([batch]))


@pytest.mark.parametrize("step", [_hold_lines, _count_words])
def test_scratch_memory_is_that_of_a_step(step):
    batch = _batch()
    assert batch.nbytes > 7 * MB
    run = step(batch)
    tracemalloc.start()
    try:
        for _ in run():
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100 * MB


def test_steps_do_not_change_what_lines_are_held(monkeypatch):
    batch = _batch(300, 12)
    wanted = np.unique(line_rules.Lines(batch.column("text").slice(0, 100)).hashes())
    rows = lambda: {tuple(r.values()) for b in line_rules.held_lines(iter([batch]), wanted) for r in b.to_pylist()}
    whole = rows()
    monkeypatch.setattr(line_rules, "STEP_BYTES", 1000)
    assert rows() == whole and len(whole) == 100 * 12


def test_pieces_of_a_segment_do_not_change_the_postings(spark, monkeypatch):
    rows = [(i, None if i % 5 == 4 else f"alpha beta {i} gamma\n" * (i % 3)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    terms = ["gamma", "alpha", "7", "absent"]
    seen = lambda: [{k: v for k, v in r.asDict().items() if k != "segment"} for r in decontaminate.build_index(docs, terms=terms).collect()]
    whole = seen()
    monkeypatch.setattr(decontaminate, "STEP_BYTES", 50)
    (one,), pieces = whole, seen()
    assert pieces == whole and one["terms"] == ["7", "alpha", "gamma"] and one["n_words"][1] == 4
