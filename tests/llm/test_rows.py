"""Rows, not ids, carry verdicts: ids on several texts, null ids, repeated rows."""

import random

from poolbook.llm import decontaminate, neardup

DOCS = "doc_id bigint, text string, lang string"


def prose(seed, n=120):
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(10_000)}" for _ in range(n)]


def test_links_of_an_id_on_two_texts_are_kept(spark):
    a, b = prose(1), prose(2)
    near = lambda words, i: " ".join([*words[:i], "other", *words[i + 1:]])
    rows = [(5, " ".join(a)), (5, " ".join(b)), (6, " ".join(a + ["more"])), (3, near(b, 5)), (7, near(b, 100)), (9, " ".join(prose(3))),
            (5, " ".join(a)), (None, " ".join(a)), (8, ""), (8, None)]
    docs = spark.createDataFrame([(*r, "en") for r in rows], DOCS)
    found = sorted((r["doc_id"], r["class_id"]) for r in neardup.classes(docs).collect() if r["doc_id"] is not None)
    assert found == [(3, 3), (5, 3), (5, 5), (5, 5), (6, 5), (7, 3), (8, 8), (8, 8), (9, 9)]
    kept = sorted((r["doc_id"], r["text"] or "") for r in neardup.keep_one(docs).collect() if r["doc_id"] is not None)
    assert kept == sorted([(3, near(b, 5)), (5, " ".join(a)), (8, ""), (8, ""), (9, " ".join(prose(3)))])
    assert neardup.keep_one(docs).where("doc_id is null").count() == 1


def test_decontamination_judges_rows(spark):
    item = " ".join(f"q{i}" for i in range(12))
    rows = [(None, f"x {item} y"), (1, f"x {item}"), (1, "a clean text"), (2, None), (None, "clean too"), (3, f"x {item}")]
    docs = spark.createDataFrame([(*r, "en") for r in rows], DOCS)
    benchmark = spark.createDataFrame([("i", item)], "item_id string, text string")
    left = decontaminate.drop_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted([(1, "a clean text"), (2, None), (None, "clean too")], key=str)
    assert decontaminate.drop_contaminated(docs.limit(0), benchmark).count() == 0


def test_a_license_belongs_to_the_row_that_holds_it(spark):
    from poolbook.llm import licenses

    mit = licenses.TEMPLATES["MIT"]
    rows = [(None, mit), (None, "nothing here"), ("/a/b.txt", mit), ("/a/b.txt", "other words"), ("/a/b.txt", None), (None, None)]
    files = spark.createDataFrame(rows, "path string, text string")
    found = licenses.scan(files).collect()
    assert sorted(r["own_license"] or "" for r in found) == ["", "", "", "", "MIT", "MIT"]
    assert [r["license_from"] for r in found] == [None] * 6
