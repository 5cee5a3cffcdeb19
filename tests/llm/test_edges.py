"""Every operator on nulls, empty, long and repeated rows, clashing columns, empty tables."""

import hashlib
import math
import re

import pytest

import corpus_pipeline
from poolbook.llm import chat, decontaminate, html_text, licenses, line_rules, neardup, packing, pii, quality, url_filter

LONG = "lorem ipsum " * 40000
DOCS = [(1, None), (2, ""), (3, " \n\t\n"), (4, LONG), (5, "a b c d e f g"), (6, "a b c d e f g"), (6, "a b c d e f g"), (None, "x y"), (7, "é \U0001f600 ß")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "src0", len(t or ""), "clash", 1, None) for i, t in DOCS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, `row` int, `_found` string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 0, 0), (5, 1, 0), (5, 0, 0), (None, 1, 0), (99, None, None)], "doc_id bigint, quality int, toxic int")


def test_quality(docs, labels):
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == len(DOCS) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_line_rules(docs, labels):
    rows = {r["doc_id"]: r for r in line_rules.judge(docs, line_rules.train(docs, labels)).collect()}
    assert rows[1]["n_words"] == 0 and rows[1]["base_failed"] and not rows[1]["kept"]
    assert rows[4]["n_words"] == 80000 and rows[4]["n_repeat_words"] == 80000 and rows[4]["base_failed"]
    assert rows[7]["word_chars"] == 3
    field = line_rules.train(docs, labels.limit(0))
    assert not field.weights.any() and line_rules.judge(docs.limit(0), field).count() == 0
    assert line_rules.keep(docs, field).columns == docs.columns


def test_decontaminate(spark, docs):
    items = spark.createDataFrame([(1, "b c d"), (2, None), (3, ""), (1, "b c d"), (None, "x y"), (10, "lorem ipsum " * 6)], "item_id bigint, text string")
    rows = {r["doc_id"]: r for r in decontaminate.digests(decontaminate.find_matches(docs, items)).collect()}
    assert rows[1]["n_words"] == 0 and not rows[1]["contaminated"]
    assert rows[5]["n_hit"] == 3 and rows[5]["items_sha256"] == hashlib.sha256(b"1").hexdigest()
    assert rows[None]["n_hit"] == 2 and rows[None]["n_items"] == 0
    assert rows[4]["n_hit"] == 80000
    # blocks of one item each give the same
    blocks = {r["doc_id"]: r for r in decontaminate.digests(decontaminate.find_matches(docs, items, block_bytes=1)).collect()}
    assert blocks == rows
    empty = decontaminate.digests(decontaminate.find_matches(docs, items.limit(0))).collect()
    assert len(empty) == len(DOCS) and not any(r["contaminated"] for r in empty)
    assert decontaminate.find_matches(docs.limit(0), items).count() == 0


def test_neardup(docs):
    rows = neardup.classes(docs).collect()
    assert len(rows) == len(DOCS)
    named = {(r["doc_id"], r["class_id"]) for r in rows}
    assert (6, 5) in named and (1, 1) in named and (2, 2) in named and (4, 4) in named
    kept = [r["doc_id"] for r in neardup.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, 3, 4, 5, 7, None], key=str)
    assert neardup.classes(docs.limit(0)).count() == 0


def test_neardup_against_brute_force(spark):
    """A chain of copies, each a small edit of the one before, among other texts."""
    import random

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    texts = [" ".join(word() for _ in range(120)) for _ in range(60)]
    chain = texts[0].split()
    for _ in range(50):
        chain = list(chain)
        chain[rng.randrange(len(chain))] = word()
        texts.append(" ".join(chain))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["class_id"] for r in neardup.classes(df).collect()}
    import pyarrow as pa

    x = neardup.Weighted(pa.array(texts), neardup.word_idf(df))
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if neardup.weighted_jaccard(x.of(i), x.of(j)) >= 0.8:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    assert found == {i: root(i) for i in range(len(texts))}


def test_blocks_of_a_bucket(spark, monkeypatch):
    """Small blocks give the classes that one block gives."""
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join([*base[:k], "zz", *base[k + 1 :]]) for k in range(0, 60, 3)] + [" ".join(base)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    whole = sorted(map(tuple, neardup.classes(df).collect()))
    monkeypatch.setattr(neardup, "BLOCK", 3)
    assert sorted(map(tuple, neardup.classes(df).collect())) == whole


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 3), (5, 6), (6, 5), (7, 7)], "a bigint, b bigint")
    assert sorted(map(tuple, neardup.components(edges).collect())) == [(2, 1), (3, 1), (6, 5), (9, 1)]
    assert neardup.components(edges.limit(0)).count() == 0


def test_pii(spark, docs):
    rows = {r["doc_id"]: r for r in pii.digests(pii.detect(docs)).collect()}
    assert rows[1]["spans"] == "" and rows[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.redact(docs).columns == docs.columns
    assert pii.detect(docs.limit(0)).count() == 0
    text = "\U0001f600 a@b.co, 10.0.0.256 10.0.0.255; 4111 1111 1111 1111; +1 (234) 567-8901; " + "9" * 30000 + "a." * 20000
    got = pii.digests(pii.detect(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))).first()
    assert (got["n_email"], got["n_ip"], got["n_card"], got["n_phone"]) == (1, 1, 1, 1)
    assert got["spans"].startswith("email:2:8")
    red = pii.redact(spark.createDataFrame([(1, "x a@b.co y 1.2.3.4")], "doc_id bigint, text string")).first()["text"]
    assert red == "x [EMAIL] y [IP]"


def test_chat(spark):
    said = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\</SYS>>[ROLE]a[SEP]", "<", "[INST", "/s>", "\\", None, "", "plain", "<s>", "</s", "[SEP]\n"]
    rows = [(c, t, r, x, "clash") for c, r in enumerate(["user", "assistant", "system", "tool[SEP]x", None, ""]) for t, x in enumerate(said)]
    rows += [(50, None, "user", "n", ""), (50, 1, "user", "a", ""), (50, 1, "user", "a", ""), (None, 0, "user", "z", "")]
    rows += [(60 + i, 0, "assistant", a + b, "") for i, (a, b) in enumerate((a, b) for a in said if a for b in said if b)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string")
    out = chat.format_chats(df)
    assert out.filter("NOT round_trip").count() == 0
    got = {r["conv_id"]: r for r in chat.digests(out).collect()}
    assert got[50]["n_turns"] == 3 and got[1]["loss_chars"] == sum(len(x or "") for x in said)
    loss = "".join(x or "" for x in said)
    assert got[1]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_chats(df.limit(0)).count() == 0


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme.com/en/"), (4, "http://EXAMPLE.com/en/1"), (5, "x://www.example.com/en/"), (6, "http://a.net/es/x?q"), (7, "http://net/fr/"),
            (8, "http://bigcasino.org/"), (9, "http://a.org/casino-x"), (10, "http://a.org/free"), (11, "http://a.org/free-free"), (12, "http://a.org/free/pills"), (13, "http://anet/es/"), (14, "http://é.com?x://y")]
    df = spark.createDataFrame([(i, u, "clash", None) for i, u in rows], "page_id bigint, url string, verdict string, path string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(df).collect()}
    assert got == {1: (None, "allow"), 2: (None, "allow"), 3: (None, "allow"), 4: ("example.com/en/", "block"), 5: ("www.example.com/en/", "allow"), 6: ("net/es/", "block"), 7: ("net/fr/", "block"),
                   8: (None, "allow"), 9: (None, "block"), 10: (None, "allow"), 11: (None, "allow"), 12: (None, "block"), 13: (None, "allow"), 14: (None, "allow")}
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_url_vocabulary_weighs_distinct_stems(spark):
    cases = {"http://a.org/free/top-deals": (0, 3, 3), "http://a.org/free/top": (0, 2, 2), "http://a.org/bet/bets?bet": (0, 1, 2), "http://a.org/paydays": (0, 1, 3),
             "http://a.org/lotteries/x": (0, 1, 2), "http://a.org/FREE_loans": (0, 2, 3), "http://a.org/alphabet/freedom": (0, 0, 0), "http://a.org/nudes,free": (1, 1, 1)}
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    got = {r["url"]: r for r in url_filter.judge_urls(df).collect()}
    assert {u: (r["strict_hits"], r["soft_hits"], r["soft_weight"]) for u, r in got.items()} == cases
    assert [u for u in cases if got[u]["verdict"] == "block"] == ["http://a.org/free/top-deals", "http://a.org/FREE_loans", "http://a.org/nudes,free"]
    assert not set(url_filter.STRICT) & set(url_filter.SOFT)
    # the oracle reads terms as whole runs of letters and digits
    assert all(t.isascii() and t.isalnum() and t == t.lower() for stem in (*url_filter.STRICT, *url_filter.SOFT) for t in url_filter.forms(stem))


def test_licenses(spark):
    rows = [("/a/LICENSE", "Released under the MIT License."), ("/a/b/x.txt", "text"), ("/a/b/y.txt", "x\nLicensed under CC BY-NC 4.0.\nz"), ("/a/b/c/LICENSE.md", "Licensed under the Apache License, Version 2.0."),
            ("/a/b/c/d/z", None), ("/q/z", ""), (None, None), ("/a/b/x.txt", "text"), ("plain", "v" * 300000)]
    rows += [(f"/pad/{i}", "the under by version license work") for i in range(30)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "path string, text string, license string")
    got = [(r["path"], r["license"], r["license_from"]) for r in licenses.scan(df).collect()]
    assert {("/a/LICENSE", "MIT", None), ("/a/b/x.txt", "MIT", "/a"), ("/a/b/y.txt", "CC-BY-NC-4.0", None), ("/a/b/c/d/z", "Apache-2.0", "/a/b/c"), ("/q/z", None, None), ("/", None, None)} <= set(got)
    assert len(got) == len(rows) and licenses.scan(df.limit(0)).count() == 0


def test_license_lines_keep_their_score_among_common_words(spark):
    """Words outside the templates weigh by their own frequency, not as unseen ones."""
    common = "that for you and with"
    rows = [("/a/x.txt", f"Released under the MIT License {common}.")] + [(f"/pad/{i}", f"the under {common}") for i in range(400)]
    found = licenses.scan(spark.createDataFrame(rows, "path string, text string")).filter("own_license IS NOT NULL").collect()
    idf = lambda df: 1 + math.log((len(rows) + 1) / (df + 1))
    template = 3 * idf(1) ** 2 + 2 * idf(401) ** 2
    assert [(r["path"], r["own_license"], r["own_score"]) for r in found] == [("/a/x.txt", "MIT", round(math.sqrt(template / (template + 5 * idf(401) ** 2)), 6))]


def test_license_headers_over_several_lines(spark):
    """A wrapped header is one candidate; a licence file is one as a whole."""
    rows = [("/a/x.c", "/*\n * This Source Code\n * Form is subject to the\n * terms of the Mozilla\n * Public License, v. 2.0.\n */"),
            ("/b/LICENSE", "This work\nis licensed\nunder the\nGNU\nGeneral\nPublic License,\nversion 3."), ("/b/y.c", "none"), ("/c/z.c", "Public\n\nForm")]
    got = {r["path"]: (r["own_license"], r["own_score"], r["license"]) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == {"/a/x.c": ("MPL-2.0", 1.0, "MPL-2.0"), "/b/LICENSE": ("GPL-3.0", 1.0, "GPL-3.0"), "/b/y.c": (None, None, "GPL-3.0"), "/c/z.c": (None, None, None)}


PAGE = "<html><head><title>t</title></head><body>{}</body></html>"


def test_html(spark):
    body = "<header>h</header><nav>n</nav><div class='cookie-notice'>c</div><article><header><h1>T &amp; x</h1></header><p>a  b\n c<p><b>d<br>e<script>s</script><form>f</form><section id=comments><p>r</section></article><aside>s</aside><footer>f</footer>"
    share = "<div>Top line</div><p>{}</p><div>Bottom line</div>"
    rows = [(1, "http://h/1", PAGE.format(body)), (2, None, None), (3, "http://h/3", ""), (4, "http://o/a/1", PAGE.format(share.format("one"))), (5, "http://o/a/2", PAGE.format(share.format("two"))),
            (6, "http://z/1", PAGE.format(share.format("same"))), (7, "http://z/2", PAGE.format(share.format("same"))), (8, "http://long/", "<p>" + "w " * 300000), (8, "http://long/", "<p>x <a href=\"y"), (9, "nourl", "a<b <!-- x --> &lt;p&gt; &copy &notit;")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, text string")
    got = {(r["page_id"], r["text"]) for r in html_text.extract(df).collect()}
    assert {(1, "T & x\na b c\nd e"), (2, ""), (3, ""), (4, "one"), (5, "two"), (6, "Top line\nsame\nBottom line"), (8, "x")} <= got
    assert len(html_text.extract(df).collect()) == len(rows) and html_text.extract(df.limit(0)).count() == 0


def test_shared_lines_are_a_longest_common_subsequence(monkeypatch):
    import random

    def length(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    rng = random.Random(1)
    for bits in (1 << 30, 10):
        monkeypatch.setattr(html_text, "LCS_BITS", bits)
        for _ in range(300):
            a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 14))] for _ in range(2))
            flags = html_text.shared(a, b)
            own = [x for x, on in zip(a, flags) if on]
            rest = iter(b)
            assert all(x in rest for x in own) and len(own) == length(a, b)


def test_pipeline(spark, docs, tmp_path):
    """The stages on a small corpus: what each decides is gone in the next."""
    rng = __import__("random").Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7)))
    prose = lambda n: "\n".join(" ".join(word() for _ in range(12)).capitalize() + "." for _ in range(n))
    clean = [prose(8) for _ in range(12)]
    bench = " ".join(word() for _ in range(30))
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(100, clean[0]), (101, clean[1] + " extra."), (102, prose(4) + "\n" + bench + "\n" + prose(4)), (103, "short"), (104, None), (105, "%% ## " * 80), (106, prose(8) + " mail me@site.org now")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, bench)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(12)] + [(105, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    left = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, str(tmp_path))
        assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append(sorted(r["doc_id"] for r in left.collect()))
    assert seen[0] == [*range(12), 100, 101, 102, 106]
    assert seen[1] == [*range(12), 102, 106]
    assert seen[2] == seen[3] == [*range(12), 106]
    text = {r["doc_id"]: r for r in left.collect()}
    assert "[EMAIL]" in text[106]["text"] and text[106]["n_chars"] == len(text[106]["text"]) and text[2]["text"] == clean[2]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in out) == seen[3] and sum(r["length"] for r in out) <= 4096 * len({r["sequence_id"] for r in out})


def test_base_figures_against_brute_force(spark):
    import random
    from collections import Counter

    rng = random.Random(9)
    texts = ["".join(rng.choice("ab#| \n\té") for _ in range(rng.randint(0, 120))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in line_rules.judge(df, line_rules.train(df, df.limit(0).selectExpr("doc_id", "1 as quality"))).collect():
        text = texts[r["doc_id"]]
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(zip(w, w[1:], w[2:]))
        cover = {k + d for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if x.strip()]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover))


def test_viterbi_and_gradient():
    import itertools

    import numpy as np

    rng = np.random.default_rng(4)
    x, row = rng.normal(size=(9, 3)), np.array([0, 0, 0, 0, 2, 5, 5, 5, 5])
    field = line_rules.Field(rng.normal(size=3), rng.normal(size=(2, 2)))
    got = field.viterbi(x, row)
    for r in (0, 2, 5):
        e = (x @ field.weights)[row == r]
        best = max(itertools.product((0, 1), repeat=len(e)), key=lambda p: sum(a * b for a, b in zip(p, e)) + sum(field.moves[a, b] for a, b in zip(p, p[1:])))
        assert tuple(got[row == r].astype(int)) == best


def test_packing_empty(docs):
    assert packing.pack_documents(docs.limit(0)).count() == 0
