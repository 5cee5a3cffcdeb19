r"""Personal data (operator 7): weak supervision over candidate spans.

Candidates per text, with code point offsets: the matches of four base patterns
(email, ip, card, phone), digit runs that are no valid card (``number``) and
long mixed runs of letters and digits (``secret``).  Base matches that pass
their check (octets, Luhn, digit counts) are always spans.  The rest is decided
by a method trained on the corpus itself:

1. Five labelers vote +1, 0 or -1 on every candidate: a format check (regex), a
   gazetteer of cue words before it, one of counter words, the characters
   around it (context), and its variety of characters.
2. Votes are counted per pattern of (kind, votes, length class) over all rows: a
   table of fixed size.  Expectation-maximisation on it estimates the share of
   real spans of each kind and how often each labeler is right, in the manner
   of Dawid and Skene with one reliability a labeler.
3. A logistic span classifier is fitted to the posteriors, and its score decides
   on every candidate that is not a base span and overlaps none.

Candidates come from Spark SQL string and array functions alone.  Patterns have
possessive loops and start where a run starts, so long runs neither backtrack
nor recurse.  A text's spans are built by one fold over its matches.

Defined results: null text is empty and has no spans; repeated rows are judged
one by one; a table without candidates fits no weights and adds no span.
Further columns of the input are not read by ``detect`` and are kept by
``redact``, which fills ``text`` with ``[KIND]`` in place of spans.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolbook.llm.common import stored

#: The base patterns, with possessive loops where no shorter match exists.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])(?=[0-9]*+[A-Za-z])[A-Za-z0-9]{20,}+",
}
#: Kinds in the order that breaks ties between spans with one start.
KINDS = ("email", "ip", "card", "phone", "number", "secret")
BASE = KINDS[:4]
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Last words before a span that speak for and against it.
CUES = ("account", "acct", "api", "apikey", "bearer", "card", "contact", "credit", "cuenta", "iban", "karte", "key", "konto", "mail", "passport", "passwd", "password", "phone", "pwd", "secret", "ssn", "tel", "token", "visa")
COUNTERS = ("article", "build", "chapter", "commit", "figure", "isbn", "issn", "issue", "page", "pages", "part", "release", "revision", "section", "table", "version", "vol", "volume")
LABELERS = ("format", "cues", "counters", "context", "variety")
ROUNDS = 60
_SPAN = "struct<kind:string,start:int,end:int,base:boolean,votes:array<int>,size:int>"


def _matches(text: Column, kind: str, guard: Column) -> tuple[Column, Column]:
    """(matches, pieces around them); pieces are one more than matches."""
    none = F.array().cast("array<string>")
    return (F.when(guard, F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))).otherwise(none),
            F.split(text, PATTERNS[kind], -1))


def _located(hits: Column, pieces: Column) -> Column:
    """array<struct<start, end, hit, before, after>> of the matches."""
    kind = "array<struct<start:int,end:int,hit:string,before:string,after:string>>"
    empty = F.array().cast(kind)

    def step(acc: Column, i: Column) -> Column:
        piece, hit = F.get(pieces, i), F.get(hits, i)
        start = acc["at"] + F.length(piece)
        end = start + F.length(hit)
        found = F.struct(start.alias("start"), end.alias("end"), hit.alias("hit"), F.substring(piece, -24, 24).alias("before"),
                         F.substring(F.get(pieces, i + 1), 1, 1).alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(found)).cast(kind).alias("out"))

    fold = F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda a: a["out"])
    return F.when(F.size(hits) > 0, fold).otherwise(empty)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    d = F.reverse(_digits(hit))

    def add(acc: Column, i: Column) -> Column:
        x = F.substring(d, i, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return acc + F.when(i % 2 == 0, twice).otherwise(x)

    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add)
    return F.when(F.length(d).between(14, 19), total % 10 == 0).otherwise(False)


def _passes(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    if kind == "card":
        return _luhn(hit)
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    return F.lit(kind == "email")


def _votes(kind: str, m: Column, good: Column) -> Column:
    word = F.lower(F.regexp_extract(m["before"], r"([\p{L}_]+)[^\p{L}\n]{0,6}$", 1))
    last = F.substring(m["before"], -1, 1)
    n = F.length(m["hit"])
    distinct = F.size(F.array_distinct(F.split(F.lower(m["hit"]), "")))
    if kind == "secret":
        form = F.when(m["hit"].rlike("^(?:[0-9a-f]++|[0-9A-F]++)$") & n.isin(32, 40, 48, 56, 64, 96, 128), 1).otherwise(F.when(n >= 32, 0).otherwise(-1))
        context = F.when(last.isin('"', "'", "=", ":", "`"), 1).when(m["after"].rlike(r"^[\p{L}_]"), -1).otherwise(0)
        variety = F.when(distinct >= 10, 1).otherwise(-1)
    elif kind in ("card", "number"):
        form = F.when(good, 1).when(F.length(_digits(m["hit"])).between(13, 19), 0).otherwise(-1)
        context = F.when(last.rlike(r"^[\p{L}._/#$+-]$") | m["after"].rlike(r"^[\p{L}_/%]$"), -1).when(m["hit"].rlike(r"^[0-9]{4}([\x20-]?[0-9]{4}){3}$"), 1).otherwise(0)
        variety = F.when(distinct >= 5, 1).otherwise(-1)
    else:
        form = F.when(good, 1).otherwise(-1)
        context = F.when(last.rlike(r"^[\p{L}0-9]$") | m["after"].rlike(r"^[\p{L}0-9]$"), -1).otherwise(1)
        variety = F.when(distinct >= 4, 1).otherwise(-1)
    return F.array(form, F.when(word.isin(*CUES), 1).otherwise(0), F.when(word.isin(*COUNTERS), -1).otherwise(0), context, variety).cast("array<int>")


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_found``: all candidates of the text as array of
    (kind, start, end, base, votes, size)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digit = text.rlike("[0-9]")
    guards = {"email": F.instr(text, "@") > 0, "ip": digit, "card": digit, "phone": F.instr(text, "+") > 0, "secret": digit}
    df = docs.withColumns({f"_m_{k}": _matches(text, k, guards[k])[0] for k in PATTERNS})
    df = df.withColumns({f"_l_{k}": _located(F.col(f"_m_{k}"), _matches(text, k, guards[k])[1]) for k in PATTERNS})

    def of(kind: str):
        def one(m: Column) -> Column:
            good = _passes(kind, m["hit"])
            name = F.when(good, "card").otherwise("number") if kind == "card" else F.lit(kind)
            return F.struct(name.alias("kind"), m["start"].alias("start"), m["end"].alias("end"), good.alias("base"),
                            _votes(kind, m, good).alias("votes"), F.length(m["hit"]).alias("size")).cast(_SPAN)

        return one

    parts = [F.transform(f"_l_{kind}", of(kind)) for kind in PATTERNS]
    # digit runs too short for a number of a person or a card are no candidates
    found = F.filter(F.concat(*parts), lambda c: c["base"] | (c["kind"] != "number") | (c["size"] >= 9))
    return df.withColumn("_found", found).drop(*[f"_{x}_{k}" for k in PATTERNS for x in "ml"])


def _length_class(size: Column) -> Column:
    return F.least(F.lit(7), (size / 8).cast("int"))


Counts = Sequence[tuple[str, tuple[int, ...], int, int]]


def vote_counts(found: DataFrame) -> Counts:
    """(kind, votes, length class, candidates): at most 6 * 3^5 * 8 rows."""
    c = found.select(F.explode("_found").alias("c")).select("c.kind", "c.votes", _length_class(F.col("c.size")).alias("size"))
    rows = c.groupBy("kind", "votes", "size").agg(F.count("*").alias("n")).collect()
    return sorted((r["kind"], tuple(r["votes"]), r["size"], r["n"]) for r in rows)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def reliabilities(counts: Counts, rounds: int = ROUNDS) -> tuple[dict[str, float], list[float], list[float]]:
    """(share of real spans per kind, reliability per labeler, posterior per
    count) by expectation-maximisation; a labeler that abstains says nothing."""
    right = [0.8] * len(LABELERS)
    prior = dict.fromkeys((c[0] for c in counts), 0.5)
    posterior: list[float] = []
    for _ in range(rounds):
        posterior = []
        for kind, votes, _, _ in counts:
            odds = math.log(prior[kind] / (1 - prior[kind]))
            odds += sum(v * math.log(r / (1 - r)) for v, r in zip(votes, right))
            posterior.append(_sigmoid(odds))
        for kind in prior:  # one pseudo-count on either side
            own = [(p, c[3]) for p, c in zip(posterior, counts) if c[0] == kind]
            prior[kind] = (1 + sum(p * n for p, n in own)) / (2 + sum(n for _, n in own))
        for k in range(len(right)):
            hit = sum((p if c[1][k] > 0 else 1 - p) * c[3] for p, c in zip(posterior, counts) if c[1][k])
            of = sum(c[3] for c in counts if c[1][k])
            # starts and stays better than chance, which fixes which class is which
            right[k] = min(0.99, max(0.55, (4 + hit) / (5 + of)))
    return prior, right, posterior


def features(kind: str, votes: Sequence[int], size: int) -> list[float]:
    return [*(float(kind == k) for k in KINDS), *map(float, votes), size / 8]


def fit(counts: Counts, steps: int = 400) -> list[float]:
    """Weights of the span classifier, fitted to the posteriors; zeros without data."""
    weights = [0.0] * (len(KINDS) + len(LABELERS) + 1)
    if not counts:
        return weights
    _, _, target = reliabilities(counts)
    rows = [features(*c[:3]) for c in counts]
    mass = [math.log1p(c[3]) for c in counts]
    total = sum(mass)
    for _ in range(steps):
        slope = [0.0] * len(weights)
        for x, y, n in zip(rows, target, mass):
            off = n * (_sigmoid(sum(w * v for w, v in zip(weights, x))) - y)
            for i, v in enumerate(x):
                slope[i] += off * v
        weights = [w - 2.0 * (g / total + 1e-4 * w) for w, g in zip(weights, slope)]
    return weights


def _score(c: Column, weights: Sequence[float]) -> Column:
    kinds, votes, size = weights[: len(KINDS)], weights[len(KINDS) : -1], weights[-1]
    out = size / 8 * _length_class(c["size"])
    for k, w in zip(KINDS, kinds):
        out = out + F.when(c["kind"] == k, w).otherwise(0.0)
    for i, w in enumerate(votes):
        out = out + w * F.get(c["votes"], F.lit(i))
    return out


def decide(found: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Replace ``_found`` by ``spans``: array of (start, rank, kind, end, base),
    sorted; rank is the kind's place in ``KINDS``."""
    base = F.filter("_found", lambda c: c["base"])
    more = F.filter("_found", lambda c: (~c["base"]) & ~c["kind"].isin(*BASE) & (_score(c, weights) > 0))
    free = F.filter("_more", lambda c: ~F.exists("_base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    row = lambda c: F.struct(c["start"].alias("start"), F.element_at(rank, c["kind"]).alias("rank"), c["kind"].alias("kind"), c["end"].alias("end"), c["base"].alias("base"))
    df = found.withColumns({"_base": base, "_more": more})
    return df.withColumn("spans", F.array_sort(F.transform(F.concat("_base", free), row))).drop("_found", "_base", "_more")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans of every row.  Candidates are written once; the model is
    fitted to their counts."""
    found = stored(candidates(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).drop("text"), "candidates")
    return decide(found, fit(vote_counts(found)))


def redact(docs: DataFrame, text_col: str = "text", weights: Sequence[float] | None = None) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind, e.g. ``[EMAIL]``;
    overlapping spans become one replacement, named by the first."""
    found = candidates(docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text")))
    df = decide(found, fit(vote_counts(found)) if weights is None else weights)
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        gap = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(gap))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    clean = F.aggregate("spans", start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))))
    changed = F.when(F.size("spans") > 0, clean).otherwise(text)
    return df.select(*[(changed if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])


def digests(detected: DataFrame) -> DataFrame:
    listed = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return detected.select("doc_id", *map(count, BASE), F.sha2(listed(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
