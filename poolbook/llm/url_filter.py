"""URL filter (operator 2): longest host/path rule, else a weighted vocabulary.

Method: one Aho-Corasick automaton over all vocabulary terms scans the
lower-cased URL.  Terms are the stems of the vocabulary and their plurals.  A hit
counts only between boundaries (no ASCII letter or digit directly before or after
it).  One strict hit rejects; soft stems carry weights and reject when at least
``soft_hits`` *distinct* ones stand in the URL and their weights add up to
``soft_limit``: two everyday words do not, one of them beside a telling one does.
Explicit rules go first: a rule ``host/path`` fits its host and
every subdomain when the URL's path starts with the rule's path, and the longest
fitting rule decides.

Defined results: a null URL, or one without ``://``, has empty host and path, no
rule fits it; a null or empty URL is allowed by the vocabulary.  Repeated rows
are judged one by one.  Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values: (rule, verdict) pairs of the URL query.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: One hit rejects.
STRICT = tuple("""
    adult bdsm bukkake camgirl camsex casino cuckold escort fetish gambling gangbang hentai hookup incest milf
    naked nsfw nude orgy porn porno sexcam sexchat striptease upskirt voyeur webcamsex xnxx xrated xxx
    cialis levitra tramadol viagra xanax
    botnet carding cracked cryptolocker exploitkit fullz keygen keylogger malware nulled phishing ransomware
    rootkit spyware trojan warez
""".split())
#: Soft stems by weight: 1 everyday words, 2 telling ones, 3 those that hardly stand elsewhere.
SOFT = {stem: weight for weight, stems in {
    1: """
        ad affiliate babe bargain best bonus boost buy cash cheap click coin coupon crack credit date deal diet
        discount dose earn easy extra farm fast forex free girl gift guarantee hot income instant lucky money
        offer online play popup prize profit promo quick rate referral reward rich sale save single spin stake
        ticket top track trade trial video vip wager weight win winner
    """,
    2: """
        arcade baccarat bet betting bingo bitcoin blackjack bookmaker clickbait crypto debt dating download
        fling flirt giveaway jackpot lingerie loan lottery lotto mega mortgage pharma pharmacy pill pirate poker
        refinance roulette serial slot spam sportsbook stream supplement sweepstake torrent weightloss
    """,
    3: """
        backlink blackhat cashadvance doorway freebet freespin linkfarm moneymaker onlinepharmacy payday paydayloan
        replica sexy sideload steroid strip toplist traffic unsecured
    """,
}.items() for stem in stems.split()}
#: Distinct soft stems and sum of their weights from which they reject.
SOFT_HITS = 2
SOFT_LIMIT = 3


def forms(stem: str) -> tuple[str, str]:
    """A stem and its plural, both terms of the automaton."""
    if stem.endswith(("s", "x", "ch", "sh")):
        return stem, stem + "es"
    if stem.endswith("y") and stem[-2:-1] not in tuple("aeiou"):
        return stem, stem[:-1] + "ies"
    return stem, stem + "s"


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``; both empty without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    return df.withColumns({
        "host": _lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    })


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), else null."""
    out = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        at, slash, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        out = out.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
    return out


def vocabulary_scan(strict: Sequence[str], soft: Mapping[str, int]):
    """Pandas UDF url -> struct(strict_hits, soft_hits, soft_weight)."""
    strict, soft = tuple(strict), dict(soft)

    @F.pandas_udf("strict_hits int, soft_hits int, soft_weight int")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        find = ahocorasick.Automaton()
        for stem in (*soft, *strict):  # a stem in both is strict
            for term in forms(stem):
                find.add_word(term, (stem, len(term)))
        find.make_automaton()
        edge = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
        hard = frozenset(strict)

        def hits(url: str | None) -> tuple[int, int, int]:
            url = url or ""
            seen: set[str] = set()
            n_strict = 0
            for end, (stem, length) in find.iter(url):
                start = end - length + 1
                if (start and url[start - 1] in edge) or (end + 1 < len(url) and url[end + 1] in edge):
                    continue
                if stem in hard:
                    n_strict += 1
                else:
                    seen.add(stem)
            return n_strict, len(seen), sum(soft[t] for t in seen)

        for urls in batches:
            yield pd.DataFrame([hits(u) for u in urls], columns=["strict_hits", "soft_hits", "soft_weight"]).astype("int32")

    return scan


def judge_urls(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES,
               strict: Sequence[str] = STRICT, soft: Mapping[str, int] = SOFT, soft_hits: int = SOFT_HITS, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """Add host, path, strict_hits, soft_hits, soft_weight, rule and verdict to ``pages``."""
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "strict_hits", "soft_hits", "soft_weight")]
    df = with_host_path(pages.select(*own), url).withColumns({
        "_rule": rule_of(F.col("host"), F.col("path"), rules),
        "_hits": vocabulary_scan(strict, soft)(_lower(F.col(url))),
    })
    several = (F.col("_hits.soft_hits") >= soft_hits) & (F.col("_hits.soft_weight") >= soft_limit)
    by_method = F.when((F.col("_hits.strict_hits") > 0) | several, "block").otherwise("allow")
    return df.select(
        *own, "host", "path", "_hits.strict_hits", "_hits.soft_hits", "_hits.soft_weight",
        F.col("_rule.rule").alias("rule"), F.coalesce(F.col("_rule.verdict"), by_method).alias("verdict"),
    )


def oracle() -> str:
    """DuckDB SQL of the query: terms are letters only, so a hit between boundaries is a
    whole run of letters and digits."""
    text = lambda stem: "[" + ", ".join(f"'{t}'" for t in forms(stem)) + "]"
    strict = "list_has_any(runs, flatten([" + ", ".join(map(text, STRICT)) + "]))"
    soft = "[" + ", ".join(f"{{'weight': {w}, 'terms': {text(t)}}}" for t, w in SOFT.items()) + "]"
    cases = lambda k: " ".join(
        f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) "
        f"AND starts_with(path, '/{r.partition('/')[2]}') THEN '{(r, v)[k]}'"
        for r, v in sorted(RULES, key=lambda x: (-len(x[0]), x[0])))
    return f"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest,
         regexp_extract_all(translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+') AS runs
  FROM pages
), p AS (
  SELECT page_id, runs,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), j AS (
  SELECT *, CASE {cases(0)} END AS rule, CASE {cases(1)} END AS by_rule, {strict} AS hard, [s.weight for s in {soft} if list_has_any(runs, s.terms)] AS found FROM p
)
SELECT page_id, host, path, rule,
       coalesce(by_rule, CASE WHEN hard OR (len(found) >= {SOFT_HITS} AND list_sum(found) >= {SOFT_LIMIT}) THEN 'block' ELSE 'allow' END) AS verdict
FROM j"""
