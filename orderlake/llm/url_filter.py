"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` together with the literal tokens (runs of
a-z and 0-9, bounded on both sides) that every matching URL must contain.  The rule is filed under the
token that is rarest among the URLs.  A URL's own tokens fetch the candidate rules, and only those run
their regular expression.  Everything is Spark SQL expressions on the main path: the index is one
array of hash buckets, looked up per token, so a scan needs no shuffle and no join.

The index goes into the plan as one JSON text, which Catalyst reads once, when it folds constants, so
thousands of rules are planned as fast as ten.  The rule set is a parameter whose size is checked
(``MAX_RULES``, a few MB with every task); it does not grow with the pages.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 20_000
_RULE_TYPE = "struct<token:string,pattern:string,priority:int,name:string,verdict:string>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``name`` is reported; ``tokens`` are implied by ``pattern``; higher ``priority`` wins."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    priority: int


def quote(text: str) -> str:
    """``text`` as a literal inside a regular expression."""
    return re.sub(r"([^A-Za-z0-9_/-])", r"\\\1", text)


def bounded_tokens(text: str, closed: bool) -> tuple[str, ...]:
    """Tokens of a literal; the last one only counts if the literal is closed by a separator."""
    found = [(m.group(), m.end()) for m in re.finditer("[a-z0-9]+", text.lower())]
    return tuple(t for t, end in found if end < len(text) or closed)


def path_rule(verdict: str, rule: str, priority: int = 0) -> Rule:
    """``host/path`` rule: the host and all its subdomains, paths that start with the path; longer rules win."""
    host, path = rule[:rule.index("/")], rule[rule.index("/"):]
    return Rule(rule, verdict, rf"(?s)^(?:[^/]*\.)?{quote(host)}{quote(path)}", bounded_tokens(rule, False), priority + len(rule))


def host_word_rule(verdict: str, *words: str) -> Rule:
    """Hosts with a label of these words joined by hyphens or standing next to other hyphenated words."""
    phrase = "-".join(words)
    return Rule(phrase, verdict, rf"(?s)^(?:[^/]*[.-])?{quote(phrase)}(?:[.-][^/]*)?(?:/|\z)", words, 0)


def path_phrase_rule(verdict: str, *words: str) -> Rule:
    """Paths with a segment of these words joined by hyphens or underscores, A-Z in any case, an extension apart."""
    phrase = "[-_]".join(quote(w) for w in words)
    return Rule("/" + "-".join(words), verdict, rf"(?i)/{phrase}(?:[/.]|\z)", words, 0)


@dataclass(frozen=True)
class Theme:
    """Words that mark a kind of site: alone in a host, or as ``first``-``last`` phrases in a host or path."""

    alone: str
    first: str
    last: str

    def rules(self, verdict: str) -> list[Rule]:
        pairs = [(a, b) for a in self.first.split() for b in self.last.split() if a != b]
        return [*(host_word_rule(verdict, w) for w in self.alone.split()), *(host_word_rule(verdict, *p) for p in pairs),
                *(path_phrase_rule(verdict, *p) for p in pairs)]


#: The rules of the contract: host, then path.
BASE_RULES = (path_rule("block", "net/", 1000), path_rule("allow", "example.net/en/", 1000),
              path_rule("block", "example.com/de/", 1000), path_rule("allow", "org/fr/", 1000))
#: Kinds of sites that a corpus does without.  Words with an everyday meaning only count in phrases.
THEMES = {
    "gambling": Theme("casino casinos poker roulette blackjack jackpot sportsbook",
                      "free online live best real mobile lucky mega royal vegas top bonus win big",
                      "casino casinos bet bets betting poker slots slot bingo roulette lottery lotto jackpot gambling spins wager"),
    "medicines": Theme("pills viagra cialis tramadol xanax",
                       "cheap buy order discount generic online best canadian fast herbal diet weightloss",
                       "pills pill meds pharmacy viagra cialis drugs drugstore tablets steroids tramadol xanax"),
    "adult": Theme("porn porno xxx sex camgirls escorts nsfw",
                   "adult free live hot sexy amateur nude teen erotic mature xxx local",
                   "adult porn porno x xxx sex cams cam video videos tube chat dating girls escorts singles"),
    "advertising": Theme("adserver adservice adtrack adtracker doubleclick popunder popads clickbank",
                         "ad ads adv advert banner click popup pixel affiliate promo sponsor retarget",
                         "track tracker tracking server serve service click clicks network exchange delivery pixel redirect rotator syndication"),
    "spam": Theme("spam spammer linkfarm clickfarm",
                  "spam link click seo bulk email traffic backlink follower keyword",
                  "farm farms bot bots blast network exchange generator spam booster mailer sender"),
    "money": Theme("getrich payday",
                   "easy fast quick instant payday guaranteed earn free bitcoin crypto forex binary",
                   "cash money loan loans profit profits doubler giveaway payout riches income millionaire signals"),
    "software": Theme("warez keygen keygens crackz",
                      "free full cracked crack serial keygen torrent pirate nulled",
                      "crack cracks keygen serial serials warez torrent torrents downloadz nulled activator"),
}


def themed_rules(themes: Iterable[Theme] = tuple(THEMES.values()), verdict: str = "block") -> tuple[Rule, ...]:
    """All rules of the themes, each once."""
    return tuple({r.name: r for theme in themes for r in theme.rules(verdict)}.values())


#: What the filter itself blocks where no base rule speaks.
SPAM_RULES = themed_rules()


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for NULL or without ``://``."""
    return F.coalesce(F.regexp_extract(url, "(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(target: Column) -> Column:
    """Distinct tokens of ``host + path``."""
    return F.array_distinct(F.regexp_extract_all(F.translate(target, _UPPER, _LOWER), F.lit("([a-z0-9]+)"), F.lit(1)))


def _buckets(filed: Iterable[tuple[str, object]], item_type: str) -> tuple[Column, int]:
    """(constant array of hash buckets, number of buckets) of items filed under tokens."""
    filed = list(filed)
    size = 1
    while size < 2 * len(filed):
        size *= 2
    buckets: list[list] = [[] for _ in range(size)]
    for token, item in filed:
        buckets[zlib.crc32(token.encode()) % size].append(item)
    return F.from_json(F.lit(json.dumps(buckets)), f"array<array<{item_type}>>"), size


def _bucket_of(index: tuple[Column, int], token: Column) -> Column:
    return F.element_at(index[0], (F.crc32(token) % index[1] + 1).cast("int"))


def token_counts(pages: DataFrame, rules) -> dict[str, int]:
    """How many URLs hold each token that some rule has (at most one row per rule token reaches the driver)."""
    wanted = sorted({t for r in rules for t in r.tokens})
    known = _buckets(((t, t) for t in wanted), "string")
    target = F.concat(host_of(F.col("url")), path_of(F.col("url")))
    # only a rule's own tokens leave the row, so the partial count per task is as small as the rule set
    hits = F.filter(tokens_of(target), lambda t: F.array_contains(_bucket_of(known, t), t))
    rows = pages.select(F.explode(hits).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()
    return {t: 0 for t in wanted} | {r["token"]: r["n"] for r in rows}


def rule_index(rules, counts: dict[str, int]) -> tuple[Column, int]:
    """Constant array of hash buckets, each an array of rule structs filed under their rarest token, and its size."""
    rules = list(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} fit a plan")
    filed = []
    for rule in rules:
        if not rule.tokens:
            raise ValueError(f"rule {rule.name!r} has no literal token to be indexed by")
        token = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
        filed.append((token, {"token": token, "pattern": rule.pattern, "priority": rule.priority, "name": rule.name, "verdict": rule.verdict}))
    return _buckets(filed, _RULE_TYPE)


def candidates(target: Column, rules, counts: dict[str, int]) -> Column:
    """Rules whose rarest token the URL has: the only ones whose patterns run."""
    index = rule_index(rules, counts)
    return F.flatten(F.transform(tokens_of(target), lambda t: F.filter(_bucket_of(index, t), lambda r: r["token"] == t)))


def best_rule(target: Column, rules, counts: dict[str, int]) -> Column:
    """Struct (priority, name, verdict) of the matching rule with the highest priority, else NULL."""
    matching = F.filter(candidates(target, rules, counts), lambda r: F.rlike(target, r["pattern"]))
    return F.array_max(F.transform(matching, lambda r: F.struct(r["priority"], r["name"], r["verdict"])))


def judge(pages: DataFrame, base=BASE_RULES, own=SPAM_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row.

    ``rule`` is the longest matching base rule; without one it is NULL and the filter's own rules
    decide: block if one matches, else allow.  URLs of any length are judged whole.  A NULL url or one without ``://`` has an empty host and
    path, which match nothing.  Ties between rules go to the greater name.
    """
    counts = token_counts(pages, [*base, *own])
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    best = parts.withColumn("best", best_rule(F.concat("host", "path"), [*base, *own], counts))
    named = F.col("best.priority") >= 1000
    return best.select("page_id", "host", "path", F.when(named, F.col("best.name")).alias("rule"),
                       F.coalesce(F.col("best.verdict"), F.lit("allow")).alias("verdict"))


def _themes_sql() -> str:
    """The themes' rules as conditions on host and path, one alternation per theme."""
    alone = ", ".join(f"'{w}'" for t in THEMES.values() for w in t.alone.split())
    out = [f"list_has_any(string_split_regex(host, '[.-]'), [{alone}])"]
    for t in THEMES.values():
        for column, begin, join, end in (("host", "(?:^|[.-])", "-", r"(?:[.-]|\z)"), ("lower_path", "/", "[-_]", r"(?:[/.]|\z)")):
            # a word does not pair with itself
            pairs = "|".join(f"{a}{join}(?:{'|'.join(b for b in t.last.split() if b != a)})" for a in t.first.split())
            out.append(f"regexp_matches({column}, '{begin}(?:{pairs}){end}')")
    return "\n      OR ".join(out)


JUDGE_SQL = rf"""
WITH cut AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)://([^/?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)://[^/?#]*([^?#]*)', 1), '') AS path,
         translate(coalesce(regexp_extract(url, '(?s)://[^/?#]*([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_path
  FROM pages),
named AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM cut)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN {_themes_sql()} THEN 'block'
    ELSE 'allow' END AS verdict
FROM named
"""
