"""URL filter: host/path rules first, then a weighted vocabulary.

The vocabulary is matched by an Aho-Corasick automaton over the URL with A-Z
lower-cased. A term counts only between boundaries (the start, the end, or a
character other than a-z and 0-9). One strict term rejects; soft terms
reject when at least ``min_soft`` different ones occur and their weights sum
to ``min_weight``.

The vocabulary may be the one below or a table of (term, weight), where a null
weight makes a term strict (``Vocabulary.from_table``).

Cases: a null URL, or one without ``://``, has an empty host and path and no
term is looked up in a null; such a URL is allowed unless a term occurs in
it. URLs of any length are read whole. Of rules of equal length the first
given wins; a term that is strict and soft is strict. Repeated rows are
judged one by one, an empty table gives an empty
table, and the input's other columns are kept by ``judge_urls`` (an input
column with the name of a result is replaced).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TERM = re.compile("[a-z0-9]+(?:-[a-z0-9]+)*")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path)
DEFAULT_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Terms that reject alone (adult, betting, malware and piracy sites).
STRICT = (
    "adult", "adultvideo", "bdsm", "botnet", "bukkake", "cam-girls", "camgirl", "camgirls",
    "camsex", "casino", "cracked-software", "crackz", "cumshot", "deepfake-porn",
    "ddos-for-hire", "escort", "escorts", "exploit-kit", "fake-id", "fetish", "fuck", "gangbang",
    "hardcore", "hentai", "hookup", "hookups", "incest", "keygen", "keygens", "keylogger",
    "livesex", "malware", "milf", "milfs", "nsfw", "nude", "nudes", "online-casino", "orgy",
    "phish", "phishing", "porn", "porno", "pornos", "pornhub", "ransomware", "rapidgator",
    "serialz", "sex", "sexcam", "sexcams", "sexchat", "sexshop", "shemale", "slots", "spam",
    "spyware", "stripper", "strippers", "swinger", "swingers", "trojan", "viagra", "warez",
    "webcam-sex", "xnxx", "xvideos", "xxx",
)
#: Terms that several make a rejection, by how much each says.
SOFT = {
    "ad": 0.5, "ads": 0.75, "adserver": 0.75, "affiliate": 0.5, "affiliates": 0.5, "amateur": 0.5,
    "auto-approve": 0.75, "babe": 0.5, "babes": 0.75, "backlinks": 0.75, "bet": 0.75, "bets": 0.75,
    "betting": 0.75, "bikini": 0.5, "bingo": 0.75, "bitcoin": 0.5, "blackjack": 0.75, "bonus": 0.5,
    "bookmaker": 0.75, "buy-now": 0.5, "cash": 0.5, "cheap": 0.5, "cheapest": 0.5, "cialis": 0.75,
    "click": 0.5, "clickbait": 0.75, "clicks": 0.5, "coupon": 0.5, "coupons": 0.5, "crack": 0.5,
    "cracked": 0.75, "credit": 0.5, "crypto": 0.5, "dating": 0.75, "deal": 0.5, "deals": 0.5,
    "detox": 0.5, "diet": 0.5, "discount": 0.5, "discounts": 0.5, "doubleclick": 0.75,
    "earn-money": 0.75, "erotic": 0.75, "erotica": 0.75, "forex": 0.75, "free": 0.5,
    "freebie": 0.5, "freebies": 0.5, "gambling": 0.75, "get-rich": 0.75, "giveaway": 0.5,
    "girls": 0.5, "hot": 0.5, "jackpot": 0.75, "kinky": 0.75, "lesbian": 0.5, "levitra": 0.75,
    "lingerie": 0.5, "loan": 0.5, "loans": 0.5, "lottery": 0.75, "lotto": 0.75, "mature": 0.5,
    "mortgage": 0.5, "naked": 0.75, "naughty": 0.75, "nulled": 0.75, "odds": 0.5,
    "paid-to-click": 0.75, "payday": 0.75, "penny-stocks": 0.75, "pharmacy": 0.5, "pill": 0.5,
    "pills": 0.75, "playboy": 0.5, "poker": 0.75, "popup": 0.5, "popups": 0.5, "prize": 0.5,
    "prizes": 0.5, "promo": 0.5, "promos": 0.5, "proxy-list": 0.75, "replica": 0.75,
    "replicas": 0.75, "roulette": 0.75, "sale": 0.5, "seduce": 0.5, "seo-links": 0.75,
    "serial-key": 0.75, "sexy": 0.75, "singles": 0.5, "slot": 0.5, "sportsbook": 0.75,
    "steroids": 0.75, "sweepstakes": 0.75, "teen": 0.5, "teens": 0.5, "thumbs": 0.5,
    "torrent": 0.5, "torrents": 0.5, "track": 0.5, "tracker": 0.5, "trackers": 0.5,
    "unlimited": 0.5, "viral": 0.5, "wager": 0.75, "weight-loss": 0.5, "win": 0.5, "winner": 0.5,
    "winners": 0.5,
}
#: Terms that a vocabulary from a table may have: what a task's automaton can hold.
MAX_TERMS = 1_000_000


@dataclass(frozen=True)
class Vocabulary:
    """Terms of a-z, 0-9 and inner hyphens; ``strict`` ones reject alone."""

    strict: Sequence[str] = STRICT
    soft: Mapping[str, float] = field(default_factory=lambda: dict(SOFT))
    min_soft: int = 2
    min_weight: float = 1.0

    @classmethod
    def from_table(cls, terms: DataFrame, min_soft: int = 2, min_weight: float = 1.0,
                   max_terms: int = MAX_TERMS) -> Vocabulary:
        """The vocabulary of a table of ``term`` (any case) and ``weight``
        (null: strict). Null and empty terms are passed over, of a repeated
        term the strict, else the largest weight counts. A term with other
        characters, or more than ``max_terms`` terms, raise."""
        found = terms.select(F.translate("term", UPPER, LOWER).alias("term"),
                             F.col("weight").cast("double")).filter("term <> ''")
        found = found.groupBy("term").agg(F.max("weight").alias("weight"),
                                          F.max(F.isnull("weight")).alias("strict"))
        rows = found.limit(max_terms + 1).collect()
        if len(rows) > max_terms:
            raise ValueError(f"more than {max_terms} terms")
        bad = [r["term"] for r in rows if not TERM.fullmatch(r["term"])]
        if bad:
            raise ValueError(f"terms are of a-z, 0-9 and inner hyphens: {sorted(bad)[:5]}")
        return cls(tuple(sorted(r["term"] for r in rows if r["strict"])),
                   {r["term"]: r["weight"] for r in sorted(rows) if not r["strict"]},
                   min_soft, min_weight)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.soft.items():
            found.add_word(term, (term, False, weight))
        for term in self.strict:
            found.add_word(term, (term, True, 0.0))
        found.make_automaton()
        return found


def bounded_terms(automaton: ahocorasick.Automaton, text: str) -> dict[str, tuple[bool, float]]:
    """The different terms in ``text`` (lower-cased) that stand between
    boundaries, with (strict, weight)."""
    inner = LOWER + "0123456789"
    out: dict[str, tuple[bool, float]] = {}
    for end, (term, strict, weight) in automaton.iter(text):
        start = end - len(term) + 1
        if (start == 0 or text[start - 1] not in inner) and (
                end + 1 == len(text) or text[end + 1] not in inner):
            out[term] = (strict, weight)
    return out


def url_host(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_expr(host: Column, path: Column, rules, value) -> Column:
    """``value(verdict, host, path)`` of the longest rule that fits, else
    null; rules of equal length are tried in the order given."""
    out = F.lit(None).cast("string")
    # what is added last is asked first: the longest, and of equal ones the first given
    for verdict, rule_host, rule_path in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.lit(value(verdict, rule_host, rule_path))).otherwise(out)
    return out


def _hits(vocabulary: Vocabulary):
    @F.pandas_udf("strict_hits int, soft_hits int, soft_weight double")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = vocabulary.automaton()
        for urls in batches:
            rows = []
            for url in urls:
                found = bounded_terms(automaton, url) if url and len(automaton) else {}
                strict = sum(1 for is_strict, _ in found.values() if is_strict)
                rows.append((strict, len(found) - strict,
                             float(sum(found[t][1] for t in sorted(found)))))
            yield pd.DataFrame(rows, columns=["strict_hits", "soft_hits", "soft_weight"])

    return hits


def judge_urls(df: DataFrame, url: str = "url", rules=DEFAULT_RULES,
               vocabulary: Vocabulary | None = None) -> DataFrame:
    """``df`` with host, path, rule, verdict ('allow' or 'block'),
    strict_hits, soft_hits (different terms) and soft_weight."""
    vocabulary = vocabulary or Vocabulary()
    found = _hits(vocabulary)(F.translate(F.col(url), UPPER, LOWER))
    results = ["host", "path", "rule", "verdict", "strict_hits", "soft_hits", "soft_weight"]
    kept = [F.col(c) for c in df.columns if c.lower() not in results]
    host, path = url_host(F.col(url)), url_path(F.col(url))
    rejected = (F.col("hits.strict_hits") > 0) | (
        (F.col("hits.soft_hits") >= vocabulary.min_soft)
        & (F.col("hits.soft_weight") >= vocabulary.min_weight))
    ruled = rule_expr(F.col("host"), F.col("path"), rules, lambda v, h, p: v)
    return (
        df.select(*kept, host.alias("host"), path.alias("path"), found.alias("hits"))
        .select(*[c for c in df.columns if c.lower() not in results], "host", "path",
                rule_expr(F.col("host"), F.col("path"), rules,
                          lambda v, h, p: h + p).alias("rule"),
                F.coalesce(ruled, F.when(rejected, "block").otherwise("allow")).alias("verdict"),
                "hits.strict_hits", "hits.soft_hits", "hits.soft_weight")
    )


def oracle(rules=DEFAULT_RULES, vocabulary: Vocabulary | None = None) -> str:
    """DuckDB SQL for ``judge_urls`` over ``pages``: page_id and results."""
    v = vocabulary or Vocabulary()
    bound = lambda term: f"regexp_matches(u, '(^|[^a-z0-9]){term}($|[^a-z0-9])')"
    case = lambda value: "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') "
        f"THEN '{value(verdict, h, p)}'"
        for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))) + " END"
    strict = " + ".join(f"{bound(t)}::INT" for t in v.strict)
    soft = " + ".join(f"{bound(t)}::INT" for t in v.soft)
    weight = " + ".join(f"{bound(t)}::INT * {w}::DOUBLE" for t, w in v.soft.items())
    return f"""
WITH parsed AS (
  SELECT page_id, coalesce(translate(url, '{UPPER}', '{LOWER}'), '') AS u,
         coalesce(translate(regexp_extract(url, '(?s)\\A.*?://([^/?#]*)', 1),
                            '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)\\A.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
counted AS (
  SELECT *, ({strict})::INT AS strict_hits, ({soft})::INT AS soft_hits,
         ({weight})::DOUBLE AS soft_weight
  FROM parsed)
SELECT page_id, host, path, {case(lambda v, h, p: h + p)} AS rule,
       coalesce({case(lambda v, h, p: v)},
                CASE WHEN strict_hits > 0 OR (soft_hits >= {v.min_soft}
                          AND soft_weight >= {v.min_weight})
                     THEN 'block' ELSE 'allow' END) AS verdict,
       strict_hits, soft_hits, soft_weight
FROM counted"""
