"""URL filter: fixed host and path rules first, a weighted vocabulary for the rest.

The vocabulary is counted in the whole url behind its scheme, query and fragment included, with one
Aho-Corasick automaton; a url without a scheme is searched from its start.  A hit counts when no
letter or digit touches it.  Terms of weight ``LIMIT`` are strict: one is enough.  Soft terms weigh
1 and only distinct ones add up.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import lower_ascii, ship, text_of

LIMIT = 2

STRICT = ("casino", "porn", "porno", "xxx", "viagra", "cialis", "hentai", "camgirl", "sportsbook", "escorts")
SOFT = (
    "adult", "bet", "bets", "betting", "bonus", "cheap", "crack", "escort", "free", "gamble", "jackpot", "keygen",
    "loan", "loans", "nude", "payday", "pill", "pills", "poker", "replica", "sex", "sexy", "slots", "torrent", "warez",
    "win",
)

Rule = tuple[str, str, str]

#: (host, path, verdict) of the registered query.
RULES: tuple[Rule, ...] = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(text_of(url), _ADDRESS, 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(text_of(url), _ADDRESS, 2)


def seen_of(url: Column) -> Column:
    """What the vocabulary is counted in: everything behind the first ``://``, or all, A-Z lower-cased."""
    text = text_of(url)
    return lower_ascii(F.when(F.contains(text, F.lit("://")), F.regexp_extract(text, r"(?s)^.*?://(.*)$", 1)).otherwise(text))


def longest_first(rules: Sequence[Rule]) -> list[Rule]:
    """Longest host + path first; of equally long ones the longer host, then alphabetic."""
    return sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r))


def _chosen(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    chosen = F.lit(None).cast("string")
    for rule in reversed(longest_first(rules)):
        fits = ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])
        chosen = F.when(fits, F.lit(value(rule))).otherwise(chosen)
    return chosen


@functools.lru_cache(maxsize=4)
def _automaton(terms: tuple[tuple[str, int], ...]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for term, weight in terms:
        machine.add_word(term, (term, weight))
    machine.make_automaton()
    return machine


def _joins(text: str, at: int) -> bool:
    """Does a letter or digit stand at this place?"""
    return 0 <= at < len(text) and text[at].isascii() and text[at].isalnum()


def count_terms(text: str, terms: tuple[tuple[str, int], ...]) -> tuple[int, int]:
    """Distinct strict and distinct soft terms that stand free in a lower-cased text."""
    found = {
        term: weight
        for end, (term, weight) in _automaton(terms).iter(text)
        if not _joins(text, end - len(term)) and not _joins(text, end + 1)
    }
    strict = sum(weight >= LIMIT for weight in found.values())
    return strict, len(found) - strict


def read_vocabulary(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Strict and soft terms of a text file with a term and its weight (1 or 2) on each line.

    A configured list, as short as the memory of a task allows; blank lines and lines that begin
    with # are passed over.
    """
    rows = spark.read.text(path).where("trim(value) <> '' AND NOT value LIKE '#%'").select(F.split(F.trim("value"), r"\s+").alias("v"))
    terms = {r["v"][0].lower(): int(r["v"][1]) for r in rows.collect()}
    return sorted(t for t, w in terms.items() if w >= LIMIT), sorted(t for t, w in terms.items() if w < LIMIT)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    url: str = "url",
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``strict_hits``, ``soft_hits`` and ``verdict``.

    ``rules`` is a short configured list; the longest that fits decides.  Without one, the verdict
    is block for a strict hit or ``LIMIT`` distinct soft hits.  Columns of those six names are
    replaced.  A null url, or one without ``://``, has empty host and path and so no rule; the
    vocabulary is counted in it all the same, and a null url has no hits.  Rows may repeat, urls
    may have any length, and an empty table gives no rows.
    """
    ship(pages.sparkSession)
    terms = tuple(sorted({**dict.fromkeys(soft, 1), **dict.fromkeys(strict, LIMIT)}.items()))

    @F.pandas_udf("strict_hits int, soft_hits int")
    def hits(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            yield pd.DataFrame([count_terms(x, terms) for x in part], columns=["strict_hits", "soft_hits"], dtype="int32")

    read = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    host, path = F.col("host"), F.col("path")
    counted = read.withColumn("_hits", hits(seen_of(F.col(url))))
    method = F.when((F.col("strict_hits") > 0) | (F.col("soft_hits") >= LIMIT), "block").otherwise("allow")
    return (
        counted.withColumns({"strict_hits": F.col("_hits.strict_hits"), "soft_hits": F.col("_hits.soft_hits")})
        .withColumn("rule", _chosen(rules, host, path, lambda r: r[0] + r[1]))
        .withColumn("verdict", F.coalesce(_chosen(rules, host, path, lambda r: r[2]), method))
        .drop("_hits")
    )


def judge_sql(rules: Sequence[Rule] = RULES, strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT) -> str:
    """The query's result in DuckDB SQL, with one pattern per term."""

    def free(term: str) -> str:
        return f"CAST(regexp_matches(seen, '(^|[^a-z0-9]){term}([^a-z0-9]|$)') AS INTEGER)"

    def fits(rule: Rule) -> str:
        return f"(host = '{rule[0]}' OR ends_with(host, '.{rule[0]}')) AND starts_with(path, '{rule[1]}')"

    ordered = longest_first(rules)
    rule = " ".join(f"WHEN {fits(r)} THEN '{r[0]}{r[1]}'" for r in ordered)
    verdict = " ".join(f"WHEN {fits(r)} THEN '{r[2]}'" for r in ordered)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH cut AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{_ADDRESS}', 1), '{upper}', '{lower}') AS host,
    regexp_extract(coalesce(url, ''), '{_ADDRESS}', 2) AS path, coalesce(url, '') AS url
  FROM pages
), lowered AS (
  SELECT *, translate(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE url END, '{upper}', '{lower}') AS seen
  FROM cut
), counted AS (
  SELECT *, {" + ".join(map(free, strict))} AS strict_hits, {" + ".join(map(free, soft))} AS soft_hits FROM lowered
)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN strict_hits > 0 OR soft_hits >= {LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
  strict_hits, soft_hits
FROM counted"""
