"""URL filter: a weighted vocabulary found by Aho-Corasick, below explicit host and path rules.

Null or malformed urls have an empty host and path, no hits, and are allowed. Repeated rows
are judged one by one. The result columns replace input columns of the same names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.llm.common import ascii_lower

#: Terms whose single occurrence rejects a url, and terms of which several distinct ones do.
STRICT_TERMS = ("casino", "escort", "porn", "viagra", "warez", "xxx")
SOFT_TERMS = ("ads", "bet", "bonus", "cheap", "crack", "free", "loan", "pills", "poker", "sexy", "track", "win")
SOFT_LIMIT = 2

_HITS = "struct<strict_hits: int, soft_hits: int>"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_SIGNS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str


def url_host(url: str) -> Column:
    """What follows the first ``://`` up to a slash, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(F.col(url), _PARTS, 1), F.lit("")))


def url_path(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), _PARTS, 2), F.lit(""))


def term_hits(url: Column, strict: Sequence[str], soft: Sequence[str]) -> Column:
    """Occurrences of strict terms and distinct soft terms, each between non-alphanumeric signs or ends."""
    weights = {term: 1 for term in soft} | {term: 2 for term in strict}

    @F.pandas_udf(_HITS)
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        vocabulary = ahocorasick.Automaton()
        for term, weight in weights.items():
            vocabulary.add_word(term, (weight, term))
        vocabulary.make_automaton()

        def hits(text) -> tuple[int, int]:
            if not isinstance(text, str):
                return 0, 0
            strictly, softly = 0, set()
            for last, (weight, term) in vocabulary.iter(text):
                first = last - len(term) + 1
                inside = (first and text[first - 1] in _SIGNS) or text[last + 1 : last + 2] in _SIGNS
                if inside:
                    continue
                if weight == 2:
                    strictly += 1
                else:
                    softly.add(term)
            return strictly, len(softly)

        for urls in batches:
            yield pd.DataFrame([hits(u) for u in urls], columns=["strict_hits", "soft_hits"]).astype("int32")

    if not weights:
        return F.struct(F.lit(0).alias("strict_hits"), F.lit(0).alias("soft_hits"))
    return count(ascii_lower(url))


def matching_rule(rules: Sequence[Rule], host: Column, path: Column, field) -> Column:
    """``field`` of the longest rule whose host is the url's or a parent of it, and whose path begins the url's."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.lit(field(rule))).otherwise(found)
    return found


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = (),
    url: str = "url",
    strict: Sequence[str] = STRICT_TERMS,
    soft: Sequence[str] = SOFT_TERMS,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """Add ``host, path, rule, strict_hits, soft_hits, verdict`` to every row.

    A fitting rule decides. Else one strict term, or ``soft_limit`` distinct soft terms, block the
    url. The rules are a short list written by hand: they become expressions of the plan, as they
    are tested on every row; no join and no shuffle is needed.
    """
    hosted = pages.withColumns({"host": url_host(url), "path": url_path(url)})
    host, path = F.col("host"), F.col("path")
    hits = hosted.withColumn("_hits", term_hits(F.col(url), strict, soft)).withColumns(
        {
            "strict_hits": F.col("_hits.strict_hits"),
            "soft_hits": F.col("_hits.soft_hits"),
            "rule": matching_rule(rules, host, path, lambda r: r.host + r.path),
            "verdict": matching_rule(rules, host, path, lambda r: r.verdict),
        }
    )
    bad = (F.col("strict_hits") > 0) | (F.col("soft_hits") >= soft_limit)
    own = F.when(bad, F.lit("block")).otherwise(F.lit("allow"))
    return hits.withColumn("verdict", F.coalesce(F.col("verdict"), own)).drop("_hits")
