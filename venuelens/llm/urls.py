"""URL filters: host rules, then a weighted vocabulary counted with an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rules as (text, verdict), and the vocabulary.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
STRICT = ("casino", "porn", "xxx", "viagra", "escort", "warez", "jackpot", "hentai")
SOFT = ("adult", "bet", "bets", "cheap", "crack", "dating", "free", "gambling", "keygen", "loan", "loans", "pills", "poker", "sex", "torrent", "win")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From after the first :// to the next /, ?, # or the end, A-Z lower-cased; empty for NULL or without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host to the next ?, # or the end; empty for NULL or without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule whose host is the url's or a parent of it and whose path starts the url's; else NULL."""
    out = None
    for text, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, _, rest = text.partition("/")
        fits = F.concat(F.lit("."), host).endswith("." + name) & path.startswith("/" + rest)
        found = F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out if out is not None else F.lit(None).cast("struct<rule: string, verdict: string>")


def judge_urls(
    pages: DataFrame, id: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str]] = RULES, strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, several: int = 2
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, strict and soft (distinct terms found).

    The longest fitting rule decides; without one a url is blocked by one strict term or by `several` distinct soft terms anywhere in
    it. A term counts where neither neighbour is a letter or digit of ASCII; A-Z are lower-cased. NULL and empty urls have empty host and
    path and are allowed. Repeated rows are judged alike; NULL ids stay; an empty table gives no rows. A map without a shuffle; vocabulary
    and rules are arguments, whose size the caller knows.
    """
    kinds = {**dict.fromkeys(soft, "soft"), **dict.fromkeys(strict, "strict")}

    def run(batches):
        finder = automaton(kinds)
        for batch in batches:
            found = [terms(finder, u) for u in batch.column("url").to_pylist()]
            counts = {kind: pa.array([sum(kinds[t] == kind for t in x) for x in found], pa.int32()) for kind in ("strict", "soft")}
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"), **counts})

    narrow = pages.select(F.col(id).alias("page_id"), F.col(url).cast("string").alias("url"))
    counted = narrow.mapInArrow(run, f"page_id {narrow.schema['page_id'].dataType.simpleString()}, url string, strict int, soft int")
    parts = counted.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = parts.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    method = F.when((F.col("strict") > 0) | (F.col("soft") >= several), "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", method).alias("verdict"), "strict", "soft")


def automaton(terms: dict[str, str]) -> ahocorasick.Automaton | None:
    out = ahocorasick.Automaton()
    for term in terms:
        out.add_word(term, term)
    out.make_automaton()
    return out if len(out) else None


def terms(finder: ahocorasick.Automaton | None, url: str | None) -> set[str]:
    """Distinct terms of the url that stand between boundaries."""
    if not url or finder is None:
        return set()
    text = url.translate(_TO_LOWER)
    inner = lambda i: 0 <= i < len(text) and text[i] in _INNER
    return {term for end, term in finder.iter(text) if not inner(end + 1) and not inner(end - len(term))}


_TO_LOWER = str.maketrans(_UPPER, _LOWER)
_INNER = frozenset(_LOWER + "0123456789")
