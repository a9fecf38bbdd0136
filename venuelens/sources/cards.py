"""Listing cards from page HTML (SRC-4)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from venuelens.functions.numbers import digits_to_int
from venuelens.functions.text import strip


@dataclass(frozen=True)
class CardRules:
    """A pattern for one card, and for each field a pattern whose first group is its text."""

    card: str
    fields: Mapping[str, str] = field(default_factory=dict)


LINKS = CardRules(
    card=r'<a href="[^"]*">[^<]*</a>',
    fields={"target": r'href="([^"]*)"', "label": r">([^<]*)<"},
)


def extract_cards(pages: DataFrame, rules: CardRules, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per card and page, with its place on the page; a field that is absent is NULL."""
    cards = pages.select(
        key,
        F.posexplode(F.regexp_extract_all(html, F.lit(rules.card), F.lit(0))).alias("card_no", "card"),
    )
    return cards.select(
        key,
        "card_no",
        *[
            F.when(F.col("card").rlike(p), F.regexp_extract("card", p, 1)).alias(name)
            for name, p in rules.fields.items()
        ],
    )


# Elements that have no end tag in HTML.
_VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

# Comments and declarations, scripts and styles whole, tags with quoted values, texts, and a sign that begins no tag.
_TOKEN = r"""(?s)<!--.*?-->|<![^>]*+>|<((?i:script|style))\b.*?</\1\s*>|</?[A-Za-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^<]++|<"""


def _attribute(name: str, value: str) -> str:
    return rf"""(?s)\s(?i:{name})\s*=\s*(?:"{value}"|'{value}'|{value}(?=[\s>/]))"""


def _has_class(token: Column, name: str) -> Column:
    return token["raw"].rlike(_attribute("class", rf"(?:[^\"'>]*\s)?{name}(?:\s[^\"'>]*)?"))


def _has_role(token: Column, role: str) -> Column:
    return token["raw"].contains(role) & token["raw"].rlike(_attribute("data-automation", role))


def _opens(token: Column, tag: str) -> Column:
    return (token["kind"] == 1) & (token["tag"] == tag)


def _tokens(html: Column) -> Column:
    """The tags and texts of a page in order: ``raw``, lower-case ``tag``, ``kind`` 1 for a start, -1 for an end, 0 for all else, and its number."""
    tag = lambda raw: F.lower(F.regexp_extract(raw, r"^</?([A-Za-z][^\s/>]*)", 1))
    named = F.transform(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)), lambda raw: F.struct(raw.alias("raw"), tag(raw).alias("tag")))
    nothing = lambda t: (t["tag"] == "") | t["tag"].isin("script", "style", *_VOID) | t["raw"].endswith("/>")
    kind = lambda t: F.when(nothing(t), 0).when(t["raw"].startswith("</"), -1).otherwise(1)
    return F.transform(named, lambda t, i: F.struct(t["raw"].alias("raw"), t["tag"].alias("tag"), kind(t).alias("kind"), i.alias("no")))


# A length beyond that of any page's tokens.
_ALL = 1 << 30


def _element(tokens: Column, at: Column) -> Column:
    """The tokens of the element that starts at a place (from 1): up to the end tag that brings the depth of its own tag back to 0.

    Other tags left open inside it do not matter. One that is never closed reaches to the end.
    """
    start = F.get(tokens, at - 1)
    same = F.filter(F.slice(tokens, at, _ALL), lambda t: t["tag"] == start["tag"])

    def step(seen: Column, t: Column) -> Column:
        depth = seen["depth"] + t["kind"]
        return F.struct(depth.alias("depth"), F.when((seen["end"] < 0) & (depth == 0), t["no"]).otherwise(seen["end"]).alias("end"))

    end = F.aggregate(same, F.struct(F.lit(0).alias("depth"), F.lit(-1).alias("end")), step, lambda seen: F.when(seen["end"] < 0, _ALL).otherwise(seen["end"]))
    return F.slice(tokens, at, F.least(F.lit(_ALL), end - start["no"] + 1))


def _first(tokens: Column, condition) -> Column:
    """The place (from 1) of the first token that meets the condition, 0 without one."""
    return F.coalesce(F.array_position(F.transform(tokens, condition), F.lit(True)), F.lit(0)).cast("int")


def _child(tokens: Column, condition) -> Column:
    """The place of the first element right below the one that the tokens make up."""

    def step(seen: Column, t: Column) -> Column:
        hit = (seen["found"] == 0) & (seen["depth"] == 1) & (t["kind"] == 1) & condition(t)
        return F.struct((seen["depth"] + t["kind"]).alias("depth"), (seen["i"] + 1).alias("i"), F.when(hit, seen["i"] + 1).otherwise(seen["found"]).alias("found"))

    return F.aggregate(tokens, F.struct(F.lit(0).alias("depth"), F.lit(0).alias("i"), F.lit(0).alias("found")), step)["found"]


def _text(tokens: Column) -> Column:
    """The texts of an element, stripped and put together; NULL without an element."""
    plain = F.filter(tokens, lambda t: (t["tag"] == "") & ~t["raw"].startswith("<!"))

    def decoded(raw: Column) -> Column:
        for code, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
            raw = F.replace(raw, F.lit(code), F.lit(sign))
        return strip(raw)

    return F.array_join(F.transform(plain, lambda t: decoded(t["raw"])), "")


def extract_listing_cards(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Restaurant cards of listing pages: rating text (``N/A`` when absent), review count, cuisine, price, sponsored.

    A page becomes a stream of tags and texts; a card is the run of tokens from its start tag to where the depth of its tag is 0 again, and its
    fields are elements found inside it in the same way. All of it is native and per row: nothing is shuffled, and pages without a card are left out
    before they are cut. Cards do not nest. NULL and empty pages have none.
    """
    is_card = lambda t: (t["kind"] == 1) & _has_role(t, "restaurantCard")
    cut = pages.where(F.col(html).contains("restaurantCard")).select(key, _tokens(F.col(html)).alias("_all"))
    cut = cut.withColumn("_starts", F.filter(F.transform("_all", lambda t, i: F.when(is_card(t), i + 1)), lambda i: i.isNotNull()))
    # Each card with what follows it, up to the next one.
    following = F.transform(
        "_starts",
        lambda at, i: F.slice("_all", at, F.coalesce(F.get("_starts", i + 1), F.size("_all") + 1) - at),
    )
    cards = cut.select(key, F.posexplode(following).alias("card_no", "_from")).withColumn("_card", _element(F.col("_from"), F.lit(1)))
    card = F.col("_card")

    for name, role in (("rating", "bubbleRatingValue"), ("reviews", "bubbleReviewCount")):
        cards = cards.withColumn(f"_{name}_at", _first(card, _box(role)))
        cards = cards.withColumn(f"_{name}_box", F.when(F.col(f"_{name}_at") > 0, _element(card, F.col(f"_{name}_at"))))
        cards = cards.withColumn(f"_{name}_span", _first(F.col(f"_{name}_box"), lambda t: _opens(t, "span")))
        cards = cards.withColumn(name, F.when(F.col(f"_{name}_span") > 0, _text(_element(F.col(f"_{name}_box"), F.col(f"_{name}_span")))))

    places = lambda condition: F.filter(F.transform(card, lambda t, i: F.when(condition(t), i + 1)), lambda i: i.isNotNull())
    inner = lambda e: F.slice(e, 2, _ALL)
    named = F.transform(places(lambda t: _opens(t, "span") & _has_class(t, "f")), lambda at: inner(_element(card, at)))
    cards = cards.withColumn("_named", F.get(F.filter(named, lambda e: F.exists(e, lambda t: _opens(t, "span"))), F.lit(0)))
    cards = cards.withColumn("cuisine_type", _text(_element(F.col("_named"), _first(F.col("_named"), lambda t: _opens(t, "span")))))
    is_price = lambda t: _opens(t, "span") & _has_class(t, "biGQs")
    priced = F.transform(places(lambda t: _opens(t, "div") & _has_class(t, "biqBm")), lambda at: _element(card, at))
    cards = cards.withColumn("_priced", F.get(F.filter(priced, lambda e: _child(e, is_price) > 0), F.lit(0)))
    cards = cards.withColumn("price", _text(_element(F.col("_priced"), _child(F.col("_priced"), is_price))))
    return cards.select(
        key,
        "card_no",
        F.coalesce("rating", F.lit("N/A")).alias("rating"),
        digits_to_int(F.coalesce("reviews", F.lit("0"))).alias("reviews_count"),
        F.coalesce("cuisine_type", F.lit("")).alias("cuisine_type"),
        F.coalesce("price", F.lit("")).alias("price"),
        F.get(card, F.lit(0))["raw"].rlike(r"\s(?i:data-sponsored)(?=[\s=>/])").alias("is_sponsored"),
    )


def _box(role: str) -> Callable[[Column], Column]:
    return lambda t: _opens(t, "div") & _has_role(t, role)
