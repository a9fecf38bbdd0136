"""List columns, price tiers and one-hot expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Price signs and their tier.
PRICE_LEVELS = {"$": 1, "$$": 2, "$$$": 3, "$$$$": 4, "$$$$$": 5}


def split_list(c: Column) -> Column:
    return F.split(c, ", ")


def parse_list_text(c: Column) -> Column:
    """``"['A', 'B']"`` to an array; quotes inside names are removed too."""
    return split_list(F.regexp_replace(c, r"['\[\]]", ""))


def struct_field(c: Column, field: str) -> Column:
    """One field of every struct in an array column."""
    return F.transform(c, lambda item: item[field])


def occurrences(c: Column, value: object) -> Column:
    """How often a value occurs in an array; 0 for an empty or NULL array."""
    hits = F.size(F.filter(c, lambda item: item == F.lit(value)))
    return F.when(c.isNull(), F.lit(0)).otherwise(hits).cast("int")


def value_counts_map(c: Column) -> Column:
    """Sparse one-hot: map of each array value to its number of occurrences."""
    present = F.filter(c, lambda item: item.isNotNull())
    return F.map_from_entries(
        F.transform(
            F.array_distinct(present),
            lambda value: F.struct(value, F.size(F.filter(present, lambda item: item == value))),
        )
    )


def indicator(c: Column, value: object) -> Column:
    return F.coalesce((c == F.lit(value)).cast("int"), F.lit(0))


def price_level(c: Column) -> Column:
    """Tier of a price sign; an unknown sign gives NULL."""
    pairs = [F.lit(part) for pair in PRICE_LEVELS.items() for part in pair]
    return F.create_map(*pairs)[c]


def price_bounds(price: Column) -> tuple[Column, Column]:
    """Lower and upper tier of a price range such as ``$$ - $$$``."""
    parts = F.split(F.replace(price, F.lit(" "), F.lit("")), "-")
    return price_level(F.element_at(parts, 1)), price_level(F.element_at(parts, -1))


def price_length(price: Column) -> Column:
    """Number of price characters; 0 when the price is unknown."""
    return F.char_length(F.coalesce(price, F.lit("")))
