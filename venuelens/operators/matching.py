"""Match values to a dictionary: exact, then normalised, then closest (JN-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from venuelens.functions.text import bare_name, squeeze_name
from venuelens.operators.materialize import materialize


def similarity(a: Column, b: Column) -> Column:
    """1 for equal texts, 0 when every character differs."""
    longest = F.greatest(F.char_length(a), F.char_length(b))
    return F.when(longest == 0, 1.0).otherwise(F.try_divide(longest - F.levenshtein(a, b), longest)).cast("double")


def match_values(df: DataFrame, col: str, dictionary: Sequence[str], cutoff: float = 0.6) -> DataFrame:
    """Add ``matched_value``, ``match_type`` and ``match_score``.

    The dictionary is a list of names given by the caller, held as a literal array: rows are matched
    where they are, without a join or a pair per candidate. Its normal forms are literals too, formed once when
    the query is planned. The edit distance is only computed for rows that neither equal an entry nor equal one
    after normalisation. Ties go to the earlier entry.
    """
    value = F.col(col)
    names = list(dictionary)
    entries = F.array(*[F.lit(name) for name in names])

    def first_equal(form) -> Column:
        forms = F.array(*[form(F.lit(name)) for name in names])
        return F.get(entries, F.nullif(F.array_position(forms, form(value)), F.lit(0).cast("bigint")).cast("int") - 1)

    exact = F.when(value.isin(*names), value)
    normal = F.coalesce(
        first_equal(squeeze_name), F.when(bare_name(value) != "", first_equal(bare_name))
    )
    wanted = squeeze_name(value)
    squeezed = F.array(*[F.struct(squeeze_name(F.lit(name)).alias("form"), F.lit(name).alias("name")) for name in names])
    scored = F.transform(
        squeezed,
        lambda e, i: F.struct(similarity(e["form"], wanted).alias("score"), (-i).alias("place"), e["name"].alias("name")),
    )
    best = F.array_max(scored)
    match = (
        F.when(exact.isNotNull(), F.struct(exact.alias("name"), F.lit("exact").alias("kind"), F.lit(1.0).alias("score")))
        .when(normal.isNotNull(), F.struct(normal.alias("name"), F.lit("normalised").alias("kind"), F.lit(1.0).alias("score")))
        .when(
            value.isNotNull() & (best["score"] >= cutoff),
            F.struct(best["name"].alias("name"), F.lit("closest").alias("kind"), best["score"].alias("score")),
        )
    )
    return (
        df.withColumn("_match", match)
        .withColumn("matched_value", F.col("_match.name"))
        .withColumn("match_type", F.coalesce(F.col("_match.kind"), F.lit("none")))
        .withColumn("match_score", F.col("_match.score"))
        .drop("_match")
    )


def _wrong(length: Column, cutoff: float) -> Column:
    """How many edits a text may be away when the longer of both has this length; rounding errors allow for more, never less."""
    return F.floor(length * (1 - cutoff) + 1e-9).cast("int")


def _pieces(long: Column, parts: Column, i: Column) -> tuple[Column, Column]:
    """Begin (from 1) and length of piece i of a text of length ``long`` in ``parts`` nearly equal pieces, the shorter ones first."""
    size = F.floor(long / parts).cast("int")
    short = parts - long % parts
    return (i - 1) * size + F.greatest(F.lit(0), i - 1 - short) + 1, size + (i > short).cast("int")


def _cut(forms: DataFrame, cutoff: float) -> DataFrame:
    """(form, long, i, piece): every text in one more piece than it may have edits, so that one piece is left whole."""
    rows = forms.withColumn("long", F.char_length("form")).where("long > 0").withColumn("parts", _wrong(F.col("long"), cutoff) + 1)
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("parts"))))
    begin, size = _pieces(F.col("long"), F.col("parts"), F.col("i"))
    return rows.select("form", "long", "i", F.col("form").substr(begin, size).alias("piece"))


def _probe(forms: DataFrame, cutoff: float, more: int) -> DataFrame:
    """(form, long, i, piece): where the pieces of longer texts (by ``more`` or above) can stand in these texts.

    Piece i of m is whole with at most i - 1 edits before it and m - i after it (Li et al. 2011), which leaves few places.
    """
    rows = forms.withColumn("n", F.char_length("form")).where("n > 0")
    top = F.floor(F.col("n") / cutoff + 1e-9).cast("int")
    rows = rows.withColumn("long", F.explode(F.sequence(F.col("n"), F.greatest(F.col("n"), top)))).where(F.col("long") >= F.col("n") + more)
    rows = rows.withColumn("parts", _wrong(F.col("long"), cutoff) + 1).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("parts"))))
    begin, size = _pieces(F.col("long"), F.col("parts"), F.col("i"))
    shift, left, right = F.col("n") - F.col("long"), F.col("i") - 1, F.col("parts") - F.col("i")
    low = F.greatest(begin - left, begin + shift - right, F.lit(1))
    high = F.least(begin + left, begin + shift + right, F.col("n") - size + 1)
    rows = rows.withColumns({"low": low, "high": high, "size": size}).where("low <= high")
    return rows.select("form", "long", "i", "size", F.explode(F.sequence("low", "high")).alias("at")).select(
        "form", "long", "i", F.col("form").substr(F.col("at"), F.col("size")).alias("piece")
    )


def closest_forms(values: DataFrame, entries: DataFrame, cutoff: float) -> DataFrame:
    """(value, form, score) of all pairs of distinct texts (``form`` on either side) with similarity of at least the cutoff.

    The longer text of a pair is cut into one more piece than the edits the cutoff leaves it, so one piece stands unchanged in
    the shorter text, near its old place: pairs meet on equal pieces and are verified. No pair is missed, and none is formed without a common piece. The
    number of places grows with the cube of the length: this is for names, not for long texts.
    """
    if not 0 < cutoff <= 1:
        raise ValueError("the cutoff must lie above 0 and at most at 1")
    key = ["long", "i", "piece"]
    value = lambda df: df.withColumnRenamed("form", "value")
    longer_entries = value(_probe(values, cutoff, 0)).join(_cut(entries, cutoff), key)
    longer_values = value(_cut(values, cutoff)).join(_probe(entries, cutoff, 1), key)
    met = longer_entries.select("value", "form").union(longer_values.select("value", "form"))
    return met.withColumn("score", similarity(F.col("form"), F.col("value"))).where(F.col("score") >= cutoff)


def match_values_table(
    df: DataFrame, col: str, dictionary: DataFrame, name: str, place: str | None = None, cutoff: float = 0.6
) -> DataFrame:
    """``match_values`` against a dictionary that is a table of any size.

    Each distinct value is matched once: by an equal name, then by an equal normal form, then by the closest form over the
    cutoff, searched with an index of pieces (``closest_forms``), and the result is joined back. Ties go to the entry with the lowest
    ``place``, or to the smallest name. NULL values match nothing; NULL names are no entries. The cutoff must lie above 0.
    """
    entries = dictionary.select(F.col(name).cast("string").alias("name"), F.col(place or name).alias("place")).where("name is not null")

    def first_by(form) -> DataFrame:
        return entries.select(form(F.col("name")).alias("form"), F.struct("place", "name").alias("entry")).groupBy("form").agg(F.min("entry").alias("entry"))

    squeezed = materialize(first_by(squeeze_name))
    bare = first_by(bare_name).where("form <> ''")
    values = df.select(F.col(col).cast("string").alias("value")).where("value is not null").distinct()
    values = materialize(values.select("value", squeeze_name(F.col("value")).alias("squeezed"), bare_name(F.col("value")).alias("bare")))
    equal = entries.select(F.col("name").alias("value"), F.col("name").alias("exact")).distinct()
    tiers = materialize(
        values.join(equal, "value", "left")
        .join(squeezed.select(F.col("form").alias("squeezed"), F.col("entry.name").alias("same")), "squeezed", "left")
        .join(bare.select(F.col("form").alias("bare"), F.col("entry.name").alias("alike")), "bare", "left")
        .select("value", "squeezed", "exact", F.coalesce("same", "alike").alias("normal"))
    )
    left = tiers.where("exact is null and normal is null").select(F.col("squeezed").alias("form")).distinct()
    near = closest_forms(left, squeezed.select("form"), cutoff).join(squeezed, "form")
    best = near.groupBy(F.col("value").alias("squeezed")).agg(F.min(F.struct((-F.col("score")).alias("score"), "entry")).alias("best"))
    kind = F.when(F.col("exact").isNotNull(), "exact").when(F.col("normal").isNotNull(), "normalised").when(F.col("best").isNotNull(), "closest")
    found = tiers.join(best, "squeezed", "left").select(
        F.col("value").alias("_value"),
        F.coalesce("exact", "normal", "best.entry.name").alias("matched_value"),
        kind.alias("match_type"),
        F.when(F.coalesce("exact", "normal").isNotNull(), F.lit(1.0)).otherwise(-F.col("best.score")).alias("match_score"),
    )
    joined = df.join(found.where("match_type is not null"), F.col(col).cast("string") == F.col("_value"), "left").drop("_value")
    return joined.withColumn("match_type", F.coalesce("match_type", F.lit("none")))
