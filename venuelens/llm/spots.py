"""SpotSigs fingerprints: chains of content words that follow common words, compared as sets."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuelens.llm.storage import keep

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with",
    "auf", "das", "den", "der", "des", "die", "ein", "eine", "für", "ist", "mit", "nicht", "und", "von", "zu",
    "au", "aux", "avec", "dans", "de", "du", "elle", "en", "est", "et", "la", "le", "les", "par", "pas", "pour", "que", "qui", "sur", "un", "une",
    "como", "con", "del", "el", "las", "los", "no", "para", "por", "se", "su", "una", "y",
)


def signatures(text: Column, anchors: Sequence[str] = ANCHORS, length: int = 2) -> list[tuple[str, Column]]:
    """Steps, as columns to add one after another, that end in `sigs`: the ascending hashes of a text's spot signatures.

    Words are runs of letters and digits, lower-cased. A signature is a common word with the `length` content words that follow
    it, common words between them left out (fewer at the end of the text). The common word must stand directly before the first content word. A text
    without a signature has one for the whole text; NULL counts as empty.
    """
    common = lambda w: w.isin(*anchors)
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    paired = F.zip_with(F.col("_words"), F.concat(F.array(F.lit("")), F.col("_words")), lambda w, before: F.struct(w.alias("w"), before.alias("before")))
    content = F.filter(F.col("_paired"), lambda x: x["w"].isNotNull() & ~common(x["w"]))
    after = lambda i: F.slice(F.col("_content"), i + 1, F.greatest(F.size("_content") - i, F.lit(0)))
    chains = F.transform(F.col("_content"), lambda x: F.struct(common(x["before"]).alias("spot"), F.xxhash64(x["before"], x["w"]).alias("h")))
    steps = [("_words", words), ("_paired", paired), ("_content", content), ("_chains", chains)]
    for i in range(1, length):
        joined = F.zip_with(F.col("_chains"), after(i), lambda c, x: F.struct(c["spot"].alias("spot"), F.xxhash64(c["h"], F.coalesce(x["w"], F.lit(""))).alias("h")))
        steps.append(("_chains", joined))
    spots = F.array_sort(F.array_distinct(F.transform(F.filter("_chains", lambda c: c["spot"]), lambda c: c["h"])))
    return [*steps, ("sigs", spots), ("sigs", F.when(F.size("sigs") > 0, F.col("sigs")).otherwise(F.array(F.xxhash64(F.lower(F.coalesce(text, F.lit("")))))))]


def with_signatures(df: DataFrame, text: str, name: str, anchors: Sequence[str] = ANCHORS, length: int = 2) -> DataFrame:
    """`df` with the ascending signature hashes of `text` as `name`."""
    columns = df.columns
    for step, column in signatures(F.col(text), anchors, length):
        df = df.withColumn(step, column)
    return df.select(*columns, F.col("sigs").alias(name))


def fingerprint(sigs: Column) -> Column:
    """Size and 128-bit digest of a signature set."""
    return F.concat_ws("-", F.size(sigs).cast("string"), F.lower(F.hex(F.xxhash64(sigs))), F.lower(F.hex(F.xxhash64(F.lit(1), sigs))))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    return both / (F.size(a) + F.size(b) - both)


def fingerprint_edits(docs: DataFrame, id: str = "doc_id", text: str = "text", anchors: Sequence[str] = ANCHORS, length: int = 2, task_bytes: int = 32 << 20) -> DataFrame:
    """One row per document: n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by as many first ones (or all) of the next document in ascending
    id, the first after the last. NULL texts count as empty, NULL ids come first; rows with equal ids follow each other by text. A single
    document is its own next one; an empty table gives no rows. Ids are integers.

    Texts are dealt once, by ranges of ids of about `task_bytes`; the first document of each range is also dealt to the range before it, so a window
    within ranges finds every next document.
    """
    narrow = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    piece = _ranges(narrow, task_bytes)
    placed = narrow.withColumn("piece", piece(F.col("doc_id")))
    firsts = placed.groupBy("piece").agg(F.min("doc_id").alias("first"))
    order = Window.orderBy("piece")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per range: the number of ranges is bounded by bytes / task_bytes.
    firsts = firsts.select("first", F.coalesce(F.lag("piece").over(order), F.last("piece").over(everything)).alias("before"))
    copied = placed.join(F.broadcast(firsts), placed["doc_id"].eqNullSafe(firsts["first"]))
    rows = placed.withColumn("copy", F.lit(0)).union(copied.select("doc_id", "text", F.col("before").alias("piece"), F.lit(1)))
    following = F.lead("text").over(Window.partitionBy("piece").orderBy("copy", "doc_id", "text"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.substring(F.col("next"), F.lit(1), half))
    pairs = rows.withColumn("next", following).where("copy = 0").select("doc_id", "text", "next", edited.alias("edited"))
    # The next text's signatures are made again where they are used: that is cheaper than dealing them out.
    for source, name in (("text", "sigs_text"), ("edited", "sigs_edited"), ("next", "sigs_next")):
        pairs = with_signatures(pairs, source, name, anchors, length)
    own, changed, after = F.col("sigs_text"), F.col("sigs_edited"), F.col("sigs_next")
    return pairs.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), fingerprint(own).alias("fingerprint"),
        fingerprint(changed).alias("edited_fingerprint"), likeness(own, changed).alias("near_edited"), likeness(own, after).alias("near_next"),
    )


def _ranges(narrow: DataFrame, task_bytes: int, most: int = 256):
    """A function from an id to its range: up to `most` ranges by quantiles, each cut evenly as often as its bytes ask for."""
    spark = narrow.sparkSession
    shares = [i / most for i in range(most + 1)]
    size, bounds = narrow.agg(F.sum(F.octet_length("text")), F.percentile_approx("doc_id", shares, 10_000)).first()
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((size or 0) / task_bytes))
    step = max(1, most // wanted)
    bounds = sorted(set((bounds or [0])[::step]))
    cuts = max(1, math.ceil(wanted / len(bounds)))

    def tree(x: Column, low: int, high: int) -> Column:
        if high - low == 1:
            width = bounds[high] - bounds[low] if high < len(bounds) else 1
            inside = F.least(F.lit(cuts - 1), F.greatest(F.lit(0), F.floor((x - bounds[low]) * float(cuts) / float(width))))
            return F.lit(low * cuts).cast("long") + inside
        middle = (low + high) // 2
        return F.when(x < bounds[middle], tree(x, low, middle)).otherwise(tree(x, middle, high))

    return lambda x: F.when(x.isNull(), F.lit(-1).cast("long")).otherwise(tree(x, 0, len(bounds)))


def similar(docs: DataFrame, threshold: float = 0.8, id: str = "doc_id", text: str = "text", anchors: Sequence[str] = ANCHORS, length: int = 2) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, likeness) of class representatives from `threshold` up, and the class (doc_id, class_id) of every document.

    Texts with equal fingerprints are one class, named by the smallest id. Sets are partitioned by length so that partners stand in the same or
    the next partition; within one, only sets that share one of their rarest signatures meet (a set can't reach the threshold without), and
    lengths prune again before sets are compared. NULL ids are left out.
    """
    found = with_signatures(docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text")), text="text", name="sigs", anchors=anchors, length=length)
    found = keep(found.where("doc_id is not null").select("doc_id", "sigs", fingerprint(F.col("sigs")).alias("print")))
    named = found.groupBy("print").agg(F.min("doc_id").alias("class_id"), F.first("sigs").alias("sigs"))
    classes = keep(named.withColumn("n", F.size("sigs")).withColumn("part", F.floor(F.log("n") / -math.log(threshold)).cast("long")))
    each = classes.select("class_id", "n", "part", F.explode("sigs").alias("sig"))
    rarity = each.groupBy("sig").agg(F.count("*").alias("sets")).where("sets > 1")
    prefix = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    # Signatures of one set alone count for the prefix, but meet nobody: `alone` is how many there are.
    shared = each.join(rarity, "sig")
    order = Window.partitionBy("class_id").orderBy("sets", "sig")
    alone = shared.groupBy("class_id").agg(F.count("*").alias("common"))
    ranked = shared.withColumn("place", F.row_number().over(order)).join(alone, "class_id").where(F.col("place") + F.col("n") - F.col("common") <= prefix)
    keys = ranked.select("class_id", "n", "part", "sig")
    right = keys.select(F.col("class_id").alias("b"), F.col("n").alias("m"), F.col("sig"), F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"))
    close = (F.col("n") <= F.col("m")) & (F.col("n") >= F.col("m") * threshold - 1e-9) & ((F.col("n") < F.col("m")) | (F.col("class_id") < F.col("b")))
    met = keys.withColumnRenamed("class_id", "a").alias("l").join(right, ["part", "sig"]).withColumnRenamed("a", "class_id").where(close).select("class_id", "b").distinct()
    sets = classes.select("class_id", "sigs")
    compared = met.join(sets, "class_id").join(sets.select(F.col("class_id").alias("b"), F.col("sigs").alias("other")), "b")
    pairs = compared.select(F.least("class_id", "b").alias("a"), F.greatest("class_id", "b").alias("b"), likeness(F.col("sigs"), F.col("other")).alias("likeness"))
    return pairs.where(F.col("likeness") >= threshold), found.join(named.select("print", "class_id"), "print").select("doc_id", "class_id")
