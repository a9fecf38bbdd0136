"""SimHash near-duplicates: links of few differing bits found through deletion variants of segments."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelens.llm.components import components
from venuelens.llm.storage import keep, measured_broadcasts
from venuelens.llm.words import NO_SPACE, mix, slices, words_of

BITS = 64

#: Members of one key that are compared directly. Larger keys are cut finer first, so that pairs stay in proportion to the rows.
TOGETHER = 16

_PAIRS_OF_BITS = np.uint64(0x0000000100000001)
_KEYED = "fp long, key long, low int, width int, left int"


def fingerprints_of(texts: pa.Array, size: int, seed: int) -> np.ndarray:
    """SimHash of every text: a bit is 1 where it is set in over half of the XXH64 hashes of the shingles of `size` words.

    Shingles are joined by one space and count as often as they occur. A text with fewer words is one shingle; one without words gets zero.
    """
    w = words_of(texts, NO_SPACE)
    words = np.diff(w.first)
    # One space after each word, whatever stood there; no shingle reaches over the end of its row.
    inside = NO_SPACE[w.data]
    gap = w.ends[w.ends < len(w.data)]
    gap = gap[~inside[gap]]
    data = w.data.copy()
    data[gap] = 0x20
    inside[gap] = True
    at = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(inside, out=at[1:])
    text = data[inside].tobytes()

    count = np.where(words > 0, np.maximum(words - size + 1, 1), 0)
    begin = np.zeros(len(count) + 1, dtype=np.int64)
    np.cumsum(count, out=begin[1:])
    rows = np.repeat(np.arange(len(count)), count)
    first = w.first[rows] + np.arange(begin[-1]) - begin[rows]
    last = np.minimum(first + size - 1, w.first[rows + 1] - 1)
    digest = xxhash.xxh64_intdigest
    ranges = zip(at[w.starts[first]].tolist(), at[w.ends[last]].tolist())
    hashes = np.fromiter((digest(text[s:e], seed) for s, e in ranges), np.uint64, len(first))

    out = np.zeros(len(count), dtype=np.uint64)
    full = np.flatnonzero(count)
    if len(full):
        half = count[full].astype(np.uint64)
        for bit in range(BITS // 2):  # two counters of 32 bits at a time
            both = np.add.reduceat((hashes >> np.uint64(bit)) & _PAIRS_OF_BITS, begin[full])
            low, high = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
            out[full] |= (low * np.uint64(2) > half).astype(np.uint64) << np.uint64(bit)
            out[full] |= (high * np.uint64(2) > half).astype(np.uint64) << np.uint64(bit + 32)
    return out


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row's whole text, as a signed long. A map without a shuffle; NULL is an empty text."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                fp = fingerprints_of(batch.column("text"), size, seed)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(fp.view(np.int64))})

    narrow = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, fp long")


def _bits(low: int, width: int) -> np.uint64:
    return np.uint64(((1 << width) - 1) << low)


def _variants(low: int, width: int, left: int) -> list[tuple[np.uint64, int, int, int]]:
    """The keys that cut a free range of bits finer: (bits that must be equal now, low and width of the range still free, errors left).

    Halved, a range with at most two wrong bits has a half without any, or one wrong bit in each: then the lower half has a
    one-wildcard variant that is equal, and at most one wrong bit is left for the upper. A range with at most one wrong bit has a half without any.
    """
    half = width // 2
    down, up = (low, half), (low + half, width - half)
    out = [(_bits(*down), *up, left), (_bits(*up), *down, left)]
    if left == 2:
        out += [(_bits(*down) & ~_bits(low + i, 1), *up, 1) for i in range(half)]
    return out


def cut_finer(rows: DataFrame) -> DataFrame:
    """Every row (fp, key, low, width, left) once for each variant of its free range, with the key that also holds the variant's bits."""

    def run(batches):
        for batch in batches:
            fp, key = (batch.column(c).to_numpy().view(np.uint64) for c in ("fp", "key"))
            shape = np.stack([batch.column(c).to_numpy() for c in ("low", "width", "left")])
            for low, width, left in np.unique(shape, axis=1).T.tolist():
                mine = np.flatnonzero((shape == np.array([[low], [width], [left]])).all(axis=0))
                own, before = fp[mine], key[mine]
                for equal, to_low, to_width, to_left in _variants(low, width, left):
                    # The mask tells variants apart: no two of one range fix the same bits.
                    fixed = mix(mix(before + equal) ^ (own & equal))
                    n = len(mine)
                    yield pa.RecordBatch.from_pydict(
                        {"fp": pa.array(own.view(np.int64)), "key": pa.array(fixed.view(np.int64))}
                        | {c: pa.array(np.full(n, v, np.int32)) for c, v in (("low", to_low), ("width", to_width), ("left", to_left))}
                    )

    return rows.mapInArrow(run, _KEYED)


def close_pairs(distinct: DataFrame, most: int = 2) -> DataFrame:
    """(a, b), a < b: the distinct fingerprints (fp) that differ in at most `most` bits, 1 or 2.

    64 bits are cut into two segments, of which one is wrong in at most one bit; equal one-wildcard variants of segments meet and are
    verified. A key with more than TOGETHER members is not compared but cut again in the same way within the bits still free,
    until few are left: at the last level they differ in four bits at most. So every pair is found, and a crowded
    key costs rows in proportion to its members, never their square.
    """
    if most not in (1, 2):
        raise ValueError("most must be 1 or 2")
    spark = distinct.sparkSession
    zero = {"key": F.lit(0).cast("long"), "low": F.lit(0), "width": F.lit(BITS), "left": F.lit(most)}
    rows, found = cut_finer(distinct.select("fp", *[v.alias(k) for k, v in zero.items()])), []
    while True:
        sizes = rows.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
        with measured_broadcasts(spark):
            met = keep(rows.join(sizes, "key"))
        crowded = (F.col("members") > TOGETHER) & (F.col("width") > 1)
        few = met.where(~crowded).select("key", "fp")
        pairs = few.alias("x").join(few.alias("y").hint("merge"), "key").where(F.col("x.fp") < F.col("y.fp"))
        apart = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp")))
        found.append(pairs.where(apart <= most).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")))
        many = met.where(crowded)
        if many.isEmpty():
            break
        rows = cut_finer(many.select("fp", "key", "low", "width", "left"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 3, seed: int = 42, most: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable over links, itself included).

    Documents link when their fingerprints differ in at most `most` bits. Equal fingerprints are one class, which stands for
    its smallest doc_id; links are searched among classes only, so copies never meet again.

    NULL, empty and blank texts have fingerprint zero and link like any other. Rows with one doc_id are one document in links, and
    each gives a row. A row without doc_id has its fingerprint and component_id NULL; it links nothing. An empty table gives no rows; further columns are ignored.
    """
    rows = keep(fingerprints(docs, id, text, size, seed))
    classes = keep(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id")))
    pairs = close_pairs(classes.select("fp"), most)
    # A class that has the id of another one as its own smallest is the same document: both get one node.
    ends = classes.select(F.col("fp").alias("a"), F.col("id").alias("from"))
    links = pairs.join(ends, "a").join(classes.select(F.col("fp").alias("b"), F.col("id").alias("to")), "b").select(F.col("from").alias("a"), F.col("to").alias("b"))
    with measured_broadcasts(docs.sparkSession):
        placed = keep(rows.join(classes, "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("id")).alias("id")))
        several = placed.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")
        same = placed.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("id").alias("b")).where("a < b").distinct()
        groups = components(links.union(same))
    # This join runs later, as part of what the caller does.
    return placed.join(groups.hint("merge"), "id", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint"), F.coalesce("component", "id").alias("component_id")
    )
