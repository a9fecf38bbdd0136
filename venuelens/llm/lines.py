"""Substring dedup by unit hashing: of every line or sentence that occurs again, the earliest occurrence stays."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelens.llm.storage import keep
from venuelens.llm.words import ALNUM, char_offsets, mix, slices, words_of

_MARKS = np.zeros(256, dtype=bool)
_MARKS[[0x21, 0x2E, 0x3F]] = True
_SEED = np.uint64(0xA0761D6478BD642F)
_UNITS = "array<struct<start: int, end: int, high: long, low: long>>"


def units_of(texts: pa.Array, sentences: bool, least: int) -> list[list[dict]]:
    """Units of each text that have `least` words or more: code points from the first word to the end, and a 128-bit digest.

    A unit is a line, or with `sentences` what of a line ends with . ! or ? before white space. It is normalised to its words (runs of letters
    and digits, A-Z lower-cased), so that blanks and punctuation don't matter.
    """
    w = words_of(texts, ALNUM)
    out: list[list[dict]] = [[] for _ in range(len(w.first) - 1)]
    if not len(w.starts):
        return out
    cut = w.data == 0x0A
    if sentences:
        blank = np.append(np.isin(w.data[1:], np.array([0x20, 0x09, 0x0D, 0x0A], np.uint8)), True)
        cut |= _MARKS[w.data] & blank
    cuts = np.flatnonzero(cut)
    unit = np.searchsorted(cuts, w.starts) + w.rows  # grows by a cut, or by the next row
    first = np.flatnonzero(np.diff(unit, prepend=-1) != 0)
    after = np.append(first[1:], len(w.starts))
    count = after - first
    # Sums of hashes that also depend on the place in the unit, so that the order of words counts.
    place = (np.arange(len(w.starts)) - np.repeat(first, count)).astype(np.uint64)
    high = np.add.reduceat(mix(w.hashes + mix(place)), first)
    low = np.add.reduceat(mix((w.hashes ^ _SEED) + mix(place ^ _SEED)), first)
    chosen = np.flatnonzero(count >= least)
    if not len(chosen):
        return out
    rows = w.rows[first[chosen]]
    # A unit ends where its last word does, or behind the marks that follow it.
    stop = w.ends[after[chosen] - 1]
    heads = char_offsets(w.data, np.stack([w.starts[first[chosen]], stop, w.offsets[rows]], axis=1))
    for r, s, e, h, l in zip(rows.tolist(), (heads[:, 0] - heads[:, 2]).tolist(), (heads[:, 1] - heads[:, 2]).tolist(), high[chosen].view(np.int64).tolist(), low[chosen].view(np.int64).tolist()):
        out[r].append({"start": s, "end": e, "high": h, "low": l})
    return out


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(doc_id, text, row): `row` is a digest of the text."""
    return docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("row", F.xxhash64("text"))


def repeated_units(docs: DataFrame, id: str = "doc_id", text: str = "text", sentences: bool = True, least: int = 8) -> DataFrame:
    """(doc_id, row, start, end, first_doc): every unit of `least` words or more that isn't the earliest of its kind.

    A row is told by its doc_id and `row`, a digest of its text, so rows without id and texts that share an id stay apart. Earliest: smallest
    doc_id, then row, then start; NULL ids come last, and equal rows are one occurrence, so they lose nothing to each other.
    Digests are counted with pre-aggregation; only those that occur again are joined back, and a frequent one is split by adaptive
    skew joins. Empty tables and texts, and NULL texts, have no units.
    """
    narrow = _rows(docs, id, text)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    place = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("high", pa.int64()), ("low", pa.int64())]))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "row": batch.column("row"), "units": pa.array(units_of(batch.column("text"), sentences, least), place)})

    units = keep(narrow.mapInArrow(run, f"doc_id {kind}, row long, units {_UNITS}").select("doc_id", "row", F.inline("units")))
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row", "start")
    first = units.groupBy("high", "low").agg(F.min(rank).alias("least"), F.max(rank).alias("most")).where("least <> most")
    # Kept, so that the join deals both sides itself and Spark can split a frequent digest.
    first = keep(first.select("high", "low", "least"))
    again = units.join(first, ["high", "low"]).where(rank != F.col("least"))
    return again.select("doc_id", "row", "start", "end", F.col("least.doc_id").alias("first_doc"))


def drop_repeated_units(docs: DataFrame, id: str = "doc_id", text: str = "text", sentences: bool = True, least: int = 8) -> DataFrame:
    """One row per document: doc_id, text without its repeated units, n_removed, removed and kept stretches of the original text.

    `removed` (start, end, first_doc) and `kept` (start, end) are in code points of the original, end exclusive; the new text is the kept
    stretches one after another. Marks and blanks that followed a removed unit go with it. Rules as in `repeated_units`; NULL texts stay NULL.
    """
    found = repeated_units(docs, id, text, sentences, least)
    gone = found.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(F.sort_array(F.collect_set(F.struct("start", "end", "first_doc"))).alias("removed"))
    narrow = _rows(docs, id, text)
    same = (F.col("row") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    joined = narrow.join(gone, same, "left").select("doc_id", "text", "removed")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    stretch = [("start", pa.int32()), ("end", pa.int32())]
    first_doc = joined.schema["removed"].dataType.elementType["first_doc"].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                texts, removed = batch.column("text").to_pylist(), batch.column("removed").to_pylist()
                done = [without(t, x or []) for t, x in zip(texts, removed)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([x[0] for x in done], pa.string()),
                        pa.array([len(x[1]) for x in done], pa.int32()),
                        pa.array([x[1] for x in done], batch.schema.field("removed").type),
                        pa.array([x[2] for x in done], pa.list_(pa.struct(stretch))),
                    ],
                    ["doc_id", "text", "n_removed", "removed", "kept"],
                )

    return joined.mapInArrow(
        run, f"doc_id {kind}, text string, n_removed int, removed array<struct<start: int, end: int, first_doc: {first_doc}>>, kept array<struct<start: int, end: int>>"
    )


_BEHIND = re.compile(r"[^\w\n]*\n?")


def without(text: str | None, removed: list[dict]) -> tuple[str | None, list[dict], list[dict]]:
    """The text without the removed units and what follows each up to the next word or line; the units; the kept stretches."""
    if text is None:
        return None, [], []
    kept, at = [], 0
    for unit in removed:
        if unit["start"] > at:
            kept.append({"start": at, "end": unit["start"]})
        at = max(at, _BEHIND.match(text, unit["end"]).end())
    if at < len(text):
        kept.append({"start": at, "end": len(text)})
    return "".join(text[x["start"] : x["end"]] for x in kept), removed, kept
