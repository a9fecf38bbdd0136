"""Divergence of the sources of a language, counted over a vocabulary held in minimal acyclic transducers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuelens.llm.storage import keep
from venuelens.llm.transducer import Transducer, build
from venuelens.llm.words import slices, strings_of, words_of

#: Letters: a-z (A-Z are lower-cased before) and all that is not ASCII.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[0x61:0x7B] = LETTERS[0x80:] = True

#: Terms of one transducer, and bytes of the transducers that a pass over the text holds at once.
PIECE, BLOCK_BYTES = 1 << 16, 32 << 20

#: Counts of one comparison task (sources x terms), and sources whose pairs one task lists.
CELLS, SIDE = 1 << 18, 256

SCALE = 1_000_000_000


def _terms(texts: pa.Array) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """The distinct terms of some texts; number and row of every occurrence."""
    w = words_of(texts, LETTERS)
    found = strings_of(w, LETTERS).dictionary_encode()
    return found.dictionary, found.indices.to_numpy().astype(np.int64), w.rows


def _codes(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    encoded = column.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)


def _narrow(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((text, "text"), (lang, "lang"), (source, "source"))])


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """(lang, term) of the terms in at least `least` documents of the language. Counted within pieces of a task, then over all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 16 << 20):
                terms, codes, rows = _terms(batch.column("text"))
                langs, lang = _codes(batch.column("lang"))
                size = max(len(terms), 1)
                once = np.unique(rows * size + codes)
                pairs, n = np.unique(lang[once // size] * size + once % size, return_counts=True)
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(pairs // size)), terms.take(pa.array(pairs % size)), pa.array(n)], ["lang", "term", "n"])

    counted = docs.select("text", "lang").mapInArrow(run, "lang string, term string, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term")


def vocabulary(terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, term, piece, at) of distinct terms, and (lang, piece, n, bytes, ...) with the transducer of each piece.

    Terms are sorted by ranges over all tasks; a piece is a run of at most PIECE terms of one language, so that each is built from a bounded group.
    `at` is the place of a term within its piece; pieces follow the order of the terms.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, piece, at, last = TaskContext.get().partitionId(), -1, 0, None
        for batch in batches:
            pieces, places = [], []
            for lang in batch.column("lang").to_pylist():
                if lang != last or at == PIECE:
                    piece, at, last = piece + 1, 0, lang
                pieces.append(task << 32 | piece)
                places.append(at)
                at += 1
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("term"), pa.array(pieces, pa.int64()), pa.array(places, pa.int32())], ["lang", "term", "piece", "at"])

    def one(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        machine = build(group.column("term").cast(pa.binary()).to_pylist())
        parts = machine.to_bytes()
        row = {"lang": group.column("lang")[0].as_py(), "piece": group.column("piece")[0].as_py(), "n": len(group), "states": len(machine.final), "bytes": sum(map(len, parts.values())), **parts}
        return pa.Table.from_pylist([row], schema=made)

    made = pa.schema([("lang", pa.string()), ("piece", pa.int64()), ("n", pa.int64()), ("states", pa.int32()), ("bytes", pa.int64()), *[(c, pa.binary()) for c in ("label", "target", "output", "final")]])
    ordered = terms.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    placed = keep(ordered.mapInArrow(cut, "lang string, term string, piece long, at int"))
    pieces = placed.groupBy("piece").applyInArrow(one, "lang string, piece long, n long, states int, bytes long, label binary, target binary, output binary, final binary")
    return placed, keep(pieces)


def recount(docs: DataFrame, pieces: DataFrame) -> DataFrame:
    """(lang, source, piece, at, n): occurrences of every term of the vocabulary in each source of its language.

    The text streams through the transducers of a block of at most BLOCK_BYTES, which every task holds; a larger
    vocabulary takes several passes over the text. Each piece of a task sends one row for a term and source that it holds.
    """
    spark = docs.sparkSession
    sizes = pieces.select("piece", "bytes").orderBy("piece").collect()  # one short row for every PIECE terms
    blocks: list[list[int]] = []
    room = 0
    for row in sizes:
        if not blocks or row["bytes"] > room:
            blocks.append([])
            room = BLOCK_BYTES
        blocks[-1].append(row["piece"])
        room -= row["bytes"]
    out = spark.createDataFrame([], "lang string, source string, piece long, at int, n long")
    for block in blocks:
        rows = pieces.where(F.col("piece").between(block[0], block[-1])).toArrow()
        shared = spark.sparkContext.broadcast(rows.to_pylist())
        counts = docs.mapInArrow(_counter(shared), out.schema).groupBy("lang", "source", "piece", "at").agg(F.sum("n").alias("n"))
        counts = keep(counts)
        shared.destroy()
        out = counts if len(blocks) == 1 else out.union(counts)
    return out


def _counter(shared):
    names = ["lang", "source", "piece", "at", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines: dict[str, list[tuple[int, Transducer]]] = {}
        for r in shared.value:
            machines.setdefault(r["lang"], []).append((r["piece"], Transducer.from_bytes(r["label"], r["target"], r["output"], r["final"], r["states"])))
        for whole in batches:
            for batch in slices(whole, "text", 16 << 20):
                terms, codes, rows = _terms(batch.column("text"))
                langs, lang = _codes(batch.column("lang"))
                sources, source = _codes(batch.column("source"))
                size, wide = max(len(terms), 1), max(len(sources), 1)
                group, n = np.unique((lang[rows] * wide + source[rows]) * size + codes, return_counts=True)
                code, source_of, lang_of = group % size, group // size % wide, group // size // wide
                _, offsets, data = terms.buffers()
                ends = np.frombuffer(offsets, np.int32)[terms.offset : terms.offset + len(terms) + 1].astype(np.int64)
                data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
                for number, name in enumerate(langs.to_pylist()):
                    mine = np.flatnonzero(lang_of == number)
                    there, back = np.unique(code[mine], return_inverse=True)
                    for piece, machine in machines.get(name, ()):
                        ordinal = machine.ordinals(data, ends[there], ends[there + 1])[back]
                        hit = mine[ordinal >= 0]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([name] * len(hit), pa.string()), sources.take(pa.array(source_of[hit])), pa.array(np.full(len(hit), piece, np.int64)),
                                pa.array(ordinal[ordinal >= 0].astype(np.int32)), pa.array(n[hit], pa.int64()),
                            ],
                            names,
                        )

    return run


def _p(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + size)), exact beyond 64 bits."""
    up = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", up, (total + size).cast("decimal(20,0)"))


def _f(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / q); fits, as p and q are at most SCALE + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _pairs(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums of f over one run of terms, for every source marked `own` against every other source.

    Only terms that one of both has are computed; for all others f is one number for a pair.
    """
    names, own = right.column("source").to_pylist(), right.column("own").to_numpy(zero_copy_only=False)
    zero, run = right.column("zero").to_numpy(), right.column("run")[0].as_py()
    number = {s: i for i, s in enumerate(names)}
    p = np.repeat(zero[:, None], run, axis=1)
    has = np.zeros(p.shape, dtype=bool)
    if len(left):
        at = (np.array([number[s] for s in left.column("source").to_pylist()]), left.column("column").to_numpy())
        p[at], has[at] = left.column("p").to_numpy(), True
    total = np.zeros((len(names), len(names)), dtype=np.int64)
    for i in range(len(names)):
        mine = np.flatnonzero(has[i])
        if own[i]:
            total[i] += _gaps(p[i, mine], p[:, mine]).sum(axis=1)
        # i as the second of a pair, where the first lacks the term
        total[own, i] += np.where(has[own][:, mine], 0, _gaps(zero[own][:, None], p[i, mine])).sum(axis=1)
    flat = has.astype(np.float64)
    either = flat.sum(axis=1)[:, None] + flat.sum(axis=1)[None, :] - flat @ flat.T
    total += _gaps(zero[:, None], zero[None, :]) * (run - either.astype(np.int64))
    first, second = np.nonzero(own[:, None] & ~np.eye(len(names), dtype=bool))
    names = pa.array(names, pa.string())
    return pa.table({"lang": pa.array([key[0].as_py()] * len(first), pa.string()), "source": names.take(pa.array(first)), "item": names.take(pa.array(second)), "value": total[first, second]})


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 3, most: int = 200) -> DataFrame:
    """How far the sources of a language differ: (lang, source, part, item, value, rank).

    A language keeps the V terms (runs of letters, A-Z lower-cased) of at least `least` of its documents. Each (lang, source) group and each
    language gives a kept term p = 1 + floor(10**9 * (count + 1) / (N + V)); N is the sum of its counts. With f = floor((p - q)**2 / q) and the group's p,
    part `pair` has f against every other source of the language, summed over all kept terms, and part `term` the first `most` terms
    of the group with p > q, the language's. Ranks: value descending, then item ascending (terms by their ordinal). All numbers are exact.

    NULL texts, languages and sources are empty ones; repeated rows are documents of their own. A source without a kept term still has its pairs; a
    language with one source has none, and in one that keeps no term all pairs have value 0. An empty table gives no rows; further columns are ignored.
    """
    docs = _narrow(docs, text, lang, source)
    placed, pieces = vocabulary(kept_terms(docs, least))
    before = Window.partitionBy("lang").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    # One row for every PIECE terms.
    starts = keep(pieces.select("lang", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), "n"))
    counts = recount(docs, pieces).join(starts.select("piece", "start"), "piece").select("lang", "source", (F.col("start") + F.col("at")).alias("ordinal"), "n")
    counts = keep(counts)
    sizes = starts.groupBy("lang").agg(F.sum("n").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "v"])
    groups = keep(groups)
    ps = keep(counts.join(groups, ["lang", "source"]).withColumn("p", _p(F.col("n"), F.col("total"), F.col("v"))).select("lang", "source", "ordinal", "p"))

    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("m"))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.first("v").alias("v"), F.count("*").alias("sources"))
    qs = whole.join(langs, "lang").select("lang", "ordinal", _p(F.col("m"), F.col("total"), F.col("v")).alias("q"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    above = ps.join(qs, ["lang", "ordinal"]).where("p > q").select("lang", "source", "ordinal", _f(F.col("p"), F.col("q")).alias("value"))
    top = above.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
    named = placed.join(starts.select("piece", "start"), "piece").select("lang", (F.col("start") + F.col("at")).alias("ordinal"), F.col("term").alias("item"))
    terms = top.join(named, ["lang", "ordinal"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    # Each task compares the sources of a language on one run of terms, so that its counts are at most CELLS.
    run = F.greatest(F.lit(1), F.floor(F.lit(CELLS) / F.col("sources")))
    plan = langs.select("lang", "v", run.alias("run"), F.ceil(F.col("sources") / SIDE).alias("sides"))
    left = ps.join(plan, "lang").select("lang", "source", "p", F.floor(F.col("ordinal") / F.col("run")).alias("part"), (F.col("ordinal") % F.col("run")).cast("int").alias("column"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)).alias("side"))
    last = F.greatest(F.lit(0).cast("long"), F.ceil(F.col("v") / F.col("run")) - 1)
    right = (
        groups.drop("v").join(plan, "lang")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("side", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)))
        .select(
            "lang", "source", "part", "side", (F.pmod(F.xxhash64("source"), F.col("sides")) == F.col("side")).alias("own"),
            F.when(F.col("v") == 0, 1).otherwise(_p(F.lit(0), F.col("total"), F.greatest(F.col("v"), F.lit(1)))).cast("long").alias("zero"),
            F.least(F.col("run"), F.col("v") - F.col("part") * F.col("run")).cast("int").alias("run"),
        )
    )
    key = ["lang", "part", "side"]
    sums = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_pairs, "lang string, source string, item string, value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    near = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = sums.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(near).alias("rank"))
    return pairs.union(terms)
