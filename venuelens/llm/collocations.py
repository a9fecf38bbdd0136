"""Phrases whose words hold together, by best-first growth under bounds from the counts of their beginnings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuelens.llm.membership import filter_of, may_hold
from venuelens.llm.storage import keep
from venuelens.llm.words import mix, slices, strings_of, words_of

#: Bytes that end a piece, and bytes of words.
ENDS = np.zeros(256, dtype=bool)
ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
LETTERS = ~ENDS
LETTERS[[0x09, 0x20]] = False

#: The frontier is expanded from the highest bound on: up to these shares of the occurrences of a language's first words, one round each.
SHARES = (1 / 8, 1 / 2, 1.0)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = "lang string, phrase string, key long, a long, keys array<long>, heads array<long>"


@dataclass
class Pieces:
    """The words of some texts: a key that holds word and language, and the number of the piece they stand in."""

    keys: np.ndarray
    piece: np.ndarray
    strings: pa.StringArray
    lang: np.ndarray  # by word, as a number
    langs: pa.Array

    def phrases(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1 to `size` words: the key of the phrase that begins at each word, and whether it stays within its piece.

        The arrays get shorter by one with every further word.
        """
        key = self.keys
        yield key, np.ones(len(key), dtype=bool)
        for m in range(2, min(size, len(self.keys)) + 1):
            key = extended(key[: len(key) - 1], self.keys[m - 1 :])
            yield key, self.piece[: len(key)] == self.piece[m - 1 :]


def extended(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a phrase followed by one more word."""
    return mix(key * _BASE + word)


def _pieces(batch: pa.RecordBatch) -> Pieces:
    w = words_of(batch.column("text"), LETTERS)
    langs = batch.column("lang").dictionary_encode()
    number = langs.indices.to_numpy().astype(np.int64)
    seeds = np.array([xxhash.xxh64_intdigest(x or "") for x in langs.dictionary.to_pylist()], dtype=np.uint64)
    lang = number[w.rows]
    ended = np.zeros(len(w.data) + 1, dtype=np.int32)
    np.cumsum(ENDS[w.data], out=ended[1:])
    new = np.ones(len(w.starts), dtype=bool)
    new[1:] = ended[w.starts[1:]] > ended[w.ends[:-1]]
    new[w.first[:-1][np.diff(w.first) > 0]] = True
    return Pieces(mix(w.hashes ^ seeds[lang]), np.cumsum(new), strings_of(w, LETTERS), lang, langs.dictionary)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[Pieces]:
    for whole in batches:
        for batch in slices(whole, "text", 8 << 20):
            yield _pieces(batch)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, key, n) of all words: counted within pieces of a task, then over all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in _each(batches):
            keys, at, n = np.unique(p.keys, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([p.langs.take(pa.array(p.lang[at])), p.strings.take(pa.array(at)), _long(keys), pa.array(n)], ["lang", "word", "key", "n"])

    return docs.mapInArrow(run, "lang string, word string, key long, n long").groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))


def _count_next(docs: DataFrame, size: int, beginnings: Broadcast, words: Broadcast) -> DataFrame:
    """(key, parent, last, n) of the phrases of `size` words whose beginning and last word may be among the given ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in _each(batches):
            if len(p.keys) < size:
                continue
            *_, (parent, _), (key, within) = p.phrases(size)
            at = np.flatnonzero(within)
            at = at[may_hold(words.value, p.keys[at + size - 1])]
            at = at[may_hold(beginnings.value, parent[at])]
            keys, index, n = np.unique(key[at], return_index=True, return_counts=True)
            at = at[index]
            yield pa.RecordBatch.from_arrays([_long(keys), _long(parent[at]), _long(p.keys[at + size - 1]), pa.array(n)], ["key", "parent", "last", "n"])

    counts = docs.mapInArrow(run, "key long, parent long, last long, n long")
    return counts.groupBy("key", "parent", "last").agg(F.sum("n").alias("n"))


def grow(docs: DataFrame, starts: DataFrame, known: DataFrame, words: Broadcast, most_words: int, least: int) -> list[DataFrame]:
    """Tables of phrases by number of words, from 2: all those that occur `least` times or more and begin with one of `starts`.

    `heads` has the counts of the first word, the first two and so on; every one of them bounds what a longer phrase can score.
    """
    level = starts.select("lang", F.col("word").alias("phrase"), "key", F.col("n").alias("a"), F.array("key").alias("keys"), F.array().cast("array<long>").alias("heads"))
    found = []
    for size in range(2, most_words + 1):
        beginnings = docs.sparkSession.sparkContext.broadcast(filter_of(level))
        counts = _count_next(docs, size, beginnings, words).where(F.col("n") >= least)
        before = level.select("lang", "phrase", F.col("key").alias("parent"), F.col("a").alias("head"), "keys", "heads")
        ends = known.select("word", F.col("key").alias("last"))
        longer = counts.join(before, "parent").join(ends, "last")
        level = keep(
            longer.select(
                "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "key", F.col("n").alias("a"),
                F.concat("keys", F.array("last")).alias("keys"), F.concat("heads", F.array("head")).alias("heads"),
            )
        )
        beginnings.destroy()
        if level.isEmpty():
            break
        found.append(level)
    return found


def _with_rests(level: DataFrame) -> DataFrame:
    """The phrases of one length with `rests`: the keys of what is left after the first word, the first two and so on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("keys").flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)
            rests = [reduce(extended, list(keys[:, k + 1 :].T), keys[:, k]) for k in range(1, keys.shape[1])]
            flat = np.stack(rests, axis=1)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * flat.shape[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, _long(flat.ravel()))], [*batch.schema.names, "rests"])

    return level.select("lang", "phrase", "key", "a", "keys", "heads").mapInArrow(run, f"{_LEVEL}, rests array<long>")


def inspect(docs: DataFrame, asked: DataFrame, most_words: int) -> DataFrame:
    """(key, n, before, after): how often the phrases of 2 to `most_words` words in `asked` (key) occur, and the one word that always stands before
    or after them; 0 if there are several, or none at a place. Some phrases that were not asked for may be among the rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filter_of(asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for p in _each(batches):
            same = p.piece[1:] == p.piece[:-1]
            before, after = np.zeros(len(p.keys), np.uint64), np.zeros(len(p.keys), np.uint64)
            before[1:][same], after[:-1][same] = p.keys[:-1][same], p.keys[1:][same]
            for m, (key, within) in enumerate(p.phrases(most_words), 1):
                if m == 1:
                    continue
                at = np.flatnonzero(within)
                at = at[may_hold(bits, key[at])]
                if not len(at):
                    continue
                at = at[np.argsort(key[at], kind="stable")]
                first = np.flatnonzero(np.append(True, key[at][1:] != key[at][:-1]))
                ends = [f.reduceat(x.view(np.int64), first) for x in (before[at], after[at + m - 1]) for f in (np.minimum, np.maximum)]
                yield pa.RecordBatch.from_arrays([_long(key[at[first]]), pa.array(np.diff(np.append(first, len(at)))), *map(pa.array, ends)], ["key", "n", "b0", "b1", "a0", "a1"])

    seen = docs.mapInArrow(run, "key long, n long, b0 long, b1 long, a0 long, a1 long").groupBy("key")
    seen = seen.agg(F.sum("n").alias("n"), F.min("b0").alias("b0"), F.max("b1").alias("b1"), F.min("a0").alias("a0"), F.max("a1").alias("a1"))
    one = lambda low, high: F.when(F.col(low) == F.col(high), F.col(low)).otherwise(0)
    seen = keep(seen.select("key", "n", one("b0", "b1").alias("before"), one("a0", "a1").alias("after")))
    shared.destroy()
    return seen


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), beyond 64 bits on the way."""
    whole = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (whole(a) * whole(n)).cast("decimal(34,0)"), whole(left) * whole(right))


def survivors(docs: DataFrame, levels: list[DataFrame], known: DataFrame, totals: DataFrame, most_words: int) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of `levels` that no longer phrase accounts for.

    A longer phrase with as many occurrences exists just when one more word does, always the same, before or after every occurrence. Counts of the
    rests that are not known from growth, and these words, are taken in one pass over the text.
    """
    phrases = keep(reduce(DataFrame.union, map(_with_rests, levels)))
    cuts = phrases.select("*", F.posexplode(F.arrays_zip(F.col("heads").alias("l"), F.col("rests").alias("rest"))).alias("place", "cut"))
    cuts = cuts.select("lang", "phrase", "key", "a", F.size("keys").alias("words"), (F.col("place") + 1).alias("k"), "cut.l", "cut.rest")
    asked = cuts.where(F.col("k") < F.col("words") - 1).select(F.col("rest").alias("key")).union(phrases.where(F.size("keys") < most_words).select("key"))
    seen = inspect(docs, asked, most_words - 1)
    rests = seen.select(F.col("key").alias("rest"), F.col("n").alias("r")).union(known.select("key", "n"))
    scored = cuts.join(rests, "rest").join(totals, "lang").withColumn("score", _score(F.col("a"), F.col("total"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "phrase", "key", "a", "words", F.col("total").alias("n")).agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    around = seen.select("key", "before", "after")
    left = lowest.join(around, "key", "left").where((F.col("words") == most_words) | ((F.col("before") == 0) & (F.col("after") == 0)))
    return left.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", most_words: int = 5, least: int = 100, top: int = 2000) -> DataFrame:
    """The `top` collocations of every language: (lang, rank, phrase, a, l, r, n, score), all counts over whole texts.

    Texts (A-Z lower-cased) are split into pieces and those into words. Candidates are phrases of 2 to `most_words` words that occur a >= `least` times within pieces of the
    language; n is its number of words. A candidate scores floor(1000 * a * n / (l * r)) at its lowest-scoring cut into a first part (l times) and
    a rest (r times); ties go to the shortest first part. Candidates inside a longer candidate with as many occurrences are dropped.
    Order: score and a descending, then the phrase by its bytes.

    Growth is best-first. The rest of a cut occurs at least as often as the phrase, so no phrase that begins with a word w scores over
    1000 * n / count(w): the rarest first words have the highest bounds. They are expanded in rounds (SHARES), word by word while
    the beginning is frequent enough. A language is settled, and its texts no longer read, once it has `top` survivors and its
    last score is above every bound that is left; equality is not enough, so ties are complete.

    NULL texts are empty; NULL is the language `und`. Repeated rows count again; tables without candidates give no rows; further columns are ignored.
    Words and phrases are told apart by 64-bit hashes within their language, phrases also by their beginning and last word.
    """
    if most_words < 2 or least < 1:
        raise ValueError("most_words must be at least 2 and least at least 1")
    docs = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    words = keep(count_words(docs))
    totals = keep(words.groupBy("lang").agg(F.sum("n").alias("total")))
    # Bands of bounds that differ by less than a factor of two: at most 63 rows a language.
    known = keep(words.where(F.col("n") >= least).withColumn("band", F.floor(F.log2("n")).cast("int")))
    sums = known.groupBy("lang", "band").agg(F.sum("n").alias("here"), F.min("n").alias("rarest"))
    before = Window.partitionBy("lang").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    share = F.coalesce(F.sum("here").over(before), F.lit(0)) / F.sum("here").over(Window.partitionBy("lang"))
    turn = reduce(Column.__add__, [(share >= s).cast("int") for s in SHARES[:-1]], F.lit(0))
    bands = keep(sums.withColumn("turn", turn))
    frequent = docs.sparkSession.sparkContext.broadcast(filter_of(known))

    best = docs.sparkSession.createDataFrame([], "lang string, phrase string, a long, l long, r long, n long, score long, rank long")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    open_texts = docs
    for r in range(len(SHARES)):
        starts = keep(known.join(bands.where(F.col("turn") == r).select("lang", "band"), ["lang", "band"]))
        levels = grow(open_texts, starts, known, frequent, most_words, least)
        if levels:
            found = best.drop("rank").union(survivors(open_texts, levels, known, totals, most_words))
            best = keep(found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top))
        last = best.where(F.col("rank") == top).select("lang", F.col("score").alias("last"))
        ahead = bands.where(F.col("turn") > r).groupBy("lang").agg(F.min("rarest").alias("rarest")).join(totals, "lang").join(last, "lang", "left")
        bound = _score(F.lit(1), F.col("total"), F.col("rarest"), F.lit(1))
        open_langs = keep(ahead.where(F.col("last").isNull() | (F.col("last") <= bound)).select("lang"))
        if open_langs.isEmpty():
            break
        # Settled languages leave: neither their texts nor their words are looked at again.
        open_texts = docs.join(open_langs, "lang", "left_semi")
        bands = keep(bands.join(open_langs, "lang", "left_semi"))
    frequent.destroy()
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
