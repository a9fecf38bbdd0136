"""Quality by perplexity under an interpolated modified Kneser-Ney bigram model of trusted text."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.llm.storage import keep, mark, no_leftovers, release
from venuelens.llm.words import NO_SPACE, Words, mix, slices, words_of

#: Numbers of the words outside the vocabulary and of the start of a text; vocabulary words follow.
RARE, START = 0, 1

#: Bits of the filter that tells most bigrams that were never seen from those of the table; a fixed 16 MB.
FILTER, BLOCK = 1 << 27, 1 << 16

#: A group of requests meets about so many rows of the table and stems from about so many bytes of text; a piece of a task holds about so many requests.
LISTED, TEXT, PIECE = 1 << 18, 1 << 25, 1 << 20

#: Deals bigrams to passes and groups, see `_place`.
SPREAD = 1_000_003


@dataclass
class Lower:
    """What every task holds: at most 40 bytes a vocabulary word, 16 a head bigram (each has `head` of all or more), and the filter."""

    words: np.ndarray  # ascending hashes of the vocabulary; word i has number i + 2
    weight: np.ndarray  # log of the weight of the lower order after a word, by number
    continuation: np.ndarray  # log of the continuation probability of a word, by number
    rare: float  # log of the share of one word among those outside the vocabulary
    head: np.ndarray  # ascending keys of the frequent bigrams
    gain: np.ndarray  # what seeing the bigram adds to the log of the lower order's share
    filter: np.ndarray | None = None  # one bit for each hash of a bigram of the table, as bytes
    listed: int = 0  # rows of the table
    begin: np.ndarray | None = None  # place of the first word whose hash has these leading bits, or more; two to four places a word, made by the worker

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(hashes), RARE, dtype=np.int64)
        if self.begin is None:
            self.begin = _begin(self.words)
        last = len(self.words) - 1
        at = self.begin[(hashes >> np.uint64(65 - len(self.begin).bit_length())).astype(np.int64)].astype(np.int64)
        behind = np.flatnonzero(self.words[at] < hashes)
        while len(behind):
            behind = behind[at[behind] < last]
            at[behind] += 1
            behind = behind[self.words[at[behind]] < hashes[behind]]
        return np.where(self.words[at] == hashes, at + 2, RARE)


def _begin(words: np.ndarray) -> np.ndarray:
    """For every value of the leading bits the place of the first of the ascending hashes that is not below it, the last place at most."""
    bits = len(words).bit_length() + 1
    leading = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.minimum(np.searchsorted(words, leading), len(words) - 1).astype(np.int32)


def _bigrams(w: Words, lower: Lower) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the word before (START for the first of a text) and of the word itself, and the row of each."""
    second = lower.numbers(w.hashes)
    first = np.empty_like(second)
    first[1:] = second[:-1]
    starts = w.first[:-1][np.diff(w.first) > 0]
    first[starts] = START
    return first, second, w.rows


def _counted(docs: DataFrame, lower: Lower | None) -> DataFrame:
    """(key, n): words, or bigrams once the vocabulary is known, counted within every piece of a task and then over all."""
    shared = docs.sparkSession.sparkContext.broadcast(lower)

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 16 << 20):
                w = words_of(batch.column("text"), NO_SPACE)
                if shared.value is None:
                    keys = w.hashes.view(np.int64)
                else:
                    first, second, _ = _bigrams(w, shared.value)
                    keys = (first << 32) | second
                keys, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.int64()), "n": pa.array(n, pa.int64())})

    return docs.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _discounts(counts: dict[int, int]) -> tuple[float, float, float]:
    """Discounts of modified Kneser-Ney for counts of 1, 2 and more, from how many have counts of 1 to 4."""
    n1, n2, n3, n4 = (max(float(counts.get(i, 0)), 0.5) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(d, 0.05), cap) for d, cap in ((1 - 2 * y * n2 / n1, 0.95), (2 - 3 * y * n3 / n2, 1.9), (3 - 4 * y * n4 / n3, 2.9)))


def _counts_of(df: DataFrame, column: str) -> dict[int, int]:
    return {r[column]: r["count"] for r in df.where(F.col(column) <= 4).groupBy(column).count().collect()}


def _discount(n: Column, d: tuple[float, float, float]) -> Column:
    return F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


def _filter(table: DataFrame) -> np.ndarray:
    """The FILTER bits that the keys' hashes set. Tasks send positions by block; a block's bits are put together in one group."""

    def positions(batches):
        keys = [b.column("key").to_numpy() for b in batches]
        if keys:
            at = np.sort(mix(np.concatenate(keys).view(np.uint64)) & np.uint64(FILTER - 1))
            blocks, first = np.unique(at // np.uint64(BLOCK), return_index=True)
            parts = np.split((at % np.uint64(BLOCK)).astype("<u2"), first[1:])
            yield pa.RecordBatch.from_pydict({"block": pa.array(blocks.astype(np.int32)), "at": [x.tobytes() for x in parts]})

    def union(group: pa.Table) -> pa.Table:
        bits = np.zeros(BLOCK, dtype=bool)
        for x in group.column("at").to_pylist():
            bits[np.frombuffer(x, "<u2")] = True
        return pa.table({"block": group.column("block")[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    with no_leftovers(table.sparkSession):
        found = table.select("key").mapInArrow(positions, "block int, at binary").groupBy("block").applyInArrow(union, "block int, bits binary").toArrow()
    out = np.zeros((FILTER // BLOCK, BLOCK // 8), dtype=np.uint8)
    for block, bits in zip(found.column("block").to_pylist(), found.column("bits").to_pylist()):
        out[block] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def _may_be_listed(lower: Lower, keys: np.ndarray) -> np.ndarray:
    at = (mix(keys.view(np.uint64)) & np.uint64(FILTER - 1)).astype(np.int64)
    return (lower.filter[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _in_head(lower: Lower, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key among the frequent bigrams, and whether it is one."""
    at = np.minimum(np.searchsorted(lower.head, keys), max(len(lower.head) - 1, 0))
    return at, lower.head[at] == keys if len(lower.head) else np.zeros(len(keys), bool)


def _place(v, w, parts: int):
    """The part of a bigram, for arrays and for columns alike."""
    return (v * SPREAD + w) % parts


def _packed(x: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones, and so on, compressed: ascending numbers as differences take little room."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    plain = pa.decompress(data, decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(size, n).T).view(kind).ravel()


def _requests(docs: np.ndarray, keys: np.ndarray, at: np.ndarray, passes: int, buckets: int) -> pa.RecordBatch:
    """A row for each bucket of a piece: its bigrams and the places of their documents in the piece. The row without keys has the documents.

    The number of the piece is a hash of its documents in their order, so a task run again gives the same.
    """
    piece = mix(docs.view(np.uint64) + np.arange(len(docs), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).sum().astype(np.int64)
    bucket = _place(keys >> 32, keys & 0xFFFFFFFF, passes * buckets) // passes
    order = np.lexsort((keys, bucket))
    bucket, keys, at = bucket[order], keys[order], at[order].astype(np.int32)
    begin = np.flatnonzero(np.diff(bucket, prepend=-1))
    cuts = list(zip(begin, np.append(begin[1:], len(keys))))
    return pa.RecordBatch.from_pydict({
        "piece": pa.array([piece] * (len(cuts) + 1), pa.int64()),
        "bucket": pa.array([*bucket[begin], piece % buckets], pa.int32()),
        "n": pa.array([*(j - i for i, j in cuts), len(docs)], pa.int32()),
        "keys": pa.array([*(_packed(np.diff(keys[i:j], prepend=0)) for i, j in cuts), None], pa.binary()),
        "at": pa.array([*(_packed(at[i:j]) for i, j in cuts), _packed(docs)], pa.binary()),
    })


def _answers(asked: pa.Table, listed: pa.Table) -> pa.Table:
    """What the bigrams of a bucket add to the documents of each piece. Rows with documents pass through."""
    order = np.argsort(listed.column("key").to_numpy())
    key, gain = listed.column("key").to_numpy()[order], listed.column("gain").to_numpy()[order]
    rows = []
    for batch in asked.to_batches():
        for piece, n, keys, at in zip(*(batch.column(c) for c in ("piece", "n", "keys", "at"))):
            piece, n = piece.as_py(), n.as_py()
            if not keys.is_valid:
                rows.append((piece, n, at.as_py(), None))
            elif len(key):
                wanted = np.cumsum(_unpacked(keys.as_py(), n, np.int64))
                found = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
                hit = key[found] == wanted
                who, back = np.unique(_unpacked(at.as_py(), n, np.int32)[hit], return_inverse=True)
                if len(who):
                    rows.append((piece, len(who), _packed(np.diff(who, prepend=np.int32(0))), _packed(np.bincount(back, gain[found[hit]]))))
    kinds = {"piece": pa.int64(), "n": pa.int32(), "at": pa.binary(), "gains": pa.binary()}
    return pa.table({c: pa.array([r[i] for r in rows], kind) for i, (c, kind) in enumerate(kinds.items())})


def _gained(piece: pa.Table) -> pa.Table:
    """(doc, gained) of a piece: the answers of all buckets added up."""
    rows = piece.to_pylist()
    docs = next((_unpacked(r["at"], r["n"], np.int64) for r in rows if r["gains"] is None), None)
    if docs is None:
        raise RuntimeError("the documents came in another order when a task ran again; write them to a table first")
    sums = np.zeros(len(docs))
    for r in rows:
        if r["gains"] is not None:
            sums[np.cumsum(_unpacked(r["at"], r["n"], np.int32))] += _unpacked(r["gains"], r["n"], np.float64)
    some = np.flatnonzero(sums)
    return pa.table({"doc": docs[some], "gained": sums[some]})


def fit(trusted: DataFrame, text: str = "text", share: float = 0.0, head: float = 2e-7) -> tuple[Lower, DataFrame]:
    """The model of all of `trusted`: what is broadcast, and the table (key, gain) of the other bigrams.

    P(w | v) = max(c(vw) - D(c), 0) / c(v) + weight(v) * continuation(w), and the continuation is discounted in the same way towards the
    uniform distribution. Bigrams with `head` of all or more are broadcast, the others stay in the table. A word seen twice or more is in the
    vocabulary however large the input is; words seen once are one class to the model, shared out evenly among them. A `share` above 0 also
    asks for that share of all words. All counts are taken over all trusted text. What is gathered is the vocabulary, which grows more slowly
    than the text, 1 / head bigrams and a filter of fixed size over the others. Without trusted text every word is equally likely.
    """
    docs = trusted.select(F.col(text).cast("string").alias("text"))
    empty = np.zeros(0)
    lower = Lower(np.zeros(0, np.uint64), np.zeros(2), np.zeros(2), 0.0, np.zeros(0, np.int64), empty)
    before_fit = mark()
    words = keep(_counted(docs, None))
    total = words.agg(F.sum("n")).first()[0] or 0
    if total:
        known = words.where(F.col("n") >= max(2.0, share * total)).select("key").toArrow().column("key").to_numpy()
        lower.words = np.sort(known.view(np.uint64))
        lower.rare = -float(np.log(words.count() - len(known) + 1))
    release(trusted.sparkSession, before_fit)
    size = len(lower.words) + 2
    pairs = keep(_counted(docs, lower))
    d = _discounts(_counts_of(pairs, "n"))
    first, second = F.shiftright("key", 32).alias("v"), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("w")
    # One row per vocabulary word.
    before = pairs.groupBy(first).agg(F.sum("n").alias("c"), F.sum(_discount(F.col("n"), d)).alias("freed")).toArrow()
    types = keep(pairs.groupBy(second).agg(F.count("*").cast("long").alias("types")))
    e = _discounts(_counts_of(types, "types"))
    after = types.toArrow()
    weight, c = np.zeros(size), np.zeros(size)
    c[before.column("v").to_numpy()] = before.column("c").to_numpy()
    weight[before.column("v").to_numpy()] = np.log(before.column("freed").to_numpy() / before.column("c").to_numpy())
    met = np.zeros(size)
    met[after.column("w").to_numpy()] = after.column("types").to_numpy()
    cut = np.where(met >= 3, e[2], np.where(met == 2, e[1], np.where(met == 1, e[0], 0.0)))
    all_types = max(met.sum(), 1.0)
    freed = cut.sum() if met.sum() else 1.0
    lower.weight, lower.continuation = weight, np.log((met - cut) / all_types + freed / all_types / size)
    shared = trusted.sparkSession.sparkContext.broadcast((lower.weight, lower.continuation, c, d))

    def gains(batches):
        weight, continuation, c, d = shared.value
        for batch in batches:
            key, n = batch.column("key").to_numpy(), batch.column("n").to_numpy()
            v, w = key >> 32, key & 0xFFFFFFFF
            seen = (n - np.where(n == 1, d[0], np.where(n == 2, d[1], d[2]))) / c[v]
            gain = np.log1p(seen / np.exp(weight[v] + continuation[w]))
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "gain": gain})

    # Of what was written the counts of bigrams stay; they take half the room of the gains, which are computed where they are read.
    release(trusted.sparkSession, before_fit + 1)
    frequent = F.col("n") >= max(2.0, head * total)
    top = pairs.where(frequent).mapInArrow(gains, "key long, gain double").toArrow()
    order = np.argsort(top.column("key").to_numpy())
    lower.head, lower.gain = top.column("key").to_numpy()[order], top.column("gain").to_numpy()[order]
    rest = pairs.where(~frequent)
    lower.listed, lower.filter = rest.count(), _filter(rest)
    table = rest.mapInArrow(gains, "key long, gain double")
    return lower, table


def perplexity(docs: DataFrame, model: tuple[Lower, DataFrame], id: str = "doc_id", text: str = "text", passes: int = 4) -> DataFrame:
    """(doc_id, n_tokens, perplexity) of every whole text.

    The lower order and frequent bigrams are scored where the text is. Every other bigram of a text that may be listed, by the filter, is asked
    for: a task packs what a piece of its texts asks of a bucket of the sharded table into one row, a bucket's requests meet its rows in one group, and
    the piece gets sums by document back. The number of buckets follows the table and the bytes of text, so a group stays small.
    Texts are not dealt out: further passes over them cost less. The bigrams are dealt to `passes` passes over the texts, each with its share of
    the table; what a pass has exchanged goes when its sums are written, so the disk holds one pass at a time. NULL and blank texts have no
    tokens and perplexity NULL; rows equal in id and text are scored once and returned as often as they occur.
    """
    lower, table = model
    shared = docs.sparkSession.sparkContext.broadcast(lower)
    narrow = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("doc", F.xxhash64("doc_id", "text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(lower.listed // LISTED, size // TEXT) // passes + 1

    def parts(batches):
        lower = shared.value
        for whole in batches:
            for batch in slices(whole, "text"):
                w = words_of(batch.column("text"), NO_SPACE)
                v, x, rows = _bigrams(w, lower)
                yield batch, w, v, x, rows, (v << 32) | x

    def local(batches):
        lower = shared.value
        for batch, w, v, x, rows, key in parts(batches):
            at, is_head = _in_head(lower, key)
            logs = lower.weight[v] + lower.continuation[x] if len(v) else np.zeros(0)
            if is_head.any():
                logs = logs + np.where(is_head, lower.gain[at], 0.0)
            logs = logs + np.where(x == RARE, lower.rare, 0.0)
            sums = np.bincount(rows, logs, batch.num_rows).astype(np.float64)
            yield pa.RecordBatch.from_pydict({"doc": batch.column("doc"), "doc_id": batch.column("doc_id"), "n_tokens": pa.array(np.diff(w.first), pa.int64()), "logs": sums})

    def asking(number: int):
        def run(batches):
            docs, keys, at = [], [], []
            for batch, _, v, x, rows, key in parts(batches):
                tail = np.flatnonzero(_place(v, x, passes) == number)
                tail = tail[_may_be_listed(shared.value, key[tail])]
                tail = tail[~_in_head(shared.value, key[tail])[1]]
                at.append(rows[tail] + sum(map(len, docs)))
                keys.append(key[tail])
                docs.append(batch.column("doc").to_numpy())
                if sum(map(len, keys)) >= PIECE:
                    yield _requests(*map(np.concatenate, (docs, keys, at)), passes, buckets)
                    docs, keys, at = [], [], []
            if sum(map(len, keys)):
                yield _requests(*map(np.concatenate, (docs, keys, at)), passes, buckets)

        return run

    rows = narrow.mapInArrow(local, f"doc long, doc_id {kind}, n_tokens long, logs double")
    rows = rows.groupBy("doc", "doc_id").agg(F.first("n_tokens").alias("n_tokens"), F.first("logs").alias("logs"), F.count("*").cast("int").alias("copies"))
    place = _place(F.shiftright("key", 32), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)), passes * buckets)
    sums = []
    for number in range(passes):
        asked = narrow.mapInArrow(asking(number), "piece long, bucket int, n int, keys binary, at binary").groupBy("bucket")
        listed = table.where(place % passes == number).select(F.floor(place / passes).cast("int").alias("bucket"), "key", "gain").groupBy("bucket")
        answers = asked.cogroup(listed).applyInArrow(_answers, "piece long, n int, at binary, gains binary")
        sums.append(keep(answers.groupBy("piece").applyInArrow(_gained, "doc long, gained double")))
    gained = reduce(DataFrame.union, sums).groupBy("doc").agg(F.sum("gained").alias("gained"))
    logs = F.col("logs") + F.coalesce(F.col("gained") / F.col("copies"), F.lit(0.0))
    found = rows.join(gained, "doc", "left").withColumn("_", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    return found.select("doc_id", "n_tokens", F.when(F.col("n_tokens") > 0, F.exp(-logs / F.col("n_tokens"))).alias("perplexity"))


def judge(scored: DataFrame, languages: DataFrame, good: DataFrame, id: str = "doc_id", lang: str = "lang", quantile: float = 0.99) -> DataFrame:
    """`scored` with lang, threshold and keep: perplexity of at most the language's quantile among the documents of `good` (ids).

    A language without a good document takes the quantile of all good ones; without any, everything stays. Texts without tokens are not kept.
    NULL is a language of its own. `languages` has id and language of each document; of a repeated id the first language counts.
    """
    names = languages.select(F.col(id).alias("doc_id"), F.col(lang).alias("lang")).groupBy("doc_id").agg(F.min("lang").alias("lang"))
    rows = keep(scored.join(names, "doc_id", "left"))
    marked = rows.join(good.select(F.col(id).alias("doc_id")).distinct(), "doc_id", "left_semi")
    limits = marked.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("own"))
    whole = marked.agg(F.percentile_approx("perplexity", quantile, 10_000)).first()[0]
    limits = limits.withColumnRenamed("lang", "_lang")
    out = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left").withColumn("threshold", F.coalesce("own", F.lit(whole if whole is not None else float("inf"))))
    return out.select("doc_id", "lang", "n_tokens", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("keep"))
