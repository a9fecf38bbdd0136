"""Near-duplicate texts: a multi-index Hamming join on b-bit MinHash signatures, every link confirmed on full shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelens.llm.components import components
from venuelens.llm.storage import keep, small_batches, tidy
from venuelens.llm.words import NO_SPACE, mix, slices, words_of

#: A signature has SYMBOLS one-byte symbols, of which the first ones form CHUNKS chunks of CHUNK. With ERRORS wrong symbols allowed in a chunk, all pairs that
#: differ in at most CHUNKS * (ERRORS + 1) - 1 of these symbols share a key; a pair at similarity 0.8 is missed with probability
#: (1 - 0.8 ** 5 - 5 * 0.2 * 0.8 ** 4) ** 10, less than 2e-6.
CHUNKS, CHUNK, ERRORS = 10, 5, 1
KEYED = CHUNKS * CHUNK

#: Further symbols only sharpen the distance: candidates that differ in more than MOST_WRONG of all SYMBOLS are not
#: compared; at similarity 0.8 the chance of that is about 1e-6.
SYMBOLS = 128
MOST_WRONG = 47

_SEEDS = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64)) | np.uint64(1)

#: A key with more members than this outside its main group gives no pairs of all; its members are found by rare shingles instead.
CROWD = 16
#: Counters by which shingles are ordered from rare to frequent: a broadcast of fixed size, 8 MB.
COUNTERS, BLOCK = 1 << 20, 1 << 14

#: Bits that sum up the shingles which a member does not share with its key's pivot.
MASK = 512


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, ascending within a row, and the row offsets into them."""
    w = words_of(texts, NO_SPACE)
    at, hashes = w.ngrams(size)
    rows = w.rows[at]
    lengths = np.diff(w.first)
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):
        whole = [_sequence(w.hashes[w.first[r] : w.first[r + 1]]) for r in short]
        hashes, rows = np.concatenate([hashes, np.array(whole, dtype=np.uint64)]), np.concatenate([rows, short])
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], np.searchsorted(rows[new], np.arange(len(lengths) + 1))


def _sequence(hashes: np.ndarray) -> int:
    h = np.zeros(1, dtype=np.uint64)
    for x in hashes:
        h = mix(h + x)
    return int(h[0]) ^ 0x5DEECE66D


def signatures(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lowest byte of the smallest of each of SYMBOLS hashes, one row per set; empty sets give zeros."""
    out = np.zeros((len(offsets) - 1, SYMBOLS), dtype=np.uint8)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        at = offsets[full]
        for i, seed in enumerate(_SEEDS):
            # The high half orders the shingles; it is spread once more, so that its low byte is even.
            out[full, i] = mix(np.minimum.reduceat((sets ^ seed) * seed, at)).astype(np.uint8)
    return out


def _bytes(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix of bytes."""
    n, width = rows.shape
    at = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(values: pa.Array, width: int) -> np.ndarray:
    """The matrix of bytes of binary values of one width; NULL gives zeros."""
    values = values.cast(pa.large_binary()).fill_null(bytes(width))
    if not len(values):
        return np.zeros((0, width), np.uint8)
    _, offsets, data = values.buffers()
    start = int(np.frombuffer(offsets, np.int64)[values.offset])
    return np.frombuffer(data, np.uint8)[start : start + len(values) * width].reshape(-1, width)


def describe(docs: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """(doc_id, text_id, n_shingles, set_id, sig): size, digest and signature of every text's shingle set. A map without a shuffle."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                sets, offsets = shingle_sets(batch.column("text"), size)
                sums = np.zeros((3, len(sets) + 1), dtype=np.uint64)
                for k, v in enumerate((sets, mix(sets), mix(~sets))):
                    np.cumsum(v, out=sums[k, 1:])
                digest = np.ascontiguousarray((sums[:, offsets[1:]] - sums[:, offsets[:-1]]).T)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id"), "text_id": batch.column("text_id"), "n_shingles": pa.array(np.diff(offsets), pa.int64()),
                        "set_id": _bytes(digest.view(np.uint8)), "sig": _bytes(signatures(sets, offsets)),
                    }
                )

    narrow = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("text_id", F.xxhash64("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, text_id long, n_shingles long, set_id binary, sig binary")


def keys_of(sig: np.ndarray) -> np.ndarray:
    """The keys of signatures, a row for each: of each chunk, what is left when any one symbol (ERRORS = 1) is allowed to be wrong."""
    out = np.empty((len(sig), KEYED), dtype=np.int64)
    for place in range(KEYED):
        chunk = place // CHUNK * CHUNK
        key = np.full(len(sig), place, dtype=np.int64)
        for i in range(chunk, chunk + CHUNK):
            if i != place:
                key = (key << 8) | sig[:, i]
        out[:, place] = key
    return out


def first_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest number of a key that two signatures share (-1: none): a pair that meets in several keys is listed in that one only."""
    differ = (a[:, :KEYED] != b[:, :KEYED]).reshape(len(a), CHUNKS, CHUNK)
    shared = differ.sum(axis=2) <= ERRORS
    chunk = shared.argmax(axis=1)
    # With no wrong symbol in the chunk the first of its keys is shared already, with one that symbol's key.
    place = chunk * CHUNK + differ[np.arange(len(a)), chunk].argmax(axis=1)
    return np.where(shared.any(axis=1), place, -1)


def _keyed(classes: DataFrame) -> DataFrame:
    """(id, key) of every class."""

    def run(batches):
        for batch in batches:
            keys = keys_of(_matrix(batch.column("sig"), SYMBOLS))
            ids = batch.column("id").take(pa.array(np.repeat(np.arange(batch.num_rows), KEYED)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys.ravel())], ["id", "key"])

    return classes.select("id", "sig").mapInArrow(run, f"id {classes.schema['id'].dataType.simpleString()}, key long")


def _close(pairs: DataFrame) -> DataFrame:
    """(id, other) of the `pairs` (id, other, a, b) whose signatures a and b differ in at most MOST_WRONG symbols."""

    def run(batches):
        for batch in batches:
            wrong = (_matrix(batch.column("a"), SYMBOLS) != _matrix(batch.column("b"), SYMBOLS)).sum(axis=1)
            yield batch.select(["id", "other"]).filter(pa.array(wrong <= MOST_WRONG))

    kind = pairs.schema["id"].dataType.simpleString()
    return pairs.select("id", "other", "a", "b").mapInArrow(run, f"id {kind}, other {kind}")


def _open_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """(id, other) of the `pairs` (key, x, y) of members of one key that may be near, each in the first key the two share only.

    What x and y have in common with the key's pivot bounds what they share: shared shingles are either the pivot's, at most as many as the one with
    fewer of those has, or not; then their hashes share bits, and no more of them can hide behind one bit than one side has shingles in
    excess of bits. Without a comparison with the pivot nothing is known.
    """

    def run(batches):
        for batch in batches:
            x, y = ({f.name: column for f, column in zip(side.type, side.flatten())} for side in (batch.column("x"), batch.column("y")))
            a, b = _matrix(x["sig"], SYMBOLS), _matrix(y["sig"], SYMBOLS)
            number = lambda side, name: side[name].fill_null(0).to_numpy(zero_copy_only=False)
            least = lambda name: np.minimum(number(x, name), number(y, name))
            common = np.bitwise_count(_matrix(x["mask"], MASK // 8) & _matrix(y["mask"], MASK // 8)).sum(axis=1, dtype=np.int64)
            excess = np.minimum(number(x, "rest") - number(x, "bits"), number(y, "rest") - number(y, "bits"))
            most = least("both") + np.minimum(least("rest"), common + excess)
            unknown = ~(x["both"].is_valid().to_numpy(zero_copy_only=False) & y["both"].is_valid().to_numpy(zero_copy_only=False))
            stays = unknown | (100 * most >= percent * (number(x, "n") + number(y, "n") - most))
            stays &= (a != b).sum(axis=1) <= MOST_WRONG
            stays &= batch.column("key").to_numpy() >> (8 * (CHUNK - ERRORS)) == first_keys(a, b)
            yield pa.RecordBatch.from_arrays([x["id"], y["id"]], ["id", "other"]).filter(pa.array(stays))

    kind = pairs.schema["x"].dataType["id"].dataType.simpleString()
    return pairs.select("key", "x", "y").mapInArrow(run, f"id {kind}, other {kind}")


def _compare(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Exact comparison of every pair (id, other) on full shingle sets.

    `near`: 100 * intersection >= percent * union. `both`: size of the intersection. `rest`: how many shingles of id the other does not
    have; `bits`, `mask`: how many of MASK bits, and which, the hashes of those set.
    """
    left, right = texts.select("id", F.col("text").alias("ta")), texts.select(F.col("id").alias("other"), F.col("text").alias("tb"))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "ta", 1 << 20):
                a, a_at = shingle_sets(batch.column("ta"), size)
                b, b_at = shingle_sets(batch.column("tb"), size)
                both = np.zeros(batch.num_rows, dtype=np.int64)
                masks = np.zeros((batch.num_rows, MASK), dtype=bool)
                for r in range(batch.num_rows):
                    x, y = a[a_at[r] : a_at[r + 1]], b[b_at[r] : b_at[r + 1]]
                    if len(x) and len(y):
                        found = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
                        both[r] = found.sum()
                        masks[r, (x[~found] & np.uint64(MASK - 1)).astype(np.int64)] = True
                n, m = np.diff(a_at), np.diff(b_at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"), batch.column("other"), pa.array((both > 0) & (100 * both >= percent * (n + m - both))),
                        pa.array(both), pa.array(n - both), pa.array(masks.sum(axis=1), pa.int64()),
                        _bytes(np.packbits(masks, axis=1)),
                    ],
                    ["id", "other", "near", "both", "rest", "bits", "mask"],
                )

    kind = pairs.schema["id"].dataType.simpleString()
    rows = pairs.join(left, "id").join(right, "other").select("id", "other", "ta", "tb")
    return rows.mapInArrow(run, f"id {kind}, other {kind}, near boolean, both long, rest long, bits long, mask binary")


def _counted_blocks(texts: DataFrame, size: int) -> DataFrame:
    """(block, n): how often the shingles of BLOCK classes each occur in a task's part of `texts` (id, text); at most COUNTERS / BLOCK rows a task."""

    def run(batches):
        own = np.zeros(COUNTERS, dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                sets, _ = shingle_sets(batch.column("text"), size)
                own += np.bincount((sets & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        blocks = own.reshape(-1, BLOCK)
        held = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_pydict({"block": pa.array(held.astype(np.int32)), "n": _bytes(blocks[held].view(np.uint8))})

    return texts.select("text").mapInArrow(run, "block int, n binary")


def _counters(texts: DataFrame, size: int) -> np.ndarray:
    """How often the shingles of each of COUNTERS classes occur in `texts` (id, text)."""

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, dtype=np.int64)
        for n in group.column("n").to_pylist():
            total += np.frombuffer(n, np.int64)
        return pa.table({"block": group.column("block")[:1], "n": [total.tobytes()]})

    found = _counted_blocks(texts, size).groupBy("block").applyInArrow(add, "block int, n binary").toArrow()
    out = np.zeros((COUNTERS // BLOCK, BLOCK), dtype=np.int64)
    for block, n in zip(found.column("block").to_pylist(), found.column("n").to_pylist()):
        out[block] = np.frombuffer(n, np.int64)
    return out.ravel()


def _rare(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, component, n, key, place): as many of each text's rarest shingles as any near text must share one of, and their places in its order.

    Texts of n and m shingles that are near share at least percent * max(n, m) / 100. Under one order of all shingles, here from rare to frequent
    classes, each then has a shared one among its first n + 1 less that number. Exact for any order; a good one keeps the rows of common passages apart.
    """
    shared = texts.sparkSession.sparkContext.broadcast(_counters(texts, size))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                sets, at = shingle_sets(batch.column("text"), size)
                n = np.diff(at)
                rows = np.repeat(np.arange(batch.num_rows), n)
                order = np.lexsort((sets, shared.value[(sets & np.uint64(COUNTERS - 1)).astype(np.int64)], rows))
                place = np.arange(len(sets)) - at[rows]
                first = place < (n - (percent * n + 99) // 100 + 1)[rows]
                rows = pa.array(rows[first])
                columns = [batch.column("id").take(rows), batch.column("component").take(rows), pa.array(n).take(rows), pa.array(sets[order][first].view(np.int64)), pa.array(place[first])]
                yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "key", "place"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.select("id", "component", "text").mapInArrow(run, f"id {kind}, component {kind}, n long, key long, place long")


def _with_main(rows: DataFrame) -> DataFrame:
    """(key, main, outside) of the keys of `rows` (key, component) with several groups: the largest one, and how many rows are of others."""
    sizes = rows.groupBy("key", "component").agg(F.count("*").alias("size"))
    main = sizes.groupBy("key").agg(
        F.count("*").alias("groups"), F.max_by("component", F.struct("size", "component")).alias("main"), (F.sum("size") - F.max("size")).alias("outside")
    )
    return main.where("groups > 1").drop("groups")


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs x, y of `rows` (key, main, component, id, n) of different groups that share a key, at least one outside its main group."""
    return (
        rows.where("component <> main").alias("x").join(rows.alias("y"), "key")
        .where((F.col("x.component") != F.col("y.component")) & ((F.col("y.component") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))))
        .where(_alike(F.col("x.n"), F.col("y.n"), percent))
    )


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id of its group) and kept (it is that one).

    Words stand between white space, A-Z lower-cased; a document's set has its distinct shingles of `size` words, or its whole
    sequence when it has fewer words. Two documents are linked when 100 * intersection >= percent * union (percent 80 or
    more); groups are what links connect.

    1. Equal sets become one class, represented by its smallest doc_id, so exact copies never meet again.
    2. Representatives that share a key of the multi-index are candidates. Each key's members are first compared with one
       pivot only (the one that shares most keys with others), which ties large groups together with one pair per member.
    3. Members of one key that are still in different groups are compared with each other, unless their signatures, or what they share
       with the key's pivot, rule out a link. A key whose members are already together gives no pair; in other keys the
       members of its main group are only compared with those outside it. So no link between groups is lost and a group
       of n copies does not give n * n pairs.
    4. A key with more than CROWD members outside its main group, as a passage gives that many texts share, gives no pairs. Its
       members meet on their rarest shingles instead, of which near texts always share one.
    Every pair is confirmed on the full sets. Nothing is capped; a frequent key is split by adaptive skew joins.

    NULL, empty and blank texts have an empty set: 0 shingles, linked with nothing. Rows with equal doc_id are one document
    in links, and each gives a row. A row without doc_id has component_id NULL and is kept. Empty tables give no rows;
    further columns are ignored.
    """
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs, id, text, size, percent)


def _near_duplicates(docs: DataFrame, id: str, text: str, size: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    rows = keep(describe(docs, id, text, size))
    known = rows.where("doc_id is not null and n_shingles > 0")
    classes = known.groupBy("set_id").agg(
        F.min(F.struct("doc_id", "text_id")).alias("least"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")
    )
    classes = keep(classes.select("set_id", "least.text_id", F.col("least.doc_id").alias("id"), "n", "sig"))
    placed = keep(rows.join(classes.select("set_id", "id"), "set_id", "left").select("doc_id", "n_shingles", "id"))

    keyed = _keyed(classes)
    shared = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    met = keep(keyed.join(shared, "key"))
    pull = met.groupBy("id").agg(F.sum(F.col("members") - 1).alias("pull"))
    # Sorted by id, so that the repeated signatures take little space.
    members = keep(met.select("id", "key").join(pull.join(classes, "id").select("id", "pull", "n", "sig"), "id"))
    texts = keep(_texts(docs, id, text, classes.join(pull.select("id"), "id", "left_semi").select("id", "text_id")))
    tidy(spark)

    pivots = members.groupBy("key").agg(F.max(F.struct("pull", "id", "n", "sig")).alias("p"))
    met_pivot = members.alias("x").join(pivots, "key").where(F.col("x.id") != F.col("p.id")).where(_alike(F.col("x.n"), F.col("p.n"), percent))
    stars = keep(_close(met_pivot.select("x.id", F.col("p.id").alias("other"), F.col("x.sig").alias("a"), F.col("p.sig").alias("b"))).distinct())
    compared = keep(_compare(stars, texts, size, percent))
    tidy(spark)
    links = keep(compared.where("near").select(F.col("id").alias("a"), F.col("other").alias("b")).union(_repeated(placed)))
    groups = keep(components(links))
    tidy(spark)

    labelled = members.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    main = _with_main(labelled).join(pivots.select("key", F.col("p.id").alias("other")), "key")
    # Pairs with the pivot itself are done.
    facts = compared.select("id", "other", "both", "rest", "bits", "mask")
    open_keys = keep(labelled.join(main, "key").where("id <> other").join(facts, ["id", "other"], "left"))
    tidy(spark)
    side = lambda name: F.struct(*[f"{name}.{c}" for c in ("id", "n", "sig", "both", "rest", "bits", "mask")]).alias(name)
    few = _across(open_keys.where(F.col("outside") <= CROWD), percent).select("key", side("x"), side("y"))
    rare = keep(_rare(keep(texts.join(open_keys.where(F.col("outside") > CROWD).select("id", "component").distinct(), "id")), size, percent))
    tidy(spark)
    # Of the first shingle that two texts share, in the order, the ones after it bound what they share in all.
    most = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    crowded = _across(rare.join(_with_main(rare).select("key", "main"), "key"), percent)
    crowded = crowded.where((100 + percent) * most >= percent * (F.col("x.n") + F.col("y.n"))).select("x.id", F.col("y.id").alias("other"))
    crossed = _open_pairs(few, percent).union(crowded).select(F.least("id", "other").alias("id"), F.greatest("id", "other").alias("other")).distinct()
    more = keep(_compare(crossed, texts, size, percent).where("near").select(F.col("id").alias("a"), F.col("other").alias("b")))
    tidy(spark)
    groups = components(links.union(more))
    tidy(spark)

    component = F.coalesce("component", "id", "doc_id")
    return placed.join(groups, "id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def _alike(n: Column, m: Column, percent: int) -> Column:
    """Sets of these sizes can reach the similarity."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _texts(docs: DataFrame, id: str, text: str, wanted: DataFrame) -> DataFrame:
    """(id, text) of the representatives in `wanted` (id, text_id)."""
    own = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).withColumn("text_id", F.xxhash64("text"))
    return own.join(wanted, ["id", "text_id"], "left_semi").dropDuplicates(["id", "text_id"]).select("id", "text")


def _repeated(placed: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of rows with one doc_id."""
    several = placed.where("id is not null").groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")
    return placed.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("id").alias("b")).where("a < b").distinct()


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The documents that `near_duplicates` keeps, one of each group, with their own columns.

    Rows without id or words stay; so do all rows of a kept doc_id.
    """
    found = near_duplicates(docs, id, text, size, percent)
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    left = docs.join(gone, docs[f"`{id}`"] == gone["_gone"], "left_anti")
    return left
