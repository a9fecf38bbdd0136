"""Benchmark decontamination: windows of test words, broadcast as a hash set, looked up in every training text."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelens.llm.storage import keep
from venuelens.llm.words import ALNUM, Words, char_offsets, slices, words_of

_CARRIED = "items array<string>, runs array<long>"


class Windows:
    """The windows of some benchmark items: sorted hashes by window length, and the words and items of each."""

    def __init__(self, items: pa.Table, size: int) -> None:
        self.found: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        w = words_of(items.column("text"), ALNUM)
        lengths = np.diff(w.first)
        for n in sorted({min(size, int(x)) for x in lengths if x}):
            at, hashes = w.ngrams(n)
            for i, h, row in zip(at.tolist(), hashes.tolist(), w.rows[at].tolist()):
                if min(size, int(lengths[row])) == n:
                    self.found[n][h].append((_spelt(w, i, n), items.column("item")[row].as_py()))
        self.found = {n: dict(x) for n, x in self.found.items()}
        self.sorted = {n: np.array(sorted(x), dtype=np.uint64) for n, x in self.found.items()}
        self.bits = {n: np.zeros(1 << 20, dtype=bool) for n in self.found}
        for n, x in self.sorted.items():
            self.bits[n][(x & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, w: Words) -> tuple[np.ndarray, dict[int, set]]:
        """For every word whether a window covers it, and the items found by row. Hash hits are verified word by word."""
        cover = np.zeros(len(w.starts) + 1, dtype=np.int32)
        items: dict[int, set] = defaultdict(set)
        rows = w.rows
        for n, known in self.sorted.items():
            at, hashes = w.ngrams(n)
            near = np.flatnonzero(self.bits[n][(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
            near = near[known[np.minimum(np.searchsorted(known, hashes[near]), len(known) - 1)] == hashes[near]]
            for i, h in zip(at[near].tolist(), hashes[near].tolist()):
                text = _spelt(w, i, n)
                same = [item for words, item in self.found[n][h] if words == text]
                if same:
                    items[int(rows[i])].update(x for x in same if x is not None)
                    cover[i] += 1
                    cover[i + n] -= 1
        return np.cumsum(cover[:-1]) > 0, items


def _spelt(w: Words, i: int, n: int) -> bytes:
    return b" ".join(w.data[s:e].tobytes() for s, e in zip(w.starts[i : i + n], w.ends[i : i + n]))


def _blocks(bench: DataFrame, item: str, text: str, size: int, most_bytes: int) -> Iterator[Windows]:
    """The benchmark's windows in blocks whose texts have `most_bytes` at most, as far as single items allow it."""
    narrow = bench.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-int(total) // most_bytes) or 1
    for k in range(blocks):
        part = narrow if blocks == 1 else narrow.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield Windows(part.toArrow(), size)


def _scan(docs: DataFrame, windows: Windows, first: bool) -> DataFrame:
    """Add the items and the hit runs (word numbers, start and end in turn) that `windows` give to those of earlier blocks."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)
    names = [x for x in docs.columns if x not in ("items", "runs")]

    def scan(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                w = words_of(batch.column("text"), ALNUM)
                hit, items = shared.value.hits(w)
                runs = [[] for _ in range(batch.num_rows)]
                if hit.any():
                    edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
                    for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                        for r in range(int(np.searchsorted(w.first, s, "right")) - 1, int(np.searchsorted(w.first, e, "left"))):
                            a, b = max(s, int(w.first[r])), min(e, int(w.first[r + 1]))
                            if a < b:
                                runs[r] += [a - int(w.first[r]), b - int(w.first[r])]
                found = [sorted(items.get(r, ())) for r in range(batch.num_rows)]
                if not first:
                    found = [sorted({*x, *y}) for x, y in zip(batch.column("items").to_pylist(), found)]
                    runs = [x + y for x, y in zip(batch.column("runs").to_pylist(), runs)]
                columns = [batch.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.string())), pa.array(runs, pa.list_(pa.int64()))], [*names, "items", "runs"])

    schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    return docs.select(*docs.columns).mapInArrow(scan, f"{schema}, {_CARRIED}")


def _marked(docs: DataFrame, bench: DataFrame, item: str, item_text: str, size: int, most_bytes: int) -> DataFrame:
    for k, windows in enumerate(_blocks(bench, item, item_text, size, most_bytes)):
        docs = _scan(docs if not k else keep(docs), windows, first=not k)
    return docs


def find_contamination(
    docs: DataFrame, bench: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = 10, most_bytes: int = 32 << 20
) -> DataFrame:
    """One row per document: which of its words stand inside a window of `size` consecutive words of a benchmark item.

    Words are runs of digits, letters and non-ASCII characters after A-Z are lower-cased. An item of fewer words is one window;
    an item without words has none. The hash set of windows is broadcast in blocks of at most `most_bytes` of benchmark
    text: a larger benchmark is scanned block after block, nothing is left out. Hash hits are verified on the words.

    NULL and empty texts have no words. NULL item ids cover words but are not counted as items; a repeated item counts
    once. Repeated documents and NULL ids are judged row by row. Empty tables give no rows or no hits.
    `spans`: hit stretches as code points (start, end), end exclusive.
    """
    narrow = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    marked = _marked(narrow, bench, item, item_text, size, most_bytes)

    def digest(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                w = words_of(batch.column("text"), ALNUM)
                items, runs = batch.column("items").to_pylist(), batch.column("runs").to_pylist()
                hits, spans = [], []
                for r, x in enumerate(runs):
                    merged = merge(list(zip(x[::2], x[1::2])))
                    hits.append(sum(b - a for a, b in merged))
                    at = w.first[r]
                    low, high = w.offsets[r], w.offsets[r + 1]
                    places = np.array([[w.starts[at + a] - low, w.ends[at + b - 1] - low] for a, b in merged], dtype=np.int64)
                    spans.append([{"start": int(a), "end": int(b)} for a, b in char_offsets(w.data[low:high], places)] if merged else [])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id"),
                        "n_words": pa.array(np.diff(w.first), pa.int64()),
                        "n_hit": pa.array(hits, pa.int64()),
                        "n_items": pa.array([len(x) for x in items], pa.int64()),
                        "items_sha256": [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items],
                        "contaminated": [x > 0 for x in hits],
                        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    }
                )

    kind = marked.schema["doc_id"].dataType.simpleString()
    return marked.mapInArrow(
        digest, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start: long, end: long>>"
    )


def merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching runs as one; ascending."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def drop_contaminated(docs: DataFrame, bench: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", size: int = 10, most_bytes: int = 32 << 20) -> DataFrame:
    """The documents without a hit word, with their own columns in their order; rules as in `find_contamination`.

    One pass over the rows without a shuffle. Columns may have any names; NULL texts stay.
    """
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{text}`"].cast("string").alias("text"))
    clean = _marked(packed, bench, item, item_text, size, most_bytes).where(F.size("runs") == 0)
    return clean.select([F.col("row").getField(c).alias(c) for c in docs.columns])
