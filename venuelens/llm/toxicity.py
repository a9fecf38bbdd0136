"""Toxicity by multiple-instance learning: sentences are scored, noisy-or joins them, and only documents have labels."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelens.llm.storage import keep
from venuelens.llm.words import ALNUM, Words, char_offsets, hash_ranges, slices, words_of

#: Size of the hashed feature space, and so of the broadcast model: 4 bytes each.
BUCKETS = 1 << 20

#: Bytes that end a sentence.
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[0x0A, 0x21, 0x2E, 0x3F]] = True


@dataclass
class Model:
    """Weights of hashed features and the intercept of a sentence's log odds."""

    weights: np.ndarray
    bias: float


def features(w: Words) -> np.ndarray:
    """Three buckets for every word: the word and its first 4 and 5 bytes, so that inflected forms share evidence."""
    parts = [w.hashes]
    for n in (4, 5):
        parts.append(hash_ranges(w.data, w.starts, np.minimum(w.ends, w.starts + n)) * np.uint64(2 * n + 1))
    return (np.stack(parts, axis=1) >> np.uint64(44)).astype(np.int32)


def sentence_starts(w: Words) -> np.ndarray:
    """Index of the first word of every sentence with words; a row with words starts a sentence."""
    marks = np.flatnonzero(_ENDS[w.data])
    sentence = np.searchsorted(marks, w.starts) + w.rows  # grows by an end, or by the next row
    return np.flatnonzero(np.diff(sentence, prepend=-1) != 0)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _document(z: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Noisy-or: 1 - product of (1 - sentence probability), for documents whose sentences start at `at` in z."""
    full = np.flatnonzero(np.diff(at) > 0)
    out = np.zeros(n)
    if len(full):
        out[full] = -np.expm1(-np.add.reduceat(_softplus(z), at[:-1][full]))
    return out


def sample_labels(labels: DataFrame, id: str, label: str, most: tuple[int, int]) -> DataFrame:
    """(id, y, weight): up to most[y] labelled rows of class y in an order that only depends on the id.

    Weights restore the shares of the classes among all labelled rows. Its size is bounded by sum(most).
    """
    known = labels.where(F.col(id).isNotNull() & F.col(label).isin(0, 1)).select(F.col(id).alias("id"), F.col(label).cast("int").alias("y"))
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    parts = []
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most[y])
        parts.append(part.withColumn("weight", F.lit(max(1.0, counts.get(y, 0) / most[y]))))
    return parts[0].union(parts[1])


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", most: tuple[int, int] = (4_000, 1_500), longest: int = 20_000) -> Model:
    """Fit sentence weights to document labels.

    The training sample is bounded: most[0] clean and most[1] positive documents, of up to `longest` bytes each; their tokenised
    sentences are put together and fitted in one task. Without positive labels every score is near 0.
    NULL ids, texts and labels are left out; a repeated id is positive if one of its labels is.
    """
    chosen = F.broadcast(sample_labels(labels, id, label, most))
    narrow = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).where(F.octet_length("text") <= longest)

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                w = words_of(batch.column("text"), ALNUM)
                begin, found = sentence_starts(w), features(w)
                at = np.searchsorted(begin, w.first)
                rows = []
                for r in range(batch.num_rows):
                    a, b = w.first[r], w.first[r + 1]
                    rows.append((found[a:b].tobytes(), (begin[at[r] : at[r + 1]] - a).astype("<i4").tobytes()))
                yield pa.RecordBatch.from_pydict({"y": batch.column("y"), "weight": batch.column("weight"), "found": [x[0] for x in rows], "begin": [x[1] for x in rows]})

    def train(batches):
        sample = [b for b in batches if b.num_rows]
        model = _fit(pa.Table.from_batches(sample)) if sample else Model(np.zeros(BUCKETS, dtype=np.float32), -6.0)
        yield pa.RecordBatch.from_pydict({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    # The sample is bounded and fitted in one task; the driver gets the weights.
    sample = keep(narrow.join(chosen, "id").mapInArrow(run, "y int, weight double, found binary, begin binary"))
    fitted = sample.coalesce(1).mapInArrow(train, "weights binary, bias double").toArrow()
    if not fitted.num_rows:  # no file of the sample, no task
        return Model(np.zeros(BUCKETS, dtype=np.float32), -6.0)
    return Model(np.frombuffer(fitted.column("weights")[0].as_py(), np.float32), fitted.column("bias")[0].as_py())


def _fit(sample: pa.Table, rounds: int = 150, rate: float = 0.1, sparse: float = 1e-4) -> Model:
    """Full-batch gradient steps (Adam) on the negative log likelihood of the document labels.

    Weights are not negative: a sentence offends by what it holds. Features take part that at least three positive documents have, and
    significantly more often than others; a sparsity term keeps chance features small.
    """
    y, weight = sample.column("y").to_numpy().astype(float), sample.column("weight").to_numpy()
    found = [np.frombuffer(x, np.int32) for x in sample.column("found").to_pylist()]
    begin = [np.frombuffer(x, np.int32) for x in sample.column("begin").to_pylist()]
    model = Model(np.zeros(BUCKETS, dtype=np.float32), -6.0)
    if not (y > 0).any():
        return model
    number = _chosen_features(y, found)
    texts = [i for i, b in enumerate(begin) if len(b)]
    sentence, feature, first, n = [], [], [], 0
    for i in texts:
        own = number[found[i]]
        where = np.repeat(np.searchsorted(begin[i], np.arange(len(own) // 3), "right") - 1 + n, 3)
        sentence.append(where[own >= 0])
        feature.append(own[own >= 0])
        first.append(n)
        n += len(begin[i])
    if not texts:
        return model
    sentence, feature, first = np.concatenate(sentence), np.concatenate(feature), np.array(first)
    y, weight = y[texts], weight[texts] / weight[texts].sum()
    each = np.diff(np.append(first, n))
    size = int(number.max()) + 1
    x = np.append(np.full(size, 2.0), -6.0)  # weights, then the intercept
    m1, m2 = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(sentence, x[feature], n) + x[-1]
        total = np.add.reduceat(_softplus(z), first)
        slope = np.where(y > 0, -1.0 / np.expm1(np.clip(total, 1e-9, 500.0)), 1.0) * weight
        dz = np.repeat(slope, each) / (1.0 + np.exp(-np.clip(z, -500.0, 500.0)))
        g = np.append(np.bincount(feature, dz[sentence], size) + sparse, dz.sum())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        x -= rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-8)
        x[:-1] = np.maximum(x[:-1], 0.0)
    model.weights[number >= 0] = x[:-1]
    model.bias = float(x[-1])
    return model


def _chosen_features(y: np.ndarray, found: list[np.ndarray], least: int = 3, deviations: float = 2.0) -> np.ndarray:
    """Number of every bucket whose log odds ratio of positive documents lies `deviations` standard errors above 0; else -1."""
    seen = np.zeros((2, BUCKETS), dtype=np.float32)
    for label, x in zip(y.astype(int), found):
        seen[label, np.unique(x)] += 1
    rest = np.array([[(y == 0).sum()], [(y > 0).sum()]]) - seen
    odds = np.log((seen + 0.5) / (rest + 0.5))
    error = np.sqrt(1 / (seen + 0.5)).clip(min=1e-9)
    chosen = (seen[1] >= least) & (odds[1] - odds[0] > deviations * np.sqrt(error[0] ** 2 + error[1] ** 2))
    number = np.full(BUCKETS, -1, dtype=np.int32)
    number[chosen] = np.arange(chosen.sum())
    return number


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", threshold: float = 0.7, located: float = 0.5) -> DataFrame:
    """One row per document: doc_id, score (0 to 1), predicted (1 from `threshold`) and the offending sentences.

    `sentences`: start and end (code points, end exclusive; from the first to the last word) and score of those from `located`. NULL and
    empty texts have no sentence and score 0. Repeated rows are scored alike; NULL ids stay; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                scores, sentences = judge(batch.column("text"), shared.value, located)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column("doc_id"), "score": scores, "predicted": pa.array((scores >= threshold).astype(np.int32)), "sentences": pa.array(sentences, place)}
                )

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, score double, predicted int, sentences array<struct<start: long, end: long, score: double>>")


def judge(texts: pa.Array, model: Model, located: float) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores of some texts, and their sentences from `located`."""
    w = words_of(texts, ALNUM)
    n = len(w.first) - 1
    sentences: list[list[dict]] = [[] for _ in range(n)]
    if not len(w.starts):
        return np.zeros(n), sentences
    begin = sentence_starts(w)
    z = np.add.reduceat(model.weights[features(w)].sum(axis=1, dtype=np.float64), begin) + model.bias
    at = np.searchsorted(begin, w.first)
    bad = np.flatnonzero(z >= np.log(located / (1 - located)))
    last = np.append(begin[1:], len(w.starts)) - 1
    for s in bad.tolist():
        r = int(np.searchsorted(w.first, begin[s], "right")) - 1
        low, high = w.offsets[r], w.ends[last[s]]
        a, b = char_offsets(w.data[low:high], np.array([w.starts[begin[s]] - low, high - low]))
        sentences[r].append({"start": int(a), "end": int(b), "score": float(1 / (1 + np.exp(-z[s])))})
    return _document(z, at, n), sentences


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The documents that score below `threshold`, with their own columns in their order. A map without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text, 1 << 20):
                yield batch.filter(pa.array(judge(batch.column(text), shared.value, 0.999999)[0] < threshold))

    return docs.select(*[docs[f"`{c}`"] for c in columns]).mapInArrow(run, docs.schema)
