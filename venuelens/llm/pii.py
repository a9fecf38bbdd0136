"""Personal data: patterns, and a skip-chain conditional random field that carries their labels to repeated and similar tokens."""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelens.llm.words import slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
BUCKETS = 1 << 13

Span = tuple[int, int, int]  # number of the kind, start, end

# Quantifiers never give back digits, so that long runs of digits take linear time; the matches are the same.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")

_TOKEN = re.compile(r"\S+")
_SHAPED = re.compile("[0-9@]")
_EDGES = " \t\n\r,;:!?\"'<>[]{}|"


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by kind and start. Matches of one kind don't overlap; those that fail a test are dropped."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := _NOT_DIGIT.sub("", m.group())) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((3, *m.span()))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, x in enumerate(reversed(digits)):
        d = int(x) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


@dataclass
class Field:
    """Log potentials: of a feature and a label, of neighbours, of distant tokens that are equal or alike."""

    unary: np.ndarray
    near: np.ndarray
    far: np.ndarray


def _shape(token: str) -> str:
    return re.sub("9+", "9", re.sub("[a-z]+", "a", re.sub("[A-Z]+", "A", re.sub("[0-9]", "9", token))))


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % BUCKETS


class Tokens:
    """Tokens with a digit or an @ of some texts, their features, and the links between them."""

    def __init__(self, texts: list[str | None]) -> None:
        self.row, self.start, self.end, self.features = [], [], [], []
        near, far = [], []
        for r, text in enumerate(texts):
            if not text or not _SHAPED.search(text):
                continue
            last: dict[str, int] = {}
            previous = None
            for m in _TOKEN.finditer(text):
                if not _SHAPED.search(word := m.group()):
                    continue
                inner = word.strip(_EDGES).rstrip(".")
                if not inner:
                    continue
                s = m.start() + word.index(inner)
                i = len(self.start)
                self.row.append(r)
                self.start.append(s)
                self.end.append(s + len(inner))
                digits = _NOT_DIGIT.sub("", inner)
                before = text[max(0, s - 2) : s].strip()[-1:]
                self.features.append(
                    [
                        _bucket(x)
                        for x in ("s" + _shape(inner), f"n{min(len(digits), 20)}", f"@{inner.count('@')}.{min(inner.count('.'), 4)}", f"l{min(len(inner), 40) // 3}",
                                  "c" + _shape(inner[:2]), "b" + _shape(before), f"d{min(len(digits), 20)}{len(digits) == len(inner)}")
                    ]
                )
                if previous is not None and text[self.end[previous] : s].isspace():
                    near.append((previous, i))
                previous = i
                keys = {"w" + inner.lower()} | ({"d" + digits} if len(digits) >= 7 else set())
                for key in sorted(keys):
                    if key in last:
                        far.append((last[key], i))
                    last[key] = i
        self.near = np.array(near, dtype=np.int64).reshape(-1, 2)
        self.far = np.array(sorted(set(far)), dtype=np.int64).reshape(-1, 2)
        self.features = np.array(self.features, dtype=np.int64).reshape(-1, 7)

    def labels(self, spans: list[list[Span]]) -> np.ndarray:
        """Label of the base span that a token overlaps, else none."""
        out = np.zeros(len(self.start), dtype=np.int64)
        by_row: dict[int, list[int]] = {}
        for i, r in enumerate(self.row):
            by_row.setdefault(r, []).append(i)
        for r, own in by_row.items():
            starts = np.array([self.start[i] for i in own])
            ends = np.array([self.end[i] for i in own])
            for kind, a, b in reversed(spans[r]):
                for k in range(int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left"))):
                    out[own[k]] = kind + 1
        return out

    def marginals(self, field: Field, rounds: int = 10) -> np.ndarray:
        """Label probabilities by loopy sum-product messages over all links."""
        unary = field.unary[self.features].sum(axis=1)
        source = np.concatenate([self.near[:, 0], self.far[:, 0], self.near[:, 1], self.far[:, 1]])
        target = np.concatenate([self.near[:, 1], self.far[:, 1], self.near[:, 0], self.far[:, 0]])
        n, m = len(self.near), len(self.near) + len(self.far)
        message = np.zeros((2 * m, len(LABELS)))
        belief = unary
        for _ in range(rounds if m else 0):
            out = belief[source] - np.concatenate([message[m:], message[:m]])
            new = np.empty_like(message)
            for part, table in ((slice(0, n), field.near), (slice(n, m), field.far), (slice(m, m + n), field.near.T), (slice(m + n, 2 * m), field.far.T)):
                new[part] = _log_sum(out[part][:, :, None] + table, 1)
            new -= _log_sum(new, 1)[:, None]
            message = 0.5 * message + 0.5 * new
            belief = unary + np.stack([np.bincount(target, message[:, k], len(unary)) for k in range(len(LABELS))], axis=1)
        return np.exp(belief - _log_sum(belief, 1)[:, None])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True) if x.size else np.zeros(0)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis) if x.size else x.sum(axis=axis)


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", most: int = 3000, longest: int = 20_000) -> Field:
    """Fit the field, piece by piece, to what the patterns find.

    The training sample is bounded: `most` documents with a digit or an @, of up to `longest` bytes, in an order that only depends on
    the id. Without any such document nothing is added to the base spans.
    """
    narrow = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).where((F.octet_length("text") <= longest) & F.col("text").rlike("[0-9@]"))
    chosen = narrow.select("id").where("id is not null").orderBy(F.xxhash64("id"), "id").limit(most)
    texts = narrow.join(F.broadcast(chosen.distinct()), "id").select("text").limit(2 * most).toArrow().column("text").to_pylist()
    return _fit(texts)


def _fit(texts: list[str]) -> Field:
    k = len(LABELS)
    tokens = Tokens(texts)
    y = tokens.labels([base_spans(t) for t in texts])
    weights = np.zeros((BUCKETS, k))
    if not len(y):
        weights[:, 0] = 5.0
        return Field(weights, np.zeros((k, k)), np.zeros((k, k)))
    used, where = np.unique(tokens.features, return_inverse=True)
    where = where.reshape(tokens.features.shape)
    v = np.zeros((len(used), k))
    speed = np.zeros_like(v)
    truth = np.eye(k)[y]
    for _ in range(200):
        z = v[where].sum(axis=1)
        error = (np.exp(z - _log_sum(z, 1)[:, None]) - truth) / len(y)
        g = np.stack([np.bincount(where.ravel(), np.repeat(error[:, j], where.shape[1]), len(used)) for j in range(k)], axis=1) + 1e-5 * v
        speed += g * g
        v -= 0.5 * g / (np.sqrt(speed) + 1e-8)
    weights[used] = v
    return Field(weights, _agreement(y, tokens.near), _agreement(y, tokens.far))


def _agreement(y: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Log of how much more often two labels meet on a link than by chance, smoothed towards equal labels; symmetric."""
    k = len(LABELS)
    both = np.full((k, k), 0.5) + 2.0 * np.eye(k)
    np.add.at(both, (y[links[:, 0]], y[links[:, 1]]), 1.0)
    both = (both + both.T) / both.sum() / 2
    return np.clip(np.log(both / np.outer(both.sum(1), both.sum(0))), -3.0, 3.0)


def all_spans(texts: list[str | None], field: Field, least: float = 0.9) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans of each text, and all spans: base ones and those of tokens that the field labels with `least` probability."""
    base = [base_spans(t) if t else [] for t in texts]
    tokens = Tokens(texts)
    added: list[list[Span]] = [[] for _ in texts]
    if len(tokens.start):
        covered = tokens.labels(base)
        p = tokens.marginals(field)
        best = p.argmax(axis=1)
        joined = {(int(a), int(b)) for a, b in tokens.near}
        for i in np.flatnonzero((best > 0) & (p.max(axis=1) >= least) & (covered == 0)).tolist():
            own = added[tokens.row[i]]
            kind = int(best[i]) - 1
            if own and (i - 1, i) in joined and own[-1][0] == kind and own[-1][2] == tokens.end[i - 1]:
                own[-1] = (kind, own[-1][1], tokens.end[i])
            else:
                own.append((kind, tokens.start[i], tokens.end[i]))
    return base, [sorted(a + b) for a, b in zip(base, added)]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, field: Field, id: str = "doc_id", text: str = "text", least: float = 0.9) -> DataFrame:
    """One row per document: counts of base spans by kind, their digest, and all spans as `kind:start:end` in code points.

    Base spans are those of the patterns; the field adds spans and never removes one. NULL and empty texts have none. Rows are judged one by
    one: repeated rows alike, NULL ids kept; an empty table gives no rows. A map without a shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    narrow = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                base, spans = all_spans(batch.column("text").to_pylist(), shared.value, least)
                counts = {f"n_{kind}": pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k, kind in enumerate(KINDS)}
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column("doc_id"), **counts, "base_sha256": [hashlib.sha256(_joined(x).encode()).hexdigest() for x in base], "spans": [_joined(x) for x in spans]}
                )

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, field: Field, text: str = "text", chars: str | None = "n_chars", least: float = 0.9) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets, for example <EMAIL>; `chars`, if there, counts anew.

    Overlapping spans are replaced together, under the kind of the first. Other columns and NULL texts stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    columns = docs.columns

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text, 1 << 20):
                texts = batch.column(text).to_pylist()
                new = [cut(t, s) if s else t for t, s in zip(texts, all_spans(texts, shared.value, least)[1])]
                at = columns.index(text)
                batch = batch.set_column(at, text, pa.array(new, batch.column(at).type))
                if chars in columns:
                    at = columns.index(chars)
                    counts = [old if a == b else len(b) for a, b, old in zip(texts, new, batch.column(at).to_pylist())]
                    batch = batch.set_column(at, chars, pa.array(counts, batch.column(at).type))
                yield batch

    return docs.select(*[docs[f"`{c}`"] for c in columns]).mapInArrow(run, docs.schema)


def cut(text: str, spans: list[Span]) -> str:
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"<{KINDS[kind].upper()}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])
