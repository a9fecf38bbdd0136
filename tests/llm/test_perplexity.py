from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tests.llm.conftest import prose
from venuelens.llm import perplexity, storage


def brute(trusted, texts, share):
    words = Counter(w for t in trusted for w in (t or "").encode().lower().split())
    total = sum(words.values())
    known = {w for w, n in words.items() if n >= max(2, share * total)}
    rare = math.log(len(words) - len(known) + 1)
    tokens = lambda t: [w if w in known else "<rare>" for w in (t or "").encode().lower().split()]
    pairs, after, before, types = Counter(), Counter(), Counter(), Counter()
    for t in trusted:
        w = ["<s>", *tokens(t)]
        pairs.update(zip(w, w[1:]))
    for (v, w), n in pairs.items():
        before[v] += n
        types[w] += 1
    d = perplexity._discounts(Counter(pairs.values()))
    e = perplexity._discounts(Counter(types.values()))
    cut = lambda n, d: 0 if not n else d[min(n, 3) - 1]
    freed = Counter()
    for (v, w), n in pairs.items():
        freed[v] += cut(n, d)
    size, everything = len(known) + 2, sum(types.values())
    out = {}
    for i, t in texts:
        v, logs, own = "<s>", 0.0, tokens(t)
        for w in own:
            low = (types[w] - cut(types[w], e)) / everything + sum(cut(n, e) for n in types.values()) / everything / size
            p = (pairs[v, w] - cut(pairs[v, w], d)) / before[v] + freed[v] / before[v] * low if before[v] else low
            logs += math.log(p) - (rare if w == "<rare>" else 0.0)
            v = w
        out[i] = math.exp(-logs / len(own)) if own else None
    return out


def test_agrees_with_brute_force(spark, frame):
    trusted = [prose(i % 7, 40) + " the end" for i in range(30)] + [prose(100 + i, 30) for i in range(10)] + [None, ""]
    texts = [(i, prose(i, 50)) for i in range(12)] + [(20, "new words only"), (21, None), (22, " "), (23, "the end the end"), (24, "THE end"), (24, "THE end")]
    for share in (1e-6, 0.02):
        model = perplexity.fit(frame(list(enumerate(trusted))), share=share)
        got = perplexity.perplexity(frame(texts), model).collect()
        want = brute(trusted, texts, share)
        assert len(got) == len(texts)
        for r in got:
            assert (want[r.doc_id] is None) == (r.perplexity is None)
            assert r.perplexity is None or math.isclose(r.perplexity, want[r.doc_id], rel_tol=1e-6), (r, want[r.doc_id])


def test_probabilities_sum_to_one(frame):
    lower, table = perplexity.fit(frame([(i, prose(i % 5, 30)) for i in range(20)]))
    gains = dict(table.collect()) | dict(zip(lower.head.tolist(), lower.gain.tolist()))
    for v in range(len(lower.words) + 2):
        logs = lower.weight[v] + lower.continuation + np.array([gains.get((v << 32) | w, 0.0) for w in range(len(lower.continuation))])
        if lower.weight[v]:
            assert abs(np.exp(logs).sum() - 1) < 1e-6


def test_thresholds_by_language(spark, frame):
    rows = [(i, "en" if i % 2 else "fr", float(i)) for i in range(100)] + [(200, "de", 150.0), (201, None, 10.0), (202, "en", None)]
    scored = spark.createDataFrame([(i, 5, p) for i, _, p in rows], "doc_id long, n_tokens long, perplexity double")
    names = spark.createDataFrame([(i, x) for i, x, _ in rows], "doc_id long, lang string")
    good = spark.createDataFrame([(i,) for i in range(60)], "doc_id long")
    got = {r.doc_id: r for r in perplexity.judge(scored, names, good, quantile=0.5).collect()}
    assert len(got) == len(rows)
    assert got[1].threshold in (29.0, 31.0) and got[0].threshold in (28.0, 30.0) and got[200].threshold in (29.0, 30.0)
    assert got[27].keep and not got[41].keep and not got[202].keep and got[201].keep


def test_odd_rows(odd):
    model = perplexity.fit(odd.limit(0))
    got = perplexity.perplexity(odd, model)
    assert got.count() == odd.count()
    judged = perplexity.judge(got, odd, odd.limit(0))
    assert judged.count() == odd.count() and judged.where("not keep").count() == 3
    assert perplexity.perplexity(odd.limit(0), perplexity.fit(odd)).count() == 0


def test_vocabulary_does_not_depend_on_the_size_of_the_table(spark, frame):
    small = [(i, prose(i, 30)) for i in range(6)] * 2
    hot = spark.range(25).selectExpr("id AS doc_id", "repeat('hot word ', 60000) AS text")  # 3 million words
    few = perplexity.fit(frame(small))[0]
    many = perplexity.fit(frame(small).select("doc_id", "text").union(hot))[0]
    assert len(few.words) > 50 and np.isin(few.words, many.words).all() and len(many.words) == len(few.words) + 2


def test_only_the_table_of_bigrams_stays_written(frame):
    before = storage.mark()
    _, table = perplexity.fit(frame([(i, f"a b c a b d {i % 7} e") for i in range(50)]))
    assert storage.mark() == before + 1 and table.count() >= 0


def test_passes_leave_the_result_and_exchange_a_part_each(frame, monkeypatch):
    lower, table = perplexity.fit(frame([(i, prose(i % 9, 60)) for i in range(30)]), head=0.5)
    docs = frame([(i, prose(i, 50)) for i in range(12)] + [(3, prose(3, 50)), (20, None)])
    want = brute([prose(i % 9, 60) for i in range(30)], [(i, prose(i, 50)) for i in range(12)] + [(20, None)], 0.0)
    written = []
    monkeypatch.setattr(perplexity, "keep", lambda df: written.append(storage.keep(df)) or written[-1])
    for passes in (1, 2, 5):
        written.clear()
        got = perplexity.perplexity(docs, (lower, table), passes=passes).collect()
        assert len(got) == 14 and len(written) == passes
        assert passes == 1 or all(0 < df.count() for df in written)
        for r in got:
            assert r.perplexity is None if want[r.doc_id] is None else math.isclose(r.perplexity, want[r.doc_id], rel_tol=1e-6)


def test_numbers_agree_with_a_plain_search():
    rng = np.random.default_rng(1)
    for size in (0, 1, 2, 3, 1000, 4097):
        words = np.unique(rng.integers(0, 1 << 63, size, dtype=np.int64).view(np.uint64) * np.uint64(2))
        if size == 1000:  # many words with the same leading bits, and both ends
            words = np.unique(np.concatenate([words, np.arange(50, dtype=np.uint64) + np.uint64(7 << 60), np.array([0, 2**64 - 1], np.uint64)]))
        lower = perplexity.Lower(words, np.zeros(0), np.zeros(0), 0.0, np.zeros(0, np.int64), np.zeros(0))
        asked = np.concatenate([words, words + np.uint64(1), rng.integers(0, 1 << 63, 500, dtype=np.int64).view(np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        place = {int(w): i + 2 for i, w in enumerate(words)}
        assert lower.numbers(asked).tolist() == [place.get(int(h), perplexity.RARE) for h in asked]


def test_requests_are_whole_and_take_few_bytes():
    rng = np.random.default_rng(2)
    docs = rng.integers(-(1 << 62), 1 << 62, 500)
    keys = (rng.integers(0, 100_000, 40_000) << 32) | rng.integers(0, 100_000, 40_000)
    at = rng.integers(0, len(docs), len(keys))
    batch = perplexity._requests(docs, keys, at, 4, 10)
    assert sum(len(r["keys"] or b"") + len(r["at"]) for r in batch.to_pylist()) < 8 * len(keys)  # 20 in plain columns, twice
    seen = []
    for r in batch.to_pylist():
        if r["keys"] is None:
            assert (perplexity._unpacked(r["at"], r["n"], np.int64) == docs).all()
        else:
            got = np.cumsum(perplexity._unpacked(r["keys"], r["n"], np.int64))
            assert (perplexity._place(got >> 32, got & 0xFFFFFFFF, 40) // 4 == r["bucket"]).all()
            seen += zip(got.tolist(), perplexity._unpacked(r["at"], r["n"], np.int32).tolist())
    assert Counter(seen) == Counter(zip(keys.tolist(), at.tolist()))


def test_many_buckets_and_pieces_leave_the_result(frame, monkeypatch):
    monkeypatch.setattr(perplexity, "LISTED", 5)
    monkeypatch.setattr(perplexity, "PIECE", 20)
    monkeypatch.setattr(perplexity, "slices", lambda batch, *_: (batch.slice(i, 2) for i in range(0, batch.num_rows, 2)))
    trusted = [prose(i % 9, 60) for i in range(30)]
    texts = [(i, prose(i % 10, 50) + " " + prose(i % 10, 50)) for i in range(12)]  # each bigram twice or more in its text
    model = perplexity.fit(frame(list(enumerate(trusted))), head=0.5)
    assert model[0].listed == model[1].count() > 50
    want = brute(trusted, texts, 0.0)
    got = perplexity.perplexity(frame([*texts, texts[3], texts[3], texts[7]]), model).collect()
    assert len(got) == 15 and all(math.isclose(r.perplexity, want[r.doc_id], rel_tol=1e-6) for r in got)


def test_a_piece_without_its_documents_is_an_error():
    batch = perplexity._requests(np.arange(3), np.arange(6, dtype=np.int64) << 32, np.array([0, 1, 2, 0, 1, 2]), 1, 1)
    listed = pa.table({"key": np.arange(6, dtype=np.int64) << 32, "gain": np.ones(6)})
    answers = perplexity._answers(pa.Table.from_batches([batch]), listed)
    assert perplexity._gained(answers).to_pydict() == {"doc": [0, 1, 2], "gained": [2.0, 2.0, 2.0]}
    with pytest.raises(RuntimeError):
        perplexity._gained(answers.filter(pc.is_valid(answers["gains"])))
