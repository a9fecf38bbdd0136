from __future__ import annotations

import random

import pytest

from tests.llm.conftest import prose
from venuelens.llm import mixing


def soft(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = [rng.random() ** 4 for _ in range(3)]
        rows.append((i, rng.randrange(0, 500), [x / sum(p) for x in p]))
    return spark.createDataFrame(rows, "doc_id long, tokens long, p array<double>"), rows


@pytest.mark.parametrize("targets", [[0.5, 0.3, 0.2], [0.9, 0.1, 0.0], [0.15, 0.05, 0.8]])
def test_expected_tokens_meet_targets(spark, targets):
    table, rows = soft(spark)
    rated, left = mixing.fit_rates(table, targets)
    rates = {r.doc_id: r.rate for r in rated.collect()}
    size = sum(t for _, t, _ in rows)
    got = [sum(rates[i] * t * p[k] for i, t, p in rows) / size for k in range(3)]
    assert min(rates.values()) >= 0
    # No rates can give a domain less than the documents of the others bring along.
    slack = 2e-3 if targets[2] else 0.08
    assert all(abs(g - w) <= slack for g, w in zip(got, targets))
    assert all(abs(g - w - d) < 1e-6 for g, w, d in zip(got, targets, left))


def test_total_without_loss(spark):
    table, rows = soft(spark)
    own = [sum(t * p[k] for _, t, p in rows) for k in range(3)]
    rated, _ = mixing.fit_rates(table, [0.2, 0.3, 0.5], "no loss")
    rates = {r.doc_id: r.rate for r in rated.collect()}
    assert all(sum(rates[i] * t * p[k] for i, t, p in rows) >= own[k] * 0.995 for k in range(3))


def test_mix_learns_domains(spark, frame):
    texts = [(i, ("red green blue " if i % 3 else "uno dos tres ") * (5 + i % 7) + prose(i, 10)) for i in range(240)]
    labelled = spark.createDataFrame([(i, "b" if i % 3 else "a") for i in range(0, 240, 2)], "doc_id long, domain string")
    got = mixing.mix(frame(texts), labelled, {"a": 0.6, "b": 0.4}).collect()
    assert all(r.domain == ("b" if r.doc_id % 3 else "a") and abs(sum(r.p) - 1) < 1e-6 for r in got)
    total = sum(r.tokens * r.rate for r in got)
    assert abs(sum(r.tokens * r.rate * r.p[0] for r in got) / total - 0.6) < 2e-3
    assert abs(sum(r.tokens * r.copies for r in got if r.domain == "a") / sum(r.tokens * r.copies for r in got) - 0.6) < 0.1
    assert all(r.rate - 1 < r.copies < r.rate + 1 for r in got)


def test_odd_rows_and_few_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, domain string")
    got = mixing.mix(odd, none, {"a": 0.5, "b": 0.5}).collect()
    assert len(got) == odd.count() and all(abs(r.rate - 1) < 1e-3 for r in got)
    one = spark.createDataFrame([(4, "a"), (6, "b"), (7, None), (None, "a"), (5, "zzz")], "doc_id long, domain string")
    assert mixing.mix(odd, one, {"a": 0.5, "b": 0.5}).count() == odd.count()
    assert mixing.mix(odd.limit(0), none, {"a": 1.0}).count() == 0
