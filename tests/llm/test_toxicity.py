from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import prose
from venuelens.llm import toxicity
from venuelens.llm.words import ALNUM, words_of

BAD = ("dreadword", "dreadly", "vilething")


def text(i):
    clean = ". ".join(prose(1000 * i + k, 9) for k in range(5)) + "."
    return clean.replace(". ", f". {prose(i, 2)} {BAD[i % 3]} {prose(i + 1, 2)}. ", 1) if i % 4 == 0 else clean


@pytest.fixture(scope="module")
def model(spark, frame):
    docs = frame([(i, text(i)) for i in range(400)])
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 1) for i in range(400)], "doc_id long, toxic int, quality int")
    return toxicity.fit(docs, labels)


def test_unseen_documents_and_their_sentences(frame, model):
    texts = {i: text(i) for i in range(1000, 1080)}
    got = {r.doc_id: r for r in toxicity.score(frame(list(texts.items())), model).collect()}
    assert all(r.predicted == int(i % 4 == 0) for i, r in got.items())
    for i, r in got.items():
        assert 0 <= r.score <= 1
        if i % 4 == 0:
            assert all(any(b in texts[i][s.start : s.end] for b in BAD) for s in r.sentences) and r.sentences
            assert all(not set(texts[i][s.start : s.end]) & set(".!?\n") for s in r.sentences)
        else:
            assert not r.sentences


def test_noisy_or(model):
    texts = pa.array([text(4), text(8), text(5)])
    scores, _ = toxicity.judge(texts, model, 0.5)
    for t, score in zip(texts.to_pylist(), scores):
        parts = [s for s in t.replace("!", ".").split(".") if s.strip()]
        own = toxicity.judge(pa.array(parts), model, 0.5)[0]
        assert np.isclose(score, 1 - np.prod(1 - own))


def test_features_ignore_what_stands_around(model):
    a, b = words_of(pa.array(["Alpha beta"]), ALNUM), words_of(pa.array(["zz", "  ALPHA, beta!"]), ALNUM)
    assert (toxicity.features(a) == toxicity.features(b)[1:]).all()


def test_odd_rows_and_missing_labels(spark, odd, model):
    got = {(r.doc_id, r.score) for r in toxicity.score(odd, model).collect()}
    assert {(1, 0.0), (2, 0.0), (3, 0.0)} <= got
    assert toxicity.score(odd.limit(0), model).count() == 0
    assert toxicity.drop_toxic(odd, model).columns == odd.columns and toxicity.drop_toxic(odd, model).count() == odd.count()
    none = spark.createDataFrame([(None, 1), (4, None)], "doc_id long, toxic int")
    empty = toxicity.fit(odd, none)
    assert toxicity.score(odd, empty).where("predicted = 1").count() == 0


def test_held_out_accuracy(spark):
    from venuelens.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = QUERIES["op1_toxicity"](spark, folder).join(labels, "doc_id").where("held_out")
    right, wrong = scored.where("toxic = 1 and predicted = 1").count(), scored.where("toxic = 0 and predicted = 1").count()
    assert right >= 0.6 * scored.where("toxic = 1").count() and wrong <= 0.02 * scored.where("toxic = 0").count()
