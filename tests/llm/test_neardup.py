from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from tests.llm.conftest import prose
from venuelens.llm import neardup
from venuelens.llm.components import components
from venuelens.llm.storage import small_batches


def brute(texts, size, percent):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def edited(text, changes, rng):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_groups_agree_with_brute_force(frame):
    rng = random.Random(3)
    texts = []
    for base in range(6):
        text = prose(base, 120)
        texts += [edited(text, rng.randrange(0, 9), rng) for _ in range(25)]
    chain = prose(77, 100)
    for _ in range(12):  # every text is close to the one before, the first and last are not
        texts.append(chain)
        chain = edited(chain, 4, rng)
    passage = prose(500, 90)
    texts += [passage + " " + prose(600 + i, 60) for i in range(40)]
    texts += ["", " ", None, "one", "ONE", "one two", "one  two ", "two one"]
    rng.shuffle(texts)
    texts = list(enumerate(texts))
    for size in (2, 5):
        got = {r.doc_id: r for r in neardup.near_duplicates(frame(texts), size=size).collect()}
        want = brute(texts, size, 80)
        assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
        assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_keys_are_shared_up_to_one_wrong_symbol_a_chunk():
    import numpy as np

    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 3, (2, 500, neardup.SYMBOLS)).astype(np.uint8)
    same = neardup.keys_of(a) == neardup.keys_of(b)
    assert (neardup.first_keys(a, b) == np.where(same.any(axis=1), same.argmax(axis=1), -1)).all()


def test_crowded_keys_lose_no_link(frame, monkeypatch):
    """A passage common to all texts crowds the keys; near pairs beside it are still found, with pairs by rare shingles only and with both ways."""
    rng = random.Random(8)
    passage, texts = prose(1, 60), []
    for i in range(45):
        text = passage + " " + prose(100 + i, 25)
        texts += [text, edited(text, rng.randrange(1, 6), rng)]
    texts = list(enumerate(texts + [passage, None, "one"]))
    want = brute(texts, 2, 80)
    for crowd in (0, 16):
        monkeypatch.setattr(neardup, "CROWD", crowd)
        got = neardup.near_duplicates(frame(texts), size=2).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_odd_rows(frame, odd):
    found = neardup.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[5].component_id == 4 and not by_id[5].kept and by_id[4].kept
    assert by_id[None].component_id is None and by_id[None].kept
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0
    kept = neardup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "4", "6", "7", "None"]
    assert neardup.near_duplicates(odd.limit(0)).count() == 0


def test_repeated_id_links_its_texts(frame):
    a, b = prose(1, 60), prose(2, 60)
    got = {(r.doc_id, r.component_id) for r in neardup.near_duplicates(frame([(1, a), (2, a), (2, b), (3, b)])).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)}


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 2), (2, 1), (10, 11), (12, 11), (7, 7), (None, 1), (20, 30), (30, 40), (20, 40)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 10: 10, 11: 10, 12: 10, 20: 20, 30: 20, 40: 20}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shares_of_wrong_symbols_bound_the_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    sets, at = [], [0]
    for _ in range(200):  # pairs at similarity 0.8
        both, own = rng.integers(1, 2**63, 400), rng.integers(1, 2**63, 100)
        for part in (np.concatenate([both, own[:50]]), np.concatenate([both, own[50:]])):
            sets.append(np.sort(part.astype(np.uint64)))
            at.append(at[-1] + len(part))
    s = neardup.signatures(np.concatenate(sets), np.array(at))[:, : neardup.SYMBOLS]
    wrong = (s[0::2] != s[1::2]).sum(axis=1)
    assert wrong.max() <= neardup.MOST_WRONG
    assert abs(wrong.mean() / neardup.SYMBOLS - 0.2) < 0.02


def test_counters_are_added_up_within_tasks(frame):
    texts = [(i, " ".join(f"w{(i * 31 + k * k) % 997}" for k in range(300))) for i in range(60)]
    df = frame(texts).repartition(3)
    sets, _ = neardup.shingle_sets(pa.array([t for _, t in texts]), 2)
    want = np.bincount((sets & np.uint64(neardup.COUNTERS - 1)).astype(np.int64), minlength=neardup.COUNTERS)
    assert (neardup._counters(df, 2) == want).all()
    assert neardup._counted_blocks(df, 2).count() <= 3 * neardup.COUNTERS // neardup.BLOCK < (want > 0).sum()


def test_texts_go_to_python_in_batches_of_bytes(spark, frame, monkeypatch):
    """Between `describe` and the last comparison no step hands over 10,000 texts at once; the session's own setting comes back."""
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []

    def spy(df, real=neardup.keep):
        seen.append(spark.conf.get(key, None))
        return real(df)

    monkeypatch.setattr(neardup, "keep", spy)
    before = spark.conf.get(key, None)
    found = neardup.near_duplicates(frame([(1, prose(1, 60)), (2, prose(1, 60)), (3, prose(2, 60))]))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {1: 1, 2: 1, 3: 3}
    assert seen and all(x is not None and int(x) <= 4 << 20 for x in seen)
    assert spark.conf.get(key, None) == before


def test_batches_are_bounded_by_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    texts = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 2000) text")
    with small_batches(spark, 1 << 20):
        found = [r["n"] for r in texts.mapInArrow(sizes, "n long").collect()]
    assert len(found) > 1 and max(found) < 3 << 20


def test_broadcasts_of_ended_steps_are_dropped(spark, frame, monkeypatch):
    """Each of the large steps is followed by a collection of garbage, the last one too."""
    calls = []
    monkeypatch.setattr(neardup, "keep", lambda df, real=neardup.keep: (calls.append("keep"), real(df))[1])
    monkeypatch.setattr(neardup, "tidy", lambda spark, real=neardup.tidy: (calls.append("tidy"), real(spark))[1])
    neardup.near_duplicates(frame([(1, prose(1, 60)), (2, prose(2, 60))]))
    assert calls[-1] == "tidy" and "".join(x[0] for x in calls).count("kt") >= 4
