from __future__ import annotations

import hashlib
import random

from tests.llm.conftest import prose
from venuelens.llm import spots


def chains(text, length=2):
    import re

    w = [x for x in re.split(r"[^\w]+|_", (text or "").lower()) if x]
    content = [(x, w[i - 1] if i else "") for i, x in enumerate(w) if x not in spots.ANCHORS]
    return {(before, *(content[i + k][0] if i + k < len(content) else "" for k in range(length))) for i, (_, before) in enumerate(content) if before in spots.ANCHORS} or {("whole", (text or "").lower())}


def mixed(seed, n=60):
    rng = random.Random(seed)
    return " ".join(rng.choice(spots.ANCHORS[:22]) if rng.random() < 0.4 else w for w in prose(seed, n).split())


def likeness(a, b):
    return len(a & b) / len(a | b)


def test_edits_agree_with_brute_force(frame):
    texts = [(i, mixed(i, 5 + 3 * i)) for i in range(3, 30)] + [(40, None), (41, ""), (42, "ä" * 7), (50, mixed(5, 20)), (60, mixed(5, 20)), (-3, "The É cat and a dog")]
    got = {r.doc_id: r for r in spots.fingerprint_edits(frame(texts), task_bytes=500).collect()}
    ordered = sorted(texts)
    for k, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - likeness(chains(t), chains(edited))) < 1e-9
        assert abs(r.near_next - likeness(chains(t), chains(after))) < 1e-9
    prints = {}
    for i, t in texts:
        prints.setdefault(frozenset(chains(t)), set()).add(got[i].fingerprint)
    assert all(len(x) == 1 for x in prints.values()) and len({x for p in prints.values() for x in p}) == len(prints)


def test_pairs_agree_with_brute_force(frame):
    rng = random.Random(2)
    texts = []
    for base in range(8):
        w = mixed(base, 150).split()
        for _ in range(6):
            v = list(w)
            for _ in range(rng.randrange(0, 8)):
                v[rng.randrange(len(v))] = f"new{rng.randrange(99)}"
            texts.append(" ".join(v))
    texts = list(enumerate(texts + texts[:5] + ["plain", "other", ""]))
    pairs, members = spots.similar(frame(texts), threshold=0.7)
    classes = {r.doc_id: r.class_id for r in members.collect()}
    sets = {i: chains(t) for i, t in texts}
    assert all(sets[i] == sets[c] and c <= i for i, c in classes.items()) and len(classes) == len(texts)
    names = sorted(set(classes.values()))
    want = {(a, b) for a in names for b in names if a < b and likeness(sets[a], sets[b]) >= 0.7}
    assert {(r.a, r.b) for r in pairs.collect()} == want and want


def test_odd_rows(frame, odd):
    got = spots.fingerprint_edits(odd).collect()
    assert len(got) == odd.count()
    assert len({r.fingerprint for r in got if r.doc_id == 4}) == 1
    assert spots.fingerprint_edits(odd.limit(0)).count() == 0
    one = spots.fingerprint_edits(frame([(9, "the cat sat")])).first()
    assert one.near_next == 1.0
