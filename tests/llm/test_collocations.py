from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.conftest import WORDS, prose
from venuelens.llm import collocations


def brute(rows, most_words=5, least=100, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, most_words + 1):
                counts[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        found = {c: a for c, a in f.items() if len(c) > 1 and a >= least}
        inside = {d[i:j] for d in found for i in range(len(d)) for j in range(i + 2, len(d) + 1) if j - i < len(d) and found[d] >= f[d[i:j]]}
        kept = []
        for c, a in found.items():
            score, k = min((1000 * a * total[lang] // (f[c[:k]] * f[c[k:]]), k) for k in range(1, len(c)))
            if c not in inside:
                kept.append((-score, -a, " ".join(c).encode(), f[c[:k]], f[c[k:]]))
        kept.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(kept[:top])]
    return sorted(out)


def mined(frame_of, rows, **arguments):
    return sorted(tuple(r) for r in collocations.mine(frame_of(rows), **arguments).collect())


@pytest.fixture
def frame_of(spark):
    schema = "doc_id long, text string, lang string, key long, n long, phrase string"
    return lambda rows: spark.createDataFrame([(i, t, g, 1, 2, "x") for i, (t, g) in enumerate(rows)], schema)


def corpus(seed, n):
    rng = random.Random(seed)
    bound = ["red herring", "ad hoc basis today", "New York", "a a a", "one two three four five six", "über Ähre"]
    out = []
    for _ in range(n):
        words = [rng.choice(bound) if rng.random() < 0.2 else rng.choice(WORDS[: rng.randrange(1, 25)]) for _ in range(rng.randrange(40))]
        text = "".join(x + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " "]) for x in words)
        out.append((text, rng.choice(["en", "en", "de", None])))
    return out + [(None, "en"), ("", None), (" ,. ", "xx"), (prose(3, 4000), "en"), ("x " * 500, "fr")]


@pytest.mark.parametrize("least, top, most_words", [(100, 2000, 5), (5, 40, 5), (3, 7, 3), (20, 3, 2)])
def test_agrees_with_brute_force(frame_of, least, top, most_words):
    rows = corpus(least, 250)
    want = brute(rows, most_words, least, top)
    assert len(want) > 3 and mined(frame_of, rows, least=least, top=top, most_words=most_words) == want


def test_settled_languages_are_left_early(frame_of, monkeypatch):
    """Ties at the last rank, in as many rounds as there are bands; rounds after the last needed one read nothing."""
    rng = random.Random(4)
    rows = [(" ".join(f"p{k} q{k}" for k in range(60)) + ". " + " ".join(rng.choice(["the", "of", "and"]) for _ in range(400)), "en") for _ in range(12)]
    rows += [("the of the of and the " * 10, "de")] * 10
    rounds = []
    true_grow = collocations.grow
    monkeypatch.setattr(collocations, "SHARES", (0.01, 0.3, 0.6, 1.0))
    monkeypatch.setattr(collocations, "grow", lambda docs, starts, *a: rounds.append({r.lang for r in starts.select("lang").distinct().collect()}) or true_grow(docs, starts, *a))
    assert mined(frame_of, rows, least=10, top=20) == brute(rows, 5, 10, 20)
    assert rounds[0] == {"de", "en"} and all("en" not in later for later in rounds[1:])


def test_odd_rows(odd):
    assert collocations.mine(odd.limit(0)).count() == 0
    assert collocations.mine(odd, least=10**6).count() == 0
    rows = [(r.text, r.lang) for r in odd.collect()]
    got = sorted(tuple(r) for r in collocations.mine(odd, least=50, top=25).collect())
    assert got == brute(rows, 5, 50, 25)
