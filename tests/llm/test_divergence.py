from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import WORDS, prose
from venuelens.llm import divergence, transducer

DOCS = "doc_id long, text string, lang string, source string, n_chars long, term string, piece int"


def brute(rows, least=3, most=200):
    words = lambda t: re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    seen, counts, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        langs[lang].add(source)
        seen[lang].update(set(words(text)))
        counts[lang, source].update(words(text))
    out = []
    for lang, sources in langs.items():
        kept = sorted((t for t, n in seen[lang].items() if n >= least), key=str.encode)
        count = lambda c: ([c[t] for t in kept], sum(c[t] for t in kept))
        share = lambda ns, total: [1 + 10**9 * (n + 1) // (total + len(kept)) for n in ns]
        own = {s: count(counts[lang, s]) for s in sources}
        all_ns = [sum(own[s][0][i] for s in sources) for i in range(len(kept))]
        p, q = {s: share(*own[s]) for s in sources}, share(all_ns, sum(all_ns))
        for s in sources:
            pairs = [(sum((a - b) ** 2 // b for a, b in zip(p[s], p[o])), o) for o in sources if o != s]
            terms = [((a - b) ** 2 // b, t) for a, b, t, n in zip(p[s], q, kept, own[s][0]) if n and a > b]
            for part, found in (("pair", pairs), ("term", terms)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found) if part == "pair" or i < most]
    return sorted(out)


def audited(spark, rows, **arguments):
    docs = spark.createDataFrame([(i, *r, 1, "x", 2) for i, r in enumerate(rows)], DOCS)
    return sorted(tuple(r) for r in divergence.audit(docs, **arguments).collect())


def corpus(seed, n):
    rng = random.Random(seed)
    own = {s: rng.sample(WORDS, 12) for s in ("a", "b", "Ä", "")}
    rows = []
    for i in range(n):
        s = rng.choice(list(own))
        extra = " ".join(rng.choice(["Straße", "éa", "STRASSE", "x-y", "don't", "zz1z", "ü"]) for _ in range(rng.randrange(4)))
        rows.append((" ".join(rng.choice(own[s]) for _ in range(rng.randrange(30))) + " " + extra, rng.choice(["en", "de", None]), s))
    return rows + [(prose(7, 3000), "en", "long"), (None, "en", None), ("", None, "empty"), ("once", "one", "x"), ("once", "one", "y"), ("1 2", None, None)]


def test_audit_agrees_with_brute_force(spark):
    rows = corpus(1, 300)
    assert audited(spark, rows) == brute(rows)
    assert audited(spark, rows, least=2, most=3) == brute(rows, 2, 3)


def test_small_pieces_blocks_and_sides(spark, monkeypatch):
    """Cut as finely as a very large table would be: nothing changes."""
    rows = corpus(2, 150)
    for name, value in (("PIECE", 7), ("BLOCK_BYTES", 2000), ("CELLS", 40), ("SIDE", 2)):
        monkeypatch.setattr(divergence, name, value)
    assert audited(spark, rows) == brute(rows)


def test_odd_rows(spark, odd):
    assert divergence.audit(odd).where("part = 'pair'").count() == 0  # one source
    assert divergence.audit(odd.limit(0)).count() == 0
    rows = [("a b", "en", "s"), ("c", "en", "t"), (None, None, None)]  # no term is kept
    assert audited(spark, rows) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
    assert audited(spark, rows * 3) == brute(rows * 3)


@pytest.mark.parametrize("n", [0, 1, 500])
def test_transducer_is_minimal_and_counts_in_order(n):
    rng = random.Random(n)
    terms = sorted({"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7))).encode() for _ in range(n)})
    machine = transducer.build(terms)
    machine = transducer.Transducer.from_bytes(**machine.to_bytes(), states=len(machine.final))
    asked = terms + [t + b"x" for t in terms] + [t[:-1] for t in terms] + [b"zz", b""]
    ends = np.cumsum([0, *map(len, asked)])
    data = np.frombuffer(b"".join(asked), np.uint8)
    place = {t: i for i, t in enumerate(terms)}
    assert machine.ordinals(data, ends[:-1], ends[1:]).tolist() == [place.get(t, -1) for t in asked]
    # As many states as different sets of endings.
    endings = defaultdict(set)
    for t in terms:
        for i in range(len(t) + 1):
            endings[t[:i]].add(t[i:])
    assert len(machine.final) == max(len({frozenset(e) for e in endings.values()}), 1)
