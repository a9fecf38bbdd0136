from __future__ import annotations

import random
from itertools import combinations

import pyarrow as pa
import xxhash

from tests.llm.conftest import prose
from venuelens.llm import simhash


def plain(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute(texts):
    """{row: (fingerprint, smallest reachable id)} by comparing all pairs of documents."""
    prints = [plain(t) for _, t in texts]
    root = {i: i for i, _ in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, p), (j, q) in combinations(zip([i for i, _ in texts], prints), 2):
        if (p ^ q).bit_count() <= 2:
            low, high = sorted((find(i), find(j)))
            root[high] = low
    return sorted((i, f"{p:016x}", find(i)) for (i, _), p in zip(texts, prints))


def near(text, rng, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(50)}"
    return " ".join(words)


def test_fingerprints_are_those_of_plain_code(frame):
    texts = [None, "", " \t\n", "One", "one  two", "a\tb\nc d", "Ä ß é", prose(1, 500), "x " * 70_000, "a\x0bb\x0cc\x1fd e"]
    got = simhash.fingerprints_of(pa.array(texts), 3, 42)
    assert [int(x) for x in got] == [plain(t) for t in texts]


def test_groups_agree_with_brute_force(frame):
    rng = random.Random(5)
    texts = [near(prose(base, 400), rng, rng.randrange(0, 6)) for base in range(8) for _ in range(30)]
    texts += [prose(100, 50)] * 40 + ["", None, "one", "one", "two words"] + [prose(i, 30) for i in range(200, 260)]
    rng.shuffle(texts)
    texts = list(enumerate(texts))
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(frame(texts)).collect())
    assert got == brute(texts)
    assert len({c for _, _, c in got}) < len({f for _, f, _ in got})


def test_all_pairs_are_found_in_crowded_keys(spark):
    """Balls around a few centres, far more members than a key compares directly: every pair, at both distances."""
    rng = random.Random(9)
    prints = set()
    for centre in (0, rng.getrandbits(64), 2**64 - 1):
        for _ in range(400):
            x = centre
            for bit in rng.sample(range(64) if rng.random() < 0.5 else range(20, 34), rng.randrange(0, 4)):
                x ^= 1 << bit
            prints.add(x)
    signed = [x - 2**64 if x >= 2**63 else x for x in prints]
    table = spark.createDataFrame([(x,) for x in signed], "fp long")
    for most in (1, 2):
        want = {(min(a, b), max(a, b)) for a, b in combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= most}
        got = [tuple(r) for r in simhash.close_pairs(table, most).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_variants_cover_all_errors():
    """Two wrong bits anywhere leave a variant of the first cut equal, with no more errors than it has left."""
    for wrong in [(), *[(i,) for i in range(64)], *combinations(range(64), 2)]:
        x = sum(1 << i for i in wrong)
        fits = [v for v in simhash._variants(0, 64, 2) if not x & int(v[0]) and (x & int(simhash._bits(v[1], v[2]))).bit_count() <= v[3]]
        assert fits


def test_odd_rows(odd):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found}
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1} and by_id[1].fingerprint == "0" * 16
    assert by_id[5].component_id == 4
    assert by_id[None].component_id is None and by_id[None].fingerprint != "0" * 16
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_repeated_id_links_its_texts(frame):
    texts = [(1, prose(1, 60)), (2, prose(1, 60)), (2, prose(2, 60)), (3, prose(2, 60)), (9, prose(3, 60)), (9, prose(4, 60)), (10, prose(4, 60))]
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(frame(texts)).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (9, 9), (10, 9)}


def test_no_side_of_a_join_is_broadcast_by_the_size_of_files(frame, monkeypatch):
    """Files of a few MB hold fingerprints that make 34 rows each: what Spark guesses from them must not decide."""
    from venuelens.llm import components

    plans, keep, set_before = [], simhash.keep, frame([]).sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df)

    monkeypatch.setattr(simhash, "keep", spy)
    monkeypatch.setattr(components, "keep", spy)
    rng = random.Random(3)
    out = simhash.near_duplicates(frame([(i, near(prose(i % 9, 300), rng, i % 4)) for i in range(60)]))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 4 and not any("Broadcast" in p for p in plans)
    assert frame([]).sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold") == set_before
