from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from venuelens.operators import matching as mt


def close(a: str, b: str) -> float:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    longest = max(len(a), len(b))
    return 1.0 if not longest else (longest - row[-1]) / longest


def edited(word: str, rng: random.Random, n: int) -> str:
    for _ in range(n):
        at = rng.randrange(len(word) + 1)
        word = rng.choice([word[:at] + rng.choice("abcé") + word[at:], word[:at] + word[at + 1 :], word[:at] + rng.choice("abcd") + word[at + 1 :]])
    return word


@pytest.mark.parametrize("cutoff", [0.35, 0.6, 0.75, 0.9, 1.0])
def test_closest_forms_miss_no_pair(spark, cutoff):
    rng = random.Random(11)
    bases = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 13))) for _ in range(40)]
    left = sorted({edited(w, rng, rng.randrange(5)) for w in bases for _ in range(3)} | {"", "a", "ab"})
    right = sorted(set(bases) | {"", "b", "é"})
    want = {(s, t): close(s, t) for s in left for t in right if s and t and close(s, t) >= cutoff}
    table = lambda texts: spark.createDataFrame([(t,) for t in texts], "form string")
    rows = mt.closest_forms(table(left), table(right), cutoff).collect()
    assert {(r["value"], r["form"]): pytest.approx(r["score"]) for r in rows} == want


def test_table_and_list_agree(spark):
    names = ["Intimates", "Dresses", "dresses ", "Knits", "Fine gauge", "fine-gauge", "Pants", "Trend", ""]
    rng = random.Random(3)
    values = names + [edited(n, rng, rng.randrange(4)) for n in names * 8] + ["  fine   GAUGE", "finegauge", "zzz", "Initmates", None, "---"]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(values)], "id long, word string, form string")
    table = spark.createDataFrame([(n, i) for i, n in enumerate(names)] + [(None, 99), ("Knits", 77)], "name string, value int")
    columns = ["id", "word", "form", "matched_value", "match_type", "match_score"]
    for cutoff in (0.35, 0.6):
        want = mt.match_values(df, "word", names, cutoff).select(columns).orderBy("id").collect()
        got = mt.match_values_table(df, "word", table, "name", "value", cutoff).select(columns).orderBy("id").collect()
        assert got == want
    assert {r.match_type for r in want} == {"exact", "normalised", "closest", "none"}


def test_large_dictionary_without_a_cross_join(spark):
    letters = F.translate(F.substring(F.md5(F.col("id").cast("string")), 1, 12), "0123456789", "ghijklmnop")
    dictionary = spark.range(100_000).select(letters.alias("name"))
    picked = dictionary.where(F.crc32("name") % 500 == 0).select("name", F.concat(F.substring("name", 1, 5), F.lit("q"), F.substring("name", 7, 6)).alias("word"))
    matched = mt.match_values_table(picked, "word", dictionary, "name", cutoff=0.8)
    rows = matched.collect()
    assert len(rows) > 100 and all(r.matched_value == r.name and r.match_type == "closest" for r in rows)
    plan = plan_of(matched)
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, word string")
    empty = spark.createDataFrame([], "name string")
    rows = mt.match_values_table(df, "word", empty, "name").orderBy("id").collect()
    assert [(r.matched_value, r.match_type, r.match_score) for r in rows] == [(None, "none", None)] * 2
    assert mt.match_values_table(df.limit(0), "word", empty, "name").count() == 0
    with pytest.raises(ValueError):
        mt.match_values_table(df, "word", empty, "name", cutoff=0)
