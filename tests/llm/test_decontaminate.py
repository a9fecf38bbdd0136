from __future__ import annotations

import hashlib
import re

import pytest

from tests.llm.conftest import prose
from venuelens.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = WORD.findall(lower(text)), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in own if x is not None}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def bench(spark):
    items = [(1, prose(1, 25)), (10, "ünï code Two"), (2, prose(2, 10).upper()), (2, prose(2, 10)), (None, prose(3, 12)), (5, None), (6, "..."), (7, prose(1, 25))]
    return spark.createDataFrame(items, "item_id long, text string"), items


@pytest.mark.parametrize("most_bytes", [1 << 20, 200])
def test_agrees_with_brute_force(spark, frame, bench, most_bytes):
    table, items = bench
    a, b = prose(1, 25), prose(2, 10)
    texts = [(1, a), (2, "x " + a[:70] + " y"), (3, f"{prose(9, 40)}, {b}; {b}. {prose(8, 9)}"), (4, "ünï, code: TWO! ünï code two"), (5, prose(3, 12)), (6, None), (7, ""), (8, prose(50, 300))]
    got = decontaminate.find_contamination(frame(texts), table, most_bytes=most_bytes).drop("spans").collect()
    assert sorted(map(tuple, got), key=str) == brute(texts, items)
    clean = {d for d, *_, bad in brute(texts, items) if not bad}
    kept = decontaminate.drop_contaminated(frame(texts), table, most_bytes=most_bytes)
    assert kept.columns == frame(texts).columns
    assert {r.doc_id for r in kept.collect()} == clean


def test_spans_are_code_points(spark, frame, bench):
    text = "ääää ünï-code TWO zzz"
    row = decontaminate.find_contamination(frame([(1, text)]), bench[0]).first()
    assert [text[s.start : s.end] for s in row.spans] == ["ünï-code TWO"]


def test_odd_rows_and_empty_tables(spark, odd, bench):
    table, _ = bench
    found = decontaminate.find_contamination(odd, table)
    assert found.count() == odd.count()
    assert decontaminate.find_contamination(odd.limit(0), table).count() == 0
    assert not decontaminate.find_contamination(odd, table.limit(0)).where("contaminated").count()
    assert decontaminate.drop_contaminated(odd, table.limit(0)).count() == odd.count()
