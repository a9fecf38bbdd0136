from __future__ import annotations

import re

from tests.llm.conftest import prose
from venuelens.llm import lines


def brute(texts, least=8):
    """First words of units by (doc, start), without the earliest of each normal form."""
    seen, gone = set(), set()
    for doc, text in sorted(texts):
        at = 0
        for unit in re.split(r"(?<=\n)|(?<=[.!?])(?=\s)", text or ""):
            words = re.findall(r"[a-z0-9]+", unit.lower())
            if len(words) >= least:
                key = tuple(words)
                start = at + re.search("[A-Za-z0-9]", unit).start()
                if key in seen:
                    gone.add((doc, start))
                seen.add(key)
            at += len(unit)
    return gone


def test_agrees_with_brute_force(frame):
    a, b, c = prose(1, 60), prose(2, 9), prose(3, 4)
    texts = [(1, f"{a}\n{b}. {c}! {prose(4, 20)}"), (2, f"{prose(5, 12)}. {b.upper()}? {c}!\n{a}"), (3, a), (4, f"{b}\n{b}. tail"), (5, f"{prose(6, 30)} {b}"), (6, f"v1.5 {b}!! x"), (7, None), (8, "")]
    found = lines.repeated_units(frame(texts)).collect()
    assert {(r.doc_id, r.start) for r in found} == brute(texts)
    assert all(r.first_doc in (1, 2) for r in found)
    done = {r.doc_id: r for r in lines.drop_repeated_units(frame(texts)).collect()}
    assert done[3].text == "" and done[1].text == texts[0][1] and done[7].text is None and done[8].text == ""
    assert done[4].text == "tail"
    for i, t in texts:
        if t:
            assert done[i].text == "".join(t[k.start : k.end] for k in done[i].kept)


def test_odd_rows(frame, odd):
    done = lines.drop_repeated_units(odd).collect()
    assert len(done) == odd.count()
    by_id = {}
    for r in done:
        by_id.setdefault(r.doc_id, []).append(r.text)
    assert by_id[4] == [prose(4, 80)] * 2 and by_id[5] == [""] and by_id[1] == [None]
    assert lines.drop_repeated_units(odd.limit(0)).count() == 0


def test_rows_without_id_or_with_an_id_in_common_keep_their_own_text(frame):
    a, b, c, d = (prose(40 + i, 12) for i in range(4))
    done = {}
    for r in lines.drop_repeated_units(frame([(1, a), (None, f"{a}\n{b}"), (None, f"{c}\n{d}"), (2, f"{a}\n{c}"), (2, d), (None, None)])).collect():
        done.setdefault(r.doc_id, []).append(r.text)
    assert done[1] == [a] and sorted(done[2]) == sorted([c, d]) and sorted(done[None], key=str) == sorted([b, "", None], key=str)
    # The same unit at the same place of two rows without id is removed from one of them.
    texts = [r.text for r in lines.drop_repeated_units(frame([(None, f"{a}\n{b}"), (None, f"{a}\n{c}")])).collect()]
    assert sum(a in t for t in texts) == 1 and all(t.endswith((b, c)) for t in texts)


def test_query_removes_short_units(spark, frame, tmp_path):
    from venuelens.llm import queries

    texts = [(1, f"{prose(1, 20)}\nRead more.\nok"), (2, f"Read more.\n{prose(2, 20)}. Yes! Yes!"), (3, f"OK\n{prose(3, 6)}\n{prose(1, 20)}"), (4, f"{prose(3, 6)}\n***")]
    frame(texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op8_substring_dedup(spark, str(tmp_path)).collect()}
    assert {(i, x.start) for i, r in got.items() for x in r.removed} == brute(texts, least=1)
    assert [got[i].text for i in (1, 2, 3, 4)] == [texts[0][1], f"{prose(2, 20)}. Yes! ", f"{prose(3, 6)}\n", "***"]
