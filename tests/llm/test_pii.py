from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from venuelens.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())

    def luhn(d):
        return sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(d[::-1])) % 10 == 0

    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


@settings(max_examples=1500, deadline=None)
@given(st.one_of(st.text("a1.@-+ ()é%", max_size=40), st.text("0123459 .-+(", max_size=60)))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    assert pii.base_spans("1" * 200_000 + "." + "@a" * 1000 + "+1" + " (" * 100_000) is not None


TEXTS = [f"call +1 (988) 555-{2000 + i} now or write a{i}.b@mail{i}.example.com, host 10.0.{i}.7 and 4111 1111 1111 1111." for i in range(60)]


def field(frame):
    return pii.fit(frame(list(enumerate(TEXTS))))


def test_field_keeps_base_spans_and_carries_labels_to_repeats(frame):
    docs = frame([(1, TEXTS[3]), (2, "no data at 5 pm"), (3, None), (4, ""), (5, "say +1 (988) 555-2485 then (988) 555-2485 again")])
    got = {r.doc_id: r for r in pii.find_pii(docs, field(frame)).collect()}
    base = brute(TEXTS[3])
    text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (1, 1, 1, 1)
    assert got[1].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert set(text.split(",")) <= set(got[1].spans.split(","))
    assert got[2].spans == got[3].spans == got[4].spans == ""
    assert got[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert "phone:4:21" in got[5].spans.split(",")


def test_far_links_pull_towards_the_label_of_the_same_token():
    import numpy as np

    k = len(pii.LABELS)
    unary = np.zeros((pii.BUCKETS, k))
    tokens = pii.Tokens(["x 5551234567 y 5551234567 z"])
    unary[tokens.features[0], 4] = 1.0
    far = np.where(np.eye(k, dtype=bool), 2.0, -2.0)
    p = tokens.marginals(pii.Field(unary, np.zeros((k, k)), far))
    alone = tokens.marginals(pii.Field(unary, np.zeros((k, k)), np.zeros((k, k))))
    assert p[:, 4].min() > alone[:, 4].min()


def test_redaction_and_odd_rows(frame, odd):
    docs = frame([(1, TEXTS[0]), (2, None), (3, "clean text")])
    got = {r.doc_id: r for r in pii.redact(docs, field(frame)).collect()}
    assert got[1].text == "call <PHONE> now or write <EMAIL>, host <IP> and <CARD>." and got[1].n_chars == len(got[1].text)
    assert got[2].text is None and got[3].text == "clean text" and got[3].n_chars == 10
    model = pii.fit(odd)
    assert pii.find_pii(odd, model).count() == odd.count()
    assert pii.redact(odd, model).columns == odd.columns
    assert pii.find_pii(odd.limit(0), pii.fit(odd.limit(0))).count() == 0
