from __future__ import annotations

import re

import pytest

from leaseload.llm import pii
from tests.llm.conftest import CLASHING, LONG

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain(text):
    spans = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                spans.append((kind, m.start(), m.end()))
    return spans


TEXTS = [
    "a@b.c%d@e.f x@y @@..@a.b, a.b@c.d.e..f g@h", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 99999999999999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111  1111 1111 1111 1111", "1 -2 3-4 5 12 34 5678 9012 3456",
    "+1 (555) 010-2030 ++49 30 1234567. +12 . . . 3 x +1 192.168.10.10 12", "é😀 mail: q%w@x-y.z.w, é 😀+44 20 7946 0958",
    "1 2 3 4 5 6 " * 3000, "9" * 3000, "+" + "1." * 3000, "b" * 3000 + "@" + "c." * 900 + "d",
    "+491234567890@x.com +1234567890", "5500-0000-0000-0004 5500 0000 0000 0005 378282246310005", "", None, LONG,
    "no\nspan 4111\n1111 1111 1111 1111 1111 1111", "10.0.0.1" * 50,
]


@pytest.fixture
def odd(documents):
    return documents(*TEXTS, (None, TEXTS[0]), (0, TEXTS[0]), extra=CLASHING)


def test_base_spans(odd):
    rows = pii.found_in(odd).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        got = [(s.kind, s.start, s.end) for s in r.spans if s.kind in pii.BASE]
        assert got == plain(TEXTS[r.doc_id or 0]), r.doc_id


def spans_of(documents, text):
    return [(s.kind, text[s.start : s.end], round(s.score, 1)) for s in pii.found_in(documents(text)).collect()[0].spans]


def test_checksums_and_context(documents):
    assert spans_of(documents, "iban GB82 WEST 1234 5698 7654 32 or GB83 WEST 1234 5698 7654 32") == [
        ("iban", "GB82 WEST 1234 5698 7654 32", 1.1)
    ]
    assert spans_of(documents, "part 123-45-6789 of a list") == []
    assert spans_of(documents, "his social security number 123-45-6789.") == [("national_id", "123-45-6789", 0.7)]
    assert spans_of(documents, "call +1 555 010 2030") == [("phone", "+1 555 010 2030", 1.0)]
    assert spans_of(documents, "see +1 555 010 2030") == [("phone", "+1 555 010 2030", 0.7)]


# 16 to 19 digits that pass Luhn.
CARDS = ["4111111111111111", "41111111111111113", "411111111111111118", "4111111111111111110"]


@pytest.mark.parametrize("separator", [" ", "-"])
def test_cards_spelled_digit_by_digit(documents, separator):
    texts = [f"pay {separator.join(card)} now" for card in CARDS]
    texts += [separator.join(CARDS[0][:-1]), "4 11 1 1-1 1-11-11 1 1 11 1", "4 1" + "  1" * 14]
    assert [len(plain(t)) for t in texts] == [1, 1, 1, 1, 0, 1, 0]
    docs = documents(*texts)
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.found_in(docs).collect()}
    assert found == {n: plain(t) for n, t in enumerate(texts)}
    masked = {r.doc_id: r.text for r in pii.masked_documents(docs).collect()}
    assert [masked[n] for n in range(len(CARDS))] == ["pay [CARD] now"] * len(CARDS)


def test_joined_spans(spark, documents):
    row = pii.found_in(documents("x a@b.cd 1.2.3.4")).select(pii.joined_spans("spans").alias("s")).collect()[0]
    assert row.s == "email:2:8,ip:9:16"


def test_masks_cover_every_span(odd):
    masked = pii.masked_documents(odd)
    assert masked.columns == odd.columns
    for r in masked.collect():
        text = TEXTS[r.doc_id or 0]
        if text is None:
            assert r.text is None and r.n_chars is None
            continue
        hidden = [False] * len(text)
        for _, start, end in plain(text):
            hidden[start:end] = [True] * (end - start)
        left = "".join(c for c, h in zip(text, hidden) if not h)
        assert re.sub(r"\[(EMAIL|IP|CARD|PHONE|IBAN|NATIONAL_ID)\]", "", r.text) == left
        assert r.n_chars == len(r.text)


def test_plan_has_no_python(odd, capsys):
    pii.masked_documents(odd).explain()
    assert "Python" not in capsys.readouterr().out


def test_empty_table(odd):
    assert pii.found_in(odd.filter("false")).count() == 0
