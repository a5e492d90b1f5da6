from __future__ import annotations

import random
import re

import pytest

from leaseload.llm import decontaminate
from tests.llm.conftest import CLASHING, LONG


def words(text):
    return re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").encode().lower())


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    found = {}
    for doc_id, text in texts:
        w = words(text)
        hit, named = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    named |= windows[tuple(w[i : i + n])]
        found[doc_id] = (len(w), len(hit), sorted(named), bool(hit) and 20 * len(hit) >= len(w))
    return found


def rows_of(judged):
    return {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in judged.collect()}


@pytest.fixture
def items(spark):
    rng = random.Random(9)
    base = [" ".join(rng.choice("alpha beta gamma delta é ß 12 zeta".split()) for _ in range(40)) for _ in range(6)]
    texts = [*base, base[0], base[1][:90], "Only Five Words Are Here", "one", "", None, "!!!", "a a a a a a a a a a a a a a a a"]
    return spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "item_id bigint, text string")


def test_equals_brute_force(documents, items):
    rng = random.Random(4)
    held = [(r.item_id, r.text) for r in items.collect()]
    texts = []
    for n in range(120):
        filler = [rng.choice("alpha beta gamma delta é ß 12 zeta omega".split()) for _ in range(rng.randrange(0, 200))]
        source = words(held[rng.randrange(6)][1])
        begin = rng.randrange(25)
        piece = [w.decode() for w in source[begin : begin + rng.randrange(9, 22)]]
        place = rng.randrange(len(filler) + 1)
        texts.append((n, ", ".join([*filler[:place], *piece, *filler[place:]]).title()))
    texts += [(200, None), (201, ""), (202, "a " * 40), (203, "only five WORDS are here"), (204, "one"), (205, LONG)]
    assert rows_of(decontaminate.judged(documents(*texts), items)) == brute(texts, held)


def test_winnowing_keeps_a_gram_of_every_window():
    rng = random.Random(1)
    hashes = decontaminate.WordHashes()
    for _ in range(50):
        text = [bytes([97 + rng.randrange(3)]) for _ in range(80)]
        grams = decontaminate.gram_hashes(hashes.of(text), decontaminate.GRAM)
        kept = set(decontaminate.winnowed(grams).tolist())
        reach = decontaminate.SPAN - decontaminate.GRAM
        assert all(kept & set(range(i, i + reach + 1)) for i in range(80 - decontaminate.SPAN + 1))


def test_clean_documents_keep_rows_and_columns(documents, items):
    dirty = items.collect()[2].text
    docs = documents(dirty, dirty, "nothing to see", None, (None, dirty), (9, "fine"), (9, "fine"), extra=CLASHING)
    clean = decontaminate.clean_documents(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 9, 9]


def test_items_without_an_id_count(spark, documents):
    alone, shared = ([f"{name}{n}" for n in range(20)] for name in ("alone", "shared"))
    items = spark.createDataFrame(
        [(None, " ".join(alone)), (None, "few words here"), (None, " ".join(shared)), (7, " ".join(shared))],
        "item_id bigint, text string",
    )
    docs = documents(*(" ".join(w) for w in (alone, shared, alone + shared, ["x", *alone[:12]], ["few", "words", "here"])))
    assert rows_of(decontaminate.judged(docs, items)) == {
        0: (20, 20, [], True),
        1: (20, 20, ["7"], True),
        2: (40, 40, ["7"], True),
        3: (13, 0, [], False),
        4: (3, 3, [], True),
    }
    assert [r.doc_id for r in decontaminate.clean_documents(docs, items).collect()] == [3]


def test_empty_tables(documents, items):
    docs = documents("one")
    assert decontaminate.judged(docs.filter("false"), items).count() == 0
    assert rows_of(decontaminate.judged(docs, items.filter("false"))) == {0: (1, 0, [], False)}
