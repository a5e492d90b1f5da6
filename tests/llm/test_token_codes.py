from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leaseload.llm import token_codes
from tests.llm.conftest import CLASHING, LONG

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer


@pytest.mark.parametrize("top", [1, 255, 256, 49_407, 70_000, 1 << 31])
def test_codes_round_trip_and_random_access(top):
    rng = np.random.default_rng(top)
    ids = np.minimum(rng.integers(0, top, 3000), rng.integers(0, top, 3000)).astype(np.uint32)
    levels = token_codes.pack(ids)
    assert token_codes.unpack(levels).tolist() == ids.tolist()
    assert [token_codes.id_at(levels, i) for i in range(len(ids))] == ids.tolist()


def test_empty_codes():
    assert token_codes.unpack(token_codes.pack(np.empty(0, np.uint32))).tolist() == []


ODD = [
    "THE End.", "don't we'll I'VE it's", "a\tb\nc  d", "état ÉTAT état", "straße STRASSE", "İstanbul ΣΊΣΥΦΟΣ",
    "…“quoted”—dash", "###$$$ %%%", "x1y2z3 12,345.67", "<|endoftext|> <|startoftext|>", "a b c", "漢字かな 한국",
    "ab́c", "word!!? (x) [y]", "Ångstrom", "ﬁne", "'", "''s", "A'b.", "",
]


def test_word_ids_equal_the_library(library, monkeypatch):
    monkeypatch.setattr(token_codes, "REMEMBERED", 40)
    words = token_codes.WordIds(PATH)
    rng = random.Random(2)
    letters = "aAbBéÉßñ'., !?0\t\n漢İΣ́"
    texts = [*ODD, *("".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(2000))]
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.encode(text), "<u4").tolist() == expected, text


# Letters that are composed in lower case only; the marks come after the letters.
LOWER_ONLY = ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a"]


def test_letters_composed_in_lower_case_only(library):
    words = token_codes.WordIds(PATH)
    for text in [*LOWER_ONLY, *(f"A{x}b THE {x}, {x.lower()} É{x}" for x in LOWER_ONLY)]:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.encode(text), "<u4").tolist() == expected, ascii(text)


QUOTED = [
    "a <|endoftext|> b", "<|endoftext|>", "<|ENDOFTEXT|> <|EndOfText|> <|startoftext|>", "x<|startoftext|>Y É<|endoftext|>\u0301",
    "<|endoftext|><|endoftext|>", "<|endoftext|", "J\u030c<|endoftext|>J\u030c", "no\n<|startoftext|>THE<|endoftext|>, end",
]


def test_special_tokens_as_in_the_unmodified_library(spark, documents):
    plain = Tokenizer.from_file(PATH)
    texts = [*ODD, *LOWER_ONLY, *QUOTED]
    assert plain.encode(QUOTED[0], add_special_tokens=False).ids == [320, 49407, 321]
    folder = token_codes.write_codes(documents(*texts), PATH)
    for row in token_codes.read_documents(spark, folder).collect():
        text = texts[row.doc_id]
        assert list(row.ids) == [*plain.encode(text, add_special_tokens=False).ids, token_codes.END_ID], ascii(text)


def test_written_and_read_back(spark, documents, library):
    texts = {3: LONG, 1: "Hello World", 7: "", 5: None, 2: "Hello World", -4: "before all"}
    docs = documents(*texts.items(), (1, "same id"), (None, "no id"), extra=CLASHING)
    folder = token_codes.write_codes(docs, PATH)
    rows = token_codes.read_documents(spark, folder).collect()
    assert len(rows) == 8
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == [None, -4, 1, 1, 2, 3, 5, 7]
    everything = []
    for r in ordered:
        assert r.start == len(everything)
        everything += r.ids
        if r.doc_id not in (None, 1):
            assert list(r.ids) == [*library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in token_codes.digests(spark, folder).collect()}
    assert sums == {(r.doc_id, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows}
    places = [0, 1, 5, len(everything) - 1, len(everything), *range(100, 5000, 37)]
    found = token_codes.tokens_at(spark, folder, spark.createDataFrame([(p,) for p in places], "place bigint")).collect()
    assert {r.place: r.token for r in found} == {p: everything[p] for p in places if p < len(everything)}


def test_empty_table(spark, documents):
    folder = token_codes.write_codes(documents("x").filter("false"), PATH)
    assert token_codes.read_documents(spark, folder).count() == 0
