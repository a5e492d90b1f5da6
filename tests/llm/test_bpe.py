from __future__ import annotations

import base64
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from leaseload.llm import bpe
from tests.llm.conftest import CLASHING, LONG

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_equals_the_library(library):
    rng = random.Random(8)
    letters = "aaaabeeeetthhnoi   .,'s019é漢😀́xyzXYZ\n\t"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(3000)]
    texts += ["a" * 4000, " " * 3000, "!" * 999, "ab" * 2500, "", None, "  x", "don't we'll I'VE"]
    encoder = bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    for begin in range(0, len(texts), 700):
        part = texts[begin : begin + 700]
        assert [ids.tolist() for ids in encoder.encode(part)] == [library.encode_ordinary(t or "") for t in part]


def test_forgetting_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    encoder = bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    for n in range(30):
        texts = [f"some words {n} come back and others{n * k} do not" for k in range(5)]
        assert [ids.tolist() for ids in encoder.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_round_trip_of_a_table(documents, library):
    texts = ["Hello, wörld!", "Hello, wörld!", None, "", LONG]
    docs = documents(*texts, (None, "no id"), extra=CLASHING)
    coded = bpe.encoded(docs, PATH, public_tokenizers.PATTERN)
    rows = coded.select("doc_id", "ids", bpe.decoded(F.col("ids"), PATH).alias("back")).collect()
    assert len(rows) == 6
    for r in rows:
        text = "no id" if r.doc_id is None else texts[r.doc_id] or ""
        assert list(r.ids) == library.encode_ordinary(text)
        assert bytes(r.back).decode() == text


def test_empty_table(documents):
    assert bpe.encoded(documents("x").filter("false"), PATH, public_tokenizers.PATTERN).count() == 0
