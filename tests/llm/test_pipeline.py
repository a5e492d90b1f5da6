from __future__ import annotations

import base64
import random
import re
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from leaseload.llm import queries
from leaseload.llm.common import written
from tests.llm.test_decontaminate import brute
from tests.llm.test_simhash import plain_fingerprint, plain_groups

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def folder(spark, documents, tmp_path):
    rng = random.Random(12)

    def prose(n):
        return " ".join(rng.choice("ab cd ef gh ij kl mn op qr st".split()) + str(rng.randrange(99)) for _ in range(n))

    passage = prose(30)
    texts = [prose(60) for _ in range(30)]
    texts += [texts[0], texts[1].upper(), "too few words", "same five words again here " * 20, None, ""]
    texts += [f"{prose(5)} {passage} {prose(4)}", f"{prose(40)} write to a.b@example.com or +1 555 010 2030"]
    docs = documents(*texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), dict(enumerate(texts)), passage


def expected(texts, passage):
    """Every stage once more, by the plainest means; no adaptive fence is met here."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    kept = {i: t for i, t in texts.items() if t and len(t.split()) >= 10 and "same five" not in t}
    ids = sorted(kept)
    groups = plain_groups([plain_fingerprint(kept[i]) for i in ids])
    kept = {i: kept[i] for n, i in enumerate(ids) if groups[n] == n}
    dirty = brute(kept.items(), [(1, passage)])
    kept = {i: t for i, t in kept.items() if not dirty[i][3]}
    kept = {i: re.sub(r"\+1 555 010 2030", "[PHONE]", re.sub("a.b@example.com", "[EMAIL]", t)) for i, t in kept.items()}
    return {i: library.encode_ordinary(t) for i, t in kept.items()}


def test_run_equals_the_plain_way(spark, folder):
    path, texts, passage = folder
    rows = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id: list(r.ids) for r in rows} == expected(texts, passage)
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_stages_return_the_columns_they_got(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns, name


def test_every_stage_takes_an_empty_table(spark, folder):
    path, _, _ = folder
    empty = written(spark.read.parquet(f"{path}/documents.parquet").filter("false"), "none")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, path).count() == 0, name


@pytest.mark.skipif(not Path(SMALL).exists(), reason="supplied tables are not here")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_a_row_for_each_row(spark, name):
    table = {"op3_chat": "conversations", "op7_html_text": "pages", "op11_url_filter": "pages"}.get(name, "documents")
    rows = queries.QUERIES[name](spark, SMALL).count()
    source = spark.read.parquet(f"{SMALL}/{table}.parquet")
    if name == "op3_chat":
        assert rows == source.select("conv_id").distinct().count() + 1
    elif name == "op13_collocations":
        # A row per phrase.
        assert rows > 0
    else:
        assert 0 < rows <= source.count() and (rows == source.count() or name == "pipeline")
