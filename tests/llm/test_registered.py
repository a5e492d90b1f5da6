from __future__ import annotations

import __spark_entry__
from leaseload.llm import queries


def test_every_text_query_is_registered():
    registered = __spark_entry__.queries()
    assert set(queries.QUERIES) <= set(registered)
    assert {name.split("_")[0] for name in queries.QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}
    assert set(queries.SQL) <= set(queries.QUERIES)
