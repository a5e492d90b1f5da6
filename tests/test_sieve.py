"""Rejects shuffle only the rows that a lookup or another row of their key may concern."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leaseload.operators import sieve
from leaseload.operators.outcome import Known, Outcome
from leaseload.params import Params
from leaseload.sources.contracts import CHARGE_COLUMNS


def test_a_sieve_rules_out_no_key_that_was_put_in(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    rows = spark.range(30000).select(F.col("id").cast("string").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    flagged = sieve.sieve(keys, ["k"]).may_hold(rows, ["k"], "maybe")
    assert flagged.columns == ["k", "maybe"]
    found = flagged.groupBy((F.col("k").cast("int") < 3000).alias("put_in"), "maybe").count().collect()
    counts = {(r.put_in, r.maybe): r["count"] for r in found}
    assert counts[True, True] == 3000 and (True, False) not in counts
    assert counts.get((False, True), 0) < 2700
    assert counts[None, False] == 1 and (None, True) not in counts


def test_no_sieve_where_it_would_be_full(spark, monkeypatch):
    monkeypatch.setattr(sieve, "SIEVE_BITS", 1 << 16)
    assert sieve.sieve(spark.range(1 << 15), ["id"]) is None
    assert sieve.sieve(spark.range(1 << 13), ["id"]) is not None
    assert sieve.sieve(spark.range(0), ["id"]).may_hold(spark.range(9), ["id"], "maybe").filter("maybe").count() == 0


@pytest.mark.parametrize("bits", [1 << 26, 1])
def test_only_rows_that_may_miss_their_lookup_are_shuffled(spark, monkeypatch, bits):
    """One ledger of ten has no customer; a full sieve asks for all rows and tells the same."""
    monkeypatch.setattr(sieve, "SIEVE_BITS", bits)
    monkeypatch.setattr(sieve, "LEAST_BITS_PER_KEY", 4 if bits > 1 else 1e9)
    asked = []
    monkeypatch.setattr(sieve, "attach", lambda rows, *a, real=sieve.attach, **k: asked.append(rows.count()) or real(rows, *a, **k))
    facts = spark.range(20000).selectExpr("id AS _row_ord", "IF(id % 7 = 0, NULL, id % 1000) AS k")
    held = spark.range(1000).filter("id % 10 > 0").selectExpr("id AS b")

    def narrow(part, where, flag):
        return part.select("_row_ord", F.when(where, F.col("k")).alias("k"), F.col("k").alias("own"), flag)

    told = sieve.flag_missing(facts, held, ("k", "b"), narrow, "lacks")
    assert told.count() == 20000
    assert told.filter("lacks <> (own IS NULL OR own % 10 = 0)").count() == 0
    keyed = facts.filter("k IS NOT NULL").count()
    assert asked == [keyed] if bits == 1 else 0 < asked[0] < keyed / 5


@pytest.mark.parametrize("full", [False, True])
def test_rows_whose_key_stands_alone_are_not_shuffled(spark, monkeypatch, full):
    monkeypatch.setattr(sieve, "LEAST_BITS_PER_KEY", 1e9 if full else 4)
    met = []
    together = Outcome._met_together
    monkeypatch.setattr(Outcome, "_met_together", lambda own, rows, tables: met.append(rows.count()) or together(own, rows, tables))
    rows = spark.range(10000).selectExpr(
        "IF(id % 50 = 49, NULL, CAST(IF(id % 100 = 1, id - 1, id) AS STRING)) AS k", "CAST(NULL AS STRING) AS _before",
        "IF(id % 9 = 0, 'error|no_date|A', NULL) AS _after", "CAST(NULL AS STRING) AS _before_value", "IF(id % 9 = 0, 'a', NULL) AS _after_value",
        "CAST(id AS STRING) AS _row_id", "id AS _row_ord",
    )
    table = spark.range(10000).filter("id % 100 = 7").selectExpr("CAST(id AS STRING) AS k")
    outcome = Outcome(rows, ("k",), ("k",), (Known(table, (("k", "k"),)),))
    expected = set()
    for n in range(10000):
        if n % 100 == 7:
            expected.add((str(n), "duplicate", None))
        elif n % 9 == 0:
            expected.add((str(n), "no_date", "a"))
        # The row before is the first of the key, unless it has no date.
        elif n % 100 == 1 and (n - 1) % 9:
            expected.add((str(n), "repeat_in_file", None))
    assert {(r.row_id, r.reason, r.value) for r in outcome.rejects.collect()} == expected
    assert met[0] == 9800 if full else 300 <= met[0] < 1500


def test_rejects_of_charges_by_their_ledger(spark, export):
    """Ledgers without a customer, without a number, unknown; a row that stops before all that."""
    from leaseload.plans.charges import load_charges

    columns = [*CHARGE_COLUMNS, "DDELETED"]

    def row(n, ledger, deleted=None):
        cells = {"CHARGEID": str(n), "CHARGEDESCID": "1", "LEDGERID": ledger, "DCAMT": "1.00", "DDELETED": deleted}
        return tuple(cells.get(c) for c in columns)

    rows = [row(1, "1"), row(2, "2"), row(3, "7"), row(4, "x"), row(5, "2", "1/1/2020"), row(6, None), row(1, "1"), row(1, "2")]
    tenants = export(["LEDGERID", "TENANTID", "SUNITNAME"], [("1", "1", "U1"), ("2", "9", "U1")])
    customers = spark.createDataFrame([(11, "1")], "id bigint, external_id string")
    units = spark.createDataFrame([(5, "U1")], "id bigint, unit_number string")
    stored = spark.createDataFrame([], "external_charge_id string")
    types = export(["CHARGEDESCID", "ID"], [("1", "2")])
    outcome = load_charges(export(columns, rows), types, tenants, customers, units, stored, Params())
    got = sorted((r.row_id, r.reason, r.value or "") for r in outcome.rejects.collect())
    assert got == [
        ("1", "no_customer", "2"), ("1", "repeat_in_file", ""), ("2", "no_customer", "2"), ("3", "no_customer", "7"),
        ("4", "bad_ids", "x"), ("5", "deleted", "1/1/2020"), ("6", "bad_ids", ""),
    ]
    settled = sorted((r.row_id, r.reason, r.value or "") for r in outcome.settled().rejects.collect())
    assert settled == got
