"""Small fixtures that hit every reason once, and the rules that hold for every plan."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from leaseload.operators.load import insert_new, upsert
from leaseload.operators.reconcile import link_payments
from leaseload.params import Params
from leaseload.plans.balances import load_balances
from leaseload.plans.billing import load_billing_schedules
from leaseload.plans.cards import load_profiles
from leaseload.plans.charges import load_charges, load_credits
from leaseload.plans.customers import load_customers, load_former_customers, load_former_with_notes, split_former
from leaseload.plans.gate import load_gate_log
from leaseload.plans.invoices import load_invoices, payment_pairs
from leaseload.plans.payments import load_payments
from leaseload.plans.receipts import load_receipts
from leaseload.plans.tenancy import load_history_leases, load_history_links, load_leases, load_links
from leaseload.plans.units import UNIT_KEY, UNIT_UPDATES, load_units
from leaseload.sources.contracts import CUSTOMER_KEYS, UNIT_KEYS

PARAMS = Params(run_ts=datetime(2021, 1, 2, 3, 4, 5), as_of=date(2020, 6, 15))
UPDATING = Params(run_ts=PARAMS.run_ts, as_of=PARAMS.as_of, on_match="update")


def counts(outcome) -> dict[str, int]:
    return {f"{r.outcome}:{r.reason}": r.n_rows for r in outcome.counters.collect()}


@pytest.fixture
def customers(spark):
    rows = [(11, "1", "Doe", "1 Road"), (12, "2", "Roe", "2 Road"), (13, "3", "Roe", None), (14, "X9", "Poe", "a"), (15, "5", "Poe", "A ")]
    return spark.createDataFrame(rows, "id bigint, external_id string, last_name string, address1 string")


@pytest.fixture
def units(spark):
    return spark.createDataFrame([(21, "U1"), (22, "U2"), (23, "U3")], "id bigint, unit_number string")


@pytest.fixture
def tenants(export):
    rows = [("100", "1.0", " U1 "), ("200", "9", "U2"), ("300", "2", "U9"), ("300.0", "1", "U2"), ("abc", "1", "U1"), ("400", "x", "U1")]
    return export(["LEDGERID", "TENANTID", "SUNITNAME"], rows)


PAYMENT_COLUMNS = ["PAYMENTID", "LEDGERID", "PMTTYPEID", "DCPMTAMT", "DPMT", "DCREATED", "BNSF", "DDELETED", "SCHECKNUM", "RECEIPTID", "EMPLOYEEID"]
PAYMENT_ROWS = [
    ("1.0", "100", "99", "10.125", "1/2/2020", None, "1", None, " 77 ", "5.0", "8"),  # loaded, tie to even
    ("2", " ", "99", "1", "1/2/2020", None, None, None, None, None, None),  # silent: no ledger
    ("3", "abc", "99", "1", "1/2/2020", None, None, None, None, None, None),  # silent: bad ledger
    ("4", "200", "99", "1", "1/2/2020", None, None, None, None, None, None),  # tenant is no customer
    ("5", "100", "99", "0.00", "1/2/2020", None, None, None, None, None, None),  # zero
    ("6", "100", "99", "junk", "1/2/2020", None, None, None, None, None, None),  # counts as zero
    ("7", "100", "99", "1", "1/2/2020", None, None, "1/3/2020", None, None, None),  # deleted
    ("8", "100", "99", "1", "1/2/2020", None, None, None, None, None, None),  # is a credit
    (None, "100", "99", "1", "1/2/2020", None, None, None, None, None, None),  # silent: no id
    ("9", "100", "99", "1", "1/2/2020", None, None, None, None, None, None),  # stored
    ("10", "100", "99", "1", "nat", "2/2/1969", None, None, None, None, None),  # no date
    ("11", "100", "cash", "1", "1/2/2020", None, None, None, None, None, None),  # bad method
    ("12", "300", "104", "-5", None, "2020-01-05 10:00:00", "no", "", None, None, None),  # created date, floored amount
    ("1", "100", "99", "99", "1/2/2020", None, None, None, None, None, None),  # repeat
]


def payments(export, tenants, customers, stored, partitions=None):
    credits = export(["PAYMENTID"], [("8.0",), (None,)])
    return load_payments(
        export(PAYMENT_COLUMNS, PAYMENT_ROWS, partitions), tenants, customers, stored, PARAMS, credits=credits
    )


@pytest.fixture
def stored_payments(spark):
    return spark.createDataFrame([("9",)], "external_id string")


def test_payments(export, tenants, customers, stored_payments):
    outcome = payments(export, tenants, customers, stored_payments)
    rows = {r.external_id: r for r in outcome.accepted.collect()}
    assert set(rows) == {"1", "12"}
    one, twelve = rows["1"], rows["12"]
    assert (one.amount_in_cents, one.customer_id, one.status, one.reference_number) == (1012, 11, "FAILED", "77")
    assert one.notes == "Imported from SiteLink. LedgerID: 100. ReceiptID: 5."
    assert one.payment_date == one.created_at == datetime(2020, 1, 2)
    assert (twelve.amount_in_cents, twelve.customer_id, twelve.status) == (0, 11, "COMPLETED")
    assert twelve.payment_date == datetime(2020, 1, 5, 10)
    assert counts(outcome) == {
        "insert:new": 2, "silent:no_ledger": 2, "skip:no_customer": 1, "skip:zero_amount": 2, "skip:deleted": 1,
        "skip:credit": 1, "silent:no_payment_id": 1, "skip:duplicate": 1, "error:no_date": 1, "error:bad_method": 1,
        "skip:repeat_in_file": 1,
    }


def test_every_source_row_is_accounted_for(export, tenants, customers, stored_payments):
    outcome = payments(export, tenants, customers, stored_payments)
    assert sum(counts(outcome).values()) == len(PAYMENT_ROWS)
    assert outcome.accepted.count() + outcome.rejects.count() == len(PAYMENT_ROWS)
    by_reason = {f"{r.outcome}:{r.reason}": r["count"] for r in outcome.rejects.groupBy("outcome", "reason").count().collect()}
    assert by_reason == {k: n for k, n in counts(outcome).items() if not k.startswith("insert")}


def test_second_run_adds_nothing(export, tenants, customers, stored_payments):
    first = payments(export, tenants, customers, stored_payments).accepted
    snapshot = insert_new(stored_payments, first.withColumn("_row_ord", F.lit(0)), ["external_id"])
    again = payments(export, tenants, customers, snapshot)
    assert again.accepted.count() == 0
    assert "insert:new" not in counts(again)


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_result_does_not_depend_on_partitioning(export, tenants, customers, stored_payments, partitions):
    base = payments(export, tenants, customers, stored_payments)
    other = payments(export, tenants, customers, stored_payments, partitions)
    assert sorted(map(str, other.accepted.collect())) == sorted(map(str, base.accepted.collect()))
    assert counts(other) == counts(base)


def test_settled_rows_give_the_same_frames(export, tenants, customers, stored_payments):
    outcome = payments(export, tenants, customers, stored_payments)
    settled = outcome.settled()
    assert sorted(map(str, settled.accepted.collect())) == sorted(map(str, outcome.accepted.collect()))
    assert counts(settled) == counts(outcome)
    assert settled.rejects.count() == outcome.rejects.count()


def test_charges(spark, export, tenants, customers, units):
    columns = ["CHARGEID", "CHARGEDESCID", "LEDGERID", "DCAMT", "DCHGSTRT", "DCREATED", "DUPDATED", "SCHGDESC", "DDELETED"]
    rows = [
        ("1.0", "7.0", "100", "-12.345", "1/2/2020", "1/1/2020", None, " Rent ", None),
        ("2", "7", "100", "1", None, None, None, "nan", "1/1/2020"),
        ("3", "n/k", "100", "1", None, None, None, None, None),
        ("4", "8", "100", "1", None, None, None, None, None),
        ("5", "7", "200", "1", None, None, None, None, None),
        ("6", "7", "100", "1", None, None, None, None, None),
        ("7", "7", "300", "x", None, None, None, "nan", None),
        (" ", "7", "100", "999", None, None, None, "total", None),
    ]
    types = export(["ID", "CHARGEDESCID"], [("3", "7"), (None, "8"), ("5", "7.0")])
    stored = spark.createDataFrame([("6",)], "external_charge_id string")
    outcome = load_charges(export(columns, rows), types, tenants, customers, units, stored, PARAMS)
    got = {r.external_charge_id: r for r in outcome.accepted.collect()}
    assert set(got) == {"1", "7"}
    assert (got["1"].amount_in_cents, got["1"].unit_id, got["1"].charge_type_id, got["1"].memo) == (-1234, 21, 5, "Rent")
    assert got["1"].updated_at == PARAMS.run_ts and got["1"].effective_date == datetime(2020, 1, 2)
    assert (got["7"].amount_in_cents, got["7"].unit_id, got["7"].memo, got["7"].effective_date) == (0, 22, None, PARAMS.run_ts)
    assert counts(outcome) == {
        "insert:new": 2, "skip:deleted": 1, "error:bad_ids": 1, "skip:no_charge_type": 1, "skip:no_customer": 1, "skip:duplicate": 1,
    }


def test_credits(spark, export, tenants, customers, units):
    columns = ["CREDITID", "LEDGERID", "DCCREDITAMT", "DCREDIT", "SMEMO", "DCREATED", "BNONPOSTING", "DDELETED"]
    rows = [
        ("1", "100", "5.50", "1/1/1900", "Reservation Fee ", "1/2/2020", "False", None),
        ("2", "100", "-5.50", None, "reservation fee", None, None, None),
        ("3", "100", "5", None, "reservation fee", None, " TRUE", None),
        ("4", "100", "5", None, "reservation fee", None, None, "x"),
        ("5", " ", "5", None, "reservation fee", None, None, None),
        ("6", "100", "5", None, "other memo", None, None, None),
        ("7", "abc", "5", None, "reservation fee", None, None, None),
        ("8", "200", "5", None, "reservation fee", None, None, None),
        ("9", "100", "5", None, "other memo", None, None, None),
    ]
    stored = spark.createDataFrame([("9", 100)], "external_charge_id string, amount_in_cents bigint")
    outcome = load_credits(export(columns, rows), tenants, customers, units, stored, PARAMS)
    row = outcome.accepted.collect()
    assert len(row) == 1
    assert (row[0].amount_in_cents, row[0].charge_type_id, row[0].memo) == (-550, 10002, "Reservation Fee")
    assert row[0].effective_date == PARAMS.run_ts and row[0].created_at == datetime(2020, 1, 2)
    assert counts(outcome) == {
        "insert:new": 1, "skip:amount_not_positive": 1, "skip:non_posting": 1, "skip:deleted": 1, "skip:no_ledger": 1,
        "skip:no_memo_mapping": 1, "error:bad_ledger": 1, "skip:no_customer": 1, "skip:duplicate": 1,
    }


def test_receipts(spark, export, customers):
    columns = ["RECEIPTID", "TENANTID", "DCAMT", "DRCPT", "IRECEIPTNUM", "PAYMENTID"]
    rows = [
        ("1", "1.0", "-2", "1/2/2020", " 7 ", "50.0"), ("2", "x", "2", None, "7", "50"), ("3", "1", "0", None, "7", "50"),
        ("4", "1", "2", None, None, "50"), ("5", "1", "2", None, "8", "50"), ("6", "1", "2", None, "9", "51"),
        ("7", "77", "2", None, "10", "50"), ("8", "1", "3", None, "7", "50"),
    ]
    stored_payments = spark.createDataFrame(
        [(500, "50", datetime(2020, 1, 1), 99)], "id bigint, external_payment_id string, payment_date timestamp_ntz, payment_method_type_id bigint"
    )
    methods = spark.createDataFrame([(99, "Cash")], "id bigint, name string")
    stored = spark.createDataFrame([("SL-8-50",)], "receipt_number string")
    outcome = load_receipts(export(columns, rows), stored_payments, methods, customers, stored, PARAMS)
    row = outcome.accepted.first()
    assert (row.receipt_number, row.payment_id, row.payment_method, row.amount_in_cents) == ("SL-7-50", 500, "Cash", 0)
    assert counts(outcome) == {
        "insert:new": 1, "error:bad_ids": 1, "skip:zero_amount": 1, "skip:no_receipt_number": 1, "skip:duplicate": 1,
        "skip:no_payment": 1, "skip:no_customer": 1, "skip:repeat_in_file": 1,
    }


INVOICE_COLUMNS = ["INVOICEID", "IINVOICENUM", "CHARGEID", "DINVOICED", "DDUE", "PAYMENTID"]


def test_invoices(spark, export):
    rows = [
        ("1.0", "900", "zz", "1/1/2020", "1/31/2020", "70"),  # first charge is not stored
        ("1.0", "901", "10", "1/2/2020", "2/1/2020", "71.0"),
        ("1.0", "902", "10", "1/2/2020", "2/1/2020", "71"),  # same charge again counts again
        ("2", None, "10", "1/1/2020", "1/1/2020", None),
        ("3", "1", "10", "soon", "1/1/2020", None),
        ("4", "1", "10", "1/1/2020", None, None),
        ("5", "1", None, "1/1/2020", "1/1/2020", None),
        ("6", "1", "zz", "1/1/2020", "1/1/2020", None),
        ("7", "1", "11", "1/1/2020", "1/1/2020", None),  # negative total
        ("8", "1", "10", "1/1/2020", "1/1/2020", None),  # stored
        ("9", "1", "12", "1/1/2020", "1/1/2020", None),
    ]
    charges = spark.createDataFrame(
        [(1, "10", 11, 3, 1000), (2, "11", 11, 1, -5), (3, "12", 12, 99, 700)],
        "id bigint, external_charge_id string, customer_id bigint, charge_type_id bigint, amount_in_cents bigint",
    )
    paid = export(
        ["CHARGEID", "DPMT", "DCPMTAMT"],
        [("10.0", "1/1/2020", "2.50"), ("10", "6/15/2020", "1"), ("10", "6/16/2020", "100"), ("12", "1/1/2020", "7"), ("zz", "1/1/2020", "0.10"), ("10", "x", "1"), ("10", "1/1/2020", "x")],
    )
    stored = spark.createDataFrame([("8",)], "external_invoice_id string")
    outcome = load_invoices(export(INVOICE_COLUMNS, rows), charges, paid, stored, PARAMS)
    got = {r.external_invoice_id: r for r in outcome.accepted.collect()}
    assert set(got) == {"1", "9"}
    one = got["1"]
    assert (one.invoice_number, one.customer_id, one.invoice_type_id, one.issue_date) == ("900", 11, 1, date(2020, 1, 1))
    assert (one.total_in_cents, one.amount_paid_in_cents, one.balance_in_cents, one.status) == (2000, 710, 1290, "PARTIAL_PAID")
    assert (got["9"].status, got["9"].balance_in_cents, got["9"].invoice_type_id) == ("PAID", 0, 7)
    assert counts(outcome) == {
        "insert:new": 2, "skip:no_invoice_number": 1, "skip:no_issue_date": 1, "skip:no_due_date": 1, "skip:no_charges": 1,
        "skip:no_customer": 1, "skip:total_not_positive": 1, "skip:duplicate": 1,
    }
    pairs = payment_pairs(export(INVOICE_COLUMNS, rows), outcome.accepted)
    assert sorted(map(tuple, pairs.collect())) == [("1", "70"), ("1", "71")]


def test_payments_are_linked_to_the_largest_invoice(spark):
    payments = spark.createDataFrame([(1, "a", None), (2, "b", 7), (3, "c", 7)], "id bigint, external_payment_id string, invoice_id bigint")
    pairs = spark.createDataFrame([("x", "a"), ("y", "a"), ("x", "b"), ("q", "c")], "external_invoice_id string, external_payment_id string")
    invoices = spark.createDataFrame([(100, "x"), (200, "y")], "id bigint, external_invoice_id string")
    linked = {r.id: r.invoice_id for r in link_payments(payments, pairs, invoices).collect()}
    assert linked == {1: 200, 2: 100, 3: 7}
    kept = {r.id: r.invoice_id for r in link_payments(payments, pairs, invoices, only_unlinked=True).collect()}
    assert kept == {1: 200, 2: 7, 3: 7}


TENANCY_COLUMNS = [
    "TENANTID", "SUNITNAME", "DMOVEDIN", "DLEASE", "DPAIDTHRU", "DMOVEDOUT", "DSCHEDOUT", "DCRENT", "DCSCHEDRENT", "SACCESSCODE",
    "DCSECDEPPAID", "DCINSURPREMIUM", "LEDGERID", "BILLINGFREQID", "IPROCESSDAYOFMONTH", "DDELETED2",
]
STAY = ("1/31/2020", None, "2/29/2020", None, None, "$1,000.50", "0", "12345678901", None, "5", "1", "3.0", "0", None)


def tenancy(tenant, unit, **changes):
    row = dict(zip(TENANCY_COLUMNS, (tenant, unit, *STAY), strict=True)) | changes
    return tuple(row[c] for c in TENANCY_COLUMNS)


def test_active_leases(spark, export, customers, units):
    rows = [
        tenancy("1", " U1 "), tenancy("2", "U1"), tenancy("9", "U1"), tenancy("1", "U9"), tenancy("1", "U2", DMOVEDIN="x"),
        tenancy("1", "U2", DPAIDTHRU=None), tenancy("1", "U2", DCRENT="nan"), tenancy("2", "U3"), tenancy("2", "U2", DCRENT="junk"),
    ]
    stored = spark.createDataFrame([(23, "ACTIVE"), (22, "TERMINATED")], "unit_id bigint, status string")
    outcome = load_leases(export(TENANCY_COLUMNS, rows), customers, units, stored, PARAMS)
    got = {r.unit_id: r for r in outcome.accepted.collect()}
    assert set(got) == {21, 22}
    one = got[21]
    assert (one.customer_id, one.rental_rate_in_cents, one.schedule_rate_in_cents, one.charge_day) == (11, 100050, 100050, 30)
    assert (one.lease_date, one.schedule_date, one.insurance_option, one.status) == (date(2020, 1, 31), date(2020, 1, 31), "BASIC", "ACTIVE")
    assert got[22].rental_rate_in_cents == 0
    assert counts(outcome) == {
        "insert:new": 2, "skip:repeat_in_file": 1, "skip:no_customer": 1, "skip:no_unit": 1, "skip:no_move_in": 1,
        "skip:no_paid_through": 1, "skip:no_rent": 1, "skip:unit_occupied": 1,
    }


def test_history_leases(spark, export, customers, units):
    out = {"DMOVEDOUT": "3/1/2020"}
    rows = [
        tenancy("1.0", "U1", **out, DSCHEDOUT="1/1/2020"), tenancy("1", "U1", **out), tenancy("1", "U1", DMOVEDOUT="4/1/2020"),
        tenancy("1", "U2", **out), tenancy("2", "U3", **out), tenancy("1", "U3"), tenancy("1", "U3", DMOVEDOUT="nat"),
        tenancy("1", "U3", DMOVEDOUT="soon"),
    ]
    stored = spark.createDataFrame(
        [(11, 22, date(2020, 1, 31), None), (12, 23, date(2020, 1, 31), date(2020, 3, 1))],
        "customer_id bigint, unit_id bigint, move_in_date date, move_out_date date",
    )
    frame = export(TENANCY_COLUMNS, rows)
    outcome = load_history_leases(frame, customers, units, stored, PARAMS)
    got = outcome.accepted.collect()
    assert sorted((r.customer_id, r.unit_id, r.move_out_date) for r in got) == [(11, 21, date(2020, 3, 1)), (11, 21, date(2020, 4, 1))]
    assert all(r.schedule_date == date(2020, 1, 31) and r.status == "TERMINATED" for r in got)
    assert counts(outcome) == {
        "insert:new": 2, "skip:repeat_in_file": 1, "skip:active_lease": 1, "skip:duplicate": 1, "skip:no_move_out": 1,
    }
    updating = load_history_leases(frame, customers, units, stored, UPDATING)
    assert [(r.customer_id, r.unit_id, r.rental_rate_in_cents) for r in updating.updates.collect()] == [(12, 23, 100050)]


def test_links(spark, export, customers, units):
    rows = [tenancy("1", "U1"), tenancy("1", "U1", DCRENT="7"), tenancy("2", "U2"), tenancy("2", "U3", DMOVEDIN=None)]
    stored = spark.createDataFrame([(12, 22)], "customer_id bigint, unit_id bigint")
    outcome = load_links(export(TENANCY_COLUMNS, rows), customers, units, stored, PARAMS)
    row = outcome.accepted.collect()
    assert [(r.customer_id, str(r.rental_rate), r.charge_day, r.access_code) for r in row] == [(11, "1000.50", 31, "1234567890")]
    assert counts(outcome) == {"insert:new": 1, "skip:repeat_in_file": 1, "skip:duplicate": 1, "skip:no_move_in": 1}
    updating = load_links(export(TENANCY_COLUMNS, rows), customers, units, stored, UPDATING)
    assert str(updating.accepted.first().rental_rate) == "7.00"
    assert [(r.customer_id, r.unit_id) for r in updating.updates.collect()] == [(12, 22)]
    assert counts(updating) == {"insert:new": 1, "update:matched": 2, "skip:no_move_in": 1}


def test_history_links(spark, export, customers, units):
    rows = [tenancy("1.0", "U1", DMOVEDOUT="3/1/2020"), tenancy("2", "U2", DMOVEDOUT="3/1/2020"), tenancy("2", "U3")]
    stored = spark.createDataFrame(
        [(12, 22, date(2020, 1, 31), date(2020, 3, 1))], "customer_id bigint, unit_id bigint, lease_date date, move_out_date date"
    )
    outcome = load_history_links(export(TENANCY_COLUMNS, rows), customers, units, stored, PARAMS)
    assert [(r.customer_id, r.charge_day, str(r.rental_rate)) for r in outcome.accepted.collect()] == [(11, 28, "0.00")]
    assert counts(outcome) == {"insert:new": 1, "skip:duplicate": 1}


def test_billing(spark, export, customers, units):
    rows = [
        tenancy("1.0", "U1", DLEASE="7/31/99"), tenancy("1", "U1", BILLINGFREQID="9"), tenancy("1", "U1", BILLINGFREQID="1"),
        tenancy("9", "U1"), tenancy("1", "U9"), tenancy("2", "U1"), tenancy("1", "U2", DLEASE="1/1/1900"),
        tenancy("1", "U1", DMOVEDOUT="x"), tenancy("1", "U1", DDELETED2="x"), tenancy("2", "U3", DLEASE="1/5/2020"),
    ]
    roll = export(["UNIT", "CHARGE DAY"], [("U3", "12.0"), ("U3", "x"), ("U1", "0")])
    leases = spark.createDataFrame(
        [(1, 11, 21, None), (2, 11, 22, None), (3, 12, 23, None), (4, 12, 21, date(2020, 1, 1))],
        "id bigint, customer_id bigint, unit_id bigint, move_out_date date",
    )
    stored = spark.createDataFrame([], "rental_agreement_id bigint")
    outcome = load_billing_schedules(export(TENANCY_COLUMNS, rows), roll, customers, units, leases, stored, PARAMS)
    got = {r.rental_agreement_id: r for r in outcome.accepted.collect()}
    assert {k: (r.charge_day, r.start_date, r.next_billing_date, r.billing_frequency) for k, r in got.items()} == {
        1: (28, date(1999, 7, 31), date(2020, 6, 28), "MONTHLY"), 3: (12, date(2020, 1, 5), date(2020, 7, 12), "MONTHLY"),
    }
    assert counts(outcome) == {
        "insert:new": 2, "skip:unknown_frequency": 1, "skip:unsupported_frequency": 1, "skip:no_customer": 1,
        "skip:no_unit": 1, "skip:no_lease": 1, "skip:no_lease_date": 1,
    }


def test_customers(spark, export):
    columns = list(CUSTOMER_KEYS)
    blank = {c: None for c in columns}
    rows = [
        blank | {"TENANTID": " 1 ", "SFNAME": "Ann", "SMI": "B", "SLNAME": "One"}, blank | {"TENANTID": "nan"},
        blank | {"TENANTID": "1", "SLNAME": "Two"}, blank | {"TENANTID": "2", "SLNAME": "New"},
    ]
    frame = export(columns, [tuple(r[c] for c in columns) for r in rows])
    stored = spark.createDataFrame([("2", "Old", 3)], "external_id string, last_name string, created_by bigint")
    outcome = load_customers(frame, stored, PARAMS)
    assert [(r.external_id, r.first_name, r.last_name) for r in outcome.accepted.collect()] == [("1", "Ann B", "One")]
    assert counts(outcome) == {"insert:new": 1, "skip:no_tenant_id": 1, "skip:repeat_in_file": 1, "skip:duplicate": 1}
    updating = load_customers(frame, stored, UPDATING)
    assert [(r.external_id, r.last_name) for r in updating.accepted.collect()] == [("1", "Two")]
    merged = upsert(stored, updating.updates, ["external_id"], ["last_name"])
    assert [tuple(r) for r in merged.collect()] == [("2", "New", 3)]


FORMER_COLUMNS = ["FIRSTNAME", "LASTNAME", "ACTIVELEDGERS", "TENANTID", "PHONE", "UNITNAME", "DATEMOVEDIN", "DATEMOVEDOUT"]


def test_former_customers(spark, export):
    rows = [
        ("A", "One", " 0 ", "7.0", "555", "U1", "1/2/2020", "nan"), ("B", "Two", "2", "8", None, None, None, None),
        ("C", "Three", "", None, None, None, None, None), ("D", "Four", "0.0", "9", None, None, None, None),
        ("E", " ", None, "5", None, None, None, None),
    ]
    frame = export(FORMER_COLUMNS, rows)
    gone, active = split_former(frame)
    assert (gone.count(), active.count()) == (3, 2)
    stored = spark.createDataFrame([("5",)], "external_id string")
    outcome = load_former_customers(frame, stored, PARAMS)
    assert [(r.external_id, r.customer_status_id) for r in outcome.accepted.collect()] == [("7", 2)]
    assert counts(outcome) == {"insert:new": 1, "error:no_tenant_id": 1, "skip:duplicate": 1}
    noted = load_former_with_notes(frame, stored, PARAMS)
    notes = {r.last_name: r.notes for r in noted.accepted.collect()}
    assert notes["One"] == "Last unit: U1 | Move-in: 2020-01-02" and notes["Two"] is None
    assert counts(noted) == {"insert:new": 4, "skip:no_last_name": 1}


def test_units(spark, export):
    columns = list(UNIT_KEYS)
    blank = {c: None for c in columns}
    rows = [
        blank | {"UNITNAME": "U1", "FLOOR": "2.0", "TYPE": "RV Parking", "UNITSIZE": "5 * 5", "STANDARDRATE": "1.125"},
        blank | {"UNITNAME": "U1", "FLOOR": "3", "UNITSIZE": "9x9", "BLDG": "B"}, blank | {"UNITNAME": "nan"},
        blank | {"UNITNAME": "U2", "ADA": "maybe"},
    ]
    frame = export(columns, [tuple(r[c] for c in columns) for r in rows])
    sizes = spark.createDataFrame([(1, "5x5"), (2, "0 x 0")], "id bigint, value string")
    stored = spark.createDataFrame(
        [("U2", 1, 4, True, "old")], "unit_number string, organization_id bigint, location_id bigint, reserved boolean, building string"
    )
    outcome = load_units(frame, sizes, stored, PARAMS)
    row = outcome.accepted.collect()
    assert [(r.unit_number, r.floor_level, r.unit_size_id, r.building, r.ada) for r in row] == [("U1", 3, 2, "B", False)]
    errors = {(r.row_id, r.field, r.value) for r in outcome.field_errors.collect()}
    assert errors == {("U1", "floor_level", "2.0"), ("U2", "ada", "maybe")}
    assert counts(outcome) == {"insert:new": 1, "update:matched": 2, "error:no_unit_name": 1}
    changed = upsert(stored, outcome.updates, list(UNIT_KEY), list(UNIT_UPDATES)).first()
    assert (changed.reserved, changed.building) == (True, None)
    assert load_units(frame, sizes, stored, PARAMS, nullable_flags=True).accepted.first().ada is None


def test_profiles(spark, export, customers):
    columns = ["Name", "CardNumber", "CardType", "ExpirationDate", "NameOnCard", "Address", "ZipCode"]
    rows = [
        ("DOE , J", "**** 1111", "Master Card", "1/2/2027", "J", "nowhere", "1"), ("NoComma", "1", "", None, None, None, None),
        ("Nobody, A", "1", "", None, None, None, None), ("Roe, A", "**2222", "Visa", "never", None, " 2 ROAD", None),
        ("Roe, A", "**2222", "Visa", None, None, "elsewhere", None), ("Roe, B", "**3333", "Visa", None, None, None, None),
        ("Poe, B", "**3333", "Visa", None, None, "a", None), ("Doe, J", "1111", "Visa", "1/9/2027", "K", None, "2"),
    ]
    stored = spark.createDataFrame([(12, "2222", None, None)], "customer_id bigint, card_last4 string, card_exp_month int, card_exp_year int")
    outcome = load_profiles(export(columns, rows), customers, stored, PARAMS)
    got = sorted((r.customer_id, r.card_last4, r.card_brand, r.billing_name) for r in outcome.accepted.collect())
    assert got == [(11, "1111", "visa", "K"), (13, "3333", "visa", None)]
    assert [r.profile_key for r in outcome.updates.collect()] == ["12|2222||"]
    assert counts(outcome) == {
        "insert:new": 2, "update:matched": 2, "skip:no_comma": 1, "skip:no_customer": 1, "skip:ambiguous_no_address": 1,
        "skip:ambiguous_same_address": 1,
    }


def test_card_numbers_reach_no_frame(spark, export, customers):
    columns = ["Name", "CardNumber", "CardType", "ExpirationDate", "NameOnCard", "Address", "ZipCode"]
    rows = [("Doe, J", "4111 1111 1111 1234", "Visa", None, None, None, None), ("NoComma", "4111 1111 1111 1234", "", None, None, None, None)]
    stored = spark.createDataFrame([], "customer_id bigint, card_last4 string, card_exp_month int, card_exp_year int")
    outcome = load_profiles(export(columns, rows), customers, stored, PARAMS)
    for frame in (outcome.rows, outcome.accepted, outcome.rejects, outcome.updates):
        assert "4111" not in str(frame.collect())


def test_balances(spark, export, customers):
    rows = [("1", "10.005", "2", "-1", "3", "$1,000.5", "1/2/2020"), ("9", "1", None, None, None, None, None), ("2", "-50", None, None, "x", None, None)]
    columns = ["TENANTID", "DCRENTBAL", "DCLATEFEE1BAL", "DCRECCHG8BAL", "DCCREDITBAL", "DCPMTLASTAMT", "DPMTLAST"]
    stored = spark.createDataFrame([], "customer_id bigint")
    outcome = load_balances(export(columns, rows), customers, stored, PARAMS)
    got = {r.customer_id: (r.balance_in_cents, r.credit_balance_in_cents, r.last_payment_amount_in_cents) for r in outcome.accepted.collect()}
    assert got == {11: (int(round(11.005 * 100)), 300, 100050), 12: (0, 0, 0)}
    assert counts(outcome) == {"insert:new": 2, "skip:no_customer": 1}


def test_gate_log(export):
    columns = ["OCCURRED", "DESCRIPTION", "ACCESSPOINTNAME", "ACCESSORFIRSTNAME", "ACCESSORLASTNAME"]
    rows = [
        ("1/2/2020 3:04:05 PM", " Granted", "G" * 40, "Ann", "Doe"), ("1/2/2020", "Denied", "", "", "Doe"), ("later", "x", "x", None, None),
        ("1/2/2020", "", None, "Ann", None),
    ]
    outcome = load_gate_log(export(columns, rows), PARAMS)
    got = [(r.triggered_by, r.command, r.success, r.error_message) for r in outcome.accepted.collect()]
    assert got == [("Doe, Ann", "G" * 32, True, None), ("Doe", None, False, "Denied"), ("Ann", None, False, None)]
    assert counts(outcome) == {"insert:new": 3, "skip:no_time": 1}
    assert [(r.row_id, r.reason, r.value) for r in outcome.rejects.collect()] == [("later", "no_time", "later")]
