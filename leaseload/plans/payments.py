"""Payments export -> payments table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaseload.functions.dates import payment_timestamp
from leaseload.functions.enums import payment_method_id
from leaseload.functions.numbers import id_text, not_negative, number, signed_cents, whole_number
from leaseload.functions.records import (
    failure_reason,
    payment_notes,
    payment_receipt_number,
    payment_status,
    source_system,
)
from leaseload.functions.text import clean_text, is_empty
from leaseload.operators.keys import attach
from leaseload.operators.outcome import Known, Outcome, Rule, judged
from leaseload.params import Params
from leaseload.plans.common import classified, ledger_customers, long, nothing, told_rows
from leaseload.sources.contracts import PAYMENT_COLUMNS, optional, require

PAYMENT_TABLE = (
    "external_id", "external_payment_id", "receipt_number", "customer_id", "location_id", "organization_id",
    "amount_in_cents", "payment_method_type_id", "status", "payment_date", "failure_reason", "reference_number",
    "notes", "created_by", "created_at", "updated_at", "payment_profile_id", "stripe_payment_intent_id",
    "stripe_charge_id", "stripe_refund_id", "transaction_fee_in_cents", "refunded_amount_in_cents",
    "reversal_reason", "reversed_by", "reversed_at", "external_employee_id", "external_system",
)


def credited_payments(credits: DataFrame) -> DataFrame:
    """Payment ids of the credits export; those are loaded as negative charges."""
    return credits.select(id_text(optional(credits, "PAYMENTID")).alias("credited_id")).dropna().distinct()


def load_payments(
    payments: DataFrame,
    tenants: DataFrame,
    customers: DataFrame,
    stored: DataFrame,
    params: Params,
    credits: DataFrame | None = None,
) -> Outcome:
    """Payments of known customers that are neither zero, void, credits nor stored."""
    require(payments, PAYMENT_COLUMNS)
    rows = payments.withColumns(
        {
            "_ledger": whole_number("LEDGERID"),
            "_payment": id_text("PAYMENTID"),
            "_paid_at": payment_timestamp("DPMT"),
            "_created_at": payment_timestamp("DCREATED"),
            "_amount": F.coalesce(number("DCPMTAMT"), F.lit(0.0)),
            "_method": payment_method_id("PMTTYPEID")[0],
        }
    )
    taken = Known(stored, (("external_id", "external_id"),))
    credited = () if credits is None else (
        Known(credited_payments(credits), (("external_id", "credited_id"),), "credit"),
    )

    deleted, nsf = optional(rows, "DDELETED"), optional(rows, "BNSF")
    paid_at, created_at = F.col("_paid_at"), F.col("_created_at")
    before = [
        Rule("no_ledger", F.col("_ledger").isNull(), "LEDGERID", F.col("LEDGERID"), "silent"),
        Rule("no_customer", F.col("customer_id").isNull(), "LEDGERID", F.col("LEDGERID")),
        Rule("zero_amount", F.col("_amount") == 0, "DCPMTAMT", F.col("DCPMTAMT")),
        Rule("amount_out_of_range", signed_cents("DCPMTAMT").isNull(), "DCPMTAMT", F.col("DCPMTAMT"), "error"),
        Rule("deleted", ~is_empty(deleted), "DDELETED", deleted),
        Rule("no_payment_id", F.col("_payment").isNull(), "PAYMENTID", F.col("PAYMENTID"), "silent"),
    ]
    after = [
        Rule("no_date", F.coalesce(paid_at, created_at).isNull(), "DPMT", F.col("DPMT"), "error"),
        Rule("bad_method", F.col("_method").isNull(), "PMTTYPEID", F.col("PMTTYPEID"), "error"),
    ]
    alone = rows
    rows, told_before = judged(rows, before, ("no_customer",), "before")
    rows, told_after = judged(rows, after, (), "after")
    rows = attach(rows, ledger_customers(tenants, customers), [("_ledger", "ledger_id")])
    stamped = F.coalesce(created_at, paid_at)
    derived = {
        "external_id": F.col("_payment"),
        "external_payment_id": F.col("_payment"),
        "receipt_number": payment_receipt_number(F.col("_payment")),
        "customer_id": F.col("customer_id"),
        "location_id": params.location,
        "organization_id": params.organization,
        "amount_in_cents": not_negative(signed_cents("DCPMTAMT")),
        "payment_method_type_id": F.col("_method"),
        "status": payment_status(nsf, deleted),
        "payment_date": F.coalesce(paid_at, created_at),
        "failure_reason": failure_reason(nsf, deleted),
        "reference_number": clean_text(optional(rows, "SCHECKNUM")),
        "notes": payment_notes(F.col("_ledger").cast("string"), id_text(optional(rows, "RECEIPTID"))),
        "created_by": params.author,
        "created_at": stamped,
        "updated_at": stamped,
        "payment_profile_id": nothing("bigint"),
        "stripe_payment_intent_id": nothing(),
        "stripe_charge_id": nothing(),
        "stripe_refund_id": nothing(),
        "transaction_fee_in_cents": long(0),
        "refunded_amount_in_cents": long(0),
        "reversal_reason": nothing(),
        "reversed_by": nothing("bigint"),
        "reversed_at": nothing("timestamp_ntz"),
        "external_employee_id": whole_number(optional(rows, "EMPLOYEEID")),
        "external_system": source_system(),
    }
    return Outcome(
        rows=classified(rows, F.col("PAYMENTID"), derived, before, after, told=(told_before, told_after)),
        columns=PAYMENT_TABLE,
        key=("external_id",),
        known=(*credited, taken),
        lean=lambda: told_rows(alone, "PAYMENTID", ("external_id", F.col("_payment")), tenants, customers, before, after),
    )
