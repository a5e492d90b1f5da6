"""Receipts export -> receipts table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaseload.functions.dates import free_timestamp, unread
from leaseload.functions.numbers import number, not_negative, signed_cents, whole_number
from leaseload.functions.records import receipt_number, source_system
from leaseload.operators.keys import attach, attach_code
from leaseload.operators.outcome import Known, Outcome, Rule, field_errors, judged
from leaseload.params import Params
from leaseload.plans.common import classified, long, nothing
from leaseload.sources.contracts import RECEIPT_COLUMNS, optional, require
from leaseload.sources.tables import customers_by_number

RECEIPT_TABLE = (
    "receipt_number", "payment_id", "customer_id", "receipt_date", "payment_date", "amount_in_cents",
    "payment_method", "transaction_id", "pdf_url", "pdf_filename", "pdf_size_bytes", "email_sent",
    "email_sent_at", "email_recipient", "email_subject", "version", "is_latest", "superseded_by_receipt_id",
    "generated_by_user_id", "created_at", "updated_at", "external_employee_id", "external_system",
)


def payment_lookup(payments: DataFrame, methods: DataFrame) -> DataFrame:
    """External payment id -> id, date and method name of the stored payment.

    One aggregate per column, so that a plan that only asks for the id shuffles no more."""
    named = attach_code(
        payments, methods.select(F.col("id").alias("_method"), F.col("name").alias("payment_method")),
        [("payment_method_type_id", "_method")],
    )
    return named.dropna(subset=["external_payment_id"]).groupBy("external_payment_id").agg(
        F.max("id").alias("payment_id"),
        *[F.max_by(c, "id").alias(c) for c in ("payment_date", "payment_method")],
    )


def load_receipts(
    receipts: DataFrame,
    payments: DataFrame,
    methods: DataFrame,
    customers: DataFrame,
    stored: DataFrame,
    params: Params,
    generated_by: int = 9,
) -> Outcome:
    """Receipts of stored payments and known customers."""
    require(receipts, RECEIPT_COLUMNS)
    rows = receipts.withColumns(
        {
            "_payment": whole_number("PAYMENTID"),
            "_tenant": whole_number("TENANTID"),
            "_amount": F.coalesce(number("DCAMT"), F.lit(0.0)),
            "_received": F.coalesce(free_timestamp("DRCPT"), params.now),
        }
    )
    rows = rows.withColumn("_payment_key", F.col("_payment").cast("string"))

    key = receipt_number("IRECEIPTNUM", F.col("_payment"))
    stamped = F.col("_received")
    before = [
        Rule("bad_ids", F.col("_payment").isNull() | F.col("_tenant").isNull(), "PAYMENTID", F.col("PAYMENTID"), "error"),
        Rule("zero_amount", F.col("_amount") == 0, "DCAMT", F.col("DCAMT")),
        Rule("amount_out_of_range", signed_cents("DCAMT").isNull(), "DCAMT", F.col("DCAMT"), "error"),
        Rule("no_receipt_number", key.isNull(), "IRECEIPTNUM", F.col("IRECEIPTNUM")),
    ]
    after = [
        Rule("no_payment", F.col("payment_id").isNull(), "PAYMENTID", F.col("PAYMENTID")),
        Rule("no_customer", F.col("customer_id").isNull(), "TENANTID", F.col("TENANTID")),
    ]
    rows, told_before = judged(rows, before, (), "before")
    rows = attach(rows, payment_lookup(payments, methods), [("_payment_key", "external_payment_id")])
    rows = attach(rows, customers_by_number(customers), [("_tenant", "tenant_id")])
    unread_dates = field_errors(
        {"receipt_date": (stamped, unread("DRCPT", free_timestamp("DRCPT")), F.col("DRCPT"))}
    )
    derived = {
        "receipt_number": key,
        "payment_id": F.col("payment_id"),
        "customer_id": F.col("customer_id"),
        "receipt_date": stamped,
        "payment_date": F.col("payment_date"),
        "amount_in_cents": not_negative(signed_cents("DCAMT")),
        "payment_method": F.col("payment_method"),
        "transaction_id": nothing(),
        "pdf_url": nothing(),
        "pdf_filename": nothing(),
        "pdf_size_bytes": nothing("bigint"),
        "email_sent": F.lit(False),
        "email_sent_at": nothing("timestamp_ntz"),
        "email_recipient": nothing(),
        "email_subject": nothing(),
        "version": F.lit(1),
        "is_latest": F.lit(True),
        "superseded_by_receipt_id": nothing("bigint"),
        "generated_by_user_id": long(generated_by),
        "created_at": stamped,
        "updated_at": stamped,
        "external_employee_id": whole_number(optional(rows, "EMPLOYEEID")),
        "external_system": source_system(),
    }
    return Outcome(
        rows=classified(rows, F.col("RECEIPTID"), derived, before, after, {"_errors": unread_dates}, (told_before, after)),
        columns=RECEIPT_TABLE,
        key=("receipt_number",),
        known=(Known(stored, (("receipt_number", "receipt_number"),)),),
    )
