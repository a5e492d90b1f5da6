"""Invoice detail export -> invoices table, and the payments linked to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaseload.functions.dates import free_date
from leaseload.functions.enums import invoice_type_id, invoice_type_name
from leaseload.functions.numbers import cents_or_null, id_text, whole_number
from leaseload.functions.records import invoice_status, open_balance, source_system
from leaseload.operators.keys import attach, last_wins, only_known
from leaseload.operators.outcome import Known, Outcome, Rule
from leaseload.params import Params
from leaseload.plans.common import classified, long
from leaseload.sources.contracts import INVOICE_COLUMNS, optional, require
from leaseload.sources.exports import ROW_ORDER, drop_blank_key

INVOICE_TABLE = (
    "invoice_number", "customer_id", "location_id", "organization_id", "invoice_type_id", "status",
    "issue_date", "due_date", "subtotal_in_cents", "tax_in_cents", "total_in_cents", "amount_paid_in_cents",
    "balance_in_cents", "created_by", "created_at", "updated_at", "version", "external_invoice_id",
    "external_employee_id", "external_system",
)


def paid_per_charge(payments: DataFrame, params: Params) -> DataFrame:
    """Cents paid per charge up to today, every payment rounded on its own."""
    paid = payments.select(
        id_text("CHARGEID").alias("charge_key"),
        free_date("DPMT").alias("_paid_on"),
        cents_or_null("DCPMTAMT").alias("_cents"),
    ).filter(F.col("_paid_on") <= params.today)
    return (
        paid.dropna(subset=["charge_key", "_cents"])
        .groupBy("charge_key")
        .agg(F.sum("_cents").alias("paid_in_cents"))
    )


def charge_values(charges: DataFrame, payments: DataFrame, params: Params) -> DataFrame:
    """Per charge id what is charged and what is paid, one row per id.

    Both sides are brought together before they meet the details, so the details
    are shuffled once by charge id. A payment for a charge that is not stored
    still counts as paid, hence the full outer join.
    """
    stored = last_wins(
        charges.select(
            id_text("external_charge_id").alias("charge_key"), "id", "customer_id", "charge_type_id", "amount_in_cents"
        ),
        ["charge_key"], ["customer_id", "charge_type_id", "amount_in_cents"], F.col("id"),
    ).withColumn("stored", F.lit(True))
    return stored.join(paid_per_charge(payments, params), "charge_key", "full_outer")


def invoice_groups(invoices: DataFrame, charges: DataFrame, payments: DataFrame, params: Params) -> DataFrame:
    """One row per invoice id: head of its first detail row, owner of its first stored
    charge (also when that charge has no customer), sums over all of them.

    Every aggregate combines on the map side; no list per invoice is built, so an
    invoice with very many details needs no more room than one with few.
    """
    require(invoices, INVOICE_COLUMNS)
    details = drop_blank_key(invoices, "INVOICEID").select(
        id_text("INVOICEID").alias("external_invoice_id"),
        id_text("CHARGEID").alias("charge_key"),
        "IINVOICENUM", "DINVOICED", "DDUE", optional(invoices, "EMPLOYEEID").alias("EMPLOYEEID"), ROW_ORDER,
    )
    matched = attach(details, charge_values(charges, payments, params), [("charge_key", "charge_key")])
    order = F.col(ROW_ORDER)
    # Only the cells of the head are read as numbers and dates, once per invoice.
    head = F.struct("IINVOICENUM", "DINVOICED", "DDUE", "EMPLOYEEID", ROW_ORDER)
    read_head = [
        id_text("_head.IINVOICENUM").alias("invoice_number"),
        free_date("_head.DINVOICED").alias("issue_date"),
        free_date("_head.DDUE").alias("due_date"),
        whole_number("_head.EMPLOYEEID").alias("external_employee_id"),
        F.col(f"_head.{ROW_ORDER}").alias(ROW_ORDER),
    ]
    owner = F.struct("customer_id", "charge_type_id")
    zero = long(0)
    return (
        matched.groupBy("external_invoice_id")
        .agg(
            F.min_by(head, order).alias("_head"),
            F.min_by(owner, F.when(F.col("stored"), order)).alias("_owner"),
            F.count("charge_key").alias("n_charges"),
            F.coalesce(F.sum("amount_in_cents"), zero).alias("total_in_cents"),
            F.coalesce(F.sum("paid_in_cents"), zero).alias("amount_paid_in_cents"),
        )
        .select("external_invoice_id", *read_head, "_owner.*", "n_charges", "total_in_cents", "amount_paid_in_cents")
    )


def load_invoices(
    invoices: DataFrame, charges: DataFrame, payments: DataFrame, stored: DataFrame, params: Params
) -> Outcome:
    """Invoices with a number, both dates, a stored charge and a positive total.

    ``charges`` is the stored ledger_charges table, ``payments`` the payments
    export. Groups are unique, so a stored id is the only possible conflict.
    """
    rows = invoice_groups(invoices, charges, payments, params)
    total, paid = F.col("total_in_cents"), F.col("amount_paid_in_cents")
    kind = invoice_type_id("charge_type_id")
    after = [
        Rule("no_invoice_number", F.col("invoice_number").isNull(), "IINVOICENUM"),
        Rule("no_issue_date", F.col("issue_date").isNull(), "DINVOICED"),
        Rule("no_due_date", F.col("due_date").isNull(), "DDUE"),
        Rule("no_charges", F.col("n_charges") == 0, "CHARGEID"),
        Rule("no_customer", F.col("customer_id").isNull(), "CHARGEID"),
        Rule("total_not_positive", total <= 0, "total_in_cents", total),
    ]
    derived = {
        "invoice_number": F.col("invoice_number"),
        "customer_id": F.col("customer_id"),
        "location_id": params.location,
        "organization_id": params.organization,
        "invoice_type_id": kind,
        "status": invoice_status(paid, total),
        "issue_date": F.col("issue_date"),
        "due_date": F.col("due_date"),
        "subtotal_in_cents": total,
        "tax_in_cents": long(0),
        "total_in_cents": total,
        "amount_paid_in_cents": paid,
        "balance_in_cents": open_balance(paid, total),
        "created_by": params.author,
        "created_at": params.now,
        "updated_at": params.now,
        "version": F.lit(0),
        "external_invoice_id": F.col("external_invoice_id"),
        "external_employee_id": F.col("external_employee_id"),
        "external_system": source_system(),
    }
    return Outcome(
        rows=classified(
            rows, F.col("external_invoice_id"), derived, [], after, {"invoice_type": invoice_type_name(kind)}
        ),
        columns=INVOICE_TABLE,
        key=("external_invoice_id",),
        known=(Known(stored, (("external_invoice_id", "external_invoice_id"),)),),
    )


def payment_pairs(invoices: DataFrame, accepted: DataFrame) -> DataFrame:
    """(invoice, payment) pairs of the accepted invoices, each pair once, in long form."""
    pairs = drop_blank_key(invoices, "INVOICEID").select(
        id_text("INVOICEID").alias("external_invoice_id"),
        id_text(optional(invoices, "PAYMENTID")).alias("external_payment_id"),
    )
    pairs = pairs.dropna().distinct()
    return only_known(pairs, accepted, [("external_invoice_id", "external_invoice_id")])


def distinct_invoices(invoices: DataFrame) -> DataFrame:
    """Number of detail rows and of different invoices in an export."""
    return drop_blank_key(invoices, "INVOICEID").agg(
        F.count(F.lit(1)).alias("n_details"), F.countDistinct(id_text("INVOICEID")).alias("n_invoices")
    )
