"""Set-based corrections over whole stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leaseload.functions.records import open_balance, reviewed_status
from leaseload.operators.keys import attach, last_wins, only_known
from leaseload.params import Params

# The tables whose owner is filled in from the users table.
OWNED_TABLES = (
    "customer", "rental_agreements", "billing_schedules", "payments", "ledger_charges", "invoices",
)
STATUS_ORDER = ("PAID", "PARTIAL_PAID", "UNPAID", "OVERDUE")


def paid_per_invoice(payments: DataFrame) -> DataFrame:
    return (
        payments.filter("invoice_id IS NOT NULL")
        .groupBy("invoice_id")
        .agg(F.sum("amount_in_cents").alias("paid_in_cents"))
    )


def recalculate_invoices(
    invoices: DataFrame, payments: DataFrame, params: Params, legacy_preview: bool = False
) -> DataFrame:
    """Every invoice with paid amount, balance and status taken from its payments."""
    joined = attach(invoices, paid_per_invoice(payments), [("id", "invoice_id")])
    paid = F.coalesce("paid_in_cents", F.lit(0).cast("bigint"))
    total = F.col("total_in_cents")
    return joined.withColumns(
        {
            "status": reviewed_status(paid, total, F.col("due_date"), params.today, swapped=legacy_preview),
            "amount_paid_in_cents": paid,
            "balance_in_cents": open_balance(paid, total),
            "updated_at": params.now,
        }
    ).drop("paid_in_cents")


def status_distribution(invoices: DataFrame) -> DataFrame:
    """Invoices per status and their share in hundredths of a percent.

    The window runs over one row per status, after the count.
    """
    counts = invoices.groupBy("status").agg(F.count(F.lit(1)).alias("n_invoices"))
    total = F.sum("n_invoices").over(W.partitionBy())
    return counts.withColumn("share_bp", F.floor(F.col("n_invoices") * F.lit(10000) / total).cast("bigint"))


def link_payments(
    payments: DataFrame, pairs: DataFrame, invoices: DataFrame, only_unlinked: bool = False
) -> DataFrame:
    """Payments with the invoice they belong to.

    ``pairs`` holds (external_invoice_id, external_payment_id) in long form, never a
    list per invoice. Where a payment names several invoices the largest id wins.
    """
    ids = last_wins(
        invoices.select("external_invoice_id", F.col("id").alias("_invoice")),
        ["external_invoice_id"], ["_invoice"], F.col("_invoice"),
    )
    links = (
        pairs.select("external_invoice_id", "external_payment_id").distinct()
        .join(ids, "external_invoice_id")
        .groupBy("external_payment_id")
        .agg(F.max("_invoice").alias("_linked"))
    )
    linked = attach(payments, links, [("external_payment_id", "external_payment_id")])
    old = F.col("invoice_id")
    new = F.coalesce(old, F.col("_linked")) if only_unlinked else F.coalesce(F.col("_linked"), old)
    return linked.withColumn("invoice_id", new).drop("_linked")


def user_ids(users: DataFrame) -> DataFrame:
    """External employee id -> user id and how many users have it."""
    return users.dropna(subset=["external_id"]).groupBy("external_id").agg(
        F.max("id").alias("_user"), F.count(F.lit(1)).alias("_n")
    )


def backfill_created_by(table: DataFrame, users: DataFrame) -> DataFrame:
    """Owner from the employee id; null where no user has it; rows without one stay.

    A row whose employee id belongs to several users ends the job, as a scalar subquery
    that finds two rows would; such users that no row needs do not.
    """
    joined = attach(table, user_ids(users), [("external_employee_id", "external_id")])
    message = F.concat(F.lit("several users with external id "), F.col("external_employee_id").cast("string"))
    found = F.when(F.col("_n") > 1, F.raise_error(message).cast("bigint")).otherwise(F.col("_user"))
    owner = F.when(F.col("external_employee_id").isNull(), F.col("created_by")).otherwise(found)
    return joined.withColumn("created_by", owner).drop("_user", "_n")


def preview_created_by(table: DataFrame, users: DataFrame) -> DataFrame:
    """How many rows of a table have a user for their employee id."""
    hits = only_known(table, users.dropna(subset=["external_id"]), [("external_employee_id", "external_id")])
    return hits.agg(F.count(F.lit(1)).alias("n_rows"))


def backfill_tables(tables: dict[str, DataFrame], users: DataFrame) -> dict[str, DataFrame]:
    """Owner filled in for each of the owned tables that is given."""
    return {name: backfill_created_by(tables[name], users) for name in OWNED_TABLES if name in tables}


def preview_tables(tables: dict[str, DataFrame], users: DataFrame) -> DataFrame:
    """Per owned table how many rows would get an owner."""
    parts = [
        preview_created_by(tables[name], users).select(F.lit(name).alias("table"), "n_rows")
        for name in OWNED_TABLES if name in tables
    ]
    return reduce(DataFrame.unionByName, parts)
