"""Balance columns of the tenancy export -> customer_balances table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaseload.functions.dates import free_timestamp
from leaseload.functions.numbers import cents, total_cents
from leaseload.functions.text import squeeze
from leaseload.operators.keys import attach
from leaseload.operators.outcome import Known, Outcome, Rule
from leaseload.params import Params
from leaseload.plans.common import classified, long
from leaseload.sources.contracts import optional, require
from leaseload.sources.tables import customers_by_text

# The balances that add up to what a customer owes.
BALANCE_COLUMNS = (
    "DCRENTBAL",
    *[f"DCLATEFEE{n}BAL" for n in range(1, 6)],
    "DCNSFBAL", "DCADMINFEEBAL", "DCCUTLOCKFEEBAL", "DCAUCTIONFEEBAL", "DCINSURBAL", "DCOTHERBAL",
    *[f"DCRECCHG{n}BAL" for n in range(1, 9)],
)
BALANCE_TABLE = (
    "customer_id", "balance_in_cents", "credit_balance_in_cents", "last_payment_date",
    "last_payment_amount_in_cents", "total_invoiced_in_cents", "total_paid_in_cents", "organization_id",
    "location_id", "version",
)


def load_balances(balances: DataFrame, customers: DataFrame, stored: DataFrame, params: Params) -> Outcome:
    """One balance per known customer: the sum of twenty nullable columns, not below zero."""
    require(balances, ("TENANTID",))
    rows = balances.withColumn("_tenant", squeeze("TENANTID"))
    rows = attach(rows, customers_by_text(customers), [("_tenant", "tenant_key")])
    derived = {
        "customer_id": F.col("customer_id"),
        "balance_in_cents": total_cents([optional(rows, c) for c in BALANCE_COLUMNS]),
        "credit_balance_in_cents": cents(optional(rows, "DCCREDITBAL")),
        "last_payment_date": free_timestamp(optional(rows, "DPMTLAST")),
        "last_payment_amount_in_cents": cents(optional(rows, "DCPMTLASTAMT")),
        "total_invoiced_in_cents": long(0),
        "total_paid_in_cents": long(0),
        "organization_id": params.organization,
        "location_id": params.location,
        "version": F.lit(0),
    }
    amounts = {"balance_in_cents": "", "credit_balance_in_cents": "DCCREDITBAL", "last_payment_amount_in_cents": "DCPMTLASTAMT"}
    before = [
        Rule("no_customer", F.col("customer_id").isNull(), "TENANTID", F.col("TENANTID")),
        *[
            Rule("amount_out_of_range", derived[name].isNull(), cell, optional(rows, cell) if cell else None, "error")
            for name, cell in amounts.items()
        ],
    ]
    return Outcome(
        rows=classified(rows, F.col("TENANTID"), derived, before),
        columns=BALANCE_TABLE,
        key=("customer_id",),
        known=(Known(stored, (("customer_id", "customer_id"),)),),
    )
