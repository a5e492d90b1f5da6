"""Reject frames of the plans whose other frames are checked elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame

from contract import money_plans as money
from contract import tenancy_plans as tenancy
from contract.registry import PARAMS, RANKED, Tables, check
from contract.tenancy_plans import ONE, TENANCY
from leaseload.operators.outcome import Outcome
from leaseload.plans.customers import load_former_customers, load_former_with_notes
from leaseload.plans.tenancy import load_history_links

CUSTOMERS_READ = ("x_customers", "t_customers")
FORMER_READ = ("x_former", "t_customers")


def told_sql(ctes: str, row_id: str, order: str = "_o1, _o2, _o3", errors: tuple[str, ...] = ()) -> str:
    """Rows not loaded with outcome and reason; ``errors`` names the reasons that are errors."""
    named = ", ".join(f"'{e}'" for e in errors) or "''"
    return f"""WITH {ctes}, {RANKED.format(order=order)},
        told AS (SELECT {row_id} AS row_id, COALESCE(r, 'repeat_in_file') AS reason FROM c2 WHERE r IS NOT NULL OR rn > 1)
        SELECT row_id, CASE WHEN reason IN ({named}) THEN 'error' ELSE 'skip' END AS outcome, reason FROM told"""


def told(outcome: Outcome) -> DataFrame:
    return outcome.rejects.select("row_id", "outcome", "reason")


@check("receipts_rejects", money.RECEIPT_ADAPTERS, told_sql(money.RECEIPT_SQL, "RECEIPTID", errors=("bad_ids", "amount_out_of_range")))
def receipts_rejects(t: Tables) -> DataFrame:
    return told(money.receipts(t))


@check("invoice_rejects", money.INVOICE_ADAPTERS, told_sql(money.INVOICE_SQL, "inv"))
def invoice_rejects(t: Tables) -> DataFrame:
    return told(money.invoices(t))


@check("lease_history_rejects", (*TENANCY, "t_leases"), told_sql(tenancy.HISTORY_LEASE_SQL, "unit", ONE, ("amount_out_of_range",)))
def lease_history_rejects(t: Tables) -> DataFrame:
    return told(tenancy.history_leases(t))


@check("customer_unit_link_rejects", (*TENANCY, "t_links"), told_sql(tenancy.LINK_SQL, "unit", ONE, ("amount_out_of_range",)))
def customer_unit_link_rejects(t: Tables) -> DataFrame:
    return told(tenancy.links(t))


@check("history_link_rejects", (*TENANCY, "t_links"), told_sql(tenancy.HISTORY_LINK_SQL, "unit", ONE, ("amount_out_of_range",)))
def history_link_rejects(t: Tables) -> DataFrame:
    return told(load_history_links(t("x_tenancy"), t("t_customers"), t("t_units"), t("t_links"), PARAMS))


@check("customers_rejects", CUSTOMERS_READ, told_sql(tenancy.CUSTOMER_CHECK_SQL, "TENANTID", "_o1, _o2"))
def customers_rejects(t: Tables) -> DataFrame:
    return told(tenancy.customers(t))


@check("former_customers_rejects", FORMER_READ, told_sql(tenancy.FORMER_SQL, "TENANTID", ONE, ("no_tenant_id",)))
def former_customers_rejects(t: Tables) -> DataFrame:
    return told(load_former_customers(t("x_former"), tenancy.stored_customers(t), PARAMS))


@check("synthetic_id_rejects", FORMER_READ, told_sql(tenancy.NOTES_SQL, "LASTNAME", ONE))
def synthetic_id_rejects(t: Tables) -> DataFrame:
    return told(load_former_with_notes(t("x_former"), t("t_customers"), PARAMS))


@check("balance_rejects", ("x_balances", "t_customers"), told_sql(tenancy.BALANCE_SQL, "TENANTID", ONE, ("amount_out_of_range",)))
def balance_rejects(t: Tables) -> DataFrame:
    return told(tenancy.balances(t))


@check("card_profiles_rejects", tenancy.CARDS, f"""WITH {tenancy.CARD_SQL}
    SELECT Name AS row_id, 'skip' AS outcome, b AS reason FROM c WHERE b IS NOT NULL""")
def card_profiles_rejects(t: Tables) -> DataFrame:
    return told(tenancy.load_profiles(t("x_cards"), t("t_customers"), t("t_profiles"), PARAMS))
