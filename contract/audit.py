"""Reject frames with all their columns: outcome, reason, the cell's name and the cell itself."""

from __future__ import annotations

from pyspark.sql import DataFrame

from contract import money_plans as money
from contract import tenancy_plans as tenancy
from contract.registry import PARAMS, RANKED, Tables, check, free_at
from contract.tenancy_plans import ONE, TENANCY
from leaseload.operators.outcome import Outcome
from leaseload.plans.charges import load_credits
from leaseload.plans.gate import load_gate_log
from leaseload.plans.receipts import load_receipts


def audit_sql(ctes: str, row_id: str, cells: dict[str, str], key: str, errors: dict[str, str], order: str = "_o1, _o2, _o3") -> str:
    """``cells`` names the cell behind each reason; a stored key or a repeat names the key's last column."""
    field = " ".join(f"WHEN '{reason}' THEN '{cell}'" for reason, cell in cells.items())
    value = " ".join(f"WHEN '{reason}' THEN CAST({cell} AS VARCHAR)" for reason, cell in cells.items())
    outcome = " ".join(f"WHEN '{reason}' THEN '{kind}'" for reason, kind in errors.items()) or "WHEN '' THEN ''"
    return f"""WITH {ctes}, {RANKED.format(order=order)},
        told AS (SELECT *, {row_id} AS row_id, COALESCE(r, 'repeat_in_file') AS reason FROM c2 WHERE r IS NOT NULL OR rn > 1)
        SELECT row_id, CASE reason {outcome} ELSE 'skip' END AS outcome, reason,
               CASE reason {field} ELSE '{key}' END AS field, CASE reason {value} END AS value FROM told"""


def audit(outcome: Outcome) -> DataFrame:
    return outcome.rejects.select("row_id", "outcome", "reason", "field", "value")


PAYMENT_CELLS = {
    "no_ledger": "LEDGERID", "no_customer": "LEDGERID", "zero_amount": "DCPMTAMT", "amount_out_of_range": "DCPMTAMT",
    "deleted": "DDELETED", "no_payment_id": "PAYMENTID", "no_date": "DPMT", "bad_method": "PMTTYPEID",
}
CHARGE_CELLS = {
    "deleted": "DDELETED", "bad_ids": "LEDGERID", "no_charge_type": "CHARGEDESCID", "no_customer": "LEDGERID", "amount_out_of_range": "DCAMT",
}
CREDIT_CELLS = {
    "amount_not_positive": "DCCREDITAMT", "amount_out_of_range": "DCCREDITAMT", "non_posting": "BNONPOSTING", "deleted": "DDELETED",
    "no_ledger": "LEDGERID", "no_memo_mapping": "SMEMO", "bad_ledger": "LEDGERID", "no_customer": "LEDGERID",
}
RECEIPT_CELLS = {
    "bad_ids": "PAYMENTID", "zero_amount": "DCAMT", "amount_out_of_range": "DCAMT", "no_receipt_number": "IRECEIPTNUM",
    "no_payment": "PAYMENTID", "no_customer": "TENANTID",
}


@check("payments_audit", money.PAYMENT_ADAPTERS,
       audit_sql(money.PAYMENT_SQL, "PAYMENTID", PAYMENT_CELLS, "external_id", money.PAYMENT_OUTCOMES))
def payments_audit(t: Tables) -> DataFrame:
    return audit(money.payments(t))


@check("charges_audit", money.CHARGE_ADAPTERS,
       audit_sql(money.CHARGE_SQL, "CHARGEID", CHARGE_CELLS, "external_charge_id", {"bad_ids": "error", **money.TOO_LARGE}))
def charges_audit(t: Tables) -> DataFrame:
    return audit(money.charges(t))


@check("credits_audit", money.CREDIT_ADAPTERS,
       audit_sql(money.CREDIT_SQL, "CREDITID", CREDIT_CELLS, "external_charge_id", {"bad_ledger": "error", **money.TOO_LARGE}))
def credits_audit(t: Tables) -> DataFrame:
    return audit(money.credits(t))


@check("receipts_audit", money.RECEIPT_ADAPTERS,
       audit_sql(money.RECEIPT_SQL, "RECEIPTID", RECEIPT_CELLS, "receipt_number", {"bad_ids": "error", **money.TOO_LARGE}))
def receipts_audit(t: Tables) -> DataFrame:
    return audit(money.receipts(t))


LEASE_CELLS = {
    "no_customer": "tenant", "no_unit": "unit", "no_move_in": "DMOVEDIN", "no_move_out": "DMOVEDOUT",
    "no_paid_through": "DPAIDTHRU", "no_rent": "DCRENT", "amount_out_of_range": "DCRENT",
}
_LEASE_NAMES = {"tenant": "TENANTID", "unit": "SUNITNAME"}


def lease_audit_sql(ctes: str, key: str) -> str:
    sql = audit_sql(ctes, "unit", LEASE_CELLS, key, tenancy.TOO_LARGE, ONE)
    for cell, name in _LEASE_NAMES.items():
        sql = sql.replace(f"THEN '{cell}'", f"THEN '{name}'")
    return sql


@check("lease_active_audit", (*TENANCY, "t_leases"), lease_audit_sql(tenancy.LEASE_SQL, "unit_id"))
def lease_active_audit(t: Tables) -> DataFrame:
    return audit(tenancy.leases(t))


@check("customer_unit_link_audit", (*TENANCY, "t_links"), lease_audit_sql(tenancy.LINK_SQL, "unit_id"))
def customer_unit_link_audit(t: Tables) -> DataFrame:
    return audit(tenancy.links(t))


@check("units_rejects", tenancy.UNITS_USED, """
    SELECT UNITNAME AS row_id, 'error' AS outcome, 'no_unit_name' AS reason, 'UNITNAME' AS field, UNITNAME AS value
    FROM x_units WHERE lower(trim(UNITNAME)) IN ('', 'nan', 'none') OR UNITNAME IS NULL""")
def units_rejects(t: Tables) -> DataFrame:
    return audit(tenancy.units(t))


@check("gate_log_rejects", ("x_gate",), f"""
    SELECT OCCURRED AS row_id, 'skip' AS outcome, 'no_time' AS reason, 'OCCURRED' AS field, OCCURRED AS value
    FROM x_gate WHERE {free_at('OCCURRED')} IS NULL""")
def gate_log_rejects(t: Tables) -> DataFrame:
    return audit(load_gate_log(t("x_gate"), PARAMS))


_CREDIT_DATES = {"effective_date": "DCREDIT", "created_at": "DCREATED"}
_NO_DATE = "('', 'nan', 'NaT', 'None', '1/1/1900', '1900-01-01')"


def unread_sql(row_id: str, table: str, cells: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT {row_id} AS row_id, '{field}' AS field, {cell} AS value FROM {table}
            WHERE trim({cell}) NOT IN {_NO_DATE} AND {free_at(cell)} IS NULL""" for field, cell in cells.items()
    )


@check("credit_field_errors", ("x_credits_odd", *money.CREDIT_ADAPTERS), unread_sql("CREDITID", "x_credits_odd", _CREDIT_DATES))
def credit_field_errors(t: Tables) -> DataFrame:
    odd = load_credits(t("x_credits_odd"), t("x_tenants"), t("t_customers"), t("t_units"), t("t_charges_loaded"), PARAMS)
    return odd.field_errors.select("row_id", "field", "value")


@check("receipt_field_errors", ("x_receipts_odd", *money.RECEIPT_ADAPTERS), unread_sql("RECEIPTID", "x_receipts_odd", {"receipt_date": "DRCPT"}))
def receipt_field_errors(t: Tables) -> DataFrame:
    odd = load_receipts(t("x_receipts_odd"), t("t_payments"), t("t_methods"), t("t_customers"), t("t_receipts"), PARAMS)
    return odd.field_errors.select("row_id", "field", "value")
