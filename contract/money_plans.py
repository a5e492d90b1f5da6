"""Payments, charges, credits, receipts and invoices, next to their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.registry import (
    CUSTOMERS, LEDGERS, NOW_SQL, PARAMS, TODAY_SQL, UNITS, Tables, accepted_sql, big, cents, check, clean,
    counters_sql, day, empty, free_at, idt, num, paid_at, rejects_sql, too_large, ts, vc,
)
from leaseload.operators.load import assign_ids
from leaseload.operators.outcome import Outcome
from leaseload.operators.reconcile import link_payments, recalculate_invoices, status_distribution
from leaseload.plans.charges import key_collisions, load_charges, load_credits
from leaseload.plans.invoices import (
    distinct_invoices, invoice_groups, load_invoices, paid_per_charge, payment_pairs,
)
from leaseload.plans.payments import load_payments
from leaseload.plans.receipts import load_receipts

# -- payments -----------------------------------------------------------------

PAYMENT_ADAPTERS = ("x_payments", "x_credits", "x_tenants", "t_customers", "t_payments_loaded")


def payments(t: Tables) -> Outcome:
    return load_payments(
        t("x_payments"), t("x_tenants"), t("t_customers"), t("t_payments_loaded"), PARAMS, credits=t("x_credits")
    )


_NSF = "COALESCE(lower(trim(BNSF)) IN ('1', 'true', 'yes', 't', 'y'), FALSE)"
PAYMENT_SQL = f"""{LEDGERS}, {CUSTOMERS},
    credited AS (SELECT DISTINCT {idt('PAYMENTID')} AS id FROM x_credits WHERE PAYMENTID IS NOT NULL),
    p AS (SELECT x.*, {big('x.LEDGERID')} AS ledger, {idt('x.PAYMENTID')} AS ky, {paid_at('DPMT')} AS paid,
                 {paid_at('DCREATED')} AS created FROM x_payments x),
    c AS (SELECT p.*, customers.customer_id,
        CASE WHEN ledger IS NULL THEN 'no_ledger' WHEN customers.customer_id IS NULL THEN 'no_customer'
             WHEN COALESCE({num('DCPMTAMT')}, 0) = 0 THEN 'zero_amount' WHEN {too_large('DCPMTAMT')} THEN 'amount_out_of_range' WHEN NOT {empty('DDELETED')} THEN 'deleted'
             WHEN ky IS NULL THEN 'no_payment_id' END AS b,
        CASE WHEN ky IN (SELECT id FROM credited) THEN 'credit'
             WHEN ky IN (SELECT external_id FROM t_payments_loaded) THEN 'duplicate' END AS k,
        CASE WHEN paid IS NULL AND created IS NULL THEN 'no_date' WHEN {num('PMTTYPEID')} IS NULL THEN 'bad_method' END AS a
        FROM p LEFT JOIN ledgers ON ledger = ledgers.ledger_id LEFT JOIN customers ON ledgers.tenant_id = customers.tenant_id)"""
TOO_LARGE = {"amount_out_of_range": "error"}
PAYMENT_OUTCOMES = {"no_ledger": "silent", "no_payment_id": "silent", "no_date": "error", "bad_method": "error", **TOO_LARGE}


@check("payments_load", PAYMENT_ADAPTERS, accepted_sql(PAYMENT_SQL, f"""
    ky AS external_id, 'SL-' || ky AS receipt_number, customer_id,
    greatest(COALESCE({cents('DCPMTAMT')}, 0), 0) AS amount_in_cents,
    CAST({big('PMTTYPEID')} AS INTEGER) AS payment_method_type_id,
    CASE WHEN {_NSF} THEN 'FAILED' ELSE 'COMPLETED' END AS status, {ts('COALESCE(paid, created)')} AS payment_date,
    {ts('COALESCE(created, paid)')} AS created_at, CASE WHEN {_NSF} THEN 'NSF - Returned check' END AS failure_reason,
    {clean('SCHECKNUM')} AS reference_number,
    'Imported from SiteLink. LedgerID: ' || {idt('LEDGERID')} || '.' ||
        COALESCE(' ReceiptID: ' || {idt('RECEIPTID')} || '.', '') AS notes,
    {big('EMPLOYEEID')} AS external_employee_id, CAST(0 AS BIGINT) AS refunded_amount_in_cents,
    'sitelink' AS external_system"""))
def payments_load(t: Tables) -> DataFrame:
    return payments(t).accepted.select(
        "external_id", "receipt_number", "customer_id", "amount_in_cents", "payment_method_type_id", "status",
        "payment_date", "created_at", "failure_reason", "reference_number", "notes", "external_employee_id",
        "refunded_amount_in_cents", "external_system",
    )


@check("payments_counters", PAYMENT_ADAPTERS, counters_sql(PAYMENT_SQL, PAYMENT_OUTCOMES))
def payments_counters(t: Tables) -> DataFrame:
    return payments(t).counters


@check("payments_rejects", PAYMENT_ADAPTERS, rejects_sql(PAYMENT_SQL, "PAYMENTID"))
def payments_rejects(t: Tables) -> DataFrame:
    return payments(t).rejects.select("row_id", "reason")


# -- charges ------------------------------------------------------------------

CHARGE_ADAPTERS = ("x_charges", "x_charge_types", "x_tenants", "t_customers", "t_units", "t_charges_loaded")


def charges(t: Tables) -> Outcome:
    return load_charges(
        t("x_charges"), t("x_charge_types"), t("x_tenants"), t("t_customers"), t("t_units"), t("t_charges_loaded"),
        PARAMS,
    )


CHARGE_SQL = f"""{LEDGERS}, {CUSTOMERS}, {UNITS},
    types AS (SELECT {big('CHARGEDESCID')} AS desc_id, {big('ID')} AS charge_type_id FROM x_charge_types WHERE ID IS NOT NULL),
    p AS (SELECT x.*, {big('LEDGERID')} AS ledger, {big('CHARGEDESCID')} AS descr, {idt('CHARGEID')} AS ky,
                 {free_at('DCHGSTRT')} AS started, {free_at('DCREATED')} AS created, {free_at('DUPDATED')} AS updated
          FROM x_charges x WHERE NOT {empty('CHARGEID')}),
    c AS (SELECT p.*, customers.customer_id, units.unit_id, types.charge_type_id,
        CASE WHEN NOT {empty('DDELETED')} THEN 'deleted' WHEN descr IS NULL OR ledger IS NULL THEN 'bad_ids'
             WHEN types.charge_type_id IS NULL THEN 'no_charge_type' WHEN customers.customer_id IS NULL THEN 'no_customer'
             WHEN {too_large('DCAMT')} THEN 'amount_out_of_range' END AS b,
        CASE WHEN ky IN (SELECT external_charge_id FROM t_charges_loaded) THEN 'duplicate' END AS k,
        CAST(NULL AS VARCHAR) AS a
        FROM p LEFT JOIN types ON descr = types.desc_id LEFT JOIN ledgers ON ledger = ledgers.ledger_id
        LEFT JOIN customers ON ledgers.tenant_id = customers.tenant_id LEFT JOIN units ON ledgers.unit_name = units.unit_name)"""


@check("charges_load", CHARGE_ADAPTERS, accepted_sql(CHARGE_SQL, f"""
    ky AS external_charge_id, customer_id, {vc('unit_id')} AS unit_id, charge_type_id, {cents('DCAMT')} AS amount_in_cents,
    {ts(f'COALESCE(started, created, {NOW_SQL})')} AS effective_date,
    CASE WHEN trim(SCHGDESC) NOT IN ('', 'nan') THEN trim(SCHGDESC) END AS memo, {ts(f'COALESCE(created, {NOW_SQL})')} AS created_at,
    {ts(f'COALESCE(updated, {NOW_SQL})')} AS updated_at, {big('EMPLOYEEID')} AS external_employee_id, 'POSTED' AS status"""),
    as_text=("unit_id",))
def charges_load(t: Tables) -> DataFrame:
    return charges(t).accepted.select(
        "external_charge_id", "customer_id", "unit_id", "charge_type_id", "amount_in_cents", "effective_date", "memo",
        "created_at", "updated_at", "external_employee_id", "status",
    )


@check("charges_counters", CHARGE_ADAPTERS, counters_sql(CHARGE_SQL, {"bad_ids": "error", **TOO_LARGE}))
def charges_counters(t: Tables) -> DataFrame:
    return charges(t).counters


@check("charges_rejects", CHARGE_ADAPTERS, rejects_sql(CHARGE_SQL, "CHARGEID"))
def charges_rejects(t: Tables) -> DataFrame:
    return charges(t).rejects.select("row_id", "reason")


_CHARGE_DATES = {"effective_date": "DCHGSTRT", "created_at": "DCREATED", "updated_at": "DUPDATED"}


@check("charge_field_errors", CHARGE_ADAPTERS, " UNION ALL ".join(
    f"""SELECT CHARGEID AS row_id, '{field}' AS field, {cell} AS value FROM x_charges
        WHERE trim(CHARGEID) <> '' AND trim({cell}) <> '' AND {free_at(cell)} IS NULL""" for field, cell in _CHARGE_DATES.items()))
def charge_field_errors(t: Tables) -> DataFrame:
    return charges(t).field_errors.select("row_id", "field", "value")


# -- credits ------------------------------------------------------------------

CREDIT_ADAPTERS = ("x_credits", "x_tenants", "t_customers", "t_units", "t_charges_loaded")


def credits(t: Tables) -> Outcome:
    return load_credits(
        t("x_credits"), t("x_tenants"), t("t_customers"), t("t_units"), t("t_charges_loaded"), PARAMS
    )


def _after_1900(x: str) -> str:
    return f"CASE WHEN CAST({free_at(x)} AS DATE) > DATE '1900-01-01' THEN {free_at(x)} END"


CREDIT_SQL = f"""{LEDGERS}, {CUSTOMERS}, {UNITS},
    p AS (SELECT x.*, {big('LEDGERID')} AS ledger, {idt('CREDITID')} AS ky, {_after_1900('DCREDIT')} AS credited,
                 {_after_1900('DCREATED')} AS created,
                 CASE lower(trim(SMEMO)) WHEN 'waived current late fee 1.' THEN 10000 WHEN 'waived current late fee 2.' THEN 10001
                      WHEN 'reservation fee' THEN 10002 END AS kind FROM x_credits x),
    c AS (SELECT p.*, customers.customer_id, units.unit_id,
        CASE WHEN COALESCE({num('DCCREDITAMT')}, 0) <= 0 THEN 'amount_not_positive'
             WHEN {too_large('DCCREDITAMT')} THEN 'amount_out_of_range'
             WHEN lower(trim(BNONPOSTING)) = 'true' THEN 'non_posting' WHEN NOT {empty('DDELETED')} THEN 'deleted'
             WHEN {empty('LEDGERID')} THEN 'no_ledger' END AS b,
        CASE WHEN ky IN (SELECT external_charge_id FROM t_charges_loaded) THEN 'duplicate' END AS k,
        CASE WHEN kind IS NULL THEN 'no_memo_mapping' WHEN ledger IS NULL THEN 'bad_ledger'
             WHEN customers.customer_id IS NULL THEN 'no_customer' END AS a
        FROM p LEFT JOIN ledgers ON ledger = ledgers.ledger_id
        LEFT JOIN customers ON ledgers.tenant_id = customers.tenant_id LEFT JOIN units ON ledgers.unit_name = units.unit_name)"""


@check("credits_as_negative_charges", CREDIT_ADAPTERS, accepted_sql(CREDIT_SQL, f"""
    ky AS external_charge_id, customer_id, {vc('unit_id')} AS unit_id, CAST(kind AS BIGINT) AS charge_type_id,
    0 - abs({cents('DCCREDITAMT')}) AS amount_in_cents, {ts(f'COALESCE(credited, {NOW_SQL})')} AS effective_date,
    trim(SMEMO) AS memo, {ts(f'COALESCE(created, credited, {NOW_SQL})')} AS created_at"""), as_text=("unit_id",))
def credits_load(t: Tables) -> DataFrame:
    return credits(t).accepted.select(
        "external_charge_id", "customer_id", "unit_id", "charge_type_id", "amount_in_cents", "effective_date", "memo",
        "created_at",
    )


@check("credits_counters", CREDIT_ADAPTERS, counters_sql(CREDIT_SQL, {"bad_ledger": "error", **TOO_LARGE}))
def credits_counters(t: Tables) -> DataFrame:
    return credits(t).counters


@check("credits_rejects", CREDIT_ADAPTERS, rejects_sql(CREDIT_SQL, "CREDITID"))
def credits_rejects(t: Tables) -> DataFrame:
    return credits(t).rejects.select("row_id", "reason")


@check("credit_key_collisions", ("x_credits", "t_charges_loaded"), f"""
    SELECT CAST(count(DISTINCT {idt('CREDITID')}) AS BIGINT) AS key_collision FROM x_credits
    WHERE {idt('CREDITID')} IN (SELECT external_charge_id FROM t_charges_loaded WHERE amount_in_cents >= 0)""")
def credit_key_collisions(t: Tables) -> DataFrame:
    return key_collisions(t("x_credits"), t("t_charges_loaded"))


# -- receipts -----------------------------------------------------------------

RECEIPT_ADAPTERS = ("x_receipts", "t_payments", "t_methods", "t_customers", "t_receipts")


def receipts(t: Tables) -> Outcome:
    return load_receipts(
        t("x_receipts"), t("t_payments"), t("t_methods"), t("t_customers"), t("t_receipts"), PARAMS
    )


RECEIPT_SQL = f"""{CUSTOMERS},
    stored_payments AS (SELECT external_payment_id, max(q.id) AS payment_id, arg_max(payment_date, q.id) AS payment_date,
                               arg_max(COALESCE(m.name, ''), q.id) AS method
                        FROM t_payments q LEFT JOIN t_methods m ON q.payment_method_type_id = m.id GROUP BY 1),
    p AS (SELECT x.*, {big('PAYMENTID')} AS payment, {big('TENANTID')} AS tenant, {free_at('DRCPT')} AS received,
                 'SL-' || trim(IRECEIPTNUM) || '-' || CAST({big('PAYMENTID')} AS VARCHAR) AS ky FROM x_receipts x),
    c AS (SELECT p.*, customers.customer_id, s.payment_id, s.payment_date, NULLIF(s.method, '') AS method,
        CASE WHEN payment IS NULL OR tenant IS NULL THEN 'bad_ids' WHEN COALESCE({num('DCAMT')}, 0) = 0 THEN 'zero_amount'
             WHEN {too_large('DCAMT')} THEN 'amount_out_of_range' WHEN ky IS NULL THEN 'no_receipt_number' END AS b,
        CASE WHEN ky IN (SELECT receipt_number FROM t_receipts) THEN 'duplicate' END AS k,
        CASE WHEN s.payment_id IS NULL THEN 'no_payment' WHEN customers.customer_id IS NULL THEN 'no_customer' END AS a
        FROM p LEFT JOIN stored_payments s ON CAST(payment AS VARCHAR) = s.external_payment_id
        LEFT JOIN customers ON tenant = customers.tenant_id)"""


@check("receipts_load", RECEIPT_ADAPTERS, accepted_sql(RECEIPT_SQL, f"""
    ky AS receipt_number, payment_id, customer_id, {ts(f'COALESCE(received, {NOW_SQL})')} AS receipt_date, {ts('payment_date')} AS payment_date,
    greatest(0, {cents('DCAMT')}) AS amount_in_cents, method AS payment_method, CAST(9 AS BIGINT) AS generated_by_user_id"""))
def receipts_load(t: Tables) -> DataFrame:
    return receipts(t).accepted.select(
        "receipt_number", "payment_id", "customer_id", "receipt_date", "payment_date", "amount_in_cents",
        "payment_method", "generated_by_user_id",
    )


@check("receipts_counters", RECEIPT_ADAPTERS, counters_sql(RECEIPT_SQL, {"bad_ids": "error", **TOO_LARGE}))
def receipts_counters(t: Tables) -> DataFrame:
    return receipts(t).counters


# -- invoices -----------------------------------------------------------------

INVOICE_ADAPTERS = ("x_invoices", "x_payments", "t_charges", "t_invoices")


def some_stored(t: Tables) -> DataFrame:
    """Invoices loaded before: those of a small total."""
    return t("t_invoices").filter("total_in_cents BETWEEN 1 AND 9000000")


def invoices(t: Tables) -> Outcome:
    return load_invoices(t("x_invoices"), t("t_charges"), t("x_payments"), some_stored(t), PARAMS)


PAID_SQL = f"""paid AS (SELECT {idt('CHARGEID')} AS charge_key, CAST(sum({cents('DCPMTAMT')}) AS BIGINT) AS paid
    FROM x_payments WHERE CAST({free_at('DPMT')} AS DATE) <= {TODAY_SQL} AND {cents('DCPMTAMT')} IS NOT NULL GROUP BY 1)"""
GROUPS_SQL = f"""{PAID_SQL},
    ch AS (SELECT external_charge_id, arg_max(COALESCE(customer_id, -1), id) AS customer_id,
                  arg_max(charge_type_id, id) AS charge_type_id, arg_max(amount_in_cents, id) AS amount FROM t_charges GROUP BY 1),
    d AS (SELECT x.*, {idt('INVOICEID')} AS inv, {idt('CHARGEID')} AS charge_key,
                 row_number() OVER (PARTITION BY {idt('INVOICEID')} ORDER BY _o1, _o2, _o3) AS pos FROM x_invoices x),
    m AS (SELECT d.*, ch.external_charge_id IS NOT NULL AS has_charge, NULLIF(ch.customer_id, -1) AS customer_id, ch.charge_type_id, ch.amount, paid.paid FROM d
          LEFT JOIN ch ON d.charge_key = ch.external_charge_id LEFT JOIN paid ON d.charge_key = paid.charge_key),
    g AS (SELECT inv, max(CASE WHEN pos = 1 THEN {idt('IINVOICENUM')} END) AS invoice_number,
                 max(CASE WHEN pos = 1 THEN CAST({free_at('DINVOICED')} AS DATE) END) AS issue_date,
                 max(CASE WHEN pos = 1 THEN CAST({free_at('DDUE')} AS DATE) END) AS due_date,
                 max(CASE WHEN pos = 1 THEN {big('EMPLOYEEID')} END) AS external_employee_id,
                 min(CASE WHEN has_charge THEN pos END) AS owner_pos, count(charge_key) AS n_charges,
                 CAST(COALESCE(sum(amount), 0) AS BIGINT) AS total, CAST(COALESCE(sum(paid), 0) AS BIGINT) AS paid
          FROM m GROUP BY inv),
    gc AS (SELECT g.*, m.customer_id, m.charge_type_id FROM g LEFT JOIN m ON g.inv = m.inv AND g.owner_pos = m.pos)"""
INVOICE_SQL = f"""{GROUPS_SQL},
    c AS (SELECT gc.*, inv AS ky, 0 AS _o1, 0 AS _o2, 0 AS _o3, CAST(NULL AS VARCHAR) AS b,
        CASE WHEN inv IN (SELECT external_invoice_id FROM t_invoices WHERE total_in_cents BETWEEN 1 AND 9000000) THEN 'duplicate' END AS k,
        CASE WHEN invoice_number IS NULL THEN 'no_invoice_number' WHEN issue_date IS NULL THEN 'no_issue_date'
             WHEN due_date IS NULL THEN 'no_due_date' WHEN n_charges = 0 THEN 'no_charges'
             WHEN customer_id IS NULL THEN 'no_customer' WHEN total <= 0 THEN 'total_not_positive' END AS a FROM gc)"""
_INVOICE_COLUMNS = f"""
    inv AS external_invoice_id, invoice_number, customer_id,
    CASE charge_type_id WHEN 3 THEN 1 WHEN 1 THEN 2 WHEN 21 THEN 3 WHEN 13 THEN 4 ELSE 7 END AS invoice_type_id,
    CASE WHEN paid <= 0 THEN 'UNPAID' WHEN paid < total THEN 'PARTIAL_PAID' ELSE 'PAID' END AS status,
    {day('issue_date')} AS issue_date, {day('due_date')} AS due_date, total AS total_in_cents, paid AS amount_paid_in_cents,
    greatest(total - paid, 0) AS balance_in_cents, external_employee_id"""


@check("invoice_build", INVOICE_ADAPTERS, accepted_sql(INVOICE_SQL, _INVOICE_COLUMNS))
def invoice_build(t: Tables) -> DataFrame:
    return invoices(t).accepted.select(
        "external_invoice_id", "invoice_number", "customer_id", "invoice_type_id", "status", "issue_date", "due_date",
        "total_in_cents", "amount_paid_in_cents", "balance_in_cents", "external_employee_id",
    )


@check("invoice_counters", INVOICE_ADAPTERS, counters_sql(INVOICE_SQL, {}))
def invoice_counters(t: Tables) -> DataFrame:
    return invoices(t).counters


@check("invoice_detail_groups", INVOICE_ADAPTERS, f"""WITH {GROUPS_SQL}
    SELECT inv AS external_invoice_id, invoice_number, {vc('customer_id')} AS customer_id, {vc('charge_type_id')} AS charge_type_id,
           CAST(n_charges AS BIGINT) AS n_charges, total AS total_in_cents, paid AS amount_paid_in_cents FROM gc""",
    as_text=("customer_id", "charge_type_id"))
def invoice_detail_groups(t: Tables) -> DataFrame:
    return invoice_groups(t("x_invoices"), t("t_charges"), t("x_payments"), PARAMS).select(
        "external_invoice_id", "invoice_number", "customer_id", "charge_type_id", "n_charges", "total_in_cents",
        "amount_paid_in_cents",
    )


@check("paid_per_charge", ("x_payments",), f"WITH {PAID_SQL} SELECT charge_key, paid AS paid_in_cents FROM paid")
def paid_per_charge_query(t: Tables) -> DataFrame:
    return paid_per_charge(t("x_payments"), PARAMS)


@check("invoice_distinct_counts", ("x_invoices",), f"""
    SELECT CAST(count(*) AS BIGINT) AS n_details, CAST(count(DISTINCT {idt('INVOICEID')}) AS BIGINT) AS n_invoices
    FROM x_invoices""")
def invoice_distinct_counts(t: Tables) -> DataFrame:
    return distinct_invoices(t("x_invoices"))


_PAIRS_SQL = f"""pairs AS (SELECT DISTINCT {idt('INVOICEID')} AS inv, {idt('PAYMENTID')} AS pay FROM x_invoices
        WHERE PAYMENTID IS NOT NULL AND {idt('INVOICEID')} IN (SELECT ky FROM c WHERE k IS NULL AND a IS NULL))"""


@check("invoice_payment_pairs", INVOICE_ADAPTERS, f"""WITH {INVOICE_SQL}, {_PAIRS_SQL}
    SELECT inv AS external_invoice_id, pay AS external_payment_id FROM pairs""")
def invoice_payment_pairs(t: Tables) -> DataFrame:
    return payment_pairs(t("x_invoices"), invoices(t).accepted)


@check("payment_invoice_link", ("x_invoices", "t_payments", "t_invoices"), f"""
    WITH links AS (SELECT {idt('x.PAYMENTID')} AS pay, max(i.id) AS linked FROM x_invoices x
                   JOIN t_invoices i ON {idt('x.INVOICEID')} = i.external_invoice_id WHERE x.PAYMENTID IS NOT NULL GROUP BY 1)
    SELECT p.id, {vc('COALESCE(links.linked, p.invoice_id)')} AS invoice_id FROM t_payments p
    LEFT JOIN links ON p.external_payment_id = links.pay""", as_text=("invoice_id",))
def payment_invoice_link(t: Tables) -> DataFrame:
    pairs = payment_pairs(t("x_invoices"), t("t_invoices"))
    return link_payments(t("t_payments"), pairs, t("t_invoices")).select("id", "invoice_id")


@check("payment_invoice_link_open_only", ("x_invoices", "t_payments", "t_invoices"), f"""
    WITH links AS (SELECT {idt('x.PAYMENTID')} AS pay, max(i.id) AS linked FROM x_invoices x
                   JOIN t_invoices i ON {idt('x.INVOICEID')} = i.external_invoice_id WHERE x.PAYMENTID IS NOT NULL GROUP BY 1)
    SELECT p.id, {vc('COALESCE(p.invoice_id, links.linked)')} AS invoice_id FROM t_payments p
    LEFT JOIN links ON p.external_payment_id = links.pay""", as_text=("invoice_id",))
def payment_invoice_link_open_only(t: Tables) -> DataFrame:
    pairs = payment_pairs(t("x_invoices"), t("t_invoices"))
    return link_payments(t("t_payments"), pairs, t("t_invoices"), only_unlinked=True).select("id", "invoice_id")


@check("invoice_surrogate_ids", INVOICE_ADAPTERS, f"""WITH {INVOICE_SQL}
    SELECT ky AS external_invoice_id, (SELECT max(id) FROM t_invoices) + row_number() OVER (ORDER BY ky) AS id
    FROM c WHERE k IS NULL AND a IS NULL""")
def invoice_surrogate_ids(t: Tables) -> DataFrame:
    new = invoices(t).accepted.select("external_invoice_id")
    return assign_ids(new, t("t_invoices"), "external_invoice_id")


# -- stored invoices ------------------------------------------------------------


def _recalculated_sql(later: str, past: str) -> str:
    return f"""totals AS (SELECT invoice_id, CAST(sum(amount_in_cents) AS BIGINT) AS paid FROM t_payments
                      WHERE invoice_id IS NOT NULL GROUP BY 1),
    r AS (SELECT i.id, total_in_cents AS total, COALESCE(paid, 0) AS paid, due_date FROM t_invoices i
          LEFT JOIN totals ON i.id = totals.invoice_id),
    s AS (SELECT *, CASE WHEN paid >= total AND total > 0 THEN 'PAID' WHEN paid > 0 THEN 'PARTIAL_PAID'
                         WHEN due_date > {TODAY_SQL} THEN '{later}' ELSE '{past}' END AS status FROM r)"""


@check("invoice_status_recalc", ("t_invoices", "t_payments"), f"""WITH {_recalculated_sql('UNPAID', 'OVERDUE')}
    SELECT id, paid AS amount_paid_in_cents, greatest(total - paid, 0) AS balance_in_cents, status,
           '2002-03-04 05:06:07' AS updated_at FROM s""")
def invoice_status_recalc(t: Tables) -> DataFrame:
    return recalculate_invoices(t("t_invoices"), t("t_payments"), PARAMS).select(
        "id", "amount_paid_in_cents", "balance_in_cents", "status", "updated_at"
    )


_SHARE = """SELECT status, CAST(count(*) AS BIGINT) AS n_invoices,
    CAST(floor(count(*) * 10000 / (SELECT count(*) FROM s)) AS BIGINT) AS share_bp FROM s GROUP BY status"""


@check("invoice_status_distribution", ("t_invoices", "t_payments"),
       f"WITH {_recalculated_sql('UNPAID', 'OVERDUE')} {_SHARE}")
def invoice_status_distribution(t: Tables) -> DataFrame:
    return status_distribution(recalculate_invoices(t("t_invoices"), t("t_payments"), PARAMS))


@check("invoice_status_preview", ("t_invoices", "t_payments"), f"WITH {_recalculated_sql('OVERDUE', 'UNPAID')} {_SHARE}")
def invoice_status_preview(t: Tables) -> DataFrame:
    return status_distribution(recalculate_invoices(t("t_invoices"), t("t_payments"), PARAMS, legacy_preview=True))


@check("paid_per_invoice", ("t_payments",), """
    SELECT invoice_id, CAST(sum(amount_in_cents) AS BIGINT) AS paid_in_cents FROM t_payments
    WHERE invoice_id IS NOT NULL GROUP BY 1""")
def paid_per_invoice_query(t: Tables) -> DataFrame:
    from leaseload.operators.reconcile import paid_per_invoice

    return paid_per_invoice(t("t_payments"))
