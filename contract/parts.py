"""Lookups, winners, loads, contracts, extracts, run history and ownership with their oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.registry import CUSTOMERS, LEDGERS, UNITS, Tables, big, check, empty, idt, num, vc
from leaseload.functions.numbers import number, whole_number
from leaseload.functions.text import is_empty
from leaseload.operators.keys import attach, first_rows, known_flag, last_wins, only_known, without_known
from leaseload.operators.load import insert_new, new_rows
from leaseload.operators.reconcile import backfill_created_by, backfill_tables, preview_tables
from leaseload.plans.cards import with_profile_key
from leaseload.plans.charges import charge_type_lookup
from leaseload.plans.common import ledger_customers, ledger_tenants, unresolved_tenants
from leaseload.plans.payments import credited_payments
from leaseload.plans.receipts import payment_lookup
from leaseload.sources import legacy
from leaseload.sources.contracts import UNIT_KEYS, check_constraints, check_target, validation_report
from leaseload.sources.exports import READ_OPTIONS, drop_blank_key, drop_empty_rows, fill_blank, na_to_null, trim_cells
from leaseload.sources.runs import newest_runs, parse_runs, record_run, run_statistics, with_duration
from leaseload.sources.tables import customers_by_number, units_by_name

# -- scans and contracts ----------------------------------------------------------


@check("export_lines_parsed", ("x_charges",), """
    SELECT _o1 AS line, _o2 AS supplier, NULLIF(CHARGEID, '') AS id, 'say "' || COALESCE(SCHGDESC, 'none') || '", ok' AS memo,
           NULLIF(DCREATED, '') AS created FROM x_charges""")
def export_lines_parsed(t: Tables) -> DataFrame:
    """Lines as an export holds them, every cell quoted, through the reader's own options."""
    memo = F.concat(F.lit('say "'), F.coalesce("SCHGDESC", F.lit("none")), F.lit('", ok'))
    cells = [F.coalesce("CHARGEID", F.lit("")), memo, F.coalesce("DCREATED", F.lit(""))]
    quoted = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in cells]
    options = {name: READ_OPTIONS[name] for name in ("quote", "escape")}
    parsed = F.from_csv(F.concat_ws(",", *quoted), "id STRING, memo STRING, created STRING", options)
    rows = t("x_charges").select(F.col("_row_ord._o1").alias("line"), F.col("_row_ord._o2").alias("supplier"), parsed.alias("p"))
    return rows.select("line", "supplier", "p.*")


@check("export_cells_cleaned", ("x_former",), """
    SELECT _o1 AS ledger, COALESCE(trim(CASE WHEN LASTNAME NOT IN ('', 'nan', 'NaN', 'NULL', 'NA') THEN LASTNAME END), '') AS last_name,
           COALESCE(trim(EMAIL), '') AS email, COALESCE(trim(TENANTID), '') AS tenant FROM x_former""")
def export_cells_cleaned(t: Tables) -> DataFrame:
    cleaned = fill_blank(trim_cells(na_to_null(t("x_former"))))
    return cleaned.select(
        F.col("_row_ord").alias("ledger"), F.col("LASTNAME").alias("last_name"), F.col("EMAIL").alias("email"),
        F.col("TENANTID").alias("tenant"),
    )


@check("export_empty_and_footer_rows", ("x_charges",), f"""
    SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE SCHGDESC IS NOT NULL OR DDELETED IS NOT NULL) AS BIGINT) AS n_filled,
           CAST(count(*) FILTER (WHERE NOT {empty('CHARGEID')}) AS BIGINT) AS n_keyed FROM x_charges""")
def export_empty_and_footer_rows(t: Tables) -> DataFrame:
    rows = t("x_charges")
    filled = drop_empty_rows(rows.select("SCHGDESC", "DDELETED")).agg(F.count(F.lit(1)).alias("n"))
    keyed = drop_blank_key(rows, "CHARGEID").agg(F.count(F.lit(1)).alias("n"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", filled.scalar().alias("n_filled"), keyed.scalar().alias("n_keyed")
    )


_KEY_ROWS = ", ".join(f"('{k}')" for k in UNIT_KEYS)


@check("validation_report", ("x_units",), f"""
    SELECT 'required' AS role, k AS key, CASE WHEN k = 'POWER (YES' THEN 'POWER (YES/NO)' ELSE k END AS "column",
           (SELECT CAST(count(*) AS BIGINT) FROM x_units) AS rows_total, CAST(0 AS BIGINT) AS rows_empty FROM (VALUES {_KEY_ROWS}) AS v(k)""")
def validation_report_query(t: Tables) -> DataFrame:
    return validation_report(t("x_units"), UNIT_KEYS)


@check("target_key_repeats", ("t_payments",), """
    SELECT external_payment_id, CAST(count(*) AS BIGINT) AS rows_per_key FROM t_payments GROUP BY 1 HAVING count(*) > 1""")
def target_key_repeats(t: Tables) -> DataFrame:
    return check_target(t("t_payments"), ("id", "external_payment_id"), ("external_payment_id",))


@check("target_constraints", ("t_charges",), """
    SELECT id, 'amount_not_negative' AS "constraint" FROM t_charges WHERE amount_in_cents < 0
    UNION ALL SELECT id, 'type_known' FROM t_charges WHERE charge_type_id NOT IN (1, 3, 13, 21)""")
def target_constraints(t: Tables) -> DataFrame:
    rules = {
        "amount_not_negative": F.col("amount_in_cents") >= 0,
        "type_known": F.col("charge_type_id").isin(1, 3, 13, 21),
    }
    return check_constraints(t("t_charges"), rules, ("id",))


@check("credit_filters", ("x_credits",), f"""
    SELECT CAST(count(*) FILTER (WHERE {num('DCCREDITAMT')} > 0) AS BIGINT) AS positive,
           CAST(count(*) FILTER (WHERE COALESCE({num('DCCREDITAMT')}, 0) <> 0) AS BIGINT) AS not_zero,
           CAST(count(*) FILTER (WHERE {empty('DDELETED')}) AS BIGINT) AS alive,
           CAST(count(*) FILTER (WHERE COALESCE(lower(trim(BNONPOSTING)), '') <> 'true') AS BIGINT) AS posting FROM x_credits""")
def credit_filters(t: Tables) -> DataFrame:
    amount = number("DCCREDITAMT")
    return t("x_credits").agg(
        F.count_if(amount > 0).alias("positive"), F.count_if(F.coalesce(amount, F.lit(0.0)) != 0).alias("not_zero"),
        F.count_if(is_empty("DDELETED")).alias("alive"),
        F.count_if(F.coalesce(F.lower(F.trim("BNONPOSTING")), F.lit("")) != "true").alias("posting"),
    )


# -- lookups ----------------------------------------------------------------------


@check("lookup_ledger_tenant", ("x_tenants",), f"WITH {LEDGERS} SELECT ledger_id, tenant_id, NULLIF(unit_name, '') AS unit_name FROM ledgers")
def lookup_ledger_tenant(t: Tables) -> DataFrame:
    return ledger_tenants(t("x_tenants"))


@check("lookup_customer_by_number", ("t_customers",), f"WITH {CUSTOMERS} SELECT tenant_id, customer_id FROM customers")
def lookup_customer_by_number(t: Tables) -> DataFrame:
    return customers_by_number(t("t_customers"))


@check("lookup_ledger_customer_unit", ("x_tenants", "t_customers", "t_units"), f"""WITH {LEDGERS}, {CUSTOMERS}, {UNITS}
    SELECT ledger_id, {vc('customer_id')} AS customer_id, {vc('unit_id')} AS unit_id FROM ledgers
    LEFT JOIN customers ON ledgers.tenant_id = customers.tenant_id LEFT JOIN units ON ledgers.unit_name = units.unit_name""",
    as_text=("customer_id", "unit_id"))
def lookup_ledger_customer_unit(t: Tables) -> DataFrame:
    return ledger_customers(t("x_tenants"), t("t_customers"), t("t_units"))


@check("unresolved_tenants", ("x_tenants", "t_customers"), f"""WITH {LEDGERS}, {CUSTOMERS}
    SELECT tenant_id, CAST(count(*) AS BIGINT) AS n_ledgers FROM ledgers
    WHERE tenant_id NOT IN (SELECT tenant_id FROM customers) GROUP BY 1""")
def unresolved_tenants_query(t: Tables) -> DataFrame:
    return unresolved_tenants(t("x_tenants"), t("t_customers"))


@check("lookup_charge_type", ("x_charge_types",), f"""
    SELECT {big('CHARGEDESCID')} AS desc_id, {big('ID')} AS charge_type_id FROM x_charge_types WHERE ID IS NOT NULL""")
def lookup_charge_type(t: Tables) -> DataFrame:
    return charge_type_lookup(t("x_charge_types"))


@check("lookup_unit_nullable", ("x_tenants", "t_units"), f"""WITH {UNITS}
    SELECT LEDGERID AS ledger, _o2 AS n, {vc('unit_id')} AS unit_id FROM x_tenants LEFT JOIN units ON trim(SUNITNAME) = unit_name""",
    as_text=("unit_id",))
def lookup_unit_nullable(t: Tables) -> DataFrame:
    rows = t("x_tenants").withColumn("_unit", F.trim("SUNITNAME"))
    return attach(rows, units_by_name(t("t_units")), [("_unit", "unit_name")]).select(
        F.col("LEDGERID").alias("ledger"), F.col("_row_ord._o2").alias("n"), "unit_id"
    )


@check("lookup_payment_details", ("t_payments", "t_methods"), """
    SELECT external_payment_id, payment_id, strftime(payment_date, '%Y-%m-%d %H:%M:%S') AS payment_date, name AS payment_method FROM (
        SELECT external_payment_id, id AS payment_id, payment_date, payment_method_type_id,
               row_number() OVER (PARTITION BY external_payment_id ORDER BY id DESC) AS rn FROM t_payments) LEFT JOIN t_methods m
    ON payment_method_type_id = m.id WHERE rn = 1""")
def lookup_payment_details(t: Tables) -> DataFrame:
    return payment_lookup(t("t_payments"), t("t_methods"))


@check("profile_lookup_null_safe", ("s_profiles",), """
    WITH k AS (SELECT customer_id, card_last4, card_exp_month, card_exp_year, max(id) AS profile_id FROM s_profiles GROUP BY ALL)
    SELECT p.id, k.profile_id FROM s_profiles p JOIN k ON p.customer_id = k.customer_id AND p.card_last4 = k.card_last4
        AND p.card_exp_month IS NOT DISTINCT FROM k.card_exp_month AND p.card_exp_year IS NOT DISTINCT FROM k.card_exp_year""")
def profile_lookup_null_safe(t: Tables) -> DataFrame:
    profiles = with_profile_key(t("s_profiles"))
    newest = last_wins(profiles.select("profile_key", F.col("id").alias("profile_id")), ["profile_key"], ["profile_id"], F.col("profile_id"))
    return attach(profiles, newest, [("profile_key", "profile_key")]).select("id", "profile_id")


# -- semi and anti joins ------------------------------------------------------------


@check("payments_not_credits", ("x_payments", "x_credits"), f"""
    SELECT _o1 AS line, _o2 AS supplier FROM x_payments WHERE PAYMENTID IS NULL OR {idt('PAYMENTID')} NOT IN
        (SELECT {idt('PAYMENTID')} FROM x_credits WHERE PAYMENTID IS NOT NULL)""")
def payments_not_credits(t: Tables) -> DataFrame:
    from leaseload.functions.numbers import id_text

    rows = t("x_payments").withColumn("_payment", id_text("PAYMENTID"))
    return without_known(rows, credited_payments(t("x_credits")), [("_payment", "credited_id")]).select(
        F.col("_row_ord._o1").alias("line"), F.col("_row_ord._o2").alias("supplier")
    )


@check("existing_key_flag", ("t_charges", "t_charges_loaded"), """
    SELECT external_charge_id IN (SELECT external_charge_id FROM t_charges_loaded) AS stored, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(sum(amount_in_cents) AS BIGINT) AS cents FROM t_charges GROUP BY 1""")
def existing_key_flag(t: Tables) -> DataFrame:
    flagged = known_flag(t("t_charges"), t("t_charges_loaded"), [("external_charge_id", "external_charge_id")], "stored")
    return flagged.groupBy("stored").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("amount_in_cents").alias("cents"))


@check("composite_key_anti_join", ("s_leases", "t_links"), """
    SELECT id FROM s_leases l WHERE NOT EXISTS (SELECT 1 FROM t_links k WHERE k.customer_id = l.customer_id AND k.unit_id = l.unit_id
        AND k.lease_date = l.move_in_date AND k.move_out_date IS NOT NULL AND l.move_out_date =
            CASE WHEN k.unit_id % 3 = 0 THEN CAST(k.move_out_date + INTERVAL 1 DAY AS DATE) ELSE k.move_out_date END)""")
def composite_key_anti_join(t: Tables) -> DataFrame:
    # A third of the links match a lease in all columns of the key but the last.
    later = F.when(F.col("unit_id") % 3 == 0, F.date_add("move_out_date", 1)).otherwise(F.col("move_out_date"))
    ended = t("t_links").filter("move_out_date IS NOT NULL").withColumn("move_out_date", later)
    on = [("customer_id", "customer_id"), ("unit_id", "unit_id"), ("move_in_date", "lease_date"), ("move_out_date", "move_out_date")]
    return without_known(t("s_leases"), ended, on, null_safe=True).select("id")


@check("occupied_units", ("t_units", "s_leases"), """
    SELECT unit_number FROM t_units WHERE id IN (SELECT unit_id FROM s_leases WHERE status = 'ACTIVE')""")
def occupied_units(t: Tables) -> DataFrame:
    return only_known(t("t_units"), t("s_leases").filter("status = 'ACTIVE'"), [("id", "unit_id")]).select("unit_number")


# -- winners and loads --------------------------------------------------------------


@check("first_wins_per_key", ("x_payments",), f"""
    SELECT PAYMENTID AS payment, CHARGEID AS charge FROM (SELECT PAYMENTID, CHARGEID,
        row_number() OVER (PARTITION BY PAYMENTID ORDER BY _o1, _o2, _o3) AS rn FROM x_payments WHERE PAYMENTID IS NOT NULL) WHERE rn = 1""")
def first_wins_per_key(t: Tables) -> DataFrame:
    return first_rows(t("x_payments"), ["PAYMENTID"], ["_row_ord"]).select(
        F.col("PAYMENTID").alias("payment"), F.col("CHARGEID").alias("charge")
    )


@check("last_wins_per_key", ("x_payments",), """
    SELECT PAYMENTID AS payment, CHARGEID AS charge, LEDGERID AS ledger FROM (SELECT PAYMENTID, CHARGEID, LEDGERID,
        row_number() OVER (PARTITION BY PAYMENTID ORDER BY _o1 DESC, _o2 DESC, _o3 DESC) AS rn FROM x_payments WHERE PAYMENTID IS NOT NULL) WHERE rn = 1""")
def last_wins_per_key(t: Tables) -> DataFrame:
    return last_wins(t("x_payments"), ["PAYMENTID"], ["CHARGEID", "LEDGERID"], F.col("_row_ord")).select(
        F.col("PAYMENTID").alias("payment"), F.col("CHARGEID").alias("charge"), F.col("LEDGERID").alias("ledger")
    )


@check("insert_skip_existing", ("t_payments", "t_payments_loaded"), """
    SELECT external_id, CAST(count(*) AS BIGINT) AS n FROM (
        SELECT external_id FROM t_payments_loaded UNION ALL
        SELECT DISTINCT external_payment_id FROM t_payments WHERE external_payment_id NOT IN (SELECT external_id FROM t_payments_loaded)) GROUP BY 1""")
def insert_skip_existing(t: Tables) -> DataFrame:
    source = t("t_payments").select(F.col("external_payment_id").alias("external_id"), "id")
    snapshot = insert_new(t("t_payments_loaded"), source, ["external_id"], order="id")
    return snapshot.groupBy("external_id").agg(F.count(F.lit(1)).alias("n"))


@check("insert_null_keys_never_conflict", ("t_payments", "t_invoices"), """
    SELECT count(*) FILTER (WHERE invoice_id IS NULL) AS null_keys, count(*) FILTER (WHERE invoice_id IS NOT NULL) AS keyed FROM (
        SELECT invoice_id FROM t_payments WHERE invoice_id IS NULL
        UNION ALL SELECT DISTINCT invoice_id FROM t_payments WHERE invoice_id NOT IN (SELECT id FROM t_invoices WHERE total_in_cents > 20000000))""")
def insert_null_keys_never_conflict(t: Tables) -> DataFrame:
    target = t("t_invoices").filter("total_in_cents > 20000000").select(F.col("id").alias("invoice_id"))
    added = new_rows(target, t("t_payments"), ["invoice_id"], order="id")
    return added.agg(
        F.count_if(F.col("invoice_id").isNull()).alias("null_keys"), F.count("invoice_id").alias("keyed")
    )


@check("insert_conditional_key", ("s_leases",), """
    SELECT id FROM (SELECT id, status, unit_id, row_number() OVER (PARTITION BY status, unit_id ORDER BY id) AS rn FROM s_leases) r
    WHERE status <> 'ACTIVE' OR (rn = 1 AND NOT EXISTS (
        SELECT 1 FROM s_leases s WHERE s.id % 20 = 0 AND s.status = 'ACTIVE' AND s.unit_id = r.unit_id))""")
def insert_conditional_key(t: Tables) -> DataFrame:
    leases = t("s_leases")
    return new_rows(leases.filter("id % 20 = 0"), leases, ["unit_id"], order="id", key_filter=F.col("status") == "ACTIVE").select("id")


@check("preview_first_rows", ("x_tenancy",), "SELECT _o1 AS tenancy, SUNITNAME AS unit FROM x_tenancy ORDER BY _o1 LIMIT 5")
def preview_first_rows(t: Tables) -> DataFrame:
    rows = t("x_tenancy").select(F.col("_row_ord").alias("tenancy"), F.col("SUNITNAME").alias("unit"))
    return rows.orderBy("tenancy").limit(5)


# -- ownership ----------------------------------------------------------------------


@check("created_by_backfill", ("t_payments", "t_users"), f"""
    SELECT p.id, {vc('CASE WHEN p.external_employee_id IS NULL THEN p.created_by ELSE u.id END')} AS created_by
    FROM t_payments p LEFT JOIN t_users u ON p.external_employee_id = u.external_id""", as_text=("created_by",))
def created_by_backfill(t: Tables) -> DataFrame:
    return backfill_created_by(t("t_payments"), t("t_users")).select("id", "created_by")


_OWNED = {
    "customer": "t_customers", "rental_agreements": "x_tenancy", "billing_schedules": "x_tenancy", "payments": "t_payments",
    "ledger_charges": "x_charges", "invoices": "x_invoices",
}


def _employee(adapter: str) -> str:
    return "external_employee_id" if adapter.startswith("t_") else big("EMPLOYEEID")


def owned_tables(t: Tables) -> dict[str, DataFrame]:
    """The six owned tables, each with its employee id."""
    return {
        name: t(adapter) if adapter.startswith("t_")
        else t(adapter).select(whole_number("EMPLOYEEID").alias("external_employee_id"), F.lit(5).cast("bigint").alias("created_by"))
        for name, adapter in _OWNED.items()
    }


@check("created_by_preview", (*dict.fromkeys(_OWNED.values()), "t_users"), " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", CAST(count(*) AS BIGINT) AS n_rows FROM {adapter}
        WHERE {_employee(adapter)} IN (SELECT external_id FROM t_users WHERE external_id IS NOT NULL)""" for name, adapter in _OWNED.items()))
def created_by_preview(t: Tables) -> DataFrame:
    return preview_tables(owned_tables(t), t("t_users"))


@check("created_by_backfill_six_tables", (*dict.fromkeys(_OWNED.values()), "t_users"), " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", {vc(f'CASE WHEN {_employee(adapter)} IS NULL THEN 5 ELSE u.id END')} AS created_by, CAST(count(*) AS BIGINT) AS n_rows
        FROM {adapter} p LEFT JOIN t_users u ON {_employee(adapter).replace('external_employee_id', 'p.external_employee_id')} = u.external_id GROUP BY 1, 2"""
    for name, adapter in _OWNED.items()), as_text=("created_by",))
def created_by_backfill_six_tables(t: Tables) -> DataFrame:
    filled = backfill_tables(owned_tables(t), t("t_users"))
    counts = [
        df.groupBy("created_by").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "created_by", "n_rows")
        for name, df in filled.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@check("customer_created_by_backfill", ("t_customers", "t_users"), f"""
    SELECT p.id, {vc('CASE WHEN p.external_employee_id IS NULL THEN p.created_by ELSE u.id END')} AS created_by
    FROM t_customers p LEFT JOIN t_users u ON p.external_employee_id = u.external_id""", as_text=("created_by",))
def customer_created_by_backfill(t: Tables) -> DataFrame:
    return backfill_created_by(t("t_customers"), t("t_users")).select("id", "created_by")


# -- legacy extracts ------------------------------------------------------------------


@check("tenancy_extract", ("l_tenants", "l_units", "l_ledgers", "l_access"), """
    SELECT l.LedgerID AS ledger, t.TenantID AS tenant, u.sUnitName AS unit, a.sAccessCode AS code, t.sLName AS last_name
    FROM l_ledgers l JOIN l_units u ON u.UnitID = l.UnitID JOIN l_access a ON a.LedgerID = l.LedgerID
    JOIN l_tenants t ON t.TenantID = a.TenantID WHERE l.SiteID = 1""")
def tenancy_extract(t: Tables) -> DataFrame:
    rows = legacy.tenancy_extract(t("l_tenants"), t("l_units"), t("l_ledgers"), t("l_access"), 1)
    return rows.select(
        F.col("LedgerID").alias("ledger"), F.col("TenantID").alias("tenant"), F.col("sUnitName").alias("unit"),
        F.col("sAccessCode").alias("code"), F.col("sLName").alias("last_name"),
    )


@check("active_ledgers_per_tenant", ("l_access", "l_ledgers"), """
    SELECT a.TenantID AS tenant, CAST(count(l.LedgerID) AS BIGINT) AS rentals,
           CAST(sum(CASE WHEN l.dMovedOut IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS active FROM l_access a JOIN l_ledgers l ON l.LedgerID = a.LedgerID
    WHERE a.SiteID = 1 AND a.bPrimary = 1 AND l.dDeleted IS NULL GROUP BY 1""")
def active_ledgers_per_tenant(t: Tables) -> DataFrame:
    counts = legacy.active_ledgers(t("l_access"), t("l_ledgers"), 1)
    return counts.select(
        F.col("TenantID").alias("tenant"), F.col("TotalRentals").alias("rentals"), F.col("ActiveLedgers").alias("active")
    )


@check("former_tenants_extract", ("l_tenants", "l_units", "l_ledgers", "l_access", "l_sites"), f"""
    WITH primary_ledgers AS (
        SELECT access.TenantID AS tenant, access.sAccessCode AS code, ledger.UnitID AS unit_id, ledger.SiteID AS site,
               ledger.dMovedIn AS came, ledger.dMovedOut AS went, access.SiteID AS access_site
        FROM l_access access, l_ledgers ledger
        WHERE access.LedgerID = ledger.LedgerID AND access.bPrimary = 1 AND ledger.dDeleted IS NULL),
    still_open AS (
        SELECT tenant, count(*) FILTER (WHERE went IS NULL) AS n FROM primary_ledgers WHERE access_site = 1 GROUP BY tenant),
    ended AS (
        SELECT DISTINCT tenant, code, sUnitName AS unit, came, went FROM primary_ledgers, l_units
        WHERE went IS NOT NULL AND site = 1 AND l_units.UnitID = unit_id AND bPermanent = 0),
    people AS (SELECT TenantID AS tenant, sLName || ', ' || sFName AS name, min(sMobile) AS mobile FROM l_tenants GROUP BY 1, 2)
    SELECT tenant, (SELECT sLocationCode FROM l_sites WHERE SiteID = 1) AS location, unit, name, code,
           strftime(came, '%Y-%m-%d') AS moved_in, strftime(went, '%Y-%m-%d') AS moved_out,
           {vc('CAST(n AS BIGINT)')} AS active, mobile
    FROM ended JOIN people USING (tenant) LEFT JOIN still_open USING (tenant)""", as_text=("active",))
def former_tenants_extract(t: Tables) -> DataFrame:
    rows = legacy.former_tenants_extract(
        t("l_tenants"), t("l_units"), t("l_ledgers"), t("l_access"), t("l_sites"), 1
    )
    names = {
        "TenantID": "tenant", "LocationCode": "location", "UnitName": "unit", "Name": "name", "Gatecode": "code",
        "DateMovedIn": "moved_in", "DateMovedOut": "moved_out", "ActiveLedgers": "active", "Mobile": "mobile",
    }
    return rows.select(*[F.col(a).alias(b) for a, b in names.items()])


@check("credit_extract", ("l_credits", "l_memos"), """
    SELECT c.CreditID AS credit, c.cents, m.SMemo AS memo FROM l_credits c JOIN l_memos m ON c.MemoID = m.MemoID""")
def credit_extract(t: Tables) -> DataFrame:
    return legacy.credit_extract(t("l_credits"), t("l_memos")).select(
        F.col("CreditID").alias("credit"), "cents", F.col("SMemo").alias("memo")
    )


@check("invoice_extract", ("l_invoices", "l_details"), """
    SELECT i.InvoiceID AS invoice, i.kind, d.ChargeID AS charge, d.cents FROM l_invoices i JOIN l_details d ON i.InvoiceID = d.InvoiceID""")
def invoice_extract(t: Tables) -> DataFrame:
    return legacy.invoice_extract(t("l_invoices"), t("l_details")).select(
        F.col("InvoiceID").alias("invoice"), "kind", F.col("ChargeID").alias("charge"), "cents"
    )


@check("charge_and_payment_extract", ("t_charges", "t_payments"), """
    SELECT 'charges' AS "table", id, external_charge_id AS external_id FROM t_charges
    UNION ALL SELECT 'payments', id, external_payment_id FROM t_payments""")
def charge_and_payment_extract(t: Tables) -> DataFrame:
    charges = legacy.whole_table(t("t_charges")).select(
        F.lit("charges").alias("table"), "id", F.col("external_charge_id").alias("external_id")
    )
    payments = legacy.whole_table(t("t_payments")).select(
        F.lit("payments").alias("table"), "id", F.col("external_payment_id").alias("external_id")
    )
    return charges.unionByName(payments)


# -- run history --------------------------------------------------------------------

_RUNS = """runs AS (SELECT 'r' || CAST(event_id AS VARCHAR) AS run_id, event_type, ts,
    CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'view' THEN 'running' ELSE 'success' END AS status,
    value > 90 AS dry_run, user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS started_at FROM events)"""


@check("run_history_rows", ("x_run_texts",), f"""WITH {_RUNS}
    SELECT run_id, event_type AS migration_type, status, dry_run, CAST(user_id AS VARCHAR) || '.csv' AS first_file, '1440m 0s' AS duration FROM runs""")
def run_history_rows(t: Tables) -> DataFrame:
    runs = with_duration(parse_runs(t("x_run_texts"), "doc"))
    return runs.select("run_id", "migration_type", "status", "dry_run", F.col("files")[0].alias("first_file"), "duration")


@check("run_history_stats", ("x_run_texts",), f"""WITH {_RUNS}
    SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE status = 'success') AS BIGINT) AS success,
           CAST(count(*) FILTER (WHERE status = 'error') AS BIGINT) AS errors,
           (SELECT run_id FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 1) AS last_run FROM runs""")
def run_history_stats(t: Tables) -> DataFrame:
    return run_statistics(parse_runs(t("x_run_texts"), "doc"))


@check("run_history_newest", ("x_run_texts",), f"""WITH {_RUNS}
    SELECT run_id, status FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 8""")
def run_history_newest(t: Tables) -> DataFrame:
    return newest_runs(parse_runs(t("x_run_texts"), "doc"), 8).select("run_id", "status")


@check("run_record_upsert", ("x_run_texts",), f"""WITH {_RUNS}
    SELECT CASE WHEN event_type = 'view' THEN 'finished' ELSE status END AS status, CAST(count(*) AS BIGINT) AS n_rows FROM runs GROUP BY 1""")
def run_record_upsert(t: Tables) -> DataFrame:
    runs = parse_runs(t("x_run_texts"), "doc")
    finished = runs.filter("status = 'running'").withColumn("status", F.lit("finished"))
    return record_run(runs, finished).groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))
