"""Units, customers, links, leases, billing, balances, cards and gate log with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.registry import (
    PARAMS, TEXT_CUSTOMERS, TODAY_SQL, UNITS, UPDATING, Tables, accepted_sql, big, check, clean, counters_sql, day,
    empty, free_at, idt, money_cents, num, rejects_sql, strptime, ts, vc,
)
from leaseload.operators.load import upsert
from leaseload.operators.outcome import Outcome
from leaseload.plans.balances import load_balances
from leaseload.plans.billing import load_billing_schedules, open_leases, rent_roll_days
from leaseload.plans.cards import load_profiles, match_holders
from leaseload.plans.customers import (
    latest_per_person, load_customers, load_former_customers, load_former_with_notes, split_former,
)
from leaseload.plans.gate import load_gate_log
from leaseload.plans.tenancy import load_history_leases, load_history_links, load_leases, load_links
from leaseload.plans.units import UNIT_KEY, UNIT_UPDATES, load_units

ONE = "_o1"


def free_day(x: str) -> str:
    return f"CAST({free_at(x)} AS DATE)"


# -- leases and links -----------------------------------------------------------

TENANCY = ("x_tenancy", "t_customers", "t_units")


TOO_LARGE = {"amount_out_of_range": "error"}
LEASE_AMOUNTS = " OR ".join(f"{money_cents(c)} IS NULL" for c in ("DCRENT", "DCSCHEDRENT", "DCSECDEPPAID", "DCINSURPREMIUM"))


def link_amounts(marks: bool) -> str:
    """Rents of more than ten digits before the point."""
    plain = "replace(ltrim(trim({0}), '$'), ',', '')" if marks else "trim({0})"
    return " OR ".join(f"COALESCE(TRY_CAST({plain.format(c)} AS DOUBLE) >= 1e10, FALSE)" for c in ("DCRENT", "DCSCHEDRENT"))


def tenancy_sql(tenant: str, rules: str, known: str, key: str, where: str = "TRUE", amounts: str = LEASE_AMOUNTS) -> str:
    return f"""{TEXT_CUSTOMERS}, {UNITS},
    p AS (SELECT x.*, {tenant} AS tenant, trim(SUNITNAME) AS unit, {free_day('DMOVEDIN')} AS moved_in,
                 COALESCE({free_day('DLEASE')}, {free_day('DMOVEDIN')}) AS lease_date, {free_day('DPAIDTHRU')} AS paid_thru,
                 {free_day('DMOVEDOUT')} AS moved_out, {free_day('DSCHEDOUT')} AS sched FROM x_tenancy x WHERE {where}),
    q AS (SELECT p.*, customers.customer_id, units.unit_id FROM p LEFT JOIN customers ON tenant = tenant_key
          LEFT JOIN units ON unit = unit_name),
    c AS (SELECT q.*, {key} AS ky,
        CASE WHEN customer_id IS NULL THEN 'no_customer' WHEN unit_id IS NULL THEN 'no_unit'
             WHEN moved_in IS NULL THEN 'no_move_in' {rules}
             WHEN COALESCE(lower(trim(DCRENT)) IN ('', 'nan', 'none'), TRUE) THEN 'no_rent'
             WHEN {amounts} THEN 'amount_out_of_range' END AS b,
        {known} AS k, CAST(NULL AS VARCHAR) AS a FROM q)"""


LEASE_SQL = tenancy_sql(
    "trim(TENANTID)", "WHEN paid_thru IS NULL THEN 'no_paid_through'",
    "CASE WHEN unit_id IN (SELECT unit_id FROM t_leases WHERE status = 'ACTIVE') THEN 'unit_occupied' END", "unit_id",
)
ENDED = "DMOVEDOUT IS NOT NULL AND lower(trim(DMOVEDOUT)) <> 'nat'"
HISTORY_LEASE_SQL = tenancy_sql(
    "split_part(trim(TENANTID), '.', 1)",
    "WHEN moved_out IS NULL THEN 'no_move_out' WHEN paid_thru IS NULL THEN 'no_paid_through'",
    """CASE WHEN EXISTS (SELECT 1 FROM t_leases l WHERE l.move_out_date IS NULL AND l.customer_id = q.customer_id
                         AND l.unit_id = q.unit_id AND l.move_in_date = q.moved_in) THEN 'active_lease'
            WHEN EXISTS (SELECT 1 FROM t_leases l WHERE l.customer_id = q.customer_id AND l.unit_id = q.unit_id
                         AND l.move_in_date = q.moved_in AND l.move_out_date = q.moved_out) THEN 'duplicate' END""",
    "(customer_id, unit_id, moved_in, moved_out)", ENDED,
)
LINK_SQL = tenancy_sql(
    "trim(TENANTID)", "",
    "CASE WHEN EXISTS (SELECT 1 FROM t_links l WHERE l.customer_id = q.customer_id AND l.unit_id = q.unit_id) THEN 'duplicate' END",
    "(customer_id, unit_id)", amounts=link_amounts(True),
)
HISTORY_LINK_SQL = tenancy_sql(
    "split_part(trim(TENANTID), '.', 1)", "WHEN moved_out IS NULL THEN 'no_move_out'",
    """CASE WHEN EXISTS (SELECT 1 FROM t_links l WHERE l.move_out_date IS NOT NULL AND l.customer_id = q.customer_id
                         AND l.unit_id = q.unit_id AND l.lease_date = q.lease_date) THEN 'duplicate' END""",
    "(customer_id, unit_id, lease_date)", ENDED, link_amounts(False),
)


def _lease_columns(schedule: str, status: str) -> str:
    rent, premium = money_cents("DCRENT"), money_cents("DCINSURPREMIUM")
    return f"""customer_id, unit_id, {day('moved_in')} AS move_in_date, {day('lease_date')} AS lease_date,
        {day('paid_thru')} AS paid_through_date, {day(schedule)} AS schedule_date, {day('moved_out')} AS move_out_date,
        {rent} AS rental_rate_in_cents,
        CASE WHEN {money_cents('DCSCHEDRENT')} = 0 THEN {rent} ELSE {money_cents('DCSCHEDRENT')} END AS schedule_rate_in_cents,
        {money_cents('DCSECDEPPAID')} AS security_deposit_in_cents, {premium} AS insurance_rate_in_cents,
        CASE WHEN {premium} > 0 THEN 'BASIC' ELSE 'NONE' END AS insurance_option,
        CAST(least(day(moved_in), 30) AS INTEGER) AS charge_day, '{status}' AS status, {big('EMPLOYEEID')} AS external_employee_id"""


LEASE_SHOWN = (
    "customer_id", "unit_id", "move_in_date", "lease_date", "paid_through_date", "schedule_date", "move_out_date",
    "rental_rate_in_cents", "schedule_rate_in_cents", "security_deposit_in_cents", "insurance_rate_in_cents",
    "insurance_option", "charge_day", "status", "external_employee_id",
)


def leases(t: Tables) -> Outcome:
    return load_leases(t("x_tenancy"), t("t_customers"), t("t_units"), t("t_leases"), PARAMS)


def history_leases(t: Tables) -> Outcome:
    return load_history_leases(t("x_tenancy"), t("t_customers"), t("t_units"), t("t_leases"), PARAMS)


@check("lease_active_first_wins", (*TENANCY, "t_leases"),
       accepted_sql(LEASE_SQL, _lease_columns("COALESCE(sched, moved_in)", "ACTIVE"), ONE))
def lease_active_first_wins(t: Tables) -> DataFrame:
    return leases(t).accepted.select(*LEASE_SHOWN)


@check("lease_active_counters", (*TENANCY, "t_leases"), counters_sql(LEASE_SQL, TOO_LARGE, ONE))
def lease_active_counters(t: Tables) -> DataFrame:
    return leases(t).counters


@check("lease_active_rejects", (*TENANCY, "t_leases"), rejects_sql(LEASE_SQL, "unit", ONE))
def lease_active_rejects(t: Tables) -> DataFrame:
    return leases(t).rejects.select("row_id", "reason")


@check("lease_history_quad_dedup", (*TENANCY, "t_leases"),
       accepted_sql(HISTORY_LEASE_SQL, _lease_columns("greatest(COALESCE(sched, moved_in), moved_in)", "TERMINATED"), ONE))
def lease_history_quad_dedup(t: Tables) -> DataFrame:
    return history_leases(t).accepted.select(*LEASE_SHOWN)


@check("lease_history_counters", (*TENANCY, "t_leases"), counters_sql(HISTORY_LEASE_SQL, TOO_LARGE, ONE))
def lease_history_counters(t: Tables) -> DataFrame:
    return history_leases(t).counters


@check("lease_history_updates", (*TENANCY, "t_leases"), f"""WITH {HISTORY_LEASE_SQL},
    hits AS (SELECT *, row_number() OVER (PARTITION BY ky ORDER BY _o1 DESC) AS rn FROM c WHERE b IS NULL AND k = 'duplicate')
    SELECT customer_id, unit_id, {day('moved_in')} AS move_in_date, {day('moved_out')} AS move_out_date,
           {day('paid_thru')} AS paid_through_date, {money_cents('DCRENT')} AS rental_rate_in_cents FROM hits WHERE rn = 1""")
def lease_history_updates(t: Tables) -> DataFrame:
    updating = load_history_leases(t("x_tenancy"), t("t_customers"), t("t_units"), t("t_leases"), UPDATING)
    return updating.updates.select(
        "customer_id", "unit_id", "move_in_date", "move_out_date", "paid_through_date", "rental_rate_in_cents"
    )


def _dollars(x: str, marks: bool) -> str:
    plain = f"replace(ltrim(trim({x}), '$'), ',', '')" if marks else f"trim({x})"
    return f"COALESCE(TRY_CAST(round_even(TRY_CAST({plain} AS DECIMAL(38,18)), 2) AS DECIMAL(12,2)), CAST(0 AS DECIMAL(12,2)))"


def _link_columns(marks: bool, charge: str, code: str) -> str:
    rent, scheduled = _dollars("DCRENT", marks), _dollars("DCSCHEDRENT", marks)
    return f"""customer_id, unit_id, {day('lease_date')} AS lease_date, {day('moved_out')} AS move_out_date,
        {day('paid_thru')} AS paid_through_date, {day('sched')} AS scheduled_date, {vc(rent)} AS rental_rate,
        {vc(f'CASE WHEN {scheduled} = 0 THEN {rent} ELSE {scheduled} END')} AS scheduled_rate,
        CAST({charge} AS INTEGER) AS charge_day, {code} AS access_code"""


LINK_SHOWN = (
    "customer_id", "unit_id", "lease_date", "move_out_date", "paid_through_date", "scheduled_date", "rental_rate",
    "scheduled_rate", "charge_day", "access_code",
)


def links(t: Tables, params=PARAMS) -> Outcome:
    return load_links(t("x_tenancy"), t("t_customers"), t("t_units"), t("t_links"), params)


@check("customer_unit_links", (*TENANCY, "t_links"),
       accepted_sql(LINK_SQL, _link_columns(True, "day(moved_in)", f"substr({clean('SACCESSCODE')}, 1, 10)"), ONE))
def customer_unit_links(t: Tables) -> DataFrame:
    return links(t).accepted.select(*LINK_SHOWN)


@check("customer_unit_link_counters", (*TENANCY, "t_links"), counters_sql(LINK_SQL, TOO_LARGE, ONE))
def customer_unit_link_counters(t: Tables) -> DataFrame:
    return links(t).counters


@check("customer_unit_link_update_counters", (*TENANCY, "t_links"), counters_sql(LINK_SQL, TOO_LARGE, ONE, updating=True))
def customer_unit_link_update_counters(t: Tables) -> DataFrame:
    return links(t, UPDATING).counters


@check("history_links", (*TENANCY, "t_links"),
       accepted_sql(HISTORY_LINK_SQL, _link_columns(
           False, "least(day(moved_in), 28)", "NULLIF(substr(trim(SACCESSCODE), 1, 10), '')"), ONE))
def history_links(t: Tables) -> DataFrame:
    return load_history_links(
        t("x_tenancy"), t("t_customers"), t("t_units"), t("t_links"), PARAMS
    ).accepted.select(*LINK_SHOWN)


@check("history_link_counters", (*TENANCY, "t_links"), counters_sql(HISTORY_LINK_SQL, TOO_LARGE, ONE))
def history_link_counters(t: Tables) -> DataFrame:
    return load_history_links(t("x_tenancy"), t("t_customers"), t("t_units"), t("t_links"), PARAMS).counters


# -- billing --------------------------------------------------------------------

BILLING = (*TENANCY, "x_rent_roll", "t_leases", "t_schedules")
BILLING_FORMATS = ["%m/%d/%Y", "%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%m-%d-%Y %H:%M:%S", "%m-%d-%Y"]


def next_billing_sql(charge: str) -> str:
    first = f"date_trunc('month', {TODAY_SQL})"

    def capped(month: str) -> str:
        return f"CAST({month} + to_days(CAST(least({charge}, day(last_day({month}))) - 1 AS INTEGER)) AS DATE)"

    following = f"({first} + INTERVAL 1 MONTH)"
    return f"CASE WHEN {capped(first)} >= {TODAY_SQL} THEN {capped(first)} ELSE {capped(following)} END"


OPEN_LEASES_SQL = """open_leases AS (SELECT customer_id, unit_id, max(id) AS lease_id FROM t_leases
    WHERE move_out_date IS NULL GROUP BY 1, 2)"""
ROLL_SQL = f"roll AS (SELECT trim(UNIT) AS unit_name, {big('\"CHARGE DAY\"')} AS roll_day FROM x_rent_roll)"
BILLING_SQL = f"""{TEXT_CUSTOMERS}, {UNITS}, {OPEN_LEASES_SQL}, {ROLL_SQL},
    p AS (SELECT x.*, {idt('TENANTID')} AS tenant, trim(SUNITNAME) AS unit, CAST({strptime('DLEASE', BILLING_FORMATS)} AS DATE) AS lease,
                 CASE {idt('BILLINGFREQID')} WHEN '1' THEN 'DAILY' WHEN '2' THEN 'WEEKLY' WHEN '3' THEN 'MONTHLY' WHEN '4' THEN 'QUARTERLY'
                      WHEN '5' THEN 'SEMI_ANNUALLY' WHEN '6' THEN 'ANNUAL' WHEN '7' THEN 'TWENTY_EIGHT_DAYS' END AS freq
          FROM x_tenancy x WHERE {empty('DMOVEDOUT')} AND {empty('DDELETED2')}),
    q AS (SELECT p.*, customers.customer_id, units.unit_id, o.lease_id,
                 least(COALESCE(NULLIF(roll_day, 0), NULLIF({big('IPROCESSDAYOFMONTH')}, 0), day(lease), 1), 28) AS charge
          FROM p LEFT JOIN customers ON tenant = tenant_key LEFT JOIN units ON unit = units.unit_name
          LEFT JOIN roll ON unit = roll.unit_name AND units.unit_id IS NOT NULL
          LEFT JOIN open_leases o ON customers.customer_id = o.customer_id AND units.unit_id = o.unit_id),
    c AS (SELECT q.*, lease_id AS ky,
        CASE WHEN freq IS NULL THEN 'unknown_frequency' WHEN freq NOT IN ('MONTHLY', 'QUARTERLY', 'ANNUAL') THEN 'unsupported_frequency'
             WHEN customer_id IS NULL THEN 'no_customer' WHEN unit_id IS NULL THEN 'no_unit' WHEN lease_id IS NULL THEN 'no_lease'
             WHEN lease IS NULL THEN 'no_lease_date' END AS b,
        CASE WHEN lease_id IN (SELECT rental_agreement_id FROM t_schedules) THEN 'duplicate' END AS k,
        CAST(NULL AS VARCHAR) AS a FROM q)"""


def billing(t: Tables) -> Outcome:
    return load_billing_schedules(
        t("x_tenancy"), t("x_rent_roll"), t("t_customers"), t("t_units"), t("t_leases"), t("t_schedules"), PARAMS
    )


@check("billing_schedule", BILLING, accepted_sql(BILLING_SQL, f"""customer_id, unit_id, lease_id AS rental_agreement_id,
    freq AS billing_frequency, CAST(charge AS INTEGER) AS charge_day, {day('lease')} AS start_date,
    {day(next_billing_sql('charge'))} AS next_billing_date, {big('EMPLOYEEID')} AS external_employee_id""", ONE))
def billing_schedule(t: Tables) -> DataFrame:
    return billing(t).accepted.select(
        "customer_id", "unit_id", "rental_agreement_id", "billing_frequency", "charge_day", "start_date",
        "next_billing_date", "external_employee_id",
    )


@check("billing_counters", BILLING, counters_sql(BILLING_SQL, {}, ONE))
def billing_counters(t: Tables) -> DataFrame:
    return billing(t).counters


@check("billing_rejects", BILLING, rejects_sql(BILLING_SQL, "unit", ONE))
def billing_rejects(t: Tables) -> DataFrame:
    return billing(t).rejects.select("row_id", "reason")


@check("lookup_open_lease", ("s_leases",), f"""WITH {OPEN_LEASES_SQL.replace('t_leases', 's_leases')}
    SELECT customer_id, unit_id, lease_id AS rental_agreement_id FROM open_leases""")
def lookup_open_lease(t: Tables) -> DataFrame:
    return open_leases(t("s_leases"))


@check("lookup_rent_roll_day", ("x_rent_roll",), f"""WITH {ROLL_SQL}
    SELECT unit_name, roll_day FROM roll WHERE unit_name <> '' AND roll_day IS NOT NULL""")
def lookup_rent_roll_day(t: Tables) -> DataFrame:
    return rent_roll_days(t("x_rent_roll"))


# -- customers ------------------------------------------------------------------


def _name(first: str, middle: str) -> str:
    return f"CASE WHEN {clean(first)} IS NOT NULL THEN {clean(first)} || COALESCE(' ' || {clean(middle)}, '') END"


CUSTOMER_SQL = f"""c AS (SELECT x.*, {clean('TENANTID')} AS ky,
        CASE WHEN {clean('TENANTID')} IS NULL THEN 'no_tenant_id' END AS b,
        CASE WHEN {clean('TENANTID')} IN (SELECT external_id FROM t_customers) THEN 'duplicate' END AS k,
        CAST(NULL AS VARCHAR) AS a FROM x_customers x)"""
CUSTOMER_SHOWN = (
    "external_id", "first_name", "last_name", "company_name", "address1", "address2", "phone", "alternate_first_name",
    "alternate_phone", "email", "access_gate_code", "external_employee_id", "customer_status_id",
)
_CUSTOMER_COLUMNS = f"""ky AS external_id, {_name('SFNAME', 'SMI')} AS first_name, {clean('SLNAME')} AS last_name,
    {clean('SCOMPANY')} AS company_name, {clean('SADDR1')} AS address1, {clean('SADDR2')} AS address2, {clean('SPHONE')} AS phone,
    {_name('SFNAMEALT', 'SMIALT')} AS alternate_first_name, {clean('SPHONEALT')} AS alternate_phone, {clean('SEMAIL')} AS email,
    {clean('SACCESSCODE')} AS access_gate_code, {big('EMPLOYEEID')} AS external_employee_id, 1 AS customer_status_id"""


def stored_customers(t: Tables) -> DataFrame:
    """Customers loaded before: those with a high employee number."""
    return t("t_customers").filter("external_employee_id > 12")


def _stored_sql(sql: str) -> str:
    return sql.replace("FROM t_customers)", "FROM t_customers WHERE external_employee_id > 12)")


def customers(t: Tables, params=PARAMS) -> Outcome:
    return load_customers(t("x_customers"), stored_customers(t), params)


CUSTOMER_CHECK_SQL = _stored_sql(CUSTOMER_SQL)


@check("customers_load", ("x_customers", "t_customers"), accepted_sql(CUSTOMER_CHECK_SQL, _CUSTOMER_COLUMNS, "_o1, _o2"))
def customers_load(t: Tables) -> DataFrame:
    return customers(t).accepted.select(*CUSTOMER_SHOWN)


@check("customers_counters", ("x_customers", "t_customers"), counters_sql(CUSTOMER_CHECK_SQL, {}, "_o1, _o2"))
def customers_counters(t: Tables) -> DataFrame:
    return customers(t).counters


@check("customers_update_mode_insert", ("x_customers", "t_customers"), f"""WITH {CUSTOMER_CHECK_SQL},
    n AS (SELECT *, row_number() OVER (PARTITION BY ky ORDER BY _o1, _o2) AS f, row_number() OVER (PARTITION BY ky ORDER BY _o1 DESC, _o2 DESC) AS l
          FROM c WHERE b IS NULL AND k IS NULL)
    SELECT ky AS external_id, max(CASE WHEN f = 1 THEN {big('EMPLOYEEID')} END) AS external_employee_id,
           max(CASE WHEN l = 1 THEN {clean('SLNAME')} END) AS last_name FROM n GROUP BY ky""")
def customers_update_mode_insert(t: Tables) -> DataFrame:
    return customers(t, UPDATING).accepted.select("external_id", "external_employee_id", "last_name")


@check("customers_updates", ("x_customers", "t_customers"), f"""WITH {CUSTOMER_CHECK_SQL},
    n AS (SELECT *, row_number() OVER (PARTITION BY ky ORDER BY _o1 DESC, _o2 DESC) AS l FROM c WHERE b IS NULL AND k IS NOT NULL)
    SELECT ky AS external_id, {clean('SLNAME')} AS last_name, {clean('SEMAIL')} AS email FROM n WHERE l = 1""")
def customers_updates(t: Tables) -> DataFrame:
    return customers(t, UPDATING).updates.select("external_id", "last_name", "email")


@check("customers_update_counters", ("x_customers", "t_customers"),
       counters_sql(CUSTOMER_CHECK_SQL, {}, "_o1, _o2", updating=True))
def customers_update_counters(t: Tables) -> DataFrame:
    return customers(t, UPDATING).counters


GONE = "COALESCE(trim(ACTIVELEDGERS), '') IN ('', '0')"
FORMER_SQL = _stored_sql(f"""c AS (SELECT x.*, {idt('TENANTID')} AS ky,
        CASE WHEN TENANTID IS NULL THEN 'no_tenant_id' END AS b,
        CASE WHEN {idt('TENANTID')} IN (SELECT external_id FROM t_customers) THEN 'duplicate' END AS k,
        CAST(NULL AS VARCHAR) AS a FROM x_former x WHERE {GONE})""")


@check("former_customers_load", ("x_former", "t_customers"), accepted_sql(FORMER_SQL, f"""ky AS external_id,
    {_name('FIRSTNAME', 'MI')} AS first_name, {clean('LASTNAME')} AS last_name, {clean('ADDRESS1')} AS address1, {clean('EMAIL')} AS email,
    {clean('PHONE')} AS phone, {clean('MOBILE')} AS mobile, 2 AS customer_status_id""", ONE))
def former_customers_load(t: Tables) -> DataFrame:
    return load_former_customers(t("x_former"), stored_customers(t), PARAMS).accepted.select(
        "external_id", "first_name", "last_name", "address1", "email", "phone", "mobile", "customer_status_id"
    )


@check("former_customers_counters", ("x_former", "t_customers"), counters_sql(FORMER_SQL, {"no_tenant_id": "error"}, ONE))
def former_customers_counters(t: Tables) -> DataFrame:
    return load_former_customers(t("x_former"), stored_customers(t), PARAMS).counters


@check("former_split", ("x_former",), f"""
    SELECT CASE WHEN {GONE} THEN 'former' ELSE 'active' END AS side, ACTIVELEDGERS AS active_ledgers, CAST(count(*) AS BIGINT) AS n_rows
    FROM x_former GROUP BY 1, 2""")
def former_split(t: Tables) -> DataFrame:
    gone, active = split_former(t("x_former"))
    both = gone.withColumn("side", F.lit("former")).unionByName(active.withColumn("side", F.lit("active")))
    return both.groupBy("side", F.col("ACTIVELEDGERS").alias("active_ledgers")).agg(F.count(F.lit(1)).alias("n_rows"))


_CONTACT = f"COALESCE({clean('PHONE')}, {clean('MOBILE')}, {clean('EMAIL')}, '')"


@check("former_latest_per_person", ("x_former",), f"""
    SELECT last_name, first_name, contact, o_id FROM (
        SELECT trim(LASTNAME) AS last_name, trim(FIRSTNAME) AS first_name, {_CONTACT} AS contact, _o1 AS o_id,
               row_number() OVER (PARTITION BY lower(trim(LASTNAME)), lower(trim(FIRSTNAME)), {_CONTACT}
                                  ORDER BY {free_at('DATEMOVEDOUT')} DESC NULLS LAST, _o1) AS rn FROM x_former) WHERE rn = 1""")
def former_latest_per_person(t: Tables) -> DataFrame:
    from leaseload.functions.text import clean_text

    return latest_per_person(t("x_former")).select(
        F.trim("LASTNAME").alias("last_name"), F.trim("FIRSTNAME").alias("first_name"),
        F.coalesce(clean_text("PHONE"), clean_text("MOBILE"), clean_text("EMAIL"), F.lit("")).alias("contact"),
        F.col("_row_ord").alias("o_id"),
    )


_SYNTHETIC = """'FORMER-' || substr(sha256(trim(upper(trim(COALESCE(LASTNAME, ''))) || ',' || upper(trim(COALESCE(FIRSTNAME, ''))), ',')
    || '|' || COALESCE(NULLIF(trim(PHONE), ''), NULLIF(trim(MOBILE), ''), NULLIF(trim(EMAIL), ''), '')), 1, 12)"""
_ISO = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%m/%d/%Y", "%m-%d-%Y"]
NOTES_SQL = f"""c AS (SELECT x.*, {_SYNTHETIC} AS ky, CASE WHEN {clean('LASTNAME')} IS NULL THEN 'no_last_name' END AS b,
    CAST(NULL AS VARCHAR) AS k, CAST(NULL AS VARCHAR) AS a FROM x_former x)"""


@check("synthetic_external_id", ("x_former", "t_customers"), accepted_sql(NOTES_SQL, f"""ky AS external_id,
    {clean('LASTNAME')} AS last_name, 'Last unit: ' || UNITNAME || COALESCE(' | Move-in: ' || {day(strptime('DATEMOVEDIN', _ISO))}, '')
    || COALESCE(' | Move-out: ' || {day(strptime('DATEMOVEDOUT', _ISO))}, '') AS notes""", ONE))
def synthetic_external_id(t: Tables) -> DataFrame:
    return load_former_with_notes(t("x_former"), t("t_customers"), PARAMS).accepted.select(
        "external_id", "last_name", "notes"
    )


@check("synthetic_id_counters", ("x_former", "t_customers"), counters_sql(NOTES_SQL, {}, ONE))
def synthetic_id_counters(t: Tables) -> DataFrame:
    return load_former_with_notes(t("x_former"), t("t_customers"), PARAMS).counters


# -- balances -------------------------------------------------------------------

_OWED = "DCRENTBAL DCLATEFEE1BAL DCLATEFEE2BAL DCLATEFEE3BAL DCLATEFEE4BAL DCLATEFEE5BAL DCNSFBAL DCADMINFEEBAL DCRECCHG8BAL".split()
_BALANCE = " + ".join(f"COALESCE({num(c)}, 0)" for c in _OWED)
BALANCE_SQL = f"""{TEXT_CUSTOMERS},
    c AS (SELECT x.*, customer_id, customer_id AS ky, CASE WHEN customer_id IS NULL THEN 'no_customer'
             WHEN TRY_CAST(round_even(({_BALANCE}) * 100, 0) AS BIGINT) IS NULL THEN 'amount_out_of_range' END AS b,
        CASE WHEN customer_id % 7 = 0 THEN 'duplicate' END AS k, CAST(NULL AS VARCHAR) AS a FROM x_balances x LEFT JOIN customers ON trim(TENANTID) = tenant_key)"""


def balances(t: Tables) -> Outcome:
    """Every seventh customer has a stored balance."""
    stored = t("t_customers").select(F.col("id").alias("customer_id")).filter("customer_id % 7 = 0")
    return load_balances(t("x_balances"), t("t_customers"), stored, PARAMS)


@check("customer_balance", ("x_balances", "t_customers"), accepted_sql(BALANCE_SQL, f"""customer_id,
    greatest(0, TRY_CAST(round_even(({_BALANCE}) * 100, 0) AS BIGINT)) AS balance_in_cents, {money_cents('DCCREDITBAL')} AS credit_balance_in_cents,
    {ts(free_at('DPMTLAST'))} AS last_payment_date, {money_cents('DCPMTLASTAMT')} AS last_payment_amount_in_cents""", ONE))
def customer_balance(t: Tables) -> DataFrame:
    return balances(t).accepted.select(
        "customer_id", "balance_in_cents", "credit_balance_in_cents", "last_payment_date", "last_payment_amount_in_cents"
    )


# -- cards ----------------------------------------------------------------------

MATCH_SQL = f"""people AS (SELECT lower(trim(last_name)) AS surname, lower(trim(COALESCE(address1, ''))) AS street, id FROM t_customers),
    p AS (SELECT x.*, CASE WHEN contains(Name, ',') THEN lower(trim(split_part(Name, ',', 1))) END AS holder,
                 lower(trim(COALESCE(Address, ''))) AS street, {free_at('ExpirationDate')} AS expires FROM x_cards x),
    n AS (SELECT surname, count(*) AS n, max(id) AS id FROM people GROUP BY 1),
    s AS (SELECT surname, street, count(*) AS n, max(id) AS id FROM people GROUP BY 1, 2),
    q AS (SELECT p.*, n.n AS n_name, s.n AS n_street, CASE WHEN n.n = 1 THEN n.id WHEN s.n = 1 THEN s.id END AS customer_id
          FROM p LEFT JOIN n ON holder = n.surname LEFT JOIN s ON holder = s.surname AND p.street = s.street)"""
_KEY = "concat_ws('|', CAST({0}customer_id AS VARCHAR), {1}, COALESCE(CAST({2} AS VARCHAR), ''), COALESCE(CAST({3} AS VARCHAR), ''))"
CARD_SQL = f"""{MATCH_SQL},
    c AS (SELECT q.*, right(replace(replace(CardNumber, '*', ''), ' ', ''), 4) AS last4,
        {_KEY.format('', "right(replace(replace(CardNumber, '*', ''), ' ', ''), 4)", 'month(expires)', 'year(expires)')} AS ky,
        CASE WHEN holder IS NULL THEN 'no_comma' WHEN n_name IS NULL THEN 'no_customer'
             WHEN n_name > 1 AND n_street IS NULL THEN 'ambiguous_no_address' WHEN n_name > 1 AND n_street > 1 THEN 'ambiguous_same_address' END AS b,
        CASE WHEN {_KEY.format('', "right(replace(replace(CardNumber, '*', ''), ' ', ''), 4)", 'month(expires)', 'year(expires)')}
             IN (SELECT {_KEY.format('', 'card_last4', 'card_exp_month', 'card_exp_year')} FROM t_profiles) THEN 'duplicate' END AS k,
        CAST(NULL AS VARCHAR) AS a FROM q)"""
CARDS = ("x_cards", "t_customers", "t_profiles")


@check("card_match_disambiguation", ("x_cards", "t_customers"), f"""WITH {MATCH_SQL}
    SELECT _o1 AS card, {vc('customer_id')} AS customer_id, {vc('n_name')} AS n_name, {vc('n_street')} AS n_street FROM q""",
    as_text=("customer_id", "n_name", "n_street"))
def card_match_disambiguation(t: Tables) -> DataFrame:
    return match_holders(t("x_cards"), t("t_customers")).select(
        F.col("_row_ord").alias("card"), "customer_id", "n_name", "n_street"
    )


@check("card_profiles_load", CARDS, f"""WITH {CARD_SQL},
    last_row AS (SELECT *, row_number() OVER (PARTITION BY ky ORDER BY _o1 DESC) AS l FROM c WHERE b IS NULL AND k IS NULL),
    brand AS (SELECT *, CASE lower(trim(CardType)) WHEN 'master card' THEN 'mastercard' WHEN 'american express' THEN 'amex'
                             WHEN '' THEN NULL ELSE lower(trim(CardType)) END AS brand FROM last_row WHERE l = 1)
    SELECT customer_id, brand AS card_brand, last4 AS card_last4, {vc('month(expires)')} AS card_exp_month,
           {vc('year(expires)')} AS card_exp_year, {clean('NameOnCard')} AS billing_name, {clean('Address')} AS billing_address_line1,
           {clean('ZipCode')} AS billing_postal_code FROM brand""", as_text=("card_exp_month", "card_exp_year"))
def card_profiles_load(t: Tables) -> DataFrame:
    return load_profiles(t("x_cards"), t("t_customers"), t("t_profiles"), PARAMS).accepted.select(
        "customer_id", "card_brand", "card_last4", "card_exp_month", "card_exp_year", "billing_name",
        "billing_address_line1", "billing_postal_code",
    )


@check("card_profiles_counters", CARDS, counters_sql(CARD_SQL, {}, ONE, updating=True))
def card_profiles_counters(t: Tables) -> DataFrame:
    return load_profiles(t("x_cards"), t("t_customers"), t("t_profiles"), PARAMS).counters


@check("card_profile_updates", CARDS, f"""WITH {CARD_SQL},
    last_row AS (SELECT *, row_number() OVER (PARTITION BY ky ORDER BY _o1 DESC) AS l FROM c WHERE b IS NULL AND k IS NOT NULL)
    SELECT ky AS profile_key, {clean('NameOnCard')} AS billing_name, {clean('ZipCode')} AS billing_postal_code FROM last_row WHERE l = 1""")
def card_profile_updates(t: Tables) -> DataFrame:
    return load_profiles(t("x_cards"), t("t_customers"), t("t_profiles"), PARAMS).updates.select(
        "profile_key", "billing_name", "billing_postal_code"
    )


# -- gate log -------------------------------------------------------------------


@check("gate_log_load", ("x_gate",), f"""
    SELECT {ts(free_at('OCCURRED'))} AS created_at, NULLIF(substr(trim(ACCESSPOINTNAME), 1, 32), '') AS command,
           NULLIF(trim(DESCRIPTION), '') AS pdk_response_status, lower(trim(DESCRIPTION)) = 'granted' AS success,
           CASE WHEN lower(trim(DESCRIPTION)) <> 'granted' THEN NULLIF(trim(DESCRIPTION), '') END AS error_message,
           NULLIF(substr(concat_ws(', ', NULLIF(trim(ACCESSORLASTNAME), ''), NULLIF(trim(ACCESSORFIRSTNAME), '')), 1, 100), '') AS triggered_by
    FROM x_gate WHERE {free_at('OCCURRED')} IS NOT NULL""")
def gate_log_load(t: Tables) -> DataFrame:
    return load_gate_log(t("x_gate"), PARAMS).accepted.select(
        "created_at", "command", "pdk_response_status", "success", "error_message", "triggered_by"
    )


@check("gate_log_counters", ("x_gate",), f"""
    SELECT CASE WHEN {free_at('OCCURRED')} IS NULL THEN 'skip' ELSE 'insert' END AS outcome,
           CASE WHEN {free_at('OCCURRED')} IS NULL THEN 'no_time' ELSE 'new' END AS reason, CAST(count(*) AS BIGINT) AS n_rows
    FROM x_gate GROUP BY 1, 2""")
def gate_log_counters(t: Tables) -> DataFrame:
    return load_gate_log(t("x_gate"), PARAMS).counters


# -- units ----------------------------------------------------------------------


def _lookup(x: str, pairs: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in pairs.items())
    return f"CASE lower(trim({x})) {whens} END"


_YES = {"yes": "TRUE", "y": "TRUE", "true": "TRUE", "1": "TRUE", "no": "FALSE", "n": "FALSE", "false": "FALSE", "0": "FALSE"}


def _flag(x: str) -> str:
    return f"CASE WHEN COALESCE(lower(trim({x})) IN ('', 'nan'), TRUE) THEN FALSE ELSE {_lookup(x, _YES)} END"


_ACCESS = {
    "ground floor driveup": "'GROUND_FLOOR_DRIVEUP'", "driveup covered exterior parking": "'DRIVEUP_COVERED_EXT_PARKING'",
    "multi-floor/level elevator accessible": "'MULTI_FLOOR_ELEVATOR_ACCESSIBLE'",
    "multi-floor/level elevator no-accessible": "'MULTI_FLOOR_ELEVATOR_NON_ACCESSIBLE'",
}
_LIGHTS = {"hallway": "'HALLWAY'", "inside unit": "'INSIDE_UNIT'", "no": "'NO'"}
_LOCKS = {"pad lock": "'PAD_LOCK'", "padlock": "'PAD_LOCK'", "smart lock": "'SMART_LOCK'", "rfid": "'RFID'", "bluetooth": "'BLUETOOTH'"}
_DOORS = {"rollup": "1", "roll up": "1", "swing": "2"}
_MOBILE = {"pod": "'POD'", "shipping container": "'SHIPPING_CONTAINER'", "no": "'NO'"}
_TIMER = f"""CASE WHEN lower(POWER_TIMER_HR) = 'continuous' THEN 'CONTINUOUS' WHEN lower(POWER_TIMER_HR) = 'no' THEN 'NO'
    WHEN {big('POWER_TIMER_HR')} BETWEEN 1 AND 24 THEN 'HOURS_' || {vc(big('POWER_TIMER_HR'))} END"""


def _rate(x: str) -> str:
    return f"TRY_CAST(round_even(TRY_CAST(trim({x}) AS DECIMAL(38,18)), 2) AS DECIMAL(12,2))"


_YES_SHORT = "lower(trim({0})) IN ('yes', 'y')"
UNIT_VALUES_SQL = f"""sizes AS (SELECT replace(replace(lower(trim(value)), '*', 'x'), ' ', '') AS size_key, max(id) AS size_id FROM t_sizes GROUP BY 1),
    v AS (SELECT x._o1, x._o2, {clean('UNITNAME')} AS unit_number, BLDG AS building,
        {_lookup('TYPE', {'apartment': '4', 'rv parking': '5', 'boat parking': '5', 'vehicle parking': '5'})} AS type_id,
        lower(trim(TYPE)) IN ('climate control', 'climate') AS climate_controlled, lower(trim("ENTRY LOCATION")) = 'interior' AS inside,
        {_lookup('"UNIT ACCESS"', _ACCESS)} AS unit_access,
        CASE WHEN regexp_full_match(FLOOR, '[+-]?[0-9]+') THEN CAST(FLOOR AS INTEGER) END AS floor_level,
        {_flag('"POWER (YES/NO)"')} AS power, {_lookup('POWER_LIGHTS', _LIGHTS)} AS power_lights, {_TIMER} AS power_timer_hr,
        NULLIF(trim("UNIT ACCESS HOURS"), '') AS unit_access_hours, {_lookup('ENTRYLOCK', _LOCKS)} AS entry_lock,
        {_lookup('DOORTYPE', _DOORS)} AS door_type_id, {_flag('ADA')} AS ada, {_rate('STANDARDRATE')} AS standard_rate,
        {_rate('PUSHRATE')} AS push_rate, {_lookup('"MOBILE UNIT"', _MOBILE)} AS mobile_unit,
        COALESCE(size_id, (SELECT max(id) FROM t_sizes WHERE value = '0 x 0')) AS unit_size_id,
        CASE WHEN {_YES_SHORT.format('RENTABLE')} THEN 1 WHEN {_YES_SHORT.format('RENTED')} THEN 2
             WHEN {_YES_SHORT.format('RESERVED')} THEN 4 WHEN {_YES_SHORT.format('MAINTENANCE')} THEN 5 ELSE 1 END AS unit_status_id,
        {_flag('"BOX TRUCK RENTAL"')} AS box_truck_rental, {clean('UNITNAME')} IN (SELECT unit_number FROM t_units WHERE reserved) AS stored
        FROM x_units x LEFT JOIN sizes ON replace(replace(lower(trim(UNITSIZE)), '*', 'x'), ' ', '') = size_key),
    w AS (SELECT *, row_number() OVER (PARTITION BY unit_number ORDER BY _o1 DESC, _o2 DESC) AS l FROM v WHERE unit_number IS NOT NULL)"""
_UNIT_COLUMNS = f"""unit_number, building, COALESCE(type_id, 1) AS unit_type_id, climate_controlled, inside, unit_access,
    {vc('floor_level')} AS floor_level, power, power_lights, power_timer_hr, unit_access_hours, entry_lock, {vc('door_type_id')} AS door_type_id,
    ada, {vc('standard_rate')} AS standard_rate, {vc('push_rate')} AS push_rate, mobile_unit, unit_size_id, unit_status_id, box_truck_rental"""
UNIT_SHOWN = (
    "unit_number", "building", "unit_type_id", "climate_controlled", "inside", "unit_access", "floor_level", "power",
    "power_lights", "power_timer_hr", "unit_access_hours", "entry_lock", "door_type_id", "ada", "standard_rate",
    "push_rate", "mobile_unit", "unit_size_id", "unit_status_id", "box_truck_rental",
)
UNITS_USED = ("x_units", "t_sizes", "t_units")
UNIT_TEXT = ("floor_level", "door_type_id")


def stored_units(t: Tables) -> DataFrame:
    """Units loaded before: those held back for a reservation."""
    return t("t_units").filter("reserved")


def units(t: Tables) -> Outcome:
    return load_units(t("x_units"), t("t_sizes"), stored_units(t), PARAMS)


@check("units_insert", UNITS_USED, f"WITH {UNIT_VALUES_SQL} SELECT {_UNIT_COLUMNS} FROM w WHERE l = 1 AND NOT stored", as_text=UNIT_TEXT)
def units_insert(t: Tables) -> DataFrame:
    return units(t).accepted.select(*UNIT_SHOWN)


@check("units_update", UNITS_USED, f"WITH {UNIT_VALUES_SQL} SELECT {_UNIT_COLUMNS} FROM w WHERE l = 1 AND stored", as_text=UNIT_TEXT)
def units_update(t: Tables) -> DataFrame:
    return units(t).updates.select(*UNIT_SHOWN)


@check("units_counters", UNITS_USED, f"""WITH {UNIT_VALUES_SQL},
    j AS (SELECT CASE WHEN unit_number IS NULL THEN 'no_unit_name' WHEN stored THEN 'matched'
                      WHEN row_number() OVER (PARTITION BY unit_number ORDER BY _o1, _o2) = 1 THEN 'new' ELSE 'matched' END AS reason FROM v)
    SELECT CASE reason WHEN 'no_unit_name' THEN 'error' WHEN 'new' THEN 'insert' ELSE 'update' END AS outcome, reason,
           CAST(count(*) AS BIGINT) AS n_rows FROM j GROUP BY 1, 2""")
def units_counters(t: Tables) -> DataFrame:
    return units(t).counters


_BAD_CELLS = {
    "unit_access": ('"UNIT ACCESS"', "unit_access IS NULL"), "floor_level": ("FLOOR", "floor_level IS NULL"),
    "power": ('"POWER (YES/NO)"', "power IS NULL"), "power_lights": ("POWER_LIGHTS", "power_lights IS NULL"),
    "power_timer_hr": ("POWER_TIMER_HR", "power_timer_hr IS NULL"), "entry_lock": ("ENTRYLOCK", "entry_lock IS NULL"),
    "door_type_id": ("DOORTYPE", "door_type_id IS NULL"), "push_rate": ("PUSHRATE", "push_rate IS NULL"),
    "mobile_unit": ('"MOBILE UNIT"', "mobile_unit IS NULL"),
}


@check("unit_field_errors", UNITS_USED, f"WITH {UNIT_VALUES_SQL} " + " UNION ALL ".join(
    f"""SELECT x.UNITNAME AS row_id, '{field}' AS field, x.{cell} AS value FROM v JOIN x_units x ON v._o1 = x._o1 AND v._o2 = x._o2
        WHERE v.unit_number IS NOT NULL AND lower(trim(x.{cell})) NOT IN ('', 'nan') AND v.{test}""" for field, (cell, test) in _BAD_CELLS.items()))
def unit_field_errors(t: Tables) -> DataFrame:
    return units(t).field_errors.select("row_id", "field", "value")


@check("upsert_units", UNITS_USED, f"""WITH {UNIT_VALUES_SQL}, chosen AS (SELECT * FROM w WHERE l = 1)
    SELECT COALESCE(s.unit_number, n.unit_number) AS unit_number, COALESCE(n.building, s.building) AS building,
           {vc('COALESCE(n.standard_rate, s.standard_rate)')} AS standard_rate, COALESCE(s.reserved, FALSE) AS reserved,
           COALESCE(s.created_by, 9) AS created_by
    FROM (SELECT * FROM t_units WHERE reserved) s FULL OUTER JOIN chosen n ON s.unit_number = n.unit_number""")
def upsert_units(t: Tables) -> DataFrame:
    stored = stored_units(t)
    outcome = units(t)
    key = list(UNIT_KEY)
    updated = upsert(stored, outcome.updates, key, list(UNIT_UPDATES))
    final = upsert(updated, outcome.accepted, key, list(UNIT_UPDATES))
    return final.select("unit_number", "building", "standard_rate", "reserved", "created_by")
